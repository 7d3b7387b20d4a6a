"""Helpers of the operators here: worker state, word blocks, hashes of doc ids."""

from __future__ import annotations

import ctypes
import gc
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.materialize import materialize

__all__ = [
    "as_table", "forget", "kept_rows", "light_after", "materialize", "on_worker", "remainder", "rows_of", "ship_package", "text_slices"
]

_state: dict[str, object] = {}
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Needless where the job was submitted with the package (``--py-files``).
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = shutil.make_archive(
            f"{tempfile.mkdtemp(prefix='package-')}/{package.name}", "zip", package.parent, package.name
        )
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


def on_worker(key: str, make: Callable[[], object]) -> object:
    """State that a Python worker keeps between its tasks: the last that was asked for."""
    if key not in _state:
        forget()
        _state[key] = make()
    return _state[key]


def forget() -> None:
    """Drop what the worker keeps, and give the memory back; for tasks that need none of it.

    What was freed stays with the C library, in pieces between what is in use, until it is trimmed:
    a worker would keep the most memory that any of its tasks, of any stage, has used.
    """
    if _state:
        _state.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def light_after(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` over a task's batches, after which the worker drops what it keeps.

    Spark takes idle workers in turn, and an executor may have twice as many as cores, since plans
    with two Python steps need two for a task: so each of them would hold a task's memory while others work.
    """

    def run(batches: Iterator) -> Iterator:
        yield from work(batches)
        forget()

    return run


def rows_of(batches: Iterator[pa.RecordBatch], *names: str, chunk: int = 256) -> Iterator[list[list]]:
    """Columns of at most ``chunk`` rows at a time as Python lists."""
    for batch in batches:
        for start in range(0, batch.num_rows, chunk):
            part = batch.slice(start, chunk)
            yield [part.column(n).to_pylist() for n in names]


def text_slices(data: bytes, width: int = 1 << 20) -> Iterator[bytes]:
    """A long text in slices of about ``width`` bytes that end at ASCII white space."""
    start = 0
    while len(data) - start > width:
        end = start + width
        cut = next((i for i in range(end, len(data)) if data[i] in b" \t\n\v\f\r"), len(data))
        yield data[start:cut]
        start = cut
    if start < len(data):
        yield data[start:]


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % divisor


def as_table(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema
    )


def kept_rows(docs: DataFrame, text_col: str, good: Callable[[list[str | None]], list[bool]], chunk: int = 256) -> DataFrame:
    """The rows of ``docs`` whose texts are ``good``, all columns as they are.

    Rows pass through the tasks batch by batch; only ``chunk`` texts at a time become Python strings.
    """
    place = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for start in range(0, batch.num_rows, chunk):
                part = batch.slice(start, chunk)
                yield part.filter(pa.array(good(part.column(place).cast(pa.string()).to_pylist()), pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
