"""Exact token counts from the histogram of encoded lengths.

Documents are counted by length, so that everything after is a table with one row for each
length that occurs. Suffix sums over it answer, for every context limit, how many documents
reach it and how many tokens remain if texts are cut there, and which share is shorter.

A null text is empty and has length 0; repeated rows count as often as they occur; an empty
table gives no rows. Columns other than the text are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import MergeEncoder, PieceCache
from .common import as_table, on_worker, rows_of


def length_histogram(docs: DataFrame, vocabulary: str, *, text_col: str = "text") -> DataFrame:
    """(length, documents): how many texts have each number of ids; counted in tasks first."""
    with open(vocabulary, encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())
    schema = pa.schema([("length", pa.int64()), ("documents", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = on_worker(f"lengths {vocabulary}", lambda: PieceCache(MergeEncoder(definition.value), len))
        found: Counter[int] = Counter()
        for (texts,) in rows_of(batches, "text", chunk=2000):
            found.update(sum(v) for v in known.values(t or "" for t in texts))
        yield as_table(schema, [list(found), list(found.values())])

    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(count, "length long, documents long").groupBy("length").agg(F.sum("documents").alias("documents"))


def token_counts(docs: DataFrame, vocabulary: str, *, text_col: str = "text") -> DataFrame:
    """One row for each length that occurs, as a context limit.

    ``documents`` and ``tokens`` of that length; ``reach`` documents at least as long;
    ``kept_tokens`` if all texts are cut to that length; ``quantile`` the share of documents
    no longer than it; ``total_tokens`` of all.
    """
    order = Window.orderBy("length")  # one row for each length
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    on = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tokens = F.col("length") * F.col("documents")
    return length_histogram(docs, vocabulary, text_col=text_col).select(
        "length",
        "documents",
        tokens.alias("tokens"),
        F.sum("documents").over(on).alias("reach"),
        (F.sum(tokens).over(upto) - tokens + F.col("length") * F.sum("documents").over(on)).alias("kept_tokens"),
        (F.sum("documents").over(upto) / F.sum("documents").over(every)).alias("quantile"),
        F.sum(tokens).over(every).alias("total_tokens"),
    )
