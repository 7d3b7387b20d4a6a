"""Best-fit packing of tokenized documents into sequences of bounded length.

The plan is made on the histogram of lengths, which has at most ``capacity`` rows whatever
the number of documents: lengths are placed from long to short, all pieces of a length at
once, into the sequences with the least room that still fits them. Pieces then take the
planned places by a join on their rank within their length.

Nulls: a null text is empty, so its only piece is the end token; a row with a null id keeps
it. Repeated rows are packed as often as they occur. An empty table gives an empty result.
Columns other than id and text are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bpe import MergeEncoder, PieceCache
from .common import as_table, light_after, materialize, on_worker, rows_of

# so many tasks share the pieces of one length when they are ranked
SLICES = 1024

_PIECES = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
)


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids cut at ``capacity``."""
    with open(vocabulary, encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())
    end = np.uint32(end_id).astype("<u4").tobytes()
    width = 4 * capacity

    def cache() -> PieceCache:
        return PieceCache(MergeEncoder(definition.value), lambda ids: np.array(ids, "<u4").tobytes())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = on_worker(f"packing {vocabulary}", cache)
        for keys, texts in rows_of(batches, "doc_id", "text"):
            out: list[tuple] = []
            for key, values in zip(keys, known.values(t or "" for t in texts)):
                ids = b"".join(values) + end
                for number, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    out.append((key, number, at // 4, len(part) // 4, zlib.crc32(part)))
            yield as_table(_PIECES, list(zip(*out)))

    thin = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return thin.mapInArrow(light_after(encode), "doc_id long, piece int, start long, length long, ids_crc32 long")


def plan_slots(counts: Iterable[tuple[int, int]], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over a histogram of (length, count).

    Gives slots (length, first_rank, last_rank, per_sequence, first_sequence, offset): the
    pieces of that length with those ranks fill consecutive sequences, ``per_sequence`` in
    each, from ``offset`` on. Sequences with equal history stay together as one range, so the
    number of slots depends on ``capacity`` alone.
    """
    ranges: dict[int, list[tuple[int, int]]] = {}  # free room -> ranges (first sequence, how many)
    rooms: list[int] = []
    opened = 0
    slots = []

    def put(room: int, first: int, many: int) -> None:
        if many and room:
            if room not in ranges:
                ranges[room] = []
                insort(rooms, room)
            ranges[room].append((first, many))

    for length, count in sorted(counts, reverse=True):
        rank = 0
        while rank < count:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                many = -(-(count - rank) // (capacity // length))
                room, first = capacity, opened
                opened += many
            else:
                room = rooms[at]
                first, many = ranges[room].pop()
                if not ranges[room]:
                    del ranges[room]
                    rooms.pop(at)
            each = room // length
            full, rest = divmod(min(count - rank, many * each), each)
            for sequences, pieces in ((full, each), (1, rest)):
                if sequences and pieces:
                    last = rank + sequences * pieces - 1
                    slots.append((length, rank, last, pieces, first, capacity - room))
                    put(room - pieces * length, first, sequences)
                    rank, first, many = last + 1, first + sequences, many - sequences
            put(room, first, many)
    return slots


def ranked(pieces: DataFrame, key: str, order: list[str | Column], slices: int = SLICES) -> DataFrame:
    """Number the rows of each ``key`` from 0, with a frequent key split over ``slices`` tasks."""
    rows = pieces.withColumn("__slice", F.pmod(F.xxhash64(*order), F.lit(slices)).cast("int"))
    within = Window.partitionBy(key, "__slice").orderBy(*order)
    before = Window.partitionBy(key).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(key, "__slice")
        .agg(F.count("*").alias("__rows"))
        .withColumn("__before", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
        .drop("__rows")
    )
    return (
        rows.withColumn("__number", F.row_number().over(within) - 1)
        .join(offsets, [key, "__slice"])
        .withColumn("rank", F.col("__before") + F.col("__number"))
        .drop("__slice", "__number", "__before")
    )


def pack(
    docs: DataFrame,
    vocabulary: str,
    *,
    capacity: int = 4096,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every piece of every document with its place.

    Returns doc_id, piece, start, length, ids_crc32 and sequence_id, offset: pieces of one
    sequence do not overlap and leave no gap from 0 on.
    """
    pieces = materialize(token_pieces(docs, vocabulary, capacity, end_id, id_col, text_col), "token-pieces")
    histogram = pieces.groupBy("length").count().collect()  # at most ``capacity`` rows
    slots = docs.sparkSession.createDataFrame(
        plan_slots([(r["length"], r["count"]) for r in histogram], capacity),
        "slot_length long, first_rank long, last_rank long, per_sequence long, first_sequence long, slot_offset long",
    )
    inside = F.col("rank") - F.col("first_rank")
    return (
        ranked(pieces, "length", ["doc_id", "piece", "ids_crc32"])
        .join(
            F.broadcast(slots),  # bounded by ``capacity``
            (F.col("length") == F.col("slot_length")) & F.col("rank").between(F.col("first_rank"), F.col("last_rank")),
        )
        .select(
            *pieces.columns,
            (F.col("first_sequence") + F.floor(inside / F.col("per_sequence"))).alias("sequence_id"),
            (F.col("slot_offset") + inside % F.col("per_sequence") * F.col("length")).alias("offset"),
        )
    )
