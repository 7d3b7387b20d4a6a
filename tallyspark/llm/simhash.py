"""Near duplicates by SimHash: fingerprints within a few bits, whatever the group sizes.

A fingerprint is cut into a ring of segments. If two fingerprints differ in at most ``bits``
bits, some segment starts a chain in which every number of consecutive segments differs in
no more than its share of the bits. So with 7 segments and 2 bits, three consecutive segments
are equal, six differ in at most one bit, and all in at most two. The equal part is the key
of a join; the rest of the chain and the full distance are tested on the joined pairs.

Equal fingerprints are one node before any pair is formed. A key that many different
fingerprints share is not paired: each of them is laid out with every single bit flipped,
and those that meet in one such value are within two bits of each other. No meeting place
has more than 65 members, so the work stays in proportion to the fingerprints.

Nulls: a null text is empty and has fingerprint zero; a null id stays a row, is linked like
any other and is no component's id. Repeated rows each give a row. Columns other than id and
text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_table, forget, materialize, rows_of, text_slices
from .components import connected_components

SEED = 42
BITS = 2
SEGMENTS = 7
SHINGLE = 3
# keys with more fingerprints than this are linked by flipped bits instead of pairs
CROWD = 256

_FINGERPRINTS = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.int64())])
_BYTE_BITS = np.uint64(0x0101010101010101)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit set, from the lowest bit on."""
    counts = np.zeros((8, 8), np.int64)
    starts = np.arange(0, len(hashes), 255)  # a byte holds the count of so many
    for bit in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(bit)) & _BYTE_BITS, starts)
        counts[:, bit] = sums.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0)
    return counts.ravel()


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The SimHash of word shingles, as an unsigned number."""
    counts, total, words = np.zeros(64, np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for part in text_slices(text.encode().lower()):  # bytes: A to Z only
        words = words[1 - shingle :] + part.split() if shingle > 1 else part.split()
        found = [digest(b" ".join(s), SEED) for s in zip(*(words[i:] for i in range(shingle)))]
        if found:
            counts += bit_counts(np.array(found, np.uint64))
            total += len(found)
    if not total:
        return digest(b" ".join(words), SEED) if words else 0
    return int.from_bytes(np.packbits(2 * counts > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint): the fingerprint's bits as a long."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for keys, texts in rows_of(batches, "doc_id", "text"):
            prints = np.array([fingerprint(t or "") for t in texts], np.uint64).astype(np.int64)
            yield as_table(_FINGERPRINTS, [keys, prints])

    thin = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return thin.mapInArrow(hashed, "doc_id long, fingerprint long")


def _turned(value: Column, by: int) -> Column:
    return F.shiftright(value, by) if by == 0 else F.shiftrightunsigned(value, by).bitwiseOR(F.shiftleft(value, 64 - by))


def _low_bits(count: int) -> int:
    """A mask of the lowest bits, as a signed long."""
    return -1 if count == 64 else (1 << count) - 1


def near_pairs(prints: DataFrame, bits: int = BITS, segments: int = SEGMENTS, crowd: int = CROWD) -> DataFrame:
    """(a, b) links that connect all distinct fingerprints within ``bits`` of each other.

    ``prints`` has distinct values in ``fingerprint``. Every link is within ``bits``; where
    more than ``crowd`` share a key, links to a common value stand for their pairs, which
    needs ``bits`` to be 2.
    """
    if bits != 2:
        raise ValueError("crowded keys are linked for a distance of 2 bits only")
    bounds = [64 * i // segments for i in range(segments + 1)]
    width = lambda start, length: sum(
        bounds[(start + i) % segments + 1] - bounds[(start + i) % segments] for i in range(length)
    )
    budget = {length: bits * length // segments for length in range(1, segments + 1)}
    equal = max(n for n, most in budget.items() if most == 0)
    chains = F.array(
        *[
            F.struct(
                F.lit(i).alias("chain"),
                _turned(F.col("fingerprint"), bounds[i]).bitwiseAND(F.lit(_low_bits(width(i, equal)))).alias("key"),
            )
            for i in range(segments)
        ]
    )
    keyed = prints.select("fingerprint", F.explode(chains).alias("c")).select("fingerprint", "c.*")
    shared = materialize(keyed.groupBy("chain", "key").count().filter("count > 1"), "shared-keys")
    members = materialize(keyed.join(shared, ["chain", "key"]), "members")

    few = members.filter(F.col("count") <= crowd).drop("count")
    other = few.withColumnRenamed("fingerprint", "other")
    difference = F.col("fingerprint").bitwiseXOR(F.col("other"))
    within = F.bit_count(difference) <= bits
    # of the lengths with equal budget the longest says it all
    for length in [n for n in range(equal + 1, segments) if budget[n] < budget[n + 1]]:
        for i in range(segments):
            part = _turned(difference, bounds[i]).bitwiseAND(F.lit(_low_bits(width(i, length))))
            within &= (F.col("chain") != i) | (F.bit_count(part) <= budget[length])
    pairs = few.join(other, ["chain", "key"]).filter((F.col("fingerprint") < F.col("other")) & within)
    pairs = pairs.select(F.col("fingerprint").alias("a"), F.col("other").alias("b"))

    crowded = members.filter(F.col("count") > crowd).select("fingerprint").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])
    met = (
        crowded.select("fingerprint", F.explode(flips).alias("flip"))
        .groupBy(F.col("fingerprint").bitwiseXOR(F.col("flip")).alias("place"))
        .agg(F.collect_set("fingerprint").alias("found"))  # at most 65
        .filter(F.size("found") > 1)
        .select(F.array_min("found").alias("a"), F.explode("found").alias("b"))
        .filter("a != b")
    )
    return pairs.unionByName(met)


def _grouped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, fingerprint, root, component_id): the root is a fingerprint and names one component only."""
    marked = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    prints = materialize(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = materialize(connected_components(near_pairs(prints), "a", "b"), "roots")
    least = roots.join(prints, roots["node"] == prints["fingerprint"]).groupBy("root").agg(F.min("first").alias("component"))
    named = roots.join(materialize(least, "components"), "root").select(F.col("node").alias("fingerprint"), "root", "component")
    groups = prints.join(materialize(named, "named"), "fingerprint", "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"), F.coalesce("component", "first").alias("component_id")
    )
    return marked.join(materialize(groups, "groups"), "fingerprint")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per document.

    ``component_id`` is the least id among the documents that links lead to.
    """
    return _grouped(docs, id_col, text_col).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def representatives(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component: that of its least id, then least fingerprint.

    A null id comes after all others, so a component keeps such a row only if it has no other.
    """
    groups = materialize(_grouped(docs, id_col, text_col), "grouped")
    order = F.struct(F.col("doc_id").isNull().alias("lost"), "doc_id", "fingerprint")
    best = groups.groupBy("root").agg(F.min(order).alias("best")).select(
        F.col("best.doc_id").alias("__chosen"), F.col("best.fingerprint").alias("__print")
    )
    times = groups.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("__times"))
    chosen = materialize(best.join(times, F.col("__chosen") == F.col("doc_id"), "left").drop("doc_id"), "representatives")
    key = docs[id_col].cast("long")
    once = docs.join(chosen.filter("__times = 1"), key == F.col("__chosen"), "left_semi")

    @F.pandas_udf("long")
    def printed(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t or "") for t in texts], np.uint64).astype(np.int64))

    # ids that repeat, and null ids, are told apart by their texts; these rows are staged, since Spark would
    # else hash and shuffle all texts for them: it moves the last join below the first
    repeated = materialize(chosen.filter("__times > 1").select("__chosen").distinct(), "repeated-ids")
    several = docs.join(repeated, key == F.col("__chosen"), "left_semi").unionByName(docs.filter(key.isNull()))
    several = materialize(several, "rows-of-repeated-ids")
    several = several.withColumn("__own", F.col(id_col).cast("long")).withColumn("__seen", printed(F.col(text_col).cast("string")))
    same = F.col("__own").eqNullSafe(F.col("__chosen")) & (F.col("__seen") == F.col("__print"))
    several = several.join(chosen.select("__chosen", "__print"), same, "left_semi").dropDuplicates(["__own", "__seen"])
    return once.unionByName(several.select(docs.columns))
