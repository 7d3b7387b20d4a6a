"""Removal of word passages that another document has already.

A window of ``window`` consecutive words is repeated if a document with a smaller id has the
same words in a row. Windows are found level by level: a window can only be repeated if the
windows of ``base`` words in it are, so those are counted first, and only windows around
repeated ones are extended to twice that length, up to ``window``, and counted again. Of the
short windows in a long one, the one with the least hash stands for it, the same in every
document, so a fraction of the short windows is counted.

Windows are 64-bit hashes of their words' hashes, and 96 bits at the last level. Copies of a whole
text are found by its digest; they need no windows.

Nulls: a null text is empty. A row with a null id loses nothing and takes nothing away.
Rows with one id are one document's: none removes words of another. Empty tables give empty
results. Columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_table, light_after, materialize, on_worker, rows_of, text_slices

WINDOW = 13
BATCH_BYTES = 1 << 19

# hashes of words are polynomials modulo a prime, so that no two words collide for every base
_PRIME = (1 << 31) - 1
_BASES = (0x2545F491, 0x5851F42D)
# a window's hash mixes those of its halves; the second row is for the check
_MIX = (
    (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93),
    (0xD1342543DE82EF95, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB),
)


def _folded(x: np.ndarray) -> np.ndarray:
    """Modulo the prime, which may itself stand for zero; ``x`` is changed."""
    for _ in range(2):
        high = x >> np.uint64(31)
        x &= np.uint64(_PRIME)
        x += high
    return x


class _Powers:
    """Powers of a base and of its inverse modulo the prime, as far as texts need them."""

    def __init__(self, base: int):
        self.steps = base, pow(base, -1, _PRIME)
        # one random number for each byte
        self.bytes = np.random.default_rng(base).integers(1, _PRIME, 256, np.uint64)
        self.tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def upto(self, count: int) -> list[np.ndarray]:
        while len(self.tables[0]) < count:
            for i, step in enumerate(self.steps):
                known = self.tables[i]
                self.tables[i] = np.concatenate([known, _folded(known * np.uint64(pow(step, len(known), _PRIME)))])
        return self.tables


def _powers(which: int) -> _Powers:
    return on_worker("powers", lambda: [_Powers(base) for base in _BASES])[which]


def _mixed(a: np.ndarray, b: np.ndarray, which: int) -> np.ndarray:
    """A hash of two hashes in order, which is no polynomial of them."""
    k, m, n = (np.uint64(x) for x in _MIX[which])
    h = a * k
    h ^= (b << np.uint64(29)) | (b >> np.uint64(35))
    h *= m
    h ^= h >> np.uint64(32)
    h *= n
    h ^= h >> np.uint64(29)
    return h


class Passage:
    """The words of several text segments in a row, with hashes of the windows inside each."""

    def __init__(self, segments: list[list[bytes]]):
        self.lengths = np.array([len(s) for s in segments], np.int64)
        self.owner = np.repeat(np.arange(len(segments)), self.lengths)
        # for each word, how many words its segment has from it on
        last = np.cumsum(self.lengths)
        self.left = np.repeat(last, self.lengths) - np.arange(len(self.owner))
        data = b" ".join([w for s in segments for w in s])
        self.bytes = np.frombuffer(data, np.uint8)
        blanks = np.flatnonzero(self.bytes == 32)
        self.starts = np.r_[0, blanks + 1] if data else np.zeros(0, np.int64)
        self.ends = np.r_[blanks, len(data)] if data else np.zeros(0, np.int64)
        self._words: np.ndarray | None = None

    def words(self) -> np.ndarray:
        """The hash of each word, of 62 bits."""
        if self._words is None:
            found = np.zeros(len(self.starts), np.uint64)
            for which in range(2):
                powers = _powers(which)
                forth, back = powers.upto(len(self.bytes) + 1)
                terms = powers.bytes[self.bytes]
                terms *= forth[: len(self.bytes)]
                prefix = np.r_[np.uint64(0), np.cumsum(_folded(terms))]  # below 2^31 times the bytes
                own = _folded(prefix[self.ends] - prefix[self.starts])
                own = _folded(own * back[self.starts])
                own[own == _PRIME] = 0
                found = found << np.uint64(31) | own
            self._words = found
        return self._words

    def hashes(self, words: int, which: int = 0) -> np.ndarray:
        """The hash of each window of so many words, those across segments included.

        Windows are doubled from one word on; the last two halves may overlap.
        """
        h = self.words()
        if words > len(h):
            return h[:0]
        h = _mixed(h, np.full(1, words, np.uint64), which)
        reach = 1
        while reach < words:
            step = min(reach, words - reach)
            h = _mixed(h[:-step], h[step:], which)
            reach += step
        return h

    def inside(self, words: int) -> np.ndarray:
        """Which windows of so many words lie in one segment."""
        return (self.left >= words)[: max(0, len(self.left) - words + 1)]

    def standing(self, window: int, base: int) -> np.ndarray:
        """For each window the least hash of the windows of ``base`` words in it."""
        h, reach, need = self.hashes(base), 1, window - base + 1
        while reach < need and len(h):
            step = min(reach, need - reach)
            h = np.minimum(h[:-step], h[step:]) if len(h) > step else h[:0]
            reach += step
        return h


def segments_of(text: str | None, overlap: int) -> Iterator[list[bytes]]:
    """The words of a text in bounded segments; each repeats the last ``overlap`` words before it."""
    words: list[bytes] = []
    for part in text_slices((text or "").encode(), BATCH_BYTES):
        words = (words[-overlap:] if overlap else []) + part.split()
        yield words


def passages(keys: list, texts: list[str | None], overlap: int) -> Iterator[tuple[list[int], Passage]]:
    """The texts in passages of bounded size, with the row of each segment."""
    rows: list[int] = []
    segments: list[list[bytes]] = []
    held = 0
    for row, text in enumerate(texts):
        for words in segments_of(text, overlap):
            rows.append(row)
            segments.append(words)
            held += min(len(text), BATCH_BYTES)
            if held >= BATCH_BYTES:
                yield rows, Passage(segments)
                rows, segments, held = [], [], 0
    if rows:
        yield rows, Passage(segments)


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def _anchors(docs: DataFrame, window: int, base: int) -> DataFrame:
    """(h, doc_id): the short windows that stand for a document's long ones."""
    schema = pa.schema([("h", pa.int64()), ("doc_id", pa.int64())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in rows_of(batches, "doc_id", "text"):
            ids = np.array(keys, np.int64)
            for rows, passage in passages(keys, texts, window - 1):
                at = np.flatnonzero(passage.inside(window))
                h = passage.standing(window, base)[at]
                owner = passage.owner[at]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
                yield as_table(schema, [_signed(h[new]), ids[np.array(rows)[owner[new]]]])

    return docs.mapInArrow(light_after(find), "h long, doc_id long")


def _around(docs: DataFrame, window: int, base: int) -> DataFrame:
    """(h, check, doc_id, asks): the windows whose standing short window is in ``anchors``.

    A window ``asks`` if its short window is in ``later`` too: another document had that first.
    """
    schema = pa.schema([("h", pa.int64()), ("check", pa.int32()), ("doc_id", pa.int64()), ("asks", pa.bool_())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                keys, texts = part.column("doc_id").to_pylist(), part.column("text").to_pylist()
                ids = np.array(keys, np.int64)
                wanted, later = ([np.sort(np.asarray(a.values)) for a in part.column(c)] for c in ("anchors", "later"))
                for rows, passage in passages(keys, texts, window - 1):
                    standing = _signed(passage.standing(window, base))
                    keep, asks = passage.inside(window), np.zeros(len(standing), bool)
                    firsts = np.r_[0, np.cumsum(passage.lengths)]
                    for i, row in enumerate(rows):
                        own = slice(firsts[i], min(firsts[i + 1], len(keep)))
                        keep[own] &= _among(standing[own], wanted[row])
                        asks[own] = _among(standing[own], later[row])
                    at = np.flatnonzero(keep)
                    columns = [
                        _signed(passage.hashes(window)[at]),
                        passage.hashes(window, 1)[at].astype(np.uint32).view(np.int32),
                        ids[np.array(rows)[passage.owner[at]]],
                        asks[at],
                    ]
                    yield as_table(schema, columns)

    return docs.mapInArrow(light_after(find), "h long, check int, doc_id long, asks boolean")


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _whole_copies(known: DataFrame) -> DataFrame:
    """(doc_id): documents whose whole text a document with a smaller id has."""
    digests = materialize(
        known.groupBy("doc_id")
        .agg(F.count("*").alias("rows"), F.min(F.md5("text")).alias("digest"))
        .filter("rows = 1")
        .drop("rows"),
        "digests",
    )
    firsts = digests.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows"))
    firsts = materialize(firsts.filter("rows > 1").drop("rows"), "first-copies")
    return materialize(digests.join(firsts, "digest").filter("first < doc_id").select("doc_id"), "copies")


def repeated_windows(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, windows): hashes of the windows that a document with a smaller id has too.

    ``texts`` has doc_id and text. For a copy of a whole text all windows are repeated, and
    ``windows`` is empty.
    """
    base = window // 2 + 1
    known = texts.filter("doc_id is not null and text is not null")

    def shared(found: DataFrame, *key: str) -> DataFrame:
        """Keys that occur in several documents, with the least id."""
        ends = found.groupBy(*key).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        return ends.filter("first < last").drop("last")

    copies = _whole_copies(known)
    anchors = _anchors(known, window, base)
    short = materialize(shared(anchors, "h"), "short-windows")
    candidates = (
        anchors.join(short, "h")
        .groupBy("doc_id")
        .agg(F.collect_set("h").alias("anchors"), F.collect_set(F.when(F.col("first") < F.col("doc_id"), F.col("h"))).alias("later"))
        .join(copies, "doc_id", "left_anti")
    )
    windows = materialize(_around(known.join(candidates, "doc_id"), window, base), "windows")
    long = materialize(shared(windows, "h", "check"), "long-windows")
    found = (
        windows.filter("asks")
        .join(long, ["h", "check"])
        .filter("first < doc_id")
        .groupBy("doc_id")
        .agg(F.collect_set("h").alias("windows"))
    )
    return found.unionByName(copies.withColumn("windows", F.array().cast("array<long>")))


def _with_stripped(docs: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with a column ``__stripped`` of (n_words, n_removed, kept)."""

    def strip_all(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for text, windows in batches:
            rows = [
                stripped(t, None if w is None else np.sort(np.asarray(w, np.int64)), window) for t, w in zip(text, windows)
            ]
            yield pd.DataFrame(rows, columns=["n_words", "n_removed", "kept"])

    @F.pandas_udf("n_words long, n_removed long, kept string")
    def strip(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        return light_after(strip_all)(batches)

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = repeated_windows(texts, window).select(F.col("doc_id").alias("__id"), F.col("windows").alias("__windows"))
    joined = docs.join(found, docs[id_col].cast("long") == found["__id"], "left")
    return joined.select(*[docs[c] for c in docs.columns], strip(docs[text_col].cast("string"), "__windows").alias("__stripped"))


def without_repeats(docs: DataFrame, *, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each text without the words of repeated windows.

    ``kept`` has the other words, joined by single spaces. Windows are judged on the input.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return _with_stripped(texts, window, "doc_id", "text").select("doc_id", "__stripped.*")


def strip_repeats(docs: DataFrame, *, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated passages taken out of the texts; other texts stay as they are."""
    changed = F.col("__stripped.n_removed") > 0
    return (
        _with_stripped(docs, window, id_col, text_col)
        .withColumn(text_col, F.when(changed, F.col("__stripped.kept")).otherwise(F.col(text_col)))
        .select(docs.columns)
    )


def stripped(text: str | None, windows: np.ndarray | None, window: int) -> tuple[int, int, str]:
    """(words, removed words, kept text) of one document, given the hashes of its repeated windows.

    None stands for no window, and an empty array for all.
    """
    total = removed = 0
    kept: list[bytes] = []
    if windows is not None and not len(windows):
        total = sum(map(len, segments_of(text, 0)))
        if total >= window:
            return total, total, ""
        windows = None
    if windows is None:
        total = 0
        for words in segments_of(text, 0):
            total += len(words)
            kept += [b" ".join(words)] if words else []
        return total, 0, b" ".join(kept).decode()
    carried = np.zeros(0, bool)  # which of the repeated words at a segment's start are covered
    segments = segments_of(text, window - 1)
    words = next(segments, None)
    while words is not None:
        covered = np.zeros(len(words), bool)
        covered[: len(carried)] = carried
        hits = np.flatnonzero(_among(_signed(Passage([words]).hashes(window)), windows))
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, hits, 1)
        np.add.at(change, hits + window, -1)
        covered |= np.cumsum(change[:-1]) > 0
        following = next(segments, None)
        done = len(words) if following is None else max(0, len(words) - (window - 1))
        total += done
        removed += int(covered[:done].sum())
        kept += [w for w, gone in zip(words[:done], covered[:done].tolist()) if not gone]
        carried, words = covered[done:], following
    return total, removed, b" ".join(kept).decode()
