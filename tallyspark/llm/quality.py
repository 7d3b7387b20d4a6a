"""Quality scores by a generalised additive model with pairwise interactions.

Boosting goes round the features: each turn fits a tree of a few leaves on one feature's
bins to what is left of the labels and adds it to that feature's lookup table. Pairs of
features that explain most of the rest get tables of their own in the same way. A document's
score is the sum of the table entries of its bins, through the logistic function.

The model is fitted on at most ``SAMPLE`` labelled rows; features and scores cover whole
texts of all rows. A null text is empty; an empty text gets a score like any other. With no
labelled rows every score is 0.5. Repeated rows each give a row; a null id stays, and is not
held out. Columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_table, forget, kept_rows, materialize, remainder, rows_of
from .labelled import labelled_sample

SAMPLE = 20_000
THRESHOLD = 0.7
DIVISOR, HELD_OUT = 4, 2
BINS = 32
PAIR_BINS = 8
PAIRS = 8
ROUNDS = 120
PAIR_ROUNDS = 40
RATE = 0.1

FEATURES = (
    "log_words log_lines mean_word spread_word long_words short_words letters upper digits marks odd_marks stops "
    "pipes exclamations beyond_ascii distinct_words distinct_lines words_per_line spread_line marked_ends shouted "
    "commonest_mark"
).split()

# of a byte: 0 others, 1 small letter, 2 capital, 3 digit, 4 odd mark, 5 stop, 6 blank, 7 beyond ASCII
_CLASS = np.zeros(256, np.int64)
for _kind, _chars in enumerate(
    [
        b"abcdefghijklmnopqrstuvwxyz",
        b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        b"0123456789",
        b"|#$%&*@^~=+<>{}[]\\/_",
        b".,;:?!",
        b" \t\n\v\f\r",
    ],
    1,
):
    _CLASS[list(_chars)] = _kind
_CLASS[128:] = 7
_MARK = np.flatnonzero(np.isin(_CLASS, (0, 4, 5)))
_SLICE = 1 << 22


def text_features(text: str | None) -> list[float]:
    """The features of a whole text; shares are of its bytes, words or lines."""
    data = (text or "").encode()
    counts = np.zeros(256, np.int64)
    for start in range(0, len(data), _SLICE):
        counts += np.bincount(np.frombuffer(data[start : start + _SLICE], np.uint8), minlength=256)
    words, lines = data.split(), [x for x in data.split(b"\n") if x.strip()]
    sizes, rows = np.array([len(w) for w in words] or [0]), np.array([len(x) for x in lines] or [0])
    kinds = np.bincount(_CLASS, counts, 8)
    size, n, m = max(1, len(data)), max(1, len(words)), max(1, len(lines))
    letters = max(1.0, kinds[1] + kinds[2])
    seen = set(words)
    marks = counts[_MARK]
    final = np.array([_CLASS[w[-1]] for w in words] or [0])
    return [
        np.log1p(len(words)),
        np.log1p(len(lines)),
        sizes.mean(),
        sizes.std(),
        (sizes > 12).mean(),
        (sizes < 4).mean(),
        (kinds[1] + kinds[2] + kinds[7]) / size,
        kinds[2] / letters,
        kinds[3] / size,
        marks.sum() / size,
        kinds[4] / size,
        kinds[5] / size,
        counts[124] / n,
        counts[33] / n,
        kinds[7] / size,
        len(seen) / n,
        len(set(lines)) / m,
        len(words) / m,
        rows.std() / (1 + rows.mean()),
        ((final == 4) | (final == 0)).mean(),
        sum(map(bytes.isupper, words)) / n,
        marks.max() / n,
    ]


@dataclass
class AdditiveModel:
    """Lookup tables of features and of pairs of features."""

    start: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.cuts[j], x[:, j], side="right")]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            a, b = (np.searchsorted(self.pair_cuts[k], x[:, k], side="right") for k in (i, j))
            total += table[a, b]
        return _logistic(total)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """Inner edges between bins of about equal counts."""
    edges = np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1], method="inverted_cdf"))
    return edges[edges > values.min()]


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best split of bins with gradients g and weights h."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    gain = left_g**2 / (left_h + 1) + right_g**2 / (right_h + 1) - g.sum() ** 2 / (h.sum() + 1)
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Leaf values of a shallow tree over ordered bins, best split first."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        splits = [(*_best_cut(g[a:b], h[a:b]), k) for k, (a, b) in enumerate(parts)]
        gain, at, k = max(splits)
        if gain <= 1e-12:
            break
        a, b = parts[k]
        parts[k : k + 1] = [(a, a + at), (a + at, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + 1)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """One split of the rows of a grid, then one of the columns on each side."""
    _, at = _best_cut(g.sum(axis=1), h.sum(axis=1))
    out = np.zeros(g.shape)
    for rows in (slice(0, at), slice(at, None)):
        if g[rows].size:
            out[rows] = _tree(g[rows].sum(axis=0), h[rows].sum(axis=0), leaves=2)
    return out


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    model = AdditiveModel(float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))))
    if not len(y):
        return model
    count = x.shape[1]
    model.cuts = [_cuts(x[:, j], BINS) for j in range(count)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    bins = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(model.cuts)]
    total = np.full(len(y), model.start)
    for _ in range(ROUNDS):
        for j in range(count):
            p = _logistic(total)
            size = len(model.tables[j])
            step = RATE * _tree(np.bincount(bins[j], y - p, size), np.bincount(bins[j], p * (1 - p), size))
            model.tables[j] += step
            total += step[bins[j]]
    model.pair_cuts = [_cuts(x[:, j], PAIR_BINS) for j in range(count)]
    coarse = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(model.pair_cuts)]

    def grid(i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        p = _logistic(total)
        shape = len(model.pair_cuts[i]) + 1, len(model.pair_cuts[j]) + 1
        cell = coarse[i] * shape[1] + coarse[j]
        sums = [np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in (y - p, p * (1 - p))]
        return (*sums, cell)

    def gain(pair: tuple[int, int]) -> float:
        g, h, _ = grid(*pair)
        return float((g**2 / (h + 1)).sum())

    model.pairs = sorted(combinations(range(count), 2), key=gain, reverse=True)[:PAIRS]
    model.pair_tables = [np.zeros((len(model.pair_cuts[i]) + 1, len(model.pair_cuts[j]) + 1)) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for table, pair in zip(model.pair_tables, model.pairs):
            g, h, cell = grid(*pair)
            step = RATE * _pair_tree(g, h)
            table += step
            total += step.ravel()[cell]
    return model


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x): the features of every text."""
    schema = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float64()))])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for keys, texts in rows_of(batches, "doc_id", "text"):
            yield as_table(schema, [keys, [text_features(t) for t in texts]])

    thin = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return thin.mapInArrow(measure, "doc_id long, x array<double>")


def fit_on(measured: DataFrame, known: DataFrame) -> AdditiveModel:
    """The model of labelled rows; of an id that repeats, the row of the least features counts."""
    rows = measured.join(F.broadcast(known), "doc_id").groupBy("doc_id", "y").agg(F.min("x").alias("x"))  # a bounded sample
    found = rows.orderBy("doc_id").select("x", "y").collect()
    return fit(np.array([r["x"] for r in found], float).reshape(-1, len(FEATURES)), np.array([r["y"] for r in found], float))


def _sample(labels: DataFrame, id_col: str) -> DataFrame:
    return labelled_sample(labels, "quality", DIVISOR, HELD_OUT, SAMPLE, id_col)


def _scored(x: pd.Series, model: AdditiveModel) -> pd.Series:
    return pd.Series(model.score(np.array(x.to_list(), float).reshape(-1, len(FEATURES))))


def quality_scores(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted): one row per document; a high score is good."""
    measured = materialize(features(docs, id_col, text_col), "features")
    model = docs.sparkSession.sparkContext.broadcast(fit_on(measured, _sample(labels, id_col)))  # a few thousand numbers

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return _scored(x, model.value)

    return measured.select("doc_id", score("x").alias("score")).select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), DIVISOR) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def good_rows(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose texts score at least the threshold.

    Only the labelled sample is measured to fit the model; then every text is measured once.
    """
    known = _sample(labels, id_col)
    own = docs.join(F.broadcast(known.select(F.col("doc_id").alias("__known"))), F.col(id_col).cast("long") == F.col("__known"), "left_semi")
    model = docs.sparkSession.sparkContext.broadcast(fit_on(features(own, id_col, text_col), known))

    def good(texts: list[str | None]) -> list[bool]:
        return (model.value.score(np.array([text_features(t) for t in texts]).reshape(-1, len(FEATURES))) >= THRESHOLD).tolist()

    return kept_rows(docs, text_col, good)
