"""Toxicity scores by weak supervision.

Voters are word beginnings and whole words that stand out in toxic rows, however rare, chosen in
layers so that each adds toxic rows its layer lacks, and two patterns of style. A generative model with a hidden
class, fitted by expectation maximisation, estimates how often each voter fires in either
class, and from the correlations of the voters within a class how much of a vote is its own.
Its posteriors are the labels on which the linear classifier is trained that scores texts.

Voters and classifier are fitted on at most ``SAMPLE`` labelled rows; votes and scores cover
whole texts of all rows. A null text is empty; an empty text gets a score like any other.
With no toxic rows to learn from no voter stands out, and all texts score low. Repeated rows
each give a row; a null id stays, and is not held out. Columns other than id and text are
ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_table, forget, kept_rows, materialize, remainder, rows_of
from .labelled import labelled_sample

SAMPLE = 20_000
THRESHOLD = 0.7
DIVISOR, HELD_OUT = 3, 1
# beginnings of words of these lengths are looked at, and whole words
BEGINNINGS = range(3, 9)
VOTERS = 256
LAYERS = 8
# a voter must be in, and add, so many toxic rows, however many there are
LEAST_ROWS = 3
# standard errors of the lower bound of its precision, which must exceed the share of toxic rows
ERRORS = 1.96
# a voter's share of toxic rows, weighing both classes alike
PRECISION = 0.998
WHOLE = "$"
# patterns a task counts before it passes the counts on
HELD_PATTERNS = 100_000

_WORDS = re.compile(r"[^\W\d_]+")


def _patterns(text: str) -> set[str]:
    words = set(_WORDS.findall(text.lower()))
    return {w[:n] for n in BEGINNINGS for w in words if len(w) >= n} | {w + WHOLE for w in words}


class Lexicon:
    """Finds which of a list of patterns begin, or are, words of a text."""

    def __init__(self, patterns: list[str]):
        self.automaton = ahocorasick.Automaton()
        by_text: dict[str, list[tuple[int, bool]]] = {}
        for i, p in enumerate(patterns):
            by_text.setdefault(p.removesuffix(WHOLE), []).append((i, p.endswith(WHOLE)))
        for text, found in by_text.items():
            self.automaton.add_word(text, (len(text), found))
        if by_text:
            self.automaton.make_automaton()

    def found(self, text: str | None) -> set[int]:
        """The patterns that occur in a text, by their index."""
        found: set[int] = set()
        if not len(self.automaton):
            return found
        text = (text or "").lower()
        for end, (size, patterns) in self.automaton.iter(text):
            start = end + 1 - size
            if start and _is_letter(text[start - 1]):
                continue
            whole = end + 1 == len(text) or not _is_letter(text[end + 1])
            found.update(i for i, only_whole in patterns if whole or not only_whole)
        return found


def _is_letter(char: str) -> bool:
    return _WORDS.match(char) is not None


def _style(text: str | None) -> list[bool]:
    """Many exclamations; nothing but capitals."""
    text = text or ""
    return [50 * text.count("!") > len(text), text.isupper()]


class ToxicityModel:
    def __init__(self, patterns: list[str], weights: np.ndarray, start: float):
        self.patterns, self.weights, self.start = patterns, weights, start
        self._lexicon: Lexicon | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_lexicon": None}

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self._lexicon is None:
            self._lexicon = Lexicon(self.patterns)
        x = np.array([features(t, self._lexicon, len(self.patterns)) for t in texts]).reshape(-1, len(self.weights))
        return _logistic(x @ self.weights + self.start)


def features(text: str | None, lexicon: Lexicon, count: int) -> np.ndarray:
    """Votes of the lexicon and style voters."""
    x = np.zeros(count + 2)
    x[list(lexicon.found(text))] = 1
    x[count:] = _style(text)
    return x


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def label_model(votes: np.ndarray, prior: float, first: np.ndarray, rounds: int = 4):
    """Posterior of the hidden class given 0/1 votes, and what one vote alone says.

    A 0 is to abstain.

    Starts from ``first``, the labels at hand, and keeps near them: few rounds. Votes that go
    together within a class count for less: a vote's weight is one over the sum of its
    notable correlations with the votes of its row. That all voters abstain is evidence too,
    as one event.
    """
    none = ~votes.any(axis=1)
    posterior = first.astype(float)
    for _ in range(rounds):
        on, off = posterior, 1 - posterior
        rate_on = (votes.T @ on + 0.5) / (on.sum() + 1)
        rate_off = (votes.T @ off + 0.5) / (off.sum() + 1)
        rest = votes - on[:, None] * rate_on - off[:, None] * rate_off
        cover = rest.T @ rest / max(1, len(votes))
        spread = np.sqrt(np.maximum(np.diag(cover), 1e-12))
        together = cover / spread[:, None] / spread[None, :]
        echoes = np.maximum(votes @ np.where(together > 0.2, together, 0), 1)
        silence = np.log((none @ on + 0.5) / (on.sum() + 1)) - np.log((none @ off + 0.5) / (off.sum() + 1))
        logit = np.log(prior / (1 - prior)) + (votes / echoes) @ np.log(rate_on / rate_off) + none * silence
        posterior = _logistic(logit)
    return posterior, np.log(rate_on / rate_off) - silence


def fit_linear(
    x: np.ndarray, target: np.ndarray, near: np.ndarray, ridge: float = 0.1, rounds: int = 30
) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by Newton steps, with weights drawn to ``near``."""
    x = np.hstack([x, np.ones((len(x), 1))])
    near = np.append(near, 0.0)
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-3
    for _ in range(rounds):
        p = _logistic(x @ w)
        slope = x.T @ (target - p) - penalty * (w - near)
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        w += np.linalg.solve(bend, slope)
    return w[:-1], float(w[-1])


def _choose(hits: list[list[int]], y: np.ndarray, patterns: list[str]) -> list[int]:
    """Patterns that cover the toxic rows, in layers: each adds the most rows its layer lacks.

    Of patterns that begin each other only one is chosen, the longest that has nearly all
    rows of the shortest.
    """
    rows: list[set[int]] = [set() for _ in patterns]
    for row in np.flatnonzero(y):
        for i in hits[row]:
            rows[i].add(int(row))
    open_ = set(range(len(patterns)))
    chosen: list[int] = []
    for _ in range(LAYERS):
        covered: set[int] = set()
        while open_ and len(chosen) < VOTERS:
            gain, best = max((len(rows[i] - covered), -i) for i in open_)
            if gain < LEAST_ROWS:
                break
            best = -best
            longer = [i for i in open_ if patterns[i].startswith(patterns[best]) and len(rows[i]) >= 0.97 * len(rows[best])]
            best = max(longer, key=lambda i: (len(patterns[i]), -i))
            chosen.append(best)
            covered |= rows[best]
            stem = patterns[best].removesuffix(WHOLE)
            open_ -= {i for i in open_ if patterns[i].startswith(stem) or stem.startswith(patterns[i].removesuffix(WHOLE))}
    return chosen


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> ToxicityModel:
    """Voters, label model and classifier from at most ``sample`` labelled rows."""
    known = labelled_sample(labels, "toxic", DIVISOR, HELD_OUT, sample, id_col)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = materialize(texts.join(F.broadcast(known), "doc_id").dropDuplicates(["text"]), "labelled")  # copies say nothing more
    sizes = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    shortlist: list[str] = []
    if toxic:
        often = _document_counts(rows.filter("y = 1")).filter(F.col("rows") >= LEAST_ROWS)
        elsewhere = _document_counts(rows.filter("y = 0")).withColumnRenamed("rows", "others")
        n, m = F.col("rows"), F.coalesce("others", F.lit(0))
        precise = n / toxic / (n / toxic + m / max(1, clean)) >= PRECISION
        sure = _lower_bound(n, m) > toxic / (toxic + clean) if clean else F.lit(True)
        # a pattern is in a row or more of the bounded sample
        passed = often.join(elsewhere, "pattern", "left").filter(precise & sure).orderBy(F.desc("rows"), "pattern")
        shortlist = [r["pattern"] for r in passed.select("pattern", "rows").collect()]
    found = _hits(rows, shortlist).orderBy("doc_id").collect()
    y = np.array([r["y"] for r in found], int)
    chosen = _choose([r["hits"] for r in found], y, shortlist)
    place = {i: k for k, i in enumerate(chosen)}
    votes = np.zeros((len(found), len(chosen) + 2))
    for row, r in enumerate(found):
        votes[row, [place[i] for i in r["hits"] if i in place]] = 1
        votes[row, len(chosen) :] = r["style"]
    posterior, alone = label_model(votes, (toxic + 1) / (toxic + clean + 2), y)
    weights, start = fit_linear(votes, posterior, alone)
    return ToxicityModel([shortlist[i] for i in chosen], weights, start)


def _lower_bound(n: Column, m: Column) -> Column:
    """Wilson's lower bound of n / (n + m)."""
    z = ERRORS**2
    return (n + z / 2 - ERRORS * F.sqrt(n * m / (n + m) + z / 4)) / (n + m + z)


def _document_counts(rows: DataFrame) -> DataFrame:
    """(pattern, rows): in how many texts a pattern occurs."""
    schema = pa.schema([("pattern", pa.string()), ("rows", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        forget()
        for (texts,) in rows_of(batches, "text", chunk=32):
            for text in texts:
                total.update(_patterns(text or ""))
            if len(total) > HELD_PATTERNS:
                yield as_table(schema, [list(total), list(total.values())])
                total.clear()
        yield as_table(schema, [list(total), list(total.values())])

    return rows.mapInArrow(count, "pattern string, rows long").groupBy("pattern").agg(F.sum("rows").alias("rows"))


def _hits(rows: DataFrame, patterns: list[str]) -> DataFrame:
    """(doc_id, y, hits, style): which patterns occur in each text."""
    kinds = {"doc_id": pa.int64(), "y": pa.int32(), "hits": pa.list_(pa.int32()), "style": pa.list_(pa.bool_())}
    schema = pa.schema(list(kinds.items()))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(patterns)
        for keys, labels, texts in rows_of(batches, "doc_id", "y", "text"):
            yield as_table(schema, [keys, labels, [list(lexicon.found(t)) for t in texts], [_style(t) for t in texts]])

    return rows.mapInArrow(find, "doc_id long, y int, hits array<int>, style array<boolean>")


def _score_column(docs: DataFrame, model: ToxicityModel, text_col: str) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most VOTERS patterns

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(text.tolist()))

    return score(F.col(text_col).cast("string"))


def toxicity_scores(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted): one row per document; a high score is toxic."""
    score = _score_column(docs, fit(docs, labels, id_col, text_col), text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), score.alias("score")).select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), DIVISOR) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def clean_rows(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose texts score below the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col))
    return kept_rows(docs, text_col, lambda texts: (shared.value.score(texts) < THRESHOLD).tolist())
