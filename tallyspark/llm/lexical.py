"""Exact ranked search by terms, best document interval first.

Documents are dealt into blocks, in each of which the documents stand by length. A block has a
posting list (document, impact) for each term that an item asks for, and over each list a
sparse table that gives the document of most impact in any range. For an item, the sum of its
terms' maxima over an interval of documents bounds every score in it. The interval with the
best bound is taken first and split at the document of most impact, whose exact score is
then known; the two sides get bounds of their own. An interval whose bound is below the
item's bar, the k-th best score known, is done with.

Two passes: in the first every block takes few intervals, and the best of all blocks give each
item a bar that the second pass starts from. Frequencies, lengths and document counts cover
all documents. Items are taken in blocks of a bounded number of terms, so what is sent to the
tasks is bounded: the words and bars of one such block (an item is never divided).

Terms are runs of ASCII letters, digits and all characters beyond ASCII; A to Z are lower-cased.
Nulls: a null text has no terms. A null document id can be ranked and comes after others of
its score; a null item id is an item. Repeated documents are documents of their own. Rows of
one item id are one item with the terms of all of them. Empty tables give empty results.
Columns other than id and text are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import as_table, materialize, rows_of, text_slices

# documents and postings of a block, about
BLOCK, BLOCK_POSTINGS = 4096, 400_000
# terms of the items that are taken together, repeats among items included
ITEM_TERMS = 1 << 17
# intervals of each item that are split at once, and how often in the first pass
SPLITS, FIRST_ROUNDS = 4, 6
# items times terms that are searched together in a block
TOGETHER = 1 << 13

_TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def terms_of(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a whole text, slice by slice."""
    for part in text_slices((text or "").encode().translate(_TERM_BYTES)):
        yield part.split()


def _item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item_id, term): the different terms of each item."""
    schema = pa.schema([("item_id", pa.int64()), ("term", pa.binary())])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in rows_of(batches, "item_id", "text"):
            for key, text in zip(keys, texts):
                for words in terms_of(text):
                    found = list(set(words))
                    yield as_table(schema, [[key] * len(found), found])

    thin = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    return thin.mapInArrow(split, "item_id long, term binary").distinct()


def _postings(docs: DataFrame, places: dict[bytes, int]) -> DataFrame:
    """(row, doc_id, n, terms, times): how often each term of ``places`` is in each document with terms."""
    shared = docs.sparkSession.sparkContext.broadcast(places)
    kinds = {"row": pa.int64(), "doc_id": pa.int64(), "n": pa.int64(), "terms": pa.list_(pa.int32()), "times": pa.list_(pa.int64())}
    schema = pa.schema(list(kinds.items()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = shared.value
        row = TaskContext.get().partitionId() << 40
        for keys, texts in rows_of(batches, "doc_id", "text"):
            out = []
            for key, text in zip(keys, texts):
                found: Counter[int] = Counter()
                n = 0
                for words in terms_of(text):
                    n += len(words)
                    for word, times in Counter(words).items():
                        if word in place:
                            found[place[word]] += times
                if n:
                    out.append((row, key, n, list(found), list(found.values())))
                    row += 1
            if out:
                yield as_table(schema, list(zip(*out)))

    return docs.mapInArrow(count, "row long, doc_id long, n long, terms array<int>, times array<long>")


class Block:
    """Posting lists of a block of documents, with a sparse table of maxima over each.

    Postings are (document place, term, impact); documents have places from 0 on.
    """

    def __init__(self, place: np.ndarray, term: np.ndarray, impact: np.ndarray, documents: int, terms: int):
        order = np.lexsort((place, term))
        self.place, self.impact = place[order], impact[order]
        term = term[order]
        self.documents = documents
        self.scored = 0  # documents whose score was worked out, for all items
        self.key = term * (documents + 1) + self.place
        self.first = np.searchsorted(term, np.arange(terms + 1))
        # the place of the maximum of 1, 2, 4 ... postings from each on; ranges asked for lie in one list
        levels = [np.arange(len(term), dtype=np.int32)]
        longest, reach = int(np.diff(self.first).max(initial=0)), 1
        while 2 * reach <= longest:
            a, b = levels[-1][:-reach], levels[-1][reach:]
            levels.append(np.where(self.impact[b] > self.impact[a], b, a))
            reach *= 2
        self.starts = np.cumsum([0] + [len(x) for x in levels])
        self.table = np.concatenate(levels)
        self.log = np.zeros(longest + 1, np.int64)
        for size in range(2, longest + 1):
            self.log[size] = self.log[size // 2] + 1

    def bounds(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For rows of posting ranges the sum of their maxima, and the document of most impact."""
        there = b > a
        lower, size = np.where(there, a, 0), np.where(there, b - a, 1)
        level = self.log[size]
        x = self.table[self.starts[level] + lower]
        y = self.table[self.starts[level] + lower + size - (1 << level)]
        at = np.where(self.impact[y] > self.impact[x], y, x)
        most = np.where(there, self.impact[at], 0)
        best = at[np.arange(len(at)), most.argmax(axis=1)]
        return most.sum(axis=1), self.place[best]

    def search(self, wanted: list[np.ndarray], bars: np.ndarray, k: int, rounds: int | None = None) -> Iterator[tuple]:
        """(item, document place, score) arrays with the k best of each item at or above its bar, and maybe more.

        ``wanted`` has the terms of each item. With ``rounds`` the search ends early: scores are
        exact, but better documents may be missing.
        """
        if not len(self.place):
            return
        own = [t[self.first[t + 1] > self.first[t]] for t in wanted]  # terms that occur here
        order = np.argsort([len(t) for t in own], kind="stable")
        at = 0
        while at < len(order):
            upto = at + 1
            while upto < len(order) and (upto + 1 - at) * len(own[order[upto]]) <= TOGETHER:
                upto += 1
            group = order[at:upto]
            at = upto
            width = len(own[group[-1]])
            if width:
                item, place, score = self._search([own[i] for i in group], width, bars[group], k, rounds)
                yield group[item], place, score

    def _search(self, own: list[np.ndarray], width: int, bars: np.ndarray, k: int, rounds: int | None) -> tuple:
        a, b = (np.zeros((len(own), width), np.int32) for _ in range(2))
        for i, t in enumerate(own):
            a[i, : len(t)], b[i, : len(t)] = self.first[t], self.first[t + 1]
        # the key before the document's place, for each item and term
        base = np.zeros((len(own), width), np.int64)
        for i, t in enumerate(own):
            base[i, : len(t)] = t * (self.documents + 1)
        item = np.arange(len(own))
        bound, split = self.bounds(a, b)
        bars = np.maximum(bars, 1)
        top = np.zeros((len(own), k), np.int64)
        found: list[tuple] = []
        last = len(self.key) - 1
        while len(item) and rounds != 0:
            rounds = rounds if rounds is None else rounds - 1
            live = np.flatnonzero(bound >= bars[item])
            live = live[np.lexsort((-bound[live], item[live]))]
            begins = np.r_[True, item[live][1:] != item[live][:-1]] if len(live) else np.zeros(0, bool)
            start = np.flatnonzero(begins)
            rank = np.arange(len(live)) - np.repeat(start, np.diff(np.r_[start, len(live)]))
            now, rest = live[rank < SPLITS], live[rank >= SPLITS]
            who, lower, upper, place = item[now], a[now], b[now], split[now]
            at = np.clip(np.searchsorted(self.key, base[who] + place[:, None]), lower, upper).astype(np.int32)
            hit = (at < upper) & (self.place[np.minimum(at, last)] == place[:, None])
            score = np.where(hit, self.impact[np.minimum(at, last)], 0).sum(axis=1)
            self.scored += len(now)
            good = score >= bars[who]
            found.append((who[good], place[good], score[good]))
            fresh = np.zeros((len(own), SPLITS), np.int64)
            fresh[who, rank[rank < SPLITS]] = score
            top = -np.sort(-np.hstack([top, fresh]), axis=1)[:, :k]
            bars = np.maximum(bars, top[:, -1])
            a_new, b_new, who = np.concatenate([lower, at + hit]), np.concatenate([at, upper]), np.r_[who, who]
            if len(who):
                bound_new, split_new = self.bounds(a_new, b_new)
                keep = bound_new >= bars[who]
                item = np.r_[item[rest], who[keep]]
                a, b = np.concatenate([a[rest], a_new[keep]]), np.concatenate([b[rest], b_new[keep]])
                bound, split = np.r_[bound[rest], bound_new[keep]], np.r_[split[rest], split_new[keep]]
            else:
                break
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int),) * 3


def _best(postings: DataFrame, blocks: int, wanted, ids, weights, bars, n: int, total: int, k: int, rounds: int | None, limits) -> DataFrame:
    """(item, item_id, row, doc_id, score): the k best of each item in every block."""
    schema = pa.schema([(c, pa.int64()) for c in ("item", "item_id", "row", "doc_id", "score")])
    context = postings.sparkSession.sparkContext
    shared = context.broadcast((wanted, ids, weights, bars))
    most_documents, most_postings = limits

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, ids, weights, bars = shared.value

        def block(rows: list[tuple]) -> pa.RecordBatch:
            rows.sort(key=lambda r: (r[2], r[0]))  # by length, which evens out impacts within an interval
            sizes = [len(r[3]) for r in rows]
            place = np.repeat(np.arange(len(rows)), sizes)
            term = np.array([t for r in rows for t in r[3]], np.int64)
            times = np.array([t for r in rows for t in r[4]], np.int64)
            length = np.array([100 - 90 + 90 * r[2] * n // total for r in rows], np.int64)
            impact = weights[term] * ((1_000_000_000 * times) // (1000 * times + 8 * length[place]))
            index = Block(place, term, impact, len(rows), len(weights))
            columns = [[], [], [], [], []]
            for item, at, score in index.search(wanted, bars, k, rounds):
                # ascending rows among equals would need the ids; the least k of each score are kept
                keys = [(i, -s, rows[p][1] is None, rows[p][1] or 0, rows[p][0], rows[p][1]) for i, p, s in zip(item.tolist(), at.tolist(), score.tolist())]
                keys.sort(key=lambda x: x[:5])
                held = Counter()
                for i, s, _, _, row, doc_id in keys:
                    held[i] += 1
                    if held[i] <= k:
                        for c, v in zip(columns, (i, ids[i], row, doc_id, -s)):
                            c.append(v)
            return as_table(schema, columns)

        held, postings = [], 0
        for columns in rows_of(batches, "row", "doc_id", "n", "terms", "times"):
            for r in zip(*columns):
                held.append(r)
                postings += len(r[3])
                if len(held) >= most_documents or postings >= most_postings:
                    yield block(held)
                    held, postings = [], 0
        if held:
            yield block(held)

    return postings.repartition(blocks, "row").mapInArrow(search, "item long, item_id long, row long, doc_id long, score long")


def ranked(
    docs: DataFrame,
    items: DataFrame,
    *,
    k: int = 10,
    id_col: str = "doc_id",
    item_col: str = "item_id",
    text_col: str = "text",
    item_terms: int = ITEM_TERMS,
    block: int = BLOCK,
    block_postings: int = BLOCK_POSTINGS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item, with scores above 0."""
    thin = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    asked = materialize(_item_terms(items, item_col, text_col), "item-terms")
    parts = max(1, -(-asked.count() // item_terms))
    part_of = F.pmod(F.xxhash64("item_id"), F.lit(parts))
    found = []
    for part in range(parts):
        pairs = asked.filter(part_of == part).toArrow()  # about ``item_terms`` rows
        words = pairs.column("term").unique().to_pylist()
        places = {w: i for i, w in enumerate(sorted(words))}
        by_item: dict[int | None, list[int]] = {}
        for key, word in zip(pairs.column("item_id").to_pylist(), pairs.column("term").to_pylist()):
            by_item.setdefault(key, []).append(places[word])
        ids, wanted = list(by_item), [np.array(sorted(t), np.int64) for t in by_item.values()]
        postings = materialize(_postings(thin, places), "postings")
        sums = postings.agg(F.count("*"), F.sum("n"), F.sum(F.size("terms"))).first()
        n, total, size = (int(x or 0) for x in sums)
        frequency = np.zeros(len(places), np.int64)
        for r in postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # a row for each word
            frequency[r["term"]] = r["count"]
        weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(f) + 1))) for f in frequency], np.int64)
        blocks = max(1, -(-n // block), -(-size // block_postings))
        search = lambda bars, rounds: _best(
            postings, blocks, wanted, ids, weights, bars, n, total, k, rounds, (block, block_postings)
        )
        order = Window.partitionBy("item").orderBy(F.desc("score"))
        seeds = search(np.zeros(len(ids), np.int64), FIRST_ROUNDS).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") == k)
        bars = np.zeros(len(ids), np.int64)
        for r in seeds.select("item", "score").collect():  # at most one for each item of the part
            bars[r["item"]] = r["score"]
        found.append(search(bars, None))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    return (
        reduce(DataFrame.unionByName, found)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("item_id", "rank", "doc_id", "score")
    )
