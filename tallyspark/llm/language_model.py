"""Scores of texts by a causal self-attention model over words read as subword ids.

Each word of a text, and the end after the last, is a token that is scored once. A word is read
by the embeddings of its first and last subword ids, which are learned from the company that ids
keep in all training texts. The network predicts the class of the next word: the most frequent words
and the end are classes of their own, the others are grouped by the mean embedding of their ids. One head of
masked self-attention with relative positions looks back at the words before. Within its class
a word of the training texts has its corpus share less a discount, and what the discounts leave
is for the words that no training text has. With ``whole`` the network then scores each word of the
class itself: it gives positive weights to the word's own positive numbers, its shades, and the share is
multiplied by that sum over the same sum for the mean of the class. As the sum is linear in the shades,
the words of a class add up exactly to what their shares do, however many there are. Classes and words
then also depend on the mean vector of all words of the text before a window, so on the whole text before a word.
A word that no training text has is spelled: its ids, one after the
other, by how often they follow among the class's or the ids' own kind in the training
vocabulary (with a stop after a piece that ends), and then the word for the ids, which is sure
if they spell it and else goes byte by byte, as where signs are dropped. So the
probabilities of all words add up to one at most.

A text is scored whole, in windows that overlap by ``CONTEXT`` words. The weights are trained in
numpy on all windows of all training texts: in each of a few rounds every task takes its texts
of that round from the same weights, and the tasks' weights are averaged by their windows. So they
depend, a little, on how many tasks there are. Counts, embeddings, class totals and spellings cover all training texts.

Words that are frequent in the corpus, a bounded number, are looked up in every task; the
others go through a join with the table of counts, which gives the same; in texts that are not learned
from it also tells whether the network's score of such a word counts. Nulls: a null text is empty;
a null id stays, is not held out, and is not learned from. Repeated rows each give a row. With no
training text all classes count alike. A text is held as numbers, a few bytes for each word,
and its words in slices. Columns other than id and text are ignored.
"""

from __future__ import annotations

import itertools
import math
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import END, MergeEncoder
from .common import as_table, forget, materialize, on_worker, remainder, rows_of, text_slices
from .neardup import fit_centres

DIVISOR, HELD_OUT = 5, 1
STRIDE, CONTEXT = 16, 8
WINDOW = STRIDE + CONTEXT
WIDTH = 16
SINGLE, GROUPS = 16, 32
CLASSES = SINGLE + GROUPS
# a word's own score is a product of so many positive numbers of it with as many of the network
SHADES, CONTRAST = 16, 1.5
# words of a stretch keep company; its ids are seen through so many fixed random directions
STRETCH, DIRECTIONS = 64, 16
FREQUENT = 1 << 17
# longer words are never looked up, so that the table of frequent words is bounded
FREQUENT_BYTES = 64
# each training text is in one of the rounds
ROUNDS, RATE = 3, 0.02
# windows in a batch, and in a buffer that is shuffled before it is cut into batches
BATCH, BUFFER = 128, 1 << 13
# words a training task has about in a round
TASK_WORDS = 1 << 20
# words a task counts before it passes the counts on, and that a worker keeps between batches
HELD_WORDS = 400_000
# texts that are read at once, and how long they may be for that
CHUNK, CHUNK_CHARS = 256, 1 << 22
# texts whose words are looked up together
READ = 1024
# ASCII signs that end a word in one piece; an apostrophe or a special token may begin another way
SIGNS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) not in "'<")
END_WORD = ""  # no word is empty


def words_of(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, A to Z in lower case, slice by slice."""
    for part in text_slices((text or "").encode().lower()):
        yield part.split()


class Words:
    """Numbers of the words that a worker has met, and the ids of each."""

    def __init__(self, definition: str):
        self.encoder = MergeEncoder(definition)
        self._merged = self.encoder.piece_ids  # of one piece, normalized already
        self.stops: dict[bytes, list[int]] = {}
        self.reset()

    def reset(self) -> None:
        self.stops.clear()
        self.number: dict[bytes, int] = defaultdict(itertools.count().__next__)
        self.words: list[bytes] = []
        self.columns: list[tuple[np.ndarray, ...]] = []

    def _ids(self, word: bytes) -> list[int]:
        """As the encoder has it; what is all Latin letters, signs, or those in order needs no search."""
        core = word.rstrip(SIGNS)
        if not core.isascii():
            low = core.decode().lower()
            letters = low.isalpha() and max(low) < "\u0250"
            piece = low.encode()
        else:
            letters, piece = core.isalpha(), core
        if letters or not core:
            ids = self._merged(piece) if piece else []
            if len(core) == len(word):
                return ids
            tail = word[len(core) :]
            if tail not in self.stops:
                self.stops[tail] = self._merged(tail)
            return ids + self.stops[tail]
        pieces = self.encoder.pieces(word.decode())
        found = self.encoder.encode(set(pieces))
        return [i for p in pieces for i in found[p]]

    def encoded(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words one after the other, and how many each has."""
        flat, sizes, left = self.encoder.words_together(new) if new else (np.zeros(0, np.int64), np.zeros(0, np.int64), [])
        if left:
            spans = [self._ids(new[i]) for i in left]
            owner = np.r_[np.repeat(np.arange(len(new)), sizes), np.repeat(left, [len(x) for x in spans])].astype(np.int64)
            flat = np.r_[flat, np.fromiter(chain.from_iterable(spans), np.int64)][np.argsort(owner, kind="stable")]
            sizes = np.bincount(owner, minlength=len(new))
        return flat, sizes

    def describe(self, new: list[bytes]) -> tuple[np.ndarray, ...]:
        """What is to be known of new words, an entry for each."""
        raise NotImplementedError

    def numbers(self, words: list[bytes]) -> np.ndarray:
        before = len(self.words)
        found = np.fromiter(map(self.number.__getitem__, words), np.int32, len(words))
        if len(self.number) > before:
            high = np.maximum.accumulate(np.r_[before - 1, found])
            new = [words[i] for i in np.flatnonzero(found > high[:-1]).tolist()]
            self.words += new
            self.columns.append(self.describe(new))
        return found

    def read(self, texts: list[str | None]) -> list[np.ndarray]:
        """The words' numbers of each text; they hold until ``reset``."""
        found: list[np.ndarray] = []
        held: list[str] = []
        chars = 0

        def together() -> None:
            nonlocal chars
            found.extend(self._read(held) if held else [])
            held.clear()
            chars = 0

        for text in texts:
            if text and len(text) > CHUNK_CHARS:
                together()
                found.append(np.concatenate([self.numbers(part) for part in words_of(text)] or [np.zeros(0, np.int32)]))
            else:
                held.append(text or "")
                chars += len(held[-1])
                if chars > CHUNK_CHARS:
                    together()
        together()
        return found

    def _read(self, texts: list[str]) -> list[np.ndarray]:
        """The same for texts that are short together; each different word is looked up once."""
        parts = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.large_string())))
        ends, words = parts.offsets.to_numpy()[1:], parts.values
        full = pc.greater(pc.binary_length(words), 0)  # beside white space at an end there is an empty one
        ends = np.r_[0, np.cumsum(full.to_numpy(zero_copy_only=False))][ends]
        coded = words.filter(full).cast(pa.large_binary()).dictionary_encode()
        return np.split(self.numbers(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()], ends[:-1])

    def known(self) -> tuple[np.ndarray, ...]:
        """What ``describe`` gave, by number."""
        if len(self.columns) > 1:
            self.columns = [tuple(np.concatenate(c) for c in zip(*self.columns))]
        return self.columns[0] if self.columns else self.describe([])


class AttentionModel:
    """Embeddings, classes, spelling and attention weights; all of bounded size."""

    def __init__(self, counts: np.ndarray, tokens: list[bytes], ends: np.ndarray):
        size = len(counts)
        self.name = uuid.uuid4().hex  # workers keep what they know of words under it
        self.counts, self.tokens, self.ends = counts, tokens, ends
        # after the ids: what has none, and nothing
        self.embedding = np.zeros((size + 2, WIDTH), np.float32)
        self.codes = np.uint16 if size < 1 << 16 else np.uint32
        self.centres = np.zeros((GROUPS, WIDTH), np.float32)
        # a word's shades are the product of its first and last ids'; their mean is over the words of a class
        self.shades = np.ones((size + 2, SHADES), np.float32)
        self.mean_shades = np.ones((CLASSES, SHADES), np.float32)
        self.single: dict[bytes, int] = {END_WORD.encode(): 0}
        # what an id follows: a word's start, by its class; an id within a piece, by its group; a piece's end
        self.kind_of = np.where(ends, CLASSES + GROUPS, CLASSES)
        self.spelling = np.full((CLASSES + GROUPS + 1, size + 1), -math.log(size + 1), np.float32)
        self.exact = 0.5  # share of words that their ids spell
        self.totals, self.kinds_of_words = np.ones(CLASSES), np.ones(CLASSES)
        self.discount = 0.5
        self.weights: dict[str, np.ndarray] = {}

    # -- words ---------------------------------------------------------------------------

    def describe(self, ids: np.ndarray, times: np.ndarray, sums: np.ndarray, frequent: list[bytes]) -> None:
        """Embed ids by the sums of their company, group them, and name the words that are classes."""
        self.single |= {w: i for i, w in enumerate(frequent[: SINGLE - 1], 1)}
        if len(ids):
            mean = sums.sum(axis=0) / times.sum()
            own = (sums / times[:, None] - mean) * (times / (times + 20.0))[:, None]
            _, vectors = np.linalg.eigh((own * times[:, None]).T @ own)
            projected = own @ vectors[:, ::-1][:, :WIDTH]
            scale = math.sqrt((np.square(projected).sum(axis=1) * times).sum() / times.sum()) + 1e-9
            self.embedding[ids] = projected * (2 / scale)
            norms = np.linalg.norm(self.embedding[ids], axis=1)
            apart = norms > 0
            if apart.any():
                units = (self.embedding[ids][apart] / norms[apart, None]).astype(float)
                found = fit_centres(units, GROUPS)
                self.centres[: len(found)] = found
        group = np.argmax(self.embedding[: len(self.counts)] @ self.centres.T, axis=1)
        self.kind_of = np.where(self.ends, CLASSES + GROUPS, CLASSES + group)
        if len(ids):
            # along the directions in which the ids of a group differ
            apart = self.embedding[ids] - self.embedding[ids].mean(axis=0)
            for g in range(GROUPS):
                own = group[ids] == g
                if own.any():
                    apart[own] = self.embedding[ids][own] - np.average(self.embedding[ids][own], axis=0, weights=times[own])
            norms = np.linalg.norm(apart, axis=1)
            if (norms > 0).any():
                found = fit_centres((apart[norms > 0] / norms[norms > 0, None]).astype(float), SHADES)
                self.shades[:, : len(found)] = np.exp(np.clip(self.embedding @ found.T.astype(np.float32) * (CONTRAST / 2), -4, 4))

    def shades_of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The shades of words, by their first and last ids."""
        found = self.shades.take(first, axis=0, mode="clip")
        found *= self.shades.take(last, axis=0, mode="clip")
        return found

    def vectors(self, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Mean embedding of the ids of each word."""
        sums = np.zeros((len(sizes), WIDTH), np.float32)
        there = sizes > 0
        if len(flat):
            sums[there] = np.add.reduceat(self.embedding[flat], (np.cumsum(sizes) - sizes)[there])
        return sums / np.maximum(sizes, 1)[:, None].astype(np.float32)

    def classes(self, words: list[bytes], vectors: np.ndarray) -> np.ndarray:
        found = SINGLE + np.argmax(vectors @ self.centres.T, axis=1)
        own = [(i, self.single[w]) for i, w in enumerate(words) if w in self.single]
        if own:
            found[[i for i, _ in own]] = [c for _, c in own]
        return found

    def steps(self, classes: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(kind, id) steps of the spelling of words one after the other, stops included."""
        ids = np.insert(flat, np.cumsum(sizes), len(self.counts))
        kinds = np.r_[0, self.kind_of[np.minimum(ids[:-1], len(self.counts) - 1)]] if len(ids) else ids
        kinds[np.cumsum(sizes + 1) - sizes - 1] = classes  # a word's start
        return kinds, ids

    def spelled(self, words: list[bytes], classes: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Log probability of each word, within its class, if it is not of the training texts."""
        kinds, ids = self.steps(classes, flat, sizes)
        logs = np.add.reduceat(self.spelling[kinds, ids].astype(float), np.cumsum(sizes + 1) - sizes - 1)
        exact = self.spell_out(words, flat, sizes)
        by_bytes = math.log(1 - self.exact) - math.log(257) * (1 + np.array([len(w) for w in words]))
        left = np.log(self.discount * self.kinds_of_words / self.totals)[classes]
        return left + logs + np.where(exact, math.log(self.exact), by_bytes)

    def spell_out(self, words: list[bytes], flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether a word's ids decode to it."""
        tokens, last = self.tokens, np.cumsum(sizes).tolist()
        ids = flat.tolist()
        return np.array([b"".join([tokens[i] for i in ids[b - n : b]]) == w for w, n, b in zip(words, sizes.tolist(), last)], bool)

    def share(self, kinds: np.ndarray, ids: np.ndarray, times: np.ndarray) -> None:
        """Take in what ``_word_facts`` counted."""
        steps, seen = kinds >= 0, np.zeros(self.spelling.shape)
        seen[kinds[steps], ids[steps]] = times[steps]
        plain = (seen.sum(axis=0) + 0.5) / (seen.sum() + 0.5 * seen.shape[1])
        for kind, row in enumerate(seen):
            self.spelling[kind] = np.log((row + 20 * plain) / (row.sum() + 20))

        def of(kind: int, size: int) -> np.ndarray:
            found = np.zeros(size)
            found[ids[kinds == kind]] = times[kinds == kind]
            return found

        self.totals, self.kinds_of_words = np.maximum(of(_TOTALS, CLASSES), 1), np.maximum(of(_KINDS, CLASSES), 1)
        other, exact = of(_EXACT, 2)
        self.exact = (exact + 1) / (other + exact + 2)
        once, twice = of(_TIMES, 2)
        self.discount = (once + 1) / (once + 2 * twice + 2)
        shaded, different = (of(kind, CLASSES * SHADES).reshape(CLASSES, SHADES) for kind in (_SHADED, _SHADES_OF_WORDS))
        some = shaded[:, 0] > 0
        left = (self.totals - self.discount * self.kinds_of_words)[some, None]
        self.mean_shades[some] = (shaded - self.discount * different)[some] / left

    def known(self, count: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Log of the share of words of the training texts in their classes."""
        less = np.where(classes < SINGLE, 0, self.discount)  # nothing is left of a class of one word
        return np.log((count - less) / self.totals[classes])

    def prepare(self, whole: bool = False) -> None:
        """Weights to begin training with: every class, and every word within its class, by its share."""
        rng = np.random.default_rng(7)
        shapes = {"q": (WIDTH, WIDTH), "k": (WIDTH, WIDTH), "v": (WIDTH, WIDTH), "d": (WIDTH, CLASSES), "o": (WIDTH, CLASSES)}
        scale = {"q": 0.5, "k": 0.5, "v": 1.0, "d": 0.05, "o": 0.05}
        self.weights = {n: (rng.normal(size=s) / math.sqrt(WIDTH) * scale[n]).astype(np.float32) for n, s in shapes.items()}
        self.weights["near"] = np.zeros(WINDOW, np.float32)
        self.weights["b"] = np.log(self.totals / self.totals.sum()).astype(np.float32)
        if whole:
            zeros = {"shade": (2 * WIDTH, SHADES), "tint": SHADES, "past": (WIDTH, CLASSES + SHADES)}
            self.weights |= {n: np.zeros(shape, np.float32) for n, shape in zeros.items()}

    def light(self) -> AttentionModel:
        """What training and scoring of coded words need."""
        found = AttentionModel.__new__(AttentionModel)
        found.__dict__ = self.__dict__ | {"spelling": None, "tokens": None, "single": None}
        return found

    # -- attention -----------------------------------------------------------------------

    def forward(self, x: np.ndarray, gone: np.ndarray, past: np.ndarray | None = None) -> dict[str, np.ndarray]:
        """Attention of the words after the context, and the logits of the classes that follow them.

        ``x`` are the vectors of windows of words; ``gone`` marks those that stand for nothing. With
        ``past``, the mean vectors of all words of a text before each window, there are the logits of
        the shades of the words that follow, too, and both regard the past.
        """
        w, mixed = self.weights, self.mixed()
        # words' vectors and the mean of what they look at; what is asked of a word and taken from it are
        # products of weights, so that no other vectors of words are needed
        both = np.empty((len(x), STRIDE, 2 * WIDTH), x.dtype)
        both[:, :, :WIDTH] = x[:, CONTEXT:]
        flat = both.reshape(-1, 2 * WIDTH)
        a = (flat[:, :WIDTH] @ mixed["ask"]).reshape(len(x), STRIDE, WIDTH) @ x.transpose(0, 2, 1)
        np.clip(a, -60, 60, out=a)
        np.exp(a, out=a)
        a *= np.exp(w["near"])[np.maximum(_BACK, 0)] * _SEEN
        some = np.flatnonzero(gone.any(axis=1))
        if len(some):
            a[some] *= ~gone[some, None, :]
        a *= 1 / (_sums(a)[..., None] + np.float32(1e-20))
        both[:, :, WIDTH:] = a @ x
        found = {"both": flat, "a": a, "logits": flat @ mixed["out"]}
        if past is None:
            found["logits"] += w["b"]
        else:
            found["shades"] = flat @ mixed["shade"]
            for name, rows in (("logits", past @ w["past"][:, :CLASSES] + w["b"]), ("shades", past @ w["past"][:, CLASSES:] + w["tint"])):
                found[name].reshape(len(x), STRIDE, -1)[...] += rows[:, None, :]
        return found

    def mixed(self) -> dict[str, np.ndarray]:
        """Products of weights: what a word asks of another, and logits from its vector and from the mean of what it looks at."""
        w = self.weights
        found = {"ask": w["q"] @ w["k"].T / np.float32(math.sqrt(WIDTH)), "out": np.vstack([w["d"], w["v"] @ w["o"]])}
        if "shade" in w:
            found["shade"] = np.vstack([w["shade"][:WIDTH], w["v"] @ w["shade"][WIDTH:]])
        return found

    def train(self, batches: Iterator[tuple], rate: float) -> int:
        """Adam on batches of windows, as ``slopes`` takes them; the loss is that of the next word's class and,
        if the past is given, of the word within it. Returns how many windows."""
        # all weights in one row, of which each is a part
        row = np.concatenate([w.ravel() for w in self.weights.values()])
        sizes = np.cumsum([w.size for w in self.weights.values()])
        self.weights = {n: part.reshape(w.shape) for (n, w), part in zip(self.weights.items(), np.split(row, sizes[:-1]))}
        first, second = np.zeros_like(row), np.zeros_like(row)
        step = windows = 0
        for x, *rest in batches:
            windows += len(x)
            step += 1
            now = rate * math.sqrt(1 - 0.99**step) / (1 - 0.9**step)
            slopes = self.slopes(x, *rest)
            g = np.concatenate([slopes[n].ravel() for n in self.weights])
            first += 0.1 * (g - first)
            second += 0.01 * (g * g - second)
            row -= now * first / (np.sqrt(second) + 1e-8)
        return windows

    def slopes(
        self, x: np.ndarray, gone: np.ndarray, goal: np.ndarray, past: np.ndarray | None = None, shades: np.ndarray | None = None
    ) -> dict[str, np.ndarray]:
        """Gradients of the mean loss; a goal of -1 is none. ``shades`` are those of the words that follow."""
        w, f, mixed = self.weights, self.forward(x, gone, past), self.mixed()
        both, a, p, goal = f["both"], f["a"], f["logits"], goal.ravel()
        there = np.flatnonzero(goal >= 0)
        np.clip(p, -60, 60, out=p)
        np.exp(p, out=p)
        share = np.float32(1 / max(1, len(there)))
        p *= ((goal >= 0) * share / _sums(p))[:, None]
        p[there, goal[there]] -= share
        scale, total = np.float32(1 / math.sqrt(WIDTH)), lambda m: np.ones(len(m), m.dtype) @ m
        out = both.T @ p
        dseen, dv, found = p @ mixed["out"][WIDTH:].T, out[WIDTH:] @ w["o"].T, {"d": out[:WIDTH], "o": w["v"].T @ out[WIDTH:], "b": total(p)}
        if past is not None:
            by_word, by_class = self.chances(f["shades"], goal, shades)
            several = (goal >= SINGLE) * share
            by_class *= (several / _sums(by_class))[:, None]
            by_word *= (several / _sums(by_word))[:, None]
            by_class -= by_word
            out = both.T @ by_class
            dseen += by_class @ mixed["shade"][WIDTH:].T
            dv += out[WIDTH:] @ w["shade"][WIDTH:].T
            rows = [np.ones(STRIDE, m.dtype) @ m.reshape(len(x), STRIDE, -1) for m in (p, by_class)]
            found |= {"shade": np.vstack([out[:WIDTH], w["v"].T @ out[WIDTH:]]), "tint": total(by_class), "past": past.T @ np.hstack(rows)}
        ds = dseen.reshape(-1, STRIDE, WIDTH) @ x.transpose(0, 2, 1)
        ds -= _sums(dseen * both[:, WIDTH:]).reshape(-1, STRIDE, 1)
        ds *= a
        dask = both[:, :WIDTH].T @ (ds @ x).reshape(-1, WIDTH) * scale
        near = np.bincount(np.maximum(_BACK, 0).ravel(), total(ds.reshape(len(ds), -1)), WINDOW).astype(np.float32)
        return found | {"q": dask @ w["k"], "k": dask.T @ w["q"], "v": dv, "near": near}

    def chances(self, logits: np.ndarray, goal: np.ndarray, shades: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By shade, of which the logits are given, what words are scored and what the words of their classes are in the mean.

        A word's share in its class is multiplied by the quotient of the sums: as the score is linear
        in a word's shades, the words of a class add up to what their shares do, without a sum over them.
        Where there is no choice, at classes of one word, the quotient means nothing.
        """
        light = np.exp(np.clip(logits, -60, 60))
        of_class = self.mean_shades.take(goal, axis=0, mode="clip")
        of_class *= light
        return light * shades, of_class

    def past(self, codes: np.ndarray, lengths: np.ndarray, size: int = 256) -> np.ndarray:
        """Mean vectors of all words of a line before the words that each of its windows asks."""
        rows = -(-lengths // STRIDE)
        begins = np.cumsum(rows) - rows
        sums = np.zeros((len(codes) + 1, WIDTH))
        for at in range(0, len(codes), size):
            own = self.inputs(codes[at : at + size, :, CONTEXT:])  # nothing and the start are zeros
            sums[at + 1 : at + 1 + len(own)] = np.ones(STRIDE, own.dtype) @ own
        np.cumsum(sums, axis=0, out=sums)
        words = (np.arange(len(codes)) - np.repeat(begins, rows)) * STRIDE - 1
        return ((sums[:-1] - np.repeat(sums[begins], rows, axis=0)) / np.maximum(words, 1)[:, None]).astype(np.float32)

    def logs(self, lines: list[np.ndarray], size: int = 256) -> tuple[list[float], np.ndarray, np.ndarray]:
        """For each line the log probability of its words' classes and of the end's; for each place of all
        lines by how much the network raises the word's share in its class; and where each line begins there."""
        if not lines:
            return [], np.zeros(0, np.float32), np.zeros(0, np.int64)
        codes, goals, lengths = windows_of(lines, len(self.counts))
        whole = "shade" in self.weights
        past, follows = (self.past(codes, lengths), following(codes)) if whole else (None, None)
        found, raised = np.zeros(len(goals)), np.zeros(goals.size if whole else 0, np.float32)
        for at in range(0, len(goals), size):
            some = slice(at, at + size)
            x, gone, goal = self.inputs(codes[some]), codes[some, 0] > len(self.counts), goals[some].ravel()
            made = self.forward(x, gone, past[some] if whole else None)
            logits = made["logits"]
            wanted = logits[np.arange(len(logits)), np.maximum(goal, 0)]
            np.clip(logits, -60, 60, out=logits)
            np.exp(logits, out=logits)
            logs = wanted - np.log(_sums(logits))
            logs[goal < 0] = 0
            found[some] = logs.reshape(-1, STRIDE).sum(axis=1, dtype=float)
            if whole:
                by_word, by_class = self.chances(made["shades"], goal, self.shades_of(*follows[:, some].reshape(2, -1)))
                raised[at * STRIDE : (at + size) * STRIDE] = np.log(_sums(by_word) / _sums(by_class)) * (goal >= SINGLE)
        rows = -(-lengths // STRIDE)
        begins = np.cumsum(rows) - rows
        return np.add.reduceat(found, begins).tolist(), raised, begins * STRIDE

    def line(self, data: bytes) -> np.ndarray:
        """First ids, last ids and classes of the words of a coded text."""
        width = np.dtype(self.codes).itemsize
        n = len(data) // (2 * width + 1)
        codes = np.frombuffer(data, self.codes, 2 * n).reshape(2, n)
        return np.vstack([codes, np.frombuffer(data, np.uint8, n, 2 * width * n)[None].astype(self.codes)])

    def inputs(self, codes: np.ndarray) -> np.ndarray:
        """The vectors of windows of words."""
        x = self.embedding.take(codes[:, 0], axis=0, mode="clip")  # no code is beyond; a check of each takes longer
        x += self.embedding.take(codes[:, 1], axis=0, mode="clip")
        x *= np.float32(0.5)
        return x


# what the facts about words are, beside steps of spelling
_TOTALS, _KINDS, _EXACT, _TIMES, _SHADED, _SHADES_OF_WORDS = -1, -2, -3, -4, -5, -6

# how far before each asking word a word stands
_BACK = np.arange(CONTEXT, WINDOW)[:, None] - np.arange(WINDOW)[None, :]
_SEEN = (_BACK >= 0).astype(np.float32)


def _sums(x: np.ndarray) -> np.ndarray:
    """Over the last axis, which is short: as a product, which is faster than numpy's sum."""
    return (x.reshape(-1, x.shape[-1]) @ np.ones(x.shape[-1], x.dtype)).reshape(x.shape[:-1])


def windows_of(lines: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, goals, lengths): windows of all lines, and the classes of the words that follow.

    A line has rows of first ids, last ids and classes of words. Every word, and the end, is the goal
    of one place; -1 is no goal. Beyond a line the code is ``size`` + 1. ``lengths`` counts a line's goals.
    """
    lengths = np.array([x.shape[1] + 1 for x in lines], np.int64)
    rows = -(-lengths // STRIDE)
    begins = np.cumsum(rows) - rows
    codes = np.full((2, int(rows.sum()) * STRIDE), size + 1, np.int64)
    goals = np.full(codes.shape[1], -1, np.int64)
    for x, b in zip(lines, (begins * STRIDE).tolist()):
        n = x.shape[1]
        codes[:, b] = size  # the start
        codes[:, b + 1 : b + 1 + n] = x[:2]
        goals[b : b + n] = x[2]
        goals[b + n] = 0  # the end's class
    codes, goals = codes.reshape(2, -1, STRIDE), goals.reshape(-1, STRIDE)
    before = np.full((2, len(goals), CONTEXT), size + 1, np.int64)
    before[:, 1:] = codes[:, :-1, STRIDE - CONTEXT :]
    before[:, begins] = size + 1
    return np.concatenate([before, codes], axis=2).transpose(1, 0, 2), goals, lengths


def following(codes: np.ndarray) -> np.ndarray:
    """First and last ids of the words that follow each place of windows in order, where it has a goal."""
    asked = codes[:, :, CONTEXT:].transpose(1, 0, 2)
    return np.roll(asked.reshape(2, -1), -1, axis=1).reshape(asked.shape)


def ends_of(flat: np.ndarray, sizes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last id of each word; ``size`` where it has none."""
    ends, some = np.cumsum(sizes), sizes > 0
    first, last = np.full(len(sizes), size), np.full(len(sizes), size)
    first[some], last[some] = flat[(ends - sizes)[some]], flat[ends[some] - 1]
    return first, last


class Company(Words):
    """Words with their ids, for counting them and the company they keep."""

    def describe(self, new: list[bytes]) -> tuple[np.ndarray, ...]:
        if not new:
            return (np.zeros(0, np.int64),) * 2
        flat, sizes = self.encoded(new)
        self.flat.append(flat)
        return sizes, ends_of(flat, sizes, self.encoder.size)[0]

    def reset(self) -> None:
        super().reset()
        self.flat: list[np.ndarray] = []


class CodedWords(Words):
    """Words with their first and last ids, class, whether they are frequent, and then the logs of their shares, else their spelling."""

    def __init__(self, definition: str, model: AttentionModel, frequent: dict[bytes, int], room: float):
        self.model, self.frequent, self.room = model, frequent, room
        super().__init__(definition)

    def describe(self, new: list[bytes]) -> tuple[np.ndarray, ...]:
        model, size = self.model, self.encoder.size
        flat, sizes = self.encoded(new) if new else (np.zeros(0, np.int64),) * 2
        first, last = ends_of(flat, sizes, size)
        classes = model.classes(new, model.vectors(flat, sizes))
        counts = np.fromiter(map(self.frequent.get, new, repeat(0)), np.int64, len(new))
        often, (share, base, spelled) = counts > 0, np.zeros((3, len(new)))
        share[often] = model.known(counts[often], classes[often])
        base[often] = np.log10((counts[often] + 0.5) / self.room)
        rare = np.flatnonzero(~often)
        if len(rare):
            own = np.repeat(~often, sizes)
            spelled[rare] = model.spelled([new[i] for i in rare.tolist()], classes[rare], flat[own], sizes[rare])
        return first.astype(model.codes), last.astype(model.codes), classes.astype(np.uint8), often, share, base, spelled


_GATHERED = pa.schema([("word", pa.string()), ("c", pa.int64()), ("id", pa.int32()), ("n", pa.int64()), ("sums", pa.binary())])


def gather(training: DataFrame, vocabulary: str, definition, size: int) -> DataFrame:
    """(word, c) for the words of all training texts, (id, n, sums) for the ids of theirs.

    The company of a word is the mean direction of the other words in its stretch, and a word's
    direction is a fixed random one of its first id. ``sums`` adds up an id's company, as bytes.
    A task passes on what it has of words now and then, of ids at its end.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = on_worker(f"company {vocabulary}", lambda: Company(definition.value))
        known.reset()
        directions = np.random.default_rng(11).normal(size=(size + 1, DIRECTIONS)).astype(np.float32)
        directions[size] = 0
        directions = np.ascontiguousarray(directions.T, float)
        total, times = np.zeros((size, DIRECTIONS)), np.zeros(size, np.int64)
        # of each word: how often, the company with itself, and how much of itself that is
        ends, counts, sums, itself = 0, np.zeros(0, np.int64), np.zeros((DIRECTIONS, 0)), np.zeros(0)

        def passed_on() -> pa.RecordBatch:
            nonlocal counts, sums, itself, times
            sizes, first = known.known()
            if len(sizes):
                flat, owner = np.concatenate(known.flat), np.repeat(np.arange(len(sizes)), sizes)
                for d, way in enumerate(directions):
                    total[:, d] += np.bincount(flat, (sums[d, : len(sizes)] - way[first] * itself)[owner], size)
                times += np.bincount(flat, counts[owner], size).astype(np.int64)
            words = _strings(known.words)
            none = [None] * len(words)
            batch = as_table(_GATHERED, [words, counts, none, none, none])
            counts, sums, itself = np.zeros(0, np.int64), np.zeros((DIRECTIONS, 0)), np.zeros(0)
            known.reset()
            return batch

        for (texts,) in rows_of(batches, "text", chunk=READ):
            ends += len(texts)
            numbers = [t for t in known.read(texts) if len(t)]
            if not numbers:
                continue
            first = known.known()[1]
            more = len(known.words) - len(counts)
            if more:
                room = max(more, len(known.words) // 2)  # grows by halves
                if len(known.words) > sums.shape[1]:
                    sums = np.concatenate([sums, np.zeros((DIRECTIONS, room))], axis=1)
                counts = np.concatenate([counts, np.zeros(more, np.int64)])
                itself = np.concatenate([itself, np.zeros(more)])
            line = np.concatenate(numbers).astype(np.int64)
            counts += np.bincount(line, minlength=len(counts))
            starts = np.concatenate([np.arange(0, len(t), STRETCH) + at for t, at in zip(numbers, _upto(numbers))])
            held = np.diff(np.r_[starts, len(line)])
            stretch, part = np.repeat(np.arange(len(starts)), held), 1 / np.maximum(held - 1, 1)
            itself += np.bincount(line, part[stretch], len(counts))
            ids = first[line]
            for d, way in enumerate(directions):
                company = np.bincount(stretch, way[ids], len(starts)) * part
                sums[d, : len(counts)] += np.bincount(line, company[stretch], len(counts))
            if len(known.words) > HELD_WORDS:
                yield passed_on()
        yield passed_on()
        yield as_table(_GATHERED, [[END_WORD], [ends], [None], [None], [None]])
        there = np.flatnonzero(times)
        none = [None] * len(there)
        yield as_table(_GATHERED, [none, none, there, times[there], [x.tobytes() for x in total[there].astype("<f4")]])

    return training.mapInArrow(count, "word string, c long, id int, n long, sums binary")


def word_counts(gathered: DataFrame) -> DataFrame:
    """(word, c): how often each word occurs in the training texts, and the end word once a text."""
    return gathered.filter("word is not null").groupBy("word").agg(F.sum("c").alias("c"))


def id_company(gathered: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, times, sums) of all tasks together; at most a row for each id, whatever the number of texts."""
    schema = pa.schema([("id", pa.int32()), ("n", pa.int64()), ("sums", pa.binary())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for ids, n, sums in rows_of(batches, "id", "n", "sums", chunk=4096):
            for i, times, data in zip(ids, n, sums):
                own = found.setdefault(i, [0, np.zeros(DIRECTIONS)])
                own[0] += times
                own[1] += np.frombuffer(data, "<f4")
        yield as_table(schema, [list(found), [x[0] for x in found.values()], [x[1].astype("<f4").tobytes() for x in found.values()]])

    rows = gathered.filter("id is not null").select("id", "n", "sums").repartition("id").mapInArrow(add, "id int, n long, sums binary")
    found = rows.orderBy("id").toArrow()
    sums = np.frombuffer(b"".join(found.column("sums").to_pylist()), "<f4").reshape(-1, DIRECTIONS).astype(float)
    return found.column("id").to_numpy(), found.column("n").to_numpy(), sums


def _strings(words: list[bytes]) -> pa.Array:
    return pa.array(words, pa.binary()).cast(pa.string())


def _upto(parts: list[np.ndarray]) -> list[int]:
    sizes = np.array([len(p) for p in parts], np.int64)
    return (np.cumsum(sizes) - sizes).tolist()


def _word_facts(counts: DataFrame, vocabulary: str, definition, shared) -> pa.Table:
    """(kind, id, n) over all training words: steps of spelling, by different words; of each class
    the words and the different words; words that their ids spell or not; words met once and twice;
    the shades of a class's words and of its different words."""
    schema = pa.schema([("kind", pa.int32()), ("id", pa.int32()), ("n", pa.float64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        known = on_worker(f"company {vocabulary}", lambda: Company(definition.value))
        size = len(model.counts)
        steps: Counter[int] = Counter()
        totals, different = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
        ways, often = np.zeros(2, np.int64), np.zeros(2, np.int64)
        shaded, shades = np.zeros((SHADES, CLASSES)), np.zeros((SHADES, CLASSES))
        for words, times in rows_of(batches, "word", "c", chunk=5000):
            own = [w.encode() for w in words]
            flat, sizes = known.encoded(own)
            classes = model.classes(own, model.vectors(flat, sizes))
            np.add.at(totals, classes, times)
            np.add.at(different, classes, 1)
            often += [times.count(1), times.count(2)]
            for k, shade in enumerate(model.shades_of(*ends_of(flat, sizes, size)).T.astype(float)):
                shaded[k] += np.bincount(classes, shade * times, CLASSES)
                shades[k] += np.bincount(classes, shade, CLASSES)
            kinds, ids = model.steps(classes, flat, sizes)
            keys, n = np.unique(kinds * (size + 1) + ids, return_counts=True)
            steps.update(dict(zip(keys.tolist(), n.tolist())))
            np.add.at(ways, model.spell_out(own, flat, sizes).astype(int), 1)
        keys = np.fromiter(steps, np.int64, len(steps))
        yield as_table(schema, [keys // (size + 1), keys % (size + 1), np.fromiter(steps.values(), float, len(steps))])
        of_shades = ((_SHADED, shaded.T.ravel()), (_SHADES_OF_WORDS, shades.T.ravel()))
        for kind, found in ((_TOTALS, totals), (_KINDS, different), (_EXACT, ways), (_TIMES, often), *of_shades):
            yield as_table(schema, [[kind] * len(found), range(len(found)), found])

    # at most a row for each kind and id, whatever the number of texts
    found = counts.filter(F.col("word") != END_WORD).mapInArrow(count, "kind int, id int, n double")
    return found.groupBy("kind", "id").agg(F.sum("n").alias("n")).toArrow()


def _train(model: AttentionModel, coded: DataFrame, words: int) -> None:
    """Weights from all windows; in each round the mean of what the tasks make of them."""
    context, names = coded.sparkSession.sparkContext, list(model.weights)
    schema = pa.schema([("windows", pa.int64()), ("weights", pa.list_(pa.binary()))])
    tasks = max(1, -(-words // (ROUNDS * TASK_WORDS)))
    for turn in range(ROUNDS):
        shared = context.broadcast(model.light())

        def learn(batches: Iterator[pa.RecordBatch], shared=shared, turn=turn) -> Iterator[pa.RecordBatch]:
            forget()
            network = AttentionModel.__new__(AttentionModel)
            network.__dict__ = shared.value.__dict__ | {"weights": {n: w.copy() for n, w in shared.value.weights.items()}}
            size, whole = len(network.counts), "shade" in network.weights
            rng = np.random.default_rng(11 + TaskContext.get().partitionId())

            def shuffled() -> Iterator[tuple]:
                held: list[tuple[np.ndarray, ...]] = []
                count = 0
                for (lines,) in rows_of(batches, "line", chunk=CHUNK):
                    codes, goals, lengths = windows_of([network.line(x) for x in lines], size)
                    parts = (codes, goals, network.past(codes, lengths), following(codes).transpose(1, 0, 2)) if whole else (codes, goals)
                    for at in range(0, len(goals), BUFFER):
                        held.append(tuple(part[at : at + BUFFER] for part in parts))
                        count += len(held[-1][1])
                        if count >= BUFFER:
                            yield from in_batches(held)
                            held, count = [], 0
                if held:
                    yield from in_batches(held)

            def in_batches(held: list) -> Iterator[tuple]:
                codes, goals, *rest = (np.concatenate(part) for part in zip(*held))
                order = rng.permutation(len(goals))
                for at in range(0, len(order), BATCH):
                    some = order[at : at + BATCH]
                    own, goal = codes[some], goals[some]
                    more = (rest[0][some], network.shades_of(*rest[1][some].transpose(1, 0, 2).reshape(2, -1))) if whole else ()
                    yield network.inputs(own), own[:, 0] > size, goal, *more

            windows = network.train(shuffled(), RATE / (1 + turn))
            yield as_table(schema, [[windows], [[network.weights[n].astype(np.float32).tobytes() for n in names]]])

        part = coded.filter(F.col("learn") & (F.pmod(F.xxhash64("doc_id"), F.lit(ROUNDS)) == turn)).select("line").coalesce(tasks)
        # a row for each task
        found = [r for r in part.mapInArrow(learn, "windows long, weights array<binary>").collect() if r["windows"]]
        shared.destroy()
        total = sum(r["windows"] for r in found)
        for k, n in enumerate(names if found else []):
            mean = sum(np.frombuffer(r["weights"][k], np.float32) * (r["windows"] / total) for r in found)
            model.weights[n] = mean.astype(np.float32).reshape(model.weights[n].shape)


_RARE = pa.struct([("word", pa.string()), ("times", pa.int64()), ("spelled", pa.float64()), ("total", pa.float64())])
_CODED = pa.schema(
    [
        ("row", pa.int64()),
        ("doc_id", pa.int64()),
        ("learn", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("base", pa.float64()),
        ("share", pa.float64()),
        ("line", pa.binary()),
        ("rare", pa.list_(_RARE)),
        ("places", pa.binary()),
    ]
)
_CODED_TYPES = (
    "row long, doc_id long, learn boolean, n_tokens long, n_known long, base double, share double, line binary, "
    "rare array<struct<word: string, times: long, spelled: double, total: double>>, places binary"
)


def coded_texts(known: CodedWords, texts: list[str | None], learns: list[bool], end: int) -> list:
    """Columns n_tokens, n_known, base, share, line, rare and places of ``_CODED``.

    ``share`` sums the logs of frequent words' shares in their classes. Other words are left to the
    join: ``rare`` has them, with how they are spelled. Where they may be of no training text, ``places``
    has a row of their places and one of which word of ``rare`` is there.
    """
    model = known.model
    if len(known.words) > HELD_WORDS:
        known.reset()
    numbers = known.read(texts)
    first, last, classes, frequent, share, base, spelled = known.known()
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in numbers])
    line = np.concatenate([*numbers, np.zeros(0, np.int32)]).astype(np.int64)
    often = frequent[line]
    sums = lambda who, weights=None: np.bincount(who, weights, len(texts))
    share, base, n_known = sums(owner, share[line]), sums(owner, base[line]), sums(owner[often])
    # of the others, each word of each text once
    keys, times = np.unique(owner[~often] << 32 | line[~often], return_counts=True)
    which = keys & 0xFFFFFFFF
    parts = [_strings([known.words[i] for i in which.tolist()]), times, spelled[which] * times, model.totals[classes[which]]]
    offsets = np.r_[0, np.cumsum(sums(keys >> 32))].astype(np.int32)
    # without a training text the end is an unknown word
    base, n_known = base + math.log10((end + 0.5) / known.room), n_known + (end > 0)
    rare = pa.ListArray.from_arrays(
        pa.array(offsets), pa.StructArray.from_arrays([parts[0], *(pa.array(p, f.type) for p, f in zip(parts[1:], list(_RARE)[1:]))], fields=list(_RARE))
    )
    n_tokens = np.array([len(t) + 1 for t in numbers], np.int64)
    coded = [first[line], last[line], classes[line]]
    lines = [b"".join([c[at : at + len(t)].tobytes() for c in coded]) for t, at in zip(numbers, _upto(numbers))]
    doubtful = np.flatnonzero(~often & ~np.array(learns, bool)[owner])
    text = owner[doubtful]
    pairs = np.vstack([doubtful - np.array(_upto(numbers), np.int64)[text], np.searchsorted(keys, text << 32 | line[doubtful]) - offsets[text]]).astype("<i4")
    cuts = np.cumsum(sums(text))[:-1].astype(np.int64)
    places = [p.tobytes() if p.size else None for p in np.split(pairs, cuts, axis=1)]
    return [n_tokens, n_known.astype(np.int64), base, share, lines, rare, places]


def language_scores(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text", whole: bool = False) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score): one row per document.

    Scores are log10 probabilities: ``base_score`` of the words by smoothed counts, ``score`` of the
    words by the model. With ``whole`` the network scores the words themselves and regards all of a text
    before them; without, it predicts their classes from a window, and words have their shares in these.
    """
    spark = docs.sparkSession
    with open(vocabulary, encoding="utf-8") as file:
        text = file.read()
    encoder = MergeEncoder(text)
    definition = spark.sparkContext.broadcast(text)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    learn = F.coalesce(remainder(F.col("doc_id"), DIVISOR) != HELD_OUT, F.lit(False))
    gathered = materialize(gather(texts.filter(learn).select("text"), vocabulary, definition, encoder.size), "gathered", "zstd")
    counts = materialize(word_counts(gathered), "word-counts")
    ended = F.sum(F.when(F.col("word") == END_WORD, F.col("c")))
    sums = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v"), F.coalesce(ended, F.lit(0)).alias("ends")
    ).first()
    total, room, end = sums["n"], sums["n"] + 0.5 * (sums["v"] + 1), sums["ends"]
    short = counts.filter(F.octet_length("word") <= FREQUENT_BYTES)
    top = {r["word"].encode(): r["c"] for r in short.orderBy(F.desc("c"), "word").limit(FREQUENT).collect()}

    model = described(gathered, counts, [w for w in top if w], encoder, vocabulary, definition, end)
    frequent, shared = spark.sparkContext.broadcast(top), spark.sparkContext.broadcast(model)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = on_worker(f"codes {shared.value.name}", lambda: CodedWords(definition.value, shared.value, frequent.value, room))
        row = TaskContext.get().partitionId() << 40
        for keys, learns, texts in rows_of(batches, "doc_id", "learn", "text", chunk=READ):
            yield as_table(_CODED, [range(row, row + len(keys)), keys, learns, *coded_texts(known, texts, learns, end)])
            row += len(keys)

    coded = materialize(texts.select("doc_id", learn.alias("learn"), "text").mapInArrow(code, _CODED_TYPES), "coded", "zstd")
    frequent.destroy()
    shared.destroy()
    model.prepare(whole)
    _train(model, coded, total)
    trained = spark.sparkContext.broadcast(model.light())
    facts = ["row", "doc_id", "n_tokens", "n_known", "base"]
    schema = pa.schema([*[_CODED.field(n) for n in facts], ("score", pa.float64()), ("raised", pa.list_(pa.float64()))])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        network = trained.value
        for *same, share, lines, places in rows_of(batches, *facts, "share", "line", "places", chunk=CHUNK):
            logs, raised, begins = network.logs([network.line(x) for x in lines])
            logs, apart = np.array(logs) + np.array(share), [None] * len(lines)
            if whole:
                for i, pairs in enumerate(places):
                    if pairs:  # words that the join has yet to find
                        at, word = np.frombuffer(pairs, "<i4").reshape(2, -1)
                        apart[i] = np.bincount(word, raised[begins[i] + at])
                        raised[begins[i] + at] = 0
                logs += np.add.reduceat(raised, begins, dtype=float)
            yield as_table(schema, [*same, logs / math.log(10), apart])

    scored = coded.select(*facts, "share", "line", "places").mapInArrow(
        score, "row long, doc_id long, n_tokens long, n_known long, base double, score double, raised array<double>"
    )
    unknown = F.lit(math.log10(0.5 / room))
    share = F.coalesce(F.col("times") * F.log((F.col("c") - F.lit(model.discount)) / F.col("total")), F.col("spelled"))

    def joined(rows: DataFrame, *also: Column) -> DataFrame:
        rare = rows.select("row", F.posexplode("rare").alias("place", "r")).select("row", "place", "r.*")
        return (
            rare.join(counts, "word", "left")
            .groupBy(F.col("row").alias("more_row"))
            .agg(
                F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("more_known"),
                F.sum(F.col("times") * F.coalesce(F.log10((F.col("c") + 0.5) / room), unknown)).alias("more_base"),
                (F.sum(share) / math.log(10)).alias("more_score"),
                *also,
            )
        )

    more, raised = joined(coded if not whole else coded.filter("learn")), F.lit(0.0)
    if whole:
        # training texts have known words only; of the others those count as raised that the join finds
        found = F.collect_list(F.when(F.col("c").isNotNull(), F.col("place"))).alias("found")
        more = more.unionByName(joined(coded.filter("not learn"), found), allowMissingColumns=True)
        added = F.aggregate(F.coalesce("found", F.array().cast("array<int>")), F.lit(0.0), lambda added, place: added + F.get("raised", place))
        raised = added / math.log(10)
    return scored.join(more, F.col("row") == F.col("more_row"), "left").select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), DIVISOR) == HELD_OUT, F.lit(False)).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0)) + raised).alias("score"),
    )


def described(gathered: DataFrame, counts: DataFrame, frequent: list[bytes], encoder: MergeEncoder, vocabulary: str, definition, texts: int) -> AttentionModel:
    """The model of the training texts before its weights are trained."""
    byte_of = {s: b for b, s in enumerate(encoder._symbols)}
    shown = [encoder.tokens.get(i, "") for i in range(encoder.size)]
    tokens = [t.encode() if t in encoder.special else bytes(byte_of[c] for c in t.removesuffix(END)) for t in shown]
    ends = np.array([t in encoder.special or t.endswith(END) for t in shown])
    ids, times, sums = id_company(gathered)
    seen = np.zeros(encoder.size, np.int64)
    seen[ids] = times
    model = AttentionModel(seen, tokens, ends)
    model.describe(ids, times, sums, frequent)
    plain = model.light()
    plain.tokens, plain.single = model.tokens, model.single
    shared = counts.sparkSession.sparkContext.broadcast(plain)
    facts = _word_facts(counts, vocabulary, definition, shared)
    shared.destroy()
    model.share(*[facts.column(c).to_numpy() for c in ("kind", "id", "n")])
    model.totals[0] = max(1, texts)  # the end is a class of its own
    return model
