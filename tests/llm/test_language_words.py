"""The network of the language model scores words themselves, and regards all of a text before them."""

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tallyspark.llm import language_model, queries
from tallyspark.llm.common import ship_package

from .helpers import empty, words

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
STRIDE, CONTEXT, CLASSES, SINGLE = (getattr(language_model, n) for n in ("STRIDE", "CONTEXT", "CLASSES", "SINGLE"))


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


@pytest.fixture(scope="module")
def docs(spark):
    """Texts of three topics, a few words to some hundred; held-out ones have words that no training text has."""
    ship_package(spark)
    rng = np.random.default_rng(4)
    names = [[f"{a}{b}" for a in topic for b in ("", "er", "ing", "ström", "77", "'s.")] for topic in (["house", "garden"], ["river", "boat", "sail"], ["Q", "日本"])]
    rows = []
    for i in range(60):
        own = list(rng.choice(names[i % 3], rng.integers(1, 90))) + list(rng.choice(["the", "of", "and"], 9))
        rng.shuffle(own)
        if held(i):
            own[2:2] = [f"newword{i}", "neWworD", f"newword{i}"]
        rows.append((i, " ".join(own)))
    rows += [(None, "the boat zzz boat"), (60, None), (61, ""), (3, rows[3][1]), (1, "the the sail"), (62, "river " * 300)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def fitted(run, monkeypatch):
    """(trained model, rows) of a call."""
    found = []
    train = language_model._train
    monkeypatch.setattr(language_model, "_train", lambda model, *rest: (train(model, *rest), found.append(model)))
    rows = run().collect()
    monkeypatch.setattr(language_model, "_train", train)
    return found[0], rows


class Plain:
    """The model word by word, without windows in batches."""

    def __init__(self, model, rows):
        self.model, self.w = model, {k: v.astype(float) for k, v in model.weights.items()}
        self.encoder = language_model.MergeEncoder(open(VOCABULARY, encoding="utf-8").read())
        learned = [r["text"] for r in rows if r["doc_id"] is not None and not held(r["doc_id"])]
        self.counts = Counter(w.encode().lower() for t in learned for w in words(t))

    def ids(self, word):
        pieces = self.encoder.pieces(word.decode())
        found = self.encoder.encode(set(pieces))
        return [i for p in pieces for i in found[p]]

    def ends(self, word):
        ids = self.ids(word) or [len(self.model.counts)]
        return ids[0], ids[-1]

    def kind(self, word):
        ids = np.array(self.ids(word), np.int64)
        return int(self.model.classes([word], self.model.vectors(ids, np.array([len(ids)])))[0])

    def shades(self, word):
        first, last = self.ends(word)
        return self.model.shades[first].astype(float) * self.model.shades[last]

    def logits(self, x, i):
        row, w = i // STRIDE * STRIDE, self.w
        seen = x[max(0, row - CONTEXT) : i + 1]
        back = np.arange(len(seen))[::-1]
        a = np.exp(seen @ w["k"] @ (x[i] @ w["q"]) / math.sqrt(language_model.WIDTH) + w["near"][back])
        h = (a / a.sum()) @ seen @ w["v"]
        before = x[:row].sum(axis=0) / max(1, row - 1)  # the start is a row of zeros
        both = np.r_[x[i], h]
        return np.r_[both @ np.vstack([w["d"], w["o"]]) + w["b"], both @ w["shade"] + w["tint"]] + before @ w["past"]

    def score(self, text):
        model, line = self.model, [w.encode().lower() for w in words(text)]
        x = np.array([np.zeros(language_model.WIDTH), *((model.embedding[list(self.ends(w))].astype(float).sum(axis=0) / 2) for w in line)])
        total = 0.0
        for i in range(len(line) + 1):
            logits = self.logits(x, i)
            kind = self.kind(line[i]) if i < len(line) else 0
            total += logits[kind] - math.log(np.exp(logits[:CLASSES]).sum())
            if i == len(line):
                break
            word, light = line[i], np.exp(logits[CLASSES:])
            if word in self.counts:
                less = model.discount if kind >= SINGLE else 0
                total += math.log((self.counts[word] - less) / model.totals[kind])
                if kind >= SINGLE:
                    total += math.log(light @ self.shades(word) / (light @ model.mean_shades[kind]))
            else:
                ids = np.array(self.ids(word), np.int64)
                total += float(model.spelled([word], np.array([kind]), ids, np.array([len(ids)]))[0])
        return total / math.log(10)


@pytest.mark.parametrize("frequent", [language_model.FREQUENT, 20])  # most words through the join in the second run
def test_the_query_scores_words_by_the_network(spark, docs, monkeypatch, tmp_path, frequent):
    monkeypatch.setattr(language_model, "FREQUENT", frequent)
    docs.coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    model, found = fitted(lambda: queries.op6_language_model(spark, str(tmp_path)), monkeypatch)
    rows = docs.collect()
    plain = Plain(model, rows)
    assert np.abs(model.weights["shade"]).max() > 0 and np.abs(model.weights["past"]).max() > 0
    want = sorted((str(r["doc_id"]), plain.score(r["text"])) for r in rows)
    got = sorted((str(r["doc_id"]), r["score"]) for r in found)
    assert [x[0] for x in got] == [x[0] for x in want]
    assert [x[1] for x in got] == pytest.approx([x[1] for x in want], rel=1e-4, abs=1e-3)
    assert language_model.language_scores(empty(spark), VOCABULARY, whole=True).count() == 0


def test_words_of_a_class_add_up_to_one(spark, docs, monkeypatch):
    model, _ = fitted(lambda: language_model.language_scores(docs, VOCABULARY, whole=True), monkeypatch)
    plain = Plain(model, docs.collect())
    by_class = {}
    for word in plain.counts:
        by_class.setdefault(plain.kind(word), []).append(word)
    several = [(kind, own) for kind, own in by_class.items() if kind >= SINGLE]
    assert any(len(own) > 2 for _, own in several)
    for seed, (kind, own) in enumerate(several):
        light = np.exp(np.random.default_rng(seed).normal(size=language_model.SHADES) * 3)
        raised = np.array([light @ plain.shades(w) / (light @ model.mean_shades[kind]) for w in own])
        shares = np.array([plain.counts[w] - model.discount for w in own]) / model.totals[kind]
        left = model.discount * model.kinds_of_words[kind] / model.totals[kind]
        assert shares @ raised + left == pytest.approx(1)
        assert len(own) == 1 or np.ptp(raised) > 1e-3  # each word has a score of its own


def network(rng, size=300):
    model = language_model.AttentionModel(np.ones(size, np.int64), [b""] * size, np.zeros(size, bool))
    model.embedding[:size] = rng.normal(size=(size, language_model.WIDTH))
    model.shades[:size] = np.exp(0.4 * rng.normal(size=(size, language_model.SHADES)))
    model.prepare(whole=True)
    for n, w in model.weights.items():
        model.weights[n] = (w + 0.2 * rng.normal(size=w.shape)).astype(np.float32)
    return model


def test_a_word_far_before_counts():
    rng = np.random.default_rng(6)
    model = network(rng)
    line = np.vstack([rng.integers(0, 300, (2, 100)), rng.integers(SINGLE, CLASSES, 100)])
    other = line.copy()
    other[:2, 0] = (line[:2, 0] + 7) % 300
    (log,), raised, _ = model.logs([line])
    (log_of_other,), raised_of_other, _ = model.logs([other])
    place = 5 * STRIDE  # the window's words begin long after the first one
    assert log != pytest.approx(log_of_other, rel=1e-7)
    assert np.abs(raised - raised_of_other)[place:100].min() > 0
    # and none that follows does
    other = line.copy()
    other[:2, 90] = (line[:2, 90] + 7) % 300
    assert np.array_equal(model.logs([other])[1][:90], raised[:90]) and not np.array_equal(model.logs([other])[1], raised)


def test_slopes_are_those_of_the_loss():
    rng = np.random.default_rng(7)
    model = network(rng)
    model.mean_shades = np.exp(0.2 * rng.normal(size=(CLASSES, language_model.SHADES)))
    model.embedding, model.shades = model.embedding.astype(float), model.shades.astype(float)
    model.weights = {n: w.astype(float) for n, w in model.weights.items()}
    lines = [np.vstack([rng.integers(0, 300, (2, n)), rng.integers(1, CLASSES, n)]) for n in (0, 3, 40)]
    codes, goals, lengths = language_model.windows_of(lines, 300)
    past, shades = model.past(codes, lengths), model.shades_of(*language_model.following(codes).reshape(2, -1))
    x, gone, goal = model.inputs(codes), codes[:, 0] > 300, goals.ravel()
    which = np.flatnonzero(goal >= SINGLE)

    def loss():
        made = model.forward(x, gone, past)
        logits, light = made["logits"], np.exp(made["shades"][which])
        logs = logits[np.arange(len(goal)), goal] - np.log(np.exp(logits).sum(axis=1))
        by_word = np.log((light * shades[which]).sum(axis=1) / (light * model.mean_shades[goal[which]]).sum(axis=1))
        return -(logs[goal >= 0].sum() + by_word.sum()) / (goal >= 0).sum()

    slopes = model.slopes(x, gone, goals, past, shades)
    assert set(slopes) == set(model.weights)
    for name, w in model.weights.items():
        flat = w.reshape(-1)
        for at in rng.choice(flat.size, min(8, flat.size), replace=False):
            held_ = flat[at]
            flat[at] = held_ + 1e-5
            up = loss()
            flat[at] = held_ - 1e-5
            down = loss()
            flat[at] = held_
            assert slopes[name].reshape(-1)[at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-6), (name, at)


def test_training_raises_the_words_that_fit_the_text():
    rng = np.random.default_rng(8)
    model = network(rng)
    model.prepare(whole=True)
    model.embedding[:150, 0], model.embedding[150:300, 0] = 2, -2
    model.shades[:300] = np.exp(0.4 * model.embedding[:300])
    model.mean_shades[SINGLE:] = np.square(model.shades[:300]).mean(axis=0)

    def texts(n):  # each with words of one half, whose classes are alike
        ids = [rng.integers(0, 150, 60) + 150 * rng.integers(0, 2) for _ in range(n)]
        return [np.vstack([i, i, rng.integers(SINGLE, CLASSES, 60)]) for i in ids]

    for _ in range(6):
        codes, goals, lengths = language_model.windows_of(texts(100), 300)
        batch = (model.inputs(codes), codes[:, 0] > 300, goals, model.past(codes, lengths), model.shades_of(*language_model.following(codes).reshape(2, -1)))
        model.train(iter([batch] * 20), 0.05)
    raised = model.logs(texts(50))[1].reshape(50, -1)
    assert raised[:, 1:60].mean() > 0.3  # up to log 2
