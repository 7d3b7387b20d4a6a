import math
import os
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import language_model, quality, toxicity
from tallyspark.llm.common import ship_package

from .helpers import documents, empty, words

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01").replace("sf0.001", "sf0.01")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.mark.parametrize("score, target, least", [(quality.quality_scores, "quality", 0.97), (toxicity.toxicity_scores, "toxic", 0.92)])
@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
def test_held_out_accuracy(spark, score, target, least):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{n}.parquet") for n in ("documents", "labels"))
    rows = score(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert sum(r["predicted"] == r[target] for r in rows) / len(rows) >= least
    assert all(0 <= r["score"] <= 1 for r in rows)


@pytest.mark.parametrize("score", [quality.quality_scores, toxicity.toxicity_scores])
def test_awkward_rows_and_no_labels(spark, score):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, None, None), (None, 1, 1), (6, 1, 0), (10, 0, 1)], "doc_id long, quality int, toxic int")
    for given in (labels, labels.limit(0)):
        assert score(docs, given).count() == docs.count()
    assert score(empty(spark), labels).count() == 0


def test_base_scores(spark):
    docs = documents(spark)
    rows = docs.collect()
    lower = [[w.encode().lower() for w in words(r["text"])] for r in rows]
    held = [r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1 for r in rows]
    counts = Counter(w for r, ws, h in zip(rows, lower, held) if r["doc_id"] is not None and not h for w in [*ws, b""])
    total, kinds = sum(counts.values()), len(counts)
    base = [sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in [*ws, b""]) for ws in lower]
    for frequent in (language_model.FREQUENT, 3):  # most words through the join in the second run
        language_model.FREQUENT, before = frequent, language_model.FREQUENT
        try:
            got = language_model.language_scores(docs, VOCABULARY).collect()
        finally:
            language_model.FREQUENT = before
        key = lambda x: (str(x[0]), x[2], x[3])
        want = sorted(((r["doc_id"], h, len(ws) + 1, sum(w in counts for w in ws) + 1, b) for r, h, ws, b in zip(rows, held, lower, base)), key=key)
        have = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["base_score"]) for r in got), key=key)
        assert [x[:4] for x in have] == [x[:4] for x in want]
        assert [x[4] for x in have] == pytest.approx([x[4] for x in want])
        assert all(r["train_tokens"] == total and r["score"] < 0 for r in got)
    assert language_model.language_scores(empty(spark), VOCABULARY).count() == 0


def test_scores_know_all_training_words(spark, monkeypatch):
    docs = documents(spark)
    key = lambda r: (str(r["doc_id"]), r["n_tokens"], r["n_known"])
    want = sorted(language_model.language_scores(docs, VOCABULARY).collect(), key=key)
    monkeypatch.setattr(language_model, "FREQUENT", language_model.SINGLE)
    got = sorted(language_model.language_scores(docs, VOCABULARY).collect(), key=key)
    assert [r["score"] for r in got] == pytest.approx([r["score"] for r in want], rel=1e-9)


def test_windows_hold_every_word_once():
    rng = np.random.default_rng(2)
    size = 400
    lines = [rng.integers(0, size, (3, n)).astype(np.uint16) for n in [0, 1, 15, 16, 17, 31, 32, 40, 5000, 0]]
    codes, goals, lengths = language_model.windows_of(lines, size)
    row = 0
    for line, length in zip(lines, lengths.tolist()):
        words_, want = [[size, size], *line[:2].T.tolist()], [*line[2].tolist(), 0]
        assert length == len(want)
        for at in range(0, length, language_model.STRIDE):
            before = words_[max(0, at - language_model.CONTEXT) : at]
            part = words_[at : at + language_model.STRIDE]
            none = [[size + 1] * 2]
            held = none * (language_model.CONTEXT - len(before)) + before + part + none * (language_model.STRIDE - len(part))
            assert codes[row].T.tolist() == held
            goal = want[at : at + language_model.STRIDE]
            assert goals[row].tolist() == goal + [-1] * (language_model.STRIDE - len(goal))
            row += 1
    assert row == len(goals)


def spans(encoder, word):
    found = encoder.encode(set(encoder.pieces(word.decode())))
    return [i for p in encoder.pieces(word.decode()) for i in found[p]]


def fit_model(spark, docs, monkeypatch):
    """The trained model that a call of ``language_scores`` uses, its rows, counts by word, and the encoder."""
    held = []
    train = language_model._train
    monkeypatch.setattr(language_model, "_train", lambda model, *rest: (train(model, *rest), held.append(model)))
    rows = language_model.language_scores(docs, VOCABULARY).collect()
    learned = [r["text"] for r in docs.collect() if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 != 1]
    counts = Counter(w.encode().lower() for t in learned for w in words(t)) + Counter({b"": len(learned)})
    return held[0], rows, counts, language_model.MergeEncoder(open(VOCABULARY, encoding="utf-8").read())


def plain_score(model, counts, encoder, words):
    """The log10 probability of a text, word by word, without windows in batches."""
    def vector(word):
        ids = spans(encoder, word) or [len(model.counts)]
        return (model.embedding[ids[0]].astype(float) + model.embedding[ids[-1]]) / 2

    x = [np.zeros(language_model.WIDTH), *map(vector, words)]
    total = 0.0
    for i in range(len(words) + 1):
        begin = max(0, i // language_model.STRIDE * language_model.STRIDE - language_model.CONTEXT)
        seen = np.array(x[begin : i + 1], float)
        back = i - np.arange(begin, i + 1)
        w = {k: v.astype(float) for k, v in model.weights.items()}
        a = np.exp(seen @ w["k"] @ (x[i] @ w["q"]) / math.sqrt(language_model.WIDTH) + w["near"][back])
        logits = x[i] @ w["d"] + (a / a.sum()) @ seen @ w["v"] @ w["o"] + w["b"]
        word = words[i] if i < len(words) else b""
        kind = model.single.get(word)
        if kind is None:
            ids = np.array(spans(encoder, word), np.int64)
            kind = int(model.classes([word], model.vectors(ids, np.array([len(ids)])))[0])
        total += logits[kind] - math.log(np.exp(logits).sum())
        if word in counts:
            total += math.log((counts[word] - (model.discount if kind >= language_model.SINGLE else 0)) / model.totals[kind])
        else:
            total += math.log(model.discount * model.kinds_of_words[kind] / model.totals[kind])
            ids, before = [*spans(encoder, word), len(model.counts)], kind
            for i_ in ids:
                total += float(model.spelling[before, i_])
                before = model.kind_of[min(i_, len(model.counts) - 1)]
            exact = b"".join(model.tokens[i_] for i_ in ids[:-1]) == word
            total += math.log(model.exact) if exact else math.log(1 - model.exact) - (len(word) + 1) * math.log(257)
    return total / math.log(10)


def test_scores_equal_the_model_word_by_word(spark, monkeypatch):
    docs = documents(spark)
    model, rows, counts, encoder = fit_model(spark, docs, monkeypatch)
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], []).append(r["score"])
    short = [(r["doc_id"], r["text"]) for r in docs.collect() if len(r["text"] or "") < 2000]
    for doc_id, text in short:
        want = plain_score(model, counts, encoder, [w.encode().lower() for w in words(text)])
        assert any(s == pytest.approx(want, rel=1e-4, abs=1e-3) for s in got[doc_id]), (doc_id, want, got[doc_id])


def test_words_are_encoded_as_the_encoder_does():
    definition = open(VOCABULARY, encoding="utf-8").read()
    known = language_model.Company(definition)
    encoder = known.encoder
    for word in ["abc", "abc.", "éà,", ".", ",", "..", "İx", "ßa", "ſ", "a1", "don't", "ΣΑΣ", "日本", "\u00a0", "e\u0301", "x<|endoftext|>", "ǆ.", "ʼn"]:
        assert known._ids(word.encode()) == spans(encoder, word.encode()), word


def test_signs_after_letters_are_encoded_as_the_encoder_does():
    known = language_model.Company(open(VOCABULARY, encoding="utf-8").read())
    signs = [chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum()]
    for core in ["abc", "", "é", "ab1", "日", "abc's", "e\u0301"]:
        for tail in [*signs, "$$$", "...", "'s", "'s.", ".'s", "<|", "|>", "<|endoftext|>", "_a_", "!'", "\x01", "\x7f"]:
            word = (core + tail).encode()
            assert known._ids(word) == spans(known.encoder, word), word


def test_words_encoded_together_are_as_the_encoder_has_them():
    known = language_model.Company(open(VOCABULARY, encoding="utf-8").read())
    rng = np.random.default_rng(5)
    signs = [chr(c) for c in [*range(1, 9), *range(0x0E, 0x20), *range(0x21, 0x260), 0x307, 0x3A3, 0x2003, 0x65E5, 0x1F600]]
    found = ["".join(rng.choice(signs, n)) for n in rng.integers(1, 7, 3000)] + signs + ["<|endoftext|>", "it's", "ab\x01c", "e\u0301a"]
    given = [w.encode() for w in found] + [b"the", b"an.", b"12", b"x$$$"] * 3
    flat, sizes = known.encoded(given)
    assert [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])] == [spans(known.encoder, w) for w in given]
    assert not sum(map(len, known.encoded([])))


def test_texts_read_together_look_up_each_word_once(monkeypatch):
    known = language_model.Company(open(VOCABULARY, encoding="utf-8").read())
    asked = []
    numbers = language_model.Words.numbers
    monkeypatch.setattr(language_model.Words, "numbers", lambda self, words: (asked.extend(words), numbers(self, words))[1])
    texts = ["B a\u00a0b b  a", None, "", " \t\n\v\f\r ", "\x00 \x1c\x1d x\x85y É\u2003é\x1f a ", "a B\u0130 \ta " * 500, "Z"]
    want = [[w for part in language_model.words_of(t) for w in part] for t in texts]
    got = known.read(texts)
    assert [[known.words[i] for i in line.tolist()] for line in got] == want
    assert len(asked) == len(set(asked)) == len({w for line in want for w in line})
    monkeypatch.setattr(language_model, "CHUNK_CHARS", 20)  # long texts, slice by slice, between short ones
    assert [[known.words[i] for i in line.tolist()] for line in known.read(texts)] == want
    assert known.read([]) == []


def test_shares_of_a_class_add_up_to_one(spark, monkeypatch):
    model, _, counts, encoder = fit_model(spark, documents(spark), monkeypatch)
    by_class = {}
    for word, c in counts.items():
        ids = np.array(spans(encoder, word), np.int64)
        kind = int(model.classes([word], model.vectors(ids, np.array([len(ids)])))[0])
        by_class.setdefault(kind, []).append(c)
    for kind, c in by_class.items():
        known = np.exp(model.known(np.array(c), np.full(len(c), kind))).sum()
        left = 0 if kind < language_model.SINGLE else model.discount * model.kinds_of_words[kind] / model.totals[kind]
        assert known + left == pytest.approx(1)
    assert np.exp(model.spelling.astype(float)).sum(axis=1) == pytest.approx(np.ones(len(model.spelling)))


def test_company_covers_all_training_words(spark):
    rng = np.random.default_rng(3)
    names = [f"word{i} it's"[: rng.integers(2, 9)] for i in range(60)]
    texts = [" ".join(rng.choice(names, n)) for n in [1, 5, 64, 65, 300, 3000]]
    docs = spark.createDataFrame([(t,) for t in [*texts, None, ""]], "text string")
    text = open(VOCABULARY, encoding="utf-8").read()
    encoder = language_model.MergeEncoder(text)
    gathered = language_model.gather(docs, VOCABULARY, spark.sparkContext.broadcast(text), encoder.size).persist()
    ids, times, sums = language_model.id_company(gathered)
    found = {r["word"]: r["c"] for r in language_model.word_counts(gathered).collect()}
    assert found == Counter(w for t in texts for w in t.split()) + Counter({"": len(texts) + 2})
    directions = np.random.default_rng(11).normal(size=(encoder.size + 1, language_model.DIRECTIONS))
    want, seen = {}, Counter()
    for t in texts:
        line = [w.encode() for w in t.split()]
        for at in range(0, len(line), language_model.STRETCH):
            part = [spans(encoder, w) for w in line[at : at + language_model.STRETCH]]
            whole = sum(directions[p[0]] for p in part)
            for p in part:
                for i in p:
                    want[i] = want.get(i, 0) + (whole - directions[p[0]]) / max(1, len(part) - 1)
                    seen[i] += 1
    assert dict(zip(ids.tolist(), times.tolist())) == dict(seen)
    assert sums == pytest.approx(np.array([want[i] for i in ids.tolist()]), abs=1e-2)


def test_rare_toxic_words_vote(spark):
    texts = [f"filler text {i}" if i % 3 else f"grumbax number {i}" for i in range(6000)]
    texts = [f"zorkel thing {i}" if i % 600 == 1 else t for i, t in enumerate(texts)]  # ten of 2010 toxic rows
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int("filler" not in t)) for i, t in enumerate(texts)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert any(p.startswith("zor") for p in model.patterns) and any(p.startswith("gru") for p in model.patterns)


def test_weights_are_trained_in_one_row():
    model = language_model.AttentionModel(np.ones(5, np.int64), [b""] * 5, np.zeros(5, bool))
    model.prepare()
    before = {n: w.copy() for n, w in model.weights.items()}
    codes, goals, _ = language_model.windows_of([np.array([[1, 2, 3], [1, 2, 3], [4, 5, 6]])], 5)
    model.embedding[:] = 1
    assert model.train(iter([(model.inputs(codes), codes[:, 0] > 5, goals)]), 0.1) == len(goals)
    assert all(w.shape == before[n].shape and not np.array_equal(w, before[n]) for n, w in model.weights.items() if n in "do")
    assert len({w.__array_interface__["data"][0] - w.base.__array_interface__["data"][0] for w in model.weights.values()}) == len(before)
