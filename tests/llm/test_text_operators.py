import bisect
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyspark.llm import encoding, packing, simhash, substrings
from tallyspark.llm.bpe import MergeEncoder, PieceCache, TrieEncoder
from tallyspark.llm.common import ship_package

from .helpers import documents, empty, words

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def encoders():
    definition = open(VOCABULARY, encoding="utf-8").read()
    return [kind(definition) for kind in (TrieEncoder, MergeEncoder)]


def ids_of(encoder, text):
    return [i for v in next(PieceCache(encoder, tuple).values([text])) for i in v]


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8", max_codepoint=0x2FF), st.sampled_from("aeinrst' <|>Σσé")), max_size=40))
def test_encoders_equal_the_library(library, encoders, text):
    want = library.encode(text, add_special_tokens=False).ids
    assert [ids_of(e, text) for e in encoders] == [want, want]


def test_encoding_and_decoding(spark, library):
    docs = documents(spark)
    rows = encoding.encode(docs, VOCABULARY).collect()
    texts = [r["text"] or "" for r in docs.collect()]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [r["ids"] for r in rows] == want
    assert [r["decoded"] for r in rows] == [library.decode(i, skip_special_tokens=False) for i in want]
    digests = encoding.encoding_digests(docs, VOCABULARY).collect()
    assert [r["ids_sha256"] for r in digests] == [hashlib.sha256(" ".join(map(str, i)).encode()).hexdigest() for i in want]
    assert encoding.encode(empty(spark), VOCABULARY).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_plan_is_gapless_and_tight(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([1, 7, 64, 100, rng.randint(1, 100)]) for _ in range(3000)]
    counts = {n: lengths.count(n) for n in set(lengths)}
    filled = {}
    for length, first, last, each, start, offset in packing.plan_slots(counts.items(), 100):
        for rank in range(first, last + 1):
            inside = rank - first
            filled.setdefault(start + inside // each, []).append((offset + inside % each * length, length))
    assert sum(map(len, filled.values())) == len(lengths)
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 100
    rooms = []  # best fit, one piece after another
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, length)
        bisect.insort(rooms, (rooms.pop(at) if at < len(rooms) else 100) - length)
    assert len(filled) == len(rooms)


def test_packing(spark, library):
    docs = documents(spark)
    rows = packing.pack(docs, VOCABULARY, capacity=64).collect()
    want = []
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        want += [(r["doc_id"], k, i, zlib.crc32(np.array(ids[i : i + 64], "<u4").tobytes())) for k, i in enumerate(range(0, len(ids), 64))]
    key = lambda x: (x[0] is None, x)
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["ids_crc32"]) for r in rows), key=str) == sorted(want, key=str)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(empty(spark), VOCABULARY).count() == 0


def print_of(text):
    w = [x for x in (text or "").encode().lower().split()]
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(prints):
    """The least reachable id of each (id, print), by search over all pairs."""
    root = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, (_, a) in enumerate(prints):
            for j, (_, b) in enumerate(prints):
                if (a ^ b).bit_count() <= 2 and root[i] != root[j]:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    return [min((p[0] for p, r in zip(prints, root) if r == own and p[0] is not None), default=None) for own in root]


def test_simhash_components(spark):
    docs = documents(spark)
    prints = [(r["doc_id"], print_of(r["text"])) for r in docs.collect()]
    want = sorted((str(i), f"{p:016x}", c) for (i, p), c in zip(prints, components(prints)))
    rows = simhash.near_duplicates(docs).collect()
    assert sorted((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in rows) == want
    assert simhash.near_duplicates(empty(spark)).count() == 0
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"]) == sorted({c for (i, _), c in zip(prints, components(prints)) if c})


@pytest.mark.parametrize("crowd", [1, 4, 256])
def test_links_of_crowded_keys(spark, crowd):
    rng = random.Random(3)
    values = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(12):
            v = centre
            for _ in range(rng.randint(0, 4)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    links = simhash.near_pairs(frame, crowd=crowd).collect()
    place = {v: i for i, v in enumerate(signed)}
    assert all((values[place[r["a"]]] ^ values[place[r["b"]]]).bit_count() <= 2 for r in links)
    root = list(range(len(values)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for r in links:
        a, b = top(place[r["a"]]), top(place[r["b"]])
        root[max(a, b)] = min(a, b)
    assert [values[top(i)] for i in range(len(values))] == [values[c] for c in components([(i, v) for i, v in enumerate(values)])]


def stripped(rows):
    """(n_words, n_removed, kept) of each row by the words themselves."""
    first = {}
    for i, text in rows:
        w = words(text)
        for k in range(len(w) - 12) if i is not None else ():
            gram = tuple(w[k : k + 13])
            first[gram] = min(i, first.get(gram, i))
    out = []
    for i, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if i is not None and first[tuple(w[k : k + 13])] < i:
                gone[k : k + 13] = [True] * 13
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


@pytest.mark.parametrize("width", [1 << 20, 500])
def test_repeated_passages(spark, monkeypatch, width):
    monkeypatch.setattr(substrings, "BATCH_BYTES", width)
    docs = documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = sorted((str(i), *r) for (i, _), r in zip(rows, stripped(rows)))
    got = substrings.without_repeats(docs).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept"]) for r in got) == want
    assert substrings.strip_repeats(docs).columns == docs.columns
    assert substrings.without_repeats(empty(spark)).count() == 0


def test_long_text_in_segments(monkeypatch):
    text = " ".join(f"w{i % 37}" for i in range(3000))
    whole = substrings.Passage([text.encode().split()]).hashes(13)
    windows = np.sort(whole[100:140].view(np.int64))
    want = substrings.stripped(text, windows, 13)
    monkeypatch.setattr(substrings, "BATCH_BYTES", 300)
    assert substrings.stripped(text, windows, 13) == want


def test_each_component_keeps_one_row(spark):
    x, y, z = ("alpha beta gamma delta epsilon", "one two three four five six", "red green blue black white")
    rows = [(5, x), (5, y), (3, y), (7, x), (None, z), (None, z), (None, x), (9, "last words here now"), (9, "last words here now")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = simhash.representatives(frame).collect()
    want = [(3, y), (5, x), (9, "last words here now"), (None, z)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_only_rows_of_repeated_ids_are_hashed_again(spark, tmp_path):
    rows = [(i, f"word{i} of{i * 7} text{i * i} number{i}") for i in range(20)] + [(3, "another text of three"), (None, "lost words here")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    kept = simhash.representatives(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    assert kept.count() == 22
    # what is read of the documents is joined by id only; hashes are of staged rows
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and plan.count("documents.parquet") == 1


def thue_morse(size, first, second):
    return "".join((first, second)[i.bit_count() % 2] for i in range(size))


@pytest.mark.parametrize("size", [512, 1024, 4096, 1 << 16])
def test_words_that_collide_as_polynomials_of_a_power_of_two(spark, size):
    twelve = " ".join(f"w{i}" for i in range(12))
    a, b = thue_morse(size, "x", "y"), thue_morse(size, "y", "x")
    docs = spark.createDataFrame([(1, f"{twelve} {a} one"), (2, f"{twelve} {b} two"), (3, f"{twelve} {a} three")], "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in substrings.without_repeats(docs).collect()}
    assert got == {1: 0, 2: 0, 3: 13}


@given(st.lists(st.text("ab", min_size=1, max_size=4), min_size=1, max_size=40), st.integers(1, 14))
@settings(max_examples=200, deadline=None)
def test_window_hashes_tell_windows_apart(words_, size):
    passage = substrings.Passage([[w.encode() for w in words_]])
    windows = [tuple(words_[i : i + size]) for i in range(max(0, len(words_) - size + 1))]
    for which in (0, 1):
        hashes = passage.hashes(size, which).tolist()
        assert len(hashes) == len(windows)
        assert len(set(zip(windows, hashes))) == len(set(windows)) == len(set(hashes))
