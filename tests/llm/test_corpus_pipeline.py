"""Each stage of the corpus pipeline, on its own input, against the operator's decisions row by row."""

from collections import Counter

import pytest

import corpus_pipeline
from tallyspark.llm import packing, quality, simhash, substrings, toxicity
from tallyspark.llm.common import ship_package
from tallyspark.llm.queries import VOCABULARY, public_tokenizers

from .helpers import documents, empty

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Forty good and forty bad texts, twenty toxic ones, near copies, and the awkward rows of the helpers."""
    folder = str(tmp_path_factory.mktemp("tables"))
    good = [f"The committee of town {i} met in the old hall and spoke about roads, water and schools for some time." for i in range(40)]
    bad = [f"BUY {i} $$$ ### cheap!!! |||| {i * 7} %%% @@@ click" for i in range(40)]
    toxic = [f"You are a grumbax and a zorkel, said man {i}, and he left the hall at once without a further word." for i in range(20)]
    texts = [*good, *bad, *toxic]
    rows = [(100 + i, t, 5, "x", 7) for i, t in enumerate(texts)] + [(300, good[0], 5, "x", 7), (301, good[0], 5, "x", 7)]
    docs = documents(spark).unionByName(spark.createDataFrame(rows, documents(spark).schema))
    labels = [(100 + i, int(i < 40 or i >= 80), int(i >= 80)) for i in range(100)]
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def counted(rows, *names):
    return Counter(tuple(r[n] for n in names) for r in rows)


def test_filters_take_out_what_the_operators_reject(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    for name, score, keeps in (("quality", quality.quality_scores, 1), ("toxicity", toxicity.toxicity_scores, 0)):
        kept = STAGES[name](spark, docs, sf_dir)
        assert kept.columns == docs.columns
        decided = counted(score(docs, labels).filter(f"predicted = {keeps}").collect(), "doc_id")
        assert counted(kept.collect(), "doc_id") == decided
        ids = {r["doc_id"] for r in kept.collect()}
        wanted = set(range(100, 140)) if name == "quality" else set(range(100, 180))
        assert wanted <= ids and not ids & (set(range(140, 180)) if name == "quality" else set(range(180, 200)))


def test_one_document_of_each_group_stays(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = STAGES["near_duplicates"](spark, docs, sf_dir)
    assert kept.columns == docs.columns
    groups = simhash.near_duplicates(docs).collect()
    rows = kept.collect()
    assert len(rows) == len({r["component_id"] for r in groups if r["doc_id"] is not None} | {None} & {r["component_id"] for r in groups})
    assert {r["component_id"] for r in groups if r["component_id"] is not None} <= {r["doc_id"] for r in rows}


def test_passages_are_taken_out_and_other_texts_stay(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("doc_id != 7")
    kept = STAGES["repeated_passages"](spark, docs, sf_dir)
    assert kept.columns == docs.columns
    stripped = {r["doc_id"]: r for r in substrings.without_repeats(docs).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert got == {i: stripped[i]["kept"] if stripped[i]["n_removed"] else t for i, t in texts.items()}


def test_run_packs_what_is_left(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, sf_dir), name)
    names = ("doc_id", "piece", "start", "length", "ids_crc32")
    want = counted(packing.pack(docs, public_tokenizers.path(VOCABULARY)).collect(), *names)
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert counted(got, *names) == want and len({r["doc_id"] for r in got}) >= 30


@pytest.mark.parametrize("name", list(STAGES))
def test_empty_tables(spark, sf_dir, name):
    assert STAGES[name](spark, empty(spark), sf_dir).count() == 0
