import os
import re

import public_tokenizers
import pyarrow as pa
import pytest

from tallyspark.llm import common, packing, substrings

from .helpers import documents

ROLLUP = "/proc/self/smaps_rollup"


def own_mb():
    with open(ROLLUP) as file:
        return int(re.search(r"\nPss_Anon:\s+(\d+)", file.read())[1]) / 1024


@pytest.mark.skipif(not os.path.exists(ROLLUP), reason="memory can't be read here")
def test_forgotten_state_leaves_no_memory_behind():
    before = own_mb()
    # what another stage keeps lies between what stays in use
    held = common.on_worker("test", lambda: [bytes(1000) for _ in range(200_000)])
    stays = held[::200]
    del held
    assert own_mb() - before > 150
    common.forget()
    assert own_mb() - before < 50
    assert len(stays) == 1000 and not common._state


def held_by_workers(spark):
    def report(batches):
        for _ in batches:
            yield pa.RecordBatch.from_pydict({"key": pa.array(list(common._state), pa.string())})

    return {r["key"] for r in spark.range(64).repartition(64).mapInArrow(report, "key string").collect()}


def test_idle_workers_hold_nothing_of_packing_and_substrings(spark):
    common.ship_package(spark)
    docs = documents(spark).repartition(8)
    assert packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).count() >= 12
    assert not [k for k in held_by_workers(spark) if k.startswith("packing")]
    assert substrings.without_repeats(docs).count() == 12
    assert "powers" not in held_by_workers(spark)
