import public_tokenizers
from tokenizers import Tokenizer

from tallyspark.llm.common import ship_package
from tallyspark.llm.token_counts import token_counts

from .helpers import documents, empty

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def test_token_counts_equal_brute_force(spark):
    ship_package(spark)
    docs = documents(spark)
    library = Tokenizer.from_file(VOCABULARY)
    lengths = [len(library.encode(r["text"] or "", add_special_tokens=False).ids) for r in docs.collect()]
    rows = {r["length"]: r for r in token_counts(docs, VOCABULARY).collect()}
    assert set(rows) == set(lengths)
    for n, r in rows.items():
        assert r["documents"] == lengths.count(n) and r["tokens"] == n * lengths.count(n)
        assert r["reach"] == sum(x >= n for x in lengths)
        assert r["kept_tokens"] == sum(min(x, n) for x in lengths)
        assert r["quantile"] == sum(x <= n for x in lengths) / len(lengths)
        assert r["total_tokens"] == sum(lengths)
    assert token_counts(empty(spark), VOCABULARY).count() == 0
