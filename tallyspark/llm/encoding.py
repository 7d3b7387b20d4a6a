"""Token ids of texts and the texts that the ids decode to.

Nulls: a null text is empty and has no ids; a null id stays. Repeated rows each give a row.
Any text is encoded whole, in the order of its pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import PieceCache, TrieEncoder
from .common import as_table, on_worker, rows_of

_SCHEMAS = {
    "encode": "doc_id long, ids array<int>, decoded string",
    "digest": "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
}


def _run(docs: DataFrame, vocabulary: str, kind: str, id_col: str, text_col: str) -> DataFrame:
    with open(vocabulary, encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())

    def cache() -> PieceCache:
        encoder = TrieEncoder(definition.value)
        tokens = encoder.tokens
        return PieceCache(encoder, lambda ids: (" ".join(map(str, ids)), " ".join([tokens[i] for i in ids])))

    arrow = {"doc_id": pa.int64(), "n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}
    schema = pa.schema([(n, arrow.get(n, pa.string())) for n in [f.split()[0] for f in _SCHEMAS[kind].split(", ")]])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = on_worker(f"encoding {vocabulary}", cache)
        for keys, texts in rows_of(batches, "doc_id", "text", chunk=2000):
            out = []
            for key, values in zip(keys, known.values(t or "" for t in texts)):
                ids, decoded = (" ".join(part) for part in zip(*values)) if values else ("", "")
                if kind == "encode":
                    out.append((key, list(map(int, ids.split())), decoded))
                else:
                    out.append((key, ids.count(" ") + bool(ids), _sha256(ids), _sha256(decoded)))
            yield as_table(schema, list(zip(*out)))

    thin = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return thin.mapInArrow(encode, _SCHEMAS[kind])


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encode(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): a text's ids, and its tokens joined by spaces."""
    return _run(docs, vocabulary, "encode", id_col, text_col)


def encoding_digests(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of what ``encode`` returns, without sending it on."""
    return _run(docs, vocabulary, "digest", id_col, text_col)
