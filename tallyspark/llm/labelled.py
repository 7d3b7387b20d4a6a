"""Bounded samples of labelled rows, on which classifiers are fitted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remainder


def labelled_sample(labels: DataFrame, target: str, divisor: int, held_out: int, rows: int, id_col: str) -> DataFrame:
    """(doc_id, y) of at most ``rows`` ids to learn from, picked by a hash of the id.

    Ids whose remainder is ``held_out``, null ids and null labels are left out; of several
    labels of one id the largest counts.
    """
    key = F.col(id_col).cast("long")
    return (
        labels.filter(key.isNotNull() & F.col(target).isNotNull() & (remainder(key, divisor) != held_out))
        .groupBy(key.alias("doc_id"))
        .agg(F.max(F.col(target)).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
