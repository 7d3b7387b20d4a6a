"""Records that were collected more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RECORD_KEY = ("source", "resource_type", "resource_id")


def newest_records(records: DataFrame) -> DataFrame:
    """One record for each source, resource type and resource id: that of the newest collection.

    Overlapping collections land the same bill, query or run again; here its last state counts.
    Of records collected at one time the greatest by the other columns, in their order, is taken
    (null is least), so the result does not depend on the order of rows. Records without an id
    cannot be told apart and all stay, out of the shuffle. The maximum is taken before the
    shuffle too: a record that is landed often sends one row from each task.
    """
    rest = [c for c in records.columns if c not in (*RECORD_KEY, "ingested_at")]
    state = F.struct("ingested_at", *rest)
    identified = records.filter(F.col("resource_id").isNotNull())
    newest = identified.groupBy(*RECORD_KEY).agg(F.max(state).alias("__state"))
    fields = {c: F.col(c) if c in RECORD_KEY else F.col(f"__state.{c}") for c in records.columns}
    return newest.select(*[c.alias(name) for name, c in fields.items()]).unionByName(
        records.filter(F.col("resource_id").isNull())
    )
