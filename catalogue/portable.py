"""Result types that mean the same in every engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def portable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, integers as longs, dates, timestamps and arrays as text."""
    out = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            value = value.cast("double")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            value = value.cast("long")
        elif isinstance(kind, T.DateType):
            value = value.cast("string")
        elif isinstance(kind, T.TimestampType):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, T.ArrayType):
            value = F.array_join(value, ",")
        out.append(value.alias(field.name))
    return df.select(*out)
