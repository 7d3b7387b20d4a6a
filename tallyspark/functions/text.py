"""Text, JSON and number-format expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import CONSOLE_PREFIXES, QUERY_PREVIEW_CHARS

MISSING = "—"  # shown for a value that is not there


def metadata_field(df: DataFrame, key: str, as_double: bool = False) -> Column:
    """One key of the ``raw_metadata`` JSON text, or null when it is absent.

    For one or two keys. :func:`metadata_struct` parses the text once for many keys.
    """
    value = F.get_json_object(F.col("raw_metadata"), f"$.{key}")
    return value.try_cast("double") if as_double else value


def metadata_struct(keys: Iterable[str], column: str = "raw_metadata") -> Column:
    """The named top-level keys as a struct of strings, from one parse of the text.

    Select it as a column of its own and its fields in a later step: Catalyst then
    parses once per row, and narrows the parse when only one field is used.
    """
    return F.from_json(F.col(column), ", ".join(f"`{k}` string" for k in keys))


def json_or_empty(column: str = "raw_metadata") -> Column:
    """JSON text as a variant; text that is null or cannot be parsed gives ``{}``."""
    return F.coalesce(F.try_parse_json(F.col(column)), F.parse_json(F.lit("{}")))


def tested_once(value: Column, condition: Callable[[Column], Column]) -> Column:
    """A condition on an expression that is evaluated once however often it is named.

    Catalyst moves a filter below the projection it refers to and repeats the projected
    expression at every mention; a test of twelve prefixes would parse JSON twelve times.
    """
    return F.exists(F.array(value), condition)


def with_query_text(queries: DataFrame) -> DataFrame:
    """``queries``, with the preview as ``query_text`` where the table has no such column."""
    if "query_text" not in queries.columns:
        return queries.withColumn("query_text", F.col("query_text_preview"))
    return queries


def text_identity(text: Column) -> dict[str, Column]:
    """A short preview and a digest, which as keys stand for a whole text of any length."""
    return {"query_text_preview": F.substring(text, 1, QUERY_PREVIEW_CHARS), "text_digest": F.unhex(F.sha2(text, 256))}


def starts_with_any(text: Column, prefixes: Iterable[str]) -> Column:
    """True when the text starts with one of the prefixes (null text gives null)."""
    test = F.lit(False)
    for prefix in prefixes:
        test = test | text.startswith(prefix)
    return test


def is_console_statement(text: Column, prefixes: Iterable[str] = CONSOLE_PREFIXES) -> Column:
    """Statements that a web console issues by itself, not workload."""
    return starts_with_any(text, prefixes)


def clip(text: Column, size: int, tail: str = "...") -> Column:
    """The first ``size`` characters, with ``tail`` appended when something was cut."""
    return F.when(F.length(text) > size, F.concat(F.substring(text, 1, size), F.lit(tail))).otherwise(text)


def title_words(text: Column) -> Column:
    """``warehouse_metering`` -> ``Warehouse Metering``."""
    return F.initcap(F.replace(text, F.lit("_"), F.lit(" ")))


def shown_number(value: Column, decimals: int) -> Column:
    """Number as text with a fixed count of decimals, null-safe inside ``concat``."""
    return F.coalesce(F.format_string(f"%.{decimals}f", value.cast("double")), F.lit("unknown"))


def shown_text(value: Column, default: str = "unknown") -> Column:
    """Text for use inside ``concat``, which is null as soon as one part is null."""
    return F.coalesce(value.cast("string"), F.lit(default))


def _present(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value)


def format_usd(value: Column, max_decimals: int = 10) -> Column:
    """Money for display: two decimals from one dollar up, else every significant digit.

    Digits beyond ``max_decimals`` are rounded half up in the number's shortest decimal form.
    """
    value = value.cast("double")
    small = F.rtrim(F.format_string(f"%.{max_decimals}f", value), F.lit("0"))
    return (
        F.when(~_present(value) | value.isNull(), F.lit(MISSING))
        .when(value == 0, F.lit("$0.00"))
        .when(F.abs(value) >= 1, F.concat(F.lit("$"), F.format_number(value, 2)))
        .otherwise(F.concat(F.lit("$"), F.when(small.endswith("."), F.concat(small, F.lit("0"))).otherwise(small)))
    )


def format_count(value: Column, decimals: int = 2) -> Column:
    """Number for display: thousands separators, at most ``decimals`` decimals."""
    value = value.cast("double")
    fixed = F.format_number(value, decimals)
    short = F.rtrim(F.rtrim(fixed, F.lit("0")), F.lit(".")) if decimals else fixed
    return F.when(~_present(value) | value.isNull(), F.lit(MISSING)).otherwise(short)


def format_z(value: Column) -> Column:
    value = value.cast("double")
    return F.when(~_present(value) | value.isNull(), F.lit(MISSING)).otherwise(F.format_string("z=%.2f", value))


def format_day(text: Column) -> Column:
    """ISO text as ``Aug 12, 2026``; text that is no date stays as it is."""
    day = F.try_to_date(text)
    return (
        F.when(text.isNull() | (text == ""), F.lit(MISSING))
        .when(day.isNull(), text)
        .otherwise(F.date_format(day, "MMM d, yyyy"))
    )


def format_ms(value: Column) -> Column:
    return F.format_string("%.0f ms", value.cast("double"))


def finite(value: Column) -> Column:
    """NaN becomes null, everything else stays."""
    return F.nullif(value, F.lit(float("nan")))
