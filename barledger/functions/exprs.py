"""Column expressions shared by every operator: text, numbers, dates, weekday arithmetic.

All of them are built-in Spark functions, so they stay inside whole-stage codegen and
work unchanged on batch and streaming frames.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH_MONDAY = "1970-01-05"

# --- fixed values: characters that count as surrounding white space -------------------
EDGE_SPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_NUMBER = r"(?i)\A[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)\z"
_ISO_TIME = (
    r"\A\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?\s*(Z|[+-]\d{2}:?\d{2})?)?\z"
)
_ISO_DAY = (
    r"(?U)\A\s*(\d{4}-\d{2}-\d{2})"
    r"([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?\s*(Z|[+-]\d{2}:?\d{2})?)?\s*\z"
)
_ZONE_SUFFIX = r"\s*(Z|[+-]\d{2}:?\d{2})\z"
_ZONE_AFTER_TIME = r"\A.{10}[T ].*(Z|[+-]\d{2}:?\d{2})\z"


def column_or_null(df: DataFrame, name: str, data_type: str | None = None) -> Column:
    """The named column, or a NULL literal where the frame does not carry it."""
    if name in df.columns:
        return F.col(name)
    return F.lit(None).cast(data_type or "string")


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(EDGE_SPACE))


def clean_text(c: Column) -> Column:
    """Strip, upper-case, and turn blank text into NULL."""
    return F.nullif(F.upper(strip(c.cast("string"))), F.lit(""))


def to_number(df: DataFrame, name: str) -> Column:
    """Coerce to DOUBLE; text that is not a number and NaN both become NULL."""
    if name not in df.columns:
        return F.lit(None).cast("double")
    return number(F.col(name), df.schema[name].dataType)


def number(c: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.StringType):
        text = strip(c)
        return F.when(text.rlike(_NUMBER), text.try_cast("double"))
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return F.nanvl(c.cast("double"), F.lit(None).cast("double"))
    return c.cast("double")


def to_day(df: DataFrame, name: str) -> Column:
    """Calendar date label of a provider time; unparsable text becomes NULL."""
    if name not in df.columns:
        return F.lit(None).cast("date")
    return day(F.col(name), df.schema[name].dataType)


def day(c: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.StringType):
        # One reference to the text: a range filter on the result is pushed below the
        # projection, and every reference would repeat the parsing there.
        return F.regexp_extract(c, _ISO_DAY, 1).try_cast("date")
    if isinstance(data_type, (T.NumericType, T.BooleanType)):
        return F.lit(None).cast("date")
    return c.cast("date")


def utf8_text(c: Column) -> Column:
    return c.cast("string")


# --- weekday arithmetic ---------------------------------------------------------------


def _days_from_monday(d: Column) -> Column:
    return F.datediff(d, F.lit(EPOCH_MONDAY).cast("date"))


def weekday_index(d: Column) -> Column:
    """Running count of weekdays: Monday..Friday advance it, the weekend repeats Friday."""
    n = _days_from_monday(d)
    return (
        F.floor(n / F.lit(7)) * F.lit(5) + F.least(F.pmod(n, F.lit(7)) + 1, F.lit(5))
    ).cast("int")


def weekdays_between(first: Column, last: Column) -> Column:
    """Weekdays in the closed range; zero where the range is empty."""
    return F.greatest(
        weekday_index(last) - weekday_index(F.date_sub(first, 1)), F.lit(0)
    )


def is_weekday(d: Column) -> Column:
    return F.weekday(d) < 5


def trailing_weekday_start(reference: Column, count: int) -> Column:
    """First day of the window of ``count`` weekdays that ends at ``reference``."""
    k = weekday_index(reference) - F.lit(count) + 1
    offset = F.floor((k - 1) / F.lit(5)) * 7 + F.pmod(k - 1, F.lit(5))
    return F.date_add(F.lit(EPOCH_MONDAY).cast("date"), offset.cast("int"))


# --- timestamps -----------------------------------------------------------------------


def _time_shape(text: Column) -> tuple[Column, Column]:
    """Whether a text is an ISO time, and whether a zone ends it."""
    return text.rlike(_ISO_TIME), text.rlike(_ZONE_AFTER_TIME)


def _time_values(text: Column, shaped: Column, zoned: Column) -> tuple[Column, Column]:
    """Wall clock and instant of a shaped text, null where they do not parse."""
    wall = F.when(zoned, F.regexp_replace(text, _ZONE_SUFFIX, "")).otherwise(text)
    return F.when(shaped, wall.try_cast("timestamp_ntz")), F.when(shaped & zoned, text.try_cast("timestamp"))


def _time_status(raw: Column, local: Column, utc: Column, zoned: Column) -> Column:
    return (
        F.when(raw.isNull(), "missing")
        .when(local.isNull() | (zoned & utc.isNull()), "invalid")
        .when(zoned, "aware")
        .otherwise("naive")
    )


def _facts(raw: Column, status: Column, local: Column, utc: Column) -> dict[str, Column]:
    meaning = (
        F.when(status == "missing", "missing_provider_timestamp")
        .when(status == "invalid", "invalid_provider_timestamp_preserved")
        .when(status == "aware", "source_timezone_preserved")
        .otherwise("timezone_naive_preserved_no_localization")
    )
    return {
        "raw": raw,
        "status": status,
        "local": local,
        "utc": F.when(status == "aware", utc),
        "interpretation": meaning,
    }


def timestamp_facts(c: Column, data_type: T.DataType) -> dict[str, Column]:
    """Classify a provider timestamp without ever localizing it.

    Returns ``raw`` text, awareness ``status``, wall-clock ``local`` (TIMESTAMP_NTZ),
    ``utc`` (TIMESTAMP, only where the source carried a zone) and ``interpretation``.
    """
    raw = c.cast("string")
    if isinstance(data_type, T.TimestampType):
        local, utc = c.cast("timestamp_ntz"), c
        status = F.when(c.isNull(), "missing").otherwise("aware")
    elif isinstance(data_type, (T.TimestampNTZType, T.DateType)):
        local, utc = c.cast("timestamp_ntz"), F.lit(None).cast("timestamp")
        status = F.when(c.isNull(), "missing").otherwise("naive")
    else:
        text = strip(raw)
        shaped, zoned = _time_shape(text)
        local, utc = _time_values(text, shaped, zoned)
        status = _time_status(raw, local, utc, zoned)
        local = F.when(status != "invalid", local)
    return _facts(raw, status, local, utc)


def with_timestamp_facts(df: DataFrame, c: Column, data_type: T.DataType) -> tuple[DataFrame, dict[str, Column]]:
    """``timestamp_facts`` of text in steps: each is a projection, so a time is parsed once a row.

    The facts are columns over the returned frame, which carries the steps as hidden columns.
    """
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return df, timestamp_facts(c, data_type)
    raw, text, shaped, zoned, local, utc, status = (
        F.col(f"__time_{n}") for n in ("raw", "text", "shaped", "zoned", "local", "utc", "status")
    )
    df = df.withColumn("__time_raw", c.cast("string")).withColumn("__time_text", strip(raw))
    df = df.withColumns(dict(zip(("__time_shaped", "__time_zoned"), _time_shape(text), strict=True)))
    df = df.withColumns(dict(zip(("__time_local", "__time_utc"), _time_values(text, shaped, zoned), strict=True)))
    df = df.withColumn("__time_status", _time_status(raw, local, utc, zoned))
    return df, _facts(raw, status, F.when(status != "invalid", local), utc)


def provider_time(c: Column, data_type: T.DataType) -> dict[str, Column]:
    """Provider clock value: numbers stay raw, text is parsed as UTC, pre-2000 is invalid."""
    if isinstance(data_type, T.VariantType):
        kind = F.schema_of_variant(c)
        raw = F.try_variant_get(c, "$", "string")
        is_text = kind == "STRING"
        is_number = ~kind.isin("STRING", "VOID", "BOOLEAN") & raw.isNotNull()
    else:
        raw = c.cast("string")
        is_number = F.lit(isinstance(data_type, T.NumericType)) & raw.isNotNull()
        is_text = F.lit(isinstance(data_type, (T.StringType, T.DatetimeType)))
    text = strip(raw)
    zoned = text.rlike(_ZONE_AFTER_TIME)
    as_utc = F.when(zoned, text).otherwise(F.concat(text, F.lit("Z")))
    as_utc = F.when(F.length(text) == 10, F.concat(text, F.lit("T00:00:00Z"))).otherwise(as_utc)
    instant = F.when(is_text & text.rlike(_ISO_TIME), as_utc.try_cast("timestamp"))
    usable = F.year(instant) >= 2000
    status = (
        F.when(raw.isNull(), "missing")
        .when(is_number, "provider_specific_unparsed")
        .when(usable, "parsed")
        .otherwise("invalid")
    )
    return {"raw": raw, "parsed": F.when(status == "parsed", instant), "status": status}


# --- predicates -----------------------------------------------------------------------


def holds(predicate: Column) -> Column:
    """Three-valued logic to two-valued: a comparison with a missing value is false."""
    return F.coalesce(predicate, F.lit(False))


def count_where(predicate: Column) -> Column:
    """Rows where the predicate is true; a missing comparison does not count."""
    return F.count_if(predicate)


def any_of(predicates: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, predicates)


def all_of(predicates: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, predicates)


def null_ohlc() -> Column:
    return any_of(F.col(c).isNull() for c in ("open", "high", "low", "close"))


# OHLC predicates may be NULL where a value is missing; ``greatest``/``least`` skip missing
# values, so one comparison stands for several.


def high_below_low() -> Column:
    return F.col("high") < F.col("low")


def high_below_open_close() -> Column:
    return F.col("high") < F.greatest("open", "close")


def low_above_open_close() -> Column:
    return F.col("low") > F.least("open", "close")


def invalid_ohlc() -> Column:
    return (
        (F.col("high") < F.greatest("low", "open", "close"))
        | (F.col("low") > F.least("open", "close"))
        | (F.least("open", "high", "low", "close") < 0)
    )


def non_integer(c: Column) -> Column:
    return (c % F.lit(1.0)) != 0


def reasons(*pairs: tuple[Column, str]) -> Column:
    """Array of the labels whose condition holds, in the given order."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(label)) for cond, label in pairs]))


def lit_date(value: dt.date | str | Column) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("date")


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator != 0, numerator.cast("double") / denominator.cast("double"))
