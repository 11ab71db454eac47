"""Normalizers: landed provider rows to contract columns.  All narrow projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from barledger.contracts import DAILY_RESOLUTION, PROVIDER, VALUE_COLUMNS
from barledger.functions.exprs import (
    clean_text,
    column_or_null,
    count_where,
    provider_time,
    to_day,
    to_number,
    with_timestamp_facts,
)
from barledger.operators.units import UnitProvenance, provenance_literals

_STRING = StringType()

# --- fixed values: quote snapshot columns ---------------------------------------------
QUOTE_PRICE_COLUMNS = [
    "reference_price",
    "ceiling_price",
    "floor_price",
    "open_price",
    "high_price",
    "low_price",
    "close_price",
    "average_price",
    "price_change",
    "percent_change",
    "bid_price_1",
    "bid_price_2",
    "bid_price_3",
    "ask_price_1",
    "ask_price_2",
    "ask_price_3",
]
QUOTE_VOLUME_COLUMNS = [
    "volume_accumulated",
    "total_value",
    "bid_vol_1",
    "bid_vol_2",
    "bid_vol_3",
    "ask_vol_1",
    "ask_vol_2",
    "ask_vol_3",
    "foreign_buy_volume",
    "foreign_sell_volume",
    "foreign_room",
]


def universe_rows(raw: DataFrame, snapshot: Column) -> DataFrame:
    """Normalized universe rows of every exchange (diagnostics run on these)."""
    kind = column_or_null(raw, "type").cast("string")
    extra = [F.col("input_ordinal")] if "input_ordinal" in raw.columns else []
    return raw.select(
        F.lit(PROVIDER).alias("provider"),
        clean_text(column_or_null(raw, "exchange")).alias("exchange"),
        clean_text(column_or_null(raw, "symbol")).alias("symbol"),
        column_or_null(raw, "organ_name").alias("organ_name"),
        column_or_null(raw, "en_organ_name").alias("english_organ_name"),
        F.coalesce(kind, F.lit("UNKNOWN")).alias("security_type"),
        column_or_null(raw, "id").alias("provider_id"),
        snapshot.alias("snapshot_timestamp_utc"),
        column_or_null(raw, "exchange").alias("raw_exchange_field"),
        column_or_null(raw, "type").alias("raw_type_field"),
        *extra,
    )


def universe_snapshot(raw: DataFrame, exchange: str, snapshot: Column) -> DataFrame:
    return universe_rows(raw, snapshot).where(F.col("exchange") == exchange.upper())


def universe_diagnostics(rows: DataFrame) -> DataFrame:
    """One row of counts taken before the exchange filter."""
    per_symbol = rows.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n"),
        count_where(F.col("exchange") == "HOSE").alias("hose"),
        count_where(F.col("exchange").isNull()).alias("no_exchange"),
    )

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    return per_symbol.agg(
        total(F.col("n")).alias("total_returned_rows"),
        total(F.col("hose")).alias("hose_rows"),
        total(F.col("no_exchange")).alias("null_exchange_rows"),
        total(F.col("n") - 1).alias("duplicate_symbols"),
    )


def universe_type_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("security_type").agg(F.count(F.lit(1)).alias("row_count"))


def daily_bars(
    raw: DataFrame,
    ingestion: Column,
    exchange: Column | str | None = None,
    provenance: UnitProvenance | None = None,
    carry: list[str] = (),
) -> DataFrame:
    """Normalized daily bars of all symbols at once; the symbol is a column of the raw rows."""
    if provenance is not None and (
        provenance.provider != PROVIDER or provenance.source_resolution != DAILY_RESOLUTION
    ):
        raise ValueError("Unit provenance must describe the daily resolution of this provider.")
    venue = F.lit(exchange) if exchange is None or isinstance(exchange, str) else exchange
    return raw.select(
        F.lit(PROVIDER).alias("provider"),
        F.upper(F.col("symbol")).alias("symbol"),
        F.upper(venue.cast("string")).alias("exchange"),
        to_day(raw, "time").alias("date"),
        *[to_number(raw, c).alias(c) for c in VALUE_COLUMNS],
        F.lit(None).cast("boolean").alias("adjusted_flag"),
        F.lit(DAILY_RESOLUTION).alias("source_resolution"),
        ingestion.alias("ingestion_timestamp_utc"),
        *[c.alias(n) for n, c in provenance_literals(provenance).items()],
        *carry,
    )


def intraday_bars(
    raw: DataFrame,
    ingestion: Column,
    resolution: str | None = None,
    exchange: str | None = None,
    carry: list[str] = (),
) -> DataFrame:
    """Normalized intraday bars; provider timestamps are classified, never localized."""
    raw, facts = with_timestamp_facts(
        raw,
        column_or_null(raw, "time"),
        raw.schema["time"].dataType if "time" in raw.columns else _STRING,
    )
    width = F.lit(resolution) if resolution else F.col("resolution")
    return raw.select(
        F.lit(PROVIDER).alias("provider"),
        F.upper(F.col("symbol")).alias("symbol"),
        F.upper(F.lit(exchange).cast("string")).alias("exchange"),
        facts["raw"].alias("provider_timestamp_raw"),
        facts["local"].alias("timestamp"),
        facts["utc"].alias("timestamp_utc"),
        facts["local"].cast("date").alias("trading_date"),
        facts["status"].alias("timestamp_timezone_status"),
        facts["interpretation"].alias("timestamp_interpretation"),
        F.lit(False).alias("timestamp_localization_applied"),
        width.alias("resolution"),
        *[to_number(raw, c).alias(c) for c in VALUE_COLUMNS],
        F.lit("unknown").alias("volume_semantics"),
        F.lit("unknown").alias("bar_status"),
        ingestion.alias("ingestion_timestamp_utc"),
        *carry,
    )


def quote_snapshot(raw: DataFrame, snapshot: Column) -> DataFrame:
    """Normalized quotes; absent price and volume columns default to NULL."""
    time = provider_time(
        column_or_null(raw, "time"),
        raw.schema["time"].dataType if "time" in raw.columns else _STRING,
    )
    return raw.select(
        F.lit(PROVIDER).alias("provider"),
        clean_text(column_or_null(raw, "symbol")).alias("symbol"),
        snapshot.alias("snapshot_timestamp_utc"),
        time["raw"].alias("provider_time_raw"),
        time["parsed"].alias("provider_time_parsed"),
        time["status"].alias("provider_time_parse_status"),
        clean_text(column_or_null(raw, "exchange")).alias("exchange"),
        *[to_number(raw, c).alias(c) for c in QUOTE_PRICE_COLUMNS + QUOTE_VOLUME_COLUMNS],
    )
