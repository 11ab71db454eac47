"""Queries for the normalizers (text, numbers, times, universe, daily, intraday, quotes)."""

from __future__ import annotations

from pyspark.sql import functions as F

from barledger.catalog import views as v
from barledger.catalog.oracles import n_where
from barledger.catalog.registry import query
from barledger.functions import exprs as x
from barledger.operators import normalize
from barledger.operators.sets import clean_symbols, missing_symbols
from barledger.operators.units import KBS


@query(
    "n2_text",
    """SELECT CAST(input_ordinal AS BIGINT) AS input_ordinal,
         nullif(upper(trim(symbol)), '') AS symbol, nullif(upper(trim(exchange)), '') AS exchange
       FROM universe_raw""",
)
def n2_text(spark, sf):
    return v.universe_raw(spark, sf).select(
        "input_ordinal",
        x.clean_text(F.col("symbol")).alias("symbol"),
        x.clean_text(F.col("exchange")).alias("exchange"),
    )


@query(
    "n3_numeric",
    """SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN o_totalprice WHEN 3 THEN 12.5
         WHEN 4 THEN 1000.0 END AS number FROM orders""",
)
def n3_numeric(spark, sf):
    m = F.col("o_orderkey") % 7
    text = (
        F.when(m == 0, F.col("o_totalprice").cast("string"))
        .when(m == 1, F.concat(F.col("o_totalprice").cast("string"), F.lit("d")))
        .when(m == 2, "nan")
        .when(m == 3, " 12.5\t")
        .when(m == 4, "1e3")
        .when(m == 5, F.col("o_orderpriority"))
    )
    rows = v.table(spark, sf, "orders").select("o_orderkey", text.alias("t"))
    return rows.select("o_orderkey", x.to_number(rows, "t").alias("number"))


@query(
    "n4_universe",
    """SELECT 'vnstock' AS provider, upper(trim(exchange)) AS exchange,
         upper(trim(symbol)) AS symbol, organ_name, coalesce(type, 'UNKNOWN') AS security_type,
         exchange AS raw_exchange_field, type AS raw_type_field
       FROM universe_raw WHERE upper(trim(exchange)) = 'ASIA'""",
)
def n4_universe(spark, sf):
    return normalize.universe_snapshot(v.universe_raw(spark, sf), "ASIA", v.stamp()).drop(
        "english_organ_name", "provider_id", "snapshot_timestamp_utc", "input_ordinal"
    )


@query(
    "a1_universe_diagnostics",
    f"""SELECT count(*) AS total_returned_rows, {n_where("exchange = 'HOSE'")} AS hose_rows,
         {n_where("exchange IS NULL")} AS null_exchange_rows,
         CAST(count(*) - count(DISTINCT upper(trim(symbol))) AS BIGINT) AS duplicate_symbols
       FROM universe_raw""",
)
def a1_universe_diagnostics(spark, sf):
    rows = normalize.universe_rows(v.universe_raw(spark, sf), v.stamp())
    return normalize.universe_diagnostics(rows)


@query(
    "a1_universe_types",
    """SELECT coalesce(type, 'UNKNOWN') AS security_type, count(*) AS row_count
       FROM universe_raw GROUP BY 1""",
)
def a1_universe_types(spark, sf):
    rows = normalize.universe_rows(v.universe_raw(spark, sf), v.stamp())
    return normalize.universe_type_counts(rows)


@query(
    "n5_daily",
    """SELECT 'vnstock' AS provider, symbol, 'HOSE' AS exchange,
         strftime(date, '%Y-%m-%d') AS date, open, high, low, close, volume,
         CAST(NULL AS BOOLEAN) AS adjusted_flag, '1D' AS source_resolution,
         'kbs' AS data_backend, 1000.0::DOUBLE AS source_price_scale_to_vnd FROM bars_raw""",
)
def n5_daily(spark, sf):
    bars = normalize.daily_bars(v.bars_raw(spark, sf), v.stamp(), "hose", KBS)
    return bars.select(
        "provider", "symbol", "exchange", "date", "open", "high", "low", "close", "volume",
        "adjusted_flag", "source_resolution", "data_backend", "source_price_scale_to_vnd",
    )


@query(
    "n6_intraday",
    """SELECT event_id, symbol, time AS provider_timestamp_raw,
         strftime(ts_minute, '%Y-%m-%d %H:%M:%S') AS timestamp,
         CASE WHEN zoned THEN strftime(ts_minute - INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') END
           AS timestamp_utc,
         strftime(ts_minute, '%Y-%m-%d') AS trading_date,
         CASE WHEN zoned THEN 'aware' ELSE 'naive' END AS timestamp_timezone_status,
         CASE WHEN zoned THEN 'source_timezone_preserved'
           ELSE 'timezone_naive_preserved_no_localization' END AS timestamp_interpretation,
         false AS timestamp_localization_applied, resolution, close, volume,
         'unknown' AS volume_semantics, 'unknown' AS bar_status
       FROM intraday_raw""",
)
def n6_intraday(spark, sf):
    bars = normalize.intraday_bars(v.intraday_raw(spark, sf), v.stamp(), carry=["event_id"])
    return bars.drop("provider", "exchange", "open", "high", "low", "ingestion_timestamp_utc")


@query(
    "n7_provider_time",
    """SELECT symbol, CASE user_id % 3 WHEN 0 THEN k
           WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS provider_time_raw,
         CASE WHEN user_id % 3 = 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END
           AS provider_time_parsed,
         CASE user_id % 3 WHEN 0 THEN 'provider_specific_unparsed' WHEN 1 THEN 'parsed'
           ELSE 'missing' END AS provider_time_parse_status
       FROM quotes_raw""",
)
def n7_provider_time(spark, sf):
    quotes = normalize.quote_snapshot(v.quotes_raw(spark, sf), v.stamp())
    return quotes.select(
        "symbol", "provider_time_raw", "provider_time_parsed", "provider_time_parse_status"
    )


@query(
    "n8_quotes",
    """SELECT 'vnstock' AS provider, symbol, 'HOSE' AS exchange, value AS reference_price,
         price_change, open_price, volume_accumulated, CAST(NULL AS DOUBLE) AS close_price,
         CAST(NULL AS DOUBLE) AS foreign_room, value AS bid_price_1 FROM quotes_raw""",
)
def n8_quotes(spark, sf):
    return normalize.quote_snapshot(v.quotes_raw(spark, sf), v.stamp()).select(
        "provider", "symbol", "exchange", "reference_price", "price_change", "open_price",
        "volume_accumulated", "close_price", "foreign_room", "bid_price_1",
    )


_TIME_TEXT = {
    0: ("yyyy-MM-dd", ""),
    1: ("yyyy-MM-dd HH:mm:ss", ""),
    2: ("yyyy-MM-dd'T'HH:mm:ss", "Z"),
    3: ("yyyy-MM-dd HH:mm:ss", "+07:00"),
}


@query(
    "n9_timestamp",
    """SELECT o_orderkey,
         CASE WHEN m <= 1 THEN 'naive' WHEN m <= 3 THEN 'aware' WHEN m = 7 THEN 'missing'
           ELSE 'invalid' END AS status,
         CASE WHEN m <= 3 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS local,
         CASE m WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
           WHEN 3 THEN strftime(o_orderdate - INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') END AS utc
       FROM (SELECT *, o_orderkey % 8 AS m FROM orders)""",
)
def n9_timestamp(spark, sf):
    m, d = F.col("o_orderkey") % 8, F.col("o_orderdate")
    text = F.when(m == 4, "12:30").when(m == 5, "1999-13-40").when(m == 6, F.col("o_orderpriority"))
    for i, (pattern, zone) in _TIME_TEXT.items():
        text = text.when(m == i, F.concat(F.date_format(d, pattern), F.lit(zone)))
    rows = v.table(spark, sf, "orders").select("o_orderkey", text.alias("t"))
    facts = x.timestamp_facts(F.col("t"), rows.schema["t"].dataType)
    return rows.select(
        "o_orderkey", *[facts[k].alias(k) for k in ("status", "local", "utc")]
    )


@query(
    "n11_clean_symbols",
    """SELECT DISTINCT nullif(upper(trim(symbol)), '') AS symbol FROM universe_raw""",
)
def n11_clean_symbols(spark, sf):
    return clean_symbols(v.universe_raw(spark, sf))


@query(
    "j3_missing_symbols",
    """SELECT DISTINCT 'U' || c_custkey AS symbol FROM customer
       WHERE 'U' || c_custkey NOT IN (SELECT symbol FROM quotes_raw)""",
)
def j3_missing_symbols(spark, sf):
    asked = v.table(spark, sf, "customer").select(
        F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("symbol")
    )
    return missing_symbols(asked, normalize.quote_snapshot(v.quotes_raw(spark, sf), v.stamp()))
