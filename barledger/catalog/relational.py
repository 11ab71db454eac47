"""Queries for order, set, profile and text operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from barledger.catalog import views as v
from barledger.catalog.oracles import n_where
from barledger.catalog.registry import query
from barledger.contracts import CAPABILITY_STATUSES
from barledger.operators import normalize, ordering, panel, profile, redaction, sets


def daily(spark, sf):
    return normalize.daily_bars(v.bars_raw(spark, sf), v.stamp(), carry=v.LINE_ORDER)


@query(
    "w3_session_gaps",
    """SELECT symbol, resolution, CAST(count(*) FILTER (WHERE gap > INTERVAL 90 MINUTE) AS BIGINT)
         AS gap_count FROM (SELECT symbol, resolution, ts_minute - lag(ts_minute) OVER (
           PARTITION BY symbol, resolution ORDER BY ts_minute) AS gap FROM intraday_raw)
       GROUP BY ALL""",
)
def w3_session_gaps(spark, sf):
    bars = normalize.intraday_bars(v.intraday_raw(spark, sf), v.stamp())
    return ordering.session_gaps(bars, ["symbol", "resolution"], "timestamp", 90)


@query(
    "w4_duplicates",
    """SELECT symbol, CAST(sum(n - 1) AS BIGINT) AS duplicate_count,
         CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS repeated_row_count
       FROM (SELECT symbol, date, count(*) AS n FROM bars_raw GROUP BY ALL) GROUP BY symbol""",
)
def w4_duplicates(spark, sf):
    return ordering.duplicate_counts(daily(spark, sf), ["date"], ["symbol"])


@query(
    "w5_latest_per_key",
    """SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS latest_order
       FROM orders WHERE o_orderstatus <> 'O' GROUP BY o_custkey""",
)
def w5_latest_per_key(spark, sf):
    """Latest usable record per key by (time, id)."""
    usable = v.table(spark, sf, "orders").where("o_orderstatus <> 'O'")
    return usable.groupBy("o_custkey").agg(
        F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("latest_order")
    )


@query(
    "w8_sortedness",
    f"""SELECT symbol, CAST(count(*) FILTER (WHERE date < before) AS BIGINT) AS order_break_count,
         count(*) AS row_count FROM (SELECT symbol, date, lag(date) OVER (PARTITION BY symbol
           ORDER BY {", ".join(v.LINE_ORDER)}) AS before FROM bars_lined) GROUP BY symbol""",
)
def w8_sortedness(spark, sf):
    """Adjacent lines (by line order) whose date goes down, scanned in ranges."""
    return ordering.order_breaks(v.bars_lined(spark, sf), v.LINE_ORDER, [F.col("date")], ["symbol"])


@query(
    "w7_total_order",
    f"""SELECT symbol, date, row_number() OVER (ORDER BY date, {", ".join(v.LINE_ORDER)}) AS place
        FROM (SELECT * REPLACE (strftime(date, '%Y-%m-%d') AS date) FROM bars_lined)""",
)
def w7_total_order(spark, sf):
    """Place of every line in one order over the whole table, without a single sorted task."""
    placed = ordering.number_rows(v.bars_lined(spark, sf), ["date", *v.LINE_ORDER], "place")
    return placed.select("symbol", "date", "place")


@query(
    "w9_last_valid_close",
    """SELECT symbol, arg_max(close, date) AS recent_close, strftime(max(date), '%Y-%m-%d')
         AS recent_date FROM bars_clean WHERE orderkey % 5 <> 0 GROUP BY symbol""",
)
def w9_last_valid_close(spark, sf):
    """All bars; every fifth order's close is planted null."""
    close = F.when(F.col("orderkey") % 5 != 0, F.col("close"))
    bars = v.bars_clean(spark, sf).withColumn("close", close)
    return bars.groupBy("symbol").agg(*panel.last_valid("close")).where("recent_date IS NOT NULL")


# --- sets ----------------------------------------------------------------------------


@query(
    "u1_concat",
    """SELECT symbol, count(*) AS row_count, CAST(count(orderkey) AS BIGINT) AS with_orderkey
       FROM (SELECT symbol, orderkey FROM bars_clean UNION ALL BY NAME SELECT symbol FROM bars_raw)
       GROUP BY symbol""",
)
def u1_concat(spark, sf):
    both = sets.union_all(
        [
            v.bars_clean(spark, sf).select("symbol", "orderkey"),
            v.bars_raw(spark, sf).select("symbol"),
        ]
    )
    return both.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("row_count"), F.count("orderkey").alias("with_orderkey")
    )


@query(
    "u3_set_difference",
    """SELECT strftime(date, '%Y-%m-%d') AS date, symbol FROM (
         SELECT symbol, date FROM source_a EXCEPT SELECT symbol, date FROM source_b)""",
)
def u3_set_difference(spark, sf):
    a = v.source_a(spark, sf).select("symbol", "date")
    return a.subtract(v.source_b(spark, sf).select("symbol", "date"))


@query(
    "u4_set_equality",
    """SELECT (SELECT count(*) FROM (SELECT symbol FROM suppliers EXCEPT
           SELECT symbol FROM bars_clean WHERE suppkey % 9 <> 0)) AS left_only_count,
         CAST(0 AS BIGINT) AS right_only_count, false AS equal FROM supplier LIMIT 1""",
)
def u4_set_equality(spark, sf):
    seen = v.bars_clean(spark, sf).where("suppkey % 9 <> 0")
    return sets.set_differences(v.suppliers(spark, sf), seen)


@query(
    "u5_frame_equality",
    f"""SELECT {n_where("orderkey % 89 = 0 OR orderkey % 83 = 0")} AS left_only_count,
         {n_where("orderkey % 89 = 0 AND orderkey % 83 <> 0")} AS right_only_count,
         false AS equal FROM bars_clean""",
)
def u5_frame_equality(spark, sf):
    """A republished copy against its source, rows counted with multiplicity."""
    source = v.bars_clean(spark, sf).select("symbol", "date", "close", "volume", "orderkey")
    copy = source.where("orderkey % 83 <> 0").withColumn(
        "close",
        F.when(F.col("orderkey") % 89 == 0, F.col("close") + 1).otherwise(F.col("close")),
    )
    return sets.frame_differences(source, copy)


@query(
    "j17_merge_by_key",
    """SELECT c_custkey, 'base' AS origin FROM customer WHERE c_custkey % 3 <> 0
       UNION ALL SELECT c_custkey, 'override' FROM customer WHERE c_custkey % 3 = 0
       UNION ALL SELECT DISTINCT o_orderkey + 1000000000, 'override' FROM orders
         WHERE o_orderstatus = 'P'""",
)
def j17_merge_by_key(spark, sf):
    """Overrides for every third customer, plus overrides without a base row."""
    customers = v.table(spark, sf, "customer").select("c_custkey")
    base = customers.withColumn("origin", F.lit("base"))
    extra = v.table(spark, sf, "orders").where("o_orderstatus = 'P'").select(
        (F.col("o_orderkey") + 1000000000).alias("c_custkey")
    )
    override = customers.where("c_custkey % 3 = 0").unionByName(extra).withColumn(
        "origin", F.lit("override")
    )
    return sets.merge_by_key(base, override, "c_custkey")


# --- profiles ------------------------------------------------------------------------


@query(
    "a26_profile",
    """SELECT count(*) AS row_count, strftime(min(date), '%Y-%m-%d 00:00:00') AS earliest_timestamp,
         strftime(max(date), '%Y-%m-%d 00:00:00') AS latest_timestamp,
         'naive/unspecified' AS timezone_information,
         '["duplicate_timestamps:time","null_values:time,open"]' AS data_quality_findings,
         'NONE' AS error_category FROM bars_raw""",
)
def a26_profile(spark, sf):
    raw = v.bars_raw(spark, sf).select("symbol", "time", "open", "high", "low", "close", "volume")
    return profile.profile(raw, required=["time", "close"]).drop("schema_summary")


@query(
    "a26_profile_tables",
    """SELECT 'customer' AS table_name, count(*) AS row_count, 'NONE' AS error_category
         FROM customer
       UNION ALL SELECT 'part', count(*), 'NONE' FROM part
       UNION ALL SELECT 'documents', count(*), 'INVALID_SCHEMA' FROM documents
       UNION ALL SELECT 'events', count(*), 'NONE' FROM events""",
)
def a26_profile_tables(spark, sf):
    required = {"documents": ["time"]}
    return sets.union_all(
        [
            profile.profile(v.table(spark, sf, t), required.get(t, [])).select(
                F.lit(t).alias("table_name"), "row_count", "error_category"
            )
            for t in ("customer", "part", "documents", "events")
        ]
    )


@query(
    "a27_status_counts",
    f"""SELECT s AS status, (SELECT count(*) FROM orders WHERE CASE o_orderstatus
           WHEN 'F' THEN 'VERIFIED' WHEN 'O' THEN 'RATE_LIMITED' ELSE 'UNKNOWN' END = s)
         AS row_count
       FROM (VALUES {", ".join(f"('{s}')" for s in CAPABILITY_STATUSES)}) t(s)""",
)
def a27_status_counts(spark, sf):
    status = (
        F.when(F.col("o_orderstatus") == "F", "VERIFIED")
        .when(F.col("o_orderstatus") == "O", "RATE_LIMITED")
        .otherwise("UNKNOWN")
    )
    return profile.capability_counts(
        v.table(spark, sf, "orders").select(status.alias("status"))
    )


# --- text ----------------------------------------------------------------------------

_SECRETS = ["eau", "Der "]
_REDACTED = "replace(replace({c}, 'eau', '[REDACTED]'), 'Der ', '[REDACTED]')"


@query(
    "r1_redact",
    f"""SELECT 'd' || doc_id AS id, {_REDACTED.format(c="text")} AS text,
         substr({_REDACTED.format(c="text")}, 1, 500) AS sanitized FROM documents
       UNION ALL SELECT 'c' || conv_id || '-' || turn, {_REDACTED.format(c="text")},
         substr({_REDACTED.format(c="text")}, 1, 500) FROM conversations""",
)
def r1_redact(spark, sf):
    docs = v.table(spark, sf, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), "text"
    )
    talk = v.table(spark, sf, "conversations").select(
        F.concat(
            F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")
        ).alias("id"),
        "text",
    )
    rows = docs.unionByName(talk).withColumn("raw", F.col("text"))
    return redaction.redact(rows, ["text"], _SECRETS).select(
        "id", "text", redaction.sanitized_error(F.col("raw"), _SECRETS).alias("sanitized")
    )


@query(
    "r1_redact_map",
    f"""SELECT doc_id, '[REDACTED]' AS secret_value, {_REDACTED.format(c="source")} AS plain_value
       FROM documents""",
)
def r1_redact_map(spark, sf):
    rows = v.table(spark, sf, "documents").select(
        "doc_id",
        F.create_map(F.lit("X-Api_Key"), F.col("text"), F.lit("source"), F.col("source")).alias("m"),
    )
    return redaction.redact(rows, ["m"], _SECRETS).select(
        "doc_id",
        F.col("m")["X-Api_Key"].alias("secret_value"),
        F.col("m")["source"].alias("plain_value"),
    )


_SUFFIXES = [
    " Timeout", " no module named x", " HTTP 429", " Forbidden", " Network unreachable", "",
    " Dữ liệu trống cho mã X với interval 1D", " api key missing; timed out",
]


_R2_SQL = """SELECT doc_id, category AS error_category, CASE category WHEN 'TIMEOUT' THEN 'NETWORK_ERROR'
           WHEN 'NETWORK' THEN 'NETWORK_ERROR' WHEN 'RATE_LIMIT' THEN 'RATE_LIMITED'
           WHEN 'AUTHENTICATION' THEN 'AUTHENTICATION_REQUIRED'
           WHEN 'PACKAGE_NOT_INSTALLED' THEN 'UNAVAILABLE_PACKAGE'
           WHEN 'EMPTY_RESPONSE' THEN 'EMPTY_RESPONSE' ELSE 'PROVIDER_ERROR' END
         AS capability_status
       FROM (SELECT doc_id, CASE
           WHEN m IN (0, 7) OR t LIKE '%timeout%' OR t LIKE '%timed out%' THEN 'TIMEOUT'
           WHEN m = 1 OR t LIKE '%no module named%' THEN 'PACKAGE_NOT_INSTALLED'
           WHEN m = 6 THEN 'EMPTY_RESPONSE'
           WHEN m = 2 OR t LIKE '%rate limit%' OR t LIKE '%too many requests%'
             OR t LIKE '%429%' THEN 'RATE_LIMIT'
           WHEN m = 3 OR t LIKE '%unauthorized%' OR t LIKE '%forbidden%' OR t LIKE '%invalid api%'
             OR t LIKE '%api key%' OR t LIKE '%401%' OR t LIKE '%403%' THEN 'AUTHENTICATION'
           WHEN m = 4 OR t LIKE '%connection%' OR t LIKE '%network%' OR t LIKE '%name resolution%'
             OR t LIKE '%nodename nor servname%' OR t LIKE '%max retries%' OR t LIKE '%dns%'
             THEN 'NETWORK' ELSE 'PROVIDER' END AS category
         FROM (SELECT doc_id, lower(text) AS t, doc_id % 8 AS m FROM documents))"""


@query("r2_classify_errors", _R2_SQL)
def r2_classify_errors(spark, sf):
    return redaction.classify_errors(_messages(spark, sf), "message").drop("message")


def _messages(spark, sf):
    suffix = F.element_at(
        F.array(*[F.lit(s) for s in _SUFFIXES]), (F.col("doc_id") % 8 + 1).cast("int")
    )
    return v.table(spark, sf, "documents").select(
        "doc_id", F.concat(F.col("text"), suffix).alias("message")
    )


@query(
    "r2_error_counts",
    f"""SELECT c AS error_category, (SELECT count(*) FROM ({_R2_SQL}) WHERE error_category = c)
         AS row_count FROM (VALUES {", ".join(f"('{c}')" for c in redaction.CATEGORIES)}) t(c)""",
)
def r2_error_counts(spark, sf):
    return redaction.error_counts(_messages(spark, sf), "message")
