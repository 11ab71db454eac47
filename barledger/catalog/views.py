"""Adapter views: the given tables seen as market-data inputs (definitions only).

``VIEW_SQL`` holds the DuckDB form used by the oracles, the functions below the Spark form.
Orders and line numbers are not unique in ``lineitem``, so every "first row" choice and
input ordinal uses the total order (l_orderkey, l_linenumber, l_partkey, l_extendedprice,
l_quantity).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barledger.operators.units import KBS, VCI

START, END = "1995-01-01", "2001-11-04"
#: First weekday of the tables.
MONDAY = "1995-01-02"
CHUNK_DAYS = 730
STAMP = "2024-01-31T00:00:00Z"
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def stamp() -> Column:
    return F.lit(STAMP).cast("timestamp")


def _symbol(c: str) -> Column:
    return F.concat(F.lit("S"), F.col(c).cast("string"))


def bars_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Landed daily rows with planted defects (a later defect wins)."""
    k = F.col("l_orderkey")

    def hit(n: int) -> Column:
        return k % n == 0

    low = F.col("l_extendedprice")
    qty = F.col("l_quantity")
    return table(spark, sf, "lineitem").select(
        *LINE_ORDER,
        F.col("l_suppkey").alias("suppkey"),
        _symbol("l_suppkey").alias("symbol"),
        F.when(~hit(113), F.col("l_shipdate").cast("date").cast("string")).alias("time"),
        F.when(~hit(101), low).alias("open"),
        F.when(hit(97), low - 1).otherwise(low + qty).alias("high"),
        low.alias("low"),
        (low + qty).alias("close"),
        F.when(hit(109), -qty)
        .when(hit(107), qty + 0.5)
        .when(hit(103), F.lit(0.0))
        .otherwise(qty)
        .alias("volume"),
    )


def _dated(rows: DataFrame, may_repeat: str = "false") -> DataFrame:
    """Every line as a bar on a weekday of its own.

    Weekend lines move to Monday; of a supplier's lines in order, each that finds its day taken
    moves to the next free weekday (running maximum of day number less line number).
    Suppliers that ``may_repeat`` keep their days as they are.
    """
    days = F.datediff(F.col("l_shipdate").cast("date"), F.lit(MONDAY).cast("date"))
    given = F.floor(days / 7) * 5 + F.least(days % 7, F.lit(5))
    w = Window.partitionBy("l_suppkey").orderBy("__w", *LINE_ORDER)
    rows = rows.withColumn("__w", given.cast("bigint")).withColumn("__n", F.row_number().over(w).cast("bigint"))
    moved = F.col("__n") + F.max(F.col("__w") - F.col("__n")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("__w", F.when(F.expr(may_repeat), F.col("__w")).otherwise(moved))
    date = F.date_add(F.lit(MONDAY).cast("date"), (F.floor(F.col("__w") / 5) * 7 + F.col("__w") % 5).cast("int"))
    return rows.withColumn("date", date).drop("__w", "__n")


def _clean_lines(spark: SparkSession, sf: str, rows: DataFrame | None = None) -> DataFrame:
    return _dated(table(spark, sf, "lineitem") if rows is None else rows)


def _as_bars(lines: DataFrame, carry: list[str] = ()) -> DataFrame:
    low, qty = F.col("l_extendedprice"), F.col("l_quantity")
    return lines.select(
        *carry,
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_suppkey").alias("suppkey"),
        F.lit("vnstock").alias("provider"),
        _symbol("l_suppkey").alias("symbol"),
        F.lit("HOSE").alias("exchange"),
        "date",
        low.alias("open"),
        (low + qty).alias("high"),
        low.alias("low"),
        (low + qty).alias("close"),
        qty.alias("volume"),
        F.lit(None).cast("boolean").alias("adjusted_flag"),
        F.lit("1D").alias("source_resolution"),
        stamp().alias("ingestion_timestamp_utc"),
    )


def bars_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Normalized daily bars of every line, one per symbol and weekday, no provenance."""
    return _as_bars(_clean_lines(spark, sf))


def bars_lined(spark: SparkSession, sf: str) -> DataFrame:
    """Symbol and day of every line with the columns of the line order."""
    return _clean_lines(spark, sf).select(*LINE_ORDER, _symbol("l_suppkey").alias("symbol"), "date")


def dated_lines(spark: SparkSession, sf: str) -> DataFrame:
    """What a bar is made from, and no more: for joins that come before the bars' fixed columns."""
    return _clean_lines(spark, sf).select("l_orderkey", "l_suppkey", "l_extendedprice", "l_quantity", "date")


def bars_prov(spark: SparkSession, sf: str, lines: DataFrame | None = None, carry: list[str] = ()) -> DataFrame:
    """bars_clean (of ``lines`` if given, with ``carry`` columns) with provenance varied by supplier."""
    m = F.col("suppkey") % 5
    columns = {}
    for name, value in KBS.by_column().items():
        if name in ("provider", "source_resolution"):
            continue
        other = VCI.by_column()[name]
        wrong = 1.0 if name == "source_price_scale_to_vnd" else value
        columns[name] = (
            F.when(m == 0, F.lit(None))
            .when(m == 1, F.lit(other))
            .when(m == 2, F.lit(wrong))
            .otherwise(F.lit(value))
        )
    bars = _as_bars(dated_lines(spark, sf) if lines is None else lines, carry)
    return bars.withColumns(columns)


def suppliers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("suppkey"), _symbol("s_suppkey").alias("symbol")
    )


def universe_raw(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    k = F.col("s_suppkey")
    kinds = ["stock", "equity", "etf", "cw", "bond", "mystery", None, "Stock"]
    kind = F.element_at(F.array(*[F.lit(x) for x in kinds]), (k % 8 + 1).cast("int"))
    rows = (
        table(spark, sf, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            k.alias("suppkey"),
            _symbol("s_suppkey").alias("symbol"),
            F.col("s_name").alias("organ_name"),
            F.col("s_name").alias("en_organ_name"),
            F.when(k % 23 != 0, F.col("r_name")).alias("exchange"),
            kind.alias("type"),
            k.cast("string").alias("id"),
            (k * 2).alias("input_ordinal"),
        )
    )
    copies = rows.where(k_mod("suppkey", 29)).withColumns(
        {
            "symbol": F.concat(F.lit("  "), F.lower("symbol"), F.lit(" ")),
            "input_ordinal": F.col("input_ordinal") + 1,
        }
    )
    return rows.unionByName(copies)


def k_mod(column: str, n: int) -> Column:
    return F.col(column) % n == 0


def _source(spark: SparkSession, sf: str, odd: bool) -> DataFrame:
    """Bars of odd or even lines; every fourth supplier keeps repeated days."""
    lines = table(spark, sf, "lineitem").where(F.col("l_linenumber") % 2 == (1 if odd else 0))
    kept = _dated(lines, "l_suppkey % 4 = 3")
    return kept.select(
        *LINE_ORDER,
        _symbol("l_suppkey").alias("symbol"),
        "date",
        F.col("l_extendedprice").alias("open"),
        (F.col("l_extendedprice") + F.col("l_quantity")).alias("high"),
        F.col("l_extendedprice").alias("low"),
        (F.col("l_extendedprice") + F.col("l_quantity")).alias("close"),
        F.col("l_quantity").alias("volume"),
    )


def source_a(spark: SparkSession, sf: str) -> DataFrame:
    return _source(spark, sf, True)


def source_b(spark: SparkSession, sf: str) -> DataFrame:
    return _source(spark, sf, False)


def intraday_raw(spark: SparkSession, sf: str) -> DataFrame:
    text = F.date_format(F.date_trunc("minute", "ts"), "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf, "events").select(
        "event_id",
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"),
        F.lit("1m").alias("resolution"),
        F.when(F.col("event_id") % 31 == 0, F.concat(text, F.lit("+07:00")))
        .otherwise(text)
        .alias("time"),
        *[F.col("value").alias(c) for c in ("open", "high", "low", "close")],
        F.lit(1.0).alias("volume"),
    )


def quotes_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Newest event per user; the time is a number, ISO text or missing (a VARIANT)."""
    last = (
        table(spark, sf, "events")
        .groupBy("user_id")
        .agg(
            F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"),
            F.max_by("ts", F.struct("ts", "event_id")).alias("ts"),
            F.max_by("value", F.struct("ts", "event_id")).alias("value"),
            F.max_by("props", F.struct("ts", "event_id")).alias("props"),
        )
    )
    iso = F.date_format(F.date_trunc("second", "ts"), "yyyy-MM-dd HH:mm:ss")
    as_json = (
        F.when(F.col("user_id") % 3 == 1, F.concat(F.lit('"'), iso, F.lit('"')))
        .when(F.col("user_id") % 3 == 2, F.lit("null"))
        .otherwise(F.get_json_object("props", "$.k"))
    )
    return last.select(
        F.concat(F.lit(" u"), F.col("user_id").cast("string"), F.lit(" ")).alias("symbol"),
        F.when(F.col("user_id") % 3 != 2, F.parse_json(as_json)).alias("time"),
        F.lit("hose").alias("exchange"),
        F.col("value").alias("reference_price"),
        (-F.col("value")).alias("price_change"),
        F.when(F.col("user_id") % 4 != 0, F.col("value")).alias("open_price"),
        F.when(F.col("user_id") % 7 == 0, F.lit(-1.0)).otherwise(F.lit(5.0)).alias(
            "volume_accumulated"
        ),
        F.col("value").alias("bid_price_1"),
    )


# --- DuckDB definitions ---------------------------------------------------------------

_ORDER = ", ".join(LINE_ORDER)
_BAR = (
    "l_extendedprice AS open, l_extendedprice + l_quantity AS high, l_extendedprice AS low, "
    "l_extendedprice + l_quantity AS close, l_quantity AS volume"
)


def _prov_sql() -> str:
    parts = []
    for name, value in KBS.by_column().items():
        if name in ("provider", "source_resolution"):
            continue
        other, wrong = VCI.by_column()[name], value
        if name == "source_price_scale_to_vnd":
            wrong = 1.0

        def q(v: object) -> str:
            return f"CAST({v} AS DOUBLE)" if isinstance(v, float) else f"'{v}'"

        parts.append(
            f"CASE WHEN suppkey % 5 = 0 THEN NULL WHEN suppkey % 5 = 1 THEN {q(other)} "
            f"WHEN suppkey % 5 = 2 THEN {q(wrong)} ELSE {q(value)} END AS {name}"
        )
    return ", ".join(parts)


def _dated_sql(where: str, may_repeat: str = "false") -> str:
    order = f"PARTITION BY l_suppkey ORDER BY w, {_ORDER}"
    return f"""(SELECT * EXCLUDE (w, n, m), DATE '{MONDAY}' + CAST(m // 5 * 7 + m % 5 AS INT) AS date FROM (
        SELECT *, CASE WHEN {may_repeat} THEN w ELSE n + max(w - n) OVER ({order} ROWS UNBOUNDED PRECEDING) END AS m FROM (
          SELECT *, row_number() OVER ({order}) AS n FROM (
            SELECT *, days // 7 * 5 + least(days % 7, 5) AS w FROM (
              SELECT *, date_diff('day', DATE '{MONDAY}', CAST(l_shipdate AS DATE)) AS days FROM lineitem WHERE {where})))))"""


VIEW_SQL: dict[str, str] = {
    "bars_raw": f"""
        SELECT {_ORDER}, l_suppkey AS suppkey, 'S' || l_suppkey AS symbol,
          CASE WHEN l_orderkey % 113 = 0 THEN NULL
               ELSE strftime(l_shipdate, '%Y-%m-%d') END AS time,
          CASE WHEN l_orderkey % 113 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS date,
          CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE l_extendedprice END AS open,
          CASE WHEN l_orderkey % 97 = 0 THEN l_extendedprice - 1
               ELSE l_extendedprice + l_quantity END AS high,
          l_extendedprice AS low, l_extendedprice + l_quantity AS close,
          CASE WHEN l_orderkey % 109 = 0 THEN -l_quantity
               WHEN l_orderkey % 107 = 0 THEN l_quantity + 0.5
               WHEN l_orderkey % 103 = 0 THEN 0.0 ELSE l_quantity END AS volume
        FROM lineitem""",
    "bars_clean": f"""
        SELECT l_orderkey AS orderkey, l_suppkey AS suppkey, 'vnstock' AS provider,
          'S' || l_suppkey AS symbol, 'HOSE' AS exchange, date, {_BAR},
          CAST(NULL AS BOOLEAN) AS adjusted_flag, '1D' AS source_resolution
        FROM {_dated_sql("true")}""",
    "bars_lined": f"SELECT {_ORDER}, 'S' || l_suppkey AS symbol, date FROM {_dated_sql('true')}",
    "bars_prov": f"SELECT *, {_prov_sql()} FROM bars_clean",
    "suppliers": "SELECT s_suppkey AS suppkey, 'S' || s_suppkey AS symbol FROM supplier",
    "universe_raw": """
        SELECT suppkey, CASE WHEN c = 1 THEN '  ' || lower(symbol) || ' ' ELSE symbol END
            AS symbol, organ_name, exchange, type, suppkey * 2 + c AS input_ordinal
        FROM (SELECT s_suppkey AS suppkey, 'S' || s_suppkey AS symbol, s_name AS organ_name,
                CASE WHEN s_suppkey % 23 = 0 THEN NULL ELSE r_name END AS exchange,
                CASE s_suppkey % 8 WHEN 0 THEN 'stock' WHEN 1 THEN 'equity' WHEN 2 THEN 'etf'
                  WHEN 3 THEN 'cw' WHEN 4 THEN 'bond' WHEN 5 THEN 'mystery' WHEN 7 THEN 'Stock'
                  END AS type
              FROM supplier JOIN nation ON s_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey)
        CROSS JOIN (VALUES (0), (1)) v(c) WHERE c = 0 OR suppkey % 29 = 0""",
    "source_a": f"""
        SELECT {_ORDER}, 'S' || l_suppkey AS symbol, date, {_BAR}
        FROM {_dated_sql("l_linenumber % 2 = 1", "l_suppkey % 4 = 3")}""",
    "source_b": f"""
        SELECT {_ORDER}, 'S' || l_suppkey AS symbol, date, {_BAR}
        FROM {_dated_sql("l_linenumber % 2 = 0", "l_suppkey % 4 = 3")}""",
    "intraday_raw": """
        SELECT event_id, 'U' || user_id AS symbol, '1m' AS resolution,
          date_trunc('minute', ts) AS ts_minute, event_id % 31 = 0 AS zoned,
          strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S')
            || CASE WHEN event_id % 31 = 0 THEN '+07:00' ELSE '' END AS time,
          value AS open, value AS high, value AS low, value AS close, 1.0::DOUBLE AS volume
        FROM events""",
    "quotes_raw": """
        SELECT user_id, 'U' || user_id AS symbol, ts, value,
          json_extract_string(props, '$.k') AS k,
          -value AS price_change,
          CASE WHEN user_id % 4 <> 0 THEN value END AS open_price,
          CASE WHEN user_id % 7 = 0 THEN -1.0::DOUBLE ELSE 5.0::DOUBLE END AS volume_accumulated
        FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
}


def oracle(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the view definitions it (transitively) mentions."""
    known = {**VIEW_SQL, **(extra or {})}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in known:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit_into(name)

    def visit_into(name: str) -> None:
        if name in needed:
            return
        for other in known:
            if other != name and re.search(rf"\b{other}\b", known[name]):
                visit_into(other)
        if name not in needed:
            needed.append(name)

    visit(body)
    if not needed:
        return body
    # A view that several others read is computed once.
    readers = {n: sum(bool(re.search(rf"\b{n}\b", t)) for t in [body, *(known[m] for m in needed if m != n)]) for n in needed}
    kept = {n: "MATERIALIZED " if readers[n] > 1 else "" for n in needed}
    ctes = ",\n".join(f"{n} AS {kept[n]}({known[n]})" for n in needed)
    return f"WITH {ctes}\n{body}"
