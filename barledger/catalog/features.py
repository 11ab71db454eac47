"""Queries for feature inputs: universe, panel, units, availability and liquidity."""

from __future__ import annotations

from pyspark.sql import functions as F

from barledger.catalog import views as v
from barledger.catalog.oracles import BAD_OHLC, NULL_OHLC, calendar, json_list, n_where, policy
from barledger.catalog.registry import query
from barledger.contracts import EFFECTIVE_UNIT_COLUMNS
from barledger.functions import exprs as x
from barledger.operators import normalize, panel, universe
from barledger.operators.units import (
    KBS,
    PROVENANCE_COLUMNS,
    VCI,
    ensure_provenance_columns,
    matches_record,
    unit_policy,
)
from barledger.sources.staging import staged

SNAPSHOT_TEXT = ["2024-01-30T00:00:00Z", "2024-01-31T00:00:00Z", "2024-02-05 00:00:00"]


def normalized_universe(spark, sf):
    return normalize.universe_rows(v.universe_raw(spark, sf), v.stamp())


# --- snapshots and candidate classification ------------------------------------------


@query(
    "f3_latest_snapshot",
    """SELECT CAST(input_ordinal AS BIGINT) AS input_ordinal, '2024-01-31T00:00:00Z'
         AS snapshot_timestamp_utc FROM universe_raw WHERE input_ordinal % 3 = 1""",
)
def f3_latest_snapshot(spark, sf):
    text = F.element_at(
        F.array(*[F.lit(t) for t in SNAPSHOT_TEXT]), (F.col("input_ordinal") % 3 + 1).cast("int")
    )
    rows = v.universe_raw(spark, sf).select("input_ordinal", text.alias("snapshot_timestamp_utc"))
    return universe.latest_snapshot(rows)


_UNIVERSE_SQL = """
  SELECT CAST(input_ordinal AS BIGINT) AS input_row_number, nullif(upper(trim(symbol)), '') AS symbol,
    CASE WHEN exchange IS NULL OR exchange <> 'ASIA' THEN 'excluded'
      WHEN copies > 1 THEN 'uncertain'
      WHEN lower(kind) IN ('stock', 'equity') THEN 'included_candidate'
      WHEN lower(kind) IN ('etf', 'cw', 'bond') THEN 'excluded' ELSE 'uncertain' END
      AS candidate_status,
    '["' || CASE WHEN exchange IS NULL OR exchange <> 'ASIA' THEN 'exchange_mismatch_or_missing'
      WHEN copies > 1 THEN 'duplicate_symbol_records'
      WHEN lower(kind) IN ('stock', 'equity') THEN 'provider_reported_stock_candidate'
      WHEN lower(kind) IN ('etf', 'cw', 'bond')
        THEN 'provider_reported_non_stock_type:' || lower(kind)
      ELSE 'unsupported_or_unknown_security_type' END || '"{extra}]' AS candidate_reasons,
    '{status}' AS historical_membership_status
  FROM (SELECT *, coalesce(type, 'UNKNOWN') AS kind,
    count(*) OVER (PARTITION BY upper(trim(symbol))) AS copies FROM universe_raw)"""


def _research(spark, sf, reference):
    prepared = universe.research_universe(normalized_universe(spark, sf), "asia", reference)
    return prepared.select(
        "input_row_number", "symbol", "candidate_status", "candidate_reasons",
        "historical_membership_status",
    )


@query(
    "n16_research_universe",
    _UNIVERSE_SQL.format(extra="", status="current_snapshot_only"),
)
def n16_research_universe(spark, sf):
    return _research(spark, sf, None)


@query(
    "n16_historical_reference",
    _UNIVERSE_SQL.format(
        extra=',"historical_membership_not_verified"', status="requested_reference_unverified"
    ),
)
def n16_historical_reference(spark, sf):
    return _research(spark, sf, "2020-01-02")


@query(
    "f7_included_symbols",
    """SELECT symbol FROM (SELECT upper(trim(symbol)) AS symbol, count(*) AS n,
         bool_and(exchange = 'ASIA' AND lower(type) IN ('stock', 'equity')) AS ok
       FROM universe_raw GROUP BY 1) WHERE n = 1 AND ok""",
)
def f7_included_symbols(spark, sf):
    return universe.included_symbols(
        universe.research_universe(normalized_universe(spark, sf), "ASIA")
    )


# --- calendars -----------------------------------------------------------------------


@query(
    "f5_trailing_window",
    """SELECT strftime(r.d, '%Y-%m-%d') AS reference, strftime(c.d, '%Y-%m-%d') AS window_start,
         20 AS weekdays
       FROM (SELECT CAST(o_orderdate AS DATE) AS d, max(n) AS n FROM orders
             JOIN cal ON cal.d <= CAST(o_orderdate AS DATE) GROUP BY 1) r
       JOIN cal c ON c.n = r.n - 19""",
    {"cal": calendar("1994-01-03", "2002-12-31")},
)
def f5_trailing_window(spark, sf):
    days = v.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    start = x.trailing_weekday_start(F.col("d"), 20)
    return days.distinct().select(
        F.col("d").alias("reference"),
        start.alias("window_start"),
        x.weekdays_between(start, F.col("d")).alias("weekdays"),
    )


# --- unit policy ---------------------------------------------------------------------

_POLICY_SELECT = (
    "unit_provenance_status, permitted AS vnd_traded_value_permitted, unit_policy_name, "
    "price_unit, volume_unit, traded_value_unit, price_scale, u_provider AS policy_provider, "
    "u_backend AS policy_data_backend, u_resolution AS policy_source_resolution, "
    "u_evidence AS unit_evidence_reference"
)
_POLICY_COLUMNS = [
    "unit_provenance_status", "vnd_traded_value_permitted", "unit_policy_name", "price_unit",
    "volume_unit", "traded_value_unit", "price_scale", "policy_provider", "policy_data_backend",
    "policy_source_resolution", "unit_evidence_reference",
]


@query(
    "a2_unit_policy_by_symbol",
    f"SELECT symbol, {_POLICY_SELECT} FROM pol",
    {"pol": policy("bars_prov", "symbol")},
)
def a2_unit_policy_by_symbol(spark, sf):
    return unit_policy(v.bars_prov(spark, sf), ["symbol"]).select("symbol", *_POLICY_COLUMNS)


@query(
    "a2_unit_policy_global",
    f"SELECT {_POLICY_SELECT} FROM pol",
    {"pol": policy("bars_prov", None)},
)
def a2_unit_policy_global(spark, sf):
    return unit_policy(v.bars_prov(spark, sf)).select(*_POLICY_COLUMNS)


@query(
    "a2_unit_policy_legacy",
    "SELECT 'legacy_missing' AS unit_provenance_status, count(*) < 0 AS "
    "vnd_traded_value_permitted FROM bars_clean",
)
def a2_unit_policy_legacy(spark, sf):
    """Rows without any source-specific column."""
    return unit_policy(v.bars_clean(spark, sf)).select(
        "unit_provenance_status", "vnd_traded_value_permitted"
    )


@query(
    "n13_missing_provenance",
    "SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS with_backend FROM bars_clean",
)
def n13_missing_provenance(spark, sf):
    rows = ensure_provenance_columns(v.bars_clean(spark, sf))
    return rows.agg(
        F.count(F.lit(1)).alias("row_count"), F.count("data_backend").alias("with_backend")
    )


@query(
    "j16_registered_records",
    """SELECT symbol, min(data_backend) AS data_backend, suppkey % 5 IN (1, 3, 4) AS registered,
         count(*) AS row_count FROM bars_prov GROUP BY symbol, suppkey""",
)
def j16_registered_records(spark, sf):
    known = matches_record(KBS) | matches_record(VCI)
    rows = v.bars_prov(spark, sf).select("symbol", *PROVENANCE_COLUMNS)
    return (
        rows.groupBy("symbol", *PROVENANCE_COLUMNS)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select("symbol", "data_backend", known.alias("registered"), "row_count")
    )


# --- panel ---------------------------------------------------------------------------

_PANEL_SQL = """
  SELECT symbol, strftime(date, '%Y-%m-%d') AS date, open, high, low, close, volume, data_backend,
    'observed_provider_bar' AS observation_status, 'unknown' AS price_adjustment_status,
    'daily-panel-v2' AS feature_input_contract_version, '{status}' AS unit_provenance_status,
    {ok} AS vnd_traded_value_permitted, '{name}' AS unit_policy_name
  FROM bars_prov WHERE date >= DATE '1995-01-02' {where}"""
#: No bar is later, however far a supplier's lines are spread.
_FAR = "9999-12-31"
_PANEL_COLUMNS = [
    "symbol", "date", "open", "high", "low", "close", "volume", "data_backend",
    "observation_status", "price_adjustment_status", "feature_input_contract_version",
    "unit_provenance_status", "vnd_traded_value_permitted", "unit_policy_name",
]


@query(
    "n15_panel",
    _PANEL_SQL.format(status="ambiguous", ok="false", name="unverified", where=""),
)
def n15_panel(spark, sf):
    return panel.daily_panel(v.bars_prov(spark, sf), "1995-01-02", _FAR).select(
        *_PANEL_COLUMNS
    )


@query(
    "n15_panel_verified",
    _PANEL_SQL.format(
        status="verified", ok="true", name="vnstock-kbs-daily-ohlcv", where="AND suppkey % 5 >= 3"
    ),
)
def n15_panel_verified(spark, sf):
    chosen = v.suppliers(spark, sf).where("suppkey % 5 >= 3")
    return panel.daily_panel(
        v.bars_prov(spark, sf), "1995-01-02", _FAR, chosen
    ).select(*_PANEL_COLUMNS)


@query(
    "f1_select_window",
    """SELECT symbol, strftime(date, '%Y-%m-%d') AS date, close FROM bars_clean
       WHERE suppkey % 3 = 0 AND date BETWEEN DATE '1995-03-01' AND DATE '2001-06-30'""",
)
def f1_select_window(spark, sf):
    chosen = v.suppliers(spark, sf).where("suppkey % 3 = 0")
    return panel.select_window(
        v.bars_clean(spark, sf), "1995-03-01", "2001-06-30", chosen
    ).select("symbol", "date", "close")


@query(
    "f2_select_or_undated",
    f"""SELECT symbol, count(*) AS row_count, {n_where("date IS NULL")} AS undated
        FROM bars_raw WHERE date IS NULL OR date BETWEEN DATE '1995-06-01' AND DATE '2001-06-30'
        GROUP BY symbol""",
)
def f2_select_or_undated(spark, sf):
    bars = normalize.daily_bars(v.bars_raw(spark, sf), v.stamp())
    rows = panel.select_window(bars, "1995-06-01", "2001-06-30", keep_undated=True)
    return rows.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("row_count"), x.count_where(F.col("date").isNull()).alias("undated")
    )


# --- availability --------------------------------------------------------------------


@query(
    "a3_availability",
    f"""SELECT p.symbol, strftime(min(date), '%Y-%m-%d') AS observed_start_date,
          strftime(max(date), '%Y-%m-%d') AS observed_end_date,
          count(r.symbol) AS observation_count,
          CAST(count(r.symbol) - count(DISTINCT date) AS BIGINT) AS duplicate_count,
          {n_where(f"r.symbol IS NOT NULL AND {NULL_OHLC}")} AS missing_ohlc_count,
          {n_where(BAD_OHLC)} AS invalid_ohlc_count, {n_where("volume = 0")} AS zero_volume_count,
          (SELECT count(*) FROM cal) AS expected_weekday_count,
          count(DISTINCT cal.d) AS observed_expected_weekday_count,
          (SELECT count(*) FROM cal) - count(DISTINCT cal.d) AS missing_expected_weekday_count,
          count(DISTINCT cal.d) / (SELECT count(*) FROM cal)::DOUBLE AS weekday_coverage_ratio,
          {n_where("isodow(date) >= 6")} AS weekend_observation_count,
          count(r.symbol) = 0 AS absence_of_data
        FROM (SELECT symbol, suppkey FROM suppliers UNION ALL SELECT 'NONE', -1) p
        LEFT JOIN (SELECT * FROM bars_raw
          WHERE date BETWEEN DATE '1995-01-02' AND DATE '2001-11-30') r
          ON r.symbol = p.symbol
        LEFT JOIN cal ON cal.d = date GROUP BY p.symbol""",
    {"cal": calendar("1995-01-02", "2001-11-30")},
)
def a3_availability(spark, sf):
    asked = v.suppliers(spark, sf).select("symbol").unionAll(
        spark.createDataFrame([(" none ",)], "symbol string")
    )
    bars = normalize.daily_bars(v.bars_raw(spark, sf), v.stamp())
    return panel.availability(bars, asked, "1995-01-02", "2001-11-30").drop(
        "feature_input_contract_version", "requested_start_date", "requested_end_date",
        "expected_session_model", "holiday_calendar_status",
    )


# --- liquidity -----------------------------------------------------------------------

_LIQUIDITY_VIEWS = {
    "liq_rows": """SELECT symbol, suppkey, date, close, volume FROM bars_prov
        UNION ALL SELECT symbol, suppkey, DATE '2001-06-24', 10.0, 5.0 FROM suppliers
        WHERE suppkey % 17 = 0""",
    "liq_cal": calendar("2001-01-01", "2001-06-29"),
    "liq_window": "SELECT d FROM liq_cal ORDER BY d DESC LIMIT 20",
    "liq_stats": """
        SELECT p.symbol, p.suppkey, count(DISTINCT w.d) AS observed,
          count(*) FILTER (WHERE w.d IS NOT NULL AND volume IS NOT NULL) AS valid,
          count(*) FILTER (WHERE w.d IS NOT NULL AND volume > 0) AS positive,
          count(*) FILTER (WHERE w.d IS NOT NULL AND volume = 0) AS zeros,
          count(*) FILTER (WHERE r.date IS NOT NULL AND w.d IS NULL) AS outside,
          CAST(sum(CAST(volume AS DECIMAL(18,4))) FILTER (WHERE w.d IS NOT NULL) AS DOUBLE) AS vol,
          CAST(sum(CAST(close * 1000 * volume AS DECIMAL(18,4))) FILTER (WHERE w.d IS NOT NULL)
            AS DOUBLE) AS worth,
          arg_max(close, w.d) AS recent_close, max(w.d) AS recent_date
        FROM suppliers p LEFT JOIN liq_rows r ON r.symbol = p.symbol
          AND r.date BETWEEN (SELECT min(d) FROM liq_window) AND DATE '2001-06-29'
        LEFT JOIN liq_window w ON w.d = r.date GROUP BY p.symbol, p.suppkey""",
}


def _liquidity_sql(where: str, worth: str, extra: list[tuple[str, str]]) -> str:
    failures = [
        ("positive / 20.0 < 0.2", "trading_frequency_below_minimum"),
        ("valid = 0 OR zeros / valid::DOUBLE > 0.2", "zero_volume_frequency_above_maximum"),
        ("valid = 0 OR vol / valid < 25", "average_volume_below_minimum"),
        *extra,
    ]
    any_failure = " OR ".join(f"({c})" for c, _ in failures)
    base = f"""CASE WHEN observed = 0 THEN '["no_daily_observations"]'
        WHEN observed < 3 THEN '["insufficient_history"]'
        WHEN {any_failure} THEN {json_list(failures)}
        ELSE '["configured_liquidity_criteria_passed"]' END"""
    return f"""
      SELECT symbol, observed AS observed_date_count, valid AS valid_volume_observation_count,
        positive AS positive_volume_observation_count, zeros AS zero_volume_observation_count,
        outside AS out_of_weekday_calendar_observation_count,
        positive / 20.0::DOUBLE AS trading_frequency,
        CASE WHEN valid > 0 THEN zeros / valid::DOUBLE END AS zero_volume_frequency,
        CASE WHEN valid > 0 THEN vol / valid END AS average_volume_provider_units,
        {worth} AS average_traded_value_vnd, recent_close AS recent_valid_close,
        strftime(recent_date, '%Y-%m-%d') AS recent_valid_close_date,
        observed < 3 AS insufficient_history,
        CASE WHEN observed = 0 THEN 'absent' WHEN observed >= 20 THEN 'complete_weekday_coverage'
          ELSE 'partial' END AS missing_data_status,
        CASE WHEN outside > 0 THEN 'failed' WHEN observed = 0 THEN 'absent_data'
          WHEN observed < 3 THEN 'insufficient_history' WHEN {any_failure} THEN 'failed'
          ELSE 'passed' END AS screen_status,
        CASE WHEN outside > 0 THEN replace({base}, ']', ',"out_of_weekday_calendar_observations"]')
          ELSE {base} END AS screen_reasons
      FROM liq_stats {where}"""


def liquidity_input(spark, sf):
    weekend = v.suppliers(spark, sf).where("suppkey % 17 = 0").select(
        "symbol",
        F.lit("2001-06-24").cast("date").alias("date"),
        F.lit(10.0).alias("close"),
        F.lit(5.0).alias("volume"),
    )
    bars = v.bars_prov(spark, sf).select("symbol", "date", "close", "volume", *PROVENANCE_COLUMNS)
    return staged(bars.unionByName(weekend, allowMissingColumns=True))


LIQUIDITY_CONFIG = panel.LiquidityConfig(20, 3, 0.2, 0.2, 25.0)
_LIQUIDITY_HIDDEN = [
    "feature_input_contract_version", "reference_date", "window_start_date", "window_weekdays",
    *PROVENANCE_COLUMNS, *EFFECTIVE_UNIT_COLUMNS,
]


@query(
    "a4_liquidity",
    _liquidity_sql("", "CAST(NULL AS DOUBLE)", []),
    _LIQUIDITY_VIEWS,
)
def a4_liquidity(spark, sf):
    return panel.liquidity(
        liquidity_input(spark, sf), v.suppliers(spark, sf), "2001-06-29", LIQUIDITY_CONFIG
    ).drop(*_LIQUIDITY_HIDDEN)


@query(
    "a4_liquidity_money",
    _liquidity_sql(
        "WHERE suppkey % 5 >= 3 AND suppkey % 17 <> 0",
        "CASE WHEN valid > 0 THEN worth / valid END",
        [("valid = 0 OR worth / valid < 1500000000", "average_traded_value_vnd_below_minimum")],
    ),
    _LIQUIDITY_VIEWS,
)
def a4_liquidity_money(spark, sf):
    chosen = v.suppliers(spark, sf).where("suppkey % 5 >= 3 and suppkey % 17 <> 0")
    config = panel.LiquidityConfig(20, 3, 0.2, 0.2, 25.0, 1_500_000_000.0)
    return panel.liquidity(liquidity_input(spark, sf), chosen, "2001-06-29", config).drop(
        *_LIQUIDITY_HIDDEN
    )


_MERGE_VIEWS = {
    **_LIQUIDITY_VIEWS,
    "screened": _liquidity_sql("", "CAST(NULL AS DOUBLE)", []),
    "prepared": _UNIVERSE_SQL.format(extra="", status="current_snapshot_only"),
}


@query(
    "j1_liquidity_merge",
    """SELECT input_row_number, p.symbol, s.screen_status AS liquidity_screen_status,
         CASE WHEN candidate_status <> 'included_candidate' THEN candidate_status
           WHEN s.screen_status = 'failed' THEN 'excluded'
           WHEN s.screen_status = 'passed' THEN candidate_status ELSE 'uncertain' END
           AS candidate_status,
         CASE WHEN candidate_status <> 'included_candidate' THEN candidate_reasons
           ELSE replace(candidate_reasons, ']', ',"' || CASE s.screen_status
             WHEN 'failed' THEN 'liquidity_screen_failed' WHEN 'passed'
             THEN 'liquidity_screen_passed' WHEN 'absent_data' THEN 'liquidity_absent_data'
             WHEN 'insufficient_history' THEN 'liquidity_insufficient_history'
             ELSE 'liquidity_not_available' END || '"]') END AS candidate_reasons
       FROM prepared p LEFT JOIN (SELECT * FROM screened s JOIN suppliers USING (symbol)
         WHERE suppkey % 3 <> 0) s ON p.symbol = s.symbol""",
    _MERGE_VIEWS,
)
def j1_liquidity_merge(spark, sf):
    prepared = universe.research_universe(normalized_universe(spark, sf), "ASIA")
    chosen = v.suppliers(spark, sf).where("suppkey % 3 <> 0")
    screened = panel.liquidity(
        liquidity_input(spark, sf), chosen, "2001-06-29", LIQUIDITY_CONFIG
    )
    return universe.apply_liquidity(prepared, screened).select(
        "input_row_number", "symbol", "liquidity_screen_status", "candidate_status",
        "candidate_reasons",
    )
