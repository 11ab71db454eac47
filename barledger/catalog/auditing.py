"""Queries for the coverage audit and its parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from barledger.catalog import views as v
from barledger.catalog.oracles import (
    BAD_OHLC,
    FRACTIONAL,
    NULL_OHLC,
    calendar,
    json_list,
    n_where,
    policy,
)
from barledger.catalog.registry import query
from barledger.contracts import COVERAGE_STATUSES, PROVENANCE_COLUMNS
from barledger.operators import coverage, normalize
from barledger.operators.sets import symbol_union, upper_symbols
from barledger.sources.staging import staged

AUDIT = ("1995-01-02", "2001-11-04")
CONFIG = coverage.CoverageConfig(365, 0.205, 10, 0.2)


def audit_daily(spark, sf):
    """Clean bars with provenance; every 11th supplier keeps its planted defects."""
    good = v.bars_prov(spark, sf).where("suppkey % 11 <> 0")
    bad = normalize.daily_bars(
        v.bars_raw(spark, sf).where("suppkey % 11 = 0"),
        v.stamp(),
        "HOSE",
        carry=["suppkey", F.col("l_orderkey").alias("orderkey")],
    )
    rows = good.unionByName(bad, allowMissingColumns=True)
    return staged(
        rows.withColumn(
            "__input_path", F.concat(F.lit("part-"), (F.col("orderkey") % 3).cast("string"))
        )
    )


def audit_universe(spark, sf):
    return v.suppliers(spark, sf).where("suppkey % 7 <> 0").select("symbol")


def audit_requested(spark, sf):
    """Most suppliers' symbols, and for some suppliers one more that has no rows anywhere."""
    known = v.suppliers(spark, sf).where("suppkey % 17 <> 0").select("symbol")
    absent = v.suppliers(spark, sf).where("suppkey % 26 = 0")
    return known.unionByName(absent.select(F.concat(F.lit("A"), F.col("suppkey").cast("string")).alias("symbol")))


def audited(spark, sf):
    return coverage.audit_coverage(
        audit_daily(spark, sf),
        audit_universe(spark, sf),
        audit_requested(spark, sf),
        "2001-11-04",
        "run-1",
        *AUDIT,
        CONFIG,
    )


_PROV = ", ".join(PROVENANCE_COLUMNS)
_NO_PROV = ", ".join(
    f"CAST(NULL AS {'DOUBLE' if '_scale_' in c else 'VARCHAR'}) AS {c}"
    for c in PROVENANCE_COLUMNS
    if c not in ("provider", "source_resolution")
)
COVERAGE_VIEWS = {
    "cov_rows": f"""SELECT symbol, date, open, high, low, close, volume, {_PROV},
          'part-' || (orderkey % 3) AS path FROM bars_prov
        WHERE suppkey % 11 <> 0
          AND date BETWEEN DATE '{AUDIT[0]}' AND DATE '{AUDIT[1]}'
        UNION ALL BY NAME SELECT symbol, date, open, high, low, close, volume,
          'vnstock' AS provider, '1D' AS source_resolution, {_NO_PROV},
          'part-' || (l_orderkey % 3) AS path FROM bars_raw
        WHERE suppkey % 11 = 0
          AND (date IS NULL OR date BETWEEN DATE '{AUDIT[0]}' AND DATE '{AUDIT[1]}')""",
    "cov_cal": calendar(*AUDIT),
    "cov_span": """SELECT symbol, min(date) AS first_d, max(date) AS last_d FROM cov_rows
        WHERE date IS NOT NULL GROUP BY symbol""",
    "cov_expected": """SELECT s.symbol, c.d, c.n, r.date IS NULL AS absent FROM cov_span s
        JOIN cov_cal c ON c.d BETWEEN s.first_d AND s.last_d
        LEFT JOIN (SELECT DISTINCT symbol, date FROM cov_rows) r
          ON r.symbol = s.symbol AND r.date = c.d""",
    "cov_streak": """SELECT symbol, max(len) AS streak FROM (SELECT symbol, count(*) AS len FROM (
          SELECT symbol, n - row_number() OVER (PARTITION BY symbol ORDER BY n) AS island
          FROM cov_expected WHERE absent) GROUP BY symbol, island) GROUP BY symbol""",
    "cov_gap": """SELECT symbol, count(*) AS span_days, count(*) FILTER (WHERE absent)
          AS span_missing FROM cov_expected GROUP BY symbol""",
    "cov_conflict": """SELECT symbol, count(*) AS conflicts FROM (SELECT symbol, date
          FROM cov_rows WHERE date IS NOT NULL GROUP BY symbol, date
          HAVING count(*) > 1 AND count(DISTINCT (open, high, low, close, volume)) > 1)
        GROUP BY symbol""",
    "cov_policy": policy("cov_rows", "symbol"),
    "cov_spine": """SELECT symbol, suppkey % 7 <> 0 AS in_universe, suppkey % 17 <> 0 AS in_request
        FROM suppliers UNION ALL SELECT 'A' || suppkey, false, true FROM suppliers WHERE suppkey % 26 = 0""",
    "cov_m": f"""
        SELECT p.symbol, p.in_universe, p.in_request, count(r.symbol) AS n,
          count(DISTINCT r.date) AS dates, min(r.date) AS first_d, max(r.date) AS last_d,
          CAST(count(r.date) - count(DISTINCT r.date) AS BIGINT) AS dups,
          {n_where("r.symbol IS NOT NULL AND r.date IS NULL")} AS undated,
          {n_where("isodow(r.date) >= 6")} AS weekend,
          count(DISTINCT CASE WHEN isodow(r.date) < 6 THEN r.date END) AS weekdays,
          {n_where(f"r.symbol IS NOT NULL AND {NULL_OHLC}")} AS missing_ohlc,
          {n_where(BAD_OHLC)} AS bad_ohlc,
          {n_where("r.symbol IS NOT NULL AND volume IS NULL")} AS no_volume,
          {n_where("volume < 0")} AS neg_volume, {n_where(FRACTIONAL)} AS frac_volume,
          {n_where("volume = 0")} AS zero_volume, count(DISTINCT path) AS files
        FROM cov_spine p LEFT JOIN cov_rows r ON r.symbol = p.symbol
        WHERE p.in_universe OR p.in_request OR r.symbol IS NOT NULL
        GROUP BY p.symbol, p.in_universe, p.in_request""",
    "cov_j": f"""SELECT m.*, coalesce(conflicts, 0) AS conflicts, coalesce(streak, 0) AS streak,
          coalesce(span_days, 0) AS span_days, coalesce(span_missing, 0) AS span_missing,
          (SELECT count(*) FROM cov_cal) AS expected,
          CASE WHEN last_d IS NOT NULL THEN greatest(date_diff('day', last_d,
            DATE '{AUDIT[1]}'), 0) END AS stale_days,
          coalesce(unit_provenance_status, 'no_data') AS prov,
          coalesce(permitted, false) AS permitted, u_backend, u_provider
        FROM cov_m m LEFT JOIN cov_conflict USING (symbol) LEFT JOIN cov_streak USING (symbol)
          LEFT JOIN cov_gap USING (symbol) LEFT JOIN cov_policy USING (symbol)""",
}
_BLOCKERS = [
    ("NOT in_request AND n > 0", "observed_symbol_not_declared_in_source_manifest"),
    ("undated > 0", "invalid_dates"),
    ("dups > 0", "duplicate_symbol_date_rows"),
    ("conflicts > 0", "conflicting_duplicate_values"),
    ("missing_ohlc > 0", "missing_ohlc_values"),
    ("bad_ohlc > 0", "invalid_ohlc_relationships"),
    ("no_volume > 0", "missing_volume_values"),
    ("neg_volume > 0", "negative_volume_values"),
    ("frac_volume > 0", "non_integer_volume_values"),
    ("weekend > 0", "weekend_observations"),
]
_LADDER = [
    ("n = 0 AND NOT in_request", "not_ingested", "symbol_not_requested_in_source_run"),
    ("n = 0", "absent", "requested_symbol_has_no_daily_observations"),
    (" OR ".join(f"({c})" for c, _ in _BLOCKERS), "blocking_quality_issues", None),
    ("stale_days > 10", "stale", "last_observation_is_stale"),
    ("dates < 365", "insufficient_history", "history_observations_below_minimum"),
    (
        "span_days = 0 OR (span_days - span_missing) / span_days::DOUBLE < 0.205",
        "sparse",
        "observed_span_coverage_below_minimum",
    ),
    (
        "n = no_volume OR zero_volume / (n - no_volume)::DOUBLE > 0.2",
        "sparse",
        "zero_volume_frequency_above_maximum",
    ),
    ("permitted", "usable_vnd", 'raw_ohlcv_coverage_passed","vnd_unit_provenance_verified'),
    ("true", "usable_non_monetary", 'raw_ohlcv_coverage_passed","vnd_unit_provenance_unverified'),
]
_STATUS = "CASE " + " ".join(f"WHEN {c} THEN '{s}'" for c, s, _ in _LADDER) + " END"
_REASONS = (
    "CASE "
    + " ".join(
        f"WHEN {c} THEN " + (json_list(_BLOCKERS) if r is None else f"'[\"{r}\"]'")
        for c, _, r in _LADDER
    )
    + " END"
)
COVERAGE_VIEWS["cov"] = f"""
    SELECT symbol, CASE WHEN in_universe THEN 'current_snapshot_candidate'
        ELSE 'not_in_selected_current_snapshot' END AS current_universe_snapshot_status,
      CASE WHEN in_request THEN 'requested' WHEN n > 0 THEN 'not_requested_but_observed'
        ELSE 'not_requested' END AS source_run_request_status,
      strftime(first_d, '%Y-%m-%d') AS first_observation_date,
      strftime(last_d, '%Y-%m-%d') AS last_observation_date, n AS observation_count,
      dates AS unique_observation_date_count, dups AS duplicate_row_count,
      conflicts AS conflicting_duplicate_date_count, files AS source_file_count,
      expected AS requested_weekday_count,
      weekdays / expected::DOUBLE AS requested_weekday_coverage_ratio,
      span_days AS observed_span_weekday_count,
      span_missing AS observed_span_missing_weekday_count,
      CASE WHEN span_days > 0 THEN (span_days - span_missing) / span_days::DOUBLE END
        AS observed_span_coverage_ratio,
      streak AS longest_missing_weekday_streak, weekend AS weekend_observation_count,
      undated AS invalid_date_count, missing_ohlc AS missing_ohlc_count,
      bad_ohlc AS invalid_ohlc_count, no_volume AS missing_volume_count,
      neg_volume AS negative_volume_count, frac_volume AS non_integer_volume_count,
      zero_volume AS zero_volume_count,
      CASE WHEN n > no_volume THEN zero_volume / (n - no_volume)::DOUBLE END
        AS zero_volume_frequency,
      stale_days AS stale_calendar_days, coalesce(stale_days > 10, false) AS stale,
      u_provider AS provider, u_backend AS data_backend, prov AS unit_provenance_status,
      permitted AS vnd_traded_value_permitted, {_STATUS} AS coverage_status,
      {_REASONS} AS coverage_reasons,
      {_STATUS} IN ('usable_vnd', 'usable_non_monetary') AS raw_ohlcv_research_usable,
      {_STATUS} = 'usable_vnd' AS vnd_liquidity_research_usable
    FROM cov_j"""

_HIDDEN = [
    "feature_input_contract_version", "universe_snapshot_date", "daily_run_id",
    "requested_start_date", "requested_end_date", "minimum_history_observations",
    "minimum_span_coverage_ratio", "maximum_zero_volume_frequency", "unit_verification_status",
    "unit_policy_name", "unit_policy_version", "price_unit", "volume_unit", "traded_value_unit",
    "unit_evidence_reference", "unit_verification_reason", "adjusted_price_research_usable",
    "point_in_time_universe_research_usable", "known_risks",
]


@query("a5_coverage", "SELECT * FROM cov", COVERAGE_VIEWS)
def a5_coverage(spark, sf):
    return audited(spark, sf).drop(*_HIDDEN)


@query(
    "a6_coverage_summary",
    f"""SELECT count(*) AS audited_symbol_count,
      {n_where("current_universe_snapshot_status = 'current_snapshot_candidate'")}
        AS current_snapshot_symbol_count,
      {n_where("source_run_request_status = 'requested'")} AS source_run_requested_symbol_count,
      {n_where("observation_count > 0")} AS symbols_with_daily_data,
      {n_where("raw_ohlcv_research_usable")} AS raw_ohlcv_usable_symbol_count,
      {n_where("vnd_liquidity_research_usable")} AS vnd_liquidity_usable_symbol_count,
      (SELECT count(*) FROM vnd_now) AS current_snapshot_vnd_usable_symbol_count,
      {", ".join(n_where(f"coverage_status = '{s}'") + f" AS status_{s}" for s in COVERAGE_STATUSES)},
      min(first_observation_date) AS earliest_observation_date,
      max(last_observation_date) AS latest_observation_date,
      (SELECT coalesce(max(first_observation_date) <= min(last_observation_date), false)
        FROM vnd_now) AS common_vnd_overlap_available,
      (SELECT CASE WHEN max(first_observation_date) <= min(last_observation_date)
        THEN max(first_observation_date) END FROM vnd_now) AS common_vnd_start_date,
      (SELECT CASE WHEN max(first_observation_date) <= min(last_observation_date)
        THEN min(last_observation_date) END FROM vnd_now) AS common_vnd_end_date
    FROM cov""",
    {
        **COVERAGE_VIEWS,
        "vnd_now": """SELECT * FROM cov WHERE vnd_liquidity_research_usable AND
            current_universe_snapshot_status = 'current_snapshot_candidate'""",
    },
)
def a6_coverage_summary(spark, sf):
    return coverage.summarize_coverage(audited(spark, sf))


@query(
    "a6_provenance_counts",
    "SELECT unit_provenance_status, count(*) AS symbol_count FROM cov GROUP BY 1",
    COVERAGE_VIEWS,
)
def a6_provenance_counts(spark, sf):
    return coverage.coverage_provenance_counts(audited(spark, sf))


@query(
    "a6_usable_symbols",
    """SELECT 'raw_ohlcv_usable' AS list_name, symbol FROM cov WHERE raw_ohlcv_research_usable
       UNION ALL SELECT 'vnd_liquidity_usable', symbol FROM cov WHERE vnd_liquidity_research_usable
       UNION ALL SELECT 'current_snapshot_vnd_usable', symbol FROM cov
         WHERE vnd_liquidity_research_usable
         AND current_universe_snapshot_status = 'current_snapshot_candidate'
       UNION ALL SELECT 'source_run_requested', symbol FROM cov
         WHERE source_run_request_status = 'requested'""",
    COVERAGE_VIEWS,
)
def a6_usable_symbols(spark, sf):
    return coverage.usable_symbols(audited(spark, sf))


@query(
    "a28_conflicts",
    """SELECT symbol, count(*) AS conflicting_dates FROM (SELECT symbol, date FROM bars_raw
         WHERE date IS NOT NULL GROUP BY symbol, date
         HAVING count(*) > 1 AND count(DISTINCT (open, high, low, close, volume)) > 1)
       GROUP BY symbol""",
)
def a28_conflicts(spark, sf):
    days = coverage.day_facts(normalize.daily_bars(v.bars_raw(spark, sf), v.stamp()))
    return days.where("conflict").groupBy("symbol").agg(
        F.count(F.lit(1)).alias("conflicting_dates")
    )


@query(
    "a30_source_files",
    "SELECT symbol, count(DISTINCT path) AS source_file_count FROM cov_rows GROUP BY symbol",
    COVERAGE_VIEWS,
)
def a30_source_files(spark, sf):
    return coverage.source_file_counts(audit_daily(spark, sf))


@query(
    "w2_longest_gap",
    """SELECT symbol, max(len) AS longest_missing_weekday_streak FROM (
         SELECT symbol, island, count(*) AS len FROM (
           SELECT s.symbol, n - row_number() OVER (PARTITION BY s.symbol ORDER BY n) AS island
           FROM span s JOIN cal ON d BETWEEN first_d AND last_d
           ANTI JOIN bars_clean b ON b.symbol = s.symbol AND b.date = d) GROUP BY symbol, island)
       GROUP BY symbol""",
    {
        "cal": calendar("1995-01-01", "2001-12-31"),
        "span": """SELECT symbol, min(date) AS first_d, max(date) AS last_d FROM bars_clean
            GROUP BY symbol""",
    },
)
def w2_longest_gap(spark, sf):
    days = v.bars_clean(spark, sf).select("symbol", "date").distinct()
    return coverage.longest_gaps(days)


@query(
    "u2_symbol_union",
    "SELECT symbol FROM cov",
    COVERAGE_VIEWS,
)
def u2_symbol_union(spark, sf):
    return symbol_union(
        [
            audit_universe(spark, sf),
            audit_requested(spark, sf),
            upper_symbols(audit_daily(spark, sf)),
        ]
    )


@query(
    "u2_expected_symbol_count",
    "SELECT count(*) AS expected_symbol_count FROM cov",
    COVERAGE_VIEWS,
)
def u2_expected_symbol_count(spark, sf):
    return coverage.coverage_symbol_count(
        audit_daily(spark, sf), audit_universe(spark, sf), audit_requested(spark, sf), *AUDIT
    )
