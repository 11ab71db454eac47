"""Queries for the data-quality catalogs: every failing check with its count."""

from __future__ import annotations

from pyspark.sql import functions as F

from barledger.catalog import auditing, features
from barledger.catalog import views as v
from barledger.catalog.oracles import FRACTIONAL, HIGH_LOW, HIGH_OC, LOW_OC, NULL_OHLC
from barledger.catalog.registry import query
from barledger.contracts import ASSEMBLED_VERSION
from barledger.operators import checks, coverage, normalize, panel, quality, universe
from barledger.operators.units import PROVENANCE_COLUMNS
from barledger.sources.staging import staged

AS_OF = "2001-06-30"


def brief(results):
    return results.select("severity", "check_name", "affected_row_count", "blocks_output")


def rows_sql(dataset_rows: str, rules: list[tuple[str, str, str]], counted: bool = True) -> str:
    """Oracle rows (severity, check_name, affected_row_count, blocks_output) of row rules."""
    parts = []
    for severity, name, condition in rules:
        parts.append(
            f"SELECT '{severity}' AS severity, '{name}' AS check_name, "
            f"{'count(*)' if counted else 'CAST(0 AS BIGINT)'} AS affected_row_count, "
            f"{'true' if severity == 'ERROR' else 'false'} AS blocks_output "
            f"FROM {dataset_rows} WHERE {condition} HAVING count(*) > 0"
        )
    return " UNION ALL ".join(parts)


def one(severity: str, name: str, count: str, source: str, having: str = "true") -> str:
    return (
        f"SELECT '{severity}' AS severity, '{name}' AS check_name, CAST({count} AS BIGINT) AS "
        f"affected_row_count, {'true' if severity == 'ERROR' else 'false'} AS blocks_output "
        f"FROM {source} HAVING {having}"
    )


_NON_NEG = [
    ("ERROR", f"{c}_non_negative", f"{c} < 0") for c in ("open", "high", "low", "close", "volume")
]
_OHLC = [
    ("ERROR", "high_gte_low", HIGH_LOW),
    ("ERROR", "high_gte_open_close", HIGH_OC),
    ("ERROR", "low_lte_open_close", LOW_OC),
    ("ERROR", "volume_integer_like", FRACTIONAL),
]


def duplicates(name: str, source: str, keys: str) -> str:
    return one(
        "ERROR", name, "sum(n - 1)",
        f"(SELECT count(*) AS n FROM {source} GROUP BY {keys})", "sum(n - 1) > 0",
    )


def daily_input(spark, sf):
    """Raw bars with defects; the landed position follows the order key."""
    raw = v.bars_raw(spark, sf)
    return normalize.daily_bars(raw, v.stamp(), "HOSE", carry=["l_orderkey", "l_linenumber"])


DAILY_SQL = " UNION ALL ".join(
    [
        rows_sql("bars_raw", [*_NON_NEG, *_OHLC, ("ERROR", "future_dates", "date > DATE '2001-07-01'")]),
        duplicates("duplicate_symbol_date", "bars_raw", "symbol, date"),
        one("WARNING", "daily_unit_provenance", "count(*)", "bars_raw"),
    ]
)


@query("dq_daily", DAILY_SQL)
def dq_daily(spark, sf):
    return brief(quality.check_daily(daily_input(spark, sf), AS_OF))


@query(
    "dq_daily_summary",
    f"""SELECT count(*) FILTER (WHERE severity = 'INFO') AS "INFO",
          count(*) FILTER (WHERE severity = 'WARNING') AS "WARNING",
          count(*) FILTER (WHERE severity = 'ERROR') AS "ERROR",
          count(*) FILTER (WHERE blocks_output) AS blocking,
          bool_or(blocks_output) AS has_blocking_errors FROM ({DAILY_SQL})""",
)
def dq_daily_summary(spark, sf):
    return checks.summarize(quality.check_daily(daily_input(spark, sf), AS_OF))


def _sample_sql(name: str, condition: str) -> str:
    return f"""SELECT '{name}' AS check_name, CAST(to_json(list(k ORDER BY rn)) AS VARCHAR)
        AS sample_affected_keys FROM (
          SELECT symbol || '|' || coalesce(strftime(date, '%Y-%m-%d'), '<NA>') AS k,
            row_number() OVER (ORDER BY symbol, date NULLS LAST) AS rn
          FROM bars_raw WHERE {condition} QUALIFY rn <= 5) HAVING count(*) > 0"""


@query(
    "o2_sample_keys",
    " UNION ALL ".join(_sample_sql(n, c) for _, n, c in [*_NON_NEG, *_OHLC])
    + """ UNION ALL SELECT 'duplicate_symbol_date', CAST(to_json(list(k ORDER BY rn)) AS VARCHAR)
        FROM (SELECT symbol || '|' || coalesce(strftime(date, '%Y-%m-%d'), '<NA>') AS k,
            row_number() OVER (ORDER BY symbol, date NULLS LAST) AS rn
          FROM (SELECT symbol, date, row_number() OVER (PARTITION BY symbol, date) AS copy
                FROM bars_raw) WHERE copy > 1 QUALIFY rn <= 5)""",
)
def o2_sample_keys(spark, sf):
    results = quality.check_daily(daily_input(spark, sf), "2100-01-01")
    return results.where(F.size("sample_affected_keys") > 0).select(
        "check_name", "sample_affected_keys"
    )


@query(
    "dq_intraday",
    " UNION ALL ".join(
        [
            rows_sql("intraday_raw", _NON_NEG),
            one("WARNING", "timestamp_timezone_naive", "0", "intraday_raw"),
            one("WARNING", "sorted_symbol_resolution_timestamp", "0", "intraday_raw"),
            duplicates(
                "duplicate_symbol_resolution_timestamp", "intraday_raw", "symbol, zoned, ts_minute"
            ),
            """SELECT 'INFO', 'session_break_gaps', count(*), false FROM (
                 SELECT symbol, t - lag(t) OVER (PARTITION BY symbol ORDER BY t) AS gap FROM (
                   SELECT symbol, CASE WHEN zoned THEN ts_minute - INTERVAL 7 HOUR
                     ELSE ts_minute END AS t FROM intraday_raw))
               WHERE gap > INTERVAL 90 MINUTE GROUP BY symbol""",
        ]
    ),
)
def dq_intraday(spark, sf):
    # Every check reads the bars: written once, their times are parsed once and not in each check.
    bars = staged(normalize.intraday_bars(v.intraday_raw(spark, sf), v.stamp(), carry=["event_id"]))
    return brief(quality.check_intraday(bars, "event_id"))


@query(
    "dq_universe",
    " UNION ALL ".join(
        [
            one(
                "ERROR", "duplicate_symbols",
                "CASE WHEN max(kept) > 0 THEN max(kept) ELSE max(total) END",
                """(SELECT (SELECT count(*) - count(DISTINCT upper(trim(symbol)))
                      FROM universe_raw) AS total,
                    (SELECT count(*) - count(DISTINCT upper(trim(symbol))) FROM universe_raw
                      WHERE exchange = 'ASIA') AS kept)""",
                "max(kept) > 0 OR max(total) > 0",
            ),
            one(
                "WARNING", "null_exchange_fields", "count(*)",
                "(SELECT * FROM universe_raw WHERE exchange IS NULL)", "count(*) > 0",
            ),
            one("INFO", "hose_filtering", "count(*)", "universe_raw"),
        ]
    ),
)
def dq_universe(spark, sf):
    return brief(quality.check_universe(features.normalized_universe(spark, sf), "ASIA"))


@query(
    "dq_research_universe",
    " UNION ALL ".join(
        [
            one("ERROR", "input_rows_auditable", "1", "universe_raw"),
            one("ERROR", "no_false_historical_membership", "0", "universe_raw"),
            rows_sql(
                "universe_raw",
                [
                    ("ERROR", "requested_reference_is_not_membership_evidence", "suppkey % 4 = 0"),
                    ("ERROR", "snapshot_observation_timestamp", "suppkey % 6 = 0"),
                    ("ERROR", "snapshot_timezone_awareness", "suppkey % 6 = 0"),
                ],
            ),
        ]
    ),
)
def dq_research_universe(spark, sf):
    """Prepared universe with planted violations, by supplier number."""
    snapshot = F.when(F.col("input_ordinal") >= 0, "2024-01-31T00:00:00Z")
    raw = v.universe_raw(spark, sf)
    rows = normalize.universe_rows(raw, snapshot).withColumn(
        "snapshot_timestamp_utc",
        F.when(F.floor(F.col("input_ordinal") / 2) % 6 == 0, "2024-01-31 00:00:00").otherwise(
            F.col("snapshot_timestamp_utc")
        ),
    )
    prepared = universe.research_universe(rows, "ASIA", "2020-01-02")
    k = F.floor(F.col("input_row_number") / 2)
    planted = prepared.withColumns(
        {
            "historical_membership_verified": k % 10 == 0,
            "historical_membership_status": F.when(k % 4 == 0, "current_snapshot_only").otherwise(
                F.col("historical_membership_status")
            ),
        }
    )
    expected = raw.agg(F.count(F.lit(1)) - 1).scalar()
    return brief(quality.check_research_universe(planted, expected))


#: A range that every dated line falls into.
_PANEL_RANGE = ("1900-01-01", "2199-12-31")
_PANEL_WHERE = f"date BETWEEN DATE '{_PANEL_RANGE[0]}' AND DATE '{_PANEL_RANGE[1]}'"


@query(
    "dq_panel",
    " UNION ALL ".join(
        [
            rows_sql(
                f"(SELECT * FROM bars_raw WHERE {_PANEL_WHERE})",
                [
                    *_NON_NEG,
                    *_OHLC,
                    ("WARNING", "missing_ohlc_preserved", NULL_OHLC),
                    ("WARNING", "price_adjustment_unknown", "true"),
                    (
                        "ERROR",
                        "effective_unit_provenance_consistency",
                        "symbol = 'S7'",
                    ),
                ],
            ),
            one("ERROR", "no_synthetic_bars", "0", "bars_raw"),
            duplicates(
                "duplicate_symbol_date",
                f"(SELECT * FROM bars_raw WHERE {_PANEL_WHERE})",
                "symbol, date",
            ),
        ]
    ),
)
def dq_panel(spark, sf):
    """Panel of defective bars with one symbol's unit columns tampered with."""
    built = panel.daily_panel(daily_input(spark, sf), *_PANEL_RANGE)
    planted = built.withColumns(
        {
            "price_unit": F.when(F.col("symbol") == "S7", "vnd").otherwise(F.col("price_unit")),
            "observation_status": F.when(F.col("symbol") == "S8", "filled").otherwise(
                F.col("observation_status")
            ),
        }
    )
    expected = panel.select_window(daily_input(spark, sf), *_PANEL_RANGE).agg(
        F.count(F.lit(1))
    )
    return brief(quality.check_daily_panel(planted, expected.scalar()))


@query(
    "dq_liquidity",
    " UNION ALL ".join(
        [
            rows_sql(
                "suppliers",
                [
                    ("ERROR", "trading_frequency_range", "suppkey % 9 = 0"),
                    ("ERROR", "monetary_units_verified", "suppkey % 4 = 0"),
                    ("ERROR", "vnd_permission_requires_verified_provenance", "suppkey % 6 = 0"),
                    ("ERROR", "traded_value_unit_consistency", "suppkey % 4 = 0"),
                    (
                        "ERROR",
                        "effective_unit_provenance_consistency",
                        "suppkey % 6 = 0",
                    ),
                ],
            )
        ]
    ),
)
def dq_liquidity(spark, sf):
    """Liquidity rows with planted monetary claims although units are unverified."""
    rows = panel.liquidity(
        features.liquidity_input(spark, sf), v.suppliers(spark, sf), "2001-06-29",
        features.LIQUIDITY_CONFIG,
    )
    k = F.substring("symbol", 2, 12).cast("int")
    planted = rows.withColumns(
        {
            "trading_frequency": F.when(k % 9 == 0, 1.5).otherwise(F.col("trading_frequency")),
            "average_traded_value_vnd": F.when(k % 4 == 0, 1.0),
            "vnd_traded_value_permitted": k % 6 == 0,
            "unit_provenance_status": F.lit("legacy_missing"),
            "unit_verification_reason": F.lit(
                "Rows predate unit provenance; only non-monetary metrics are allowed."
            ),
            **{
                c: F.lit(None).cast("double" if "_scale_" in c else "string")
                for c in PROVENANCE_COLUMNS
            },
            "unit_evidence_reference": F.lit(None).cast("string"),
        }
    )
    return brief(quality.check_liquidity(planted))


@query(
    "dq_availability",
    rows_sql(
        "suppliers",
        [
            ("ERROR", "weekday_coverage_ratio_range", "suppkey % 7 = 0"),
            ("ERROR", "absence_consistency", "suppkey % 5 = 0"),
        ],
    ),
)
def dq_availability(spark, sf):
    rows = panel.availability(
        v.bars_clean(spark, sf), v.suppliers(spark, sf), "1995-01-01", "2001-11-04"
    )
    k = F.substring("symbol", 2, 12).cast("int")
    planted = rows.withColumns(
        {
            "weekday_coverage_ratio": F.when(k % 7 == 0, -0.5).otherwise(
                F.col("weekday_coverage_ratio")
            ),
            "absence_of_data": k % 5 == 0,
        }
    )
    return brief(quality.check_availability(planted))


@query(
    "dq_coverage",
    " UNION ALL ".join(
        [
            one("ERROR", "audited_symbol_count", "2", "supplier"),
            rows_sql(
                "cov",
                [
                    ("ERROR", "coverage_status_enum", "k % 8 = 0"),
                    ("ERROR", "observed_span_coverage_ratio_range", "k % 10 = 0"),
                    ("ERROR", "diagnostic_counts_non_negative_integers", "k % 12 = 0"),
                    (
                        "ERROR",
                        "absence_status_consistency",
                        "observation_count = 0 AND k % 8 = 0",
                    ),
                    (
                        "ERROR",
                        "source_request_coverage_consistency",
                        "k % 8 = 0 AND source_run_request_status = 'not_requested_but_observed'",
                    ),
                    (
                        "ERROR",
                        "raw_usability_status_consistency",
                        "k % 8 = 0 AND raw_ohlcv_research_usable",
                    ),
                    (
                        "ERROR",
                        "vnd_usability_status_consistency",
                        "k % 8 = 0 AND vnd_liquidity_research_usable",
                    ),
                    (
                        "ERROR",
                        "vnd_usability_requires_verified_provenance",
                        "k % 8 = 0 AND vnd_liquidity_research_usable",
                    ),
                    ("ERROR", "unsupported_research_claims_remain_false", "k % 9 = 0"),
                ],
            ).replace("FROM cov WHERE", "FROM (SELECT *, CAST(substr(symbol, 2) AS INT) AS k FROM cov) WHERE"),
        ]
    ),
    auditing.COVERAGE_VIEWS,
)
def dq_coverage(spark, sf):
    """Coverage rows with planted violations."""
    k = F.substring("symbol", 2, 12).cast("int")
    planted = auditing.audited(spark, sf).withColumns(
        {
            "coverage_status": F.when(k % 8 == 0, "odd").otherwise(F.col("coverage_status")),
            "observed_span_coverage_ratio": F.when(k % 10 == 0, 2.0).otherwise(
                F.col("observed_span_coverage_ratio")
            ),
            "source_file_count": F.when(k % 12 == 0, -1).otherwise(F.col("source_file_count")),
            "adjusted_price_research_usable": k % 9 == 0,
        }
    )
    expected = coverage.coverage_symbol_count(
        auditing.audit_daily(spark, sf), auditing.audit_universe(spark, sf),
        auditing.audit_requested(spark, sf), *auditing.AUDIT,
    ).select(F.col("expected_symbol_count") + 2)
    return brief(quality.check_coverage(planted, expected.scalar()))


@query(
    "dq_quotes",
    " UNION ALL ".join(
        [
            one(
                "WARNING", "missing_requested_symbols", "count(*)",
                """(SELECT DISTINCT c_custkey FROM customer WHERE 'U' || c_custkey
                    NOT IN (SELECT symbol FROM quotes_raw))""",
            ),
            rows_sql(
                "quotes_raw",
                [
                    ("WARNING", "provider_time_raw_present", "user_id % 3 = 2"),
                    ("ERROR", "volume_accumulated_non_negative", "user_id % 7 = 0"),
                ],
            ),
            one("WARNING", "open_price_numeric", "0", "quotes_raw"),
        ]
    ),
)
def dq_quotes(spark, sf):
    asked = v.table(spark, sf, "customer").select(
        F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("symbol")
    )
    quotes = normalize.quote_snapshot(v.quotes_raw(spark, sf), v.stamp())
    return brief(quality.check_quotes(quotes, asked))


@query(
    "dq_assembled",
    " UNION ALL ".join(
        [
            one("ERROR", "assembled_rows_preserved", "5", "suppliers"),
            rows_sql(
                "bars_clean",
                [
                    ("ERROR", "assembly_contract_version_consistent", "suppkey % 9 = 0"),
                    ("ERROR", "campaign_id_consistent", "suppkey % 8 = 0"),
                    ("ERROR", "source_lineage_complete", "suppkey % 7 = 0"),
                ],
            ),
            one(
                "ERROR", "assembled_symbol_date_unique", "count(*)",
                "(SELECT * FROM bars_clean WHERE suppkey % 6 = 0)",
            ),
        ]
    ),
)
def dq_assembled(spark, sf):
    """Assembled rows with planted violations; every sixth supplier is doubled."""
    built = panel.daily_panel(
        v.bars_prov(spark, sf), "1995-01-01", "2001-12-31", carry=["suppkey"]
    )
    k = F.col("suppkey")
    rows = built.withColumns(
        {
            "assembly_contract_version": F.when(k % 9 != 0, ASSEMBLED_VERSION),
            "campaign_id": F.when(k % 8 == 0, "other").otherwise("camp"),
            "assembled_dataset_id": F.lit("id-1"),
            "source_run_id": F.lit("run-1"),
            "source_normalized_path": F.when(k % 7 == 0, " ").otherwise("path"),
        }
    )
    doubled = rows.unionByName(
        rows.where("suppkey % 6 = 0").withColumns(
            {
                "assembly_contract_version": F.lit(ASSEMBLED_VERSION),
                "campaign_id": F.lit("camp"),
                "source_normalized_path": F.lit("path"),
            }
        )
    )
    expected = doubled.agg(F.count(F.lit(1)) + 5).scalar()
    return brief(quality.check_assembled(doubled, expected, "camp", "id-1"))


