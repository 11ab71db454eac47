import datetime as dt

import pytest
from helpers import KBS, daily, names, stamp, symbols
from pyspark.sql import functions as F

from barledger.operators import coverage, normalize, panel, quality, universe


def prepared(spark, rows, snapshot=None, reference=None):
    raw = spark.createDataFrame(
        rows, "symbol string, exchange string, type string, input_ordinal bigint"
    )
    normalized = normalize.universe_rows(raw, snapshot if snapshot is not None else stamp())
    normalized = normalized.withColumn(
        "symbol", F.coalesce(F.col("symbol"), F.lit(" "))
    )
    return universe.research_universe(normalized, "HOSE", reference)


CANDIDATES = [
    ("FPT", "HOSE", "stock", 0),
    ("HPG", "HOSE", "stock", 1),
    (" fpt ", "HOSE", "stock", 2),
    (" ", "HOSE", "stock", 3),
    ("E1VFVN30", "HOSE", "fund", 4),
    ("XYZ", "HOSE", "mystery", 5),
]


def test_candidate_precedence(spark):
    rows = prepared(spark, CANDIDATES, reference="2020-01-02").collect()
    assert len(rows) == 6
    by = {r.input_row_number: r for r in rows}
    assert [by[i].candidate_status for i in range(6)] == [
        "uncertain", "included_candidate", "uncertain", "excluded", "excluded", "uncertain",
    ]
    assert by[4].candidate_reasons == [
        "provider_reported_non_stock_type:fund", "historical_membership_not_verified",
    ]
    assert {r.historical_membership_status for r in rows} == {"requested_reference_unverified"}
    assert not any(r.historical_membership_verified for r in rows)


def test_naive_snapshot_blocks(spark):
    rows = prepared(spark, CANDIDATES, F.lit("2026-07-04 10:00:00"))
    assert {r.source_snapshot_timezone_status for r in rows.collect()} == {"naive"}
    found = names(quality.check_research_universe(rows, 6))
    assert found["snapshot_timezone_awareness"].blocks_output
    assert "input_rows_auditable" not in found


def test_panel_preserves_sparse_rows(spark):
    rows = daily(spark, [("FPT", "2026-06-03", 10.0, 5), ("FPT", "2026-06-01", 10.0, 5)])
    built = panel.daily_panel(rows, "2026-06-01", "2026-06-30")
    assert built.count() == 2
    r = built.first()
    assert r.unit_provenance_status == "legacy_missing" and not r.vnd_traded_value_permitted
    found = names(quality.check_daily_panel(built, 2))
    assert set(found) == {"price_adjustment_unknown"}
    with pytest.raises(ValueError):
        panel.daily_panel(rows, "2026-06-30", "2026-06-01")


def test_panel_checks_catch_tampering(spark):
    rows = daily(spark, [("FPT", "2026-06-03", 10.0, 5)], KBS)
    built = panel.daily_panel(rows, "2026-06-01", "2026-06-30")
    assert built.first().vnd_traded_value_permitted
    forged = built.withColumn("price_unit", F.lit("vnd"))
    assert "effective_unit_provenance_consistency" in names(quality.check_daily_panel(forged, 1))
    assert "observed_rows_preserved" in names(quality.check_daily_panel(built, 2))


def test_availability(spark):
    rows = daily(spark, [("FPT", "2026-06-29", 10.0, 0), ("FPT", "2026-07-01", 10.0, 7)])
    got = {
        r.symbol: r
        for r in panel.availability(
            rows, symbols(spark, ["fpt", "VCB"]), "2026-06-29", "2026-07-03"
        ).collect()
    }
    f = got["FPT"]
    assert (f.expected_weekday_count, f.observed_expected_weekday_count) == (5, 2)
    assert (f.missing_expected_weekday_count, f.zero_volume_count) == (3, 1)
    assert got["VCB"].absence_of_data and got["VCB"].observation_count == 0


WEEK = ["2026-06-22", "2026-06-23", "2026-06-24", "2026-06-25", "2026-06-26", "2026-06-29"]
VOLUMES = [100, 0, 100, 100, 100, 999]


def liquid(spark, record=None):
    rows = [("FPT", d, 10.0, v) for d, v in zip(WEEK, VOLUMES, strict=True)]
    return daily(spark, [*rows, ("HPG", "2026-06-26", 10.0, 100)], record)


def test_liquidity_screen(spark):
    config = panel.LiquidityConfig(5, 5, 0.8, 0.2, 90.0)
    got = {
        r.symbol: r
        for r in panel.liquidity(
            liquid(spark), symbols(spark, ["FPT", "HPG", "VCB"]), "2026-06-26", config
        ).collect()
    }
    f = got["FPT"]
    assert (f.trading_frequency, f.zero_volume_frequency) == (0.8, 0.2)
    assert f.average_volume_provider_units == 80.0 and f.screen_status == "failed"
    assert f.screen_reasons == ["average_volume_below_minimum"]
    assert f.missing_data_status == "complete_weekday_coverage"
    assert got["HPG"].screen_status == "insufficient_history"
    assert got["VCB"].screen_status == "absent_data"


def test_liquidity_money_needs_verified_units(spark):
    config = panel.LiquidityConfig(5, 5, 0.8, 0.2, None, 1000.0)
    asked = symbols(spark, ["FPT"])
    r = panel.liquidity(liquid(spark, KBS), asked, "2026-06-26", config).first()
    assert r.average_traded_value_vnd == 800000.0 and r.screen_status == "passed"
    assert r.data_backend == "kbs"
    with pytest.raises(Exception, match="verified unit provenance"):
        panel.liquidity(liquid(spark), asked, "2026-06-26", config).collect()


def test_liquidity_rejects_bad_history(spark):
    config = panel.LiquidityConfig(5, 1)
    asked = symbols(spark, ["FPT"])
    old = daily(spark, [("FPT", "2020-01-02", 10.0, 1)] * 2 + [("FPT", "2026-06-26", 10.0, 1)])
    with pytest.raises(Exception, match="repeats"):
        panel.liquidity(old, asked, "2026-06-26", config).collect()
    negative = daily(spark, [("FPT", "2020-01-02", 10.0, -1)])
    with pytest.raises(Exception, match="negative"):
        panel.liquidity(negative, asked, "2026-06-26", config).collect()
    with pytest.raises(ValueError):
        panel.LiquidityConfig(5, 6)


def test_liquidity_merge(spark):
    rows = prepared(
        spark, [("FPT", "HOSE", "stock", 0), ("HPG", "HOSE", "stock", 1), ("VCB", "HOSE", "etf", 2)]
    )
    config = panel.LiquidityConfig(5, 5, 0.8, 0.2)
    screened = panel.liquidity(liquid(spark), symbols(spark, ["FPT"]), "2026-06-26", config)
    got = {r.symbol: r for r in universe.apply_liquidity(rows, screened).collect()}
    assert got["FPT"].candidate_status == "included_candidate"
    assert got["FPT"].candidate_reasons[-1] == "liquidity_screen_passed"
    assert got["HPG"].candidate_status == "uncertain"
    assert got["HPG"].candidate_reasons[-1] == "liquidity_not_available"
    assert got["VCB"].candidate_status == "excluded" and len(got["VCB"].candidate_reasons) == 1
    with pytest.raises(Exception, match="one row per symbol"):
        universe.apply_liquidity(rows, screened.unionByName(screened)).collect()


def test_coverage_statuses(spark):
    week = ["2026-06-29", "2026-06-30", "2026-07-01", "2026-07-02", "2026-07-03"]
    rows = daily(
        spark,
        [("FPT", d, 10.0, 5) for d in week] + [("VCB", d, 10.0, 5) for d in week[3:]],
        KBS,
    )
    names_ = symbols(spark, ["FPT", "VCB", "HPG"])
    config = coverage.CoverageConfig(5)
    audited = coverage.audit_coverage(
        rows, names_, names_, "2026-07-04", "run", "2026-06-29", "2026-07-03", config
    )
    got = {r.symbol: r.coverage_status for r in audited.collect()}
    assert got == {"FPT": "usable_vnd", "VCB": "insufficient_history", "HPG": "absent"}
    s = coverage.summarize_coverage(audited).first()
    assert (s.audited_symbol_count, s.vnd_liquidity_usable_symbol_count) == (3, 1)
    assert s.common_vnd_start_date == dt.date(2026, 6, 29)
    usable = coverage.usable_symbols(audited).where("list_name = 'vnd_liquidity_usable'")
    assert [r.symbol for r in usable.collect()] == ["FPT"]
    assert quality.check_coverage(audited, 3).count() == 0


def test_coverage_blockers_keep_reason_order(spark):
    rows = daily(
        spark,
        [("FPT", "2026-07-04", 10.0, 5), ("FPT", "2026-07-01", -1.0, 0.5), ("FPT", None, 1.0, 1),
         ("FPT", "2026-07-01", 10.0, -2)],
    )
    none = symbols(spark, [])
    r = coverage.audit_coverage(
        rows, none, none, "2026-07-04", "run", "2026-06-29", "2026-07-04"
    ).first()
    assert r.coverage_reasons == [
        "observed_symbol_not_declared_in_source_manifest", "invalid_dates",
        "duplicate_symbol_date_rows", "conflicting_duplicate_values",
        "invalid_ohlc_relationships", "negative_volume_values", "non_integer_volume_values",
        "weekend_observations",
    ]
    assert (r.observed_span_weekday_count, r.longest_missing_weekday_streak) == (3, 2)


def test_last_valid_close_reads_every_order(spark):
    rows = [("A", "2020-01-01", 1.0, 5), ("A", "2020-01-02", 2.0, 10), ("A", "2020-01-03", None, 1), ("B", "2020-01-01", None, 2)]
    bars = spark.createDataFrame(rows, "symbol string, date string, close double, orderkey bigint")
    got = bars.groupBy("symbol").agg(*panel.last_valid("close")).where("recent_date IS NOT NULL").collect()
    assert [tuple(r) for r in got] == [("A", 2.0, "2020-01-02")]
