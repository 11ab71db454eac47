import pytest
from helpers import KBS, VCI, daily, flat_bars, names, raw_bars, stamp, symbols
from pyspark.sql import functions as F

from barledger.operators import normalize, quality
from barledger.operators.sets import missing_symbols
from barledger.operators.units import unit_policy

AS_OF = "2026-07-04"


def universe_raw(spark, rows):
    return spark.createDataFrame(
        rows, "symbol string, exchange string, type string, input_ordinal bigint"
    )


def test_universe_filter_and_diagnostics(spark):
    raw = universe_raw(
        spark, [("FPT", "HOSE", "stock", 0), ("AAA", None, "stock", 1), ("SHS", "HNX", None, 2)]
    )
    rows = normalize.universe_rows(raw, stamp())
    kept = normalize.universe_snapshot(raw, "hose", stamp()).collect()
    assert [r.symbol for r in kept] == ["FPT"]
    d = normalize.universe_diagnostics(rows).first()
    assert (d.total_returned_rows, d.hose_rows, d.null_exchange_rows) == (3, 1, 1)
    types = {r.security_type: r.row_count for r in normalize.universe_type_counts(rows).collect()}
    assert types == {"stock": 2, "UNKNOWN": 1}


def test_daily_checks(spark):
    raw = raw_bars(
        spark,
        [
            ("fpt", "2026-01-06", 10.0, 8.0, 9.0, 10.0, 100.5),
            ("fpt", "2026-01-05", 10.0, 11.0, 9.0, 10.0, 100.0),
            ("fpt", "2026-01-05", 10.0, 11.0, 9.0, 10.0, 100.0),
        ],
    )
    bars = normalize.daily_bars(raw, stamp())
    found = names(quality.check_daily(bars, AS_OF))
    assert {"duplicate_symbol_date", "high_gte_low", "volume_integer_like"} <= set(found)
    assert found["duplicate_symbol_date"].sample_affected_keys == ["FPT|2026-01-05"]
    assert found["duplicate_symbol_date"].affected_row_count == 1
    assert found["high_gte_low"].blocks_output
    assert found["daily_unit_provenance"].severity == "WARNING"


def test_missing_required_columns_short_circuit(spark):
    found = quality.check_daily(flat_bars(spark, []), AS_OF).collect()
    assert [r.check_name for r in found] == ["required_columns"]


def test_future_dates_use_the_given_day(spark):
    rows = daily(spark, [("FPT", "2026-07-06", 10.0, 1), ("FPT", "2026-07-05", 10.0, 1)])
    assert names(quality.check_daily(rows, AS_OF))["future_dates"].affected_row_count == 1


def test_wrong_resolution_provenance_is_rejected(spark):
    from dataclasses import replace

    with pytest.raises(ValueError):
        daily(spark, [("FPT", "2026-01-05", 1.0, 1)], replace(KBS, source_resolution="1W"))


def test_intraday_duplicates_and_naive_warning(spark):
    raw = spark.createDataFrame(
        [("FPT", "1m", "2026-07-03 09:15:00", 1.0, 1.0, 1.0, 1.0, 1.0)] * 2
        + [("FPT", "1m", "2026-07-03 13:15:00", 1.0, 1.0, 1.0, 1.0, 1.0)],
        "symbol string, resolution string, time string, open double, high double, low double, "
        "close double, volume double",
    )
    found = names(quality.check_intraday(normalize.intraday_bars(raw, stamp())))
    assert {"duplicate_symbol_resolution_timestamp", "timestamp_timezone_naive"} <= set(found)
    assert found["session_break_gaps"].affected_row_count == 1
    assert not found["timestamp_timezone_naive"].blocks_output


def quotes(spark):
    raw = spark.createDataFrame(
        [("fpt", 1783067546136, "HOSE", 10.0, 5.0)],
        "symbol string, time bigint, exchange string, reference_price double, "
        "volume_accumulated double",
    )
    return normalize.quote_snapshot(raw, stamp())


def test_quotes_keep_provider_number(spark):
    rows, asked = quotes(spark), symbols(spark, ["FPT", "hpg"])
    r = rows.first()
    assert r.provider_time_raw == "1783067546136" and r.provider_time_parsed is None
    assert r.provider_time_parse_status == "provider_specific_unparsed"
    assert [m.symbol for m in missing_symbols(asked, rows).collect()] == ["HPG"]
    found = names(quality.check_quotes(rows, asked))
    assert found["missing_requested_symbols"].sample_affected_keys == ["HPG"]
    assert not any(f.blocks_output for f in found.values())


def test_quotes_misleading_1970_blocks(spark):
    rows = quotes(spark).withColumns(
        {
            "provider_time_parsed": F.lit("1970-01-01T00:00:00Z").cast("timestamp"),
            "provider_time_parse_status": F.lit("parsed"),
        }
    )
    found = names(quality.check_quotes(rows, symbols(spark, ["FPT"])))
    assert found["provider_time_not_misleading_1970"].blocks_output
    assert found["numeric_provider_time_unparsed"].blocks_output


ROWS = [("FPT", "2026-01-05", 10.0, 1), ("FPT", "2026-01-06", 10.0, 1)]


def test_unit_policy_statuses(spark):
    kbs, vci, legacy = daily(spark, ROWS, KBS), daily(spark, ROWS, VCI), daily(spark, ROWS)

    def status(df):
        return unit_policy(df).first().unit_provenance_status

    assert status(kbs) == "verified" and status(vci) == "verified"
    assert status(legacy) == "legacy_missing"
    assert status(kbs.unionByName(vci)) == "ambiguous"
    assert status(kbs.unionByName(legacy)) == "ambiguous"
    assert status(kbs.withColumn("data_backend", F.lit("vci"))) == "incompatible"
    assert status(kbs.withColumn("source_price_unit", F.lit("dong"))) == "incompatible"
    assert status(kbs.withColumn("data_backend", F.lit(None).cast("string"))) == "incomplete"
    assert status(kbs.where("false")) == "no_data"
    assert status(kbs.drop("data_backend")) == "incomplete"


def test_unregistered_record_keeps_its_source(spark):
    odd = daily(spark, ROWS, KBS).withColumn("data_backend", F.lit("other"))
    p = unit_policy(odd).first()
    assert p.unit_provenance_status == "incompatible" and not p.vnd_traded_value_permitted
    assert p.policy_data_backend == "other" and p.policy_source.source_price_unit == "thousand_vnd"
    assert p.price_unit == "unknown" and p.unit_policy_name == "unverified"
