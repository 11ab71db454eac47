import datetime as dt

import pytest
from helpers import KBS, daily, flat_bars, names, stamp, symbols
from pyspark.sql import functions as F

from barledger.operators import checks, coverage, panel
from barledger.plans import jobs
from barledger.sources.store import MarketStore, file_digests, input_paths
from barledger.streaming.landed import normalize_landed

AT = dt.datetime(2026, 7, 4, 1)
WEEK = ["2026-06-29", "2026-06-30", "2026-07-01", "2026-07-02", "2026-07-03"]


@pytest.fixture
def store(spark, tmp_path):
    return MarketStore(spark, str(tmp_path / "store"))


def land_universe(store, run="u1"):
    rows = [("FPT", "HOSE", "stock", 0), ("HPG", "HOSE", "stock", 1), ("SHS", "HNX", "stock", 2)]
    raw = store.spark.createDataFrame(
        rows, "symbol string, exchange string, type string, input_ordinal bigint"
    )
    store.land(raw, "universe", run)
    return jobs.ingest_universe(store, run, "HOSE", AT)


def land_daily(store, run="d1"):
    raw = flat_bars(store.spark, [("FPT", d, 10.0, 100) for d in WEEK] + [("HPG", WEEK[0], 5.0, 7)])
    tags = {"request_start_date": F.lit(WEEK[0]), "request_end_date": F.lit(WEEK[-1])}
    store.land(raw, "daily", run, tags)
    return jobs.ingest_daily(
        store, run, ["FPT", "HPG"], WEEK[0], WEEK[-1], provenance=KBS, as_of="2026-07-04", at=AT
    )


def test_feature_pipeline(spark, store):
    assert land_universe(store).status == "success"
    assert land_daily(store).status == "success"
    config = panel.LiquidityConfig(5, 5, 0.8, 0.2, None, 1000.0)
    prepared = jobs.prepare_universe(
        store, "p1", "HOSE", liquidity_config=config, liquidity_reference="2026-07-03", at=AT
    )
    assert prepared.status == "success" and len(prepared.outputs) == 2
    got = {r.symbol: r.candidate_status for r in store.read("features/universe").collect()}
    assert got == {"FPT": "included_candidate", "HPG": "uncertain"}
    with pytest.raises(ValueError, match="after the snapshot"):
        jobs.prepare_universe(
            store, "p2", "HOSE", liquidity_config=config, liquidity_reference="2026-07-05", at=AT
        )
    built = jobs.build_panel(store, "pan", WEEK[0], WEEK[-1], at=AT)
    assert built.status == "success"
    assert store.read("features/daily_panel").count() == 6
    assert store.read("features/availability").count() == 2
    audited = jobs.audit_run_coverage(
        store, "cov", "d1", "HOSE", coverage.CoverageConfig(5), at=AT
    )
    assert audited.status == "success"
    statuses = {r.symbol: r.coverage_status for r in store.read("features/daily_coverage").collect()}
    assert statuses == {"FPT": "usable_vnd", "HPG": "insufficient_history"}
    missing = jobs.audit_run_coverage(store, "cov2", "nope", "HOSE", at=AT)
    assert set(names(missing.results)) == {"daily_source_manifest_available"}
    stored = names(jobs.validate_stored(store, "2026-07-04"))
    assert set(stored) == {"daily_unit_provenance"}
    late = jobs.prepare_universe(store, "p3", "HOSE", snapshot_date="2020-01-01", at=AT)
    assert set(names(late.results)) == {"requested_snapshot_available"}


def test_panel_blocked_keeps_availability(spark, store):
    raw = flat_bars(spark, [("FPT", WEEK[0], 10.0, 100)] * 2)
    bars = raw.select("symbol", F.col("time").cast("date").alias("date"), "open", "high", "low",
                      "close", "volume").withColumns({
        "provider": F.lit("vnstock"), "exchange": F.lit("HOSE"), "source_resolution": F.lit("1D"),
        "adjusted_flag": F.lit(None).cast("boolean"), "ingestion_timestamp_utc": stamp()})
    store.publish_daily(bars, "legacy")
    result = jobs.build_panel(store, "pan", WEEK[0], WEEK[-1], at=AT)
    assert result.status == "failed" and not store.exists("features/daily_panel")
    assert store.read("features/availability").first().duplicate_count == 1


def test_intraday_and_quotes(spark, store):
    row = [("FPT", "1m", "2026-07-03 09:15:00", "1", "1", "1", "1", "1")]
    store.land(
        spark.createDataFrame(row, "symbol string, resolution string, time string, open string, "
                                   "high string, low string, close string, volume string"),
        "intraday", "i1",
    )
    assert jobs.ingest_intraday(store, "i1", at=AT).status == "success"
    assert store.read("normalized/intraday").first().trading_date == "2026-07-03"
    quotes = spark.createDataFrame(
        [("fpt", 1783067546136, "HOSE")], "symbol string, time bigint, exchange string"
    )
    store.land(quotes, "quotes", "q1")
    schema = "symbol string, time variant, exchange string"
    result = jobs.ingest_quotes(store, "q1", symbols(spark, ["FPT", "HPG"]), schema, AT)
    assert result.status == "success"
    assert "missing_requested_symbols" in names(result.results)
    saved = store.read("normalized/quotes").first()
    assert saved.provider_time_parse_status == "provider_specific_unparsed"


def test_raw_is_immutable_and_digests_are_stable(spark, store):
    raw = flat_bars(spark, [("FPT", WEEK[0], 10.0, 100)])
    path = store.land(raw, "daily", "0012")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        store.land(raw, "daily", "0012")
    assert {r.run_id for r in store.read_raw("daily", "symbol string").collect()} == {"0012"}
    a = [r.sha256 for r in file_digests(spark, path, "*.json").collect()]
    assert a and a == [r.sha256 for r in file_digests(spark, path, "*.json").collect()]


def test_unreadable_lines_block(spark, store, tmp_path):
    path = store.raw_path("daily", "bad")
    spark.createDataFrame([("{broken",)], "value string").write.text(path)
    result = jobs.ingest_daily(store, "bad", ["FPT"], WEEK[0], WEEK[-1], as_of="2026-07-04", at=AT)
    assert result.status == "failed" and "raw_rows_readable" in names(result.results)


def test_lineage_paths(spark, store):
    land_daily(store)
    paths = [r[0] for r in input_paths(store.read("normalized/daily")).collect()]
    assert len(paths) == 2 and all("run_id=d1" in p for p in paths)
    assert [r.run_id for r in store.run_ids("normalized/daily").collect()] == ["d1"]


def test_validate_nothing_stored(store):
    assert set(names(jobs.validate_stored(store, "2026-07-04"))) == {"no_normalized_data"}


def test_summary_of_no_results(spark):
    empty = spark.createDataFrame([], checks.RESULT_SCHEMA)
    assert not checks.summarize(empty).first().has_blocking_errors


def test_stream_equals_batch(spark, store, tmp_path):
    raw = flat_bars(spark, [("FPT", d, 10.0, 100) for d in WEEK])
    path = store.land(raw, "daily", "s1")
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    normalize_landed(spark, path, out, mark, stamp(), provenance=KBS).awaitTermination()
    rows = spark.read.parquet(out)
    assert rows.count() == 5 and rows.where("source_price_scale_to_vnd = 1000").count() == 5


def test_landed_files_are_bounded(spark, store, monkeypatch):
    """A digest reads a file whole, so a run's evidence is landed in files of bounded length."""
    monkeypatch.setattr("barledger.sources.store.LANDED_FILE_ROWS", 10)
    rows = spark.range(25).coalesce(1).select(F.concat(F.lit("S"), "id").alias("symbol"))
    paths = [store.land(rows, "daily", r) for r in ("a", "b")]
    first, second = (file_digests(spark, p, "*.json").select("length", "sha256").collect() for p in paths)
    assert len(first) == 3 and sorted(first) == sorted(second)
    assert store.read_raw("daily", "symbol string", "a").count() == 25


def test_daily_runs_are_written_by_many_tasks(spark, store):
    """A symbol's folder costs the same however small it is, so the folders are dealt over tasks."""
    store.publish_daily(daily(spark, [(f"S{i}", d, 10.0, 5) for i in range(20) for d in WEEK]), "r")
    paths = [r[0] for r in input_paths(store.read_daily()).collect()]
    assert len(paths) == 20 and len({p.rsplit("/", 1)[1].split("-")[1] for p in paths}) > 1
    listing = spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")
    assert listing == spark.conf.get("spark.sql.shuffle.partitions")


def test_daily_runs_have_no_folder_for_each_symbol(spark, store):
    """A run's files are as many as its tasks, however many symbols; a path still names its row's symbol."""
    rows = daily(spark, [(f"S{i}", d, 10.0, 5) for i in range(40) for d in WEEK], KBS)
    nameless = rows.limit(1).withColumn("symbol", F.lit(None).cast("string"))
    store.publish_daily(rows.unionByName(nameless), "r")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = store.read_daily().select("symbol", "run_id", "__input_path").distinct().collect()
    assert len({r["__input_path"].split("#")[0] for r in stored}) <= parts and len(stored) == 41
    assert all("/run_id=r/" in r["__input_path"] for r in stored)
    named = {r.symbol: r["__input_path"].split("#symbol=")[1] for r in stored}
    assert named.pop(None) == "__HIVE_DEFAULT_PARTITION__" and all(k == v for k, v in named.items())
