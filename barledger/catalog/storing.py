"""Queries that write to and read back from a store."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from barledger.catalog import views as v
from barledger.catalog.registry import query
from barledger.operators import normalize
from barledger.sources import store as s
from barledger.sources.staging import shared_dir


def fresh_store(spark) -> s.MarketStore:
    return s.MarketStore(spark, f"{shared_dir(spark)}/barledger-store/{uuid.uuid4().hex}")


def landed(spark, sf) -> s.MarketStore:
    store = fresh_store(spark)
    raw = v.bars_raw(spark, sf).select("symbol", "time", "open", "high", "low", "close", "volume")
    store.land(raw, "daily", "0001")
    return store


@query(
    "s1_s2_raw_roundtrip",
    """SELECT symbol, time, open, high, low, close, volume, '0001' AS run_id FROM bars_raw""",
)
def s1_s2_raw_roundtrip(spark, sf):
    raw = landed(spark, sf).read_raw("daily", s.RAW_DAILY_SCHEMA, "0001")
    bars = raw.select(
        "symbol", "time", *[F.col(c).cast("double").alias(c) for c in
                            ("open", "high", "low", "close", "volume")], "run_id",
    )
    return bars


@query(
    "s3_s7_daily_run",
    """SELECT symbol, strftime(date, '%Y-%m-%d') AS date, close, 'run-b' AS run_id
       FROM bars_clean WHERE suppkey % 2 = 0""",
)
def s3_s7_daily_run(spark, sf):
    """Two published runs; reading one selects its partition only."""
    store = fresh_store(spark)
    bars = v.bars_clean(spark, sf)
    store.publish_daily(bars.where("suppkey % 2 = 1"), "run-a")
    store.publish_daily(bars.where("suppkey % 2 = 0"), "run-b")
    return store.read_daily(["run-b"]).select("symbol", "date", "close", "run_id")


@query(
    "s4_intraday_partitions",
    """SELECT symbol, strftime(ts_minute, '%Y-%m-%d') AS trading_date, count(*) AS row_count
       FROM intraday_raw GROUP BY ALL""",
)
def s4_intraday_partitions(spark, sf):
    store = fresh_store(spark)
    store.publish_intraday(normalize.intraday_bars(v.intraday_raw(spark, sf), v.stamp()), "run-a")
    return store.read("normalized/intraday").groupBy("symbol", "trading_date").agg(
        F.count(F.lit(1)).alias("row_count")
    )


@query(
    "s5_s8_snapshot_runs",
    """SELECT run_id, upper(trim(symbol)) AS symbol, count(*) AS row_count
       FROM universe_raw, (VALUES ('run-a', 1), ('run-b', 2)) r(run_id, every)
       WHERE exchange = 'ASIA' AND suppkey % every = 0 GROUP BY ALL""",
)
def s5_s8_snapshot_runs(spark, sf):
    """Two snapshot runs, the second of every other supplier, read back by the runs that are listed."""
    store = fresh_store(spark)
    raw = v.universe_raw(spark, sf)
    for run, every in (("run-a", 1), ("run-b", 2)):
        rows = normalize.universe_snapshot(raw.where(F.col("suppkey") % every == 0), "ASIA", v.stamp())
        store.publish_snapshot(
            rows, "normalized/universe", run, "snapshot_date", v.stamp().cast("date")
        )
    rows = store.read("normalized/universe", runs=store.run_ids("normalized/universe"))
    return rows.groupBy("run_id", "symbol").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "s6_source_files",
    """SELECT symbol, 'run-a' AS run_id, count(*) AS row_count, true AS has_path
       FROM bars_clean GROUP BY symbol""",
)
def s6_source_files(spark, sf):
    store = fresh_store(spark)
    store.publish_daily(v.bars_clean(spark, sf), "run-a")
    rows = store.read_daily()
    in_run = F.contains("__input_path", F.concat(F.lit("/run_id="), "run_id", F.lit("/")))
    named = F.endswith("__input_path", F.concat(F.lit(s.SYMBOL_MARK), "symbol"))
    return rows.groupBy("symbol", "run_id").agg(
        F.count(F.lit(1)).alias("row_count"), F.bool_and(in_run & named).alias("has_path")
    )


@query(
    "n22_input_paths",
    "SELECT DISTINCT symbol FROM bars_clean",
)
def n22_input_paths(spark, sf):
    """Distinct lineage paths, reduced to the symbol they name inside their file."""
    store = fresh_store(spark)
    store.publish_daily(v.bars_clean(spark, sf), "run-a")
    paths = s.input_paths(store.read_daily())
    return paths.select(
        F.regexp_extract("__input_path", rf"\.parquet{s.SYMBOL_MARK}(.+)$", 1).alias("symbol")
    ).distinct()


@query(
    "s9_manifests",
    """SELECT 'run-' || o_orderstatus AS run_id, 'data backfill-daily' AS command,
         count(*) AS normalized_row_count FROM orders GROUP BY o_orderstatus""",
)
def s9_manifests(spark, sf):
    store = fresh_store(spark)
    counts = v.table(spark, sf, "orders").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("normalized_row_count")
    )
    store.append(
        counts.select(
            F.concat(F.lit("run-"), "o_orderstatus").alias("run_id"),
            F.lit("data backfill-daily").alias("command"),
            "normalized_row_count",
        ),
        "manifests",
    )
    return store.table("manifests")


@query(
    "s13_report",
    """SELECT symbol, count(*) AS row_count FROM bars_raw GROUP BY symbol""",
)
def s13_report(spark, sf):
    store = fresh_store(spark)
    counts = v.bars_raw(spark, sf).groupBy("symbol").agg(F.count(F.lit(1)).alias("row_count"))
    path = store.report(counts, "rows", "run-a")
    return spark.read.schema("symbol string, row_count bigint").json(path)


@query(
    "s14_file_digest",
    """SELECT r.run_id, CASE WHEN r.run_id = 'changed' THEN count(*) FILTER (WHERE l_orderkey % 997 = 0) = 0
         ELSE true END AS same_as_first
       FROM bars_raw, (VALUES ('again'), ('changed')) r(run_id) GROUP BY r.run_id""",
)
def s14_file_digest(spark, sf):
    """Digests of landed evidence: the same rows landed again, and with some closes changed."""
    store = fresh_store(spark)
    raw = v.bars_raw(spark, sf).select("l_orderkey", "symbol", "time", "open", "high", "low", "close", "volume")
    moved = F.when(F.col("l_orderkey") % 997 == 0, F.col("close") + 1).otherwise(F.col("close"))
    for run, rows in (("first", raw), ("again", raw), ("changed", raw.withColumn("close", moved))):
        store.land(rows.drop("l_orderkey"), "daily", run)
    digests = s.run_digests(spark, f"{store.root}/raw/dataset=daily", "raw", "*.json")
    first = digests.where("run_id = 'first'").select("sha256")
    return digests.where("run_id <> 'first'").select(
        "run_id", (F.col("sha256") == first.scalar()).alias("same_as_first")
    )
