"""Skewed inputs and plan shapes."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from barledger.operators import coverage, forensics, normalize, ordering, quality
from barledger.operators.checks import top_rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(spark, n=30000):
    """A third of all rows share one key, and half of those one date."""
    i = F.col("id")
    hot = i % 3 == 0
    return spark.range(n).select(
        F.when(hot, "HOT").otherwise(F.concat(F.lit("S"), (i % 50).cast("string"))).alias("symbol"),
        F.when(hot & (i % 2 == 0), F.lit("2020-01-06").cast("date"))
        .otherwise(F.date_add(F.lit("2020-01-01").cast("date"), (i % 700).cast("int")))
        .alias("date"),
        i.alias("position"),
        *[(i % 97).cast("double").alias(c) for c in ("open", "high", "low", "close", "volume")],
    )


POSITIONS = {
    "dense": lambda i: i,
    "sparse": lambda i: i * 1_000_003,
    "one far away": lambda i: F.when(i == 7, F.lit(10**15)).otherwise(i),
}


@pytest.mark.parametrize("kind", POSITIONS)
def test_exact_rank_matches_brute_force_on_a_hot_key(spark, kind):
    rows = skewed(spark, 9000).withColumn("position", POSITIONS[kind](F.col("position")))
    ranked = ordering.exact_rank(rows, ["symbol"], "date", "position")
    got = ranked.select("symbol", "date", "position", "rank").toPandas()
    want = got.sort_values(["symbol", "date", "position"]).groupby("symbol").cumcount() + 1
    assert (got["rank"] == want.reindex(got.index)).all()


def test_ranks_of_equal_positions_are_a_permutation(spark):
    rows = skewed(spark, 6000).withColumn("position", F.lit(1))
    got = ordering.exact_rank(rows, ["symbol"], "date", "position").select("symbol", "date", "rank").toPandas()
    for _, g in got.groupby("symbol"):
        assert sorted(g["rank"]) == list(range(1, len(g) + 1))
        assert g.sort_values("rank")["date"].is_monotonic_increasing


@pytest.mark.parametrize("kind", POSITIONS)
def test_order_breaks_match_brute_force(spark, kind):
    rows = skewed(spark, 5000).withColumn("position", POSITIONS[kind](F.col("position")))
    got = ordering.order_breaks(rows, "position", [F.col("symbol"), F.col("date")]).first()
    p = rows.toPandas().sort_values("position")
    keys = list(zip(p["symbol"], p["date"], strict=True))
    want = sum(b < a for a, b in zip(keys, keys[1:], strict=False))
    assert (got.order_break_count, got.row_count) == (want, 5000)


def test_ranges_hold_equal_shares(spark):
    """Neither far positions nor equal ones put most rows into one range."""
    for position in (F.col("id") * F.col("id") * F.col("id"), F.lit(1)):
        rows = spark.range(20_000).withColumn("position", position)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        try:
            sizes = ordering._ranged(rows, ["position"]).groupBy("__range").count().toPandas()["count"]
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "2")
        assert sizes.max() <= 2 * 20_000 / len(sizes)


def test_number_rows(spark):
    rows = skewed(spark, 4000).unionByName(skewed(spark, 4000))
    got = ordering.number_rows(rows, [F.col("date").desc(), "symbol"], "place").select("date", "symbol", "place").toPandas()
    assert sorted(got["place"]) == list(range(1, 8001))
    got = got.sort_values("place")
    keys = list(zip(-pd.to_datetime(got["date"]).astype("int64"), got["symbol"], strict=True))
    assert keys == sorted(keys)
    assert ordering.number_rows(rows.where("false"), ["symbol"]).collect() == []


def test_next_observation_makes_rows_linear_in_days(spark):
    """Every task of a symbol is stale: days are never multiplied by the tasks before them."""
    n = 30
    day = lambda c: F.date_add(F.lit("2020-01-01").cast("date"), c)
    k = F.col("id").cast("int")
    symbol = F.concat(F.lit("S"), k % 1).alias("symbol")  # one symbol, unknown to the optimizer
    tasks = spark.range(n).select(
        F.concat(F.lit("t"), k).alias("task_id"), symbol, day(k * 100).alias("start_date"),
        day(k * 100 + 99).alias("end_date"), day(k * 100 + 50).alias("last_date"), F.concat(F.lit("r"), k).alias("selected_run_id"),
    )
    days = spark.range(n * 100).select(
        F.concat(F.lit("r"), (k / 100).cast("int")).alias("run_id"), symbol, day(k).alias("date")
    ).where("dayofmonth(date) <> 1 and run_id <> 'r5'")
    found = forensics.next_observation(tasks, tasks, days)
    got = {r.task_id: (r.next_observation_date, r.next_source_run_id) for r in found.collect()}
    rows = days.toPandas()
    want = {}
    for t in tasks.toPandas().itertuples():
        for later in tasks.toPandas().itertuples():
            mine = rows[(rows.run_id == later.selected_run_id) & (rows.date > t.last_date)]
            if later.start_date > t.end_date and len(mine):
                want[t.task_id] = (mine.date.min(), later.selected_run_id)
                break
    assert got == want and len(got) == n - 1
    text = plan(found)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_session_gaps_match_brute_force(spark):
    i = F.col("id")
    rows = spark.range(4000).select(
        F.when(i % 3 == 0, "HOT").otherwise((i % 5).cast("string")).alias("symbol"),
        F.timestamp_seconds(F.pmod(F.hash(i), F.lit(10_000_000))).alias("t"),
    )
    got = {
        r.symbol: r.gap_count for r in ordering.session_gaps(rows, ["symbol"], "t").collect()
    }
    p = rows.toPandas().sort_values("t")
    for symbol, g in p.groupby("symbol"):
        assert got[symbol] == int((g["t"].diff() > pd.Timedelta(minutes=90)).sum()), symbol


def test_longest_gap_matches_calendar(spark):
    days = skewed(spark, 900).select("symbol", "date").distinct()
    got = {r.symbol: r[1] for r in coverage.longest_gaps(days).collect()}
    p = days.toPandas()
    for symbol, g in p.groupby("symbol"):
        seen = set(pd.to_datetime(g["date"]))
        run = best = 0
        for d in pd.bdate_range(min(seen), max(seen)):
            run = 0 if d in seen else run + 1
            best = max(best, run)
        assert got[symbol] == best, symbol


def test_top_rows_prunes_before_the_shuffle(spark):
    top = top_rows(skewed(spark), ["symbol"], ["position"], 5)
    assert "WindowGroupLimit" in plan(top) and "Partial" in plan(top)


def test_day_facts_stay_hash_aggregates(spark):
    text = plan(coverage.day_facts(skewed(spark)))
    assert "HashAggregate" in text and "SortAggregate" not in text
    assert "ObjectHashAggregate" not in text


def test_row_checks_use_one_pass_and_no_cross_join(spark):
    rows = skewed(spark)
    from barledger.operators.checks import run_checks

    results = run_checks(rows, "daily", quality.daily_row_rules("2030-01-01"))
    text = plan(results)
    assert "CartesianProduct" not in text and "BroadcastNestedLoop" not in text
    assert text.count("Exchange") <= 2


def test_range_filter_reaches_the_scan(spark, tmp_path):
    from barledger.operators.panel import select_window

    path = str(tmp_path / "t")
    skewed(spark, 1000).write.parquet(path)
    rows = select_window(spark.read.parquet(path), "2020-02-01", "2020-03-01").select("symbol", "date")
    text = plan(rows)
    assert "GreaterThanOrEqual(date" in text and "struct<symbol:string,date:date>" in text


def test_intraday_times_are_parsed_once(spark):
    from barledger.catalog.quality import dq_intraday

    checked = dq_intraday(spark, "/root/testdata/sf0.001")
    assert "try_cast" not in checked._jdf.queryExecution().optimizedPlan().toString()
    raw = spark.createDataFrame([("A", "1m", "2024-01-01 09:00:00+07:00")], "symbol string, resolution string, time string")
    bars = normalize.intraday_bars(raw, F.current_timestamp())
    # One parse of the wall clock and one of the instant.
    assert bars._jdf.queryExecution().optimizedPlan().toString().count("try_cast") == 2
