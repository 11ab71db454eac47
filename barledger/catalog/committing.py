"""Queries of the jobs over a store: audited commits, run-pruned reads, incremental assessment."""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import functions as F

from barledger.catalog import views as v
from barledger.catalog.campaigns import chunks_sql
from barledger.catalog.oracles import FRACTIONAL, HIGH_LOW, HIGH_OC, LOW_OC
from barledger.catalog.registry import query
from barledger.catalog.storing import fresh_store
from barledger.contracts import NORMALIZED_DAILY_VERSION, PROVENANCE_TYPES, PROVIDER
from barledger.operators import campaign
from barledger.operators.campaign import CampaignPlan
from barledger.operators.units import KBS
from barledger.plans import jobs
from barledger.sources.staging import staged
from barledger.sources.store import DAILY, LAYOUT, MANIFEST_SCHEMA, schema_of

LATE = "2100-01-01"
_CHUNK = 20

# --- write, audit, commit --------------------------------------------------------------

_RULES = [
    ("volume_non_negative", "volume < 0"),
    ("high_gte_low", HIGH_LOW),
    ("high_gte_open_close", HIGH_OC),
    ("low_lte_open_close", LOW_OC),
    ("volume_integer_like", FRACTIONAL),
]
_BAD = "(SELECT * FROM bars_raw WHERE suppkey % 3 = 1)"
_GATE_SQL = " UNION ALL ".join(
    [
        """SELECT 'good' AS run_id, 'visible_rows' AS item, count(*) AS n FROM bars_clean
             WHERE suppkey % 3 = 0 HAVING count(*) > 0""",
        "SELECT 'good', 'success', 1",
        "SELECT 'bad', 'failed', 1",
        *[f"SELECT 'bad', '{name}', count(*) FROM {_BAD} WHERE {cond} HAVING count(*) > 0" for name, cond in _RULES],
        f"""SELECT 'bad', 'duplicate_symbol_date', CAST(sum(n - 1) AS BIGINT) FROM (
             SELECT count(*) AS n FROM {_BAD} GROUP BY symbol, date) HAVING sum(n - 1) > 0""",
        """SELECT 'torn', 'files_without_commit', count(*) FROM bars_clean WHERE suppkey % 3 = 2
             HAVING count(*) > 0""",
    ]
)


def _land(store, rows, run_id):
    """Land bars (symbol, time, prices, volume) with the chunk that asked for each."""
    day = F.coalesce(F.col("time").try_cast("date"), F.lit(v.START).cast("date"))
    chunk = F.floor(F.datediff(day, F.lit(v.START).cast("date")) / _CHUNK).cast("int")
    start = F.date_add(F.lit(v.START).cast("date"), chunk * _CHUNK)
    columns = ["symbol", "time", "open", "high", "low", "close", "volume"]
    store.land(
        rows.select(
            *columns, start.cast("string").alias("request_start_date"),
            F.date_add(start, _CHUNK - 1).cast("string").alias("request_end_date"),
        ),
        "daily", run_id,
    )


@query("p2_publish_gate", _GATE_SQL)
def p2_publish_gate(spark, sf):
    """Three runs by supplier: a good one, one with planted defects, one killed before its commit.

    Rows that a reader sees, each run's status, its blocking checks, and what the torn run left.
    """
    store = fresh_store(spark)
    clean = v.bars_clean(spark, sf).withColumn("time", F.col("date").cast("string"))
    _land(store, clean.where("suppkey % 3 = 0"), "good")
    _land(store, v.bars_raw(spark, sf).where("suppkey % 3 = 1"), "bad")
    done = [jobs.ingest_daily(store, r, [], v.START, v.END, as_of=LATE) for r in ("good", "bad")]
    torn = clean.where("suppkey % 3 = 2").drop("suppkey", "orderkey", "time")
    store.stage_run(torn, DAILY, "torn", *LAYOUT[DAILY])
    one = F.lit(1).cast("bigint").alias("n")
    seen = store.read_daily().groupBy("run_id").agg(F.count(F.lit(1)).alias("n"))
    left = store.staged_rows(DAILY, "torn").agg(F.count(F.lit(1)).alias("n")).where("n > 0")
    found = seen.select("run_id", F.lit("visible_rows").alias("item"), "n")
    found = found.unionByName(store.manifests().select("run_id", F.col("status").alias("item"), one))
    for d in done:
        found = found.unionByName(
            d.results.where("blocks_output").select(
                F.lit(d.run_id).alias("run_id"), F.col("check_name").alias("item"), F.col("affected_row_count").alias("n")
            )
        )
    return found.unionByName(left.select(F.lit("torn").alias("run_id"), F.lit("files_without_commit").alias("item"), "n"))


# --- a campaign in a store --------------------------------------------------------------

CHUNK_DAYS = 730
PLAN = CampaignPlan("camp-store", v.START, v.END, CHUNK_DAYS, "2001-11-05")
AS_OF = "2001-11-05"
#: Chunks whose runs are known to the first assessment.
EARLY = 2
_VIEWS = {
    "long_chunks": chunks_sql(CHUNK_DAYS),
    "chunk_runs": "SELECT *, row_number() OVER (ORDER BY start_date) - 1 AS nth FROM long_chunks",
    "chunk_bars": """SELECT r.nth, s.suppkey, s.symbol, r.start_date, r.end_date, b.date, b.close
        FROM suppliers s CROSS JOIN chunk_runs r
        LEFT JOIN bars_clean b ON b.symbol = s.symbol AND b.date BETWEEN r.start_date AND r.end_date""",
}


def _runs(spark, sf):
    """Rows of every chunk's run: all suppliers' bars inside it, planted unit provenance included."""
    bars = v.bars_prov(spark, sf).where(F.col("date").between(F.lit(v.START), F.lit(v.END)))
    nth = F.floor(F.datediff("date", F.lit(v.START).cast("date")) / CHUNK_DAYS)
    return staged(bars.drop("suppkey", "orderkey").withColumn("nth", nth.cast("int")))


def campaign_store(spark, sf):
    """A store with the plan, a committed run for each chunk and its manifest; no receipts yet."""
    store = fresh_store(spark)
    symbols = v.suppliers(spark, sf).select("symbol")
    jobs.init_campaign(store, PLAN, symbols)
    rows = _runs(spark, sf)
    count = campaign.chunk_count(PLAN)
    for i in range(count):
        store.publish_daily(rows.where(F.col("nth") == i).drop("nth"), f"run-{i}")
    named = symbols.agg(F.array_sort(F.collect_list("symbol"))).scalar()  # the plan's symbols
    record = F.struct(*[F.lit(val).cast(PROVENANCE_TYPES[c]).alias(c) for c, val in KBS.by_column().items()])
    start = F.date_add(F.lit(v.START).cast("date"), F.col("id").cast("int") * CHUNK_DAYS)
    made = spark.range(count).select(
        F.concat(F.lit("run-"), F.col("id")).alias("run_id"),
        F.lit(campaign.BACKFILL_COMMAND).alias("command"),
        F.lit("success").alias("status"),
        F.lit(PROVIDER).alias("provider"),
        F.lit("HOSE").alias("exchange"),
        F.lit("1D").alias("resolution"),
        named.alias("symbols"),
        start.cast("string").alias("start_date"),
        F.least(F.date_add(start, CHUNK_DAYS - 1), F.lit(v.END).cast("date")).cast("string").alias("end_date"),
        F.lit(NORMALIZED_DAILY_VERSION).alias("normalized_contract"),
        F.lit(campaign.UNKNOWN_ADJUSTMENT).alias("price_adjustment_semantics"),
        record.alias("unit_provenance"),
        F.lit(AS_OF).cast("timestamp").alias("finished_at_utc"),
    )
    empty = spark.createDataFrame([], schema_of(MANIFEST_SCHEMA))
    store.append(empty.unionByName(made, allowMissingColumns=True), "manifests")
    return store


def give_receipts(store, first: int, end: int) -> None:
    """Receipts of the runs first..end-1 for all tasks of their chunk."""
    tasks, _ = jobs.campaign_tables(store, PLAN)
    for i in range(first, end):
        start = F.date_add(F.lit(v.START).cast("date"), i * CHUNK_DAYS)
        mine = tasks.where(F.col("start_date") == start)
        at = F.lit(AS_OF).cast("timestamp")
        store.append(campaign.receipts_for_run(PLAN, mine, f"run-{i}", "adopted_run", at), "receipts")


@query(
    "p8_plan_from_snapshot",
    """SELECT 'task' AS kind, upper(trim(symbol)) || '__' || strftime(start_date, '%Y-%m-%d') || '__' ||
         strftime(end_date, '%Y-%m-%d') AS name FROM universe_raw CROSS JOIN long_chunks
       WHERE input_ordinal = suppkey * 2 AND exchange = 'ASIA'
         AND lower(coalesce(type, 'UNKNOWN')) IN ('stock', 'equity')
       UNION ALL SELECT 'loaded', 'ASIA 1995-01-01 2001-11-04 730 2024-01-31'
       UNION ALL SELECT 'refused', r FROM (VALUES ('changed chunk_days'), ('changed symbols_digest'),
         ('the same again'), ('unknown version')) t(r)""",
    _VIEWS,
)
def p8_plan_from_snapshot(spark, sf):
    """A plan made from an ingested snapshot and read back; a changed or unknown one is refused."""
    store = fresh_store(spark)
    raw = v.universe_raw(spark, sf).where("input_ordinal = suppkey * 2")  # each supplier's own record
    columns = ["symbol", "organ_name", "en_organ_name", "exchange", "type", "id", "input_ordinal"]
    store.land(raw.select(*columns), "universe", "u1")
    jobs.ingest_universe(store, "u1", "ASIA", dt.datetime(2024, 1, 31))
    made = jobs.init_campaign_from_snapshot(store, "camp-u", "ASIA", v.START, v.END, CHUNK_DAYS)
    plan = jobs.load_plan(store, "camp-u")
    symbols = made.frames["tasks"].select("symbol").distinct()
    tries = {
        "changed chunk_days": lambda: jobs.init_campaign(store, dataclasses.replace(plan, chunk_days=30), symbols),
        "changed symbols_digest": lambda: jobs.init_campaign(
            store, plan, symbols.unionByName(spark.createDataFrame([("X",)], "symbol string"))
        ),
        "the same again": lambda: jobs.init_campaign(store, plan, symbols),
        "unknown version": lambda: jobs.load_plan(store, "camp-v0"),
    }
    other = {**campaign.plan_values(plan, "-"), "campaign_id": "camp-v0", "campaign_version": "v0"}
    store.append(spark.createDataFrame([tuple(other.values())], campaign.PLAN_SCHEMA), "plans")
    refused = []
    for name, attempt in tries.items():
        try:
            attempt()
        except ValueError as why:
            if name.split()[-1] in str(why) or "already exists" in str(why) or "Unsupported" in str(why):
                refused.append(("refused", name))
    text = f"{plan.exchange} {plan.start} {plan.end} {plan.chunk_days} {plan.snapshot_date}"
    rows = spark.createDataFrame([("loaded", text), *refused], "kind string, name string")
    tasks = store.table("tasks").select(F.lit("task").alias("kind"), F.col("task_id").alias("name"))
    return tasks.unionByName(rows)


_STATE = """CASE WHEN n = 0 OR suppkey % 5 NOT IN (3, 4) THEN 'incompatible' WHEN stale > 10 THEN 'stale'
    ELSE 'complete' END"""
_STATE_SQL = f"""SELECT symbol || '__' || strftime(start_date, '%Y-%m-%d') || '__' || strftime(end_date, '%Y-%m-%d')
      AS task_id, {_STATE} AS status, 'run-' || nth AS selected_run_id,
    CASE WHEN {_STATE} = 'incompatible' THEN 0 ELSE n END AS observation_count,
    CASE WHEN n = 0 THEN '["normalized_symbol_source_missing"]'
      WHEN suppkey % 5 NOT IN (3, 4) THEN '["row_unit_provenance_incompatible"]'
      WHEN stale > 10 THEN '["last_observation_stale_for_chunk_end"]'
      ELSE '["compatible_successful_source"]' END AS reason_codes, nth >= {EARLY} AS judged_again
  FROM (SELECT suppkey, symbol, nth, start_date, end_date, count(date) AS n,
      date_diff('day', max(date), end_date) AS stale FROM chunk_bars
    GROUP BY suppkey, symbol, nth, start_date, end_date)"""


@query("p9_incremental_assessment", _STATE_SQL, _VIEWS)
def p9_incremental_assessment(spark, sf):
    """Tasks after two assessments; the second one judges the runs that came in between, and no other."""
    store = campaign_store(spark, sf)
    give_receipts(store, 0, EARLY)
    jobs.assess_campaign(store, PLAN, AS_OF)
    give_receipts(store, EARLY, campaign.chunk_count(PLAN))
    frames = jobs.assess_campaign(store, PLAN, AS_OF)
    again = frames["judged"].select("task_id", F.lit(True).alias("again"))
    return frames["assessments"].join(again, "task_id", "left").select(
        "task_id", "status", "selected_run_id", "observation_count", "reason_codes",
        F.coalesce("again", F.lit(False)).alias("judged_again"),
    )


@query(
    "p10_campaign_status",
    f"""SELECT 'next' AS kind, task_id AS name, status AS value FROM (
         SELECT task_id, status FROM ({_STATE_SQL}) WHERE status = 'stale' OR status = 'incompatible'
         ORDER BY split_part(task_id, '__', 1), split_part(task_id, '__', 2) LIMIT 40)
       UNION ALL SELECT 'flag', 'campaign_complete',
         CAST(bool_and(status = 'complete') AS VARCHAR) FROM ({_STATE_SQL})
       UNION ALL SELECT 'flag', 'assembly_compatible',
         CAST(NOT bool_or(status = 'incompatible') AS VARCHAR) FROM ({_STATE_SQL})
       UNION ALL SELECT 'flag', 'before_audit', 'not_assessed' FROM supplier HAVING count(*) > 0
       UNION ALL SELECT 'flag', 'after_audit', CASE WHEN bool_and(status = 'complete') THEN 'accepted'
         ELSE 'rejected' END FROM ({_STATE_SQL})
       UNION ALL SELECT 'flag', 'after_new_run', 'not_assessed' FROM supplier HAVING count(*) > 0""",
    _VIEWS,
)
def p10_campaign_status(spark, sf):
    """Next tasks and flags; a stored readiness holds until evidence changes."""
    store = campaign_store(spark, sf)
    count = campaign.chunk_count(PLAN)
    symbols = v.suppliers(spark, sf).select("symbol")
    give_receipts(store, 0, count)
    retry = {"retry_stale": True, "retry_incompatible": True}
    before = jobs.campaign_status(store, PLAN, AS_OF, 40, **retry)
    jobs.audit_campaign(store, PLAN, symbols, AS_OF)
    after = jobs.campaign_status(store, PLAN, AS_OF, 40, **retry)
    status = F.col("research_readiness_status").alias("value")

    def flag(name, frame, value):
        return frame.select(F.lit("flag").alias("kind"), F.lit(name).alias("name"), value)

    out = before["next"].select(F.lit("next").alias("kind"), F.col("task_id").alias("name"), F.col("status").alias("value"))
    for name in ("campaign_complete", "assembly_compatible"):
        out = out.unionByName(flag(name, after["state"], F.col(name).cast("string").alias("value")))
    out = out.unionByName(flag("before_audit", before["state"], status)).unionByName(flag("after_audit", after["state"], status))
    # one more receipt: the first run also offered for the last chunk's first task
    tasks, _ = jobs.campaign_tables(store, PLAN)
    one = tasks.orderBy(F.col("start_date").desc(), "symbol").limit(1)
    store.append(campaign.receipts_for_run(PLAN, one, "run-0", "adopted_run", F.lit(v.START).cast("timestamp")), "receipts")
    moved = jobs.campaign_status(store, PLAN, AS_OF, 40)
    return out.unionByName(flag("after_new_run", moved["state"], status))


@query(
    "s7_pruned_runs",
    f"""SELECT symbol, 'run-' || nth AS run_id, count(date) AS row_count, sum(close) AS close
        FROM chunk_bars WHERE nth < {EARLY} AND date IS NOT NULL GROUP BY symbol, nth""",
    _VIEWS,
)
def s7_pruned_runs(spark, sf):
    """Rows of the receipts' runs only; other runs' partitions are never read."""
    store = campaign_store(spark, sf)
    give_receipts(store, 0, EARLY)
    _, receipts = jobs.campaign_tables(store, PLAN)
    rows = jobs.campaign_rows(store, receipts)
    return rows.groupBy("symbol", "run_id").agg(F.count(F.lit(1)).alias("row_count"), F.sum("close").alias("close"))
