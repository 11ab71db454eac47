"""Queries for ingestion campaigns: planning, receipts, assessment, readiness, assembly."""

from __future__ import annotations

from pyspark.sql import functions as F

from barledger.catalog import views as v
from barledger.catalog.oracles import BAD_OHLC, json_list, n_where
from barledger.catalog.registry import query
from barledger.contracts import PROVENANCE_TYPES
from barledger.functions import exprs as x
from barledger.operators import campaign, coverage, normalize, readiness
from barledger.operators.campaign import CampaignPlan
from barledger.operators.sets import union_all
from barledger.operators.units import KBS
from barledger.sources.staging import staged

#: Short chunks, so that the orders, each a run, leave some tasks pending.
CHUNK_DAYS = 20
SECOND_CHUNK = "1995-01-21"
PLAN = CampaignPlan("camp-1", v.START, v.END, CHUNK_DAYS, "2001-11-05")
AS_OF = "2001-11-05"
#: Run numbers are order keys times this; planted defects go by run number.
RUN_STEP = 40


def plan_symbols(spark, sf):
    return v.suppliers(spark, sf).select("symbol")


def tasks(spark, sf):
    return campaign.campaign_tasks(PLAN, plan_symbols(spark, sf))


def _chunk_start(day):
    """First day of a day's chunk; a run's rows then meet it by equality."""
    chunk = F.floor(F.datediff(day, x.lit_date(v.START)) / CHUNK_DAYS).cast("int")
    return F.date_add(x.lit_date(v.START), chunk * CHUNK_DAYS)


def runs(spark, sf):
    """Every order as a run of one symbol and chunk."""
    count = v.table(spark, sf, "supplier").agg(F.count(F.lit(1))).scalar()
    day = F.col("o_orderdate").cast("date")
    return (
        v.table(spark, sf, "orders")
        .withColumn("k", F.col("o_orderkey") * RUN_STEP)
        .select(
            "k",
            F.concat(F.lit("run-"), F.col("k").cast("string")).alias("run_id"),
            (F.col("o_custkey") % count).alias("suppkey"),
            F.concat(F.lit("S"), (F.col("o_custkey") % count).cast("string")).alias("symbol"),
            "o_orderstatus",
            day.alias("day"),
            _chunk_start(day).alias("chunk_start"),
        )
        .withColumn(
            "chunk_end", F.least(F.date_add("chunk_start", CHUNK_DAYS - 1), x.lit_date(v.END))
        )
        .withColumn(
            "run_end",
            F.when(F.col("o_orderstatus") == "P", F.date_sub("chunk_end", 5)).otherwise(
                F.col("chunk_end")
            ),
        )
    )


def _task_of_run():
    return F.concat_ws(
        "__", "symbol", F.col("chunk_start").cast("string"), F.col("chunk_end").cast("string")
    )


def manifests(spark, sf):
    k = F.col("k")
    record = [F.lit(val).cast(PROVENANCE_TYPES[c]).alias(c) for c, val in KBS.by_column().items()]
    proven = k % 240 == 40
    return runs(spark, sf).where("k % 400 <> 0").select(
        "run_id",
        (k % 600 != 200).alias("readable"),
        F.when(k % 280 == 0, "data other").otherwise("data backfill-daily").alias("command"),
        F.when(F.col("o_orderstatus") == "O", "failed").otherwise("success").alias("status"),
        F.lit("vnstock").alias("provider"),
        F.when(k % 360 == 0, "HNX").otherwise("HOSE").alias("exchange"),
        F.lit("1D").alias("resolution"),
        F.array("symbol").alias("symbols"),
        F.col("chunk_start").cast("string").alias("start_date"),
        F.col("run_end").cast("string").alias("end_date"),
        F.when(k % 80 != 0, "normalized-daily-v2").alias("normalized_contract"),
        F.lit("unknown_provider_adjustment_flag").alias("price_adjustment_semantics"),
        F.lit(None).cast("boolean").alias("expected_adjusted_flag"),
        F.when(proven, 0).otherwise(5).cast("bigint").alias("normalized_row_count"),
        F.when(proven, 1).otherwise(0).cast("bigint").alias("chunks_empty"),
        proven.alias("allow_empty_success"),
        F.struct(*record).alias("unit_provenance"),
        F.lit("camp-1").alias("campaign_id"),
        _task_of_run().alias("campaign_task_id"),
        F.col("day").cast("timestamp").alias("finished_at_utc"),
    )


def receipts(spark, sf, every: bool = True):
    """One receipt per run; without ``every`` some campaign runs have none yet."""
    rows = runs(spark, sf) if every else runs(spark, sf).where("k % 160 <> 0")
    return rows.select(
        F.lit(PLAN.campaign_version).alias("campaign_contract_version"),
        F.lit("camp-1").alias("campaign_id"),
        _task_of_run().alias("task_id"),
        F.col("run_id").alias("source_run_id"),
        F.lit("campaign_run").alias("origin"),
        F.col("day").cast("timestamp").alias("recorded_at_utc"),
    )


def stored_rows(spark, sf):
    """Normalized rows per run: the symbol's bars in the run's range, with planted defects."""
    have = runs(spark, sf).where("k % 120 <> 40").select(
        "k", "run_id", "suppkey", "chunk_start", "run_end"
    ).hint("merge")  # a table of orders that packs well is small on disk only: never broadcast it
    # Lines meet runs before they become bars: the bars' fixed columns and names are not shuffled.
    lines = v.dated_lines(spark, sf).withColumns({"suppkey": F.col("l_suppkey"), "chunk_start": _chunk_start(F.col("date"))})
    kept = lines.join(have, ["suppkey", "chunk_start"]).where("date between chunk_start and run_end")
    bars = v.bars_prov(spark, sf, kept, ["k", "run_id"])
    k = F.col("k")
    rows = bars.select(
        "run_id",
        F.col("symbol").alias("partition_symbol"),
        *[c for c in bars.columns if c not in ("k", "run_id", "suppkey", "exchange", "high")],
        F.when(F.col("orderkey") % 997 == 0, F.col("low") - 1)
        .otherwise(F.col("high"))
        .alias("high"),
        F.when((k % 520 == 0) & (F.col("orderkey") % 7 == 0), None)
        .otherwise(F.col("exchange"))
        .alias("exchange"),
        F.concat(
            F.lit("normalized/"), F.col("run_id"),
            F.when(k % 440 == 0, F.concat(F.lit("-"), (F.col("orderkey") % 2).cast("string")))
            .otherwise(F.lit("")),
        ).alias("__input_path"),
    )
    return staged(rows)


def attempts(spark, sf, rows=None):
    """``rows``: the stored rows, where the caller has them already."""
    rows = stored_rows(spark, sf) if rows is None else rows
    return campaign.assess_attempts(
        PLAN, tasks(spark, sf), receipts(spark, sf), manifests(spark, sf), rows, AS_OF
    )


def assessments(spark, sf, rows=None):
    return campaign.reduce_attempts(tasks(spark, sf), attempts(spark, sf, rows))


# --- oracle views --------------------------------------------------------------------

def chunks_sql(days: int) -> str:
    return f"""SELECT CAST(g AS DATE) AS start_date,
    least(CAST(g AS DATE) + {days - 1}, DATE '{v.END}') AS end_date
    FROM generate_series(DATE '{v.START}', DATE '{v.END}', INTERVAL {days} DAY) t(g)"""


CHUNKS = chunks_sql(CHUNK_DAYS)
_ATTEMPT = [
    ("NOT readable", "incompatible", "source_manifest_invalid"),
    ("m_run IS NULL", "incompatible", "source_manifest_missing"),
    ("command <> 'data backfill-daily'", "incompatible", "source_command_incompatible"),
    ("run_status <> 'success'", "failed", "source_run_failed"),
    ("exchange <> 'HOSE' OR run_end < end_date", "incompatible", json_list([
        ("exchange <> 'HOSE'", "exchange_mismatch"),
        ("run_end < end_date", "source_range_does_not_cover_task"),
    ])),
    ("paths IS NULL AND proven", "empty", "provider_returned_empty_chunk"),
    ("paths IS NULL", "incompatible", "normalized_symbol_source_missing"),
    ("paths > 1", "incompatible", "multiple_normalized_paths_for_source_symbol"),
    ("bad > 0", "incompatible", "normalized_daily_validation_failed"),
    ("no_exchange > 0", "incompatible", json_list([
        ("no_exchange > 0", "source_contains_null_exchanges"),
        ("no_exchange = part_rows", "source_exchange_rows_mismatch"),
    ])),
    ("n IS NULL", "empty", "successful_source_contains_no_rows_for_chunk"),
    ("wrong_units > 0", "incompatible", "row_unit_provenance_incompatible"),
    ("stale_days > 10", "stale", "last_observation_stale_for_chunk_end"),
    ("normalized_contract IS NULL", "complete",
     'compatible_successful_source","legacy_contract_structurally_validated'),
    ("true", "complete", "compatible_successful_source"),
]
_ST = "CASE " + " ".join(f"WHEN {c} THEN '{s}'" for c, s, _ in _ATTEMPT) + " END"
_RS = (
    "CASE "
    + " ".join(
        f"WHEN {c} THEN " + (r if "CASE" in r else f"'[\"{r}\"]'") for c, _, r in _ATTEMPT
    )
    + " END"
)
#: First day of a date's chunk; ranges then meet by equality.
_CHUNK_OF = (
    f"DATE '{v.START}' + CAST(date_diff('day', DATE '{v.START}', {{}}) // {CHUNK_DAYS} * {CHUNK_DAYS} AS INTEGER)"
)
CAMPAIGN_VIEWS = {
    "chunks": CHUNKS,
    "camp_tasks": """SELECT symbol || '__' || strftime(start_date, '%Y-%m-%d') || '__' ||
        strftime(end_date, '%Y-%m-%d') AS task_id, symbol, start_date, end_date
        FROM suppliers CROSS JOIN chunks""",
    "camp_runs": f"""SELECT {RUN_STEP} * o_orderkey AS k, 'run-' || {RUN_STEP} * o_orderkey AS run_id,
          'S' || (o_custkey % (SELECT count(*) FROM supplier)) AS symbol, o_orderstatus,
          CAST(o_orderdate AS DATE) AS day, start_date AS chunk_start, end_date AS chunk_end,
          CASE WHEN o_orderstatus = 'P' THEN end_date - 5 ELSE end_date END AS run_end,
          'S' || (o_custkey % (SELECT count(*) FROM supplier)) || '__' ||
            strftime(start_date, '%Y-%m-%d') || '__' || strftime(end_date, '%Y-%m-%d') AS task_id
        FROM orders JOIN chunks ON start_date = {_CHUNK_OF.format("CAST(o_orderdate AS DATE)")}
          AND CAST(o_orderdate AS DATE) BETWEEN start_date AND end_date""",
    "camp_manifests": """SELECT run_id AS m_run, k % 600 <> 200 AS readable,
          CASE WHEN k % 280 = 0 THEN 'data other' ELSE 'data backfill-daily' END AS command,
          CASE WHEN o_orderstatus = 'O' THEN 'failed' ELSE 'success' END AS run_status,
          CASE WHEN k % 360 = 0 THEN 'HNX' ELSE 'HOSE' END AS exchange,
          CASE WHEN k % 80 <> 0 THEN 'normalized-daily-v2' END AS normalized_contract,
          k % 240 = 40 AND k % 80 <> 0 AS proven
        FROM camp_runs WHERE k % 400 <> 0""",
    "camp_rows": f"""SELECT r.k, r.run_id, r.task_id, b.symbol, b.suppkey, b.orderkey, b.date, b.open,
          CASE WHEN orderkey % 997 = 0 THEN low - 1 ELSE high END AS high, low, close, volume,
          CASE WHEN k % 520 = 0 AND orderkey % 7 = 0 THEN NULL ELSE b.exchange END AS exchange,
          'normalized/' || run_id || CASE WHEN k % 440 = 0 THEN '-' || (orderkey % 2) ELSE '' END
            AS path
        FROM bars_prov b JOIN camp_runs r ON r.symbol = b.symbol
          AND r.chunk_start = {_CHUNK_OF.format("b.date")}
          AND b.date BETWEEN r.chunk_start AND r.run_end WHERE r.k % 120 <> 40""",
    "camp_part": f"""SELECT run_id, count(DISTINCT path) AS paths, {n_where(BAD_OHLC)} AS bad,
          {n_where("exchange IS NULL")} AS no_exchange, count(*) AS part_rows
        FROM camp_rows GROUP BY run_id""",
    "camp_in_task": """SELECT t.task_id, c.run_id, count(*) AS n, min(c.date) AS first_d,
          max(c.date) AS last_d, count(*) FILTER (WHERE suppkey % 5 NOT IN (3, 4)) AS wrong_units
        FROM camp_tasks t JOIN camp_rows c USING (task_id) GROUP BY ALL""",
    "camp_joined": """SELECT t.*, r.run_id, r.k, r.day, r.run_end, m.*, p.* EXCLUDE (run_id),
          i.n, i.first_d, i.last_d, i.wrong_units, date_diff('day', i.last_d, t.end_date)
            AS stale_days
        FROM camp_runs r JOIN camp_tasks t ON t.task_id = r.task_id
          LEFT JOIN camp_manifests m ON m.m_run = r.run_id
          LEFT JOIN camp_part p ON p.run_id = r.run_id
          LEFT JOIN camp_in_task i ON i.run_id = r.run_id AND i.task_id = t.task_id""",
    "camp_attempts": f"""SELECT task_id, symbol, start_date, end_date, run_id AS source_run_id,
          day, {_ST} AS status, {_RS} AS reason_codes,
          CASE WHEN {_ST} IN ('complete', 'stale') THEN n ELSE 0 END AS observation_count,
          CASE WHEN {_ST} IN ('complete', 'stale') THEN strftime(first_d, '%Y-%m-%d') END
            AS first_observation_date,
          CASE WHEN {_ST} IN ('complete', 'stale') THEN strftime(last_d, '%Y-%m-%d') END
            AS last_observation_date FROM camp_joined""",
    "camp_usable": """SELECT task_id, count(DISTINCT source_run_id) AS runs FROM camp_attempts
        WHERE status IN ('complete', 'empty') GROUP BY task_id""",
    "camp_ranked": """SELECT a.*, row_number() OVER (PARTITION BY a.task_id ORDER BY
          CASE WHEN status IN ('complete', 'empty') THEN 0 ELSE 1 END,
          CASE WHEN status IN ('complete', 'empty') THEN date_diff('day', day, DATE '2100-01-01')
          END, CASE status WHEN 'incompatible' THEN 0 WHEN 'stale' THEN 1 WHEN 'failed' THEN 2
          END, day, source_run_id) AS rn, count(*) OVER (PARTITION BY a.task_id) AS attempt_count
        FROM camp_attempts a""",
    "camp_state": """SELECT t.task_id, t.symbol, t.start_date, t.end_date,
          CASE WHEN r.task_id IS NULL THEN 'pending' WHEN u.runs > 1 THEN 'incompatible'
            ELSE r.status END AS status,
          CASE WHEN coalesce(u.runs, 0) <= 1 THEN r.source_run_id END AS selected_run_id,
          coalesce(attempt_count, 0) AS attempt_count,
          CASE WHEN coalesce(u.runs, 0) <= 1 THEN coalesce(r.observation_count, 0) ELSE 0 END
            AS observation_count,
          CASE WHEN coalesce(u.runs, 0) <= 1 THEN r.first_observation_date END
            AS first_observation_date,
          CASE WHEN coalesce(u.runs, 0) <= 1 THEN r.last_observation_date END
            AS last_observation_date,
          CASE WHEN r.task_id IS NULL THEN '["no_campaign_receipt"]'
            WHEN u.runs > 1 THEN '["multiple_compatible_successful_sources_for_task"]'
            ELSE r.reason_codes END AS reason_codes
        FROM camp_tasks t LEFT JOIN (SELECT * FROM camp_ranked WHERE rn = 1) r USING (task_id)
          LEFT JOIN camp_usable u ON u.task_id = t.task_id""",
    "camp_symbols": """SELECT symbol, CASE
          WHEN bool_and(status IN ('complete', 'empty')) THEN 'complete'
          WHEN bool_or(status = 'incompatible') THEN 'incompatible'
          WHEN bool_or(status = 'stale') THEN 'stale' WHEN bool_or(status = 'failed') THEN 'failed'
          WHEN bool_or(status IN ('complete', 'empty')) THEN 'partial' ELSE 'pending' END
          AS symbol_status FROM camp_state GROUP BY symbol""",
    "camp_source": """SELECT c.*, s.selected_run_id AS source_run_id FROM camp_state s
        JOIN camp_rows c ON c.run_id = s.selected_run_id AND c.symbol = s.symbol
          AND c.date BETWEEN s.start_date AND s.end_date WHERE s.status = 'complete'""",
}
_TASK_OUT = (
    "task_id, symbol, strftime(start_date, '%Y-%m-%d') AS start_date, "
    "strftime(end_date, '%Y-%m-%d') AS end_date"
)
_DATED = "observation_count, first_observation_date, last_observation_date, reason_codes"


# --- planning ------------------------------------------------------------------------


@query(
    "g1_date_chunks",
    """SELECT strftime(start_date, '%Y-%m-%d') AS start_date,
         strftime(end_date, '%Y-%m-%d') AS end_date FROM chunks""",
    CAMPAIGN_VIEWS,
)
def g1_date_chunks(spark, sf):
    return tasks(spark, sf).select("start_date", "end_date").distinct()


@query("j5_task_plan", f"SELECT {_TASK_OUT} FROM camp_tasks", CAMPAIGN_VIEWS)
def j5_task_plan(spark, sf):
    return tasks(spark, sf)


@query(
    "g2_projected_calls",
    "SELECT count(*) AS projected_calls, count(DISTINCT symbol) AS symbols FROM camp_tasks",
    CAMPAIGN_VIEWS,
)
def g2_projected_calls(spark, sf):
    return tasks(spark, sf).agg(
        F.count(F.lit(1)).alias("projected_calls"), F.countDistinct("symbol").alias("symbols")
    )


@query(
    "g3_plan_invariants",
    """SELECT 'task_ranges_contiguous' AS check_name, count(*) AS affected_row_count
       FROM suppliers WHERE suppkey % 10 = 0 OR suppkey % 8 = 1
       UNION ALL SELECT 'task_id_canonical', (SELECT count(*) FROM camp_tasks
           WHERE CAST(substr(symbol, 2) AS INT) % 7 = 0 AND NOT
             (CAST(substr(symbol, 2) AS INT) % 10 = 0 AND start_date = DATE '1995-01-21'))
         + (SELECT count(*) FROM suppliers WHERE suppkey % 8 = 1 AND suppkey % 7 = 0)
       UNION ALL SELECT 'tasks_cover_campaign_range', count(*) FROM suppliers
         WHERE suppkey % 9 = 0
       UNION ALL SELECT 'task_id_unique', count(*) FROM suppliers WHERE suppkey % 8 = 1
       UNION ALL SELECT 'symbol_has_tasks', 1""",
    CAMPAIGN_VIEWS,
)
def g3_plan_invariants(spark, sf):
    """A plan with a removed chunk, odd ids, a shortened tail and repeated tasks."""
    good = tasks(spark, sf)
    k = F.substring("symbol", 2, 12).try_cast("int")
    short = (k % 9 == 0) & (F.col("end_date") == x.lit_date(v.END))
    planted = good.where(~((k % 10 == 0) & (F.col("start_date") == x.lit_date(SECOND_CHUNK))))
    planted = planted.withColumn(
        "end_date", F.when(short, F.date_sub("end_date", 1)).otherwise(F.col("end_date"))
    )
    planted = planted.withColumn(
        "task_id",
        F.when(k % 7 == 0, F.lower(campaign.task_id())).otherwise(campaign.task_id()),
    )
    again = planted.where((k % 8 == 1) & (F.col("start_date") == x.lit_date(v.START)))
    symbols = plan_symbols(spark, sf).unionAll(spark.createDataFrame([("ZNONE",)], "symbol string"))
    results = campaign.check_plan(PLAN, symbols, planted.unionByName(again))
    return results.select("check_name", "affected_row_count")


# --- requests ------------------------------------------------------------------------

_REQUEST_VIEWS = {
    **CAMPAIGN_VIEWS,
    "req": """SELECT b.symbol, c.start_date, c.end_date, b.date + CASE WHEN l_orderkey % 211 = 0
          THEN 2000 ELSE 0 END AS date FROM bars_raw b
        JOIN chunks c ON b.date BETWEEN c.start_date AND c.end_date""",
}


def requested_bars(spark, sf):
    """Raw bars tagged with the chunk that requested them; a few drift out of it."""
    bars = normalize.daily_bars(v.bars_raw(spark, sf), v.stamp(), carry=["l_orderkey"])
    chunk = F.floor(F.datediff("date", x.lit_date(v.START)) / CHUNK_DAYS).cast("int")
    start = F.date_add(x.lit_date(v.START), chunk * CHUNK_DAYS)
    return bars.where("date is not null").withColumns(
        {
            "request_start_date": start,
            "request_end_date": F.least(
                F.date_add(start, CHUNK_DAYS - 1), x.lit_date(v.END)
            ),
            "date": F.when(F.col("l_orderkey") % 211 == 0, F.date_add("date", 2000)).otherwise(
                F.col("date")
            ),
        }
    )


@query(
    "g7_truncation",
    """SELECT symbol, strftime(start_date, '%Y-%m-%d') AS request_start_date,
         strftime(end_date, '%Y-%m-%d') AS request_end_date, count(*) AS row_count,
         count(*) >= 165 AS possibly_truncated FROM req GROUP BY ALL""",
    _REQUEST_VIEWS,
)
def g7_truncation(spark, sf):
    return campaign.request_checks(requested_bars(spark, sf), 165).drop("outside_row_count")


@query(
    "g8_chunk_bounds",
    f"""SELECT symbol, strftime(start_date, '%Y-%m-%d') AS request_start_date,
         {n_where("date NOT BETWEEN start_date AND end_date")} AS outside_row_count
       FROM req GROUP BY symbol, start_date""",
    _REQUEST_VIEWS,
)
def g8_chunk_bounds(spark, sf):
    return campaign.request_checks(requested_bars(spark, sf)).select(
        "symbol", "request_start_date", "outside_row_count"
    )


_LOG = """count(*) AS request_count, CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS succeeded_count,
         CAST(count(*) FILTER (WHERE ok AND n = 0) AS BIGINT) AS empty_count,
         coalesce(bool_and(ok AND n = 0), true) AS empty_is_complete"""


@query(
    "g9_empty_run",
    f"""WITH log AS (SELECT o_orderstatus <> 'O' AS ok, o_orderkey % 2 AS n FROM orders)
       SELECT 'all' AS log, {_LOG} FROM log
       UNION ALL SELECT 'empty', {_LOG} FROM log WHERE ok AND n = 0
       UNION ALL SELECT 'succeeded', {_LOG} FROM log WHERE ok""",
)
def g9_empty_run(spark, sf):
    """Three request logs: with failures, empty throughout, and succeeded with rows."""
    log = v.table(spark, sf, "orders").select(
        (F.col("o_orderstatus") != "O").alias("succeeded"),
        (F.col("o_orderkey") % 2).alias("row_count"),
    )
    logs = {"all": log, "empty": log.where("succeeded and row_count = 0"), "succeeded": log.where("succeeded")}
    return union_all(
        [campaign.empty_run_allowed(x, True).withColumn("log", F.lit(n)) for n, x in logs.items()]
    )


# --- receipts ------------------------------------------------------------------------


@query(
    "j12_reconcile",
    """SELECT task_id, run_id AS source_run_id, 'campaign_run' AS origin FROM camp_runs
       WHERE k % 160 = 0 AND k % 400 <> 0 AND k % 280 <> 0""",
    CAMPAIGN_VIEWS,
)
def j12_reconcile(spark, sf):
    created, _ = campaign.new_receipts(
        PLAN, tasks(spark, sf), receipts(spark, sf, every=False), manifests(spark, sf)
    )
    return created.select("task_id", "source_run_id", "origin")


@query(
    "j12_unknown_tasks",
    """SELECT run_id AS source_run_id, 'X' || task_id AS task_id FROM camp_runs
       WHERE k % 200 = 0 AND k % 400 <> 0 AND k % 280 <> 0""",
    CAMPAIGN_VIEWS,
)
def j12_unknown_tasks(spark, sf):
    odd = F.substring("run_id", 5, 18).cast("bigint") % 200 == 0
    named = manifests(spark, sf).withColumn(
        "campaign_task_id",
        F.when(odd, F.concat(F.lit("X"), F.col("campaign_task_id"))).otherwise(
            F.col("campaign_task_id")
        ),
    )
    _, unknown = campaign.new_receipts(PLAN, tasks(spark, sf), receipts(spark, sf), named)
    return unknown


@query(
    "j12_collisions",
    """SELECT 'camp-1' AS campaign_id, task_id, run_id AS source_run_id FROM camp_runs
       WHERE k % 120 = 0""",
    CAMPAIGN_VIEWS,
)
def j12_collisions(spark, sf):
    odd = F.substring("source_run_id", 5, 18).cast("bigint") % 120 == 0
    other = receipts(spark, sf).withColumn(
        "origin", F.when(odd, "adopted_run").otherwise(F.col("origin"))
    )
    return campaign.receipt_collisions(receipts(spark, sf), other)


@query(
    "s10_invalid_receipts",
    """SELECT task_id, run_id AS source_run_id, CASE WHEN k % 120 = 0
         THEN '["campaign_mismatch"]' ELSE '["contract_mismatch"]' END AS reasons
       FROM camp_runs WHERE k % 120 = 0 OR k % 200 = 0 AND k % 120 <> 0""",
    CAMPAIGN_VIEWS,
)
def s10_invalid_receipts(spark, sf):
    k = F.substring("source_run_id", 5, 18).cast("bigint")
    planted = receipts(spark, sf).withColumns(
        {
            "campaign_id": F.when(k % 120 == 0, "camp-2").otherwise(F.col("campaign_id")),
            "campaign_contract_version": F.when((k % 200 == 0) & (k % 120 != 0), "v0").otherwise(
                F.col("campaign_contract_version")
            ),
        }
    )
    return campaign.invalid_receipts(PLAN, tasks(spark, sf), planted)


# --- assessment ----------------------------------------------------------------------


@query(
    "g4_task_assessment",
    f"SELECT {_TASK_OUT}, source_run_id, status, {_DATED} FROM camp_attempts",
    CAMPAIGN_VIEWS,
)
def g4_task_assessment(spark, sf):
    return attempts(spark, sf).drop("recorded_at_utc")


@query(
    "g5_task_reduction",
    f"SELECT {_TASK_OUT}, status, selected_run_id, attempt_count, {_DATED} FROM camp_state",
    CAMPAIGN_VIEWS,
)
def g5_task_reduction(spark, sf):
    return assessments(spark, sf)


@query(
    "a8_task_counts",
    """SELECT s AS status, (SELECT count(*) FROM camp_state WHERE status = s) AS row_count
       FROM (VALUES ('pending'), ('complete'), ('empty'), ('failed'), ('stale'),
         ('incompatible')) t(s)""",
    CAMPAIGN_VIEWS,
)
def a8_task_counts(spark, sf):
    return campaign.task_counts(assessments(spark, sf))


@query("a9_symbol_rollup", "SELECT symbol, symbol_status FROM camp_symbols", CAMPAIGN_VIEWS)
def a9_symbol_rollup(spark, sf):
    return campaign.symbol_statuses(assessments(spark, sf))


@query(
    "a10_campaign_flags",
    """SELECT bool_and(status IN ('complete', 'empty')) AS campaign_complete,
         NOT bool_or(status = 'incompatible') AS assembly_compatible,
         bool_and(status IN ('complete', 'empty')) AS assembly_ready FROM camp_state""",
    CAMPAIGN_VIEWS,
)
def a10_campaign_flags(spark, sf):
    return campaign.campaign_flags(assessments(spark, sf))


@query(
    "f6_next_batch",
    """SELECT task_id, status FROM camp_state WHERE status IN ('pending', 'stale')
       ORDER BY symbol, start_date LIMIT 40""",
    CAMPAIGN_VIEWS,
)
def f6_next_batch(spark, sf):
    return campaign.next_batch(assessments(spark, sf), 40, retry_stale=True).select(
        "task_id", "status"
    )


@query(
    "f8_unresolved_tasks",
    "SELECT task_id, status FROM camp_state WHERE status IN ('failed', 'stale')",
    CAMPAIGN_VIEWS,
)
def f8_unresolved_tasks(spark, sf):
    from barledger.operators.forensics import unresolved_tasks

    return unresolved_tasks(assessments(spark, sf)).select("task_id", "status")


@query(
    "j13_adoptable",
    """SELECT run_id, covered AS covered_task_count, taken AS taken_task_count,
         CASE WHEN command <> 'data backfill-daily' OR run_status <> 'success'
             THEN 'source_not_successful_backfill'
           WHEN covered = 0 THEN 'covers_no_tasks'
           WHEN taken > 0 THEN 'task_already_resolved_by_other_run' ELSE 'adoptable' END
           AS verdict
       FROM (SELECT r.run_id, any_value(m.command) AS command, any_value(m.run_status)
             AS run_status, count(s.task_id) AS covered,
             count(s.task_id) FILTER (WHERE s.status IN ('complete', 'empty')
               AND s.selected_run_id <> r.run_id) AS taken
           FROM camp_runs r JOIN camp_manifests m ON m.m_run = r.run_id
           LEFT JOIN camp_state s ON s.symbol = r.symbol AND r.chunk_start <= s.start_date
             AND r.run_end >= s.end_date GROUP BY r.run_id)""",
    CAMPAIGN_VIEWS,
)
def j13_adoptable(spark, sf):
    return campaign.adoption_report(
        tasks(spark, sf), assessments(spark, sf), manifests(spark, sf)
    )


@query(
    "j7_task_rows",
    """SELECT symbol, strftime(date, '%Y-%m-%d') AS date, close, source_run_id,
         path AS source_normalized_path FROM camp_source""",
    CAMPAIGN_VIEWS,
)
def j7_task_rows(spark, sf):
    rows = stored_rows(spark, sf)
    return campaign.source_rows(assessments(spark, sf, rows), rows).select(
        "symbol", "date", "close", "source_run_id", "source_normalized_path"
    )


# --- readiness and assembly ----------------------------------------------------------

_CFG = coverage.CoverageConfig(60, 0.1, 2000, 0.2)


def campaign_frames(spark, sf):
    """(symbols, assessments, source rows, coverage) of the campaign's complete symbols."""
    stored = stored_rows(spark, sf)
    state = staged(assessments(spark, sf, stored))
    rows = staged(campaign.source_rows(state, stored))
    symbols = plan_symbols(spark, sf)
    cov = staged(readiness.campaign_coverage(PLAN, symbols, state, rows, _CFG))
    return symbols, state, rows, cov


_READY_VIEWS = {
    **CAMPAIGN_VIEWS,
    "ready_cov": """SELECT p.symbol, count(c.date) AS n,
          CASE WHEN count(c.date) = 0 AND s.symbol_status = 'complete' THEN 'absent'
            WHEN count(c.date) = 0 THEN 'not_ingested'
            WHEN s.symbol_status <> 'complete' THEN 'blocking_quality_issues'
            ELSE 'observed' END AS cls
        FROM suppliers p JOIN camp_symbols s ON s.symbol = p.symbol
          LEFT JOIN camp_source c ON c.symbol = p.symbol GROUP BY p.symbol, s.symbol_status""",
}


@query(
    "a11_readiness",
    """SELECT false AS campaign_complete, false AS task_sources_assembly_compatible,
         (SELECT count(*) > 0 FROM camp_source) AS source_rows_present,
         true AS source_symbol_dates_unique, true AS task_ranges_contiguous_non_overlapping,
         false AS structural_assembly_compatible, true AS full_universe_coverage_audited,
         false AS no_rejected_coverage_statuses, false AS minimum_vnd_usable_symbol_ratio,
         count(*) FILTER (WHERE cls = 'absent') = 0 AS maximum_absent_symbol_ratio,
         count(*) AS universe_symbol_count, count(*) AS audited_symbol_count,
         (SELECT count(*) FROM camp_source) AS source_row_count,
         CAST(count(*) FILTER (WHERE cls = 'absent') AS BIGINT) AS absent_symbol_count,
         CAST(count(*) FILTER (WHERE cls = 'absent') AS DOUBLE) / count(*) AS absent_symbol_ratio,
         (SELECT count(*) > 0 FROM camp_source) AS vnd_unit_provenance_permitted,
         'rejected' AS coverage_quality_status, 'rejected' AS research_readiness_status
       FROM ready_cov""",
    _READY_VIEWS,
)
def a11_readiness(spark, sf):
    symbols, state, rows, cov = campaign_frames(spark, sf)
    ready = readiness.readiness(PLAN, symbols, state, cov, rows)
    return ready.select(
        "campaign_complete", "task_sources_assembly_compatible", "source_rows_present",
        "source_symbol_dates_unique", "task_ranges_contiguous_non_overlapping",
        "structural_assembly_compatible", "full_universe_coverage_audited",
        "no_rejected_coverage_statuses", "minimum_vnd_usable_symbol_ratio",
        "maximum_absent_symbol_ratio", "universe_symbol_count", "audited_symbol_count",
        "source_row_count", "absent_symbol_count", "absent_symbol_ratio",
        "vnd_unit_provenance_permitted", "coverage_quality_status", "research_readiness_status",
    )


@query(
    "a29_campaign_audit",
    f"""SELECT 'camp-1' AS campaign_id, count(*) AS task_count,
         {", ".join(n_where(f"status = '{s}'") + f" AS task_{s}_count"
                    for s in ("pending", "complete", "empty", "failed", "stale", "incompatible"))},
         {", ".join(f"(SELECT count(*) FROM camp_symbols WHERE symbol_status = '{s}') "
                    f"AS symbol_{s}_count"
                    for s in ("complete", "incompatible", "stale", "failed", "partial", "pending"))},
         count(DISTINCT symbol) AS universe_symbol_count,
         count(DISTINCT selected_run_id) FILTER (WHERE status IN ('complete', 'empty'))
           AS resolved_task_source_run_count,
         (SELECT count(DISTINCT source_run_id) FROM camp_source) AS virtual_source_run_count,
         (SELECT count(*) FROM camp_source) AS virtual_source_row_count,
         (SELECT count(*) - count(DISTINCT (symbol, date)) FROM camp_source)
           AS duplicate_symbol_date_count,
         bool_and(status IN ('complete', 'empty')) AS campaign_complete
       FROM camp_state""",
    CAMPAIGN_VIEWS,
)
def a29_campaign_audit(spark, sf):
    symbols, state, rows, cov = campaign_frames(spark, sf)
    wide = readiness.audit_summary(PLAN, symbols, state, cov, rows)
    return wide.select(
        "campaign_id", "task_count",
        *[c for c in wide.columns if c.startswith("task_") and c.endswith("_count")
          and "range" not in c and c != "task_count"],
        *[c for c in wide.columns if c.startswith("symbol_")],
        "universe_symbol_count", "resolved_task_source_run_count", "virtual_source_run_count",
        "virtual_source_row_count", "duplicate_symbol_date_count", "campaign_complete",
    )


def digest_sql(lines: str, line: str = "line") -> str:
    """Oracle form of the multiset digest over a relation with one text column."""
    words = ", ".join(
        f"CAST(coalesce(sum(CAST(('0x' || substr(sha256({line}), {8 * i + 1}, 8)) AS BIGINT)), 0)"
        " AS VARCHAR)"
        for i in range(8)
    )
    return f"sha256(concat_ws('|', CAST(count({line}) AS VARCHAR), {words}))"


def _text(c: str) -> str:
    return f"coalesce('\"' || {c} || '\"', 'null')"


@query(
    "a12_evidence_digest",
    f"""SELECT sha256('{PLAN.campaign_id}|{PLAN.campaign_version}|{PLAN.normalized_version}|' ||
         {digest_sql("lines")}) AS evidence_digest
       FROM (SELECT '{{"task_id":' || {_text("task_id")} || ',"status":' || {_text("status")} ||
           ',"selected_run_id":' || {_text("selected_run_id")} || ',"observation_count":' ||
           observation_count || ',"first_observation_date":' || {_text("first_observation_date")}
           || ',"last_observation_date":' || {_text("last_observation_date")} ||
           ',"reason_codes":' || reason_codes || '}}' AS line FROM camp_state)""",
    CAMPAIGN_VIEWS,
)
def a12_evidence_digest(spark, sf):
    return readiness.evidence_digest(PLAN, assessments(spark, sf))


#: The plan's named fields as JSON in order of names, as the id's definition says.
_PLAN_JSON = (
    '{"adjustment": "unknown_provider_adjustment_flag", '
    '"campaign_id": "camp-1", '
    '"campaign_version": "daily-ingestion-campaign-v1", '
    '"chunk_days": 20, '
    '"data_backend": "kbs", '
    '"end": "2001-11-04", '
    '"exchange": "HOSE", '
    '"expected_adjusted_flag": null, '
    '"normalized_version": "normalized-daily-v2", '
    '"provenance": {"data_backend": "kbs", '
    '"evidence_reference": "vnstock-kbs-ohlcv-units@2026-01-31", '
    '"policy_name": "vnstock-kbs-daily-ohlcv", '
    '"policy_version": "1", '
    '"price_scale_to_vnd": 1000.0, '
    '"price_unit": "thousand_vnd", '
    '"provider": "vnstock", '
    '"schema_version": "daily-unit-provenance-v1", '
    '"source_resolution": "1D", '
    '"volume_scale_to_shares": 1.0, '
    '"volume_unit": "shares"}, '
    '"provider": "vnstock", '
    '"snapshot_date": "2001-11-05", '
    '"source_resolution": "1D", '
    '"stale_after_days": 10, '
    '"start": "1995-01-01"}'
)


@query(
    "a13_dataset_id",
    f"""SELECT 'assembled-daily-v1-' || substr(sha256('{_PLAN_JSON}|' ||
         {digest_sql("lines")}), 1, 16) AS assembled_dataset_id
       FROM (SELECT '{{"task_id":' || {_text("task_id")} || ',"status":' || {_text("status")} ||
           ',"selected_run_id":' || {_text("selected_run_id")} || '}}' AS line FROM camp_state)""",
    CAMPAIGN_VIEWS,
)
def a13_dataset_id(spark, sf):
    return readiness.assembled_dataset_id(PLAN, assessments(spark, sf))


@query(
    "j2_lineage",
    """SELECT symbol, strftime(date, '%Y-%m-%d') AS date, close, source_run_id,
         path AS source_normalized_path FROM camp_source""",
    CAMPAIGN_VIEWS,
)
def j2_lineage(spark, sf):
    """Join form: lineage attached to a panel built without it."""
    from barledger.operators.panel import daily_panel

    stored = stored_rows(spark, sf)
    rows = campaign.source_rows(assessments(spark, sf, stored), stored)
    panel = daily_panel(rows.drop("source_run_id", "source_normalized_path"), v.START, v.END)
    lineage = rows.select("symbol", "date", "source_run_id", "source_normalized_path")
    return readiness.attach_lineage(panel, lineage).select(
        "symbol", "date", "close", "source_run_id", "source_normalized_path"
    )


@query(
    "p13_assemble",
    """SELECT symbol, strftime(date, '%Y-%m-%d') AS date, open, high, low, close, volume,
         source_run_id, path AS source_normalized_path, 'camp-1' AS campaign_id,
         'assembled-daily-v1' AS assembly_contract_version,
         'daily-panel-v2' AS feature_input_contract_version,
         'verified' AS unit_provenance_status
       FROM camp_source""",
    CAMPAIGN_VIEWS,
)
def p13_assemble(spark, sf):
    rows = stored_rows(spark, sf)
    state = staged(assessments(spark, sf, rows))
    built = readiness.assemble(PLAN, state, campaign.source_rows(state, rows))
    return built.select(
        "symbol", "date", "open", "high", "low", "close", "volume", "source_run_id",
        "source_normalized_path", "campaign_id", "assembly_contract_version",
        "feature_input_contract_version", "unit_provenance_status",
    )

