"""Queries for the forensic audit of failed and stale tasks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from barledger.catalog import views as v
from barledger.catalog.campaigns import CAMPAIGN_VIEWS, chunks_sql, plan_symbols
from barledger.catalog.oracles import json_list, n_where
from barledger.catalog.registry import query
from barledger.contracts import VALUE_COLUMNS
from barledger.functions import exprs as x
from barledger.operators import campaign, forensics, normalize
from barledger.sources.staging import staged

#: Two-year chunks, as in the forensic fixtures.
FORENSIC_PLAN = campaign.CampaignPlan("camp-1", v.START, v.END, v.CHUNK_DAYS, "2001-11-05")


def tasks(spark, sf):
    return campaign.campaign_tasks(FORENSIC_PLAN, plan_symbols(spark, sf))


def task_rows(spark, sf):
    """Clean bars per task with planted open, close and high violations.

    The planted open equals the previous close of the same task, so the window here has at
    most one row per calendar day of a chunk.  It names the supplier too, by whom the bars
    are dealt already: the task needs no shuffle of its own.
    """
    bars = v.bars_clean(spark, sf).where(F.col("date") <= x.lit_date(v.END))  # the tasks' range
    chunk = F.floor(F.datediff("date", x.lit_date(v.START)) / v.CHUNK_DAYS).cast("int")
    start = F.date_add(x.lit_date(v.START), chunk * v.CHUNK_DAYS)
    end = F.least(F.date_add(start, v.CHUNK_DAYS - 1), x.lit_date(v.END))
    k = F.col("orderkey")
    rows = bars.withColumns(
        {
            "task_id": F.concat_ws("__", "symbol", start.cast("string"), end.cast("string")),
            "close": F.when(k % 61 == 0, F.col("high") + 1).otherwise(F.col("close")),
        }
    )
    before = F.lag("close").over(Window.partitionBy("suppkey", "task_id").orderBy("date"))
    planted = rows.withColumns(
        {
            "open": F.when((k % 59 == 0) & before.isNotNull(), before).otherwise(F.col("open")),
            "high": F.when(k % 1009 == 0, F.col("low") - 1).otherwise(F.col("high")),
        }
    ).select("task_id", "symbol", "suppkey", "orderkey", "date", *VALUE_COLUMNS)
    return staged(planted)


def stored_copy(rows):
    """A stored copy that differs: shifted closes and removed rows."""
    return rows.where("orderkey % 83 <> 0").withColumn(
        "close",
        F.when(F.col("orderkey") % 89 == 0, F.col("close") + 1).otherwise(F.col("close")),
    )


FORENSIC_VIEWS = {
    **CAMPAIGN_VIEWS,
    "chunks": chunks_sql(v.CHUNK_DAYS),
    "f_moved": """SELECT b.* EXCLUDE (close), t.task_id, t.end_date,
          CASE WHEN orderkey % 61 = 0 THEN high + 1 ELSE close END AS close
        FROM bars_clean b JOIN camp_tasks t ON t.symbol = b.symbol
          AND b.date BETWEEN t.start_date AND t.end_date""",
    "f_rows": """SELECT * EXCLUDE (open, high, was), CASE WHEN orderkey % 59 = 0 THEN
          coalesce(was, open) ELSE open END AS open,
          CASE WHEN orderkey % 1009 = 0 THEN low - 1 ELSE high END AS high
        FROM (SELECT *, lag(close) OVER (PARTITION BY task_id ORDER BY date) AS was
          FROM f_moved)""",
    "f_flags": """SELECT *, (high < open) OR (low > open) AS bad_open,
          (high < close) OR (low > close) AS bad_close, high < low AS bad_range,
          lag(close) OVER (PARTITION BY task_id ORDER BY date) AS previous_close FROM f_rows""",
    "f_ohlc": f"""SELECT *, CASE WHEN affected = 0
            THEN 'ohlc_violation_not_reproduced_from_local_raw'
          WHEN opens > 0 AND closes = 0 AND same = opens
            THEN 'kbs_open_matches_previous_close_outside_range'
          WHEN closes > 0 AND opens = 0
            THEN 'kbs_close_outside_reported_range_semantics_unresolved'
          WHEN opens > 0 AND closes > 0 AND same = opens
            THEN 'mixed_kbs_open_and_close_range_inconsistency'
          ELSE 'kbs_ohlc_range_inconsistency_unresolved' END AS category
        FROM (SELECT task_id, {n_where("bad_open OR bad_close OR bad_range")} AS affected,
            {n_where("bad_open")} AS opens, {n_where("bad_close")} AS closes,
            {n_where("bad_open AND coalesce(open = previous_close, false)")} AS same,
            {n_where("high < low")} AS hl, {n_where("high < open")} AS ho,
            {n_where("high < close")} AS hc, {n_where("low > open")} AS lo,
            {n_where("low > close")} AS lc
          FROM camp_tasks LEFT JOIN f_flags USING (task_id) GROUP BY task_id)""",
    "f_stored": """SELECT * EXCLUDE (close), CASE WHEN orderkey % 89 = 0 THEN close + 1
          ELSE close END AS close FROM f_rows WHERE orderkey % 83 <> 0""",
    "f_pairs": """SELECT coalesce(a.task_id, b.task_id) AS task_id, a.date AS ad, b.date AS bd,
          abs(a.open - b.open) AS d_open, abs(a.high - b.high) AS d_high,
          abs(a.low - b.low) AS d_low, abs(a.close - b.close) AS d_close,
          abs(a.volume - b.volume) AS d_volume
        FROM (SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY date) AS rn FROM f_rows) a
        FULL JOIN (SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY date) AS rn
          FROM f_stored) b ON a.task_id = b.task_id AND a.rn = b.rn""",
    "f_compare": """SELECT *, n_raw = n_stored AS same_count,
          n_raw = n_stored AND dates AS same_dates,
          n_raw = n_stored AND dates AND coalesce(greatest(d_open, d_high, d_low, d_close,
            d_volume) = 0, false) AS exact
        FROM (SELECT task_id, count(ad) AS n_raw, count(bd) AS n_stored,
            bool_and(ad IS NOT DISTINCT FROM bd) AS dates, max(d_open) AS d_open,
            max(d_high) AS d_high, max(d_low) AS d_low, max(d_close) AS d_close,
            max(d_volume) AS d_volume FROM f_pairs GROUP BY task_id)""",
}


@query(
    "w1_prev_close",
    """SELECT symbol, strftime(date, '%Y-%m-%d') AS date,
         arg_max(was, rn) FILTER (WHERE was IS NOT NULL) AS previous_close
       FROM (SELECT symbol, date, lag(close) OVER w AS was, row_number() OVER w AS rn
         FROM bars_raw WHERE date IS NOT NULL WINDOW w AS (PARTITION BY symbol ORDER BY date,
           l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity))
       GROUP BY symbol, date""",
)
def w1_prev_close(spark, sf):
    bars = normalize.daily_bars(v.bars_raw(spark, sf), v.stamp(), carry=v.LINE_ORDER)
    return forensics.previous_close(bars, ["symbol"], F.struct(*v.LINE_ORDER))


@query(
    "a14_ohlc_forensics",
    """SELECT task_id, affected AS affected_row_count, opens AS open_violation_row_count,
         closes AS close_violation_row_count, same AS open_matches_previous_close_count,
         hl AS high_below_low_count, ho AS high_below_open_count, hc AS high_below_close_count,
         lo AS low_above_open_count, lc AS low_above_close_count, category AS root_cause_category
       FROM f_ohlc""",
    FORENSIC_VIEWS,
)
def a14_ohlc_forensics(spark, sf):
    return forensics.classify_ohlc(
        tasks(spark, sf), task_rows(spark, sf), ["task_id"], F.col("orderkey")
    )


@query(
    "g11_affected_rows",
    f"""SELECT task_id, strftime(date, '%Y-%m-%d') AS date, {json_list([
        ("high < low", "high_below_low"), ("high < open", "high_below_open"),
        ("high < close", "high_below_close"), ("low > open", "low_above_open"),
        ("low > close", "low_above_close")])} AS relations, previous_close,
         bad_open AND coalesce(open = previous_close, false) AS open_matches_previous_close
       FROM f_flags WHERE bad_open OR bad_close OR bad_range""",
    FORENSIC_VIEWS,
)
def g11_affected_rows(spark, sf):
    return forensics.violating_rows(
        task_rows(spark, sf), ["task_id"], F.col("orderkey")
    ).select("task_id", "date", "relations", "previous_close", "open_matches_previous_close")


@query(
    "a16_raw_vs_stored",
    """SELECT task_id, n_raw AS raw_row_count, n_stored AS stored_row_count,
         same_count AS row_counts_match, same_dates AS dates_match,
         CASE WHEN same_count THEN d_close END AS max_absolute_delta_close,
         CASE WHEN same_count THEN d_open END AS max_absolute_delta_open, exact AS exact_match
       FROM f_compare""",
    FORENSIC_VIEWS,
)
def a16_raw_vs_stored(spark, sf):
    rows = task_rows(spark, sf)
    return forensics.compare_raw_and_stored(
        rows, stored_copy(rows), ["task_id"], "orderkey"
    ).drop("max_absolute_delta_high", "max_absolute_delta_low", "max_absolute_delta_volume")


@query(
    "j11_positional",
    """SELECT symbol, strftime(date, '%Y-%m-%d') AS date, l_orderkey, row_number() OVER (
         PARTITION BY symbol ORDER BY date NULLS LAST, l_orderkey, l_linenumber, l_partkey,
           l_extendedprice, l_quantity) AS rank FROM bars_raw""",
)
def j11_positional(spark, sf):
    """Exact rank within a symbol, computed in bounded sub-buckets."""
    bars = normalize.daily_bars(v.bars_raw(spark, sf), v.stamp(), carry=v.LINE_ORDER)
    from barledger.operators.ordering import exact_rank

    ranked = exact_rank(bars, ["symbol"], "date", "l_orderkey", v.LINE_ORDER[1:])
    return ranked.select("symbol", "date", "l_orderkey", "rank")


# --- stale edges ---------------------------------------------------------------------


def staged_tasks(spark, sf):
    """(assessments, rows per run): failed, stale and complete tasks by supplier number."""
    rows = task_rows(spark, sf)
    last = rows.groupBy("task_id").agg(
        F.max("date").alias("last_date"), F.min("suppkey").alias("k")
    )
    k = F.col("k")
    state = tasks(spark, sf).join(last, "task_id").withColumns(
        {
            "status": F.when(k % 4 == 0, "failed")
            .when((k % 4 == 1) & (F.datediff("end_date", "last_date") > 5), "stale")
            .otherwise("complete"),
            "selected_run_id": F.when(k % 16 != 4, F.concat(F.lit("R-"), F.col("task_id"))),
            "reason_codes": F.array(F.lit("staged")),
        }
    )
    return staged(state), rows.withColumn("run_id", F.concat(F.lit("R-"), F.col("task_id")))


_STAGED = {
    **FORENSIC_VIEWS,
    "f_state": """SELECT t.*, l.last_d, k, CASE WHEN k % 4 = 0 THEN 'failed'
          WHEN k % 4 = 1 AND date_diff('day', last_d, t.end_date) > 5 THEN 'stale'
          ELSE 'complete' END AS status, CASE WHEN k % 16 <> 4 THEN 'R-' || t.task_id END AS run
        FROM camp_tasks t JOIN (SELECT task_id, max(date) AS last_d, min(suppkey) AS k
          FROM f_rows GROUP BY task_id) l USING (task_id)""",
    "f_next": """SELECT task_id, arg_min(d, start_date) AS next_d, arg_min(run, start_date)
          AS next_run FROM (SELECT s.task_id, l.start_date, l.run, min(r.date) AS d
            FROM f_state s JOIN f_state l ON l.symbol = s.symbol AND l.start_date > s.end_date
              AND l.run IS NOT NULL JOIN f_rows r ON r.task_id = l.task_id AND r.date > s.last_d
            WHERE s.status = 'stale' GROUP BY ALL) GROUP BY task_id""",
}


def _stale_edges(state):
    return state.where("status = 'stale'")


def _raw_days(rows):
    return rows.select("run_id", "symbol", "date").distinct()


@query(
    "j10_next_observation",
    """SELECT task_id, strftime(next_d, '%Y-%m-%d') AS next_observation_date,
         next_run AS next_source_run_id FROM f_next""",
    _STAGED,
)
def j10_next_observation(spark, sf):
    state, rows = staged_tasks(spark, sf)
    return forensics.next_observation(_stale_edges(state), state, _raw_days(rows))


_CATEGORY_SQL = f"""CASE WHEN NOT exact THEN 'stored_normalization_mismatch_requires_investigation'
    WHEN n_raw >= 1000 THEN 'provider_response_at_documented_row_cap'
    WHEN end_date = DATE '{v.END}'
      THEN 'campaign_end_missing_tail_without_later_campaign_observation'
    WHEN next_d > end_date THEN 'historical_missing_tail_with_later_resumption'
    ELSE 'historical_missing_tail_without_later_observation' END"""


@query(
    "a15_stale_edge",
    f"""SELECT task_id, {_CATEGORY_SQL} AS root_cause_category FROM f_state
         JOIN f_compare USING (task_id) LEFT JOIN f_next USING (task_id)
       WHERE status = 'stale'""",
    _STAGED,
)
def a15_stale_edge(spark, sf):
    state, rows = staged_tasks(spark, sf)
    edges = _stale_edges(state)
    later = forensics.next_observation(edges, state, _raw_days(rows))
    own = rows.join(edges.select("task_id"), "task_id", "left_semi")  # of stale tasks only
    compared = forensics.compare_raw_and_stored(own, stored_copy(own), ["task_id"], "orderkey")
    category = forensics.stale_category(
        F.col("end_date"), x.lit_date(v.END), F.col("next_observation_date"),
        F.col("raw_row_count"), F.col("exact_match"),
    )
    return (
        edges.join(compared, "task_id")
        .join(later, "task_id", "left")
        .select("task_id", category.alias("root_cause_category"))
    )


def records(spark, sf):
    state, rows = staged_tasks(spark, sf)
    k = F.col("k")
    manifests = state.where("k % 25 <> 1").select(
        F.col("selected_run_id").alias("run_id"),
        (k % 20 != 8).alias("readable"),
        F.when(k % 4 == 0, "failed").otherwise("success").alias("status"),
        F.col("start_date").cast("string").alias("start_date"),
        F.when(k % 3 == 0, F.date_sub("end_date", 1))
        .otherwise(F.col("end_date"))
        .cast("string")
        .alias("end_date"),
    )
    raw = rows.withColumn("position", F.col("orderkey"))
    kept = raw.where("suppkey % 21 <> 0")
    torn = state.where("k % 22 = 3").select(F.col("selected_run_id").alias("run_id"))
    return forensics.forensic_records(
        v.END, state, manifests, kept, kept, stored_copy(kept).where("suppkey % 33 <> 0"), torn
    )


_RECORDS = {
    **_STAGED,
    "f_evidence": """SELECT s.task_id, s.symbol, s.start_date, s.end_date, s.status, s.last_d, s.k,
          s.run, s.k % 25 <> 1 AS has_manifest, s.k % 20 = 8 AND s.k % 25 <> 1 AS unreadable,
          s.k % 21 <> 0 AS has_raw, s.k % 33 <> 0 AND s.k % 21 <> 0 AS has_stored,
          c.n_raw, c.n_stored, CASE WHEN s.status = 'failed' THEN true ELSE c.exact END AS exact,
          n.next_d, n.next_run, o.*  EXCLUDE (task_id)
        FROM f_state s JOIN f_compare c USING (task_id) JOIN f_ohlc o USING (task_id)
          LEFT JOIN f_next_kept n USING (task_id) WHERE s.status IN ('failed', 'stale')""",
    "f_next_kept": "SELECT n.* FROM f_next n JOIN f_state USING (task_id) WHERE k % 21 <> 0",
    "f_errors": """SELECT *, list_sort(list_filter([
          CASE WHEN run IS NULL THEN 'selected_run_id_missing' END,
          CASE WHEN run IS NOT NULL AND NOT has_manifest THEN 'manifest_missing' END,
          CASE WHEN run IS NOT NULL AND unreadable THEN 'manifest_unreadable' END,
          CASE WHEN run IS NOT NULL AND NOT has_raw THEN 'raw_jsonl_missing' END,
          CASE WHEN run IS NOT NULL AND has_raw AND k % 22 = 3 THEN 'raw_jsonl_unreadable' END,
          CASE WHEN run IS NOT NULL AND status = 'stale' AND has_raw AND NOT has_stored
            THEN 'normalized_parquet_missing' END], lambda e: e IS NOT NULL)) AS errors
        FROM f_evidence""",
    "f_record": f"""SELECT *, len(errors) = 0 AND exact AND CASE WHEN status = 'failed'
            THEN affected > 0 ELSE true END AS complete,
          CASE WHEN len(errors) > 0 THEN 'required_local_evidence_missing'
            WHEN status = 'failed' THEN category ELSE {_CATEGORY_SQL} END AS cause
        FROM f_errors""",
}


@query(
    "g11_g12_forensic_records",
    """SELECT task_id, symbol, status AS state_status, run AS selected_run_id,
         cause AS root_cause_category, CAST(to_json(errors) AS VARCHAR) AS load_errors,
         complete AS evidence_complete,
         CASE WHEN status = 'stale' AND run IS NOT NULL AND has_stored
           THEN date_diff('day', last_s, end_date) END AS missing_tail_calendar_days,
         CASE WHEN status = 'failed' AND run IS NOT NULL AND has_raw THEN affected ELSE 0 END
           AS affected_row_count,
         cause IN ('ohlc_violation_not_reproduced_from_local_raw',
           'stored_normalization_mismatch_requires_investigation') AS code_fix_required,
         CASE WHEN cause IN ('kbs_open_matches_previous_close_outside_range',
             'kbs_close_outside_reported_range_semantics_unresolved',
             'mixed_kbs_open_and_close_range_inconsistency')
             THEN 'quarantine_and_exclude_from_assembly'
           WHEN cause IN ('historical_missing_tail_with_later_resumption',
             'campaign_end_missing_tail_without_later_campaign_observation')
             THEN 'exclude_from_assembly_and_leave_blocked'
           ELSE 'leave_blocked_unresolved' END AS disposition
       FROM f_record LEFT JOIN (SELECT task_id, max(date) AS last_s FROM f_stored
         GROUP BY task_id) USING (task_id)""",
    _RECORDS,
)
def g11_g12_forensic_records(spark, sf):
    return records(spark, sf).select(
        "task_id", "symbol", "state_status", "selected_run_id", "root_cause_category",
        "load_errors", "evidence_complete", "missing_tail_calendar_days", "affected_row_count",
        "code_fix_required", "disposition",
    )


@query(
    "g10_edge_evidence",
    """SELECT task_id, strftime(date, '%Y-%m-%d') AS last_date,
         '{"open":' || r.open || ',"high":' || r.high || ',"low":' || r.low || ',"close":' ||
           r.close || ',"volume":' || r.volume || '}' AS edge_raw,
         '{"open":' || s.open || ',"high":' || s.high || ',"low":' || s.low || ',"close":' ||
           s.close || ',"volume":' || s.volume || '}' AS edge_stored
       FROM (SELECT task_id, max(date) AS date FROM f_stored GROUP BY task_id) e
         JOIN f_rows r USING (task_id, date) JOIN f_stored s USING (task_id, date)""",
    FORENSIC_VIEWS,
)
def g10_edge_evidence(spark, sf):
    rows = task_rows(spark, sf)
    stored = stored_copy(rows)
    edges = stored.groupBy("task_id").agg(F.max("date").alias("last_date"))
    p = F.col("orderkey")
    return edges.join(forensics.edge_rows(rows, edges, p, "raw"), "task_id").join(
        forensics.edge_rows(stored, edges, p, "stored"), "task_id"
    )


@query(
    "a17_forensic_categories",
    """SELECT cause AS root_cause_category, count(*) AS task_count,
         count(DISTINCT symbol) AS symbol_count,
         CAST(sum(CASE WHEN status = 'failed' AND run IS NOT NULL AND has_raw THEN affected
           ELSE 0 END) AS BIGINT) AS affected_row_count FROM f_record GROUP BY cause""",
    _RECORDS,
)
def a17_forensic_categories(spark, sf):
    return forensics.forensic_categories(records(spark, sf))


_OWN = "status = 'failed' AND run IS NOT NULL AND has_raw"


def _relation_sum(c: str, name: str) -> str:
    return f"CAST(coalesce(sum({c}) FILTER (WHERE {_OWN}), 0) AS BIGINT) AS {name}_count"


@query(
    "a17_forensic_summary",
    f"""SELECT count(*) AS classified_task_count,
         {n_where("status = 'failed'")} AS failed_task_count,
         {n_where("status = 'stale'")} AS stale_task_count,
         count(DISTINCT symbol) FILTER (WHERE status = 'failed') AS symbols_with_failed_tasks,
         count(DISTINCT symbol) FILTER (WHERE status = 'stale') AS symbols_with_stale_tasks,
         (SELECT count(*) FROM (SELECT symbol FROM f_record WHERE status = 'failed' INTERSECT
           SELECT symbol FROM f_record WHERE status = 'stale'))
           AS symbols_with_both_failed_and_stale_tasks,
         count(DISTINCT symbol) AS not_ingested_symbol_count,
         CAST(coalesce(sum(affected) FILTER (WHERE {_OWN}), 0) AS BIGINT)
           AS failed_affected_row_count,
         {n_where("complete")} AS tasks_with_complete_local_evidence,
         {n_where("NOT complete")} AS tasks_missing_required_local_evidence,
         CAST(0 AS BIGINT) AS tasks_eligible_for_immediate_retry,
         {n_where("cause IN ('ohlc_violation_not_reproduced_from_local_raw', "
                  "'stored_normalization_mismatch_requires_investigation')")}
           AS tasks_requiring_code_fix,
         {_relation_sum("hl", "high_below_low")}, {_relation_sum("ho", "high_below_open")},
         {_relation_sum("hc", "high_below_close")}, {_relation_sum("lo", "low_above_open")},
         {_relation_sum("lc", "low_above_close")} FROM f_record""",
    _RECORDS,
)
def a17_forensic_summary(spark, sf):
    return forensics.forensic_summary(records(spark, sf))


@query(
    "j15_decisions",
    """SELECT category AS root_cause_category, CASE WHEN category IN (
           'kbs_ohlc_range_inconsistency_unresolved',
           'ohlc_violation_not_reproduced_from_local_raw') THEN 'leave_blocked_unresolved'
         ELSE 'quarantine_and_exclude_from_assembly' END AS disposition,
         count(*) AS task_count FROM f_ohlc GROUP BY category""",
    FORENSIC_VIEWS,
)
def j15_decisions(spark, sf):
    classified = forensics.classify_ohlc(
        tasks(spark, sf), task_rows(spark, sf), ["task_id"], F.col("orderkey")
    )
    decisions = F.broadcast(forensics.decision_table(spark).where("state_status = 'failed'"))
    return (
        classified.join(decisions, "root_cause_category")
        .groupBy("root_cause_category", "disposition")
        .agg(F.count(F.lit(1)).alias("task_count"))
    )
