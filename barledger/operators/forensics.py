"""Offline classification of failed and stale campaign tasks from landed evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barledger.contracts import MAX_BARS_PER_REQUEST, VALUE_COLUMNS
from barledger.functions.exprs import all_of, any_of, count_where, holds, lit_date, reasons
from barledger.operators.ordering import exact_rank, previous_value_by_day
from barledger.sources.staging import staged

# --- fixed values: root-cause categories ----------------------------------------------
OPEN_RANGE = "kbs_open_matches_previous_close_outside_range"
CLOSE_RANGE = "kbs_close_outside_reported_range_semantics_unresolved"
MIXED_RANGE = "mixed_kbs_open_and_close_range_inconsistency"
GENERIC_RANGE = "kbs_ohlc_range_inconsistency_unresolved"
NOT_REPRODUCED = "ohlc_violation_not_reproduced_from_local_raw"
MISSING_EVIDENCE = "required_local_evidence_missing"
HISTORICAL_STALE = "historical_missing_tail_with_later_resumption"
CURRENT_STALE = "campaign_end_missing_tail_without_later_campaign_observation"
UNRESOLVED_STALE = "historical_missing_tail_without_later_observation"
NORMALIZATION_MISMATCH = "stored_normalization_mismatch_requires_investigation"
POSSIBLE_TRUNCATION = "provider_response_at_documented_row_cap"
RELATIONS = {
    "high_below_low": ("high", "low"),
    "high_below_open": ("high", "open"),
    "high_below_close": ("high", "close"),
    "low_above_open": ("open", "low"),
    "low_above_close": ("close", "low"),
}
# --------------------------------------------------------------------------------------

_QUARANTINE = "quarantine_and_exclude_from_assembly"
_BLOCKED = "leave_blocked_unresolved"
_EXCLUDE = "exclude_from_assembly_and_leave_blocked"
_DECISIONS = [
    # state, category, disposition, next action, code fix, conditional retry trigger
    ("failed", OPEN_RANGE, _QUARANTINE, "Escalate the open-field semantics.", False, None),
    ("failed", CLOSE_RANGE, _QUARANTINE, "Obtain authoritative close-range semantics.", False, None),
    ("failed", MIXED_RANGE, _QUARANTINE, "Resolve open and close semantics first.", False, None),
    ("failed", GENERIC_RANGE, _BLOCKED, "Investigate the evidence mismatch.", False, None),
    ("failed", NOT_REPRODUCED, _BLOCKED, "Investigate the evidence mismatch.", True, None),
    ("failed", MISSING_EVIDENCE, _BLOCKED, "Restore the source evidence first.", False, None),
    ("stale", MISSING_EVIDENCE, _BLOCKED, "Restore the source evidence first.", False, None),
    (
        "stale", HISTORICAL_STALE, _EXCLUDE, "Seek trading-status evidence for the tail.", False,
        "The provider backfills the tail.",
    ),
    (
        "stale", CURRENT_STALE, _EXCLUDE, "Monitor for a new observation.", False,
        "A new observation after the campaign edge.",
    ),
    (
        "stale", POSSIBLE_TRUNCATION, _BLOCKED, "Repeat with a smaller request.", False,
        "A smaller request proves truncation.",
    ),
    (
        "stale", UNRESOLVED_STALE, _BLOCKED, "Investigate the unresolved edge.", False,
        "New authoritative or provider evidence.",
    ),
    (
        "stale", NORMALIZATION_MISMATCH, _BLOCKED, "Investigate the unresolved edge.", True,
        "New authoritative or provider evidence.",
    ),
]


def decision_table(spark: SparkSession) -> DataFrame:
    """Category to disposition lookup; twelve fixed rows, safe to broadcast."""
    return spark.createDataFrame(
        _DECISIONS,
        "state_status string, root_cause_category string, disposition string, "
        "next_action string, code_fix_required boolean, conditional_retry_trigger string",
    )


def unresolved_tasks(assessments: DataFrame) -> DataFrame:
    return assessments.where(F.col("status").isin("failed", "stale"))


def violated_relations() -> Column:
    """Ordered labels of the OHLC relations a row breaks."""
    return reasons(
        *[(holds(F.col(a) < F.col(b)), name) for name, (a, b) in RELATIONS.items()]
    )


def previous_close(rows: DataFrame, keys: list[str], position: Column) -> DataFrame:
    """Close of the previous observation per key and date."""
    return previous_value_by_day(rows, keys, "date", position, "close", "previous_close")


def violating_rows(rows: DataFrame, keys: list[str], position: Column) -> DataFrame:
    """Rows that break an OHLC relation, with the previous close of their date."""
    broken = rows.withColumn("relations", violated_relations()).where(F.size("relations") > 0)
    before = previous_close(rows, keys, position)
    joined = broken.join(before, [*keys, "date"], "left")
    opens = any_of(F.array_contains("relations", r) for r in RELATIONS if r.endswith("_open"))
    closes = any_of(F.array_contains("relations", r) for r in RELATIONS if r.endswith("_close"))
    return joined.withColumns(
        {
            "open_violation": opens,
            "close_violation": closes,
            "open_matches_previous_close": opens & holds(F.col("open") == F.col("previous_close")),
        }
    )


def classify_ohlc(tasks: DataFrame, rows: DataFrame, keys: list[str], position: Column) -> DataFrame:
    """OHLC category and violation counts per task; a task without violations keeps a row."""
    counts = violating_rows(rows, keys, position).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("affected_row_count"),
        count_where(F.col("open_violation")).alias("open_violation_row_count"),
        count_where(F.col("close_violation")).alias("close_violation_row_count"),
        count_where(F.col("open_matches_previous_close")).alias(
            "open_matches_previous_close_count"
        ),
        *[count_where(F.array_contains("relations", r)).alias(f"{r}_count") for r in RELATIONS],
    )
    joined = tasks.select(*keys).distinct().join(counts, keys, "left")
    numbers = [c for c in counts.columns if c not in keys]
    filled = joined.withColumns({c: F.coalesce(c, F.lit(0)).cast("bigint") for c in numbers})
    opens, closes = F.col("open_violation_row_count"), F.col("close_violation_row_count")
    every = (opens > 0) & (F.col("open_matches_previous_close_count") == opens)
    return filled.withColumn(
        "root_cause_category",
        F.when(F.col("affected_row_count") == 0, NOT_REPRODUCED)
        .when((opens > 0) & (closes == 0) & every, OPEN_RANGE)
        .when((closes > 0) & (opens == 0), CLOSE_RANGE)
        .when((opens > 0) & (closes > 0) & every, MIXED_RANGE)
        .otherwise(GENERIC_RANGE),
    )


def stale_category(
    task_end: Column,
    campaign_end: Column,
    next_date: Column,
    response_rows: Column,
    matches_raw: Column,
) -> Column:
    return (
        F.when(~holds(matches_raw), NORMALIZATION_MISMATCH)
        .when(response_rows >= MAX_BARS_PER_REQUEST, POSSIBLE_TRUNCATION)
        .when(task_end == campaign_end, CURRENT_STALE)
        .when(holds(next_date > task_end), HISTORICAL_STALE)
        .otherwise(UNRESOLVED_STALE)
    )


def compare_raw_and_stored(
    raw: DataFrame, stored: DataFrame, keys: list[str], position: str, ties: list[str] = ()
) -> DataFrame:
    """Positional comparison per task after ordering each side by date.

    Both frames carry ``date``, the five value columns and an integral input ordinal.  Rows are
    counted first: only keys with equal counts can match place by place, so only their rows are
    ranked and joined.
    """
    zero_of = F.lit(0).cast("bigint")
    counts = (
        raw.groupBy(*keys).agg(F.count(F.lit(1)).alias("__raw")).withColumn("__stored", zero_of)
        .unionByName(
            stored.groupBy(*keys).agg(F.count(F.lit(1)).alias("__stored")).withColumn("__raw", zero_of)
        )
        .groupBy(*keys)
        .agg(F.sum("__raw").alias("raw_row_count"), F.sum("__stored").alias("stored_row_count"))
    )
    even = counts.where("raw_row_count = stored_row_count").select(
        *[F.col(k).alias(f"__even_{k}") for k in keys]
    )
    own = list(dict.fromkeys([*keys, "date", position, *ties, *VALUE_COLUMNS]))

    def side(df: DataFrame, tag: str) -> DataFrame:
        kept = df.select(*own).join(
            even, all_of(F.col(k).eqNullSafe(F.col(f"__even_{k}")) for k in keys), "left_semi"
        )
        ranked = exact_rank(kept, keys, "date", position, ties, name="rank")
        return ranked.select(
            *keys,
            "rank",
            F.col("date").alias(f"{tag}_date"),
            *[F.col(c).alias(f"{tag}_{c}") for c in VALUE_COLUMNS],
        )

    both = side(raw, "raw").join(side(stored, "stored"), [*keys, "rank"], "full_outer")
    matched = both.groupBy(*[F.col(k).alias(f"__even_{k}") for k in keys]).agg(
        F.bool_and(F.col("raw_date").eqNullSafe(F.col("stored_date"))).alias("__dates"),
        *[
            F.max(F.abs(F.col(f"raw_{c}") - F.col(f"stored_{c}"))).alias(f"__delta_{c}")
            for c in VALUE_COLUMNS
        ],
    )
    grouped = counts.join(
        matched, all_of(F.col(k).eqNullSafe(F.col(f"__even_{k}")) for k in keys), "left"
    ).drop(*[f"__even_{k}" for k in keys])
    same_count = F.col("raw_row_count") == F.col("stored_row_count")
    counted = grouped.withColumns(
        {
            "row_counts_match": same_count,
            "dates_match": same_count & F.col("__dates"),
            **{
                f"max_absolute_delta_{c}": F.when(same_count, F.col(f"__delta_{c}"))
                for c in VALUE_COLUMNS
            },
        }
    )
    zero = all_of(holds(F.col(f"max_absolute_delta_{c}") == 0) for c in VALUE_COLUMNS)
    return counted.withColumn("exact_match", F.col("dates_match") & zero).drop(
        "__dates", *[f"__delta_{c}" for c in VALUE_COLUMNS]
    )


def next_observation(
    stale: DataFrame, assessments: DataFrame, raw_days: DataFrame
) -> DataFrame:
    """Forward as-of: the first later task of the symbol with an observation after the edge.

    ``stale`` has task_id, symbol, end_date and last_date; ``raw_days`` has one row per
    (run_id, symbol, date).  Days first shrink to the last one of each run and symbol, which
    tells the task to look into; tasks meet tasks only, at most one for each chunk of the
    plan's range.  The day itself comes from one window over the edges and the days of the
    chosen run and symbol together, so no day is joined with an edge.
    """
    later = assessments.where("selected_run_id is not null").select(
        "symbol",
        F.col("start_date").alias("later_start"),
        F.col("selected_run_id").alias("run_id"),
    )
    last = raw_days.groupBy("run_id", "symbol").agg(F.max("date").alias("run_last"))
    edges = stale.select("task_id", "symbol", "end_date", "last_date")
    chosen = (
        edges.join(later.join(last, ["run_id", "symbol"]), "symbol")
        .where("later_start > end_date and run_last > last_date")
        .groupBy("task_id", "symbol", "last_date")
        .agg(F.min_by("run_id", F.struct("later_start", "run_id")).alias("run_id"))
    )
    marks = chosen.select("run_id", "symbol", F.col("last_date").alias("date"), "task_id")
    days = raw_days.join(chosen, ["run_id", "symbol"], "left_semi").select(
        "run_id", "symbol", "date", F.lit(None).cast("string").alias("task_id")
    )
    # from the newest day back; an edge stands before the days of its own date
    back = Window.partitionBy("run_id", "symbol").orderBy(
        F.col("date").desc(), F.col("task_id").isNull()
    )
    seen = F.last(F.when(F.col("task_id").isNull(), F.col("date")), ignorenulls=True).over(
        back.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        days.unionByName(marks)
        .withColumn("next_observation_date", seen)
        .where("task_id is not null")
        .select("task_id", "next_observation_date", F.col("run_id").alias("next_source_run_id"))
    )


def edge_rows(rows: DataFrame, edges: DataFrame, position: Column, tag: str) -> DataFrame:
    """Values of the last row at each task's edge date."""
    values = F.struct(*VALUE_COLUMNS)
    return (
        rows.join(edges.select("task_id", F.col("last_date").alias("date")), ["task_id", "date"])
        .groupBy("task_id")
        .agg(F.max_by(values, position).alias(f"edge_{tag}"))
    )


def load_errors() -> Column:
    """Evidence gaps of a task from manifest, raw and stored presence flags."""
    f = F.col
    return F.sort_array(
        reasons(
            (f("selected_run_id").isNull(), "selected_run_id_missing"),
            (f("selected_run_id").isNotNull() & ~f("manifest_found"), "manifest_missing"),
            (f("manifest_found") & ~f("manifest_readable"), "manifest_unreadable"),
            (f("selected_run_id").isNotNull() & ~f("raw_found"), "raw_jsonl_missing"),
            (f("raw_found") & ~f("raw_readable"), "raw_jsonl_unreadable"),
            (
                (f("status") == "stale") & f("raw_found") & ~f("stored_found"),
                "normalized_parquet_missing",
            ),
        )
    )


def forensic_records(
    campaign_end: str,
    assessments: DataFrame,
    manifests: DataFrame,
    raw: DataFrame,
    normalized_raw: DataFrame,
    stored: DataFrame,
    unreadable: DataFrame | None = None,
) -> DataFrame:
    """One record per failed or stale task: category, evidence, decision.

    ``unreadable`` (run_id) names the runs whose landed evidence holds lines that could not be
    parsed; their tasks lack required evidence.

    ``raw`` holds the landed rows per (run_id, symbol) with ``date``, values and
    ``position``; ``normalized_raw`` is its re-normalization, ``stored`` the published
    rows.  Failed tasks compare raw with the re-normalization, stale ones with the store.
    """
    tasks = unresolved_tasks(assessments).select(
        "task_id", "symbol", "start_date", "end_date", "status", "selected_run_id", "reason_codes"
    )
    runs = tasks.select(
        "task_id", "symbol", F.col("selected_run_id").alias("run_id"), "status"
    )
    own = ["task_id", "date", *VALUE_COLUMNS, "position"]

    def of_tasks(df: DataFrame, state: str | None) -> DataFrame:
        wanted = runs if state is None else runs.where(F.col("status") == state)
        needed = df.select("run_id", "symbol", *own[1:])
        return wanted.select("task_id", "run_id", "symbol").join(
            needed, ["run_id", "symbol"]
        ).select(*own)

    # Read by several steps below, so written once.
    raw_rows = staged(of_tasks(raw, None))
    failed_rows = staged(of_tasks(normalized_raw, "failed"))
    stored_rows = staged(of_tasks(stored, "stale"))
    reference = failed_rows.unionByName(stored_rows)
    comparison = compare_raw_and_stored(
        raw_rows, reference, ["task_id"], "position", VALUE_COLUMNS
    )
    order = F.struct("position", *VALUE_COLUMNS)
    ohlc = classify_ohlc(
        tasks.where("status = 'failed'"), failed_rows, ["task_id"], order
    )
    edges = stored_rows.groupBy("task_id").agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )
    stale = tasks.where("status = 'stale'").join(edges, "task_id")
    later = next_observation(
        stale, assessments, raw.select("run_id", "symbol", "date").where("date is not null").distinct()
    )
    raw_edge = edge_rows(raw_rows, edges, order, "raw")
    stored_edge = edge_rows(stored_rows, edges, order, "stored")
    known = manifests.select(
        F.col("run_id").alias("selected_run_id"),
        F.lit(True).alias("manifest_found"),
        F.coalesce(F.col("readable"), F.lit(True)).alias("manifest_readable"),
        F.col("status").alias("manifest_status"),
        F.col("start_date").alias("manifest_start"),
        F.col("end_date").alias("manifest_end"),
    )
    joined = (
        tasks.join(known, "selected_run_id", "left")
        .join(comparison, "task_id", "left")
        .join(ohlc.withColumnRenamed("root_cause_category", "__ohlc"), "task_id", "left")
        .join(edges, "task_id", "left")
        .join(later, "task_id", "left")
        .join(raw_edge, "task_id", "left")
        .join(stored_edge, "task_id", "left")
    )
    if unreadable is None:
        joined = joined.withColumn("__torn", F.lit(None).cast("boolean"))
    else:
        torn = unreadable.select(F.col("run_id").alias("selected_run_id")).distinct()
        joined = joined.join(torn.withColumn("__torn", F.lit(True)), "selected_run_id", "left")
    joined = joined.withColumns(
        {
            "manifest_found": F.coalesce("manifest_found", F.lit(False)),
            "manifest_readable": F.coalesce("manifest_readable", F.lit(True)),
            "raw_found": F.coalesce(F.col("raw_row_count") > 0, F.lit(False)),
            "raw_readable": F.col("__torn").isNull(),
            "stored_found": F.coalesce(F.col("stored_row_count") > 0, F.lit(False)),
        }
    ).withColumn("load_errors", load_errors())
    lost = F.size("load_errors") > 0
    edge = stale_category(
        F.col("end_date"), lit_date(campaign_end), F.col("next_observation_date"),
        F.col("raw_row_count"), F.col("exact_match"),
    )
    category = (
        F.when(lost, MISSING_EVIDENCE)
        .when(F.col("status") == "failed", F.col("__ohlc"))
        .otherwise(edge)
    )
    complete = (
        ~lost
        & holds(F.col("exact_match"))
        & F.when(F.col("status") == "failed", holds(F.col("affected_row_count") > 0)).otherwise(
            holds(F.col("manifest_status") == "success")
        )
    )
    record = joined.withColumns(
        {
            "root_cause_category": category,
            "evidence_complete": complete,
            "state_status": F.col("status"),
            "retry_justified_now": F.lit(False),
            "missing_tail_calendar_days": F.datediff("end_date", "last_date"),
            "resumption_gap_calendar_days": F.datediff("next_observation_date", "last_date"),
            "request_bounds_match_task": (
                F.col("manifest_start").try_cast("date") == F.col("start_date")
            )
            & (F.col("manifest_end").try_cast("date") == F.col("end_date")),
            "affected_row_count": F.coalesce("affected_row_count", F.lit(0)).cast("bigint"),
        }
    )
    decisions = F.broadcast(decision_table(assessments.sparkSession))
    return record.join(decisions, ["state_status", "root_cause_category"], "left").select(
        "task_id",
        "symbol",
        "start_date",
        "end_date",
        "state_status",
        "selected_run_id",
        F.col("reason_codes").alias("state_reason_codes"),
        "root_cause_category",
        "load_errors",
        "manifest_status",
        "raw_row_count",
        "stored_row_count",
        "exact_match",
        "affected_row_count",
        "open_violation_row_count",
        "close_violation_row_count",
        "open_matches_previous_close_count",
        *[f"{r}_count" for r in RELATIONS],
        F.col("first_date").alias("first_observation_date_stored"),
        F.col("last_date").alias("last_observation_date_stored"),
        "missing_tail_calendar_days",
        "next_observation_date",
        "next_source_run_id",
        "resumption_gap_calendar_days",
        "request_bounds_match_task",
        "edge_raw",
        "edge_stored",
        "evidence_complete",
        "retry_justified_now",
        "code_fix_required",
        "disposition",
        "next_action",
        "conditional_retry_trigger",
    )


def forensic_categories(records: DataFrame) -> DataFrame:
    """Tasks, symbols and affected rows per root-cause category."""
    return records.groupBy("root_cause_category").agg(
        F.count(F.lit(1)).alias("task_count"),
        F.countDistinct("symbol").alias("symbol_count"),
        F.sum("affected_row_count").cast("bigint").alias("affected_row_count"),
    )


def forensic_summary(records: DataFrame) -> DataFrame:
    """One row of totals over all classified tasks."""
    failed, stale = F.col("state_status") == "failed", F.col("state_status") == "stale"
    by_symbol = records.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("tasks"),
        count_where(failed).alias("failed"),
        count_where(stale).alias("stale"),
        F.sum(F.when(failed, F.col("affected_row_count"))).alias("rows"),
        count_where(F.col("evidence_complete")).alias("complete"),
        count_where(F.col("retry_justified_now")).alias("retry"),
        count_where(F.col("code_fix_required")).alias("fix"),
        *[F.sum(F.when(failed, F.col(f"{r}_count"))).alias(r) for r in RELATIONS],
    )

    def total(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    return by_symbol.agg(
        total("tasks").alias("classified_task_count"),
        total("failed").alias("failed_task_count"),
        total("stale").alias("stale_task_count"),
        count_where(F.col("failed") > 0).alias("symbols_with_failed_tasks"),
        count_where(F.col("stale") > 0).alias("symbols_with_stale_tasks"),
        count_where((F.col("failed") > 0) & (F.col("stale") > 0)).alias(
            "symbols_with_both_failed_and_stale_tasks"
        ),
        F.count(F.lit(1)).alias("not_ingested_symbol_count"),
        total("rows").alias("failed_affected_row_count"),
        total("complete").alias("tasks_with_complete_local_evidence"),
        (total("tasks") - total("complete")).alias("tasks_missing_required_local_evidence"),
        total("retry").alias("tasks_eligible_for_immediate_retry"),
        total("fix").alias("tasks_requiring_code_fix"),
        *[total(r).alias(f"{r}_count") for r in RELATIONS],
    )


def attach_artifacts(records: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Evidence paths and digests of each record's run.

    ``artifacts`` has one row per (run_id, kind) with ``path`` and ``sha256``; kind is
    ``raw`` or ``normalized``.
    """
    result = records
    for kind in ("raw", "normalized"):
        side = artifacts.where(F.col("kind") == kind).select(
            F.col("run_id").alias("selected_run_id"),
            F.col("path").alias(f"{kind}_path"),
            F.col("sha256").alias(f"{kind}_sha256"),
        )
        result = result.join(side, "selected_run_id", "left")
    return result
