"""Symbol-by-date ingestion campaigns: plan, receipts, attempts, task and symbol status.

Everything is a query over four append-only tables (tasks, receipts, manifests,
normalized rows); nothing is mutated in place.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barledger.contracts import (
    CAMPAIGN_VERSION,
    DAILY_RESOLUTION,
    MAX_BARS_PER_REQUEST,
    MAX_CHUNK_CALENDAR_DAYS,
    NORMALIZED_DAILY_VERSION,
    PROVIDER,
    RESOLVED_TASK_STATUSES,
    TASK_STATUSES,
    VALUE_COLUMNS,
)
from barledger.functions.exprs import (
    any_of,
    clean_text,
    column_or_null,
    count_where,
    holds,
    is_weekday,
    lit_date,
    reasons,
)
from barledger.operators.checks import ERROR, Rule, run_checks, uniqueness_check
from barledger.operators.quality import daily_row_blocked
from barledger.operators.sets import union_all
from barledger.operators.units import KBS, REGISTERED, UnitProvenance, matches_record
from barledger.sources.staging import staged

BACKFILL_COMMAND = "data backfill-daily"
UNKNOWN_ADJUSTMENT = "unknown_provider_adjustment_flag"
RUN, PART = "run_id", "partition_symbol"
#: Width of the stretches of days in which runs and tasks meet.
STRETCH_DAYS = 32


@dataclass(frozen=True)
class CampaignPlan:
    """Scalar part of a plan; its symbols and tasks are frames."""

    campaign_id: str
    start: str
    end: str
    chunk_days: int
    snapshot_date: str
    provider: str = PROVIDER
    data_backend: str = "kbs"
    exchange: str = "HOSE"
    source_resolution: str = DAILY_RESOLUTION
    campaign_version: str = CAMPAIGN_VERSION
    normalized_version: str = NORMALIZED_DAILY_VERSION
    adjustment: str = UNKNOWN_ADJUSTMENT
    expected_adjusted_flag: bool | None = None
    stale_after_days: int = 10
    provenance: UnitProvenance = KBS

    def __post_init__(self) -> None:
        if not re.fullmatch(r"[a-z0-9][a-z0-9-]{2,63}", self.campaign_id):
            raise ValueError("The campaign id is not a valid identifier.")
        if self.campaign_version != CAMPAIGN_VERSION:
            raise ValueError(f"Unsupported campaign contract: {self.campaign_version}.")
        if self.normalized_version != NORMALIZED_DAILY_VERSION:
            raise ValueError(f"Unsupported normalized daily contract: {self.normalized_version}.")
        if self.start > self.end:
            raise ValueError("The campaign start must not be after its end.")
        if self.end > self.snapshot_date:
            raise ValueError("The campaign end must not be after the universe snapshot.")
        source = (self.provider, self.data_backend, self.source_resolution)
        p = self.provenance
        if source != (p.provider, p.data_backend, p.source_resolution):
            raise ValueError("Campaign source fields must match the expected unit provenance.")
        if self.adjustment != UNKNOWN_ADJUSTMENT or self.expected_adjusted_flag is not None:
            raise ValueError("Campaigns require an unknown, null adjustment flag.")
        check_chunk_days(self.chunk_days)


#: Stored form of a plan: its scalar fields by type, the unit record as JSON of named fields.
PLAN_SCHEMA = (
    "campaign_id string, start string, end string, chunk_days int, snapshot_date string, "
    "provider string, data_backend string, exchange string, source_resolution string, "
    "campaign_version string, normalized_version string, adjustment string, "
    "expected_adjusted_flag boolean, stale_after_days int, provenance string, symbols_digest string"
)


def plan_values(plan: CampaignPlan, symbols_digest: str) -> dict[str, object]:
    """The stored row of a plan; the digest pins the symbols its tasks were made from."""
    values = dataclasses.asdict(plan)
    return {**values, "provenance": json.dumps(values["provenance"], sort_keys=True), "symbols_digest": symbols_digest}


def plan_of(values: dict[str, object]) -> CampaignPlan:
    """The plan of a stored row; contracts this library does not know are refused."""
    fields = {k: val for k, val in values.items() if k != "symbols_digest"}
    return CampaignPlan(**{**fields, "provenance": UnitProvenance(**json.loads(fields["provenance"]))})


def check_chunk_days(days: int) -> None:
    if days < 1:
        raise ValueError("The chunk length must be positive.")
    if days > MAX_CHUNK_CALENDAR_DAYS:
        raise ValueError("The chunk length exceeds the safe request size.")


# --- planning -------------------------------------------------------------------------


def chunk_starts(start: Column, end: Column, days: int) -> Column:
    return F.sequence(start, end, F.make_dt_interval(F.lit(days)))


def date_chunks(spark, start: dt.date | str, end: dt.date | str, days: int) -> DataFrame:
    """Contiguous closed ranges of ``days`` days; the last one is clipped."""
    check_chunk_days(days)
    if str(start) > str(end):
        raise ValueError("The start date must not be after the end date.")
    one = spark.range(1).select(
        F.explode(chunk_starts(lit_date(start), lit_date(end), days)).alias("start_date")
    )
    return one.withColumn(
        "end_date", F.least(F.date_add("start_date", days - 1), lit_date(end))
    )


def task_id() -> Column:
    return F.concat_ws(
        "__",
        F.upper("symbol"),
        F.date_format("start_date", "yyyy-MM-dd"),
        F.date_format("end_date", "yyyy-MM-dd"),
    )


def chunk_count(plan: CampaignPlan) -> int:
    """Chunks, so tasks per symbol, of a plan."""
    days = (dt.date.fromisoformat(plan.end) - dt.date.fromisoformat(plan.start)).days + 1
    return -(-days // plan.chunk_days)


def campaign_tasks(plan: CampaignPlan, symbols: DataFrame) -> DataFrame:
    """One task per symbol and date chunk; chunks are generated per symbol, not joined.

    The optimizer takes the tasks to be as few as the symbols: the hint keeps joins from
    broadcasting them, and the symbols are dealt first, so that no one task makes all rows.
    """
    starts = chunk_starts(lit_date(plan.start), lit_date(plan.end), plan.chunk_days)
    end = F.least(F.date_add("start_date", plan.chunk_days - 1), lit_date(plan.end))
    parts = int(symbols.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        symbols.select("symbol")
        .repartition(parts, "symbol")
        .withColumn("start_date", F.explode(starts))
        .withColumn("end_date", end)
        .select(task_id().alias("task_id"), "symbol", "start_date", "end_date")
        .hint("merge")
    )


def check_plan(plan: CampaignPlan, symbols: DataFrame, tasks: DataFrame) -> DataFrame:
    """Plan invariants as check rows; no rows means the plan is sound.

    Task rows compress to a few bytes each, so sizes of shuffled data say little about memory:
    the tasks are dealt into a fixed number of parts, which adaptive execution leaves apart.
    """
    dataset = "campaign_plan"
    parts = int(tasks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_id = tasks.select("task_id").repartition(parts, "task_id")
    tasks = tasks.repartition(parts, "symbol")
    # One window per symbol; a symbol has at most one task per chunk of the range.
    walk = Window.partitionBy("symbol").orderBy("start_date")
    before = F.lag("end_date").over(walk)
    after = F.lead("start_date").over(walk)
    stepped = tasks.withColumns(
        {
            "__gap": F.when(
                before.isNull(), F.col("start_date") != lit_date(plan.start)
            ).otherwise(F.col("start_date") != F.date_add(before, 1)),
            "__last": after.isNull(),
        }
    )
    rules = [
        Rule("task_range_ordered", ERROR, F.col("start_date") > F.col("end_date"), ["task_id"]),
        Rule("task_id_canonical", ERROR, F.col("task_id") != task_id(), ["task_id"]),
        Rule("task_ranges_contiguous", ERROR, F.col("__gap"), ["task_id"]),
        Rule(
            "task_within_chunk_size",
            ERROR,
            F.datediff("end_date", "start_date") + 1 > plan.chunk_days,
            ["task_id"],
        ),
        Rule(
            "task_within_campaign_range", ERROR, F.col("end_date") > lit_date(plan.end), ["task_id"]
        ),
        Rule(
            "tasks_cover_campaign_range",
            ERROR,
            F.col("__last") & (F.col("end_date") < lit_date(plan.end)),
            ["task_id"],
        ),
    ]
    known = symbols.select("symbol").distinct()
    stray = tasks.join(known, "symbol", "left_anti")
    idle = known.join(tasks.select("symbol").distinct(), "symbol", "left_anti")
    named = [
        Rule(
            "symbol_normalized",
            ERROR,
            ~F.col("symbol").eqNullSafe(clean_text(F.col("symbol"))),
            ["symbol"],
        )
    ]
    present = symbols.agg(F.count(F.lit(1)).alias("n")).withColumn("symbol", F.lit("*"))
    return union_all(
        [
            run_checks(stepped, dataset, rules, ["task_id"]),
            uniqueness_check(by_id, dataset, "task_id_unique", ["task_id"]),
            uniqueness_check(symbols, dataset, "symbol_unique", ["symbol"]),
            run_checks(symbols, dataset, named, ["symbol"]),
            run_checks(
                present, dataset, [Rule("symbols_present", ERROR, F.col("n") == 0, ["symbol"])]
            ),
            run_checks(
                stray, dataset, [Rule("task_symbol_in_universe", ERROR, F.lit(True), ["symbol"])]
            ),
            run_checks(
                idle, dataset, [Rule("symbol_has_tasks", ERROR, F.lit(True), ["symbol"])]
            ),
        ]
    )


def plan_is_new(plans: DataFrame, campaign_id: str) -> DataFrame:
    """A plan id is written once: True where the id does not exist yet."""
    return plans.where(F.col("campaign_id") == campaign_id).agg(
        (F.count(F.lit(1)) == 0).alias("is_new")
    )


# --- request-level checks of a daily backfill -----------------------------------------

REQUEST_LOG = "succeeded boolean, row_count bigint"


def request_checks(bars: DataFrame, limit: int = MAX_BARS_PER_REQUEST) -> DataFrame:
    """Rows per request, rows outside the requested chunk, and the truncation flag."""
    keys = ["symbol", "request_start_date", "request_end_date"]
    inside = F.col("date").between(F.col("request_start_date"), F.col("request_end_date"))
    return bars.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("row_count"),
        count_where(F.col("date").isNotNull() & ~inside).alias("outside_row_count"),
        (F.count(F.lit(1)) >= limit).alias("possibly_truncated"),
    )


def empty_run_allowed(requests: DataFrame, allow_empty: bool) -> DataFrame:
    """A run without rows succeeds only if allowed and every request succeeded empty.

    ``requests`` is the request log: (succeeded, row_count) per request.
    """
    return requests.agg(
        F.count(F.lit(1)).alias("request_count"),
        count_where(F.col("succeeded")).alias("succeeded_count"),
        count_where(F.col("succeeded") & (F.col("row_count") == 0)).alias("empty_count"),
    ).withColumn(
        "empty_is_complete",
        F.lit(allow_empty)
        & (F.col("succeeded_count") == F.col("request_count"))
        & (F.col("empty_count") == F.col("request_count")),
    )


# --- receipts -------------------------------------------------------------------------


def new_receipts(
    plan: CampaignPlan, tasks: DataFrame, receipts: DataFrame, manifests: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Receipts for campaign runs that have none yet, and runs naming an unknown task."""
    own = manifests.where(
        (F.col("command") == BACKFILL_COMMAND) & (F.col("campaign_id") == plan.campaign_id)
    ).select(
        F.lit(plan.campaign_version).alias("campaign_contract_version"),
        "campaign_id",
        F.col("campaign_task_id").alias("task_id"),
        F.col(RUN).alias("source_run_id"),
        F.lit("campaign_run").alias("origin"),
        F.col("finished_at_utc").alias("recorded_at_utc"),
    )
    known = tasks.select("task_id")
    unknown = own.join(known, "task_id", "left_anti").select("source_run_id", "task_id")
    created = (
        own.join(known, "task_id", "left_semi")
        .join(receipts.select("task_id", "source_run_id"), ["task_id", "source_run_id"], "left_anti")
        .select(*RECEIPT_COLUMNS)
    )
    return created, unknown


RECEIPT_COLUMNS = [
    "campaign_contract_version",
    "campaign_id",
    "task_id",
    "source_run_id",
    "origin",
    "recorded_at_utc",
]


def receipts_for_run(plan: CampaignPlan, tasks: DataFrame, run_id: str, origin: str, at: Column):
    """Receipt rows of one executed or adopted run for the given tasks."""
    return tasks.select(
        F.lit(plan.campaign_version).alias("campaign_contract_version"),
        F.lit(plan.campaign_id).alias("campaign_id"),
        "task_id",
        F.lit(run_id).alias("source_run_id"),
        F.lit(origin).alias("origin"),
        at.alias("recorded_at_utc"),
    )


def receipt_collisions(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Keys present on both sides with different content."""
    keys = ["campaign_id", "task_id", "source_run_id"]
    both = existing.alias("e").join(incoming.alias("i"), keys)
    rest = [c for c in RECEIPT_COLUMNS if c not in keys]
    differs = any_of(~F.col(f"e.{c}").eqNullSafe(F.col(f"i.{c}")) for c in rest)
    return both.where(differs).select(*keys)


def invalid_receipts(plan: CampaignPlan, tasks: DataFrame, receipts: DataFrame) -> DataFrame:
    """Receipts of another campaign or contract, or for a task outside the plan."""
    known = tasks.select("task_id", F.lit(True).alias("__known"))
    why = reasons(
        (~holds(F.col("campaign_id") == plan.campaign_id), "campaign_mismatch"),
        (
            ~holds(F.col("campaign_contract_version") == plan.campaign_version),
            "contract_mismatch",
        ),
        (F.col("__known").isNull(), "unknown_task"),
    )
    return (
        receipts.join(known, "task_id", "left")
        .withColumn("reasons", why)
        .where(F.size("reasons") > 0)
        .select("task_id", "source_run_id", "reasons")
    )


# --- attempt assessment ---------------------------------------------------------------


def _source_day_facts(plan: CampaignPlan, rows: DataFrame, as_of) -> DataFrame:
    """Normalized rows compacted to (run, partition, row symbol, date) flag counts."""
    symbol, venue = clean_text(F.col("symbol")), clean_text(F.col("exchange"))
    registered = plan.provenance in REGISTERED
    wrong_units = ~(matches_record(plan.provenance) & F.lit(registered))
    flag = column_or_null(rows, "adjusted_flag").cast("boolean")
    if plan.expected_adjusted_flag is None:
        wrong_flag = flag.isNotNull()
    else:
        wrong_flag = ~flag.eqNullSafe(F.lit(plan.expected_adjusted_flag))
    no_value = any_of(F.col(c).isNull() for c in VALUE_COLUMNS)
    return rows.groupBy(RUN, PART, "symbol", "date").agg(
        F.count(F.lit(1)).alias("n"),
        count_where(daily_row_blocked(as_of)).alias("blocked"),
        count_where(F.col("symbol").isNull()).alias("null_symbol"),
        count_where(F.col("exchange").isNull()).alias("null_exchange"),
        count_where(F.col("symbol").isNotNull() & ~symbol.eqNullSafe(F.upper(PART))).alias(
            "other_symbol"
        ),
        count_where(F.col("exchange").isNotNull() & ~venue.eqNullSafe(F.lit(plan.exchange))).alias(
            "other_exchange"
        ),
        count_where(no_value).alias("missing_value"),
        count_where(wrong_units).alias("wrong_units"),
        count_where(wrong_flag).alias("wrong_flag"),
    )


_DAY_FACTS = [
    "n", "blocked", "null_symbol", "null_exchange", "other_symbol", "other_exchange",
    "missing_value", "wrong_units", "wrong_flag",
]


def _dealt_days(days: DataFrame) -> DataFrame:
    """Day facts dealt by (run, partition) once, for the partition's facts and the tasks'.

    The counts travel as one array: each reader then needs the same columns, so that both read
    the same shuffled rows.
    """
    parts = int(days.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = days.select(RUN, PART, "date", F.array(*_DAY_FACTS).alias("__facts")).repartition(parts, RUN, PART)
    return dealt.select(RUN, PART, "date", *[F.col("__facts")[i].alias(c) for i, c in enumerate(_DAY_FACTS)])


def _partition_facts(days: DataFrame) -> DataFrame:
    def total(c: str) -> Column:
        return F.sum(c).cast("bigint")

    return days.groupBy(RUN, PART).agg(
        total("n").alias("p_rows"),
        (total("blocked") + count_where(F.col("n") > 1)).alias("p_blocked"),
        F.sum(F.when(F.col("date").isNull(), F.col("n")).otherwise(0)).alias("p_undated"),
        total("null_symbol").alias("p_null_symbol"),
        total("null_exchange").alias("p_null_exchange"),
        total("other_symbol").alias("p_other_symbol"),
        total("other_exchange").alias("p_other_exchange"),
        F.min("date").alias("p_first"),
        F.max("date").alias("p_last"),
    )


def _path_facts(rows: DataFrame) -> DataFrame:
    """Distinct stored paths per (run, partition); reads no data columns."""
    paths = rows.groupBy(RUN, PART, "__input_path").agg(F.count(F.lit(1)).alias("n"))
    return paths.groupBy(RUN, PART).agg(F.count(F.lit(1)).alias("path_count"))


def assess_attempts(
    plan: CampaignPlan,
    tasks: DataFrame,
    receipts: DataFrame,
    manifests: DataFrame,
    rows: DataFrame,
    as_of: dt.date | str,
    partition_index: DataFrame | None = None,
) -> DataFrame:
    """Status and reasons of every receipt.

    Rows are compacted to days before they meet tasks, so a run holding most of the data
    costs no more in the range join than its number of calendar days.
    ``partition_index`` (run_id, partition_symbol, path_count, readable, columns_present)
    describes stored partitions when some could not be read as rows.
    """
    days = _dealt_days(_source_day_facts(plan, rows, as_of))
    # Read three times below, written once.
    attempts = staged(
        receipts.select("task_id", "source_run_id", "recorded_at_utc").join(tasks, "task_id")
    )
    bounds = attempts.select(
        "task_id", F.col("source_run_id").alias(RUN), F.col("symbol").alias(PART),
        "start_date", "end_date",
    )
    in_task = (
        bounds.hint("merge").join(days.hint("merge"), [RUN, PART])
        # Tested after the join only: a filter on dates below it would set these days apart from the facts'.
        .where(holds(F.col("date").between(F.col("start_date"), F.col("end_date"))))
        .groupBy(RUN, PART, "task_id")
        .agg(
            F.sum("n").alias("t_rows"),
            F.sum(F.when(~is_weekday(F.col("date")), F.col("n")).otherwise(0)).alias("t_weekend"),
            F.sum("missing_value").alias("t_missing"),
            F.sum("wrong_units").alias("t_wrong_units"),
            F.sum("wrong_flag").alias("t_wrong_flag"),
            (F.sum("blocked") + count_where(F.col("n") > 1)).alias("t_blocked"),
            F.min("date").alias("first_observation_date"),
            F.max("date").alias("last_observation_date"),
        )
    )
    # One row a partition, by task (at most the symbol's tasks): a join on the task too would deal all again.
    facts = [col for col in in_task.columns if col not in (RUN, PART, "task_id")]
    by_task = F.map_from_entries(F.collect_list(F.struct("task_id", F.struct(*facts))))
    in_task = in_task.groupBy(RUN, PART).agg(by_task.alias("__in_task"))
    if partition_index is None:
        index = (
            _path_facts(rows)
            if "__input_path" in rows.columns
            else days.select(RUN, PART).distinct().withColumn("path_count", F.lit(1))
        )
        index = index.withColumns({"readable": F.lit(True), "columns_present": F.lit(True)})
    else:
        index = partition_index
    keyed = attempts.withColumnRenamed("source_run_id", RUN).withColumn(PART, F.col("symbol"))
    # A run may declare every symbol: its attempts meet one symbol each, and never carry the list.
    declared = manifests.select(RUN, F.explode("symbols").alias(PART)).distinct()
    # Facts of runs are taken to be as small as the files they come from, which may pack very well:
    # no side is broadcast.
    joined = (
        keyed.hint("merge").join(_manifest_view(plan, manifests).hint("merge"), RUN, "left")
        .join(declared.withColumn("m_declared", F.lit(True)).hint("merge"), [RUN, PART], "left")
        .join(index.hint("merge"), [RUN, PART], "left")
        .join(_partition_facts(days).hint("merge"), [RUN, PART], "left")
        .join(in_task.hint("merge"), [RUN, PART], "left")
        .withColumn("__facts", F.col("__in_task")[F.col("task_id")])
        .select("*", "__facts.*")
    )
    return _attempt_ladder(plan, joined)


def _manifest_view(plan: CampaignPlan, manifests: DataFrame) -> DataFrame:
    def optional(name: str, kind: str) -> Column:
        return column_or_null(manifests, name, kind).alias(f"m_{name}")

    proof = F.lit(False)
    for name in ("unit_provenance", "declared_unit_provenance"):
        if name in manifests.columns:
            proof = proof | matches_record(plan.provenance, name)
    return manifests.select(
        RUN,
        F.lit(True).alias("m_found"),
        F.coalesce(column_or_null(manifests, "readable", "boolean"), F.lit(True)).alias(
            "m_readable"
        ),
        F.col("command").alias("m_command"),
        F.col("status").alias("m_status"),
        F.col("provider").alias("m_provider"),
        F.col("exchange").alias("m_exchange"),
        F.col("resolution").alias("m_resolution"),
        F.col("start_date").try_cast("date").alias("m_start"),
        F.col("end_date").try_cast("date").alias("m_end"),
        optional("normalized_contract", "string"),
        optional("price_adjustment_semantics", "string"),
        optional("expected_adjusted_flag", "boolean"),
        optional("normalized_row_count", "bigint"),
        optional("chunks_empty", "bigint"),
        optional("allow_empty_success", "boolean"),
        proof.alias("m_units_match"),
    )


def manifest_reasons(plan: CampaignPlan) -> Column:
    """All reasons a manifest does not fit the plan or the task, in fixed order."""
    f = F.col
    dated = f("m_start").isNotNull() & f("m_end").isNotNull()
    contract, adjustment = f("m_normalized_contract"), f("m_price_adjustment_semantics")
    head = (
        (~holds(f("m_provider") == plan.provider), "provider_mismatch"),
        (~holds(f("m_exchange") == plan.exchange), "exchange_mismatch"),
        (holds(f("m_resolution") != plan.source_resolution), "source_resolution_mismatch"),
        (
            ~holds(f("m_declared")),
            "symbol_not_declared_by_source_manifest",
        ),
        (~dated, "manifest_date_range_invalid"),
    )
    tail = (
        (
            holds((f("m_start") > f("start_date")) | (f("m_end") < f("end_date"))),
            "source_range_does_not_cover_task",
        ),
        (holds(contract != plan.normalized_version), "normalized_daily_contract_mismatch"),
        (holds(adjustment != plan.adjustment), "price_adjustment_semantics_mismatch"),
        (~holds(f("m_units_match")), "manifest_unit_provenance_incompatible"),
    )
    # An unreadable date range ends the comparison, so later reasons need a dated manifest.
    return reasons(*head, *[(dated & cond, label) for cond, label in tail])


def _attempt_ladder(plan: CampaignPlan, joined: DataFrame) -> DataFrame:
    f = F.col
    proven_empty = holds(
        (f("m_normalized_row_count") == 0)
        & (f("m_chunks_empty") >= 1)
        & f("m_allow_empty_success")
        & (f("m_normalized_contract") == plan.normalized_version)
        & (f("m_price_adjustment_semantics") == plan.adjustment)
        & f("m_expected_adjusted_flag").eqNullSafe(F.lit(plan.expected_adjusted_flag))
    )
    structure = reasons(
        (f("p_undated") > 0, "source_contains_invalid_dates"),
        (f("p_null_symbol") > 0, "source_contains_null_symbols"),
        (f("p_null_exchange") > 0, "source_contains_null_exchanges"),
        (
            (f("p_other_symbol") > 0) | (f("p_null_symbol") == f("p_rows")),
            "source_symbol_partition_mismatch",
        ),
        (
            (f("p_other_exchange") > 0) | (f("p_null_exchange") == f("p_rows")),
            "source_exchange_rows_mismatch",
        ),
    )
    df = joined.withColumns(
        {
            "__manifest": manifest_reasons(plan),
            "__structure": structure,
            "__stale_days": F.greatest(
                F.datediff("end_date", "last_observation_date"), F.lit(0)
            ),
        }
    )
    paths = F.coalesce(f("path_count"), F.lit(0))
    rows = F.coalesce(f("t_rows"), F.lit(0))

    def fixed(label: str) -> Column:
        return F.array(F.lit(label))

    legacy = F.when(
        f("m_normalized_contract").isNull(), F.lit("legacy_contract_structurally_validated")
    )
    ladder = [
        (holds(~f("m_readable")), "incompatible", fixed("source_manifest_invalid")),
        (f("m_found").isNull(), "incompatible", fixed("source_manifest_missing")),
        (
            ~holds(f("m_command") == BACKFILL_COMMAND),
            "incompatible",
            fixed("source_command_incompatible"),
        ),
        (~holds(f("m_status") == "success"), "failed", fixed("source_run_failed")),
        (F.size("__manifest") > 0, "incompatible", f("__manifest")),
        ((paths == 0) & proven_empty, "empty", fixed("provider_returned_empty_chunk")),
        (paths == 0, "incompatible", fixed("normalized_symbol_source_missing")),
        (paths > 1, "incompatible", fixed("multiple_normalized_paths_for_source_symbol")),
        (~holds(f("readable")), "incompatible", fixed("normalized_daily_source_unreadable")),
        (
            ~holds(f("columns_present")),
            "incompatible",
            fixed("normalized_daily_required_columns_missing"),
        ),
        (f("p_blocked") > 0, "incompatible", fixed("normalized_daily_validation_failed")),
        (F.size("__structure") > 0, "incompatible", f("__structure")),
        (
            holds((f("p_first") < f("m_start")) | (f("p_last") > f("m_end"))),
            "incompatible",
            fixed("source_rows_outside_manifest_range"),
        ),
        (rows == 0, "empty", fixed("successful_source_contains_no_rows_for_chunk")),
        (f("t_weekend") > 0, "incompatible", fixed("weekend_observations_in_daily_source")),
        (f("t_missing") > 0, "incompatible", fixed("missing_ohlcv_values_in_daily_source")),
        (f("t_wrong_units") > 0, "incompatible", fixed("row_unit_provenance_incompatible")),
        (f("t_wrong_flag") > 0, "incompatible", fixed("row_adjustment_semantics_incompatible")),
        (f("t_blocked") > 0, "incompatible", fixed("normalized_daily_validation_failed")),
        (
            f("__stale_days") > plan.stale_after_days,
            "stale",
            fixed("last_observation_stale_for_chunk_end"),
        ),
        (
            F.lit(True),
            "complete",
            F.array_compact(F.array(F.lit("compatible_successful_source"), legacy)),
        ),
    ]
    status = F.coalesce(*[F.when(holds(c), F.lit(s)) for c, s, _ in ladder])
    why = F.coalesce(*[F.when(holds(c), r) for c, _, r in ladder])
    df = df.withColumns({"status": status, "reason_codes": why})
    counted = f("status").isin("complete", "stale")
    return df.select(
        "task_id",
        "symbol",
        "start_date",
        "end_date",
        F.col(RUN).alias("source_run_id"),
        "recorded_at_utc",
        "status",
        "reason_codes",
        F.when(counted, rows).otherwise(F.lit(0)).cast("bigint").alias("observation_count"),
        F.when(counted, f("first_observation_date")).alias("first_observation_date"),
        F.when(counted, f("last_observation_date")).alias("last_observation_date"),
    )


def reduce_attempts(tasks: DataFrame, attempts: DataFrame) -> DataFrame:
    """One assessment per task from all of its attempts (attempts stay a table of their own)."""
    detail = F.struct(
        "source_run_id", "status", "reason_codes", "observation_count",
        "first_observation_date", "last_observation_date",
    )
    usable = F.col("status").isin(RESOLVED_TASK_STATUSES)
    priority = (
        F.when(F.col("status") == "incompatible", 3)
        .when(F.col("status") == "stale", 2)
        .when(F.col("status") == "failed", 1)
        .otherwise(0)
    )
    grouped = attempts.groupBy("task_id").agg(
        F.count(F.lit(1)).alias("attempt_count"),
        F.min(F.when(usable, F.col("source_run_id"))).alias("__first_run"),
        F.max(F.when(usable, F.col("source_run_id"))).alias("__last_run"),
        F.max_by(detail, F.when(usable, F.struct("recorded_at_utc", "source_run_id"))).alias(
            "__usable"
        ),
        F.min_by(
            detail,
            F.when(~usable, F.struct((-priority).alias("p"), "recorded_at_utc", "source_run_id")),
        ).alias("__unresolved"),
    )
    joined = tasks.join(grouped, "task_id", "left")
    conflict = holds(F.col("__first_run") != F.col("__last_run"))
    none = F.col("attempt_count").isNull()
    pick = F.coalesce("__usable", "__unresolved")

    def chosen(name: str) -> Column:
        return F.when(~none & ~conflict, pick[name])

    return joined.select(
        "task_id",
        "symbol",
        "start_date",
        "end_date",
        F.when(none, "pending").when(conflict, "incompatible").otherwise(pick["status"]).alias(
            "status"
        ),
        chosen("source_run_id").alias("selected_run_id"),
        F.coalesce("attempt_count", F.lit(0)).cast("bigint").alias("attempt_count"),
        F.coalesce(chosen("observation_count"), F.lit(0)).cast("bigint").alias(
            "observation_count"
        ),
        chosen("first_observation_date").alias("first_observation_date"),
        chosen("last_observation_date").alias("last_observation_date"),
        F.when(none, F.array(F.lit("no_campaign_receipt")))
        .when(conflict, F.array(F.lit("multiple_compatible_successful_sources_for_task")))
        .otherwise(pick["reason_codes"])
        .alias("reason_codes"),
    )


# --- roll-ups -------------------------------------------------------------------------


def status_counts(df: DataFrame, statuses: list[str], column: str = "status") -> DataFrame:
    """Count per allowed status, zero where a status does not occur."""
    dimension = df.sparkSession.createDataFrame([(s,) for s in statuses], f"{column} string")
    seen = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return dimension.join(seen, column, "left").select(
        column, F.coalesce("n", F.lit(0)).cast("bigint").alias("row_count")
    )


def task_counts(assessments: DataFrame) -> DataFrame:
    return status_counts(assessments, TASK_STATUSES)


def symbol_statuses(assessments: DataFrame) -> DataFrame:
    s = F.col("status")
    resolved = s.isin(RESOLVED_TASK_STATUSES)
    flags = assessments.groupBy("symbol").agg(
        F.bool_and(resolved).alias("all_resolved"),
        F.bool_or(resolved).alias("any_resolved"),
        *[F.bool_or(s == x).alias(x) for x in ("incompatible", "stale", "failed")],
    )
    return flags.select(
        "symbol",
        F.when(F.col("all_resolved"), "complete")
        .when(F.col("incompatible"), "incompatible")
        .when(F.col("stale"), "stale")
        .when(F.col("failed"), "failed")
        .when(F.col("any_resolved"), "partial")
        .otherwise("pending")
        .alias("symbol_status"),
    )


def complete_symbols(assessments: DataFrame) -> DataFrame:
    return symbol_statuses(assessments).where("symbol_status = 'complete'").select("symbol")


def campaign_flags(assessments: DataFrame) -> DataFrame:
    resolved = F.col("status").isin(RESOLVED_TASK_STATUSES)
    return assessments.agg(
        F.coalesce(F.bool_and(resolved), F.lit(True)).alias("campaign_complete"),
        (~F.coalesce(F.bool_or(F.col("status") == "incompatible"), F.lit(False))).alias(
            "assembly_compatible"
        ),
    ).withColumn(
        "assembly_ready", F.col("campaign_complete") & F.col("assembly_compatible")
    )


def resolved_source_runs(assessments: DataFrame) -> DataFrame:
    return (
        assessments.where(F.col("status").isin(RESOLVED_TASK_STATUSES))
        .where("selected_run_id is not null")
        .select("selected_run_id")
        .distinct()
    )


def next_batch(
    assessments: DataFrame,
    max_tasks: int,
    retry_failed: bool = False,
    retry_stale: bool = False,
    retry_incompatible: bool = False,
) -> DataFrame:
    """First eligible tasks in plan order."""
    eligible = ["pending"]
    eligible += ["failed"] if retry_failed else []
    eligible += ["stale"] if retry_stale else []
    eligible += ["incompatible"] if retry_incompatible else []
    return (
        assessments.where(F.col("status").isin(eligible))
        .orderBy("symbol", "start_date")
        .limit(max_tasks)
    )


# --- adoption and source rows ---------------------------------------------------------


def _stretch(day: Column) -> Column:
    """Number of the ``STRETCH_DAYS`` days that a day belongs to."""
    return F.floor(F.unix_date(day) / STRETCH_DAYS).cast("int")


def adoption_report(
    tasks: DataFrame, assessments: DataFrame, manifests: DataFrame
) -> DataFrame:
    """Whether each run could be adopted: containment, chunk alignment, no other source."""
    runs = manifests.select(
        RUN,
        "command",
        "status",
        F.col("start_date").try_cast("date").alias("run_start"),
        F.col("end_date").try_cast("date").alias("run_end"),
        "symbols",
    )
    # A covered task starts inside the run's range: runs meet the tasks of their own stretches of
    # days, cut to the plan's, and not every task of the symbol.
    plan_days = tasks.agg(
        F.struct(F.min("start_date").alias("first"), F.max("start_date").alias("last"))
    ).scalar()
    first = F.greatest("run_start", plan_days["first"])
    last = F.least("run_end", plan_days["last"])
    dated = F.col("run_start").isNotNull() & F.col("run_end").isNotNull() & (first <= last)
    stretches = F.when(dated, F.sequence(_stretch(first), _stretch(last)))
    declared = runs.select(
        RUN, "run_start", "run_end", F.explode("symbols").alias("symbol"), stretches.alias("__stretches")
    ).select(RUN, "run_start", "run_end", "symbol", F.explode_outer("__stretches").alias("__stretch"))
    current = assessments.select(
        "symbol",
        _stretch(F.col("start_date")).alias("__stretch"),
        "start_date",
        "end_date",
        (F.col("status").isin(RESOLVED_TASK_STATUSES)).alias("resolved"),
        "selected_run_id",
    )
    covered = declared.join(current, ["symbol", "__stretch"], "left").withColumn(
        "covers",
        holds(
            (F.col("run_start") <= F.col("start_date")) & (F.col("run_end") >= F.col("end_date"))
        ),
    )
    taken = F.col("covers") & F.col("resolved") & holds(F.col("selected_run_id") != F.col(RUN))
    per_symbol = covered.groupBy(RUN, "symbol", "run_start", "run_end").agg(
        count_where(F.col("covers")).alias("covered"),
        F.min(F.when(F.col("covers"), F.col("start_date"))).alias("first"),
        F.max(F.when(F.col("covers"), F.col("end_date"))).alias("last"),
        count_where(taken).alias("taken"),
    )
    aligned = holds(
        (F.col("first") == F.col("run_start")) & (F.col("last") == F.col("run_end"))
    )
    per_run = per_symbol.groupBy(RUN).agg(
        F.sum("covered").alias("covered_task_count"),
        F.bool_and(aligned).alias("aligned"),
        F.sum("taken").alias("taken_task_count"),
    )
    covered_n = F.coalesce("covered_task_count", F.lit(0)).cast("bigint")
    taken_n = F.coalesce("taken_task_count", F.lit(0)).cast("bigint")
    verdict = (
        F.when(
            ~holds((F.col("command") == BACKFILL_COMMAND) & (F.col("status") == "success")),
            "source_not_successful_backfill",
        )
        .when(F.col("run_start").isNull() | F.col("run_end").isNull(), "source_bounds_invalid")
        .when(covered_n == 0, "covers_no_tasks")
        .when(~holds(F.col("aligned")), "range_not_aligned_to_chunks")
        .when(taken_n > 0, "task_already_resolved_by_other_run")
        .otherwise("adoptable")
    )
    return runs.join(per_run, RUN, "left").select(
        RUN,
        covered_n.alias("covered_task_count"),
        taken_n.alias("taken_task_count"),
        verdict.alias("verdict"),
    )


def source_rows(
    assessments: DataFrame, rows: DataFrame, symbols: DataFrame | None = None
) -> DataFrame:
    """Normalized rows of every completed task, with their run and stored path.

    Equi-join on run and partition; the date range is a residual predicate.  Neither side is
    ever broadcast: the optimizer would go by sizes on disk, which say little of packed rows.
    """
    chosen = assessments.where("status = 'complete' and selected_run_id is not null").select(
        F.col("selected_run_id").alias(RUN),
        F.col("symbol").alias(PART),
        "start_date",
        "end_date",
    )
    if symbols is not None:
        chosen = chosen.join(symbols.select(F.col("symbol").alias(PART)), PART, "left_semi")
    chosen = chosen.hint("merge")
    path = column_or_null(rows, "__input_path")
    picked = rows.withColumn("source_normalized_path", path).join(chosen, [RUN, PART])
    return (
        picked.where(F.col("date").between(F.col("start_date"), F.col("end_date")))
        .withColumnRenamed(RUN, "source_run_id")
        .drop(PART, "start_date", "end_date")
    )


