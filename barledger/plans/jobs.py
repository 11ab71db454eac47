"""User-level jobs: read, normalize, write, audit, commit, record.

Bars are written once; the row checks are counted by the tasks that write them, the other checks
read the written files.  A run becomes visible by its commit row, which is appended only when
nothing blocks.  Every job appends a manifest.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barledger.contracts import (
    ASSEMBLED_VERSION,
    NORMALIZED_DAILY_VERSION,
    PROVIDER,
    NORMALIZED_DAILY_SCHEMA,
    VALUE_COLUMNS,
)
from barledger.functions.digests import multiset_digest
from barledger.functions.exprs import lit_date
from barledger.operators import campaign as camp
from barledger.operators import (
    checks,
    coverage,
    forensics,
    normalize,
    panel,
    profile,
    qualification,
    quality,
    readiness,
    redaction,
    universe,
)
from barledger.operators.campaign import CampaignPlan
from barledger.operators.ordering import duplicate_counts
from barledger.operators.sets import frame_differences, union_all
from barledger.operators.units import UnitProvenance
from barledger.sources.staging import staged
from barledger.sources.store import (
    CORRUPT,
    DAILY,
    INTRADAY,
    LAYOUT,
    RAW_DAILY_SCHEMA,
    RAW_INTRADAY_SCHEMA,
    RAW_UNIVERSE_SCHEMA,
    MarketStore,
    landed_ordinal,
    run_digests,
)

RECEIPTS = (
    "campaign_contract_version string, campaign_id string, task_id string, "
    "source_run_id string, origin string, recorded_at_utc timestamp"
)


@dataclass
class JobResult:
    run_id: str
    status: str
    results: DataFrame
    outputs: list[str] = field(default_factory=list)
    frames: dict[str, DataFrame] = field(default_factory=dict)


def gate_open(results: DataFrame) -> bool:
    """The publish gate: one small aggregate over the check results."""
    return not checks.summarize(results).first()["has_blocking_errors"]


def _now(at: dt.datetime | None) -> dt.datetime:
    return at or dt.datetime.now(dt.UTC).replace(tzinfo=None)


def _stamp(at: dt.datetime) -> Column:
    return F.lit(at.isoformat(sep=" ")).cast("timestamp")


def _finish(store: MarketStore, result: JobResult, command: str, at: dt.datetime, **extra) -> JobResult:
    store.report(result.results, command.replace(" ", "_"), result.run_id)
    store.append_manifest(
        {
            "run_id": result.run_id,
            "command": command,
            "status": result.status,
            "provider": PROVIDER,
            "output_paths": result.outputs,
            "finished_at_utc": at,
            "parameters": json.dumps(extra.pop("parameters", {}), sort_keys=True),
            **extra,
        }
    )
    return result


def _record(value: UnitProvenance | None):
    return tuple(value.by_column().values()) if value else None


def _unreadable(raw: DataFrame, dataset: str) -> DataFrame:
    rule = checks.Rule(
        "raw_rows_readable", checks.ERROR, F.col(CORRUPT).isNotNull(), [CORRUPT]
    )
    return checks.run_checks(raw, dataset, [rule])


# --- ingestion ------------------------------------------------------------------------


def ingest_universe(
    store: MarketStore, run_id: str, exchange: str, at: dt.datetime | None = None
) -> JobResult:
    at = _now(at)
    raw = store.read_raw("universe", RAW_UNIVERSE_SCHEMA, run_id)
    rows = staged(normalize.universe_rows(raw, _stamp(at)))
    results = staged(quality.check_universe(rows, exchange))
    kept = rows.where(F.col("exchange") == exchange.upper())
    outputs = []
    if gate_open(results):
        outputs.append(
            store.publish_snapshot(
                kept, "normalized/universe", run_id, "snapshot_date", _stamp(at).cast("date")
            )
        )
    status = "success" if outputs else "failed"
    return _finish(
        store, JobResult(run_id, status, results, outputs), "data ingest-universe", at,
        exchange=exchange.upper(),
    )


def ingest_daily(
    store: MarketStore,
    run_id: str,
    symbols: list[str],
    start: str,
    end: str,
    exchange: str = "HOSE",
    provenance: UnitProvenance | None = None,
    allow_empty: bool = False,
    requests: DataFrame | None = None,
    as_of: str | None = None,
    at: dt.datetime | None = None,
    campaign: tuple[str, str] | None = None,
) -> JobResult:
    """Landed daily rows to a published run: request checks, row checks, gate, manifest.

    ``requests`` is the request log (succeeded boolean, row_count bigint; one row per request).
    A failed request blocks the run.  A run without rows succeeds only if it may be empty and
    the log proves that every request succeeded without rows; without a log nothing is proven.
    """
    at = _now(at)
    as_of = as_of or at.date().isoformat()
    raw = store.read_raw("daily", RAW_DAILY_SCHEMA, run_id)
    bars = staged(
        normalize.daily_bars(
            raw, _stamp(at), exchange, provenance,
            carry=["request_start_date", "request_end_date", CORRUPT],
        )
    )
    asked = camp.request_checks(
        bars.withColumns(
            {
                "request_start_date": F.col("request_start_date").try_cast("date"),
                "request_end_date": F.col("request_end_date").try_cast("date"),
            }
        )
    )
    rows = bars.drop("request_start_date", "request_end_date", CORRUPT)
    request_rules = [
        checks.Rule("request_not_truncated", checks.ERROR, F.col("possibly_truncated"), ["symbol"]),
        checks.Rule(
            "rows_inside_requested_chunk", checks.ERROR, F.col("outside_row_count") > 0, ["symbol"]
        ),
    ]
    rules = quality.daily_row_rules(as_of)
    written = store.stage_run(rows, DAILY, run_id, *LAYOUT[DAILY], checks.rule_metrics(rules))
    count = written["row_count"]
    if count:
        rows = store.staged_rows(DAILY, run_id, rows.schema)
    log = store.spark.createDataFrame([], camp.REQUEST_LOG) if requests is None else requests
    proof = staged(camp.empty_run_allowed(log, allow_empty))
    proven = proof.first()
    empty_is_complete = bool(proven["empty_is_complete"] and proven["request_count"])
    total = store.spark.range(1).select(F.lit(count).alias("n"))
    no_rows = checks.fact_check(
        total, "daily", "daily_observations_available",
        checks.INFO if empty_is_complete else checks.ERROR, F.col("n") == 0,
        message="The provider returned no daily observations.",
    )
    failed_requests = checks.fact_check(
        proof, "daily", "daily_requests_succeeded", checks.ERROR,
        F.col("succeeded_count") < F.col("request_count"),
        message="At least one request of the run failed.",
    )
    results = staged(
        union_all(
            [
                _unreadable(bars, "daily"),
                checks.run_checks(asked, "daily", request_rules, ["symbol"]),
                quality.check_daily(rows, as_of, counts=written),
                no_rows,
                failed_requests,
            ]
        )
    )
    open_ = gate_open(results)
    outputs = [store.raw_path("daily", run_id)]
    if open_ and count:
        store.commit(DAILY, run_id, count, at)
        outputs.append(store.run_path(DAILY, run_id))
    campaign_id, task_id = campaign or (None, None)
    return _finish(
        store, JobResult(run_id, "success" if open_ else "failed", results, outputs),
        camp.BACKFILL_COMMAND, at,
        exchange=exchange, resolution="1D", symbols=symbols, start_date=start, end_date=end,
        normalized_contract=NORMALIZED_DAILY_VERSION,
        price_adjustment_semantics=camp.UNKNOWN_ADJUSTMENT, normalized_row_count=count,
        chunks_empty=proven["empty_count"], allow_empty_success=allow_empty,
        row_counts={"normalized": count}, unit_provenance=_record(provenance),
        campaign_id=campaign_id, campaign_task_id=task_id,
    )


def ingest_intraday(
    store: MarketStore, run_id: str, exchange: str | None = None, at: dt.datetime | None = None
) -> JobResult:
    at = _now(at)
    raw = store.read_raw("intraday", RAW_INTRADAY_SCHEMA, run_id)
    rows = normalize.intraday_bars(raw, _stamp(at), exchange=exchange)
    rules = quality.intraday_row_rules(rows)
    written = store.stage_run(rows, INTRADAY, run_id, *LAYOUT[INTRADAY], checks.rule_metrics(rules))
    if written["row_count"]:
        rows = store.staged_rows(INTRADAY, run_id, rows.schema)
    results = staged(quality.check_intraday(rows, counts=written))
    outputs = []
    if gate_open(results):
        store.commit(INTRADAY, run_id, written["row_count"], at)
        outputs.append(store.run_path(INTRADAY, run_id))
    status = "success" if outputs else "failed"
    return _finish(store, JobResult(run_id, status, results, outputs), "data ingest-intraday", at)


def ingest_quotes(
    store: MarketStore, run_id: str, requested: DataFrame, schema: str, at: dt.datetime | None = None
) -> JobResult:
    """Quotes; declare ``time`` as VARIANT in ``schema`` to tell numbers from text."""
    at = _now(at)
    raw = store.read_raw("quotes", schema, run_id)
    rows = staged(normalize.quote_snapshot(raw, _stamp(at)))
    results = staged(quality.check_quotes(rows, requested))
    outputs = []
    if gate_open(results):
        outputs.append(
            store.publish_snapshot(
                rows, "normalized/quotes", run_id, "snapshot_date", _stamp(at).cast("date")
            )
        )
    status = "success" if outputs else "failed"
    return _finish(store, JobResult(run_id, status, results, outputs), "data ingest-quotes", at)


# --- feature inputs -------------------------------------------------------------------


def prepare_universe(
    store: MarketStore,
    run_id: str,
    exchange: str,
    snapshot_date: str | None = None,
    reference: str | None = None,
    liquidity_config: panel.LiquidityConfig | None = None,
    liquidity_reference: str | None = None,
    daily_runs: list[str] | None = None,
    at: dt.datetime | None = None,
) -> JobResult:
    """Newest snapshot to research universe, optionally screened by liquidity."""
    at = _now(at)
    snapshot = staged(universe.latest_snapshot(store.read("normalized/universe"), snapshot_date))
    observed = snapshot.agg(F.max("snapshot_timestamp_utc").cast("date").alias("d")).first()["d"]
    if observed is None:
        empty = snapshot.agg(F.count(F.lit(1)).alias("n"))
        results = checks.fact_check(
            empty, "research_universe", "requested_snapshot_available", checks.ERROR, F.lit(True)
        )
        return _finish(
            store, JobResult(run_id, "failed", results), "data prepare-universe", at
        )
    prepared = staged(
        universe.research_universe(snapshot.drop("__input_path", "run_id"), exchange, reference)
    )
    expected = snapshot.agg(F.count(F.lit(1))).scalar()
    parts = [quality.check_research_universe(prepared, expected)]
    outputs: list[str] = []
    final = prepared
    screen_reference = liquidity_reference or reference or observed.isoformat()
    if liquidity_config is not None:
        if screen_reference > observed.isoformat():
            raise ValueError("The liquidity reference must not be after the snapshot date.")
        symbols = universe.included_symbols(prepared)
        daily = store.read_daily(daily_runs)
        start = panel.liquidity_window(screen_reference, liquidity_config)
        selected = panel.select_window(daily, start, screen_reference, symbols)
        window = snapshot.sparkSession.range(1).select(start.cast("string").alias("d")).first()["d"]
        built = staged(panel.daily_panel(daily, window, screen_reference, symbols))
        panel_results = staged(
            quality.check_daily_panel(built, selected.agg(F.count(F.lit(1))).scalar())
        )
        parts.append(panel_results)
        if gate_open(panel_results):
            screened = staged(
                panel.liquidity(built, symbols, screen_reference, liquidity_config)
            )
            liquidity_results = staged(quality.check_liquidity(screened))
            parts.append(liquidity_results)
            if gate_open(liquidity_results):
                final = universe.apply_liquidity(prepared, screened)
                outputs.append(
                    store.publish_snapshot(
                        screened, "features/liquidity", run_id, "reference_date",
                        lit_date(screen_reference),
                    )
                )
    results = staged(union_all(parts))
    open_ = gate_open(results)
    if open_:
        outputs.append(
            store.publish_snapshot(
                final, "features/universe", run_id, "snapshot_date", F.lit(observed.isoformat())
            )
        )
    return _finish(
        store, JobResult(run_id, "success" if open_ else "failed", results, outputs),
        "data prepare-universe", at, exchange=exchange.upper(),
    )


def build_panel(
    store: MarketStore,
    run_id: str,
    start: str,
    end: str,
    symbols: DataFrame | None = None,
    daily_runs: list[str] | None = None,
    at: dt.datetime | None = None,
) -> JobResult:
    """Daily panel and availability; availability is published even if the panel is blocked."""
    at = _now(at)
    daily = store.read_daily(daily_runs)
    built = staged(panel.daily_panel(daily, start, end, symbols))
    asked = symbols if symbols is not None else daily.select("symbol").distinct()
    available = staged(panel.availability(daily, asked, start, end))
    selected = panel.select_window(daily, start, end, symbols)
    panel_results = quality.check_daily_panel(built, selected.agg(F.count(F.lit(1))).scalar())
    empty = checks.fact_check(
        built.agg(F.count(F.lit(1)).alias("n")), "daily_panel", "daily_observations_available",
        checks.ERROR, F.col("n") == 0,
    )
    available_results = staged(quality.check_availability(available))
    results = staged(union_all([panel_results, empty, available_results]))
    outputs = []
    if gate_open(available_results):
        outputs.append(store.publish(available, "features/availability", run_id, []))
    open_ = gate_open(results)
    if open_:
        outputs.append(store.publish(built, "features/daily_panel", run_id, [], ["symbol", "date"]))
    return _finish(
        store, JobResult(run_id, "success" if open_ else "failed", results, outputs),
        "data build-daily-panel", at, start_date=start, end_date=end,
    )


def audit_run_coverage(
    store: MarketStore,
    run_id: str,
    daily_run_id: str,
    exchange: str,
    config: coverage.CoverageConfig = coverage.CoverageConfig(),
    snapshot_date: str | None = None,
    at: dt.datetime | None = None,
) -> JobResult:
    """Coverage of exactly one daily run against the newest universe snapshot."""
    at = _now(at)
    manifest = store.manifests().where(F.col("run_id") == daily_run_id).limit(2).collect()
    if len(manifest) > 1:
        raise ValueError(f"Run {daily_run_id} has more than one manifest.")
    spark = store.spark
    if not manifest or manifest[0]["status"] != "success":
        name = "daily_source_run_complete" if manifest else "daily_source_manifest_available"
        results = checks.fact_check(
            spark.range(1), "daily_coverage", name, checks.ERROR, F.lit(True)
        )
        return _finish(store, JobResult(run_id, "failed", results), "data audit-daily-coverage", at)
    run = manifest[0]
    snapshot = universe.latest_snapshot(store.read("normalized/universe"), snapshot_date)
    prepared = staged(universe.research_universe(snapshot, exchange))
    candidates = universe.included_symbols(prepared)
    requested = store.manifests().where(F.col("run_id") == daily_run_id).select(
        F.explode("symbols").alias("symbol")
    )
    daily = store.read_daily([daily_run_id])
    observed = prepared.agg(
        F.max("source_snapshot_observed_at_utc").cast("date").cast("string").alias("d")
    ).first()["d"]
    scope = (run["start_date"], run["end_date"])
    audited = staged(
        coverage.audit_coverage(
            daily, candidates, requested, observed, daily_run_id, *scope, config
        )
    )
    expected = coverage.coverage_symbol_count(daily, candidates, requested, *scope)
    results = staged(quality.check_coverage(audited, expected.scalar()))
    outputs = []
    if gate_open(results):
        outputs.append(
            store.publish_snapshot(
                audited, "features/daily_coverage", run_id, "snapshot_date", F.lit(observed)
            )
        )
        store.report(coverage.summarize_coverage(audited), "coverage_summary", run_id)
    return _finish(
        store,
        JobResult(run_id, "success" if outputs else "failed", results, outputs,
                  {"coverage": audited}),
        "data audit-daily-coverage", at,
    )


# --- campaigns ------------------------------------------------------------------------


def stored_plan(store: MarketStore, campaign_id: str) -> dict[str, object] | None:
    """The stored row of a plan, None without one; two rows of one campaign are refused."""
    plans = store.table_or("plans", camp.PLAN_SCHEMA, declared=True)
    rows = plans.where(F.col("campaign_id") == campaign_id).limit(2).collect()
    if len(rows) > 1:
        raise ValueError(f"Campaign {campaign_id} has more than one plan.")
    return rows[0].asDict() if rows else None


def load_plan(store: MarketStore, campaign_id: str) -> CampaignPlan:
    """A plan read back from the store; unknown contract versions are refused."""
    row = stored_plan(store, campaign_id)
    if row is None:
        raise ValueError(f"There is no campaign {campaign_id}.")
    return camp.plan_of(row)


def init_campaign(store: MarketStore, plan: CampaignPlan, symbols: DataFrame) -> JobResult:
    """Write a plan once: its typed row and its tasks, after its invariants hold.

    Anything under a known campaign id is refused, with the fields in which it differs.
    """
    symbols = staged(symbols.select("symbol"))
    digest = symbols.agg(multiset_digest(F.col("symbol")).alias("d")).first()["d"]
    values = camp.plan_values(plan, digest)
    known = stored_plan(store, plan.campaign_id)
    if known is not None:
        moved = sorted(k for k in values if values[k] != known[k])
        how = f"differs in {', '.join(moved)}" if moved else "already exists"
        raise ValueError(f"Campaign {plan.campaign_id} is immutable; the given plan {how}.")
    tasks = staged(camp.campaign_tasks(plan, symbols))
    results = staged(camp.check_plan(plan, symbols, tasks))
    open_ = gate_open(results)
    if open_:
        store.append(tasks.withColumn("campaign_id", F.lit(plan.campaign_id)), "tasks", ["campaign_id"])
        # The plan's row comes last: tasks without one are what a killed job has left.
        store.append(store.spark.createDataFrame([tuple(values.values())], camp.PLAN_SCHEMA), "plans")
    return JobResult(plan.campaign_id, "success" if open_ else "failed", results, [], {"tasks": tasks})


def init_campaign_from_snapshot(
    store: MarketStore,
    campaign_id: str,
    exchange: str,
    start: str,
    end: str,
    chunk_days: int,
    snapshot_date: str | None = None,
    **fields,
) -> JobResult:
    """Plan the included candidates of the newest universe snapshot (of ``snapshot_date``)."""
    snapshot = universe.latest_snapshot(store.read("normalized/universe"), snapshot_date)
    prepared = staged(universe.research_universe(snapshot.drop("__input_path", "run_id"), exchange))
    observed = prepared.agg(F.max("source_snapshot_observed_at_utc").cast("date").alias("d")).first()["d"]
    if observed is None:
        raise ValueError("There is no universe snapshot to plan from.")
    plan = CampaignPlan(
        campaign_id, start, end, chunk_days, observed.isoformat(), exchange=exchange.upper(), **fields
    )
    return init_campaign(store, plan, universe.included_symbols(prepared))


ATTEMPTS = (
    "campaign_id string, task_id string, source_run_id string, manifest_digest string, as_of date, "
    "status string, reason_codes array<string>, observation_count bigint, "
    "first_observation_date date, last_observation_date date"
)
_EVIDENCE = ["task_id", "source_run_id", "manifest_digest"]


def campaign_tables(store: MarketStore, plan: CampaignPlan) -> tuple[DataFrame, DataFrame]:
    """(tasks, receipts) of a campaign."""
    mine = F.col("campaign_id") == plan.campaign_id
    tasks = store.table("tasks").where(mine).drop("campaign_id")
    return tasks, store.table_or("receipts", RECEIPTS, declared=True).where(mine)


def campaign_rows(store: MarketStore, receipts: DataFrame) -> DataFrame:
    """Committed daily rows of the receipts' runs; the partitions of other runs are pruned."""
    runs = receipts.select(F.col("source_run_id").alias("run_id"))
    if not store.has_runs(DAILY):
        schema = f"{NORMALIZED_DAILY_SCHEMA}, run_id string, __input_path string"
        return store.spark.createDataFrame([], schema).withColumn("partition_symbol", F.col("symbol"))
    return store.read_daily(runs=runs).withColumn("partition_symbol", F.col("symbol"))


def manifest_digests(manifests: DataFrame) -> DataFrame:
    """One digest per run over all fields of its manifest."""
    line = F.sha2(F.to_json(F.struct(*sorted(manifests.columns)), {"ignoreNullFields": "false"}), 256)
    return manifests.groupBy(F.col("run_id").alias("source_run_id")).agg(F.max(line).alias("manifest_digest"))


def assess_campaign(
    store: MarketStore, plan: CampaignPlan, as_of: str, everything: bool = False
) -> dict[str, DataFrame]:
    """Reconcile receipts with manifests, assess new attempts, reduce all to tasks.

    A committed run never changes, so an attempt is judged once for each (task, run, manifest
    digest) and kept; only attempts without a kept judgement read stored rows.  A judgement
    holds for its day and later ones, except where rows were blocked: whether a date lies in
    the future depends on the day, so these are judged again, and so is anything judged for a
    later day than ``as_of``.  ``everything`` judges all attempts anew.
    """
    tasks, receipts = campaign_tables(store, plan)
    manifests = store.manifests()
    created, unknown = camp.new_receipts(plan, tasks, receipts, manifests)
    if not unknown.isEmpty():
        raise ValueError("A campaign manifest names an unknown task.")
    if not camp.invalid_receipts(plan, tasks, receipts).isEmpty():
        raise ValueError("The campaign has invalid receipts.")
    created = staged(created)
    if not created.isEmpty():
        store.append(created, "receipts")
    digests = manifest_digests(manifests)
    current = staged(
        receipts.unionByName(created).join(digests, "source_run_id", "left").withColumn(
            "manifest_digest", F.coalesce("manifest_digest", F.lit(""))
        )
    )
    blocked = F.array_contains("reason_codes", "normalized_daily_validation_failed")
    kept = store.table_or("attempts", ATTEMPTS, declared=True).where(
        (F.col("campaign_id") == plan.campaign_id)
        & (F.col("as_of") <= lit_date(as_of))
        & ~F.coalesce(blocked, F.lit(False))
        & F.lit(not everything)
    )
    judgement = ["status", "reason_codes", "observation_count", "first_observation_date", "last_observation_date"]
    kept = kept.groupBy(*_EVIDENCE).agg(F.max_by(F.struct(*judgement), "as_of").alias("j"))
    known = current.join(kept, _EVIDENCE).join(tasks, "task_id")
    todo = staged(current.join(kept, _EVIDENCE, "left_anti"))
    judged = camp.assess_attempts(plan, tasks, todo, manifests, campaign_rows(store, todo), as_of)
    judged = staged(judged.join(todo.select(*_EVIDENCE), ["task_id", "source_run_id"]))
    if not judged.isEmpty():
        store.append(
            judged.select(
                F.lit(plan.campaign_id).alias("campaign_id"), *_EVIDENCE, lit_date(as_of).alias("as_of"), *judgement
            ),
            "attempts",
        )
    columns = ["task_id", "symbol", "start_date", "end_date", "source_run_id", "recorded_at_utc", *judgement]
    attempts = staged(known.select("*", "j.*").select(*columns).unionByName(judged.select(*columns)))
    state = staged(camp.reduce_attempts(tasks, attempts))
    return {
        "attempts": attempts, "judged": judged, "assessments": state, "tasks": tasks,
        "rows": campaign_rows(store, current),
    }


def campaign_status(
    store: MarketStore, plan: CampaignPlan, as_of: str, max_tasks: int, **retry: bool
) -> dict[str, DataFrame]:
    """Campaign flags, the readiness that still holds, and the next tasks to fetch.

    A stored readiness stays attached only while the evidence has the digest it was made from.
    """
    frames = assess_campaign(store, plan, as_of)
    state = frames["assessments"]
    ready = store.table("readiness").where(F.col("campaign_id") == plan.campaign_id) if store.exists("tables/readiness") else None
    published = None
    if store.exists("tables/assembled_datasets"):
        published = store.table("assembled_datasets").where(F.col("campaign_id") == plan.campaign_id)
    flags = readiness.campaign_state(
        state, readiness.evidence_digest(plan, state), ready, published,
        readiness.assembled_dataset_id(plan, state),
    )
    return {**frames, "state": flags, "next": camp.next_batch(state, max_tasks, **retry)}


def adopt_run(
    store: MarketStore, plan: CampaignPlan, run_id: str, as_of: str, at: dt.datetime | None = None
) -> DataFrame:
    """Record receipts for the tasks a run covers, if it may be adopted."""
    frames = assess_campaign(store, plan, as_of)
    manifest = store.manifests().where(F.col("run_id") == run_id)
    report = camp.adoption_report(frames["tasks"], frames["assessments"], manifest)
    row = report.first()
    if row is None or row["verdict"] != "adoptable":
        raise ValueError(f"Run {run_id} cannot be adopted: {row and row['verdict']}.")
    bounds = manifest.select(
        F.explode("symbols").alias("symbol"),
        F.col("start_date").try_cast("date").alias("s"),
        F.col("end_date").try_cast("date").alias("e"),
    )
    covered = frames["assessments"].join(bounds, "symbol").where(
        "s <= start_date and e >= end_date and status not in ('complete', 'empty')"
    )
    receipts = camp.receipts_for_run(plan, covered, run_id, "adopted_run", _stamp(_now(at)))
    store.append(receipts, "receipts")
    return assess_campaign(store, plan, as_of)["assessments"]


def audit_campaign(
    store: MarketStore,
    plan: CampaignPlan,
    symbols: DataFrame,
    as_of: str,
    config: coverage.CoverageConfig = coverage.CoverageConfig(),
    policy: readiness.ReadinessPolicy = readiness.ReadinessPolicy(),
) -> dict[str, DataFrame]:
    """Coverage of complete symbols, readiness and the audit summary; readiness is stored."""
    frames = assess_campaign(store, plan, as_of)
    state = frames["assessments"]
    rows = staged(
        camp.source_rows(state, frames["rows"], camp.complete_symbols(state))
    )
    audited = staged(readiness.campaign_coverage(plan, symbols, state, rows, config))
    ready = staged(readiness.readiness(plan, symbols, state, audited, rows, policy))
    digest = readiness.evidence_digest(plan, state).scalar()
    store.append(
        ready.withColumns({"campaign_id": F.lit(plan.campaign_id), "evidence_digest": digest}), "readiness"
    )
    summary = readiness.audit_summary(plan, symbols, state, audited, rows, policy)
    return {**frames, "coverage": audited, "readiness": ready, "summary": summary, "source": rows}


def assemble_campaign(store: MarketStore, plan: CampaignPlan, symbols: DataFrame, as_of: str) -> str:
    """Publish the versioned dataset of a fully resolved campaign; return its id.

    A dataset that already exists must equal its deterministic source.
    """
    frames = assess_campaign(store, plan, as_of)
    state = frames["assessments"]
    if not camp.campaign_flags(state).first()["assembly_ready"]:
        raise ValueError(f"Campaign {plan.campaign_id} has unresolved tasks; assembly refused.")
    rows = staged(camp.source_rows(state, frames["rows"]))
    if not rows.limit(1).count():
        raise ValueError("The resolved campaign contains no daily observations.")
    if duplicate_counts(rows, ["symbol", "date"]).first()["duplicate_count"]:
        raise ValueError("Campaign sources overlap on symbol/date; assembly refused.")
    built = staged(readiness.assemble(plan, state, rows, symbols))
    expected = rows.agg(F.count(F.lit(1))).scalar()
    dataset_id = readiness.assembled_dataset_id(plan, state).first()["assembled_dataset_id"]
    results = union_all(
        [
            quality.check_daily_panel(built, expected),
            quality.check_assembled(built, expected, plan.campaign_id, dataset_id),
        ]
    )
    if not gate_open(results):
        raise ValueError("Assembled daily validation failed; nothing was published.")
    path = f"assembled/campaign_id={plan.campaign_id}/assembled_dataset_id={dataset_id}"
    facts = built.agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("symbol").alias("symbol_count")
    ).withColumns(
        {
            "campaign_id": F.lit(plan.campaign_id),
            "assembled_dataset_id": F.lit(dataset_id),
            "assembly_contract_version": F.lit(ASSEMBLED_VERSION),
        }
    )
    body = built.drop("campaign_id", "assembled_dataset_id")
    if store.exists(path):
        stored = store.spark.read.parquet(store.dataset_path(path)).select(*body.columns)
        same = frame_differences(body, stored).first()["equal"]
        known = store.table("assembled_datasets")
        missing = facts.join(known, facts.columns, "left_anti").limit(1).count()
        if not same or missing:
            raise ValueError("The existing assembled dataset differs from its source.")
    else:
        body.hint("rebalance", "symbol").sortWithinPartitions("symbol", "date").write.mode(
            "errorifexists"
        ).partitionBy("symbol").parquet(store.dataset_path(path))
        store.append(facts, "assembled_datasets")
    return dataset_id


# --- forensics, qualification, profiles -----------------------------------------------


def forensic_audit(
    store: MarketStore, plan: CampaignPlan, run_id: str, as_of: str
) -> dict[str, DataFrame]:
    """Classify every failed and stale task from landed and published rows.

    Only runs concerned are read: those of unresolved tasks, and those of the same symbols' other
    tasks, where a stale tail may resume.  Landed lines keep their ordinal; a run with lines that
    cannot be parsed counts as unreadable evidence.
    """
    frames = assess_campaign(store, plan, as_of)
    state = frames["assessments"]
    unresolved = forensics.unresolved_tasks(state)
    own = staged(unresolved.select(F.col("selected_run_id").alias("run_id")).where("run_id is not null").distinct())
    near = state.join(unresolved.select("symbol").distinct(), "symbol", "left_semi")
    near = staged(near.select(F.col("selected_run_id").alias("run_id")).where("run_id is not null").distinct())
    landed = landed_ordinal(store.read_raw("daily", RAW_DAILY_SCHEMA), near)
    raw = staged(
        normalize.daily_bars(
            landed, F.lit(None).cast("timestamp"), plan.exchange, plan.provenance, carry=["run_id", "position", CORRUPT],
        )
    )
    torn = raw.where(F.col(CORRUPT).isNotNull()).select("run_id").distinct()
    raw = raw.drop(CORRUPT)
    stored = frames["rows"].withColumn("position", F.monotonically_increasing_id())
    manifests = store.manifests().withColumn("readable", F.lit(True))
    records = forensics.forensic_records(plan.end, state, manifests, raw, raw, stored, torn)
    committed = own.join(store.run_ids(DAILY), "run_id", "left_semi")
    artifacts = union_all(
        [
            run_digests(store.spark, f"{store.root}/raw/dataset=daily", "raw", "*.json", own),
            run_digests(store.spark, store.dataset_path(DAILY), "normalized", "*.parquet", committed),
        ]
    )
    records = staged(forensics.attach_artifacts(records, artifacts))
    summary = forensics.forensic_summary(records)
    expected = unresolved.agg(F.count(F.lit(1))).scalar()
    facts = summary.withColumn("expected", expected)
    results = union_all(
        [
            checks.fact_check(
                facts, "campaign_forensics", name,
                F.when(fails, checks.ERROR).otherwise(checks.INFO), F.lit(True), affected,
            )
            for name, fails, affected in (
                (
                    "all_failed_and_stale_tasks_classified",
                    F.col("classified_task_count") != F.col("expected"),
                    F.abs(F.col("classified_task_count") - F.col("expected")),
                ),
                (
                    "required_local_evidence_available",
                    F.col("tasks_missing_required_local_evidence") > 0,
                    F.col("tasks_missing_required_local_evidence"),
                ),
                (
                    "code_defects_resolved",
                    F.col("tasks_requiring_code_fix") > 0,
                    F.col("tasks_requiring_code_fix"),
                ),
            )
        ]
    )
    store.report(records, "forensic_records", run_id)
    store.report(summary, "forensic_summary", run_id)
    return {"records": records, "summary": summary, "results": results}


def qualify_source(
    probes: DataFrame,
    responses: DataFrame,
    base: DataFrame,
    as_of: str,
    record: UnitProvenance,
    position: str = "position",
    ties: list[str] = (),
) -> dict[str, DataFrame]:
    """Inspect probe responses, compare them with the base source, derive the verdict.

    ``responses`` and ``base`` are normalized rows; ``responses`` carries probe_id and the
    landed ordinal, ``base`` is matched to probes by symbol and window.
    """
    window = probes.select("probe_id", "symbol", "start_date", "end_date")
    keep = ["probe_id", "symbol", "date", *VALUE_COLUMNS]
    inside = F.col("date").between(F.col("start_date"), F.col("end_date"))
    ours = base.join(window, "symbol").where(inside).select(*keep)
    theirs = responses.join(window, ["probe_id", "symbol"]).where(inside).select(*keep)
    inspected = staged(
        qualification.inspect_responses(probes, responses, position, as_of, ties)
    )
    compared = staged(qualification.compare_sources(probes, ours, theirs))
    groups = qualification.determinism(inspected)
    row = staged(
        qualification.verdict(
            qualification.criteria(
                inspected, compared, groups, qualification.unit_contract_registered(record)
            )
        )
    )
    return {
        "inspected": inspected,
        "comparisons": compared,
        "differences": qualification.top_differences(ours, theirs),
        "determinism": groups,
        "verdict": row,
        "accounting": qualification.comparison_accounting(compared),
        "failures": qualification.failure_rows(inspected, compared, row),
        "checks": qualification.expectation_checks(inspected),
        "units": qualification.unit_decision(responses),
    }


def profile_landed(frames: dict[str, DataFrame], required: dict[str, list[str]]) -> DataFrame:
    """Profiles of several landed frames, one row each, with their capability status."""
    rows = [
        profile.profile(df, required.get(name, [])).withColumn("capability_name", F.lit(name))
        for name, df in frames.items()
    ]
    status = F.when(F.col("error_category") == "NONE", "VERIFIED").otherwise(
        redaction.category_status(F.col("error_category"))
    )
    return union_all(rows).withColumn("status", status)


# --- stored data ----------------------------------------------------------------------


def validate_stored(
    store: MarketStore, as_of: str, requested_quotes: DataFrame | None = None
) -> DataFrame:
    """Checks over everything that was published."""
    parts = []
    if store.has_runs("normalized/daily"):
        parts.append(quality.check_daily(store.read_daily(), as_of))
    if store.has_runs("normalized/intraday"):
        parts.append(quality.check_intraday(store.read("normalized/intraday")))
    if store.has_runs("normalized/quotes"):
        quotes = store.read("normalized/quotes")
        asked = requested_quotes if requested_quotes is not None else quotes.select("symbol")
        parts.append(quality.check_quotes(quotes, asked))
    if not parts:
        return checks.fact_check(
            store.spark.range(1), "stored_data", "no_normalized_data", checks.INFO, F.lit(True)
        )
    return union_all(parts)
