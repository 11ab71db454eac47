import datetime as dt
import re
from pathlib import Path

import pytest
from helpers import KBS, daily, flat_bars, names, stamp, symbols
from pyspark.sql import functions as F

from barledger.operators import campaign as c
from barledger.operators import coverage, readiness
from barledger.plans import jobs
from barledger.sources.store import MarketStore

PLAN = c.CampaignPlan("camp-a", "2026-06-22", "2026-07-03", 7, "2026-07-04", stale_after_days=3)
AS_OF = "2026-07-04"
CHUNKS = [("2026-06-22", "2026-06-28"), ("2026-06-29", "2026-07-03")]
DAYS = {
    0: ["2026-06-22", "2026-06-23", "2026-06-24", "2026-06-25", "2026-06-26"],
    1: ["2026-06-29", "2026-06-30", "2026-07-01", "2026-07-02", "2026-07-03"],
}


def task(symbol, i):
    return f"{symbol}__{CHUNKS[i][0]}__{CHUNKS[i][1]}"


def test_date_chunks(spark):
    got = c.date_chunks(spark, "2020-01-01", "2026-08-04", 730).orderBy("start_date").collect()
    assert len(got) == 4 and got[-1].end_date == dt.date(2026, 8, 4)
    for a, b in zip(got, got[1:], strict=False):
        assert b.start_date == a.end_date + dt.timedelta(days=1)
    with pytest.raises(ValueError):
        c.date_chunks(spark, "2020-01-01", "2026-08-04", 1096)
    with pytest.raises(ValueError):
        c.date_chunks(spark, "2020-01-02", "2020-01-01", 5)


def test_plan_guards():
    for bad in (
        {"campaign_id": "X"},
        {"end": "2026-07-05"},
        {"data_backend": "vci"},
        {"expected_adjusted_flag": True},
        {"campaign_version": "v0"},
        {"chunk_days": 0},
    ):
        with pytest.raises(ValueError):
            c.CampaignPlan(**{**{f: getattr(PLAN, f) for f in PLAN.__dataclass_fields__}, **bad})


def test_plan_invariants(spark):
    asked = symbols(spark, ["FPT", "HPG"])
    tasks = c.campaign_tasks(PLAN, asked)
    assert tasks.count() == 4 and c.check_plan(PLAN, asked, tasks).count() == 0
    found = names(c.check_plan(PLAN, symbols(spark, ["FPT", "hpg "]), tasks))
    assert {"symbol_normalized", "task_symbol_in_universe", "symbol_has_tasks"} <= set(found)


@pytest.fixture
def store(spark, tmp_path):
    s = MarketStore(spark, str(tmp_path / "store"))
    assert jobs.init_campaign(s, PLAN, symbols(spark, ["FPT", "HPG"])).status == "success"
    return s


def run(store, run_id, symbol, i, days, at="2026-07-04T01:00:00", empty=False, **extra):
    """Land and ingest one campaign task."""
    raw = flat_bars(store.spark, [(symbol, d, 10.0, 5) for d in days])
    tags = {"request_start_date": F.lit(CHUNKS[i][0]), "request_end_date": F.lit(CHUNKS[i][1])}
    store.land(raw, "daily", run_id, tags)
    log = store.spark.createDataFrame([(True, len(days))], c.REQUEST_LOG)
    return jobs.ingest_daily(
        store, run_id, [symbol], *CHUNKS[i], provenance=KBS, allow_empty=empty, requests=log, as_of=AS_OF,
        at=dt.datetime.fromisoformat(at), campaign=("camp-a", task(symbol, i)), **extra,
    )


def complete(store):
    for i in (0, 1):
        assert run(store, f"fpt-{i}", "FPT", i, DAYS[i]).status == "success"
        assert run(store, f"hpg-{i}", "HPG", i, [], empty=True).status == "success"


def test_campaign_end_to_end(spark, store):
    asked = symbols(spark, ["FPT", "HPG"])
    with pytest.raises(ValueError, match="immutable"):
        jobs.init_campaign(store, PLAN, asked)
    run(store, "fpt-0", "FPT", 0, DAYS[0])
    state = jobs.assess_campaign(store, PLAN, AS_OF)["assessments"]
    assert {r.status: r.row_count for r in c.task_counts(state).collect()}["pending"] == 3
    batch = c.next_batch(state, 2).collect()
    assert [b.task_id for b in batch] == [task("FPT", 1), task("HPG", 0)]
    with pytest.raises(ValueError, match="unresolved"):
        jobs.assemble_campaign(store, PLAN, asked, AS_OF)
    run(store, "fpt-1", "FPT", 1, DAYS[1])
    for i in (0, 1):
        run(store, f"hpg-{i}", "HPG", i, [], empty=True)
    out = jobs.audit_campaign(store, PLAN, asked, AS_OF, coverage.CoverageConfig(5))
    counts = {r.status: r.row_count for r in c.task_counts(out["assessments"]).collect()}
    assert (counts["complete"], counts["empty"], counts["pending"]) == (2, 2, 0)
    statuses = {r.symbol: r.coverage_status for r in out["coverage"].collect()}
    assert statuses == {"FPT": "usable_vnd", "HPG": "absent"}
    ready = out["readiness"].first()
    assert ready.research_readiness_status == "rejected" and ready.campaign_complete
    assert ready.reason_codes == [
        "vnd_usable_symbol_ratio_below_minimum", "absent_symbol_ratio_above_maximum",
    ]
    assert out["summary"].first().assembly_ready
    dataset = jobs.assemble_campaign(store, PLAN, asked, AS_OF)
    assert dataset == jobs.assemble_campaign(store, PLAN, asked, AS_OF)
    path = f"assembled/campaign_id=camp-a/assembled_dataset_id={dataset}"
    rows = spark.read.parquet(store.dataset_path(path)).collect()
    assert len(rows) == 10 and {r.symbol for r in rows} == {"FPT"}
    assert {r.source_run_id for r in rows} == {"fpt-0", "fpt-1"}
    assert store.table("assembled_datasets").count() == 1
    relaxed = readiness.readiness(
        PLAN, asked, out["assessments"], out["coverage"], out["source"],
        readiness.ReadinessPolicy(0.5, 0.5),
    ).first()
    assert relaxed.research_readiness_status == "accepted"
    kept = readiness.campaign_state(
        out["assessments"], readiness.evidence_digest(PLAN, out["assessments"]), out["readiness"]
    ).first()
    assert kept.coverage_quality_status == "rejected"
    moved = out["assessments"].withColumn("observation_count", F.lit(1).cast("bigint"))
    lost = readiness.campaign_state(
        moved, readiness.evidence_digest(PLAN, moved), out["readiness"]
    ).first()
    assert lost.coverage_quality_status == "not_assessed"


def test_failed_gate_publishes_nothing(store):
    result = run(store, "fpt-bad", "FPT", 0, [DAYS[0][0]] * 2)
    assert result.status == "failed" and not store.has_runs("normalized/daily")
    manifest = store.manifests().first()
    assert manifest.status == "failed"
    outside = run(store, "fpt-out", "FPT", 0, DAYS[1])
    found = names(outside.results)
    assert found["rows_inside_requested_chunk"].blocks_output


def test_empty_run_without_permission_fails(store):
    assert run(store, "hpg-x", "HPG", 0, []).status == "failed"


def test_two_usable_sources_conflict(spark, store):
    complete(store)
    run(store, "fpt-0b", "FPT", 0, DAYS[0], at="2026-07-04T02:00:00")
    frames = jobs.assess_campaign(store, PLAN, AS_OF)
    r = frames["assessments"].where(F.col("task_id") == task("FPT", 0)).first()
    assert r.status == "incompatible" and r.selected_run_id is None and r.attempt_count == 2
    assert r.reason_codes == ["multiple_compatible_successful_sources_for_task"]
    with pytest.raises(ValueError, match="unresolved"):
        jobs.assemble_campaign(store, PLAN, symbols(spark, ["FPT", "HPG"]), AS_OF)


def attempts_of(spark, rows, manifest=None, plan=PLAN):
    """Assess one receipt over literal rows."""
    tasks = c.campaign_tasks(plan, symbols(spark, ["FPT"]))
    receipt = c.receipts_for_run(
        plan, tasks.where(F.col("task_id") == task("FPT", 0)), "r1", "adopted_run", stamp()
    )
    base = {
        "command": c.BACKFILL_COMMAND, "status": "success", "provider": "vnstock",
        "exchange": "HOSE", "resolution": "1D", "start_date": CHUNKS[0][0],
        "end_date": CHUNKS[0][1], "normalized_contract": "normalized-daily-v2",
        **(manifest or {}),
    }
    record = F.struct(*[F.lit(v).alias(k) for k, v in KBS.by_column().items()])
    manifests = spark.range(1).select(
        F.lit("r1").alias("run_id"),
        F.array(F.lit("FPT")).alias("symbols"),
        record.alias("unit_provenance"),
        *[F.lit(v).cast("string").alias(k) for k, v in base.items()],
    )
    keyed = rows.withColumns(
        {"run_id": F.lit("r1"), "partition_symbol": F.lit("FPT"), "__input_path": F.lit("p")}
    )
    r = c.assess_attempts(plan, tasks, receipt, manifests, keyed, AS_OF).first()
    return r.status, r.reason_codes


def test_attempt_ladder(spark):
    good = daily(spark, [("FPT", d, 10.0, 5) for d in DAYS[0]], KBS)
    assert attempts_of(spark, good) == ("complete", ["compatible_successful_source"])
    assert attempts_of(spark, good, {"normalized_contract": None}) == (
        "complete", ["compatible_successful_source", "legacy_contract_structurally_validated"],
    )
    assert attempts_of(spark, good, {"status": "failed"}) == ("failed", ["source_run_failed"])
    assert attempts_of(spark, good, {"provider": "x", "exchange": "y", "end_date": "bad"}) == (
        "incompatible", ["provider_mismatch", "exchange_mismatch", "manifest_date_range_invalid"],
    )
    assert attempts_of(spark, good, {"end_date": "2026-06-25"}) == (
        "incompatible", ["source_range_does_not_cover_task"],
    )
    early = daily(spark, [("FPT", "2026-06-22", 10.0, 5)], KBS)
    assert attempts_of(spark, early) == ("stale", ["last_observation_stale_for_chunk_end"])
    later = daily(spark, [("FPT", DAYS[1][0], 10.0, 5)], KBS)
    assert attempts_of(spark, later, {"end_date": "2026-07-03"}) == (
        "empty", ["successful_source_contains_no_rows_for_chunk"],
    )
    assert attempts_of(spark, later) == ("incompatible", ["source_rows_outside_manifest_range"])
    weekend = daily(spark, [("FPT", "2026-06-27", 10.0, 5)], KBS)
    assert attempts_of(spark, weekend)[1] == ["weekend_observations_in_daily_source"]
    legacy = daily(spark, [("FPT", d, 10.0, 5) for d in DAYS[0]])
    assert attempts_of(spark, legacy)[1] == ["row_unit_provenance_incompatible"]
    doubled = good.unionByName(good)
    assert attempts_of(spark, doubled)[1] == ["normalized_daily_validation_failed"]
    other = good.withColumns({"symbol": F.lit("XXX"), "exchange": F.lit(None).cast("string")})
    assert attempts_of(spark, other)[1] == [
        "source_contains_null_exchanges", "source_symbol_partition_mismatch",
        "source_exchange_rows_mismatch",
    ]
    assert attempts_of(spark, good.where("false"))[1] == ["normalized_symbol_source_missing"]


def test_adoption(spark, store):
    raw = flat_bars(spark, [("FPT", d, 10.0, 5) for d in DAYS[0] + DAYS[1]])
    store.land(raw, "daily", "wide", {
        "request_start_date": F.lit(PLAN.start), "request_end_date": F.lit(PLAN.end)})
    jobs.ingest_daily(store, "wide", ["FPT"], PLAN.start, PLAN.end, provenance=KBS, as_of=AS_OF)
    state = jobs.adopt_run(store, PLAN, "wide", AS_OF)
    done = {r.task_id for r in state.where("status = 'complete'").collect()}
    assert done == {task("FPT", 0), task("FPT", 1)}
    short = flat_bars(spark, [("HPG", d, 10.0, 5) for d in DAYS[0]])
    store.land(short, "daily", "short", {
        "request_start_date": F.lit(PLAN.start), "request_end_date": F.lit("2026-07-01")})
    jobs.ingest_daily(store, "short", ["HPG"], PLAN.start, "2026-07-01", provenance=KBS, as_of=AS_OF)
    with pytest.raises(ValueError, match="range_not_aligned"):
        jobs.adopt_run(store, PLAN, "short", AS_OF)


def test_forensic_audit_job(spark, store):
    run(store, "fpt-0", "FPT", 0, DAYS[0])
    bad = flat_bars(spark, [("FPT", d, 10.0, 5) for d in DAYS[1]]).withColumn(
        "close", F.when(F.col("time") == DAYS[1][1], 11.0).otherwise(F.col("close"))
    )
    tags = {"request_start_date": F.lit(CHUNKS[1][0]), "request_end_date": F.lit(CHUNKS[1][1])}
    store.land(bad, "daily", "fpt-1", tags)
    failed = jobs.ingest_daily(
        store, "fpt-1", ["FPT"], *CHUNKS[1], provenance=KBS, as_of=AS_OF,
        campaign=("camp-a", task("FPT", 1)),
    )
    assert failed.status == "failed"
    run(store, "hpg-0", "HPG", 0, DAYS[0][:1])
    run(store, "hpg-1", "HPG", 1, DAYS[1])
    out = jobs.forensic_audit(store, PLAN, "audit-1", AS_OF)
    got = {r.task_id: r for r in out["records"].collect()}
    close = got[task("FPT", 1)]
    assert close.root_cause_category == "kbs_close_outside_reported_range_semantics_unresolved"
    assert close.raw_sha256 and close.evidence_complete and close.normalized_path is None
    stale = got[task("HPG", 0)]
    assert stale.root_cause_category == "historical_missing_tail_with_later_resumption"
    assert stale.normalized_sha256 and str(stale.next_observation_date) == DAYS[1][0]
    found = names(out["results"])
    assert {r.severity for r in found.values()} == {"INFO"} and len(found) == 3
    # a line that cannot be parsed makes the run's evidence unreadable; unrelated runs are not opened
    with next(Path(store.raw_path("daily", "fpt-1")).glob("*.json")).open("a") as f:
        f.write('{"symbol": "FPT", "time"\n')
    for crc in Path(store.raw_path("daily", "fpt-1")).glob(".*.crc"):
        crc.unlink()
    again = jobs.forensic_audit(store, PLAN, "audit-2", AS_OF)
    torn = {r.task_id: r for r in again["records"].collect()}[task("FPT", 1)]
    assert torn.load_errors == ["raw_jsonl_unreadable"] and not torn.evidence_complete
    assert torn.raw_sha256 != close.raw_sha256


@pytest.mark.parametrize(
    ("days", "log", "status", "chunks_empty"),
    [
        (DAYS[0], [(True, 2)], "success", 0),
        (DAYS[0], [(True, 2), (False, 0)], "failed", 0),
        ([], [(True, 0), (True, 0)], "success", 2),
        ([], [(True, 0), (False, 0)], "failed", 1),
        ([], None, "failed", 0),
    ],
)
def test_request_log_decides(spark, store, days, log, status, chunks_empty):
    """A failed request never publishes, and only the log proves an empty run."""
    raw = flat_bars(spark, [("FPT", d, 10.0, 5) for d in days])
    tags = {"request_start_date": F.lit(CHUNKS[0][0]), "request_end_date": F.lit(CHUNKS[0][1])}
    store.land(raw, "daily", "r", tags)
    requests = None if log is None else spark.createDataFrame(log, c.REQUEST_LOG)
    done = jobs.ingest_daily(store, "r", ["FPT"], *CHUNKS[0], provenance=KBS, allow_empty=True, requests=requests, as_of=AS_OF)
    assert done.status == status
    manifest = store.manifests().where("run_id = 'r'").first()
    assert (manifest.status, manifest.chunks_empty) == (status, chunks_empty)
    assert store.has_runs("normalized/daily") == (status == "success" and bool(days))
    with pytest.raises(ValueError, match="already has a manifest"):
        store.append_manifest({"run_id": "r"})


def test_second_assessment_reads_new_runs_only(store):
    run(store, "fpt-0", "FPT", 0, DAYS[0])
    run(store, "hpg-0", "HPG", 0, DAYS[0][:1])
    first = jobs.assess_campaign(store, PLAN, AS_OF)
    assert {r.source_run_id for r in first["judged"].collect()} == {"fpt-0", "hpg-0"}
    run(store, "fpt-1", "FPT", 1, DAYS[1])
    second = jobs.assess_campaign(store, PLAN, AS_OF)
    assert {r.source_run_id for r in second["judged"].collect()} == {"fpt-1"}
    full = jobs.assess_campaign(store, PLAN, AS_OF, everything=True)
    assert full["judged"].count() == 3
    rows = lambda frames: sorted(map(repr, frames["assessments"].collect()))
    assert rows(second) == rows(full)
    # an earlier day cannot rely on judgements of a later one
    assert jobs.assess_campaign(store, PLAN, "2026-07-03")["judged"].count() == 3


def test_unrelated_runs_are_not_read(spark, store):
    """Run partitions are pruned when the query runs: files of other runs may even be broken."""
    complete(store)
    for i in range(3):
        store.publish_daily(daily(spark, [("FPT", d, 1.0, 1) for d in DAYS[0]], KBS), f"other-{i}")
    frames = jobs.assess_campaign(store, PLAN, AS_OF)
    plan = frames["rows"]._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    for path in Path(store.root).glob("normalized/daily/run_id=other-*/**/*.parquet"):
        path.write_bytes(b"broken")
    for path in Path(store.root).glob("normalized/daily/run_id=other-*/**/.*.crc"):
        path.unlink()
    assert {r.run_id for r in frames["rows"].select("run_id").distinct().collect()} == {"fpt-0", "fpt-1"}
    again = jobs.assess_campaign(store, PLAN, AS_OF, everything=True)
    assert again["judged"].where("status = 'complete'").count() == 2
    with pytest.raises(Exception, match="not a Parquet file|Parquet"):
        store.read_daily(["other-0"]).collect()


def test_torn_and_blocked_runs_are_never_read(spark, store, monkeypatch):
    run(store, "fpt-0", "FPT", 0, DAYS[0])
    bars = daily(spark, [("FPT", d, 1.0, 1) for d in DAYS[1]], KBS)
    counts = store.stage_run(bars, "normalized/daily", "torn", ["symbol"])
    assert counts == {"row_count": len(DAYS[1])}
    seen = lambda: {r.run_id for r in store.read_daily().select("run_id").distinct().collect()}
    assert seen() == {"fpt-0"} and [r.run_id for r in store.run_ids("normalized/daily").collect()] == ["fpt-0"]
    with pytest.raises(ValueError, match="holds"):
        store.commit("normalized/daily", "torn", 99)
    assert seen() == {"fpt-0"}
    store.publish_daily(bars.limit(1), "torn")  # the job runs again and replaces what was left
    assert seen() == {"fpt-0", "torn"} and store.read_daily(["torn"]).count() == 1
    with pytest.raises(ValueError, match="is committed"):
        store.stage_run(bars, "normalized/daily", "torn", ["symbol"])

    def killed(*_):
        raise RuntimeError("killed")

    monkeypatch.setattr(jobs, "gate_open", killed)
    with pytest.raises(RuntimeError, match="killed"):
        run(store, "fpt-1", "FPT", 1, DAYS[1])
    assert seen() == {"fpt-0", "torn"}


def test_tasks_are_dealt_and_never_broadcast(spark):
    """The optimizer cannot see that a symbol becomes many tasks."""
    tasks = c.campaign_tasks(PLAN, symbols(spark, ["FPT", "HPG", "VNM"]).coalesce(1))
    keys = tasks.select("task_id", F.lit(1).alias("n"))
    for joined in (keys.join(tasks, "task_id"), symbols(spark, ["FPT"]).join(tasks, "symbol", "left")):
        assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
    assert tasks.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_plan_checks_deal_tasks_into_fixed_parts(spark):
    asked = symbols(spark, ["FPT", "HPG"])
    plan = c.check_plan(PLAN, asked, c.campaign_tasks(PLAN, asked))._jdf.queryExecution().executedPlan().toString()
    by_id = [x for x in plan.splitlines() if "Exchange hashpartitioning(task_id" in x]
    assert by_id and all("REPARTITION_BY_NUM" in x for x in by_id)


def test_attempts_meet_declared_symbols_one_by_one(spark, store):
    """A run may declare every symbol of the plan; no attempt carries that list."""
    run(store, "fpt-0", "FPT", 0, DAYS[0])
    tasks, _ = jobs.campaign_tables(store, PLAN)
    receipts = c.receipts_for_run(PLAN, tasks.where("start_date = '2026-06-22'"), "fpt-0", "adopted_run", stamp())
    declared = F.array(F.lit("FPT"), F.lit("FPT"), F.lit(None).cast("string"))
    manifests = store.manifests().withColumn("symbols", declared)
    judged = c.assess_attempts(PLAN, tasks, receipts, manifests, jobs.campaign_rows(store, receipts), AS_OF)
    assert "array_contains" not in judged._jdf.queryExecution().optimizedPlan().toString()
    found = {r.symbol: (r.status, r.reason_codes) for r in judged.collect()}
    assert found["FPT"][0] == "complete" and len(found) == 2
    assert found["HPG"] == ("incompatible", ["symbol_not_declared_by_source_manifest"])


def test_runs_meet_tasks_of_their_own_days(spark):
    plan = c.CampaignPlan("camp-9", "2020-01-01", "2025-12-31", 20, "2026-01-31")
    tasks = c.campaign_tasks(plan, symbols(spark, ["AAA", "BBB", "CCC"]))
    first = F.col("start_date") == F.lit("2020-01-01").cast("date")
    state = tasks.withColumns({
        "status": F.when(first & (F.col("symbol") == "BBB"), "complete").otherwise("pending"),
        "selected_run_id": F.when(first & (F.col("symbol") == "BBB"), F.lit("other")),
    })
    # The second run spans two chunks, the third reaches far beyond the plan, the fourth runs backwards.
    rows = [
        ("one", ["AAA"], "2020-01-01", "2020-01-20"), ("two", ["AAA", "CCC"], "2020-01-21", "2020-02-29"),
        ("far", ["AAA"], "0001-01-01", "9999-12-31"), ("back", ["AAA"], "2020-03-01", "2020-01-01"),
        ("part", ["AAA"], "2020-01-02", "2020-01-21"), ("late", ["AAA"], "2026-02-01", "2026-03-01"),
        ("undated", ["AAA"], None, "2020-01-20"), ("taken", ["BBB"], "2020-01-01", "2020-01-20"),
        ("half", ["AAA", "ZZZ"], "2020-01-01", "2020-01-20"), ("none", [], "2020-01-01", "2020-01-20"),
    ]
    given = spark.createDataFrame(rows, "run_id string, symbols array<string>, start_date string, end_date string")
    given = given.withColumns({"command": F.lit(c.BACKFILL_COMMAND), "status": F.lit("success")})
    report = c.adoption_report(tasks, state, given)
    got = {r.run_id: (r.covered_task_count, r.taken_task_count, r.verdict) for r in report.collect()}
    chunks = c.chunk_count(plan)
    assert got == {
        "one": (1, 0, "adoptable"), "two": (4, 0, "adoptable"), "far": (chunks, 0, "range_not_aligned_to_chunks"),
        "back": (0, 0, "covers_no_tasks"), "part": (0, 0, "covers_no_tasks"), "late": (0, 0, "covers_no_tasks"),
        "undated": (0, 0, "source_bounds_invalid"), "taken": (1, 1, "task_already_resolved_by_other_run"),
        "half": (1, 0, "range_not_aligned_to_chunks"), "none": (0, 0, "covers_no_tasks"),
    }
    # A run does not meet every task of its symbol.
    assert "__stretch" in report._jdf.queryExecution().optimizedPlan().toString()


def test_runs_are_never_broadcast_to_their_bars(spark, monkeypatch):
    from barledger.catalog import campaigns

    monkeypatch.setattr(campaigns, "staged", lambda rows: rows)
    stored = campaigns.stored_rows(spark, "/root/testdata/sf0.001")
    assert "Broadcast" not in stored._jdf.queryExecution().executedPlan().toString()


def test_run_facts_and_source_rows_are_never_broadcast(spark):
    from barledger.catalog import campaigns

    sf = "/root/testdata/sf0.001"
    stored = campaigns.stored_rows(spark, sf)  # a small file: by its size on disk all of it would be broadcast
    for df in (campaigns.attempts(spark, sf, stored), c.source_rows(campaigns.assessments(spark, sf, stored), stored)):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_lines_meet_runs_before_they_carry_the_bars_fixed_columns(spark, monkeypatch):
    from barledger.catalog import campaigns

    monkeypatch.setattr(campaigns, "staged", lambda rows: rows)
    stored = campaigns.stored_rows(spark, "/root/testdata/sf0.001")
    text = stored._jdf.queryExecution().optimizedPlan().toString()
    assert "vnstock" in text and "vnstock" not in text[text.index("Join ") :]


def test_attempts_are_not_dealt_again_by_task(spark):
    """Facts of tasks meet attempts where the facts of their run do; day facts are shuffled once for both."""
    from barledger.catalog import campaigns

    sf = "/root/testdata/sf0.001"
    judged = campaigns.attempts(spark, sf, campaigns.stored_rows(spark, sf))
    plan = judged._jdf.queryExecution().executedPlan().toString()
    dealt = [re.sub(r"#\d+L?", "", x) for x in plan.splitlines() if "Exchange hashpartitioning(" in x]
    assert not any("task_id" in x and "run_id" in x.split("hashpartitioning")[1] for x in dealt), dealt
    days = [x for x in dealt if "(run_id, partition_symbol, " in x and "REPARTITION_BY_NUM" in x]
    assert len(days) == 2
    judged.collect()
    assert "ReusedExchange" in judged._jdf.queryExecution().executedPlan().toString()
