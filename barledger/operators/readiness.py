"""Campaign digests, research readiness, audit summary and versioned assembly."""

from __future__ import annotations

import dataclasses
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barledger.contracts import ASSEMBLED_DAILY, ASSEMBLED_VERSION, READINESS_POLICY_VERSION
from barledger.functions.digests import multiset_digest, row_line
from barledger.functions.exprs import count_where, reasons
from barledger.operators import campaign
from barledger.operators.campaign import CampaignPlan
from barledger.operators.coverage import CoverageConfig, audit_coverage, summarize_coverage
from barledger.operators.ordering import duplicate_counts
from barledger.operators.panel import daily_panel
from barledger.operators.sets import set_differences
from barledger.operators.units import unit_policy


@dataclass(frozen=True)
class ReadinessPolicy:
    min_vnd_usable_symbol_ratio: float = 1.0
    max_absent_symbol_ratio: float = 0.0
    require_common_vnd_date_overlap: bool = True
    policy_version: str = READINESS_POLICY_VERSION

    def __post_init__(self) -> None:
        if self.policy_version != READINESS_POLICY_VERSION:
            raise ValueError(f"Unsupported readiness policy: {self.policy_version}.")
        for ratio in (self.min_vnd_usable_symbol_ratio, self.max_absent_symbol_ratio):
            if not 0 <= ratio <= 1:
                raise ValueError("Readiness ratios must be between zero and one.")


# --- fixed values: criteria in report order, with the reason a failure reports ---------
CRITERIA = {
    "campaign_complete": "campaign_incomplete",
    "task_sources_assembly_compatible": "task_sources_assembly_incompatible",
    "source_rows_present": "campaign_source_rows_missing",
    "source_symbol_dates_unique": "duplicate_symbol_date_rows_present",
    "task_ranges_contiguous_non_overlapping": "task_range_gap_or_overlap_present",
    "structural_assembly_compatible": "structural_assembly_incompatible",
    "full_universe_coverage_audited": "full_universe_coverage_not_audited",
    "no_rejected_coverage_statuses": "rejected_coverage_statuses_present",
    "minimum_vnd_usable_symbol_ratio": "vnd_usable_symbol_ratio_below_minimum",
    "maximum_absent_symbol_ratio": "absent_symbol_ratio_above_maximum",
    "common_vnd_date_overlap": "common_vnd_date_overlap_missing",
    "vnd_unit_provenance_permitted": "vnd_unit_provenance_not_permitted",
}
COVERAGE_CRITERIA = [
    "full_universe_coverage_audited",
    "source_symbol_dates_unique",
    "no_rejected_coverage_statuses",
    "minimum_vnd_usable_symbol_ratio",
    "maximum_absent_symbol_ratio",
    "common_vnd_date_overlap",
    "vnd_unit_provenance_permitted",
]


def _plan_text(plan: CampaignPlan) -> Column:
    """The plan's named fields as JSON: the text hangs on names and values, not on a class's repr."""
    return F.lit(json.dumps(dataclasses.asdict(plan), sort_keys=True, default=str))


def evidence_digest(plan: CampaignPlan, assessments: DataFrame) -> DataFrame:
    """Digest of every task's status, source, counts and reasons (one row)."""
    line = row_line(
        [
            "task_id",
            "status",
            "selected_run_id",
            "observation_count",
            "first_observation_date",
            "last_observation_date",
            "reason_codes",
        ]
    )
    head = F.lit(
        "|".join([plan.campaign_id, plan.campaign_version, plan.normalized_version])
    )
    return assessments.agg(multiset_digest(line).alias("tasks")).select(
        F.sha2(F.concat_ws("|", head, "tasks"), 256).alias("evidence_digest")
    )


def assembled_dataset_id(plan: CampaignPlan, assessments: DataFrame) -> DataFrame:
    """Deterministic dataset id from the plan and each task's source (one row)."""
    line = row_line(["task_id", "status", "selected_run_id"])
    return assessments.agg(multiset_digest(line).alias("tasks")).select(
        F.concat(
            F.lit(f"{ASSEMBLED_VERSION}-"),
            F.substring(F.sha2(F.concat_ws("|", _plan_text(plan), "tasks"), 256), 1, 16),
        ).alias("assembled_dataset_id")
    )


def readiness(
    plan: CampaignPlan,
    symbols: DataFrame,
    assessments: DataFrame,
    coverage: DataFrame,
    rows: DataFrame,
    policy: ReadinessPolicy = ReadinessPolicy(),
    gaps: int = 0,
    overlaps: int = 0,
) -> DataFrame:
    """Twelve criteria, their metrics, ordered reasons and both verdicts (one row).

    ``rows`` are the campaign's source rows.  Every input is a one-row aggregate.
    """
    flags = campaign.campaign_flags(assessments)
    summary = summarize_coverage(coverage)
    universe = symbols.agg(F.count(F.lit(1)).alias("n"))
    same = set_differences(coverage, symbols).select("equal")
    doubled = duplicate_counts(rows, ["symbol", "date"]).select("duplicate_count")
    volume = rows.agg(F.count(F.lit(1)).alias("n"))
    permitted = unit_policy(rows).select("vnd_traded_value_permitted")
    s = summary.withColumns(
        {
            "flags": flags.select(F.struct("*").alias("f")).scalar(),
            "universe_symbol_count": universe.scalar(),
            "symbols_match": same.scalar(),
            "duplicate_symbol_date_count": doubled.scalar(),
            "source_row_count": volume.scalar(),
            "vnd_permitted": permitted.scalar(),
            "evidence_digest": evidence_digest(plan, assessments).scalar(),
        }
    )
    f = F.col
    total = f("universe_symbol_count")

    def share(c: str) -> Column:
        return F.when(total > 0, f(c).cast("double") / total.cast("double")).otherwise(F.lit(0.0))

    ranges = F.lit(gaps == 0 and overlaps == 0)
    present, unique = f("source_row_count") > 0, f("duplicate_symbol_date_count") == 0
    rejected = f("audited_symbol_count") - f("status_usable_vnd") - f("status_absent")
    m = s.withColumns(
        {
            "vnd_usable_symbol_ratio": share("status_usable_vnd"),
            "absent_symbol_ratio": share("status_absent"),
            "rejected_coverage_symbol_count": rejected,
        }
    )
    structural = f("flags.assembly_compatible") & present & unique & ranges
    criteria = {
        "campaign_complete": f("flags.campaign_complete"),
        "task_sources_assembly_compatible": f("flags.assembly_compatible"),
        "source_rows_present": present,
        "source_symbol_dates_unique": unique,
        "task_ranges_contiguous_non_overlapping": ranges,
        "structural_assembly_compatible": structural,
        "full_universe_coverage_audited": (f("audited_symbol_count") == total)
        & f("symbols_match"),
        "no_rejected_coverage_statuses": f("rejected_coverage_symbol_count") == 0,
        "minimum_vnd_usable_symbol_ratio": f("vnd_usable_symbol_ratio")
        >= policy.min_vnd_usable_symbol_ratio,
        "maximum_absent_symbol_ratio": f("absent_symbol_ratio") <= policy.max_absent_symbol_ratio,
        "common_vnd_date_overlap": f("common_vnd_overlap_available")
        | F.lit(not policy.require_common_vnd_date_overlap),
        "vnd_unit_provenance_permitted": f("vnd_permitted"),
    }
    c = m.withColumns(criteria)
    accepted = F.lit(True)
    for name in COVERAGE_CRITERIA:
        accepted = accepted & f(name)
    ready = f("campaign_complete") & f("structural_assembly_compatible") & accepted
    return c.select(
        *CRITERIA,
        reasons(*[(~f(name), label) for name, label in CRITERIA.items()]).alias("reason_codes"),
        _verdict(accepted).alias("coverage_quality_status"),
        _verdict(ready).alias("research_readiness_status"),
        "universe_symbol_count",
        "audited_symbol_count",
        "source_row_count",
        "duplicate_symbol_date_count",
        F.lit(gaps).cast("bigint").alias("task_range_gap_count"),
        F.lit(overlaps).cast("bigint").alias("task_range_overlap_count"),
        f("status_usable_vnd").alias("vnd_usable_symbol_count"),
        "vnd_usable_symbol_ratio",
        f("status_absent").alias("absent_symbol_count"),
        "absent_symbol_ratio",
        "rejected_coverage_symbol_count",
        f("common_vnd_overlap_available").alias("common_vnd_date_overlap_available"),
        "evidence_digest",
    )


def _verdict(ok: Column) -> Column:
    return F.when(ok, "accepted").otherwise("rejected")


def campaign_coverage(
    plan: CampaignPlan,
    symbols: DataFrame,
    assessments: DataFrame,
    rows: DataFrame,
    config: CoverageConfig = CoverageConfig(),
) -> DataFrame:
    """Coverage audit of the campaign's source rows; complete symbols count as requested."""
    stored = rows.withColumn("__input_path", F.col("source_normalized_path")).drop(
        "source_run_id", "source_normalized_path"
    )
    return audit_coverage(
        stored,
        symbols,
        campaign.complete_symbols(assessments),
        plan.snapshot_date,
        f"campaign:{plan.campaign_id}",
        plan.start,
        plan.end,
        config,
    )


def campaign_state(
    assessments: DataFrame,
    digest: DataFrame,
    stored_readiness: DataFrame | None = None,
    published_ids: DataFrame | None = None,
    dataset_id: DataFrame | None = None,
) -> DataFrame:
    """Campaign flags; a stored readiness row stays attached only while its digest matches."""
    state = campaign.campaign_flags(assessments).withColumn("evidence_digest", digest.scalar())
    if stored_readiness is None:
        state = state.withColumns(
            {
                "coverage_quality_status": F.lit("not_assessed"),
                "research_readiness_status": F.lit("not_assessed"),
            }
        )
    else:
        attached = stored_readiness.select(
            "evidence_digest", "coverage_quality_status", "research_readiness_status"
        ).dropDuplicates(["evidence_digest"])
        state = state.join(attached, "evidence_digest", "left").withColumns(
            {
                c: F.coalesce(c, F.lit("not_assessed"))
                for c in ("coverage_quality_status", "research_readiness_status")
            }
        )
    if published_ids is None or dataset_id is None:
        return state.withColumns(
            {
                "assembled_dataset_id": F.lit(None).cast("string"),
                "canonical_candidate": F.lit(False),
            }
        )
    published = published_ids.select("assembled_dataset_id").distinct()
    return (
        state.withColumn("assembled_dataset_id", dataset_id.scalar())
        .join(
            published.withColumn("__published", F.lit(True)), "assembled_dataset_id", "left"
        )
        .withColumn(
            "assembled_dataset_id", F.when(F.col("__published"), F.col("assembled_dataset_id"))
        )
        .withColumn(
            "canonical_candidate",
            (F.col("research_readiness_status") == "accepted")
            & F.col("assembled_dataset_id").isNotNull(),
        )
        .drop("__published")
    )


def audit_summary(
    plan: CampaignPlan,
    symbols: DataFrame,
    assessments: DataFrame,
    coverage: DataFrame,
    rows: DataFrame,
    policy: ReadinessPolicy = ReadinessPolicy(),
) -> DataFrame:
    """One-row campaign audit: task, symbol and run counts, flags, units and readiness."""
    ready = readiness(plan, symbols, assessments, coverage, rows, policy)
    tasks = assessments.agg(
        F.count(F.lit(1)).alias("task_count"),
        *[
            count_where(F.col("status") == s).alias(f"task_{s}_count")
            for s in ("pending", "complete", "empty", "failed", "stale", "incompatible")
        ],
    )
    by_symbol = campaign.symbol_statuses(assessments).agg(
        *[
            count_where(F.col("symbol_status") == s).alias(f"symbol_{s}_count")
            for s in ("complete", "incompatible", "stale", "failed", "partial", "pending")
        ]
    )
    used = rows.select("source_run_id").distinct().agg(F.count("source_run_id"))
    resolved = campaign.resolved_source_runs(assessments).agg(F.count(F.lit(1)))
    units = unit_policy(rows).select("unit_provenance_status")
    combined = ready.withColumns(
        {
            "t": tasks.select(F.struct("*").alias("t")).scalar(),
            "y": by_symbol.select(F.struct("*").alias("y")).scalar(),
            "virtual_source_run_count": used.scalar(),
            "resolved_task_source_run_count": resolved.scalar(),
            "unit_provenance_status": units.scalar(),
        }
    )
    return combined.select(
        F.lit(plan.campaign_id).alias("campaign_id"),
        "t.*",
        "y.*",
        "universe_symbol_count",
        "resolved_task_source_run_count",
        "virtual_source_run_count",
        F.col("source_row_count").alias("virtual_source_row_count"),
        "duplicate_symbol_date_count",
        "task_range_gap_count",
        "task_range_overlap_count",
        "campaign_complete",
        F.col("task_sources_assembly_compatible").alias("assembly_compatible"),
        (F.col("campaign_complete") & F.col("task_sources_assembly_compatible")).alias(
            "assembly_ready"
        ),
        "coverage_quality_status",
        "research_readiness_status",
        "reason_codes",
        "unit_provenance_status",
        F.col("vnd_unit_provenance_permitted").alias("vnd_traded_value_permitted"),
    )


def assemble(
    plan: CampaignPlan,
    assessments: DataFrame,
    rows: DataFrame,
    symbols: DataFrame | None = None,
) -> DataFrame:
    """Versioned daily dataset; lineage columns ride along, so no join back is needed."""
    panel = daily_panel(
        rows, plan.start, plan.end, symbols, carry=["source_run_id", "source_normalized_path"]
    )
    return panel.withColumns(
        {
            "assembly_contract_version": F.lit(ASSEMBLED_VERSION),
            "campaign_id": F.lit(plan.campaign_id),
            "assembled_dataset_id": assembled_dataset_id(plan, assessments).scalar(),
        }
    ).select(*ASSEMBLED_DAILY.columns)


def attach_lineage(panel: DataFrame, lineage: DataFrame) -> DataFrame:
    """Join form of lineage: one lineage row per (symbol, date), else the job fails."""
    keys = ["symbol", "date"]
    checked = lineage.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"),
        F.first("source_run_id").alias("source_run_id"),
        F.first("source_normalized_path").alias("source_normalized_path"),
    )
    single = F.when(
        F.col("__n") > 1, F.raise_error(F.lit("Lineage repeats symbol/date keys."))
    ).otherwise(F.lit(True))
    return panel.join(checked.where(single).drop("__n"), keys, "left")
