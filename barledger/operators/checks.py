"""Generic data-quality evaluation.

A catalog is a list of row-level rules.  All rules of a frame are counted in one
aggregate (one scan, one tiny shuffle); sample keys come from a second pass over failing
rows only, pruned to five per rule on the map side.  Key uniqueness and frame-level facts
are separate one-row aggregates in the same result shape.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barledger.functions.exprs import any_of, count_where, holds
from barledger.operators.ordering import top_rows

ERROR, WARNING, INFO = "ERROR", "WARNING", "INFO"
SAMPLE_LIMIT = 5

RESULT_COLUMNS = [
    "dataset_name",
    "severity",
    "check_name",
    "message",
    "affected_columns",
    "affected_row_count",
    "sample_affected_keys",
    "blocks_output",
]
RESULT_SCHEMA = (
    "dataset_name string, severity string, check_name string, message string, "
    "affected_columns array<string>, affected_row_count bigint, "
    "sample_affected_keys array<string>, blocks_output boolean"
)


@dataclass(frozen=True)
class Rule:
    """A row-level check: the rows where ``fails`` is true are the affected rows."""

    name: str
    severity: str
    fails: Column
    columns: list[str] = field(default_factory=list)
    message: str = ""
    counts_rows: bool = True
    keys: list[str] | None = None

    @property
    def blocks(self) -> bool:
        return self.severity == ERROR


def key_text(columns: list[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("<NA>")) for c in columns])


def required_columns(
    df: DataFrame, dataset: str, required: list[str]
) -> DataFrame | None:
    """A single blocking row when columns are missing, else None."""
    missing = sorted(set(required) - set(df.columns))
    if not missing:
        return None
    row = (
        dataset,
        ERROR,
        "required_columns",
        "Missing required columns: " + ", ".join(missing) + ".",
        missing,
        0,
        [],
        True,
    )
    return df.sparkSession.createDataFrame([row], RESULT_SCHEMA)


def rule_metrics(rules: list[Rule]) -> dict[str, Column]:
    """Aggregates that count each rule's affected rows while a frame is written."""
    return {f"rule:{r.name}": count_where(holds(r.fails)) for r in rules}


def run_checks(
    df: DataFrame,
    dataset: str,
    rules: list[Rule],
    sample_keys: list[str] | None = None,
    counts: dict[str, int] | None = None,
) -> DataFrame:
    """One result row per rule with at least one affected row.

    With ``counts`` (observed ``rule_metrics``) the frame is not counted again: only rules that
    fail read it, for their sample keys.
    """
    if counts is not None:
        return _counted_checks(df, dataset, rules, sample_keys, counts)
    flagged = df.select(
        *[c for c in (sample_keys or []) if c in df.columns],
        *[holds(r.fails).alias(f"__f{i}") for i, r in enumerate(rules)],
    )
    totals = flagged.agg(
        *[count_where(F.col(f"__f{i}")).alias(f"__f{i}") for i in range(len(rules))]
    )
    rows = totals.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(r.severity).alias("severity"),
                        F.lit(r.name).alias("check_name"),
                        F.lit(r.message or r.name.replace("_", " ")).alias("message"),
                        F.array(*[F.lit(c) for c in r.columns])
                        .cast("array<string>")
                        .alias("affected_columns"),
                        F.col(f"__f{i}").alias("failing"),
                        F.when(F.lit(r.counts_rows), F.col(f"__f{i}"))
                        .otherwise(F.lit(0).cast("bigint"))
                        .alias("affected_row_count"),
                        F.lit(r.blocks).alias("blocks_output"),
                    )
                    for i, r in enumerate(rules)
                ]
            )
        ).alias("c")
    ).select("c.*").where("failing > 0")
    keys = [c for c in (sample_keys or []) if c in df.columns]
    if keys:
        rows = rows.join(_samples(flagged, rules, keys), "check_name", "left")
        sample = F.coalesce("sample_affected_keys", F.array().cast("array<string>"))
    else:
        sample = F.array().cast("array<string>")
    return rows.withColumns(
        {"dataset_name": F.lit(dataset), "sample_affected_keys": sample}
    ).select(*RESULT_COLUMNS)


def _counted_checks(df, dataset, rules, sample_keys, counts) -> DataFrame:
    failing = [(r, counts[f"rule:{r.name}"]) for r in rules if counts[f"rule:{r.name}"]]
    rows = df.sparkSession.createDataFrame(
        [
            (dataset, r.severity, r.name, r.message or r.name.replace("_", " "), r.columns, n if r.counts_rows else 0, r.blocks)
            for r, n in failing
        ],
        RESULT_SCHEMA.replace("sample_affected_keys array<string>, ", ""),
    )
    keys = [c for c in (sample_keys or []) if c in df.columns]
    sample = F.array().cast("array<string>")
    if keys and failing:
        flagged = df.select(*keys, *[holds(r.fails).alias(f"__f{i}") for i, (r, _) in enumerate(failing)])
        rows = rows.join(_samples(flagged, [r for r, _ in failing], keys), "check_name", "left")
        sample = F.coalesce("sample_affected_keys", sample)
    return rows.withColumn("sample_affected_keys", sample).select(*RESULT_COLUMNS)


def _samples(flagged: DataFrame, rules: list[Rule], keys: list[str]) -> DataFrame:
    """Up to five smallest keys per failing rule."""
    failing = flagged.where(any_of(F.col(f"__f{i}") for i in range(len(rules))))
    names = F.array_compact(
        F.array(*[F.when(F.col(f"__f{i}"), F.lit(r.name)) for i, r in enumerate(rules)])
    )
    exploded = failing.select(key_text(keys).alias("key"), *keys, F.explode(names).alias("check_name"))
    top = top_rows(
        exploded,
        ["check_name"],
        [F.col(k).asc_nulls_last() for k in keys],
        SAMPLE_LIMIT,
        "__p",
    )
    return _collect_samples(top)


def _collect_samples(top: DataFrame) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct("__p", "key")))
    return top.groupBy("check_name").agg(
        F.transform(ordered, lambda x: x["key"]).alias("sample_affected_keys")
    )


def uniqueness_check(
    df: DataFrame,
    dataset: str,
    name: str,
    keys: list[str],
    message: str = "",
    sample_keys: list[str] | None = None,
    keep_all: bool = False,
) -> DataFrame:
    """Blocking row when a key repeats; counts rows beyond the first (or all of them)."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    extra = F.col("__n") if keep_all else F.col("__n") - 1
    repeated = counted.withColumn("__extra", extra)
    total = repeated.agg(F.coalesce(F.sum("__extra"), F.lit(0)).alias("affected_row_count"))
    shown = sample_keys or keys
    top = top_rows(
        repeated.withColumn("check_name", F.lit(name)),
        ["check_name"],
        [F.col(k).asc_nulls_last() for k in shown],
        SAMPLE_LIMIT,
        "__g",
    )
    top = (
        top.withColumn(
            "__i",
            F.explode(
                F.sequence(
                    F.lit(1), F.least(F.col("__extra"), F.lit(SAMPLE_LIMIT)).cast("int")
                )
            ),
        )
        .withColumn("key", key_text(shown))
        .withColumn("__p", F.struct("__g", "__i"))
    )
    samples = _collect_samples(top).withColumn(
        "sample_affected_keys", F.slice("sample_affected_keys", 1, SAMPLE_LIMIT)
    )
    return (
        total.where("affected_row_count > 0")
        .withColumns(
            {
                "dataset_name": F.lit(dataset),
                "severity": F.lit(ERROR),
                "check_name": F.lit(name),
                "message": F.lit(message or name.replace("_", " ")),
                "affected_columns": F.array(*[F.lit(k) for k in keys]),
                "blocks_output": F.lit(True),
            }
        )
        .join(samples, "check_name", "left")
        .select(*RESULT_COLUMNS)
    )


def fact_check(
    facts: DataFrame,
    dataset: str,
    name: str | Column,
    severity: str | Column,
    fails: Column,
    affected: Column | None = None,
    columns: list[str] | Column = (),
    message: str | Column = "",
    blocks: bool | Column | None = None,
    samples: Column | None = None,
) -> DataFrame:
    """A check over an already aggregated frame: one result row per failing fact row."""
    level = severity if isinstance(severity, Column) else F.lit(severity)
    label = name if isinstance(name, Column) else F.lit(name)
    text = message if isinstance(message, Column) else F.lit(message or str(name).replace("_", " "))
    if not isinstance(columns, Column):
        columns = F.array(*[F.lit(c) for c in columns])
    blocking = (level == ERROR) if blocks is None else blocks
    blocking = blocking if isinstance(blocking, Column) else F.lit(blocking)
    count = F.lit(0) if affected is None else affected
    sample = F.array() if samples is None else samples
    return facts.where(holds(fails)).select(
        F.lit(dataset).alias("dataset_name"),
        level.alias("severity"),
        label.alias("check_name"),
        text.alias("message"),
        columns.cast("array<string>").alias("affected_columns"),
        count.cast("bigint").alias("affected_row_count"),
        sample.cast("array<string>").alias("sample_affected_keys"),
        blocking.alias("blocks_output"),
    )


def summarize(results: DataFrame) -> DataFrame:
    """Counts by severity and of blocking results, plus the gate flag."""
    return results.agg(
        *[count_where(F.col("severity") == s).alias(s) for s in (INFO, WARNING, ERROR)],
        count_where(F.col("blocks_output")).alias("blocking"),
        F.coalesce(F.bool_or("blocks_output"), F.lit(False)).alias("has_blocking_errors"),
    )


def non_negative(columns: list[str], keys: list[str] | None = None) -> list[Rule]:
    return [
        Rule(
            f"{c}_non_negative",
            ERROR,
            F.col(c).cast("double") < 0,
            [c],
            f"{c} contains negative values.",
        )
        for c in columns
    ]
