"""Shared pieces of oracle SQL (DuckDB), written independently of the Spark plans."""

from __future__ import annotations

from barledger.contracts import PROVENANCE_COLUMNS, SOURCE_PROVENANCE_COLUMNS
from barledger.operators.units import KBS, VCI

NULL_OHLC = "(open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL)"
HIGH_LOW = "coalesce(high < low, false)"
HIGH_OC = "(coalesce(high < open, false) OR coalesce(high < close, false))"
LOW_OC = "(coalesce(low > open, false) OR coalesce(low > close, false))"
NEG_PRICE = (
    "(coalesce(open < 0, false) OR coalesce(high < 0, false) OR coalesce(low < 0, false) "
    "OR coalesce(close < 0, false))"
)
BAD_OHLC = f"({HIGH_LOW} OR {HIGH_OC} OR {LOW_OC} OR {NEG_PRICE})"
FRACTIONAL = "coalesce(volume % 1 <> 0, false)"


def n_where(condition: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT)"


def calendar(start: str, end: str) -> str:
    """Expanded weekday calendar with its ordinal."""
    return (
        "SELECT d, row_number() OVER (ORDER BY d) AS n FROM (SELECT CAST(g AS DATE) AS d FROM "
        f"generate_series(DATE '{start}', DATE '{end}', INTERVAL 1 DAY) t(g)) "
        "WHERE isodow(d) < 6"
    )


def record_equals(record, alias: str = "") -> str:
    parts = []
    for c, v in record.by_column().items():
        value = str(v) if isinstance(v, float) else f"'{v}'"
        parts.append(f"coalesce({alias}{c} = {value}, false)")
    return "(" + " AND ".join(parts) + ")"


def policy(rows: str, by: str | None) -> str:
    """Unit policy per group: brute force over all rows."""
    no_source = " AND ".join(f"{c} IS NULL" for c in SOURCE_PROVENANCE_COLUMNS)
    complete = " AND ".join(f"{c} IS NOT NULL" for c in PROVENANCE_COLUMNS)
    record = "(" + ", ".join(PROVENANCE_COLUMNS) + ")"
    lead = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    uniform = ", ".join(
        f"CASE WHEN count(DISTINCT nullif(trim({c}), '')) = 1 THEN min(nullif(trim({c}), '')) END "
        f"AS {alias}"
        for c, alias in (
            ("provider", "u_provider"),
            ("data_backend", "u_backend"),
            ("source_resolution", "u_resolution"),
            ("source_unit_evidence_reference", "u_evidence"),
        )
    )
    return f"""
        SELECT {lead} status AS unit_provenance_status, status = 'verified' AS permitted,
          CASE WHEN status = 'verified' THEN policy_name ELSE 'unverified' END
            AS unit_policy_name,
          CASE WHEN status = 'verified' THEN price ELSE 'unknown' END AS price_unit,
          CASE WHEN status = 'verified' THEN vol ELSE 'provider_units' END AS volume_unit,
          CASE WHEN status = 'verified' THEN 'vnd' ELSE 'unavailable' END AS traded_value_unit,
          CASE WHEN status = 'verified' THEN scale END AS price_scale,
          u_provider, u_backend, u_resolution, u_evidence
        FROM (SELECT *, CASE WHEN n = 0 THEN 'no_data' WHEN none = n THEN 'legacy_missing'
            WHEN full_rows < n AND full_rows > 0 THEN 'ambiguous'
            WHEN full_rows < n THEN 'incomplete' WHEN records > 1 THEN 'ambiguous'
            WHEN NOT registered THEN 'incompatible' ELSE 'verified' END AS status
          FROM (SELECT {lead} count(*) AS n,
              count(*) FILTER (WHERE {no_source}) AS none,
              count(*) FILTER (WHERE {complete}) AS full_rows,
              count(DISTINCT {record}) FILTER (WHERE {complete}) AS records,
              coalesce(bool_and({record_equals(KBS)} OR {record_equals(VCI)}), false)
                AS registered,
              min(source_unit_policy_name) AS policy_name, min(source_price_unit) AS price,
              min(source_volume_unit) AS vol, min(source_price_scale_to_vnd) AS scale,
              {uniform}
            FROM {rows} {group}))"""


def json_list(items: list[tuple[str, str]]) -> str:
    """JSON array text of the labels whose condition holds."""
    parts = ", ".join(f"CASE WHEN {cond} THEN '{label}' END" for cond, label in items)
    return f"CAST(to_json(list_filter([{parts}], lambda x: x IS NOT NULL)) AS VARCHAR)"
