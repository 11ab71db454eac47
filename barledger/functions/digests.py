"""Mergeable content digests.

A sequential hash over an ordered list forces all rows through one task.  Here every row
is hashed on its own (its position or key is part of the hashed text, so order still
counts) and the eight 32-bit words of the hashes are summed.  Sums combine map-side, and
the final SHA-256 covers the word sums and the row count.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WORDS = 8


def row_line(columns: list[Column | str]) -> Column:
    """Canonical JSON text of a row; nulls are kept."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def multiset_digest(line: Column) -> Column:
    """Aggregate expression: digest of the multiset of ``line`` values in a group."""
    digest = F.sha2(line, 256)
    words = [
        F.coalesce(
            F.sum(F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("decimal(20,0)")),
            F.lit(0).cast("decimal(20,0)"),
        ).cast("decimal(30,0)").cast("string")
        for i in range(_WORDS)
    ]
    return F.sha2(F.concat_ws("|", F.count(line).cast("string"), *words), 256)
