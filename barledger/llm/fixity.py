"""Fixity audit of WARC replicas by Merkle trees over ordered offset ranges.

A replica is a table of records (shard, offset, length, record).  Leaves are SHA-256 digests of
records; the next level covers fixed ranges of ``RANGE`` bytes of a shard's offsets, each further
level ``FANOUT`` neighbouring ranges, until a shard is one node; shards are joined by number in
the same way up to one root.  A node's digest covers its children's places, lengths and digests
in order.  The audit compares roots and then follows only branches that differ: each step joins
the children of differing nodes, so equal branches are read no further than their top digest.

Findings per record: ``changed`` (same length), ``resized``, ``missing`` or ``extra``.

Ranges are bounded in bytes and fan-out, so no node gathers an unbounded group; shards are
cut by size when records are written.

Defined cases: null url and html are empty; pages repeated whole are records of their own; an
empty replica has no root and every record of the other one is missing or extra; a record
repeated at one offset enters its range's digest twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barledger.llm.common import staged

RANGE = 1 << 18
FANOUT = 16
SHARD_BYTES = 64 << 20
NODE = ["shard", "place"]


def records(pages: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """WARC response records of pages with their shard and offset: page_id, shard, offset, length, record."""
    body = F.coalesce("html", F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce("url", F.lit("")), F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    rows = pages.select("page_id", F.concat(head, body, F.lit("\r\n\r\n")).alias("record"))
    rows = rows.withColumn("length", F.octet_length("record").cast("bigint"))
    total = rows.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    shards = max(1, -(-int(total) // shard_bytes))
    name = F.conv(F.substring(F.md5(F.coalesce(F.col("page_id").cast("string"), F.lit("")).cast("binary")), 1, 8), 16, 10).cast("bigint")
    rows = rows.withColumn("shard", name % shards)
    w = Window.partitionBy("shard").orderBy("page_id", F.xxhash64("record"))
    before = F.coalesce(F.sum("length").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.select("page_id", "shard", before.cast("bigint").alias("offset"), "length", "record")


def leaves(replica: DataFrame) -> DataFrame:
    """shard, place (offset), length, digest of each record."""
    digest = F.sha2(F.encode("record", "utf-8") if dict(replica.dtypes)["record"] == "string" else F.col("record"), 256)
    return replica.select("shard", F.col("offset").alias("place"), F.col("length"), digest.alias("digest"))


def _parents(children: DataFrame, place: Column) -> DataFrame:
    row = F.struct(F.col("place"), F.col("length"), F.col("digest"))
    text = F.transform(F.sort_array(F.collect_list(row)), lambda x: F.concat_ws(":", x["place"].cast("string"), x["length"].cast("string"), x["digest"]))
    return (
        children.groupBy("shard", place.alias("up"))
        .agg(F.sha2(F.array_join(text, "|").cast("binary"), 256).alias("digest"), F.sum("length").alias("length"))
        .select("shard", F.col("up").alias("place"), "length", "digest")
    )


def tree(replica: DataFrame, height: int, tops: int) -> list[DataFrame]:
    """Levels from leaves to root; ``height`` range levels in a shard, ``tops`` levels over shards."""
    levels = [staged(leaves(replica))]
    levels.append(staged(_parents(levels[0], F.floor(F.col("place") / RANGE))))
    for _ in range(height):
        levels.append(staged(_parents(levels[-1], F.floor(F.col("place") / FANOUT))))
    shards = levels[-1].select(F.lit(0).cast("bigint").alias("shard"), F.col("shard").alias("place"), "length", "digest")
    levels.append(shards)
    for _ in range(tops):
        levels.append(staged(_parents(levels[-1], F.floor(F.col("place") / FANOUT))))
    return levels


def _levels_for(top: int | None) -> int:
    n, top = 0, int(top or 0)
    while top > 0:
        top, n = top // FANOUT, n + 1
    return n


def root(levels: list[DataFrame]) -> str | None:
    row = levels[-1].select("digest").first()
    return row[0] if row else None


def _differing(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Nodes whose digests differ or that one side lacks."""
    x = a.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_list("digest")), "").alias("da"), F.max("length").alias("la"))
    y = b.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_list("digest")), "").alias("db"), F.max("length").alias("lb"))
    return x.join(y, keys, "full").where(~F.col("da").eqNullSafe(F.col("db")))


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """shard, offset, length, other_length, finding of each record that differs."""
    spans = [r.agg(F.max("offset"), F.max("shard")).first() for r in (first, second)]
    height = _levels_for(max((s[0] or 0) for s in spans) // RANGE)
    tops = _levels_for(max((s[1] or 0) for s in spans))
    a, b = tree(first, height, tops), tree(second, height, tops)
    bad = None
    if root(a) != root(b):
        bad = _differing(a[-1], b[-1], NODE).select(*NODE)
        for level in range(len(a) - 2, height + 1, -1):  # over shards
            bad = _descend(a[level], b[level], bad, F.floor(F.col("place") / FANOUT)).select(*NODE)
        # from a shard's place among shards to the shard's own top node
        bad = bad.select(F.col("place").alias("shard"), F.lit(0).cast("bigint").alias("place"))
        for level in range(height, -1, -1):
            wide = RANGE if level == 0 else FANOUT
            found = _descend(a[level], b[level], bad, F.floor(F.col("place") / wide))
            bad = found.select(*NODE)
    else:
        found = _differing(a[0].limit(0), b[0].limit(0), NODE)
    kind = (
        F.when(F.col("db").isNull(), "missing")
        .when(F.col("da").isNull(), "extra")
        .when(F.col("la") != F.col("lb"), "resized")
        .otherwise("changed")
    )
    return found.select("shard", F.col("place").alias("offset"), F.col("la").alias("length"), F.col("lb").alias("other_length"), kind.alias("finding"))


def _descend(a: DataFrame, b: DataFrame, bad: DataFrame, parent: Column) -> DataFrame:
    up = bad.select("shard", F.col("place").alias("up"))
    under = lambda d: d.withColumn("up", parent).join(up, ["shard", "up"], "left_semi").drop("up")
    return staged(_differing(under(a), under(b), NODE))


def damaged(replica: DataFrame) -> DataFrame:
    """A stored copy with bit rot: by digest of the page id a character is replaced, the record is
    cut to half, or it is gone."""
    fate = F.substring(F.md5(F.coalesce(F.col("page_id").cast("string"), F.lit("")).cast("binary")), 9, 2)
    middle = F.floor(F.char_length("record") / 2).cast("int")
    other = F.when(F.substr("record", middle, F.lit(1)) == "x", F.lit("y")).otherwise(F.lit("x"))
    record = (
        F.when(fate == "00", F.overlay("record", other, middle, F.lit(1)))
        .when(fate == "01", F.substr("record", F.lit(1), middle))
        .otherwise(F.col("record"))
    )
    kept = replica.where(fate != "02").withColumn("record", record)
    return kept.withColumn("length", F.octet_length("record").cast("bigint"))


def report(pages: DataFrame) -> DataFrame:
    """Audit of a damaged copy of all pages: page_id and finding of each record that differs."""
    first = staged(records(pages))
    second = staged(damaged(first))
    found = audit(first, second)
    ids = first.select("shard", "offset", "page_id")
    return found.join(ids, ["shard", "offset"], "left").select("page_id", "shard", "offset", "length", "other_length", "finding")


SQL = rf"""
WITH r AS (
  SELECT page_id, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
    || coalesce(CAST(page_id AS VARCHAR), '') || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
    || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '')
    || chr(13) || chr(10) || chr(13) || chr(10) AS record, md5(coalesce(CAST(page_id AS VARCHAR), '')) AS m FROM pages
), n AS (SELECT greatest(1, CAST(ceil(sum(strlen(record)) / {SHARD_BYTES}.0) AS BIGINT)) AS shards FROM r
), s AS (
  SELECT page_id, record, substr(m, 9, 2) AS fate, CAST('0x' || substr(m, 1, 8) AS BIGINT) % shards AS shard FROM r, n
), o AS (
  SELECT *, CAST(coalesce(sum(strlen(record)) OVER (PARTITION BY shard ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM s
)
SELECT page_id, shard, "offset", CAST(strlen(record) AS BIGINT) AS length,
  CAST(CASE fate WHEN '00' THEN strlen(substr(record, 1, CAST(floor(length(record) / 2) AS BIGINT) - 1)) + 1
      + strlen(substr(record, CAST(floor(length(record) / 2) AS BIGINT) + 1))
    WHEN '01' THEN strlen(substr(record, 1, CAST(floor(length(record) / 2) AS BIGINT))) END AS BIGINT) AS other_length,
  CASE fate WHEN '02' THEN 'missing' WHEN '01' THEN 'resized'
    ELSE CASE WHEN ord(substr(record, CAST(floor(length(record) / 2) AS BIGINT), 1)) < 128 THEN 'changed' ELSE 'resized' END END AS finding
FROM o WHERE fate IN ('00', '01', '02')
"""
