"""Shared helpers: tables, staged results, row keys, connected groups."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barledger.sources.staging import shared_dir, staged

__all__ = ["carried", "components", "doc_key", "restored", "shared_dir", "ship", "staged", "table", "text_or_empty"]

#: Stands for a null doc_id inside keys; it sorts before every other id.
NO_ID = -(2**63)
#: Rounds of contraction after which a graph of any size has converged (each at least halves it).
MAX_ROUNDS = 64


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers once, where they cannot import it themselves.

    The archive is a file of the driver alone; Spark's file server hands it to the executors.
    """
    import barledger

    sc = spark.sparkContext
    if getattr(sc, "_barledger_sent", False):
        return
    root = os.path.dirname(os.path.abspath(barledger.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="spark-"), "barledger.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("barledger", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._barledger_sent = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def doc_key(id_column: str = "doc_id", text_column: str = "text") -> Column:
    """Identity of a row: (doc_id, hash of its text).

    Rows that repeat an id with another text stay apart; rows repeated whole are one text.
    The smallest key of a set belongs to its smallest doc_id.
    """
    return F.struct(
        F.coalesce(F.col(id_column), F.lit(NO_ID)).cast("bigint").alias("d"),
        F.xxhash64(text_or_empty(text_column)).alias("h"),
    )


def carried(docs: DataFrame) -> DataFrame:
    """``docs`` as (node, row): the row's key beside all its columns in one struct.

    Columns that an operator adds cannot clash with those of the table; ``restored`` undoes it.
    """
    return docs.select(doc_key().alias("node"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def restored(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from the struct ``row``."""
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def _forest(batches):
    """Union-find inside one partition: its edges become (node, smallest node reached)."""
    import pyarrow as pa

    parent: dict[tuple, tuple] = {}

    def find(x):
        root = x
        while parent[root] != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    schema = None
    for batch in batches:
        schema = batch.schema
        cols = [batch.column(i).to_pylist() for i in range(4)]
        for a, b in zip(zip(cols[0], cols[1]), zip(cols[2], cols[3])):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            ra, rb = find(a), find(b)
            if ra != rb:
                lo, hi = (ra, rb) if ra < rb else (rb, ra)
                parent[hi] = lo
    rows = [(*x, *find(x)) for x in parent if find(x) != x]
    for i in range(0, len(rows), 50_000):
        part = list(zip(*rows[i : i + 50_000]))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in part], schema=schema)


def components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from each node of ``edges`` (a, b: structs d, h).

    Each round replaces the edges of every partition by a union-find forest, hangs each node
    on its smallest neighbour, jumps pointers and contracts what is left.  Only counts reach
    the driver.  Returns (node, root), nodes that are their own root included.
    """
    flat = "ad bigint, ah bigint, bd bigint, bh bigint"
    todo = edges.select(
        F.col("a.d").alias("ad"), F.col("a.h").alias("ah"), F.col("b.d").alias("bd"), F.col("b.h").alias("bh")
    )
    labels: DataFrame | None = None
    for _ in range(MAX_ROUNDS):
        forest = todo.mapInArrow(_forest, flat).select(
            F.struct(F.col("ad").alias("d"), F.col("ah").alias("h")).alias("a"),
            F.struct(F.col("bd").alias("d"), F.col("bh").alias("h")).alias("b"),
        )
        forest = staged(forest)
        both = forest.unionByName(forest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        up = staged(up.select("node", F.least("node", "m").alias("root")))
        for _ in range(2):
            nxt = up.select(F.col("node").alias("root"), F.col("root").alias("above"))
            up = up.join(nxt, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
        up = staged(up)
        if labels is None:
            labels = up
        else:
            step = up.select(F.col("node").alias("root"), F.col("root").alias("above"))
            labels = labels.join(step, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
        labels = staged(labels)
        at_a = up.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        at_b = up.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        left = forest.join(at_a, "a").join(at_b, "b").where("ra != rb")
        left = staged(left.select(F.col("ra.d").alias("ad"), F.col("ra.h").alias("ah"), F.col("rb.d").alias("bd"), F.col("rb.h").alias("bh")).distinct())
        if left.isEmpty():
            return labels
        todo = left
    raise RuntimeError(f"The graph did not converge in {MAX_ROUNDS} rounds.")
