"""Exact integer k-means whose nearest-centroid search runs in the Walsh-Hadamard domain.

Vectors of 64 components become integers floor(1024 * x).  Their Walsh-Hadamard transform has
integer coefficients and keeps squared distances up to the factor 64, so all is exact.

* **Transform.** Each vector is transformed once, its coefficients put in order of sequency
  (number of sign changes: coarse to fine) and written; every round reads only them.
* **Progressive search.** Squared coefficient differences are added up block by block, coarse
  to fine.  The partial sum is a lower bound of 64 times the distance.  After the first block
  the leading centroid of each vector is finished at once; a centroid whose partial sum is
  strictly above that distance can neither win nor tie and is dropped.  What survives all
  blocks has all 64 coefficients, and the smaller number wins ties.
* **Update.** The transform is linear: a task adds up the coefficients of each cluster, Spark
  adds up the tasks (k x 64 sums, a fixed number), and the inverse transform of the total is the
  exact sum of the vectors.  Only these sums and the k centroids pass through the driver.

Defined cases: a vector is kept when it has exactly 64 components, none null, NaN or infinite, and
none of absolute value 131072 or more (its squared distance could leave the range of a long);
others are in no cluster and not in the result.  With fewer kept vectors than centroids there
are as many centroids as vectors; no vector gives no row.  A null vec_id counts as the empty id
where the first centroids are chosen; rows that repeat an id are vectors of their own, and equal
hashes are put in order of the components.  Only the two named columns are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barledger.llm.common import staged

DIMENSIONS = 64
SCALE = 1024
CLUSTERS, ROUNDS = 8, 10
SEED = 3
#: Coefficients known after each step of the search.
STEPS = (4, 16, 36, DIMENSIONS)
#: Scaled components at or beyond it are left out; from NARROW on, coefficients need 64 bits.
LIMIT, NARROW = 1 << 27, 1 << 23
#: Vectors handled at once inside a task.
BLOCK = 16_384


def _natural() -> np.ndarray:
    """The Hadamard matrix in natural order."""
    h = np.ones((1, 1), np.int64)
    while len(h) < DIMENSIONS:
        h = np.block([[h, h], [h, -h]])
    return h


#: Rows of the natural order, from few sign changes to many.
SEQUENCY = np.argsort((_natural()[:, 1:] != _natural()[:, :-1]).sum(1), kind="stable")


def walsh() -> np.ndarray:
    """The 64 x 64 matrix of +1 and -1, rows in order of sequency."""
    return _natural()[SEQUENCY]


def transform(v: np.ndarray) -> np.ndarray:
    """Coefficients of the rows of ``v`` by butterflies, in order of sequency."""
    out, n, width = np.array(v), len(v), 1
    while width < DIMENSIONS:
        pairs = out.reshape(n, DIMENSIONS // (2 * width), 2, width)
        out = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), 2)
        width *= 2
    return out.reshape(n, DIMENSIONS)[:, SEQUENCY]


def nearest(w: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid (smallest number on ties) and squared distance of each coefficient row."""
    n, k = len(w), len(c)
    part = np.zeros((n, k), w.dtype)
    alive = np.ones((n, k), bool)
    best = None
    done = 0
    for upto in STEPS:
        i, j = np.nonzero(alive)
        part[i, j] += ((w[i, done:upto] - c[j, done:upto]) ** 2).sum(1)
        done = upto
        if best is None:
            lead = part.argmin(1)
            best = part[np.arange(n), lead] + ((w[:, upto:] - c[lead, upto:]) ** 2).sum(1)
        alive &= part <= best[:, None]
    # A dropped centroid is strictly worse; a survivor holds its full distance.
    far = part.max() + 1 if n else 0
    full = np.where(alive, part, far)
    chosen = full.argmin(1)
    return chosen, full[np.arange(n), chosen] // DIMENSIONS


def _coefficients(batches):
    """Kept vectors as coefficients: 4 bytes each, 8 where the components are large."""
    import pyarrow as pa

    for batch in batches:
        for lo in range(0, len(batch), BLOCK):
            part = batch.slice(lo, BLOCK)
            column = part.column("v")
            flat_values = column.flatten()
            values = flat_values.to_numpy(zero_copy_only=False).astype(np.float64)  # null: NaN
            size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            start = np.cumsum(size) - size
            rows = np.flatnonzero(size == DIMENSIONS)
            v = values[start[rows, None] + np.arange(DIMENSIONS)]
            with np.errstate(over="ignore", invalid="ignore"):
                v = np.floor(v * SCALE)
                ok = (np.abs(v) < LIMIT).all(1)
            rows, v = rows[ok], v[ok].astype(np.int64)
            w = transform(v)
            wide = np.abs(v).max(1, initial=0) >= NARROW
            body = [x.tobytes() if big else x.astype(np.int32).tobytes() for x, big in zip(w, wide)]
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id").take(pa.array(rows)), pa.array(body, pa.binary())], names=["vec_id", "w"]
            )


def _blocks(batch):
    """(rows, coefficients) of a batch; large ones as exact Python integers."""
    bodies = batch.column("w").to_pylist()
    size = np.array([len(b) for b in bodies], np.int64)
    for bytes_, kind in ((4, np.int32), (8, np.int64)):
        rows = np.flatnonzero(size == bytes_ * DIMENSIONS)
        for lo in range(0, len(rows), BLOCK):
            at = rows[lo : lo + BLOCK]
            w = np.frombuffer(b"".join(bodies[i] for i in at), kind).reshape(-1, DIMENSIONS)
            yield at, w.astype(np.int64 if bytes_ == 4 else object)


def _matching(c: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    exact = w.dtype == object or np.abs(c).max(initial=0) >= NARROW * DIMENSIONS
    return nearest(w.astype(object), c.astype(object)) if exact else nearest(w, c)


def _sums(c: np.ndarray):
    """(cluster, dimension, sum) of a partition; dimension -1 is the count."""

    def run(batches):
        import pyarrow as pa

        total = np.zeros((len(c), DIMENSIONS), object)
        count = np.zeros(len(c), np.int64)
        for batch in batches:
            for _, w in _blocks(batch):
                chosen, _ = _matching(c, w)
                for j in np.unique(chosen):
                    mine = w[chosen == j]
                    total[j] += mine.sum(0).astype(object)
                    count[j] += len(mine)
        cells = [(j, i, str(total[j, i])) for j in np.flatnonzero(count) for i in range(DIMENSIONS)]
        cells += [(j, -1, str(count[j])) for j in np.flatnonzero(count)]
        kinds = (pa.int32(), pa.int32(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(list(zip(*cells)) or [()] * 3, kinds)], names=["cluster", "i", "s"])

    return run


def _assigned(c: np.ndarray):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            cluster, distance = np.zeros(len(batch), np.int32), np.zeros(len(batch), np.int64)
            for at, w in _blocks(batch):
                cluster[at], distance[at] = _matching(c, w)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return run


def first_centroids(vectors: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """Coefficients of the vectors whose seeded id hash is smallest, in that order."""
    label = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = vectors.select(F.sha2(label, 256).alias("hash"), "w").orderBy("hash", "w").limit(clusters).collect()
    kinds = {4 * DIMENSIONS: np.int32, 8 * DIMENSIONS: np.int64}
    found = [np.frombuffer(bytes(r["w"]), kinds[len(r["w"])]).astype(np.int64) for r in rows]
    return np.array(found, np.int64).reshape(len(rows), DIMENSIONS)


def moved(c: np.ndarray, sums: list) -> np.ndarray:
    """Centroids after a round: floor(sum / count) of each non-empty cluster, as coefficients."""
    basis = walsh().astype(object)
    out = c.copy()
    for j in {r["cluster"] for r in sums}:
        cell = {r["i"]: int(r["s"]) for r in sums if r["cluster"] == j}
        total = np.array([cell[i] for i in range(DIMENSIONS)], object)
        mean = (total @ basis) // DIMENSIONS // cell[-1]  # the first division has no remainder
        out[j] = transform(mean.astype(np.int64)[None])[0]
    return out


def components(c: np.ndarray) -> list[list[int]]:
    return [[int(x) // DIMENSIONS for x in row.astype(object) @ walsh().astype(object)] for row in c]


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance) per kept vector, and the centroids' components.

    ``vectors`` has vec_id and embedding (an array of a numeric type).
    """
    held = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    held = staged(held.where(F.size("v") == DIMENSIONS).mapInArrow(_coefficients, "vec_id bigint, w binary"))
    c = first_centroids(held, clusters, seed)
    for _ in range(rounds if len(c) else 0):
        sums = held.mapInArrow(_sums(c), "cluster int, i int, s string").groupBy("cluster", "i")
        c = moved(c, sums.agg(F.sum(F.col("s").cast("decimal(28,0)")).alias("s")).collect())  # 65 rows a cluster
    if not len(c):
        return held.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")).where("false"), []
    return staged(held.mapInArrow(_assigned(c), "vec_id bigint, cluster int, distance bigint")), components(c)


def report(embeddings: DataFrame) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 per kept vector."""
    found, centroids = cluster(embeddings)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    whole = F.sum(F.col("distance").cast("decimal(20,0)"))
    each = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(whole.alias("s")).collect()}  # a row a cluster
    name = found.sparkSession.createDataFrame(
        [(j, each.get(j, 0), sum(each.values()), d) for j, d in enumerate(digest)],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    return found.join(F.broadcast(name), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
