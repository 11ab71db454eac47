import hashlib
import random

import numpy as np
import pytest

from barledger.llm import centroids as ce

SCHEMA = "vec_id long, embedding array<double>, cluster string, w int"


def brute(rows):
    kept = []
    for d, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v):
            kept.append((d, [int(np.floor(1024 * x)) for x in v]))
    digest = lambda d: hashlib.sha256(f"3:{'' if d is None else d}".encode()).hexdigest()
    c = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:8]]
    far = lambda v, y: sum((a - b) ** 2 for a, b in zip(v, y))

    def assign():
        return [min((far(v, y), j) for j, y in enumerate(c)) for _, v in kept]

    for _ in range(10):
        at = assign()
        for j in range(len(c)):
            mine = [v for (_, v), (_, k) in zip(kept, at) if k == j]
            if mine:
                c[j] = [sum(x) // len(mine) for x in zip(*mine)]
    at = assign()
    total = sum(d for d, _ in at)
    out = []
    for (i, _), (d, j) in zip(kept, at):
        inside = sum(x for x, k in at if k == j)
        out.append((i, j, d, inside, total, hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()))
    return sorted(out, key=repr)


def corpus(scale=1.0):
    rng = random.Random(8)
    centre = [[rng.uniform(-1, 1) * scale for _ in range(64)] for _ in range(5)]
    rows = [(i, [x + rng.gauss(0, 0.3) * scale for x in centre[i % 5]]) for i in range(150)]
    rows += [(900, rows[0][1])] * 30 + [(None, rows[1][1]), (901, [0.0] * 64), (902, [-0.00001] * 64)]
    bad = [(1000, None), (1001, []), (1002, [1.0] * 63), (1003, [1.0] * 65), (1004, [None] + [1.0] * 63), (1005, [float("nan")] + [1.0] * 63)]
    return rows + bad + [(1006, [float("inf")] + [1.0] * 63)]


@pytest.mark.parametrize("scale", [1.0, 30_000.0])
def test_clusters_equal_brute_force(spark, scale):
    rows = corpus(scale)
    got = ce.report(spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(3))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert dict(got.dtypes)["cluster"] == "int" and dict(got.dtypes)["inertia"] == "bigint"
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_few_and_no_vectors(spark):
    frame = lambda rows: spark.createDataFrame([(*r, "", 0) for r in rows], SCHEMA)
    few = [(i, [float(i)] * 64) for i in range(3)]
    assert sorted((tuple(r) for r in ce.report(frame(few)).collect()), key=repr) == brute(few)
    assert ce.report(frame([])).collect() == []
    assert ce.report(frame([(1, [1.0])])).collect() == []
    assert ce.report(frame([(1, [200_000.0] * 64)])).collect() == []  # outside the stated range


def test_transform_is_the_matrix_in_order_of_sequency():
    m = ce.walsh()
    assert [(row[1:] != row[:-1]).sum() for row in m] == list(range(64))
    v = np.random.default_rng(1).integers(-2000, 2000, (9, 64))
    assert (ce.transform(v) == v @ m.T).all()
    assert ce.components(ce.transform(v)) == v.tolist()


def test_progressive_search_drops_and_keeps_ties():
    rng = np.random.default_rng(2)
    c = rng.integers(-500, 500, (8, 64))
    c[5] = c[2]
    v = np.concatenate((c, rng.integers(-500, 500, (200, 64)), (c[1:2] + c[3:4]) // 2))
    chosen, distance = ce.nearest(ce.transform(v), ce.transform(c))
    full = ((v[:, None] - c[None]) ** 2).sum(2)
    assert (chosen == full.argmin(1)).all() and (distance == full.min(1)).all()
