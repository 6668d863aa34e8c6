import numpy as np
import pytest

from millrace.operators import clusters as K


def plain(rows, eps, least):
    k, p = np.array([r[0] for r in rows]), np.array([r[1:] for r in rows])
    near = ((p[:, None] - p) ** 2).sum(axis=2) <= eps * eps
    core = near.sum(axis=1) >= least
    label = np.where(core, k, 1 << 60)
    while True:
        new = np.where(core, np.where(near & core, label, 1 << 60).min(axis=1), 1 << 60)
        if (new == label).all():
            break
        label = new
    out = {}
    for i in range(len(k)):
        at = [j for j in np.flatnonzero(near[i] & core)]
        out[int(k[i])] = (int(label[i]), True) if core[i] else (int(label[min(at, key=lambda j: k[j])]) if at else None, False)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_copies_and_cells_about_eps_apart(spark, seed):
    draw = np.random.default_rng(seed)
    # dense spots whose gaps are just under, at and over eps, copies of points, and thin ones between
    spots = [(0.0, 0.0), (1.0, 0.0), (2.04, 0.0), (3.1, 0.1), (3.1, 1.12), (7.0, 7.0)]
    points = [(x + float(a) * 0.06, y + float(b) * 0.06) for x, y in spots for a, b in draw.uniform(-1, 1, (12, 2))]
    points += [(0.0, 0.0)] * 6 + [(9.0, 9.0)] * 4 + [(9.5, 9.0)] * 2 + [tuple(map(float, p)) for p in draw.uniform(-2, 10, (60, 2))]
    rows = [(int(i), *p) for i, p in zip(draw.permutation(len(points)), points, strict=True)]
    got = K.dbscan(spark.createDataFrame(rows, "k long, x double, y double"), "k", "x", "y", 1.0, 5)
    assert {r["k"]: (r["cluster"], r["is_core"]) for r in got.collect()} == plain(rows, 1.0, 5)


def test_no_table_that_grows_is_broadcast(spark):
    df = spark.createDataFrame([(i, float(i % 50), 0.0) for i in range(500)], "k long, x double, y double")
    got = K.dbscan(df, "k", "x", "y", 1.0, 5)
    assert got.count() == 500 and "BroadcastHashJoin" not in got._jdf.queryExecution().executedPlan().toString()
