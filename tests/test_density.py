"""Vector joins, DBSCAN and HDBSCAN against plain versions over all pairs."""

import numpy as np
import pytest

from millrace.operators import density as D
from millrace.operators import neighbours as N


def cloud(seed, n=260, d=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, d)) * 4
    x = centres[rng.integers(0, 5, n)] + rng.normal(size=(n, d)) * rng.choice([0.4, 0.7], (n, 1))
    x = np.concatenate([x, rng.uniform(-9, 9, (n // 8, d)), x[:3], x[:1]])
    return x


def frame(spark, x):
    return spark.createDataFrame([(3 * i + 1, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")


def all_distances(x):
    return np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))


def test_pairs_and_neighbours_equal_all_pairs(spark):
    x = cloud(1)
    cells = N.deal_cells(N.distinct_vectors(frame(spark, x), "id", "v"), 17)
    first = [i for i in range(len(x)) if not any((x[i] == x[j]).all() for j in range(i))]
    d = all_distances(x)
    for eps in (0.0, 0.9, 30.0):
        want = {(3 * i + 1, 3 * j + 1) for i in first for j in first if i < j and d[i, j] <= eps}
        assert {(r["a"], r["b"]) for r in N.pairs_within(cells, eps).collect()} == want
    got = {(r["a"], r["rank"]): (r["b"], r["distance"]) for r in N.nearest(cells, 4).collect()}
    for i in first:
        near = sorted((d[i, j], 3 * j + 1) for j in first if j != i)[:4]
        assert [got[3 * i + 1, k + 1] for k in range(4)] == [(k, w) for w, k in near]


def plain_dbscan(x, eps, least):
    near = all_distances(x) <= eps
    core = near.sum(axis=1) >= least
    label = {i: i for i in np.flatnonzero(core)}
    moved = True
    while moved:
        moved = False
        for i in label:
            low = min(label[j] for j in label if near[i, j])
            moved |= low < label[i]
            label[i] = min(low, label[i])
    out = []
    for i in range(len(x)):
        by = [j for j in label if near[i, j]]
        out.append((3 * i + 1, 3 * label[i if i in label else min(by)] + 1 if by else None, i in label))
    return out


def test_dbscan_equals_a_plain_version(spark):
    x = cloud(2)
    rows = frame(spark, x).unionByName(spark.createDataFrame([(9001, None), (9002, [None, 1.0, 2.0, 3.0, 4.0])], "id long, v array<double>"))
    for eps, least in ((0.9, 5), (1.4, 2)):
        got = D.dbscan_vectors(rows, "id", "v", eps, least, pivots=9).collect()
        assert sorted((tuple(r) for r in got), key=str) == sorted([*plain_dbscan(x, eps, least), (9001, None, False), (9002, None, False)], key=str)
    assert D.dbscan_vectors(rows.limit(0), "id", "v", 1.0, 2).count() == 0


def plain_hdbscan(x, keys, least, samples):
    """Labels (cluster as a set of keys) by the matrix of mutual reachability; edges in order of weight and keys."""
    d = all_distances(x)
    core = np.sort(d, axis=1)[:, samples]
    n = len(x)
    edges = sorted((max(core[i], core[j], d[i, j]), keys[i], keys[j], i, j) for i in range(n) for j in range(i + 1, n))
    root, size, name, small = list(range(n)), [1] * n, [None] * n, [[i] for i in range(n)]
    falls, splits, made = [], [], 0

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for w, _, _, i, j in edges:
        a, b = find(i), find(j)
        if a == b:
            continue
        if size[a] < size[b]:
            a, b = b, a
        lam = 1 / max(w, D.LEAST)
        if name[a] is not None and name[b] is not None:
            splits += [(name[a], made, lam, size[a]), (name[b], made, lam, size[b])]
            name[a], made = made, made + 1
        elif name[a] is not None or size[a] + size[b] >= least:
            if name[a] is None:
                name[a], made = made, made + 1
            falls += [(p, name[a], lam) for p in small[a] + small[b]]
            small[a] = []
        else:
            small[a] += small[b]
        root[b], size[a] = a, size[a] + size[b]
    parent, born = {c: p for c, p, _, _ in splits}, {c: lam for c, _, lam, _ in splits}
    stable = {c: sum(lam - born.get(c, 0) for _, q, lam in falls if q == c) + sum(s * (lam - born.get(c, 0)) for _, q, lam, s in splits if q == c) for c in range(made)}
    best, chosen = {}, set()
    for c in range(made):  # children are made before their parents
        under = [k for k in parent if parent[k] == c]
        total = sum(best[k] for k in under)
        best[c] = max(stable[c], total) if c in parent or not under else total
        if c in parent and (not under or stable[c] >= total):
            chosen.add(c)
    groups = {}
    for p, c, _ in falls:
        top = None
        while c is not None:
            top = c if c in chosen else top
            c = parent.get(c)
        if top is not None:
            groups.setdefault(top, set()).add(keys[p])
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize(("seed", "least", "samples", "limit"), [(3, 10, 2, 20_000), (4, 5, 4, 60)])
def test_hdbscan_equals_a_plain_version(spark, seed, least, samples, limit):
    """In one problem, and in problems that are halved."""
    x = cloud(seed)[:-4]
    rows = frame(spark, x)
    got = D.hdbscan(rows, "id", "v", least, samples, standardize=False, pivots=11, limit=limit).collect()
    groups = {}
    for r in got:
        if r["cluster"] >= 0:
            groups.setdefault(r["cluster"], set()).add(r["id"])
    want = plain_hdbscan(x, [3 * i + 1 for i in range(len(x))], least, samples)
    assert len(got) == len(x) and len(want) > 2 and {frozenset(g) for g in groups.values()} == want
    assert [min(groups[c]) for c in range(len(groups))] == sorted(min(g) for g in want)


def test_hdbscan_of_odd_rows(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(30)] + [(100 + i, [9.0 + i % 2, 2.0]) for i in range(30)] + [(200, None)], "id long, v array<double>")
    got = {r["id"]: r["cluster"] for r in D.hdbscan(same, "id", "v", 10, 2).collect()}
    assert len(got) == 61 and got[200] == -1 and {got[i] for i in range(30)} == {0}
    assert {r["cluster"] for r in D.hdbscan(same.filter("id < 1"), "id", "v").collect()} == {-1}
    assert D.hdbscan(same.limit(0), "id", "v").count() == 0


def test_standardized_components(spark):
    x = cloud(5)
    got = np.array([r["v"] for r in D.standardized(frame(spark, x), "v").orderBy("id").collect()])
    assert np.allclose(got, (x - x.mean(axis=0)) / x.std(axis=0))
    flat = spark.createDataFrame([([1.0],), ([1.0],), (None,)], "v array<double>")
    assert [r["v"] for r in D.standardized(flat, "v").collect()] == [[0.0], [0.0], None]


def test_a_tile_meets_each_tile_once_and_points_go_to_tiles_not_cells(spark):
    x = np.random.default_rng(5).normal(size=(900, 24))  # many dimensions: no cell excludes another
    cells = N.deal_cells(N.distinct_vectors(frame(spark, x), "id", "v"), 60)
    seeking = N.searches(cells, cells.points, N.F.lit(30.0))
    assert seeking.count() == len(x) * N.tiles(cells).chunks[-1] <= 9 * len(x)  # 60 rows a point, when each cell had its own
    d = all_distances(x)
    assert N.pairs_within(cells, 5.0).count() == int((d <= 5.0).sum() - len(x)) // 2
    whole = N.tiles(cells._replace(sizes=np.array([700, 0, 3, 4, 193])))  # a great cell is dealt to chunks
    assert whole.chunks.tolist() == [0, 2, 3]
    assert set(whole.chunk(np.zeros(700, np.int32), np.arange(700)).tolist()) == {0, 1}


def test_a_hierarchy_settled_by_one_task_is_that_of_the_levels(spark):
    rng = np.random.default_rng(6)
    rows = [("c0", None, 0.0)] + [(f"c{i}", f"c{rng.integers(max(0, i - 3), i)}", float(rng.integers(0, 9))) for i in range(1, 40)]
    clusters = spark.createDataFrame(rows, "cluster string, parent string, stability double")
    assert sorted(D.most_stable(clusters).collect()) == sorted(D.most_stable(clusters, few=0).collect())


@pytest.mark.parametrize(("scale", "offset"), [(1.0, 0.0), (1.0, 1e6), (1e-20, 0.0), (1e20, 0.0)])
def test_products_in_single_precision_lose_no_pair(scale, offset):
    rng = np.random.default_rng(7)
    x = (rng.normal(size=(300, 24)) + offset) * scale
    x[200:] = x[:100] + rng.normal(size=(100, 24)) * scale * 1e-3
    x[7] = np.inf
    centre = x[8:40].mean(axis=0) * 0.9
    (left, _, long), (_, right, wide) = N.lifted(x[:150], centre), N.lifted(x[100:], centre)
    s, t = {"x": x[:150], "f": left, "long": long}, {"x": x[100:], "f": right, "long": wide}
    with np.errstate(all="ignore"):
        d = np.sqrt(((x[:150, None] - x[None, 100:]) ** 2).sum(axis=2))
        for radius in (0.0, float(d[20, 120]), float(np.nanmedian(d)), np.where(np.isfinite(d[:, 150]), d[:, 150], 0.0)):
            got = {(a, b) for i, j, far in N.near_pairs(s, t, radius) for a, b, good in zip(i.tolist(), j.tolist(), (far <= np.broadcast_to(radius, 150)[i]).tolist(), strict=True) if good}
            assert got == set(zip(*(v.tolist() for v in np.nonzero(d <= np.broadcast_to(radius, 150)[:, None])), strict=True)) and len(got) >= 50


def test_spans_have_each_row_of_the_needed_cells_once():
    begins = np.cumsum(np.append(0, np.random.default_rng(3).integers(0, 900, 60)))
    for need in (np.arange(60), np.arange(0, 60, 3), np.array([4, 5, 6, 40]), np.array([59])):
        rows = [np.arange(begins[-1])[span] for span in N._spans(begins, need)]
        want = np.concatenate([np.arange(begins[c], begins[c + 1]) for c in need])
        assert sorted(np.concatenate(rows).tolist()) == want.tolist()
        assert max(map(len, rows)) < 2 * N.WIDE


def test_dense_points_are_counted_in_their_own_tile_and_cores_tied_once_a_pair_of_tiles(spark, monkeypatch):
    x = np.random.default_rng(9).normal(size=(900, 24))  # many dimensions: no cell excludes another
    x[-1] += 90.0
    rows, plain = [], D.searches
    monkeypatch.setattr(D, "searches", lambda *a, **b: rows.append((out := plain(*a, **b)).count()) or out)
    got = D.dbscan_vectors(frame(spark, x), "id", "v", 8.0, 4, pivots=60).collect()
    assert {(r["cluster"], r["is_core"]) for r in got if r["id"] < 3 * 899} == {(1, True)} and sum(r["cluster"] is None for r in got) == 1
    assert sum(rows) < 5 * len(x)  # 8 rows a point, when every point met all 4 tiles for its count and again for its links


def test_places_of_searches_deal_every_pair_of_tiles_once(spark):
    x = np.random.default_rng(5).normal(size=(900, 24))
    cells = N.deal_cells(N.distinct_vectors(frame(spark, x), "id", "v"), 60)
    met = {p: [(r["k"], r["s"], r["t"]) for r in N.searches(cells, cells.points, N.F.lit(30.0), place=p).select("k", "s", "t").collect()] for p in (None, "own", "others", "from", "later")}
    assert sorted(met["own"] + met["others"]) == sorted(met[None]) and sorted(met["own"] + met["later"]) == sorted(met["from"])
    assert all(s == t for _, s, t in met["own"]) and all(s < t for _, s, t in met["later"]) and len(set(met[None])) == len(met[None])
