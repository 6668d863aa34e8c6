"""Hashes of grids against numpy, and structural similarity against plain windows and the sequential leader rule."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import images as I
from millrace.operators import similarity as S
from millrace.operators.vectors import hamming_pairs


def boxes(grid, h, w):
    rows, columns = grid.shape
    cut = lambda n, size, i: slice(i * size // n, max(i * size // n + 1, (i + 1) * size // n))
    return np.array([[grid[cut(h, rows, i)][:, cut(w, columns, j)].mean() for j in range(w)] for i in range(h)])


def plain_bits(grid, name, size=8):
    if name == "average_hash":
        values = boxes(grid, size, size)
        return (values > values.mean()).ravel()
    if name == "dhash":
        values = boxes(grid, size, size + 1)
        return (values[:, 1:] > values[:, :-1]).ravel()
    n = 4 * size
    basis = np.array([[2 * np.cos(np.pi * k * (2 * i + 1) / (2 * n)) for i in range(n)] for k in range(size)])
    low = basis @ boxes(grid, n, n) @ basis.T
    return (low > np.median(low)).ravel()


@pytest.mark.parametrize("name", I.HASHES)
def test_hashes_equal_numpy(spark, name):
    rng = np.random.default_rng(3)
    grids = [rng.integers(0, 256, shape).astype(float) for shape in ((8, 8), (40, 33), (64, 100), (9, 32))]
    df = spark.createDataFrame([(i, g.tolist()) for i, g in enumerate(grids)] + [(8, None), (9, [])], "id long, g array<array<double>>")
    for size in (8, 4):
        got = {r["id"]: r["h"] for r in df.select("id", I.perceptual_hash(F.col("g"), name, size).alias("h")).collect()}
        for i, g in enumerate(grids):
            want = int("".join("01"[int(b)] for b in plain_bits(g, name, size)), 2)
            assert got[i] == want - (1 << 64 if want >> 63 else 0)
        assert got[8] is None and got[9] is None


def test_hashes_meet_in_joins(spark):
    rng = np.random.default_rng(4)
    basis = np.array([np.cos(np.pi * k * (2 * np.arange(48) + 1) / 96) for k in range(8)])
    terms = [rng.normal(size=(8, 8)) * 9 for _ in range(2)]
    wave = lambda p: 128 + basis.T @ terms[int(p > 0)] @ basis
    df = spark.createDataFrame([(1, wave(0).tolist()), (2, (wave(0) + 0.1 * rng.normal(size=(48, 48))).tolist()), (3, wave(1.3).tolist())], "id long, g array<array<double>>")
    for name in I.HASHES:
        hashed = df.select("id", I.perceptual_hash(F.col("g"), name).alias("h"))
        turned = hashed.withColumn("h", F.when(F.col("id") == 2, F.col("h").bitwiseXOR(F.lit(1 << 40 | 5))).otherwise(F.col("h")))  # equal hashes are one class
        pairs = hamming_pairs(turned, "id", F.col("h"), 8).collect()
        assert {(r["k_a"], r["k_b"]) for r in pairs} == {(1, 2)} and all(1 <= r["distance"] <= 8 for r in pairs)
    with pytest.raises(ValueError, match="unknown hash"):
        I.perceptual_hash(F.col("g"), "whash")


def plain_ssim(a, b, n=7):
    out = []
    for i in range(a.shape[0] - n + 1):
        for j in range(a.shape[1] - n + 1):
            x, y = a[i : i + n, j : j + n].ravel(), b[i : i + n, j : j + n].ravel()
            c = np.cov(x, y)
            out.append((2 * x.mean() * y.mean() + S.C1) * (2 * c[0, 1] + S.C2) / ((x.mean() ** 2 + y.mean() ** 2 + S.C1) * (c[0, 0] + c[1, 1] + S.C2)))
    return np.mean(out)


def pictures(seed, n=24, size=16):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        base = np.kron(rng.uniform(0, 255, (4, 4)), np.ones((size // 4, size // 4))) * rng.choice([0.02, 0.3, 1.0])
        out += [np.clip(base + rng.normal(size=base.shape) * s, 0, 255) for s in rng.choice([0.0, 1.0, 4.0, 12.0], 3)]
    return [out[i] for i in rng.permutation(len(out))]


def test_similarity_equals_plain_windows():
    for a, b in zip(pictures(1, 6), pictures(2, 6), strict=True):
        assert abs(S.ssim(a[None], b[None])[0] - plain_ssim(a, b)) < 1e-9


@pytest.mark.parametrize("threshold", [0.3, 0.92, 0.99])
def test_keys_lose_no_pair(threshold):
    x = np.array(pictures(3, 40))
    keys = S.image_keys(x)
    reach = [S.key_reach(threshold, float(np.log((255.0**2 + c / 2) / (c / 2)))) for c in (S.C1, S.C2)]
    i, j = np.triu_indices(len(x), 1)
    similar = S.ssim(x[i], x[j]) >= threshold
    near = (np.abs(keys[i] - keys[j]) <= reach).all(axis=1)
    assert similar.any() and not (similar & ~near).any() and near.mean() < (1.01 if threshold < 0.9 else 0.7)


def test_leaders_equal_the_sequential_rule(spark):
    x = pictures(5)
    x += [x[0], x[7]]
    rows = [(2 * i, g.tolist()) for i, g in enumerate(x)] + [(901, None), (903, [[1.0]])]
    df = spark.createDataFrame(rows, "id long, g array<array<double>>")
    want, free = {901: 901, 903: 903}, list(range(len(x)))
    while free:
        lead = free.pop(0)
        taken = [i for i in free if (x[i] == x[lead]).all() or plain_ssim(x[lead], x[i]) >= 0.92]
        want |= {2 * lead: 2 * lead} | {2 * i: 2 * lead for i in taken}
        free = [i for i in free if i not in taken]
    got = {r["id"]: r["leader"] for r in S.ssim_leaders(df, "id", "g", 16, 16).collect()}
    assert got == want and len(set(want.values())) < len(x)
    assert S.ssim_leaders(df.limit(0), "id", "g", 16, 16).count() == 0


def test_rough_similarity_of_all_pairs_is_that_of_each_pair():
    import numpy as np

    from millrace.operators.similarity import rough_ssim, ssim

    draw = np.random.default_rng(3)
    a, b = draw.uniform(0, 255, (9, 8, 11)), draw.uniform(0, 255, (6, 8, 11))
    b[:4] = a[:4] + draw.normal(0, 3, (4, 8, 11))
    b[4] = 100.0
    exact = np.stack([ssim(np.repeat(a[i : i + 1], len(b), axis=0), b) for i in range(len(a))])
    assert np.abs(rough_ssim(a, b) - exact).max() < 1e-9


def test_points_of_images_lose_no_pair_and_part_unlike_ones_of_equal_light():
    rng = np.random.default_rng(8)
    x = np.array(pictures(3, 40))
    x = np.concatenate([x, -x[:20], x[:20] - 128])
    i, j = np.triu_indices(len(x), 1)
    for threshold in (0.3, 0.92, 0.99):
        similar = S.ssim(x[i], x[j]) >= threshold
        for points in (S.image_points(x), S.shortened(S.image_points(x), np.linalg.svd(S.image_points(x[::9]), full_matrices=False)[2][:12].T)):
            assert np.allclose((points**2).sum(axis=1), 1)
            apart = np.linalg.norm(points[i] - points[j], axis=1)
            assert similar.any() and not (similar & (apart > S.point_reach(threshold, 100))).any()
    noise = 128 + 20 * rng.normal(size=(200, 8, 8))  # light and contrast tell none of these apart
    keys, points = S.image_keys(noise), S.image_points(noise)
    i, j = np.triu_indices(len(noise), 1)
    assert (np.abs(keys[i] - keys[j]) <= S.key_reach(0.92, 20.0)).all(axis=1).mean() > 0.9
    assert (np.linalg.norm(points[i] - points[j], axis=1) <= S.point_reach(0.92, 4)).mean() == 0


def test_images_that_are_not_finite_have_no_pairs_and_hide_none(spark):
    x = pictures(9, 6)
    odd = [np.where(np.arange(256).reshape(16, 16) == 5, v, x[0]) for v in (np.nan, np.inf)]
    rows = [(2 * i, g.tolist()) for i, g in enumerate(x)] + [(901 + 2 * i, g.tolist()) for i, g in enumerate(odd)] + [(1001, x[2].tolist())]
    df = spark.createDataFrame(rows, "id long, g array<array<double>>")
    got = {r["id"]: r["leader"] for r in S.ssim_leaders(df, "id", "g", 16, 16).collect()}
    plain = {r["id"]: r["leader"] for r in S.ssim_leaders(df.filter("id not in (901, 903)"), "id", "g", 16, 16).collect()}
    assert got == plain | {901: 901, 903: 903} and got[1001] == got[4] and len(set(plain.values())) < len(x)
