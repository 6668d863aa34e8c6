"""Small tables with ties, nulls, boundaries and order."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import geometry as G
from millrace.functions import text as T
from millrace.functions.vector import cosine, hamming
from millrace.operators import records as R
from millrace.operators import rounds as P
from millrace.operators import sampling as S
from millrace.operators import timeline as L
from millrace.operators import vectors as V
from millrace.plans.stages import Stage, StageGraph
from millrace.sources import files


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_segments_at_the_gap_join_and_contained_ones_shorten(spark):
    data = [(1, "a", 0.0, 1.0), (1, "a", 1.3, 2.0), (1, "a", 2.5, 3.0), (1, "b", 3.1, 4.0), (1, "a", 4.1, 9.0), (1, "a", 4.5, 5.0), (2, "a", 0.0, 1.0)]
    df = spark.createDataFrame(data, "g int, label string, s double, e double")
    got = rows(L.merge_segments(df, ["g"], "label", "s", "e", 0.3000001), "g", "label", "s", "e", "parts")
    assert got == [(1, "a", 0.0, 2.0, 2), (1, "a", 2.5, 3.0, 1), (1, "a", 4.1, 5.0, 2), (1, "b", 3.1, 4.0, 1), (2, "a", 0.0, 1.0, 1)]
    assert L.merge_segments(df.limit(0), ["g"], "label", "s", "e", 0.3).count() == 0


def test_range_join_includes_both_ends(spark):
    points = spark.createDataFrame([(1, x) for x in (-3, 0, 5, 10, 11, 25)], "k int, at long")
    spans = spark.createDataFrame([(1, 7, 0, 10), (1, 8, 10, 25), (1, 9, 5, 4)], "k int, id int, lo long, hi long")
    assert rows(L.range_join(points, spans, ["k"], "at", "lo", "hi", 7), "id", "at") == [(7, 0), (7, 5), (7, 10), (8, 10), (8, 11), (8, 25)]


def test_first_record_of_a_key_wins_and_null_is_one_key(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, v int")
    b = spark.createDataFrame([("x", 3), (None, 4), ("y", 5)], "k string, v int")
    assert sorted(R.merge_records([a, b], ["k"], ["v"]).collect(), key=str) == sorted(spark.createDataFrame([("x", 1), (None, 2), ("y", 5)], "k string, v int").collect(), key=str)
    with pytest.raises(ValueError, match="missing"):
        R.require_columns(a, ["k", "nope"])


def test_quota_fills_from_the_rest(spark):
    df = spark.createDataFrame([(i, "a" if i < 6 else "b", 10 - i) for i in range(8)], "id int, c string, v int")
    got = rows(S.category_quota(df, "c", {"a": 0.5, "z": 0.5}, [F.desc("v"), F.col("id")], 4), "id", "chosen")
    assert got == [(0, "quota"), (1, "quota"), (2, "fill"), (3, "fill")]


def test_positions_are_gapless_over_ranges(spark):
    df = spark.createDataFrame([(i * 7 % 101, None if i % 3 == 0 else i % 2) for i in range(101)], "x int, g int")
    assert rows(P.positions(df, ["x"], "at", 5), "x", "at") == [(i, i) for i in range(101)]
    got = P.positions(df, ["x"], "at", 4, ["g"]).groupBy("g").agg(F.count("*").alias("n"), F.countDistinct("at").alias("d"), F.max("at").alias("m")).collect()
    assert len(got) == 3 and all(r["n"] == r["d"] == r["m"] + 1 for r in got)
    assert P.positions(df.limit(0), ["x"], "at").count() == 0


def test_positions_of_many_rows_with_a_column_that_is_not_read(spark):
    df = spark.range(4_000_000).select((F.col("id") * 48271 % 4_000_037).alias("x"), F.sha1(F.col("id").cast("string")).alias("unread"))
    got = P.positions(df, ["x"], "at").agg(F.count("*").alias("n"), F.countDistinct("at").alias("d"), F.max("at").alias("m")).first()
    assert tuple(got) == (4_000_000, 4_000_000, 3_999_999)


def test_quantiles_interpolate(spark):
    import numpy as np

    data = [("a", float(i * i % 37)) for i in range(50)] + [("b", 1.0)] * 9 + [("b", 5.0), (None, 2.0), ("a", None)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {(r["g"], r["share"]): r["quantile"] for r in P.quantiles(df, ["g"], "v", [0.0, 0.3, 0.95], 5).collect()}
    for g in ("a", "b", None):
        own = [v for k, v in data if k == g and v is not None]
        assert [round(got[g, s], 9) for s in (0.0, 0.3, 0.95)] == [round(float(np.percentile(own, 100 * s)), 9) for s in (0.0, 0.3, 0.95)]


def test_quantiles_of_uneven_values(spark):
    import numpy as np

    data = [0.0] * 30 + [2.0**-i for i in range(0, 300, 9)] + [1e300, -1e300, 5.0, 5.0, float("nan")]
    df = spark.createDataFrame([(v,) for v in data], "v double")
    got = {r["share"]: r["quantile"] for r in P.quantiles(df, [], "v", [0.01, 0.5, 0.77, 1.0], 8).collect()}
    own = [v for v in data if v == v]
    assert all(np.isclose(got[s], np.percentile(own, 100 * s), rtol=1e-12) for s in got) and len(got) == 4
    assert P.quantiles(df.limit(0), [], "v", [0.5]).count() == 0


def test_means_do_not_depend_on_the_order(spark):
    df = spark.createDataFrame([(0.1 * (i % 7), None) for i in range(1000)], "a double, b double")
    means = {tuple((r["metric"], r["mean"]) for r in R.describe(df.repartition(n).orderBy("a" if n % 2 else "b"), ["a", "b"]).orderBy("metric").collect()) for n in (1, 2, 5)}
    assert len(means) == 1 and dict(means.pop())["b"] is None


def test_rows_without_words_have_no_fingerprint(spark):
    from millrace.operators import vectors as V

    df = spark.createDataFrame([(1, "g", "a b c"), (2, "g", None), (3, "g", " "), (4, "g", "c b a a"), (5, None, "a b c"), (6, None, "a b c")], "id long, g string, text string")
    prints = V.fingerprints(df, "text")
    assert {r["id"] for r in prints.filter("bits is null").collect()} == {2, 3} and prints.select("bits").distinct().count() == 2
    assert rows(V.first_wins(prints, "g", "id", "bits", 3, 60), "id", "duplicate_of") == [(1, None), (2, None), (3, None), (4, 1), (5, None), (6, 5)]


def test_components_equal_union_find(spark):
    links = [(i, i + 1) for i in range(20)] + [(50, x) for x in range(51, 60)] + [(70, 70), (3, 1)]
    got = {r["node"]: r["component"] for r in P.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(21)} | {i: 50 for i in range(50, 60)} | {70: 70}


def test_gap_rule(spark):
    df = spark.createDataFrame([("g", i, float(i)) for i in range(10)], "g string, at long, score double")
    assert rows(S.greedy_gap(df, "g", "at", "score", 4, 4), "at") == [(1,), (5,), (8,), (9,)]


def near_hashes(n, most):
    import random

    rnd = random.Random(3)
    bases = [rnd.getrandbits(63) for _ in range(n)]
    return [b ^ sum(1 << p for p in rnd.sample(range(63), d)) for b in bases for d in (0, 0, *range(1, most, 2))]


def test_hamming_bands_lose_no_pair(spark):
    hashes = near_hashes(5, 9)
    df = spark.createDataFrame(list(enumerate(hashes)), "k int, h long")
    first = {}
    for k, h in enumerate(hashes):
        first.setdefault(h, k)
    for distance in (0, 3, 4, 8, 12):
        want = sorted((a, b) for x, a in first.items() for y, b in first.items() if a < b and (x ^ y).bit_count() <= distance)
        assert rows(V.hamming_pairs(df, "k", F.col("h"), distance), "k_a", "k_b") == want


def test_first_wins_depends_on_kept_rows_only(spark):
    df = spark.createDataFrame([("g", 1, 0b0), ("g", 2, 0b11), ("g", 3, 0b1111), ("h", 4, 0b0)], "g string, k long, h long")
    assert {r["k"]: r["duplicate_of"] for r in V.first_wins(df, "g", "k", "h", 2).collect()} == {1: None, 2: 1, 3: None, 4: None}


def test_greedy_rules_equal_the_sequential_ones(spark):
    import random

    rnd = random.Random(6)
    hashes = near_hashes(6, 13)
    rnd.shuffle(hashes)
    data = [("gh"[i % 2], i, h) for i, h in enumerate(hashes)]
    df = spark.createDataFrame(data, "g string, k long, h long")
    for distance in (3, 8, 12):
        kept, want = [], {}
        for g, k, h in data:
            want[k] = next((k2 for g2, k2, h2 in kept if g2 == g and (h ^ h2).bit_count() <= distance), None)
            if want[k] is None:
                kept.append((g, k, h))
        assert {r["k"]: r["duplicate_of"] for r in V.first_wins(df, "g", "k", "h", distance).collect()} == want
        assert {r["k"]: r["leader"] for r in V.leader_clusters(df, "g", "k", "h", distance).collect()} == {k: k if v is None else v for k, v in want.items()}
    picks = {g: [] for g in "gh"}
    for g, own in picks.items():
        left = [(k, h) for g2, k, h in data if g2 == g]
        for _ in range(5):
            own.append(max(left, key=lambda r, own=own: (min(((r[1] ^ h).bit_count() for _, h in own), default=0), -r[0])))
            left.remove(own[-1])
    got = V.farthest_points(df, "g", "k", "h", 5).orderBy("g", "pick").collect()
    assert [(r["g"], r["k"]) for r in got] == [(g, k) for g in "gh" for k, _ in picks[g]]


def test_merge_suggestions_contain_at_any_place(spark):
    data = [("ring", 100), ("small ring", 90), ("ringlet", 80), ("tiny", 1), ("odd", 2), ("noise", 1), ("noise ring", 60)]
    df = spark.createDataFrame(data, "name string, n long")
    got = [tuple(r) for r in R.merge_suggestions(df, "name", "n", 10).collect()]
    assert got == [("noise ring", "ring", 0.7), ("ring", "ringlet", 0.7), ("ring", "small ring", 0.7), ("odd", "tiny", 0.5)]


def test_text_functions(spark):
    df = spark.createDataFrame([(t,) for t in ("", "   ", "A cat, a-cat!", "cat cat cat cat, dogs dogs dogs dogs", "CAPS, ONLY", "x" * 30)], "t string")
    got = df.select(F.size(T.caption_words(F.col("t"))).alias("n"), T.sd_tokens(F.col("t")).alias("sd"), F.array_join(T.caption_issues(F.col("t")), ";").alias("i")).collect()
    assert [r["n"] for r in got] == [0, 0, 4, 8, 2, 1]
    assert got[3]["i"] == "all_caps;word_repeated:dogs"
    assert "all_caps" in got[4]["i"] and "no_description" in got[5]["i"]
    fixed = spark.createDataFrame([("  a  b!! ok...,",), ("The end,",)], "t string").select(T.fix_caption(F.col("t"), "the").alias("f")).collect()
    assert [r["f"] for r in fixed] == ["The, a b! ok.", "The end"]


def test_geometry(spark):
    box = lambda *v: [F.lit(float(x)) for x in v]
    r = spark.range(1).select(
        G.iou(box(0, 0, 2, 2), box(1, 1, 3, 3)).alias("a"), G.iou(box(0, 0, 1, 1), box(1, 0, 2, 1)).alias("b"), G.scene_positions(F.lit(0), F.lit(9), 3).alias("short"),
        G.scene_positions(F.lit(0), F.lit(100), 3).alias("three"), hamming(F.lit(5).cast("long"), F.lit(3).cast("long")).alias("h"), cosine(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(2.0), F.lit(0.0))).alias("c"),
    ).first()
    assert (round(r["a"], 6), r["b"], r["short"], r["three"], r["h"], r["c"]) == (round(1 / 7, 6), 0.0, [], [10, 49, 89], 2, 1.0)


def test_stage_graph():
    seen = []
    stage = lambda n, needs=(), enabled=True: Stage(n, lambda t, n=n: seen.append(n), list(needs), enabled)
    graph = StageGraph([stage("c", ["a", "b"]), stage("a"), stage("b", ["a"])])
    assert graph.order() == ["a", "b", "c"]
    assert set(graph.execute(start_from="b").values()) == {"pending", "completed"} and seen == ["b", "c"]
    assert StageGraph([stage("a", enabled=False), stage("b", ["a"])]).execute() == {"a": "skipped", "b": "skipped"}
    with pytest.raises(ValueError, match="cycle"):
        StageGraph([stage("a", ["b"]), stage("b", ["a"])]).order()
    with pytest.raises(ValueError, match="unknown"):
        StageGraph([stage("a", ["z"])]).order()


def test_files_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "i int, s string")
    files.save_records(df, f"{tmp_path}/t.csv")
    assert rows(files.load_records(spark, f"{tmp_path}/t.parquet"), "i", "s") == [(1, "a"), (2, "b")]
    assert files.load_records(spark, f"{tmp_path}/none.parquet", df.schema).count() == 0
    with pytest.raises(FileNotFoundError):
        files.load_records(spark, f"{tmp_path}/none.parquet")
    (tmp_path / "r.csv").write_text("index,x,flags\n2,bad,f\nno,1.5,g\n1,2.5,\n")
    assert rows(files.load_report_csv(spark, f"{tmp_path}/r.csv", "index", ["x"], ["flags"]), "index", "x") == [(1, 2.5), (2, 0.0)]
    (tmp_path / "caps").mkdir()
    (tmp_path / "caps" / "one.txt").write_text(" hello \n")
    assert rows(files.load_captions(spark, f"{tmp_path}/caps"), "stem") == [("one",)]
    names = spark.createDataFrame([("scene1_pos3_frame000120_t4.5s.jpg",), ("x_0042.png",), ("plain.png",)], "n string")
    assert [r[0] for r in names.select(files.frame_number(F.col("n"))).collect()] == [120, 42, -1]
    parsed = names.limit(1).select(*(v.alias(k) for k, v in files.parse_frame_name(F.col("n")).items())).first()
    assert tuple(parsed) == ("scene1", 3, 120, "t4.5s")
    assert rows(files.manifest({"a": df, "b": df.limit(0)}), "stage", "rows", "status") == [("a", 2, "complete"), ("b", 0, "empty")]


def test_log_lines_and_scores(spark):
    from millrace.functions import scores as C

    lines = ["epoch 3/10", "steps: 120/900 loss=0.123 lr=1e-4", "CUDA out of memory error", "Traceback (most recent call last)", "fine"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, line string").select("i", *(v.alias(k) for k, v in C.log_fields(F.col("line")).items()))
    got = df.orderBy("i").collect()
    assert (got[0]["epoch"], got[1]["step"], got[1]["loss"], got[1]["rate"]) == (3, 120, 0.123, 1e-4)
    assert [r["error"] for r in got] == [None, None, "oom_error", "generic_error", None]
    folded = L.fold_last(df.withColumn("job", F.lit(1)), "job", ["i"], ["epoch", "step", "error"]).first()
    assert (folded["epoch"], folded["step"], folded["error"]) == (3, 120, "generic_error")
    m = spark.range(1).select(C.motion_match(F.lit(5.0), F.lit(1.0), 0.2, 0.6).alias("low"), C.motion_match(F.lit(20.0), F.lit(1.0), 0.2, 0.6).alias("in")).first()
    assert (m["low"]["matches"], round(m["low"]["confidence"], 6), m["in"]["matches"], m["in"]["confidence"]) == (False, 0.6, True, 1.0)


def test_poses(spark):
    from millrace.functions import poses as B

    def body(left, right, hip_left, hip_right):
        p = [(0.0, 0.0)] * 17
        p[5], p[6], p[11], p[12], p[13], p[14] = (left, 100.0), (right, 100.0), (hip_left, 0.0), (hip_right, 0.0), (hip_left, -60.0), (hip_right, -60.0)
        return p

    rows = [("front", body(-10.0, 10.0, -10.0, 10.0), [0.9] * 17), ("side", body(1.0, -1.0, -10.0, 10.0), [0.9] * 17), ("hidden", body(-10.0, 10.0, -10.0, 10.0), [0.1] * 17)]
    df = spark.createDataFrame(rows, "n string, p array<struct<x double, y double>>, s array<double>")
    got = {r["n"]: r for r in df.select("n", B.normalized(F.col("p"), F.col("s")).alias("z"), B.standing(F.col("p")).alias("up"), B.view(F.col("p"), F.col("s")).alias("v")).collect()}
    assert (got["front"]["z"][5]["x"], got["front"]["z"][5]["y"], got["front"]["up"]) == (-0.1, 1.0, True)
    assert got["hidden"]["z"] is None and tuple(got["side"]["v"]) == ("side_left", 0.8)
    assert got["front"]["v"]["name"] == "three_quarter_right" and got["hidden"]["v"]["name"] == "back_right"


def test_hashes_of_mostly_zeros_meet_in_chunks_of_bounded_size(spark):
    import random

    rng = random.Random(5)
    data = [(k, k % 2, sum(1 << rng.randrange(60) for _ in range(rng.randrange(7)))) for k in range(300)]  # nearly all share their bands
    first = {}
    for k, g, h in data:
        first.setdefault((g, h), k)
    want = sorted((a, b) for (g, x), a in first.items() for (f, y), b in first.items() if g == f and a < b and (x ^ y).bit_count() <= 8)
    df = spark.createDataFrame([*data, (900, 1, None)], "k long, g int, h long")
    assert sorted((r["k_a"], r["k_b"]) for r in V.hamming_pairs(df, "k", F.col("h"), 8, 60, ["g"], chunk=20).collect()) == want


@pytest.mark.parametrize("distance", [1, 3, 8])
def test_close_pairs_by_bands_are_those_of_all_pairs(monkeypatch, distance):
    rng = np.random.default_rng(distance)
    base = rng.integers(0, 1 << 60, 60, dtype=np.int64).view(np.uint64)
    near = [b ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 60, rng.integers(1, 11)).astype(np.uint64)) for b in np.repeat(base, 12)]
    few = np.bitwise_or(np.uint64(1) << rng.integers(0, 60, 300).astype(np.uint64), np.uint64(1) << rng.integers(0, 60, 300).astype(np.uint64))  # of short texts
    h = rng.permutation(np.unique(np.concatenate([base, np.array(near, np.uint64), few])))
    left, right = h[:600], h[300:]
    want = set(map(tuple, np.argwhere(np.bitwise_count(left[:, None] ^ right) <= distance).tolist()))
    for area in (1, 40, V.AREA):  # bands, bands in steps, all pairs
        monkeypatch.setattr(V, "AREA", area)
        got = [p for x, y in V.close_pairs(left, right, distance, 60) for p in zip(x.tolist(), y.tolist(), strict=True)]
        assert len(got) == len(set(got)) and set(got) == want and len(want) > 300


def test_near_counts_of_hashes_in_parts(spark):
    rng = np.random.default_rng(6)
    h = [int(x) for x in rng.integers(0, 1 << 20, 150)] * 2 + [int(x) for x in rng.integers(0, 1 << 60, 100)]
    df = spark.createDataFrame([*enumerate(h), (900, None)], "id long, bits long")
    want = {x: (h.index(x), h.count(x), sum(0 < (x ^ y).bit_count() <= 8 for y in h)) for x in h}
    for part in (1 << 20, 60):
        assert {r["h"]: (r["k"], r["same"], r["near"]) for r in V.near_counts(df, "id", F.col("bits"), 8, 60, part).collect()} == want
    assert sum(n for _, _, n in want.values()) > 1000 and V.near_counts(df.limit(0), "id", F.col("bits"), 8).count() == 0
