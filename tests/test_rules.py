"""Rules that SQL can't say, against plain versions, and edge cases of filters, samples, clusters, sources and streams."""

import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.functions import composites as C
from millrace.functions import simplify as P
from millrace.operators import clusters as K
from millrace.operators import filters as X
from millrace.operators import sampling as S
from millrace.operators import timeline as L
from millrace.operators import vectors as V
from millrace.sources import files
from millrace.streaming import incremental


PLAIN = {
    "": "mia, ",
    "Mia, at 512px": "Mia",
    "mia leans, stunning , here": "mia leans, here",
    "An 8K photorealistic portrait": "mia, An portrait",
    "a young Italian boy with wild, tousled curly golden-brown hair": "mia, a teenage boy with curly brown hair",
    "Sun-kissed tanned skin . . The scene glows. Mia waves": "mia, tan skin. Mia waves",
    "vibrant emerald green eyes, under sophisticated moody lighting": "mia, green eyes, under",
    "captured in a very tight medium shot": "mia, in a $1 shot",
    "a softly blurred seaside background ,  . end": "mia, blurred background. end",
    "word " * 100: "mia, " + ("word " * 100).strip(),
    "word " * 101: "mia, 3d animated character, pixar style",
    "word " * 100 + "Smiling, in a Close-Up under SOFT lighting": "mia, 3d animated character, pixar style, close-up view, soft lighting, smiling expression",
    "word " * 100 + "Wild golden-brown hair, Green eyes, tanned skin, wearing a Yellow striped tank top": "mia, Wild golden-brown hair,  Green eyes, tan skin, brown hair, Green eyes, tanned skin, wearing a Yellow striped tank top, 3d animated character, pixar style",
    "word " * 100 + "natural lighting, studio lighting, brown shirt": "mia, brown shirt, 3d animated character, pixar style, studio lighting",
}


def test_plain_captions(spark):
    rnd = random.Random(1)
    pieces = [t for t in PLAIN if len(t) < 99] + ["plain words", "\n\t", "in a close-up", "smiling"]
    more = [" ".join(rnd.choice(pieces) for _ in range(rnd.choice((1, 4, 9, 40)))) for _ in range(60)]
    texts = [*PLAIN, *more]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").withColumn("p", P.simplified(F.col("t"), "mia"))
    got = {r["i"]: (r["p"], r["twice"]) for r in df.withColumn("twice", P.simplified(F.col("p"), "mia")).collect()}
    for i, text in enumerate(texts):
        plain, twice = got[i]
        assert text not in PLAIN or plain == PLAIN[text]
        assert plain.lower().startswith("mia") and not re.search(r"\s[.,;:]|\s\s\s|[,\s]\Z", plain.removeprefix("mia, "))
        assert not any(re.search(t, plain, re.IGNORECASE) for t in P.TECHNICAL_TERMS if ".*" not in t and len(plain.split()) < 40 and text in PLAIN)
        assert text not in PLAIN or twice == plain or not 0 < len(text) < 99
    names = spark.createDataFrame([("/a/prompt_3_img.png",), ("prompt_x.png",), ("b/image_1.png",)], "n string")
    assert [r[0] for r in names.select(P.prompt_key(F.col("n"))).collect()] == ["prompt_3", "misc", "misc"]


def test_filters_at_their_bounds(spark):
    df = spark.createDataFrame([(128, 128), (127, 500), (500, 127), (400, 200), (401, 200), (200, 400), (200, 401), (1800, 1700), (1801, 1700)], "w int, h int")
    got = [r[0] for r in df.select(X.size_reason(F.col("w"), F.col("h"), most=1800)).collect()]
    assert got == [None, "width_below_minimum", "height_below_minimum", None, "aspect_above_maximum", None, "aspect_below_minimum", None, "width_above_maximum"]
    df = spark.createDataFrame([(99.0, None), (100.0, None), (120.0, 150.0), (None, 10.0)], "s double, own double")
    assert [r[0] for r in df.select(X.blur_reason(F.col("s"), 100, F.col("own"))).collect()] == ["blurry", None, "blurry", None]
    row = spark.range(1)
    parts = {"A": F.lit("bad"), "B": F.lit(None).cast("string")}
    assert [tuple(row.select(*X.composite(parts, mode)).first()) for mode in ("all", "any")] == [(False, "A: bad"), (True, "A: bad")]
    assert row.select(X.below_thresholds({"a": F.lit(None).cast("double"), "b": F.lit(0.5)}, {"a": 0.1, "b": 0.5})).first()[0] == ["a"]


def test_expressions_and_scores(spark):
    df = spark.createDataFrame([("Joy ", "happy"), ("sad", "scared"), ("fear", "shock"), ("angry", "sad"), ("calm", "relaxed")], "d string, x string")
    got = [r[0] for r in df.select(C.expression_similarity(F.col("d"), F.col("x"), F.create_map(F.lit("sad"), F.lit(0.3)))).collect()]
    assert got == [1.0, 0.5, 0.4, 0.3, 1.0]
    top = {k: F.lit(10.0 if k == "aesthetics" else 1.0) for k in C.ENSEMBLE}
    assert round(spark.range(1).select(C.ensemble_score(top)).first()[0], 9) == 10.0


def test_runs_of_activity(spark):
    rnd = random.Random(4)
    data = [(g, i, rnd.random() < 0.6) for g in range(8) for i in range(rnd.randrange(1, 60))]
    got = {(r["g"], r["start"], r["stop"]) for r in L.activity_runs(spark.createDataFrame(data, "g int, i int, v boolean"), "g", "i", "v", 5, 0.2, 0.5).collect()}
    want = set()
    for g in range(8):
        own = [v for h, _, v in data if h == g]
        smooth = [sum(own[max(0, i - 2) : i + 3]) > 2 for i in range(len(own))]
        start = None
        for i, v in enumerate(smooth):
            if v and start is None:
                start = i
            elif not v and start is not None:
                if round((i - start) * 0.2, 6) >= 0.5:
                    want.add((g, start + 1, i + 1))
                start = None
    assert got == want


def test_strides_and_coverage(spark):
    for n in (1, 5, 9, 10, 23, 100):
        df = spark.range(n).select(F.lit(0).alias("g"), "id")
        assert sorted(r["id"] for r in S.strided(df, "g", ["id"], 9).collect()) == (list(range(n)) if n <= 9 else [k * n // 9 for k in range(9)])
    names = spark.createDataFrame([(c,) for c in "abcde"], "n string")
    got = [r["n"] for r in S.with_coverage(names, "n", 12, 3).orderBy("k").collect()]
    assert len(got) == 12 and set(got[:5]) == set("abcde") and [r["n"] for r in S.with_coverage(names, "n", 3, 3).orderBy("k").collect()] == got[:3]


def test_density_clusters_equal_the_plain_rule(spark):
    rnd = random.Random(8)
    points = [(i, rnd.gauss(c, 0.6), rnd.gauss(-c, 0.6)) for i, c in enumerate(rnd.choice((0, 3, 9)) for _ in range(150))] + [(200 + i, 20.0, 20.0) for i in range(30)] + [(300, 50.0, 50.0)]
    near = {k: [j for j, u, v in points if (x - u) ** 2 + (y - v) ** 2 <= 1] for k, x, y in points}
    cores = {k for k in near if len(near[k]) >= 5}
    label = {}
    for k in sorted(cores):
        if k not in label:
            todo = [k]
            while todo:
                j = todo.pop()
                if j not in label:
                    label[j] = k
                    todo += [m for m in near[j] if m in cores]
    for k in set(near) - cores:
        label[k] = next((label[j] for j in sorted(near[k]) if j in cores), None)
    got = {r["k"]: (r["cluster"], r["is_core"]) for r in K.dbscan(spark.createDataFrame(points, "k long, x double, y double"), "k", "x", "y", 1.0, 5).collect()}
    assert got == {k: (label[k], k in cores) for k in near}
    assert K.dbscan(spark.createDataFrame([], "k long, x double, y double"), "k", "x", "y", 1.0, 5).count() == 0


def test_pair_moments_equal_all_pairs(spark):
    import numpy as np

    rnd = np.random.default_rng(2)
    data = [(int(i % 3), [float(v) for v in rnd.normal(size=6)]) for i in range(20)] + [(9, [1.0] * 6)]
    for r in V.pair_moments(spark.createDataFrame(data, "g int, v array<double>"), "g", "v").collect():
        own = [np.array(v) for g, v in data if g == r["g"]]
        dots = [float(a @ b) for i, a in enumerate(own) for b in own[:i]]
        assert r["pairs"] == len(dots) and abs(r["mean"] - np.mean(dots)) < 1e-9 and abs(r["std"] - np.std(dots)) < 1e-9


def test_cluster_samples_have_their_size(spark):
    rnd = random.Random(3)
    df = spark.createDataFrame([(i, [rnd.gauss(i % 4 * 5, 1), rnd.gauss(0, 1)], rnd.random()) for i in range(120)], "id long, v array<double>, q double")
    few = K.cluster_sample(df, "id", "v", "q", 20, 4).collect()
    assert len({r["id"] for r in few}) == 20 and len({r["cluster"] for r in few}) == 4
    assert len({r["id"] for r in K.stratified_sample(df, "id", "v", "q", 21, 4).collect()}) == 21
    levels = K.two_level(df, "id", "v", 4, 2).collect()
    assert len(levels) == 120 and {r["cluster"] for r in levels} == set(range(len({r["cluster"] for r in levels})))
    found = {r["k"]: r["is_best"] for r in K.best_k(df, "id", "v", [2, 4, 8]).collect()}
    assert sum(found.values()) == 1 and set(found) == {2, 4, 8}


def test_best_match_in_blocks(spark):
    rnd = random.Random(5)
    rows = spark.createDataFrame([(i, [rnd.gauss(0, 1) for _ in range(4)]) for i in range(30)], "id int, v array<double>")
    refs = spark.createDataFrame([(f"r{i}", [rnd.gauss(0, 1) for _ in range(4)]) for i in range(25)], "n string, v array<double>")
    whole, parts = (sorted(map(str, V.best_match(rows, refs, "id", "v", "n", 0.5, block).collect())) for block in (10_000, 7))
    assert whole == parts and len(whole) == 30


def test_sources(spark, tmp_path):
    df = spark.createDataFrame([(1, [1, 2])], "i int, a array<int>")
    assert files.save_records(df, f"{tmp_path}/x.csv").endswith("x.parquet")  # CSV has no arrays
    assert files.load_records(spark, f"{tmp_path}/x.csv").first()["a"] == [1, 2]
    tracks = spark.createDataFrame([("t", [(1, 0.5), (2, 0.6)]), ("u", [])], "track string, d array<struct<frame int, score double>>")
    for suffix in ("parquet", "csv", "json"):
        path = files.export_tracks(tracks, "track", "d", f"{tmp_path}/tracks.{suffix}")
        back = spark.read.json(path) if suffix == "json" else files.load_records(spark, path)
        assert sorted((r["track"], r["frame"], r["score"]) for r in back.collect()) == [("t", 1, 0.5), ("t", 2, 0.6)]
    stub = files.stub_frames(spark, "v", 3).orderBy("frame_index").collect()
    assert [r["frame_id"] for r in stub] == ["v_000000", "v_000001", "v_000002"] and len({r["phash"] for r in stub}) == 3
    at = spark.createDataFrame([(10, 4), (0, 4), (3, 9)], "n int, s int").select(files.interval_positions(F.col("n"), F.col("s"))).collect()
    assert [r[0] for r in at] == [[0, 4, 8], [], [0]]
    named = files.with_unique_names(spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "n string, o int"), "n", ["o"]).collect()
    assert sorted((r["o"], r["n"]) for r in named) == [(1, "a"), (2, "a_1"), (3, "b")]
    files.save_routed(spark.createDataFrame([("good", "", 1), ("rejected", "blurry", 2)], "tier string, reason string, i int"), f"{tmp_path}/routed", ["tier", "reason"])
    assert (tmp_path / "routed" / "tier=rejected" / "reason=blurry").is_dir()
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "one.json").write_text('{"a": {"b": 2}}')
    (tmp_path / "j" / "two.json").write_text("{broken")
    assert [tuple(r) for r in files.load_json_folder(spark, f"{tmp_path}/j", "a struct<b: int>").filter("a is not null").select("name", "a.b").collect()] == [("one", 2)]
    assert sorted(r["stem"] for r in files.list_files(spark, [f"{tmp_path}/j", f"{tmp_path}/j"], "*.json").collect()) == ["one", "two"]


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path):
    schema = "id long, ts timestamp, user_id long, event_type string, value double"
    make = lambda lo, hi: spark.range(lo, hi).selectExpr("id", "timestamp_seconds(1700000000 + id * 60) as ts", "id % 3 as user_id", "'x' as event_type", "1.0D as value")
    make(0, 10).write.parquet(f"{tmp_path}/in/a")
    for f in (tmp_path / "in" / "a").glob("*.parquet"):
        f.rename(tmp_path / "in" / f.name)
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in/*.parquet")
    work = f"{tmp_path}/work"
    first = incremental.run_available(stream.select("id"), work, "append").count()
    again = incremental.run_available(stream.select("id"), work, "append").count()
    assert first == again == 10
    # the state is lost and every batch runs once more
    (tmp_path / "work" / "state").rename(tmp_path / "lost")
    assert incremental.run_available(stream.select("id"), work, "append").count() == 10


def test_shared_folder_is_needed_on_a_cluster(spark):
    from types import SimpleNamespace

    from millrace.operators.rounds import shared_dir

    sc = SimpleNamespace(getConf=lambda: SimpleNamespace(get=lambda k: None), getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError, match="checkpoint"):
        shared_dir(SimpleNamespace(sparkContext=sc))


def test_terms_in_few_passes_are_removed_as_one_by_one(spark):
    """Random texts of whole, cut and joined terms: the merged passes against a pass a term, in the stated order."""
    from millrace.functions import simplify as S

    rnd = random.Random(3)
    plain = [t.replace(r"\b", "").replace(r"\d+", "4").replace(".*?", " big ") for t in S.TECHNICAL_TERMS]
    parts = plain + [w for t in plain for w in t.replace("-", " ").split()] + ["at 8k resolution", "at 40px", "é", "skin", "\n", ",", "x"]
    texts = ["".join(rnd.choice(parts).upper() + rnd.choice(" - ") if rnd.random() < 0.2 else rnd.choice(parts) + rnd.choice([" ", " ", " ", "-", "", ", "]) for _ in range(rnd.randrange(1, 9))) for _ in range(20000)]
    texts += [" ".join(p) for p in zip(plain, plain[1:])] + [f"{a} {b}" for a in plain for b in parts[-60:]]
    passes = S._passes(S.TECHNICAL_TERMS)
    assert len(passes) <= 8  # each is a scan of the whole text
    whole = few = F.col("t")
    for p in S.TECHNICAL_TERMS:
        whole = F.regexp_replace(whole, f"(?i){p}", "")
    for p in passes:
        few = F.regexp_replace(few, f"(?i){p}", "")
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(8)
    assert df.filter(whole != F.col("t")).count() > 10000 and df.filter(whole != few).limit(5).collect() == []
    assert all(S._first([p]) for p in S.VERBOSE_PHRASES) and S._letters("(alberto )?stands in a") == {"a", "s"}
