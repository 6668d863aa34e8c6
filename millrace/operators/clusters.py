"""Density clusters, numbers of clusters by silhouette, two-level k-means and samples over clusters."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import Normalizer, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.rounds import components, written


FINE = 8


def dbscan(df: DataFrame, key: str, x: str, y: str, eps: float, least: int) -> DataFrame:
    """key, cluster (the least key of its core points; null: noise), is_core: DBSCAN of points in a plane.

    Equal points are one with members. Points meet in cells of half a diagonal, whose points are all near each other, so a cell
    is one point of the graph. Two cells are linked if the boxes of two of their fine cells are all near; only where boxes leave
    it open do points meet, so a dense place costs no pairs of its own. Tables that grow are merged, never broadcast.
    A border point goes to the cluster of the least core key that is near.
    """
    # cells so small that any two points of one are near
    side = eps / 2**0.5
    rows = df.select(F.col(key).alias("k"), (F.col(x).cast("double") + F.lit(0.0)).alias("x"), (F.col(y).cast("double") + F.lit(0.0)).alias("y"))
    sound = ~(F.col("x").isNull() | F.col("y").isNull() | F.isnan("x") | F.isnan("y"))
    points = rows.filter(sound).groupBy("x", "y").agg(F.min("k").alias("k"), F.count("*").alias("members"))
    points = written(points.select("k", "x", "y", "members", F.floor(F.col("x") / side).alias("cx"), F.floor(F.col("y") / side).alias("cy")), "dbscan-points")
    dense = points.groupBy("cx", "cy").agg(F.sum("members").alias("n")).filter(F.col("n") >= least).select("cx", "cy")
    thin = written(points.join(dense.hint("merge"), ["cx", "cy"], "left_anti").select("k", "x", "y", "cx", "cy"), "dbscan-thin")  # fewer than `least` rows a cell
    steps = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-2, 3) for j in range(-2, 3)))
    moved = lambda t, *columns: t.withColumn("s", F.explode(steps)).select(*columns, (F.col("cx") + F.col("s.i")).alias("cx"), (F.col("cy") + F.col("s.j")).alias("cy"))
    dx, dy = F.col("x") - F.col("ox"), F.col("y") - F.col("oy")
    near = dx * dx + dy * dy <= eps * eps
    others = points.select("cx", "cy", F.col("x").alias("ox"), F.col("y").alias("oy"), "members")
    counted = moved(thin, "k", "x", "y").join(others.hint("merge"), ["cx", "cy"]).filter(near).groupBy("k").agg(F.sum("members").alias("n"))
    full = counted.filter(F.col("n") >= least).select("k")
    places = points.select("k", "x", "y", "cx", "cy")
    cores = written(places.join(dense.hint("merge"), ["cx", "cy"], "left_semi").select(*places.columns).union(thin.join(full.hint("merge"), "k", "left_semi").select(*places.columns)), "dbscan-cores")
    # cells of cores are linked when two of their cores are near
    cells = cores.groupBy("cx", "cy").agg(F.min("k").alias("cell"))
    fine = [F.floor((F.col(v) / side - F.col(c)) * FINE).alias(f"f{v}") for v, c in (("x", "cx"), ("y", "cy"))]
    named = written(cores.join(cells.hint("merge"), ["cx", "cy"]).select("cell", "k", "x", "y", "cx", "cy", *fine), "dbscan-named")
    ends = {f"{e}{v}": f(v) for v in "xy" for e, f in (("low_", F.min), ("high_", F.max))}
    boxes = written(named.groupBy("cell", "cx", "cy", "fx", "fy").agg(*(f.alias(n) for n, f in ends.items())), "dbscan-boxes")
    theirs = boxes.select("cx", "cy", F.col("cell").alias("other"), F.col("fx").alias("ofx"), F.col("fy").alias("ofy"), *(F.col(n).alias(f"o{n}") for n in ends))
    gap = lambda v: F.greatest(F.lit(0.0), F.col(f"olow_{v}") - F.col(f"high_{v}"), F.col(f"low_{v}") - F.col(f"ohigh_{v}"))
    span = lambda v: F.greatest(F.col(f"ohigh_{v}") - F.col(f"low_{v}"), F.col(f"high_{v}") - F.col(f"olow_{v}"))
    pairs = moved(boxes, "cell", "fx", "fy", *ends).join(theirs.hint("merge"), ["cx", "cy"]).filter(F.col("cell") < F.col("other"))
    pairs = pairs.withColumn("sure", span("x") * span("x") + span("y") * span("y") <= eps * eps).filter(gap("x") * gap("x") + gap("y") * gap("y") <= eps * eps * (1 + 1e-9))
    # of each two cells one pair of boxes that is all near, or else all pairs that may have near points
    met = pairs.groupBy("cell", "other").agg(F.max("sure").alias("sure"))
    met = written(met, "dbscan-met")
    open_ = pairs.select("cell", "fx", "fy", "other", "ofx", "ofy").join(met.filter("not sure").select("cell", "other").hint("merge"), ["cell", "other"])
    mine, theirs = named.select("cell", "fx", "fy", "x", "y"), named.select(F.col("cell").alias("other"), F.col("fx").alias("ofx"), F.col("fy").alias("ofy"), F.col("x").alias("ox"), F.col("y").alias("oy"))
    close = open_.join(mine.hint("merge"), ["cell", "fx", "fy"]).join(theirs.hint("merge"), ["other", "ofx", "ofy"]).filter(near).select("cell", "other")
    joined = components(met.filter("sure").select("cell", "other").union(close).distinct().toDF("a", "b"))
    labels = named.join(joined.withColumnRenamed("node", "cell").hint("merge"), "cell", "left").select("k", "cx", "cy", "x", "y", F.coalesce("component", "cell").alias("cluster"))
    labels = written(labels, "dbscan-labels")
    border = moved(thin.join(cores.select("k").hint("merge"), "k", "left_anti"), "k", "x", "y")
    near_core = labels.select("cx", "cy", F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("k").alias("ok"), "cluster")
    taken = border.join(near_core.hint("merge"), ["cx", "cy"]).filter(near).groupBy("x", "y").agg(F.min_by("cluster", "ok").alias("cluster"))
    found = labels.select("x", "y", "cluster", F.lit(True).alias("is_core")).union(taken.select("x", "y", "cluster", F.lit(False)))
    return rows.join(found.hint("merge"), ["x", "y"], "left").select(F.col("k").alias(key), "cluster", F.coalesce("is_core", F.lit(False)).alias("is_core"))


def _scaled(df: DataFrame, vector: str) -> DataFrame:
    rows = df.withColumn("_raw", array_to_vector(F.transform(vector, lambda x: x.cast("double"))))
    return StandardScaler(inputCol="_raw", outputCol="_x", withMean=True).fit(rows).transform(rows).drop("_raw")


def best_k(df: DataFrame, key: str, vector: str, ks: list[int], sample: int = 5000, seed: int = 42) -> DataFrame:
    """k, silhouette, is_best: unit vectors of a seeded sample in k clusters; the greatest silhouette wins, the least k of equal ones."""
    few = df.orderBy(F.xxhash64(F.lit(seed), key)).limit(sample).withColumn("_raw", array_to_vector(F.transform(vector, lambda x: x.cast("double"))))
    rows = written(Normalizer(inputCol="_raw", outputCol="_x").transform(few).select(vector_to_array("_x").alias("v")), "k-sample").select(array_to_vector("v").alias("_x"))
    score = ClusteringEvaluator(featuresCol="_x", predictionCol="prediction")
    found = [(k, float(score.evaluate(KMeans(k=k, seed=seed, featuresCol="_x").fit(rows).transform(rows)))) for k in ks]
    top = max(found, key=lambda r: (r[1], -r[0]))[0]
    return df.sparkSession.createDataFrame([(k, s, k == top) for k, s in found], "k int, silhouette double, is_best boolean")


def two_level(df: DataFrame, key: str, vector: str, coarse: int, fine: int, least: int = 15, seed: int = 42) -> DataFrame:
    """key, coarse, cluster: k-means, and k-means again within each cluster of at least `least` rows; ids are global and without gaps."""
    rows = _scaled(df, vector)
    first = written(KMeans(k=coarse, seed=seed, featuresCol="_x", predictionCol="coarse").fit(rows).transform(rows).select(key, "coarse", vector_to_array("_x").alias("v")), "coarse")
    sizes = {r["coarse"]: r["n"] for r in first.groupBy("coarse").agg(F.count("*").alias("n")).collect()}  # a row a cluster
    parts = []
    for label in sorted(sizes):
        own = first.filter(F.col("coarse") == label).withColumn("_x", array_to_vector("v"))
        named = KMeans(k=fine, seed=seed, featuresCol="_x", predictionCol="fine").fit(own).transform(own) if sizes[label] >= least else own.withColumn("fine", F.lit(0))
        parts.append(named.select(key, "coarse", "fine"))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    every = written(every, "fine")
    ids = every.select("coarse", "fine").distinct().withColumn("cluster", F.row_number().over(Window.orderBy("coarse", "fine")) - 1)
    return every.join(ids, ["coarse", "fine"]).select(key, "coarse", "cluster")


def cluster_sample(df: DataFrame, key: str, vector: str, quality: str, target: int, clusters: int, seed: int = 42) -> DataFrame:
    """Up to `target` rows: of each k-means cluster max(1, size x target // rows) by quality, cut or filled by quality; adds cluster and chosen."""
    rows = _scaled(df, vector)
    placed = written(KMeans(k=min(clusters, target), seed=seed, featuresCol="_x", predictionCol="cluster").fit(rows).transform(rows).select(*df.columns, "cluster"), "clustered")
    n = placed.count()
    sizes = placed.groupBy("cluster").agg(F.greatest(F.lit(1), F.floor(F.count("*") * target / n)).alias("_take"))
    rank = F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc(quality), key))
    ranked = placed.withColumn("_r", rank).filter(F.col("_r") <= target).join(sizes, "cluster")
    fill = (F.col("_r") > F.col("_take")).cast("int")
    order = [fill, F.when(fill == 0, F.col("cluster")), F.desc(quality), F.col(key)]
    return ranked.orderBy(*order).limit(target).withColumn("chosen", F.when(fill == 0, "cluster").otherwise("fill")).drop("_r", "_take")


def stratified_sample(df: DataFrame, key: str, vector: str, quality: str, target: int, clusters: int = 8, weights: tuple[float, float] = (0.3, 0.7), seed: int = 42) -> DataFrame:
    """target // clusters rows of each k-means cluster by quality and distance from the centre (scaled to 0 to 1 within it), filled by quality."""
    rows = _scaled(df, vector)
    model = KMeans(k=clusters, seed=seed, featuresCol="_x", predictionCol="cluster").fit(rows)
    centres = df.sparkSession.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(model.clusterCenters())], "cluster int, _centre array<double>")
    placed = model.transform(rows).select(*df.columns, "cluster", vector_to_array("_x").alias("_v")).join(F.broadcast(centres), "cluster")
    away = F.sqrt(F.aggregate(F.zip_with("_v", "_centre", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x))
    placed = written(placed.withColumn("away", away).drop("_v", "_centre"), "stratified")
    ends = placed.groupBy("cluster").agg(F.min("away").alias("_low"), F.max("away").alias("_high"), F.count("*").alias("_n"))
    spread = F.when(F.col("_n") > 1, (F.col("away") - F.col("_low")) / (F.col("_high") - F.col("_low") + 1e-8)).otherwise(1.0)
    scored = placed.join(ends, "cluster").withColumn("score", weights[0] * F.col(quality) + weights[1] * spread)
    rank = F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("score"), key))
    by_quality = F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc(quality), key))
    each = target // clusters
    few = scored.withColumns({"_r": rank, "_q": by_quality}).filter((F.col("_r") <= each) | (F.col("_q") <= target))
    first = F.col("_r") <= each
    return few.orderBy(~first, F.desc(F.when(first, F.col("score")).otherwise(F.col(quality))), key).limit(target).select(*df.columns, "cluster", "score")


def subcluster_features(df: DataFrame, vector: str, kind: str, weight: float = 2.0) -> DataFrame:
    """Adds features: the vector and a weighted one-hot of `kind`, scaled to unit length. kind: a few names."""
    kinds = sorted(r[0] for r in df.select(kind).distinct().filter(F.col(kind).isNotNull()).collect())
    hot = F.array(*(F.when(F.col(kind) == k, F.lit(weight)).otherwise(0.0) for k in kinds))
    rows = df.withColumn("_raw", array_to_vector(F.concat(F.transform(vector, lambda x: x.cast("double")), hot)))
    return Pipeline(stages=[Normalizer(inputCol="_raw", outputCol="_u")]).fit(rows).transform(rows).withColumn("features", vector_to_array("_u")).drop("_raw", "_u")
