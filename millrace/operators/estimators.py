"""Clusterers as an estimator and a model of Spark ML: fit, transform, save and load."""

from __future__ import annotations

from typing import Any

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.density import dbscan_vectors, hdbscan
from millrace.operators.neighbours import _nearest, deal_cells, rehomed, searches
from millrace.operators.reduction import component_clusters, sound_vectors
from millrace.operators.rounds import written

METHODS = ("dbscan", "hdbscan", "components")


class _ClusterParams(Params):
    method = Param(Params._dummy(), "method", f"one of {', '.join(METHODS)}", TypeConverters.toString)
    keyCol = Param(Params._dummy(), "keyCol", "column of whole-number keys", TypeConverters.toString)  # noqa: N815
    vectorCol = Param(Params._dummy(), "vectorCol", "column of vectors", TypeConverters.toString)  # noqa: N815
    clusterCol = Param(Params._dummy(), "clusterCol", "column of clusters that is added", TypeConverters.toString)  # noqa: N815
    eps = Param(Params._dummy(), "eps", "dbscan: greatest distance of neighbours", TypeConverters.toFloat)
    minSamples = Param(Params._dummy(), "minSamples", "dbscan: rows near a core point; hdbscan: neighbour of the core distance", TypeConverters.toInt)  # noqa: N815
    minClusterSize = Param(Params._dummy(), "minClusterSize", "hdbscan: rows of the least cluster", TypeConverters.toInt)  # noqa: N815
    k = Param(Params._dummy(), "k", "components: number of clusters", TypeConverters.toInt)
    components = Param(Params._dummy(), "components", "components: how many are kept", TypeConverters.toInt)
    standardize = Param(Params._dummy(), "standardize", "whether components are scaled first", TypeConverters.toBoolean)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(method="hdbscan", keyCol="id", vectorCol="features", clusterCol="cluster", eps=0.5, minSamples=2, minClusterSize=10, k=8, components=16, standardize=False)


class VectorClusterer(Estimator, _ClusterParams, DefaultParamsReadable, DefaultParamsWritable):
    """Clusters vectors by one of the methods; noise is -1 for all of them. The parameters are those of the method's function."""

    @keyword_only
    def __init__(self, **params: Any) -> None:
        super().__init__()
        self._set(**params)

    def _fit(self, dataset: DataFrame) -> VectorClusterModel:
        get = self.getOrDefault
        key, vector, method = get(self.keyCol), get(self.vectorCol), get(self.method)
        if method == "dbscan":
            found = dbscan_vectors(dataset, key, vector, get(self.eps), get(self.minSamples), get(self.standardize)).select(key, F.coalesce("cluster", F.lit(-1).cast("long")).alias("_c"))
        elif method == "hdbscan":
            found = hdbscan(dataset, key, vector, get(self.minClusterSize), get(self.minSamples), get(self.standardize)).select(key, F.col("cluster").alias("_c"))
        elif method == "components":
            found = component_clusters(dataset, key, vector, get(self.components), k=get(self.k))[0].select(key, F.coalesce("cluster", F.lit(-1)).cast("long").alias("_c"))
        else:
            raise ValueError(f"unknown method {method}; known are {', '.join(METHODS)}")
        rows = sound_vectors(dataset, vector).select(F.col(key).cast("long").alias("k"), F.transform(vector, lambda v: v.cast("double") + F.lit(0.0)).alias("x"))
        labels = rows.join(found.withColumnRenamed(key, "k"), "k").groupBy("x").agg(F.min("k").alias("k"), F.min_by("_c", "k").alias("label"))
        return self._copyValues(VectorClusterModel(written(labels.select("k", "x", "label"), "labels")))


class VectorClusterModel(Model, _ClusterParams, MLWritable, MLReadable):
    """labels: k, x, label of the fitted vectors. A vector that was fitted has its own label, another one that of the nearest fitted one."""

    def __init__(self, labels: DataFrame | None = None) -> None:
        super().__init__()
        self.labels = labels

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        vector, name = get(self.vectorCol), get(self.clusterCol)
        x = F.transform(vector, lambda v: v.cast("double") + F.lit(0.0))
        new = sound_vectors(dataset, vector).select(x.alias("x")).distinct().join(self.labels.select("x"), "x", "left_anti")
        new = written(new.withColumn("k", F.lit(-(1 << 62)) + F.monotonically_increasing_id()).select("k", "x"), "new-vectors")  # keys that no fitted row has
        named = self.labels.select("x", "label")
        if not new.isEmpty():
            cells = deal_cells(written(self.labels.select("k", "x"), "fitted"))
            seeking = rehomed(new, cells.pivots)
            times = -(-new.count() // int(cells.sizes.sum()))
            near = _nearest(cells, searches(cells, seeking.withColumn("bound", F.lit(float("inf"))), F.col("away"), times=times), 1, times)
            best = near.groupBy("a").agg(F.min_by("b", F.struct("distance", "b")).alias("b"))
            found = best.join(self.labels.select(F.col("k").alias("b"), "label"), "b").join(new.withColumnRenamed("k", "a"), "a")
            named = named.unionByName(found.select("x", "label"))
        rows = dataset.withColumn("_x", x)
        named = named.select(F.col("x").alias("_fitted"), F.col("label").alias(name))
        return rows.join(named, rows["_x"] == named["_fitted"], "left").drop("_x", "_fitted").withColumn(name, F.coalesce(name, F.lit(-1).cast("long")))

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()


class _ModelWriter(MLWriter):
    def __init__(self, model: VectorClusterModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:  # noqa: N802
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession.sparkContext)
        self.model.labels.write.mode("overwrite").parquet(f"{path}/labels")


class _ModelReader(MLReader):
    def load(self, path: str) -> VectorClusterModel:
        spark = SparkSession.active()
        metadata = DefaultParamsReader.loadMetadata(path, spark.sparkContext)
        model = VectorClusterModel(spark.read.parquet(f"{path}/labels"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
