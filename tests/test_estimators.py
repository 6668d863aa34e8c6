"""The clusterer as an estimator: the labels of the functions, for new vectors those of the nearest, the same after save and load."""

import numpy as np
import pytest
from pyspark.ml import Pipeline

from millrace.operators.density import dbscan_vectors
from millrace.operators.estimators import VectorClusterer, VectorClusterModel


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(6)
    truth = rng.integers(0, 3, 90)
    x = np.eye(3)[truth] * 6 + rng.normal(size=(90, 3)) * 0.3
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(900, None)], "id long, v array<double>"), truth, x


def test_fit_save_load_and_transform(spark, vectors, tmp_path):
    df, truth, x = vectors
    estimator = VectorClusterer(method="dbscan", vectorCol="v", eps=1.2, minSamples=4)
    model = estimator.fit(df)
    want = {r["id"]: -1 if r["cluster"] is None else r["cluster"] for r in dbscan_vectors(df, "id", "v", 1.2, 4).collect()}
    got = {r["id"]: r["cluster"] for r in model.transform(df).collect()}
    assert got == want and got[900] == -1
    model.save(f"{tmp_path}/model")
    estimator.save(f"{tmp_path}/estimator")
    again = VectorClusterModel.load(f"{tmp_path}/model")
    assert {r["id"]: r["cluster"] for r in again.transform(df).collect()} == got and again.uid == model.uid
    assert VectorClusterer.load(f"{tmp_path}/estimator").getOrDefault("eps") == 1.2
    new = x[:20] + 0.05
    near = {i: got[int(((x - v) ** 2).sum(axis=1).argmin())] for i, v in enumerate(new)}
    fresh = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(new)], "id long, v array<double>")
    assert {r["id"]: r["cluster"] for r in again.transform(fresh).collect()} == near


def test_in_a_pipeline_and_unknown_methods(vectors):
    df, truth, _ = vectors
    fitted = Pipeline(stages=[VectorClusterer(method="components", vectorCol="v", k=3, components=2, clusterCol="c")]).fit(df)
    label = {r["id"]: r["c"] for r in fitted.transform(df).collect()}
    assert label.pop(900) == -1 and len({(truth[i], c) for i, c in label.items()}) == 3
    with pytest.raises(ValueError, match="unknown method"):
        VectorClusterer(method="other", vectorCol="v").fit(df)
