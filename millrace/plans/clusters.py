"""Cluster queries: density clusters of points in a plane, k-means forms and samples over clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.vector import norm
from millrace.operators import clusters as K
from millrace.operators import density as D
from millrace.operators import reduction as R
from millrace.operators import sampling as S
from millrace.plans.registry import query
from millrace.session import table


@query("""
with recursive p as (select c_custkey as k, c_acctbal as x, c_nationkey * 200.0 as y from customer), n as (select a.k, b.k as o from p a join p b on (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 150.0 * 150.0),
c as (select k from n group by k having count(*) >= 5), e as (select n.k, n.o from n join c a on a.k = n.k join c b on b.k = n.o),
r(k, cluster) as (select k, k from c union select e.o, r.cluster from r join e on e.k = r.k where e.o > r.cluster), l as (select k, min(cluster) as cluster from r group by k),
b as (select n.k, arg_min(l.cluster, l.k) as cluster from n join l on l.k = n.o where n.k not in (select k from c) group by n.k)
select p.k as c_custkey, coalesce(l.cluster, b.cluster) as cluster, l.k is not null as is_core from p left join l on l.k = p.k left join b on b.k = p.k""")
def density_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that are dense in balance and nation: at least five within 150."""
    p = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("x"), (F.col("c_nationkey") * 200.0).alias("y"))
    return K.dbscan(p, "c_custkey", "x", "y", 150.0, 5)


@query()
def cluster_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silhouette of several numbers of clusters of unit vectors, and which is best."""
    return K.best_k(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", [2, 4, 6, 8, 10, 12])


@query()
def two_level_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coarse clusters, and finer ones within each."""
    return K.two_level(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 4, 3)


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").withColumn("quality", (F.col("vec_id") * 37 % 101) / 101.0)


@query()
def clustering_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixty vectors, of each of twelve clusters in proportion and by quality."""
    return K.cluster_sample(_scored(spark, sf_dir), "vec_id", "embedding", "quality", 60, 12).select("vec_id", "cluster", "quality", "chosen")


@query()
def hybrid_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cluster sample of one and a half times the target, then the best that are at least 5 places apart, then the best of the rest."""
    few = K.cluster_sample(_scored(spark, sf_dir), "vec_id", "embedding", "quality", 60, 12).select("vec_id", "cluster", "quality").withColumn("all", F.lit(0))
    return S.greedy_gap(few, "all", "vec_id", "quality", 5, 40).drop("all")


@query()
def diversity_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty vectors over eight clusters by quality and distance from the centre."""
    return K.stratified_sample(_scored(spark, sf_dir), "vec_id", "embedding", "quality", 40).select("vec_id", "cluster", "score")


@query("""
with l as (select vec_id, label, embedding, list_sum(list_transform(embedding, lambda x: x::double * x::double)) + 4 as n2 from embeddings)
select vec_id, round(embedding[1]::double / sqrt(n2), 8) as first, round(2 / sqrt(n2), 8) as hot, 64 + (select count(distinct label) from embeddings)::int as width from l""")
def subcluster_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with a weighted one-hot of their label, of unit length."""
    f = K.subcluster_features(table(spark, sf_dir, "embeddings").withColumn("name", F.format_string("l%03d", F.col("label").cast("int"))), "embedding", "name")
    return f.select("vec_id", F.round(F.col("features")[0] / norm(F.col("features")), 8).alias("first"), F.round(F.array_max(F.slice("features", 65, F.size("features"))), 8).alias("hot"), F.size("features").alias("width"))


_APART = "list_distance(a.embedding::double[], b.embedding::double[])"


_DENSE = f"""
with recursive n as (select a.vec_id as k, b.vec_id as o from embeddings a join embeddings b on {_APART} <= 1.15), c as (select k from n group by k having count(*) >= 4),
e as (select n.k, n.o from n join c a on a.k = n.k join c b on b.k = n.o), r(k, cluster) as (select k, k from c union select e.o, r.cluster from r join e on e.k = r.k where e.o > r.cluster), l as (select k, min(cluster) as cluster from r group by k),
b as (select n.k, arg_min(l.cluster, l.k) as cluster from n join l on l.k = n.o where n.k not in (select k from c) group by n.k)
select v.vec_id, coalesce(l.cluster, b.cluster) as cluster, l.k is not null as is_core from embeddings v left join l on l.k = v.vec_id left join b on b.k = v.vec_id"""


@query(_DENSE)
def density_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Density clusters of whole embeddings: at least four within 1.15."""
    return D.dbscan_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 1.15, 4)


@query()
def identity_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of standardised embeddings by the hierarchy of their density; -1 is noise."""
    return D.hdbscan(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 3, 2)


@query()
def component_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of unit vectors on their first 16 principal components, as many as the silhouette says."""
    return R.component_clusters(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 16, [4, 6, 8])[0]


@query("""
with u as (select vec_id, list_transform(embedding::double[], lambda v: v / sqrt(list_sum(list_transform(embedding::double[], lambda w: w * w)))) as x from embeddings),
x as (select vec_id, unnest(x) as v, generate_subscripts(x, 1) as i from u), m as (select i, avg(v) as m from x group by i), c as (select vec_id, x.i, v - m as v from x join m on m.i = x.i),
p as (select a.i, b.i as j, sum(a.v * b.v) / (select count(*) from u) as s from c a join c b on a.vec_id = b.vec_id group by a.i, b.i)
select (select count(*) from u)::bigint as rows, round(sum(s) filter (i = j), 9) as total, round(sum(s * s), 9) as squares from p""")
def component_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum and sum of squares of the variances of all principal components of unit vectors; the equivalent has them from the covariance."""
    model = R.principal_components(R.unit_vectors(table(spark, sf_dir, "embeddings"), "embedding"), "embedding", 64)
    return spark.range(1).select(F.lit(model.n).cast("long").alias("rows"), F.round(F.lit(float(model.variances.sum())), 9).alias("total"), F.round(F.lit(float((model.variances**2).sum())), 9).alias("squares"))


@query(f"""
with e as (select * from embeddings where label <> 9), p as (select a.vec_id, a.label, b.label as other, avg({_APART} ** 2) filter (a.vec_id <> b.vec_id) as d, count(*) as n from e a, e b group by all),
s as (select vec_id, max(d) filter (label = other) as own, min(d) filter (label <> other) as away, max(n) filter (label = other) as n from p group by vec_id),
x as (select label, unnest(embedding)::double as v, generate_subscripts(embedding, 1) as i from e), g as (select label, i, avg(v) as m from x group by label, i), c as (select label, list(m order by i) as embedding from g group by label),
w as (select a.label, avg({_APART}) as away from e a join c b on a.label = b.label group by a.label),
r as (select a.label, max((wa.away + wb.away) / {_APART}) as worst from c a join c b on a.label <> b.label join w wa on wa.label = a.label join w wb on wb.label = b.label group by a.label)
select (select count(*) from c)::bigint as clusters, (select count(*) from embeddings)::bigint as rows, (select count(*) from embeddings where label = 9)::bigint as noise,
  round((select avg(case when n < 2 then 0 else (away - own) / greatest(away, own) end) from s), 9) as silhouette, round((select avg(worst) from r), 9) as davies_bouldin""")
def cluster_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silhouette and Davies-Bouldin index of the labels, the last of which is taken as noise."""
    m = R.cluster_metrics(table(spark, sf_dir, "embeddings"), "label", "embedding", noise=9)
    return m.select("clusters", "rows", "noise", F.round("silhouette", 9).alias("silhouette"), F.round("davies_bouldin", 9).alias("davies_bouldin"))


@query("""
with p as (select a.vec_id as a, b.vec_id as b, round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 9) as similarity from embeddings a join embeddings b on a.vec_id < b.vec_id)
(select 'least' as kind, * from p order by similarity, a, b limit 1) union all (select 'greatest' as kind, * from p order by similarity desc, a, b limit 1)""")
def pair_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The least and the most similar pair of embeddings, without making pairs."""
    return R.extreme_pairs(table(spark, sf_dir, "embeddings"), "vec_id", "embedding").withColumn("similarity", F.round("similarity", 9))


@query(f"select vec_id, coalesce(cluster, -1) as cluster from ({_DENSE})")
def fitted_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same clusters by the estimator, fitted and then applied; -1 is noise."""
    from millrace.operators.estimators import VectorClusterer

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    estimator = VectorClusterer(method="dbscan", keyCol="vec_id", vectorCol="embedding", eps=1.15, minSamples=4)
    return estimator.fit(vectors).transform(vectors).select("vec_id", "cluster")
