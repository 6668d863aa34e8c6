"""Embedding queries: centroids, best match, consistency, near-duplicates by sign hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.vector import sign_hash
from millrace.operators import vectors as V
from millrace.operators.rounds import written
from millrace.plans.registry import query
from millrace.session import spread, table

_CENT = """
with x as (select vec_id, label, unnest(embedding)::double as v, generate_subscripts(embedding, 1) as i from embeddings),
m as (select label, i, avg(v) as m from x group by label, i),
c as (select label, list(m order by i) as centroid from m group by label)"""


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings")


@query(_CENT + ", n as (select label, count(*) as n from embeddings group by label) select c.label, n::bigint as n, round(list_sum(list_transform(centroid, lambda y: y * y)), 9) as norm2, round(centroid[1], 9) as first from c join n on c.label = n.label")
def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = V.centroids(_vectors(spark, sf_dir), "label", "embedding")
    squares = F.aggregate("centroid", F.lit(0.0), lambda s, y: s + y * y)
    return c.select("label", "n", F.round(squares, 9).alias("norm2"), F.round(F.col("centroid")[0], 9).alias("first"))


@query(_CENT + """, d as (select e.vec_id, e.label, round(sqrt(list_sum(list_transform(list_zip(e.embedding, c.centroid), lambda z: (z[1]::double - z[2]) * (z[1]::double - z[2])))), 6) as distance from embeddings e join c on e.label = c.label),
r as (select *, row_number() over (partition by label order by distance, vec_id) as rank from d)
select vec_id, label, distance, rank::int as rank from r where rank <= 3""")
def nearest_to_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.nearest_to_centroid(_vectors(spark, sf_dir), "vec_id", "label", "embedding", 3)


@query("""
with c as (select o_custkey as cluster, count(*) as n from orders where o_custkey % 50 <> 7 group by o_custkey union all select -1, count(*) from orders where o_custkey % 50 = 7), a as (select avg(n) as mean, count(*) as k from c)
select cluster::bigint as cluster, n::bigint as n, cluster = -1 or (k >= 2 and n > 0 and n < 0.2 * mean) as is_outlier from c, a""")
def outlier_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Noise (-1), and clusters of less than a fifth of the mean size."""
    label = F.when(F.col("o_custkey") % 50 == 7, F.lit(-1).cast("long")).otherwise(F.col("o_custkey"))
    return V.outlier_clusters(table(spark, sf_dir, "orders").select(label.alias("cluster")), "cluster")


@query(_CENT + """, s as (select e.vec_id, c.label, round(list_sum(list_transform(list_zip(e.embedding, c.centroid), lambda z: z[1]::double * z[2])), 9) as score from embeddings e, c),
r as (select *, row_number() over (partition by vec_id order by score desc, label) as rank from s)
select vec_id, case when score >= 0.1 then label end as match, score from r where rank = 1""")
def best_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label whose mean vector has the greatest dot product with each vector; none below 0.1."""
    v = _vectors(spark, sf_dir)
    refs = V.centroids(v, "label", "embedding").select("label", F.col("centroid").alias("embedding"))
    return V.best_match(v, refs, "vec_id", "embedding", "label", 0.1)


@query("""
with x as (select label, unnest(embedding)::double as v, generate_subscripts(embedding, 1) as i from embeddings), g as (select label, i, sum(v) as s, sum(v * v) as q, count(*) as n from x group by label, i)
select label, max(n)::bigint as n, round((sum(s * s) - sum(q)) / (max(n) * (max(n) - 1)), 8) as consistency from g group by label having max(n) > 1""")
def pair_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean similarity of all pairs of a label in closed form."""
    return V.pair_consistency(_vectors(spark, sf_dir), "label", "embedding").filter("n > 1").withColumn("consistency", F.round("consistency", 8))


@query("""
with d as (select vec_id, label, lag(embedding) over w as a, embedding as b, lead(embedding) over w as c from embeddings window w as (partition by label order by vec_id))
select vec_id, label, (a is null or c is null or coalesce(round(list_sum(list_transform(list_zip(a, b), lambda z: z[1]::double * z[2]::double)), 9) >= 0.2, false)
  or coalesce(round(list_sum(list_transform(list_zip(b, c), lambda z: z[1]::double * z[2]::double)), 9) >= 0.2, false)) as kept from d""")
def transition_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ends of each label's sequence, and vectors like the one before or after."""
    return V.transitions(_vectors(spark, sf_dir), "label", "vec_id", "embedding", 0.2).select("vec_id", "label", "kept")


_PRINTS = """
with w as (select distinct doc_id, source, unnest(string_split_regex(lower(text), '\\s+')) as w from documents), m as (select doc_id, source, ('0x' || substr(md5(w), 1, 15))::bigint as m from w where w <> ''),
l as (select doc_id, source, m % 60 as spot, min(m // 60) as m from m group by all), h as (select doc_id, source, bit_or((m % 2) << spot)::bigint as bits from l group by all)"""


def greedy_sql(columns: str, distance: int, order: str = "d.doc_id") -> str:
    """DuckDB: dup is the first kept row of the source that is near, null for kept rows; a row a step, in the given order."""
    near = f"list_filter(r.kept, lambda x: bit_count(xor(x.b, o.bits)) <= {distance})"
    return f"""with recursive {_PRINTS.strip().removeprefix("with")}, o as (select d.*, h.bits, row_number() over (partition by d.source order by {order}) as i from documents d left join h on d.doc_id = h.doc_id),
r as (select o.* exclude (text), case when bits is null then cast([] as struct(k bigint, b bigint)[]) else [{{'k': doc_id, 'b': bits}}] end as kept, null::bigint as dup from o where i = 1
  union all select o.* exclude (text), case when o.bits is null or len({near}) > 0 then r.kept else list_append(r.kept, {{'k': o.doc_id, 'b': o.bits}}) end, {near}[1].k from r join o on o.source is not distinct from r.source and o.i = r.i + 1)
select {columns} from r"""


def _prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return written(V.fingerprints(rows, "text").drop("text"), "prints")  # read several times


@query(_PRINTS + """, c as (select bits, min(doc_id) as k, count(*) as members from h group by bits)
select a.k as k_a, b.k as k_b, a.members::bigint as members_a, b.members::bigint as members_b, bit_count(xor(a.bits, b.bits))::int as distance from c a join c b on a.k < b.k where bit_count(xor(a.bits, b.bits)) <= 8""")
def near_dup_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of texts whose fingerprints of 60 bits differ in at most 8, by bands that lose no pair."""
    return V.hamming_pairs(_prints(spark, sf_dir), "doc_id", F.col("bits"), 8, 60)


@query(greedy_sql("doc_id, source, dup as duplicate_of", 3))
def first_wins_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy first-wins dedup of fingerprints within each source, at most 3 bits apart."""
    return V.first_wins(_prints(spark, sf_dir), "source", "doc_id", "bits", 3, 60).select("doc_id", "source", "duplicate_of")


@query(greedy_sql("doc_id, source, coalesce(dup, doc_id) as leader", 12))
def leader_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leader clusters of fingerprints within each source, at most 12 bits apart."""
    return V.leader_clusters(_prints(spark, sf_dir), "source", "doc_id", "bits", 12, 60).select("doc_id", "source", "leader")


def _farthest_sql(n: int) -> str:
    """The max-min rule a round a table: of each label the row farthest from those taken, the least id of equal ones."""
    rounds = ["p1 as (select label, [min(vec_id)] as ids, [arg_min(bits, vec_id)] as picks from h group by label)"]
    for k in range(1, n):
        away = "list_min(list_transform(p.picks, lambda b: bit_count(xor(b, h.bits))))"
        next_ = f"select p.label, p.ids, p.picks, h.vec_id, h.bits, row_number() over (partition by p.label order by {away} desc, h.vec_id) as nth from p{k} p join h on h.label = p.label where not list_contains(p.ids, h.vec_id)"
        rounds.append(f"p{k + 1} as (select label, list_append(ids, vec_id) as ids, list_append(picks, bits) as picks from ({next_}) where nth = 1)")
    taken = " union all ".join(f"select ids[{k}] as vec_id, label, {k - 1} as pick from p{k}" for k in range(1, n + 1))
    return f"with h as (select vec_id, label, list_reduce(list_prepend(0::hugeint, list_transform(embedding, lambda v: case when v > 0 then 1::hugeint else 0::hugeint end)), lambda s, b: s * 2 + b) as bits from embeddings), {', '.join(rounds)} {taken}"


@query(_farthest_sql(10))
def diverse_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten vectors of each label, each as far as can be from those before, on sign hashes of all components."""
    rows = _vectors(spark, sf_dir).select("vec_id", "label", sign_hash(F.col("embedding")).alias("bits"))
    return V.farthest_points(rows, "label", "vec_id", "bits", 10).select("vec_id", "label", "pick")


@query()
def kmeans_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.kmeans_report(_vectors(spark, sf_dir), "embedding", 5)


@query("""
with e as (select vec_id, case when label in (1, 3) then (select max(label) + 1 from embeddings) else label end as label from embeddings),
s as (select vec_id, case when label = 2 then 20 + vec_id % 2 else label end as label from e where label <> 2 or vec_id % 3 <> 0), n as (select label, count(*) as n from s group by label)
select count(*)::bigint as clusters, round(avg(n), 6) as mean, round(stddev_pop(n), 6) as std, min(n)::bigint as least, max(n)::bigint as most, median(n)::double as median, 0.0::double as noise from n""")
def cluster_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes after two labels are merged and a third is split in two, without every third of its members."""
    rows = V.merge_clusters(_vectors(spark, sf_dir).select("vec_id", "label"), "label", [1, 3])
    chosen = rows.filter("label = 2 and vec_id % 3 <> 0").select("vec_id", (20 + F.col("vec_id") % 2).cast("int").alias("new_label"))
    sizes = V.cluster_sizes(V.split_cluster(rows, "vec_id", "label", 2, chosen), "label")
    return sizes.select("clusters", *(F.round(c, 6).alias(c) for c in ("mean", "std")), "least", "most", "median", F.col("noise").cast("double").alias("noise"))
