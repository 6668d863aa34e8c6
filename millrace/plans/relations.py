"""Joins, set operations, deduplication and combinations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import records as R
from millrace.operators import vectors as V
from millrace.operators.rounds import positions
from millrace.plans.registry import query
from millrace.session import table


@query("""
with f as (select md5(lower(text)) as digest, min(doc_id) as first from documents group by 1)
select doc_id, digest, doc_id = first as is_kept, case when doc_id <> first then first end as duplicate_of from documents join f on md5(lower(text)) = digest""")
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5(F.lower("text")).alias("d"))
    return V.exact_dedup(docs, F.col("d"), [], "doc_id").select("doc_id", "digest", "is_kept", "duplicate_of")


@query("""
with d as (select md5(lower(text)) as digest, lower(text) as t, source from documents), z as (select source, count(*) as size from documents group by source),
g as (select digest, d.source, count(*) as n, min(size) as size, bool_or(contains(t, lower(d.source))) as named from d join z on d.source = z.source group by digest, d.source)
select digest, sum(n)::bigint as n, count(*)::bigint as sources, array_to_string(list_sort(list(source)), ',') as in_sources, first(source order by named desc, size, source) as owner from g group by digest having count(*) > 1""")
def cross_dataset_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that occur in several sources, and who keeps each: the source that the text names, else the smallest one."""
    docs = table(spark, sf_dir, "documents").select("source", F.md5(F.lower("text")).alias("digest"), F.lower("text").contains(F.lower("source")).alias("named"))
    sizes = docs.groupBy("source").agg(F.count("*").alias("size"))
    g = docs.groupBy("digest", "source").agg(F.count("*").alias("n"), F.max("named").alias("named")).join(sizes, "source")
    owner = F.min_by("source", F.struct(~F.col("named"), "size", "source")).alias("owner")
    g = g.groupBy("digest").agg(F.sum("n").alias("n"), F.count("*").alias("sources"), F.array_join(F.sort_array(F.collect_set("source")), ",").alias("in_sources"), owner)
    return g.filter("sources > 1")


@query("select doc_id, source, n_chars from documents where doc_id not in (select doc_id from labels where doc_id is not null)")
def unprocessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.unprocessed(table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), table(spark, sf_dir, "labels"), "doc_id")


@query("select a.n_name as first, b.n_name as second, (row_number() over (order by a.n_nationkey, b.n_nationkey) - 1)::bigint as pair from nation a join nation b on a.n_nationkey < b.n_nationkey")
def all_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All combinations of two names of the nation table, numbered in order; a pair's number follows from its places."""
    n = positions(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), ["n_nationkey"], "i")
    size = n.count()
    a, b = n.select("i", F.col("n_name").alias("first")), n.select(F.col("i").alias("j"), F.col("n_name").alias("second"))
    before = F.expr(f"i * (2 * {size} - i - 1) div 2")
    return a.join(b, F.col("i") < F.col("j")).select("first", "second", (before + F.col("j") - F.col("i") - 1).cast("long").alias("pair"))


@query("""
with r as (select r_name, row_number() over (order by r_regionkey) - 1 as pos, count(*) over () as n from region)
select c_custkey, r_name from customer join r on c_custkey % n = pos""")
def modulo_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row i takes entry i mod n of a short list."""
    from pyspark.sql import Window

    r = table(spark, sf_dir, "region").select("r_name", (F.row_number().over(Window.orderBy("r_regionkey")) - 1).alias("pos"))
    n = r.count()
    return table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % n).alias("pos")).join(F.broadcast(r), "pos").select("c_custkey", "r_name")


@query("""
with t as (select p_name as name from part where p_size <= 5 union all select split_part(p_name, ' ', 2) from part where p_size <= 5),
u as (select name, count(*) as n from t group by name), o as (select *, n < 0.2 * avg(n) over () as small from u),
s as (select a.name as a, b.name as b, case when contains(a.name, b.name) or contains(b.name, a.name) then 0.7 when a.small and b.small then 0.5 end as score from o a join o b on a.name < b.name where a.name <> 'noise' and b.name <> 'noise')
select a, b, score::double as score from s where score is not null order by score desc, a, b limit 100""")
def merge_suggestions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster names of which one contains the other (0.7), else two clusters that are both outliers by size (0.5); the first hundred."""
    p = table(spark, sf_dir, "part").filter("p_size <= 5")
    names = p.select(F.col("p_name").alias("name")).unionAll(p.select(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("name")))
    return R.merge_suggestions(names.groupBy("name").agg(F.count("*").alias("n")), "name", "n", 100)


@query("""
with u as (select o_custkey as key, 0 as src, o_orderkey as pos, o_orderstatus as tag from orders union all select c_custkey, 1, c_custkey, c_mktsegment from customer),
r as (select *, row_number() over (partition by key order by src, pos, tag) as n from u)
select key, pos, tag from r where n = 1""")
def merge_records_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union of two record tables; the first record of each key wins."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("pos"), F.col("o_orderstatus").alias("tag"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_custkey").alias("pos"), F.col("c_mktsegment").alias("tag"))
    return R.merge_records([o, c], ["key"], ["pos", "tag"]).select("key", "pos", "tag")


@query("""
with u as (select c_custkey, c_acctbal, 0 as version from customer union all select o_custkey, max(o_totalprice), max(o_orderkey) from orders group by o_custkey)
select c_custkey, arg_max(c_acctbal, version) as c_acctbal, max(version)::bigint as version from u group by c_custkey""")
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record with the highest version of each key."""
    base = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", F.lit(0).cast("long").alias("version"))
    changes = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("c_acctbal"), F.max("o_orderkey").alias("version"))
    return R.upsert(base, changes, ["c_custkey"], "version")


@query("""
select d.doc_id, d.source, coalesce(l.quality, -1)::int as quality, coalesce(n_chars, 100)::bigint as score from documents d left join labels l on d.doc_id = l.doc_id where d.text is not null""")
def caption_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with a caption, with a left lookup of their score and a default."""
    docs = table(spark, sf_dir, "documents").filter("text is not null").select("doc_id", "source", "n_chars")
    return docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left").select("doc_id", "source", F.coalesce("quality", F.lit(-1)).alias("quality"), F.coalesce("n_chars", F.lit(100)).cast("long").alias("score"))


@query("select p_brand, count(*)::bigint as n, round(avg(p_retailprice), 4) as avg_price from part where p_name is not null group by p_brand having count(*) > 1")
def grouped_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "part").filter("p_name is not null").groupBy("p_brand").agg(F.count("*").alias("n"), F.avg("p_retailprice").alias("a"))
    return g.filter("n > 1").select("p_brand", "n", F.round("a", 4).alias("avg_price"))
