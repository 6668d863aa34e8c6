"""Joins by parsed names, timelines, nearest references, fallbacks and combinations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.vector import dot
from millrace.operators import vectors as V
from millrace.plans import relations
from millrace.plans.registry import ORACLES, query
from millrace.plans.timelines import segments
from millrace.session import table
from millrace.sources import files

_MAP = """s as (select user_id, event_type as speaker, event_id, 60 + event_id % 7 * 600 as duration from events), m as (select c_custkey as user_id, c_mktsegment as speaker_name, c_acctbal / 10000 as confidence from customer where c_custkey % 3 <> 0),
t as (select s.*, coalesce(speaker_name, 'UNKNOWN') as character, coalesce(confidence, 0.0) as confidence from s left join m on s.user_id = m.user_id)"""


def _timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments with the character of their speaker; UNKNOWN and 0 where there is none."""
    s = segments(spark, sf_dir).select("user_id", "event_id", (F.col("e") - F.col("s")).alias("duration"))
    m = table(spark, sf_dir, "customer").filter("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("name"), (F.col("c_acctbal") / 10000).alias("c"))
    return s.join(m, "user_id", "left").select("user_id", "event_id", "duration", F.coalesce("name", F.lit("UNKNOWN")).alias("character"), F.coalesce("c", F.lit(0.0)).alias("confidence"))


@query(f"with {_MAP} select event_id, character, round(confidence, 6) as confidence from t")
def character_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _timeline(spark, sf_dir).select("event_id", "character", F.round("confidence", 6).alias("confidence"))


@query(f"with {_MAP} select character, round(sum(duration), 3)::double as total_duration, count(*)::bigint as segments, round(avg(confidence), 6) as avg_confidence from t group by character")
def voice_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per character the duration and number of its segments and the mean confidence."""
    return _timeline(spark, sf_dir).groupBy("character").agg(F.round(F.sum("duration"), 3).alias("total_duration"), F.count("*").alias("segments"), F.round(F.avg("confidence"), 6).alias("avg_confidence"))


@query("""
with c as (select event_id, 'scene' || user_id || '_frame_' || lpad((event_id * 7 % 20000)::varchar, 6, '0') || '.png' as name from events where event_id % 9 = 0), o as (select o_orderkey, 'frame_' || lpad(o_orderkey::varchar, 6, '0') || case when o_orderkey % 2 = 0 then '.jpg' else '.png' end as original from orders)
select event_id, name, original from c left join o on regexp_extract(name, 'frame_(\\d+)', 1)::bigint = o_orderkey""")
def original_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The original of each curated frame, by the number in its name; the first name of a number wins."""
    c = table(spark, sf_dir, "events").filter("event_id % 9 = 0").select("event_id", F.concat(F.lit("scene"), "user_id", F.lit("_frame_"), F.lpad((F.col("event_id") * 7 % 20000).cast("string"), 6, "0"), F.lit(".png")).alias("name"))
    suffix = F.when(F.col("o_orderkey") % 2 == 0, ".jpg").otherwise(".png")
    o = table(spark, sf_dir, "orders").select(F.concat(F.lit("frame_"), F.lpad(F.col("o_orderkey").cast("string"), 6, "0"), suffix).alias("original"))
    numbered = o.groupBy(files.frame_number(F.col("original")).alias("number")).agg(F.min("original").alias("original"))
    return c.withColumn("number", files.frame_number(F.col("name"))).join(numbered, "number", "left").select("event_id", "name", "original")


@query("""
with x as (select unnest(embedding)::double as v, generate_subscripts(embedding, 1) as i from embeddings where label = 3), m as (select list(a order by i) as ref from (select i, avg(v) as a from x group by i)),
f as (select vec_id // 4 as frame, greatest(0.0, max(round(list_inner_product(embedding::double[], ref), 9))) as best from embeddings, m group by vec_id // 4)
select frame::bigint as frame, best, best >= 0.05 as kept from f""")
def reference_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames with a face like the mean reference: the best of a frame's faces counts, from 0 on."""
    e = table(spark, sf_dir, "embeddings")
    ref = V.centroids(e.filter("label = 3"), "label", "embedding").select(F.col("centroid").alias("ref"))  # one row
    scored = e.crossJoin(F.broadcast(ref)).select(F.floor(F.col("vec_id") / 4).alias("frame"), F.round(dot(F.col("embedding"), F.col("ref")), 9).alias("s"))
    return scored.groupBy("frame").agg(F.greatest(F.lit(0.0), F.max("s")).alias("best")).withColumn("kept", F.col("best") >= 0.05)


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relations.all_pairs(spark, sf_dir)


@query(f"with p as ({ORACLES['all_pairs']}) select first, second, pair, k::int as image from p, range(3) r(k)")
def image_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three jobs for each pair of names."""
    return _pairs(spark, sf_dir).withColumn("image", F.explode(F.sequence(F.lit(0), F.lit(2))))


@query(f"with p as ({ORACLES['all_pairs']}), i as (select r_name, row_number() over (order by r_regionkey) - 1 as pos, count(*) over () as n from region) select first || ', ' || second || ', two characters, ' || r_name as prompt, pair from p join i on pair % n = pos")
def pair_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prompt for each pair; interactions (regions stand in) are given out in turn."""
    turn = Window.orderBy("r_regionkey")
    i = table(spark, sf_dir, "region").select("r_name", (F.row_number().over(turn) - 1).alias("pos"))  # a short list
    n = i.count()
    return _pairs(spark, sf_dir).withColumn("pos", F.col("pair") % n).join(F.broadcast(i), "pos").select(F.concat("first", F.lit(", "), "second", F.lit(", two characters, "), "r_name").alias("prompt"), "pair")


@query("""
with d as (select l_orderkey, count(*) as n, min(l_quantity) as x from lineitem where l_discount > 0.05 group by l_orderkey)
select o_orderkey, coalesce(n, 1)::bigint as regions, d.l_orderkey is null as whole_frame, coalesce(x, 0.0)::double as left_edge from orders left join d on o_orderkey = d.l_orderkey""")
def regions_or_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detected regions of each frame, or one of the whole frame where nothing was detected."""
    d = table(spark, sf_dir, "lineitem").filter("l_discount > 0.05").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"), F.min("l_quantity").alias("x"))
    j = table(spark, sf_dir, "orders").select("o_orderkey").join(d, "o_orderkey", "left")
    return j.select("o_orderkey", F.coalesce("n", F.lit(1)).cast("long").alias("regions"), F.col("n").isNull().alias("whole_frame"), F.coalesce("x", F.lit(0.0)).alias("left_edge"))


@query(r"""
with i as (select event_id, 'prompt_' || lpad((event_id % 2200)::varchar, 4, '0') || '_img_' || lpad((event_id % 5)::varchar, 2, '0') || '_x.png' as name from events), p as (select p_partkey as idx, p_name as prompt, p_type as kind from part where p_partkey < 2000)
select event_id, kind || ', solo, ' || trim(regexp_replace(prompt, '\s+', ' ', 'g'), ' ,') as caption from i join p on regexp_extract(name, '^prompt_(\d{4})_img_(\d{2})', 1)::int = idx""")
def prompt_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A caption for each image whose prompt number is in the list: a prefix by type and the normalised prompt."""
    from millrace.functions.text import normalized_caption

    name = F.concat(F.lit("prompt_"), F.lpad((F.col("event_id") % 2200).cast("string"), 4, "0"), F.lit("_img_"), F.lpad((F.col("event_id") % 5).cast("string"), 2, "0"), F.lit("_x.png"))
    i = table(spark, sf_dir, "events").select("event_id", F.regexp_extract(name, r"^prompt_(\d{4})_img_(\d{2})", 1).try_cast("int").alias("idx"))
    p = table(spark, sf_dir, "part").filter("p_partkey < 2000").select(F.col("p_partkey").alias("idx"), F.concat("p_type", F.lit(", solo, "), normalized_caption(F.col("p_name"))).alias("caption"))
    return i.join(p, "idx").select("event_id", "caption")


@query(r"""
with i as (select event_id, 'brand' || event_id % 25 || '_image_' || lpad((event_id % 2600)::varchar, 6, '0') || '_' || lpad((event_id % 3)::varchar, 2, '0') || '.png' as name from events), k as (select event_id, regexp_extract(name, '^(\w+)_(image_\d+_\d+)', 0) as key from i),
m as (select 'brand' || p_partkey % 25 || '_image_' || lpad(p_partkey::varchar, 6, '0') || '_' || lpad((p_partkey % 3)::varchar, 2, '0') as key, p_name as prompt from part)
select event_id, prompt from k left join m using (key)""")
def matched_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The original prompt of each image, by the key in its name; null where there is none."""
    key = lambda brand, n, c: F.concat(F.lit("brand"), brand, F.lit("_image_"), F.lpad(n.cast("string"), 6, "0"), F.lit("_"), F.lpad((c % 3).cast("string"), 2, "0"))
    e, p = F.col("event_id"), F.col("p_partkey")
    i = table(spark, sf_dir, "events").select("event_id", F.regexp_extract(F.concat(key(e % 25, e % 2600, e), F.lit(".png")), r"^(\w+)_(image_\d+_\d+)", 0).alias("key"))
    return i.join(table(spark, sf_dir, "part").select(key(p % 25, p, p).alias("key"), F.col("p_name").alias("prompt")), "key", "left").select("event_id", "prompt")


@query(r"""
with f as (select event_id, (['pose', 'action', 'expression', 'other'])[event_id % 4 + 1] || '_round' || lpad((event_id % 40)::varchar, 3, '0') || '_img' || lpad((event_id % 50)::varchar, 3, '0') || '.png' as name from events),
k as (select event_id, try_cast(regexp_extract(name, '^(?:pose|action|expression)_round(\d+)_img(\d+)\.png', 1) as int) as r, try_cast(regexp_extract(name, '^(?:pose|action|expression)_round(\d+)_img(\d+)\.png', 2) as int) as i from f)
select event_id, p_name as caption from k join part on r * 50 + i = p_partkey""")
def round_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captions joined by the round and image number in a file's name; other names have none."""
    e, pattern = F.col("event_id"), r"^(?:pose|action|expression)_round(\d+)_img(\d+)\.png"
    kind = F.element_at(F.array(*map(F.lit, ["pose", "action", "expression", "other"])), (e % 4 + 1).cast("int"))
    name = F.concat(kind, F.lit("_round"), F.lpad((e % 40).cast("string"), 3, "0"), F.lit("_img"), F.lpad((e % 50).cast("string"), 3, "0"), F.lit(".png"))
    part = lambda g: F.nullif(F.regexp_extract(name, pattern, g), F.lit("")).try_cast("int")
    k = table(spark, sf_dir, "events").select("event_id", (part(1) * 50 + part(2)).cast("long").alias("p_partkey"))
    return k.join(table(spark, sf_dir, "part"), "p_partkey").select("event_id", F.col("p_name").alias("caption"))


@query("""
with b as (select doc_id, source, n_chars, row_number() over (partition by source order by n_chars desc, doc_id) as r from documents), s as (select * from b where r <= 30),
a as (select doc_id from labels where quality = 1), t as (select doc_id from labels where quality = 0)
select source, count(*) filter (a.doc_id is not null)::bigint as from_a, count(*) filter (a.doc_id is null and t.doc_id is not null)::bigint as from_b, count(*) filter (a.doc_id is null and t.doc_id is null)::bigint as missing from s left join a on s.doc_id = a.doc_id left join t on s.doc_id = t.doc_id group by source""")
def balanced_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the chosen rows are found: in the first tier, else in the second, else nowhere."""
    rank = F.row_number().over(Window.partitionBy("source").orderBy(F.desc("n_chars"), "doc_id"))
    s = table(spark, sf_dir, "documents").select("doc_id", "source", rank.alias("r")).filter("r <= 30")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").dropDuplicates(["doc_id", "quality"])
    a, b = (labels.filter(f"quality = {q}").select("doc_id", F.lit(True).alias(name)) for q, name in ((1, "a"), (0, "b")))
    j = s.join(a, "doc_id", "left").join(b, "doc_id", "left")
    has_a, has_b = F.col("a").isNotNull(), F.col("b").isNotNull()
    return j.groupBy("source").agg(F.count_if(has_a).alias("from_a"), F.count_if(~has_a & has_b).alias("from_b"), F.count_if(~has_a & ~has_b).alias("missing"))


@query("select o_orderkey, o_orderdate from orders where o_orderkey not in (select l_orderkey from lineitem where l_linenumber = 7) and o_orderstatus = 'P' order by o_orderdate, o_orderkey limit 40")
def new_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items that have not been evaluated, in the order in which they were made."""
    from millrace.operators.records import unprocessed

    done = table(spark, sf_dir, "lineitem").filter("l_linenumber = 7").select(F.col("l_orderkey").alias("o_orderkey"))
    return unprocessed(table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'"), done, "o_orderkey").orderBy("o_orderdate", "o_orderkey").limit(40).select("o_orderkey", "o_orderdate")


@query("""
with c as materialized (select c_mktsegment as m, count(*) as n, count(distinct c_nationkey) * 40 as k, avg(c_acctbal) as q from customer group by all),
a as (select m, n, q as silhouette from c), b as (select m, k as n, q + (n % 3 - 1) as silhouette from c)
select a.m as dataset, a.n::bigint as density_clusters, b.n::bigint as kmeans_clusters, case when b.n > a.n * 3 then 'kmeans: more clusters' when b.silhouette > a.silhouette then 'kmeans: better quality' else 'both have trade-offs' end as verdict from a join b using (m)""")
def clustering_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two cluster reports side by side: over three times the clusters wins, else the better quality."""
    # one mean for both reports: sums of doubles depend on the order of rows, and two of them would break ties by chance
    c = table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("dataset")).agg(F.count("*").alias("density_clusters"), (F.countDistinct("c_nationkey") * 40).alias("kmeans_clusters"), F.avg("c_acctbal").alias("qa"))
    c = c.withColumn("qb", F.col("qa") + (F.col("density_clusters") % 3 - 1)).filter("dataset is not null")
    verdict = F.when(F.col("kmeans_clusters") > F.col("density_clusters") * 3, "kmeans: more clusters").when(F.col("qb") > F.col("qa"), "kmeans: better quality").otherwise("both have trade-offs")
    return c.select("dataset", "density_clusters", "kmeans_clusters", verdict.alias("verdict"))
