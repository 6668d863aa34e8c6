"""Group reports, tiers, rollups and comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import geometry as G
from millrace.operators import records as R
from millrace.operators import sampling as S
from millrace.plans.captions import _VALID_CTE, validated
from millrace.plans.registry import query
from millrace.session import table


@query(_VALID_CTE + """,
t as (select s.*, coalesce(quality, -1) as quality, case when score >= 80 then 'A' when score >= 60 then 'B' else 'C' end as tier from scored s left join labels l on s.doc_id = l.doc_id),
r as (select *, row_number() over (partition by source, lang order by tier, score desc, doc_id) as rank from t)
select source, lang, tier, count(*)::bigint as picked, round(avg(score), 6) as avg_score, count(*) filter (quality = 1)::bigint as good, min(rank)::bigint as first_rank from r where rank <= 20 group by source, lang, tier""")
def curation_flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score captions, join labels, assign tiers, fill 20 places of each group from tier A down, and count what was taken."""
    scored = validated(spark, sf_dir).drop("issues")
    labelled = scored.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    tiers = labelled.withColumn("tier", R.tier(F.col("score"), 80, 60))
    picked = S.fill_quota(tiers, ["source", "lang"], [F.col("tier"), F.desc("score"), F.col("doc_id")], 20)
    return picked.groupBy("source", "lang", "tier").agg(
        F.count("*").alias("picked"), F.round(F.avg("score"), 6).alias("avg_score"), F.count_if(F.col("quality") == 1).alias("good"), F.min("rank").cast("long").alias("first_rank")
    )


@query("""
select coalesce(source, 'all') as source, coalesce(lang, 'all') as lang, count(*)::bigint as n, count(quality)::bigint as labelled, coalesce(sum(quality), 0)::bigint as good, round(avg(n_chars), 6) as avg_chars, max(n_chars)::bigint as max_chars
from documents d left join labels l on d.doc_id = l.doc_id group by rollup (source, lang)""")
def group_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").drop("text").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return rows.rollup("source", "lang").agg(
        F.count("*").alias("n"), F.count("quality").alias("labelled"), F.coalesce(F.sum("quality"), F.lit(0)).cast("long").alias("good"), F.round(F.avg("n_chars"), 6).alias("avg_chars"), F.max("n_chars").alias("max_chars")
    ).withColumns({"source": F.coalesce("source", F.lit("all")), "lang": F.coalesce("lang", F.lit("all"))})


@query("select doc_id, source, case when n_chars >= 3000 then 'A' when n_chars >= 1000 then 'B' else 'C' end as tier from documents where n_chars is not null")
def tier_reclassify(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").filter("n_chars is not null")
    return docs.select("doc_id", "source", R.tier(F.col("n_chars"), 3000, 1000).alias("tier"))


@query("""
select source, count(*) filter (n_chars >= 3000)::bigint as a, count(*) filter (n_chars >= 1000 and n_chars < 3000)::bigint as b, count(*) filter (n_chars < 1000)::bigint as c from documents group by source""")
def tier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiers = tier_reclassify(spark, sf_dir)
    return tiers.groupBy("source").agg(*(F.count_if(F.col("tier") == t).alias(t.lower()) for t in "ABC"))


@query("""
select metric, count(v)::bigint as n, sum(v::decimal(28,12))::double / count(v) as mean, round(stddev_samp(v), 6) as std, min(v) as min, round(quantile_cont(v, 0.25), 6) as q25, round(quantile_cont(v, 0.5), 6) as q50, round(quantile_cont(v, 0.75), 6) as q75, max(v) as max
from (select unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) as metric, unnest([l_quantity, l_extendedprice, l_discount, l_tax]) as v from lineitem) group by metric""")
def describe_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    d = R.describe(table(spark, sf_dir, "lineitem").select(*columns), columns)
    return d.select("metric", "n", "mean", F.round("std", 6).alias("std"), "min", *(F.round(c, 6).alias(c) for c in ("q25", "q50", "q75")), "max")


_STRICT = "case when l_quantity < 5 then 'low_quantity' end, case when l_discount > 0.08 then 'high_discount' end, case when l_tax < 0.01 then 'low_tax' end, case when l_extendedprice < 2000 or l_extendedprice > 80000 then 'price_range' end"


@query(f"""
with r as (select list_filter([{_STRICT}], lambda x: x is not null) as reasons, l_extendedprice from lineitem)
select 'accepted' as reason, count(*)::bigint as n, round(avg(l_extendedprice), 4) as avg_price from r where len(reasons) = 0
union all select reason, count(*)::bigint, round(avg(l_extendedprice), 4) from (select unnest(reasons) as reason, l_extendedprice from r) group by reason""")
def quality_filter_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threshold checks that collect every failed reason; a row is accepted where none failed."""
    checks = [(F.col("l_quantity") < 5, "low_quantity"), (F.col("l_discount") > 0.08, "high_discount"), (F.col("l_tax") < 0.01, "low_tax"), (~F.col("l_extendedprice").between(2000, 80000), "price_range")]
    rows = table(spark, sf_dir, "lineitem").select("l_extendedprice", R.reasons(checks).alias("reasons"))
    named = rows.select("l_extendedprice", F.explode(F.when(F.size("reasons") == 0, F.array(F.lit("accepted"))).otherwise(F.col("reasons"))).alias("reason"))
    return named.groupBy("reason").agg(F.count("*").alias("n"), F.round(F.avg("l_extendedprice"), 4).alias("avg_price"))


@query("""
select first_reason, count(*)::bigint as n from (select coalesce(case when l_quantity < 5 then 'geometric:low_quantity' end, case when l_discount > 0.08 then 'quality:high_discount' end, case when l_tax < 0.01 then 'semantic:low_tax' end, 'passed') as first_reason from lineitem) group by first_reason""")
def prefilter_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first failing stage of a chain of filters decides."""
    checks = [(F.col("l_quantity") < 5, "geometric:low_quantity"), (F.col("l_discount") > 0.08, "quality:high_discount"), (F.col("l_tax") < 0.01, "semantic:low_tax")]
    rows = table(spark, sf_dir, "lineitem").select(F.coalesce(R.first_reason(checks), F.lit("passed")).alias("first_reason"))
    return rows.groupBy("first_reason").agg(F.count("*").alias("n"))


@query("""
with p as (select p_brand, p_size * 40 as w, (p_retailprice)::int as h from part),
b as (select p_brand, case when w * h = 0 then 'unknown' when w * h >= 2073600 then 'hd+' when w * h >= 921600 then 'hd' when w * h >= 409600 then 'medium' when w * h >= 102400 then 'small' else 'tiny' end as bucket,
  case when w / h > 1.3 then 'landscape' when w / h < 0.77 then 'portrait' else 'square' end as shape from p)
select p_brand, bucket, shape, count(*)::bigint as n from b group by all""")
def resolution_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts by brand, band of pixels and shape; a price, as the height, is rounded with halves to the even number."""
    p = table(spark, sf_dir, "part").select("p_brand", (F.col("p_size") * 40).alias("w"), F.rint("p_retailprice").cast("int").alias("h"))
    rows = p.select("p_brand", G.resolution_bucket(F.col("w"), F.col("h")).alias("bucket"), G.aspect_class(F.col("w"), F.col("h")).alias("shape"))
    return rows.groupBy("p_brand", "bucket", "shape").agg(F.count("*").alias("n"))


@query("""
with s as (select 'chars' as metric, n_chars::double as v, quality from documents d join labels l on d.doc_id = l.doc_id union all select 'lines', length(text) - length(replace(text, chr(10), '')) + 1, quality from documents d join labels l on d.doc_id = l.doc_id),
m as (select metric, avg(v) filter (quality = 1) as source_mean, avg(v) filter (quality = 0) as generated_mean, stddev_pop(v) filter (quality = 1) as source_std, stddev_pop(v) filter (quality = 0) as generated_std from s group by metric)
select metric, round(source_mean, 6) as source_mean, round(generated_mean, 6) as generated_mean, round(source_std, 6) as source_std, round(generated_std, 6) as generated_std, round(generated_mean - source_mean, 6) as difference, case when source_mean = 0 then 0 else round((generated_mean - source_mean) / source_mean * 100, 6) end as percent from m""")
def compare_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two populations' means and deviations by metric, and their difference."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    lines = F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    rows = docs.select("quality", F.col("n_chars").cast("double").alias("chars"), lines.cast("double").alias("lines")).unpivot("quality", ["chars", "lines"], "metric", "v")
    of = lambda f, q: f(F.when(F.col("quality") == q, F.col("v")))
    means = rows.groupBy("metric").agg(of(F.avg, 1).alias("a"), of(F.avg, 0).alias("b"), of(F.stddev_pop, 1).alias("sa"), of(F.stddev_pop, 0).alias("sb"))
    return means.select(
        "metric", F.round("a", 6).alias("source_mean"), F.round("b", 6).alias("generated_mean"), F.round("sa", 6).alias("source_std"), F.round("sb", 6).alias("generated_std"),
        F.round(F.col("b") - F.col("a"), 6).alias("difference"), F.when(F.col("a") == 0, 0.0).otherwise(F.round((F.col("b") - F.col("a")) / F.col("a") * 100, 6)).alias("percent"),
    )


@query("""
with g as (select source, count(*) as n from documents group by source),
e as (select *, case when n < 20 then 20 when n < 50 then 15 when n < 100 then 12 else 10 end as epochs from g)
select source, n::bigint as images, epochs::bigint as epochs, greatest(1, round_even(4000 * 2.0 / (n * epochs), 0))::bigint as repeats, ((n * greatest(1, round_even(4000 * 2.0 / (n * epochs), 0))::bigint // 2) * epochs)::bigint as steps from e""")
def params_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epochs by image count, repeats rounded half to even, and training steps."""
    n = F.col("images")
    g = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("images"))
    g = g.withColumn("epochs", F.when(n < 20, 20).when(n < 50, 15).when(n < 100, 12).otherwise(10).cast("long"))
    g = g.withColumn("repeats", F.greatest(F.lit(1), F.bround(F.lit(8000.0) / (n * F.col("epochs")), 0).cast("long")))
    return g.withColumn("steps", F.floor(n * F.col("repeats") / 2).cast("long") * F.col("epochs"))


_EVAL = """
with e as (select l_suppkey, avg(l_discount) * 10 as clip, avg(l_quantity) / 50 as pose, stddev_pop(l_tax) * 5 as spread, avg(l_tax) * 20 as face, count(*) as n from lineitem group by l_suppkey),
c as (select s_suppkey, s_name, (clip + pose) / 2 as control, face * (1 - least(spread, 0.3) / 0.3) as identity, (clip + 1 + 1) / 3 as general, clip, n from supplier join e on s_suppkey = l_suppkey)"""


@query(_EVAL + """ select s_suppkey, s_name, round(0.35 * control + 0.35 * identity + 0.30 * general, 9) as final_score, row_number() over (order by round(0.35 * control + 0.35 * identity + 0.30 * general, 9) desc, s_suppkey)::bigint as rank
from c where clip >= 0.45 and n >= 10 order by rank limit 10""")
def checkpoint_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Join evaluations to checkpoints, drop those below the thresholds, rank by the weighted score."""
    e = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(
        (F.avg("l_discount") * 10).alias("clip"), (F.avg("l_quantity") / 50).alias("pose"), (F.stddev_pop("l_tax") * 5).alias("spread"), (F.avg("l_tax") * 20).alias("face"), F.count("*").alias("n")
    )
    c = table(spark, sf_dir, "supplier").join(e, "s_suppkey").filter("clip >= 0.45 and n >= 10")
    control, identity, general = (F.col("clip") + F.col("pose")) / 2, F.col("face") * (1 - F.least("spread", F.lit(0.3)) / 0.3), (F.col("clip") + 1 + 1) / 3
    scored = c.select("s_suppkey", "s_name", F.round(0.35 * control + 0.35 * identity + 0.30 * general, 9).alias("final_score"))
    top = scored.orderBy(F.desc("final_score"), "s_suppkey").limit(10)
    from pyspark.sql import Window

    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("final_score"), "s_suppkey")).cast("long"))
