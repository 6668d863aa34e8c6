"""Scores, ladders, percentiles, coverage and combinations; numeric columns stand in for measured image metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import scores as C
from millrace.functions.vector import md5_key
from millrace.operators.rounds import positions, quantiles
from millrace.plans.registry import query
from millrace.session import table

_IMG = "with i as (select p_partkey, p_brand, p_size * 60 as w, (p_partkey % 40) * 90 + 100 as h, (p_retailprice % 400)::double as blur, (p_partkey % 17) / 400.0 as edges, (p_partkey % 251)::double as bright, (p_partkey % 97)::double as contrast from part),"
_ISSUES = """ q as (select *, list_filter([case when least(w, h) < 256 then 'resolution_too_low' end, case when greatest(w, h) > 4096 then 'resolution_too_high' end, case when blur < 100 and blur > 0 then 'too_blurry' end,
  case when edges < 0.01 and edges > 0 then 'low_detail' end, case when w / h < 0.3 or w / h > 3.0 then 'extreme_aspect' end, case when bright < 20 then 'too_dark' when bright > 235 then 'too_bright' end, case when contrast < 20 then 'low_contrast' end], lambda x: x is not null) as issues from i),
s as (select *, greatest(0.0, least(100.0, 100 - case when least(w, h) < 256 then 30 when least(w, h) < 512 then 10 when least(w, h) > 2048 then 5 else 0 end - case when blur > 0 then 30 - least(30.0, blur * 0.3) else 0 end
  - case when edges > 0 then 10 - least(10.0, edges * 100) else 0 end - case when contrast > 0 then 10 - least(10.0, contrast / 10) else 0 end - 10 * len(issues)))::double as score from q)"""


def _images(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    i = table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", (F.col("p_size") * 60).alias("w"), ((key % 40) * 90 + 100).alias("h"), (F.col("p_retailprice") % 400).cast("double").alias("blur"),
        ((key % 17) / 400.0).alias("edges"), (key % 251).cast("double").alias("bright"), (key % 97).cast("double").alias("contrast"),
    )
    c = F.col
    i = i.withColumn("issues", C.image_issues(c("w"), c("h"), c("blur"), c("edges"), c("bright"), c("contrast")))
    return i.withColumn("score", C.image_score(c("w"), c("h"), c("blur"), c("edges"), c("contrast"), c("issues")))


@query(_IMG + _ISSUES + " select p_partkey, array_to_string(issues, ';') as issues, round(score, 6) as score, len(issues) = 0 and score >= 50 as passed from s")
def image_assessment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _images(spark, sf_dir).select("p_partkey", F.array_join("issues", ";").alias("issues"), F.round("score", 6).alias("score"), ((F.size("issues") == 0) & (F.col("score") >= 50)).alias("passed"))


@query(_IMG + _ISSUES + """ select p_brand, count(*)::bigint as total, count(*) filter (len(issues) = 0 and score >= 50)::bigint as passed, round(100.0 * count(*) filter (len(issues) = 0 and score >= 50) / count(*), 1) as pass_rate, round(avg(score), 6) as avg_score, floor(avg(w))::bigint as avg_width
from s group by p_brand""")
def assessment_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    passed = F.count_if((F.size("issues") == 0) & (F.col("score") >= 50))
    return _images(spark, sf_dir).groupBy("p_brand").agg(
        F.count("*").alias("total"), passed.alias("passed"), F.round(F.lit(100.0) * passed / F.count("*"), 1).alias("pass_rate"), F.round(F.avg("score"), 6).alias("avg_score"), F.floor(F.avg("w")).alias("avg_width")
    )


@query("""
with a as (select l_orderkey, l_linenumber, l_discount * 10 as complexity, 1 - l_tax * 10 as lighting, l_tax * 5 as occlusion, l_linenumber as n, l_quantity / 50 as quality, l_extendedprice / 100000 as sharp from lineitem),
s as (select *, case when complexity < 0.3 and lighting > 0.7 and occlusion < 0.2 then 'keep_full' when n >= 2 or complexity > 0.3 then 'segment' when quality < 0.4 or sharp < 0.3 then 'enhance_segment' else 'create_occlusion' end as name,
  case when complexity < 0.3 and lighting > 0.7 and occlusion < 0.2 then (1 - complexity) * 0.4 + lighting * 0.4 + (1 - occlusion) * 0.2 when n >= 2 or complexity > 0.3 then 0.8 when quality < 0.4 or sharp < 0.3 then 1 - quality else 0.7 end as confidence from a)
select name, count(*)::bigint as n, round(avg(confidence), 6) as confidence from s group by name""")
def decide_strategy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered rules that choose a strategy with a confidence, counted."""
    c = F.col
    rows = table(spark, sf_dir, "lineitem").select(
        C.strategy(c("l_discount") * 10, 1 - c("l_tax") * 10, c("l_tax") * 5, c("l_linenumber"), c("l_quantity") / 50, c("l_extendedprice") / 100000, 0.8).alias("s")
    )
    return rows.groupBy(F.col("s.name").alias("name")).agg(F.count("*").alias("n"), F.round(F.avg("s.confidence"), 6).alias("confidence"))


_METRICS = "(select unnest(['value', 'hour', 'gap']) as metric, unnest([value, extract(hour from ts)::double, (event_id % 13)::double]) as v from events)"


@query(f"select metric, round(avg(v), 6) as mean, round(stddev_pop(v), 6) as std, min(v) as min, max(v) as max, round(median(v), 6) as median, count(*) filter (v >= 6)::bigint as at_least from {_METRICS} group by metric")
def metric_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean, population deviation, ends, median and count above a threshold for each metric."""
    ev = table(spark, sf_dir, "events").select(F.col("value").cast("double").alias("value"), F.hour("ts").cast("double").alias("hour"), (F.col("event_id") % 13).cast("double").alias("gap"))
    v = F.col("v")
    long = ev.unpivot([], ["value", "hour", "gap"], "metric", "v")
    median = quantiles(long, ["metric"], "v", [0.5]).select("metric", F.round("quantile", 6).alias("median"))
    return long.groupBy("metric").agg(F.round(F.avg(v), 6).alias("mean"), F.round(F.stddev_pop(v), 6).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"), F.count_if(v >= 6).alias("at_least")).join(median, "metric")


@query("""
with p as (select event_type, quantile_cont(value, 0.8) as cut from events group by event_type)
select event_id, e.event_type, value from events e join p on e.event_type = p.event_type where value >= cut""")
def top_fifth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows at or above the 80th linear percentile of their type."""
    ev = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    cut = quantiles(ev, ["event_type"], "value", [0.8]).select("event_type", F.col("quantile").alias("cut"))
    return ev.join(cut, "event_type").filter("value >= cut").drop("cut")


@query("""
with r as (select p_brand, p_size, count(*) as n from part group by all), m as (select p_brand, max(p_size) as top from part group by p_brand),
f as (select p_brand, unnest(range(0, top + 1)) as idx from m)
select f.p_brand, count(*)::bigint as prompts, count(*) filter (coalesce(n, 0) < 2)::bigint as sparse, count(*) filter (n is null)::bigint as absent from f left join r on f.p_brand = r.p_brand and f.idx = r.p_size group by f.p_brand""")
def prompt_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per group: prompt indices up to the greatest seen, those with fewer than two rows, and those with none."""
    p = table(spark, sf_dir, "part")
    seen = p.groupBy("p_brand", F.col("p_size").alias("idx")).agg(F.count("*").alias("n"))
    every = p.groupBy("p_brand").agg(F.max("p_size").alias("top")).select("p_brand", F.explode(F.sequence(F.lit(0), "top")).alias("idx"))
    return every.join(seen, ["p_brand", "idx"], "left").groupBy("p_brand").agg(F.count("*").alias("prompts"), F.count_if(F.coalesce("n", F.lit(0)) < 2).alias("sparse"), F.count_if(F.col("n").isNull()).alias("absent"))


@query("""
with a as (select distinct p_brand as a from part), b as (select distinct p_type as b from part),
ra as (select a, row_number() over (order by ('0x' || substr(md5('3:' || a), 1, 15))::bigint, a) - 1 as ia, count(*) over () as na from a),
rb as (select b, row_number() over (order by ('0x' || substr(md5('3:' || b), 1, 15))::bigint, b) - 1 as ib, count(*) over () as nb from b),
n as (select p_partkey, row_number() over (order by p_partkey) - 1 as i from part where p_size <= 10)
select p_partkey, a, b from n join ra on i % na = ia join rb on i % nb = ib""")
def balanced_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of two dimensions given out in turn, so that uses of a value differ by one at most."""
    p = table(spark, sf_dir, "part")

    def turn(column: str, name: str) -> tuple[DataFrame, int]:
        values = p.select(F.col(column).alias(name)).distinct()
        ranked = values.withColumn(f"i{name}", F.row_number().over(Window.orderBy(md5_key(F.lit("3:"), F.col(name)), name)) - 1)  # the vocabulary of one dimension
        return ranked, values.count()

    (a, na), (b, nb) = turn("p_brand", "a"), turn("p_type", "b")
    n = positions(p.filter("p_size <= 10").select("p_partkey"), ["p_partkey"], "i")
    n = n.withColumns({"ia": F.col("i") % na, "ib": F.col("i") % nb})
    return n.join(a, "ia").join(b, "ib").select("p_partkey", "a", "b")


@query("""
with v as (select r_name from region), s as (select distinct c_mktsegment as seg from customer), k as (select unnest([0.1, 0.2, 0.3])::double as rate)
select r_name, seg, rate, (row_number() over (order by r_name, seg, rate))::bigint as trial from v, s, k order by trial limit 40""")
def grid_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 40 combinations of three value lists, in order."""
    r = table(spark, sf_dir, "region").select("r_name")
    s = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("seg")).distinct()
    rates = spark.createDataFrame([(0.1,), (0.2,), (0.3,)], "rate double")
    top = s.join(F.broadcast(r.join(rates, F.lit(True))), F.lit(True)).orderBy("r_name", "seg", "rate").limit(40)
    return top.withColumn("trial", F.row_number().over(Window.orderBy("r_name", "seg", "rate")).cast("long"))


@query("""
with m as (select l_suppkey, avg(l_quantity) / 50 as aesthetic, avg(l_discount) * 10 as clip, case when l_suppkey % 4 = 0 then null else avg(l_tax) * 10 end as quality, stddev_pop(l_tax) as diversity from lineitem group by l_suppkey)
select l_suppkey, round(0.30 * coalesce(aesthetic, 0) + 0.25 * coalesce(clip, 0) + 0.35 * coalesce(quality, 0) + 0.10 * coalesce(diversity, 0), 8) as composite from m""")
def composite_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted composite of four metrics, missing ones as 0."""
    m = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg((F.avg("l_quantity") / 50).alias("aesthetic"), (F.avg("l_discount") * 10).alias("clip"), (F.avg("l_tax") * 10).alias("quality"), F.stddev_pop("l_tax").alias("diversity"))
    m = m.withColumn("quality", F.when(F.col("l_suppkey") % 4 != 0, F.col("quality")))
    return m.select("l_suppkey", F.round(C.weighted({"aesthetic": 0.30, "clip": 0.25, "quality": 0.35, "diversity": 0.10}, 1.0, 0.0), 8).alias("composite"))


@query("""
with m as (select event_id, least(value / 2 / 50.0, 1.0) as m, (event_id % 10) / 10.0 as c from events)
select event_id, m between 0.2 and 0.6 as matches, round(case when m between 0.2 and 0.6 then 0.7 + 0.3 * c else greatest(0.3, 0.7 - case when m < 0.2 then 0.2 - m else m - 0.6 end) end, 8) as confidence from m""")
def motion_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", C.motion_match(F.col("value") / 2, (F.col("event_id") % 10) / 10.0, 0.2, 0.6).alias("r"))
    return ev.select("event_id", "r.matches", F.round("r.confidence", 8).alias("confidence"))
