"""Filters with reasons, acceptance splits and tiers; numeric columns stand in for measured image metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import filters as X
from millrace.operators import records as R
from millrace.plans.registry import query
from millrace.session import table

_SIZES = "i as (select p_partkey, p_brand, p_size * 40 as w, (p_partkey % 30) * 50 as h, (p_retailprice * 10)::int % 300 as blur, case when p_partkey % 7 = 0 then 150 end as own from part)"


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    blur = F.round(F.col("p_retailprice") * 10).cast("int") % 300
    return p.select("p_partkey", "p_brand", (F.col("p_size") * 40).alias("w"), ((key % 30) * 50).alias("h"), blur.alias("blur"), F.when(key % 7 == 0, 150).alias("own"))


_SIZE_SQL = """case when w < 128 then 'width_below_minimum' when h < 128 then 'height_below_minimum' when w > 1800 then 'width_above_maximum' when h > 1800 then 'height_above_maximum'
  when w * h < 40000 then 'too_few_pixels' when w * h > 2000000 then 'too_many_pixels' when w / h < 0.5 then 'aspect_below_minimum' when w / h > 2.0 then 'aspect_above_maximum' end"""


@query(f"with {_SIZES} select p_partkey, {_SIZE_SQL} as reason from i")
def size_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = _sizes(spark, sf_dir)
    return i.select("p_partkey", X.size_reason(F.col("w"), F.col("h"), 128, 1800, (40_000, 2_000_000)).alias("reason"))


@query(f"with {_SIZES} select p_brand, count(*) filter (blur >= coalesce(own, 100))::bigint as kept, count(*) filter (blur < coalesce(own, 100))::bigint as blurry from i group by p_brand")
def blur_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row's own threshold comes before the default."""
    i = _sizes(spark, sf_dir).withColumn("reason", X.blur_reason(F.col("blur"), 100, F.col("own")))
    return i.groupBy("p_brand").agg(F.count_if(F.col("reason").isNull()).alias("kept"), F.count("reason").alias("blurry"))


@query(f"""
with {_SIZES}, r as (select p_partkey, {_SIZE_SQL} as size, case when blur < 100 then 'blurry' end as blur from i)
select p_partkey, size is null and blur is null as all_passed, size is null or blur is null as any_passed, nullif(concat_ws('; ', 'SizeFilter: ' || size, 'BlurFilter: ' || blur), '') as reason from r""")
def composite_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = _sizes(spark, sf_dir)
    parts = {"SizeFilter": X.size_reason(F.col("w"), F.col("h"), 128, 1800, (40_000, 2_000_000)), "BlurFilter": X.blur_reason(F.col("blur"), 100)}
    (every, reason), (some, _) = X.composite(parts, "all"), X.composite(parts, "any")
    return i.select("p_partkey", every.alias("all_passed"), some.alias("any_passed"), reason.alias("reason"))


@query(f"""
with {_SIZES} select p_brand, count(*) filter (least(w, h) >= 256 and greatest(w, h) <= 1600 and coalesce(case when p_partkey % 5 <> 0 then blur / 300.0 end, 0.7) >= 0.5)::bigint as kept, count(*)::bigint as total from i group by p_brand""")
def resolution_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shorter and longer side and score within bounds; a score that could not be made counts as 0.7."""
    score = F.coalesce(F.when(F.col("p_partkey") % 5 != 0, F.col("blur") / 300.0), F.lit(0.7))
    kept = (F.least("w", "h") >= 256) & (F.greatest("w", "h") <= 1600) & (score >= 0.5)
    return _sizes(spark, sf_dir).groupBy("p_brand").agg(F.count_if(kept).alias("kept"), F.count("*").alias("total"))


@query("""
with d as (select l_orderkey, l_linenumber, l_partkey % 1700 as w, l_suppkey * 16 % 900 + 40 as h, l_partkey % 1900 as x, l_orderkey % 1070 as y, l_extendedprice / 500 as sharp, l_discount * 4 as cut from lineitem),
g as (select *, case when least(w, h) < 128 then 'too_small' when greatest(w, h) > 1536 then 'too_large' when w / h < 0.3 or w / h > 3.0 then 'bad_aspect' when x < 10 or y < 10 or x + w > 1910 or y + h > 1070 then 'edge_position' end as geometric,
  case when sharp < 50 then 'too_blurry' when cut > 0.2 then 'truncated' end as quality from d)
select coalesce('geometric: ' || geometric, 'quality: ' || quality, 'passed') as reason, count(*)::bigint as n, round(avg(sharp), 4) as avg_sharpness from g group by 1""")
def instance_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geometry first, then quality; the first failure is told with its stage."""
    d = table(spark, sf_dir, "lineitem").select(
        (F.col("l_partkey") % 1700).alias("w"), (F.col("l_suppkey") * 16 % 900 + 40).alias("h"), (F.col("l_partkey") % 1900).alias("x"), (F.col("l_orderkey") % 1070).alias("y"),
        (F.col("l_extendedprice") / 500).alias("sharp"), (F.col("l_discount") * 4).alias("cut"),
    )
    geometric = F.concat(F.lit("geometric: "), X.geometric_reason(F.col("w"), F.col("h"), (F.col("x"), F.col("y"), F.col("w"), F.col("h"))))
    quality = F.concat(F.lit("quality: "), X.instance_reason(F.col("sharp"), F.col("cut")))
    d = d.select("sharp", F.coalesce(geometric, quality, F.lit("passed")).alias("reason"))
    return d.groupBy("reason").agg(F.count("*").alias("n"), F.round(F.avg("sharp"), 4).alias("avg_sharpness"))


_REPORT = """r as (select l_orderkey * 10 + l_linenumber as idx, l_returnflag, l_partkey, l_extendedprice / 300 as sharp, l_tax * 2.5 as contrast, l_quantity / 50 as mean, l_discount as over, l_tax as under from lineitem),
f as (select *, concat_ws(',', case when sharp < 35 then 'blurry' end, case when contrast < 0.08 then 'low_contrast' end, case when over > 0.08 then 'overexposed' end, case when under > 0.08 then 'underexposed' end) as flags from r)"""


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    r = table(spark, sf_dir, "lineitem").select(
        (c("l_orderkey") * 10 + c("l_linenumber")).alias("idx"), "l_returnflag", "l_partkey", (c("l_extendedprice") / 300).alias("sharp"), (c("l_tax") * 2.5).alias("contrast"), (c("l_quantity") / 50).alias("mean"),
        c("l_discount").alias("over"), c("l_tax").alias("under"),
    )
    return r.withColumn("flags", X.exposure_flags(c("sharp"), c("contrast"), c("over"), c("under")))


@query(f"with {_REPORT} select flags, count(*)::bigint as n, round(avg(sharp), 4) as avg_sharpness, round(avg(mean), 6) as avg_mean, min(idx)::bigint as first_index from f group by flags")
def exposure_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by their flags, with means."""
    return _report(spark, sf_dir).groupBy("flags").agg(F.count("*").alias("n"), F.round(F.avg("sharp"), 4).alias("avg_sharpness"), F.round(F.avg("mean"), 6).alias("avg_mean"), F.min("idx").alias("first_index"))


@query(f"""
with {_REPORT}, p as (select *, flags = '' and sharp >= 120 and contrast >= 0.10 and mean between 0.20 and 0.90 and over <= 0.03 and under <= 0.03 as ok from f)
select l_returnflag, count(*) filter (ok)::bigint as accepted, count(*) filter (not ok)::bigint as rejected, round(avg(sharp) filter (ok), 4) as accepted_sharpness from p group by l_returnflag""")
def strict_acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    ok = X.passes_exposure(c("sharp"), c("contrast"), c("mean"), c("over"), c("under"), c("flags"))
    return _report(spark, sf_dir).withColumn("ok", ok).groupBy("l_returnflag").agg(F.count_if("ok").alias("accepted"), F.count_if(~c("ok")).alias("rejected"), F.round(F.avg(F.when(c("ok"), c("sharp"))), 4).alias("accepted_sharpness"))


@query(f"""
with {_REPORT}, s as (select f.*, sharp >= 25 and contrast >= 0.05 and mean between 0.12 and 0.93 and over <= 0.12 and under <= 0.12 as mild, i.p_partkey is not null as has_image, nullif(trim(q.p_name), '') is not null as has_prompt
  from f left join (select p_partkey from part where p_size > 5) i on i.p_partkey = f.l_partkey left join (select p_partkey, p_name from part where p_size % 11 <> 0) q on q.p_partkey = f.l_partkey)
select case when not mild then 'rejected: metrics' when not has_image then 'rejected: no image' when not has_prompt then 'rejected: no prompt' else 'accepted' end as outcome, count(*)::bigint as n, min(idx)::bigint as first_index from s group by 1""")
def acceptance_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mild bounds, then accepted rows without an image or a prompt move to the rejected ones."""
    c, p = F.col, table(spark, sf_dir, "part")
    mild = X.passes_exposure(c("sharp"), c("contrast"), c("mean"), c("over"), c("under"), None, (25.0, 0.05, 0.12, 0.93, 0.12, 0.12))
    images = p.filter("p_size > 5").select(c("p_partkey").alias("l_partkey"), F.lit(True).alias("has_image"))
    prompts = p.filter("p_size % 11 <> 0").select(c("p_partkey").alias("l_partkey"), F.nullif(F.trim("p_name"), F.lit("")).alias("prompt"))
    rows = _report(spark, sf_dir).withColumn("mild", mild).join(images, "l_partkey", "left").join(prompts, "l_partkey", "left")
    outcome = F.when(~c("mild"), "rejected: metrics").when(c("has_image").isNull(), "rejected: no image").when(c("prompt").isNull(), "rejected: no prompt").otherwise("accepted")
    return rows.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"), F.min("idx").alias("first_index"))


@query(f"""
with {_SIZES}, r as (select p_brand, list_filter([case when w < 128 then 'small' end, case when h < 128 then 'low' end], lambda x: x is not null) as reasons, case when p_partkey % 9 <> 0 then blur end as blur from i)
select p_brand, case when len(reasons) > 0 then 'rejected' when blur is null then 'acceptable' when blur >= 200 then 'excellent' when blur >= 100 then 'good' else 'acceptable' end as tier, coalesce(reasons[1], '') as first_reason, count(*)::bigint as n from r group by all""")
def routed_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a filter would route each row: its tier, and for rejected ones the first reason."""
    i = _sizes(spark, sf_dir).withColumn("reasons", R.reasons([(F.col("w") < 128, "small"), (F.col("h") < 128, "low")]))
    tier = X.quality_tier(F.col("reasons"), F.when(F.col("p_partkey") % 9 != 0, F.col("blur")), 200, 100)
    return i.groupBy("p_brand", tier.alias("tier"), F.coalesce(F.get("reasons", F.lit(0)), F.lit("")).alias("first_reason")).agg(F.count("*").alias("n"))


#: Least metrics of the three types.
MINIMUM = {
    "pose": {"clip_similarity": 0.30, "pose_accuracy": 0.80, "identity_consistency": 0.85},
    "action": {"clip_similarity": 0.28, "motion_clarity": 0.60, "action_recognition": 0.70, "identity_consistency": 0.85},
    "expression": {"clip_similarity": 0.32, "expression_accuracy": 0.70, "facial_quality": 0.80, "identity_consistency": 0.85},
}
_METRIC_SQL = {
    "clip_similarity": "clip", "pose_accuracy": "pose", "motion_clarity": "motion / 50.0", "action_recognition": "pose", "expression_accuracy": "face", "facial_quality": "face",
    "identity_consistency": "sim * (1 - least(spread, 0.3) / 0.3)",
}
_MINIMUM_SQL = " ".join(
    f"when kind = '{kind}' then list_filter([{', '.join(f'''case when coalesce({_METRIC_SQL[m]}, 0) < {v} then '{m}' end''' for m, v in bounds.items())}], lambda x: x is not null)" for kind, bounds in MINIMUM.items()
)


@query(f"""
with e as (select l_suppkey, (['pose', 'action', 'expression'])[l_suppkey % 3 + 1] as kind, avg(l_discount) * 6.2 as clip, avg(l_quantity) / 32 as pose, case when l_suppkey % 5 <> 0 then avg(l_linenumber) * 7.7 end as motion, avg(l_tax) * 20 as face,
  0.9 + avg(l_tax) as sim, stddev_pop(l_tax) / 4 as spread from lineitem group by l_suppkey)
select l_suppkey, kind, array_to_string(case {_MINIMUM_SQL} end, '; ') as failures from e""")
def threshold_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics of each evaluation that are below the least values of its type."""
    c = F.col
    e = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        (F.avg("l_discount") * 6.2).alias("clip"), (F.avg("l_quantity") / 32).alias("pose"), (F.avg("l_linenumber") * 7.7).alias("motion"), (F.avg("l_tax") * 20).alias("face"),
        (0.9 + F.avg("l_tax")).alias("sim"), (F.stddev_pop("l_tax") / 4).alias("spread"),
    )
    kinds = list(MINIMUM)
    e = e.withColumn("kind", F.element_at(F.array(*map(F.lit, kinds)), (c("l_suppkey") % 3 + 1).cast("int"))).withColumn("motion", F.when(c("l_suppkey") % 5 != 0, c("motion")))
    values = {
        "clip_similarity": c("clip"), "pose_accuracy": c("pose"), "motion_clarity": c("motion") / 50.0, "action_recognition": c("pose"), "expression_accuracy": c("face"), "facial_quality": c("face"),
        "identity_consistency": c("sim") * (1 - F.least("spread", F.lit(0.3)) / 0.3),
    }
    failures = F.coalesce(*(F.when(c("kind") == kind, X.below_thresholds(values, bounds)) for kind, bounds in MINIMUM.items()))
    return e.select("l_suppkey", "kind", F.array_join(failures, "; ").alias("failures"))


@query("select p_brand, p_partkey, p_name from part where contains(p_name, 'ring') order by p_name, p_partkey limit 25")
def first_passing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 25 rows in name order that pass a test."""
    return table(spark, sf_dir, "part").filter(F.col("p_name").contains("ring")).orderBy("p_name", "p_partkey").limit(25).select("p_brand", "p_partkey", "p_name")


@query("select event_type, case when value / 500 > 0.5 then 'nsfw' else 'safe' end as label, count(*)::bigint as n from events group by all")
def safety_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score above the threshold, and not at it, is unsafe."""
    label = F.when(F.col("value") / 500 > 0.5, "nsfw").otherwise("safe")
    return table(spark, sf_dir, "events").groupBy("event_type", label.alias("label")).agg(F.count("*").alias("n"))


@query("""
with d as (select vec_id, label, embedding as e, list_max(embedding[6:]) as top from embeddings), s as (select *, abs(e[5])::double * 4 * top::double as score from d)
select vec_id, 'track_' || (vec_id % 3) as track, round(score, 9) as score, (list_position(e[6:], top) - 1)::int as class_id, round((e[1]::double - e[3]::double / 2) * 1.5, 9) as x1, round((e[2]::double - e[4]::double / 2) * 2.0, 9) as y1,
  round((e[1]::double + e[3]::double / 2) * 1.5, 9) as x2, round((e[2]::double + e[4]::double / 2) * 2.0, 9) as y2 from s where score >= 0.05""")
def decoded_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a detector (vectors stand in) as boxes in frame coordinates, those above a score; tracks are given out in turn."""
    row = F.transform("embedding", lambda x, i: F.when(i == 4, F.abs(x.cast("double")) * 4).otherwise(x.cast("double")))
    d = table(spark, sf_dir, "embeddings").select("vec_id", X.decoded_box(row, 1.5, 2.0).alias("d")).filter("d.score >= 0.05")
    return d.select("vec_id", F.concat(F.lit("track_"), F.col("vec_id") % 3).alias("track"), F.round("d.score", 9).alias("score"), "d.class_id", *(F.round(f"d.{c}", 9).alias(c) for c in ("x1", "y1", "x2", "y2")))
