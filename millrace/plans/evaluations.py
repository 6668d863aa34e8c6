"""Evaluation rates, composite scores and rankings; aggregates of line items and events stand in for model metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import composites as C
from millrace.operators.rounds import quantiles
from millrace.plans.registry import query
from millrace.session import table

_M = """m as (select l_suppkey as k, avg(l_quantity) / 50 as a, avg(l_discount) * 10 as b, case when l_suppkey % 4 <> 0 then avg(l_tax) * 12 end as c, case when l_suppkey % 3 <> 0 then stddev_pop(l_tax) * 20 end as d,
  avg(l_extendedprice) / 60000 as e, stddev_pop(l_discount) as f from lineitem group by l_suppkey)"""


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("k")).agg(
        (F.avg("l_quantity") / 50).alias("a"), (F.avg("l_discount") * 10).alias("b"), (F.avg("l_tax") * 12).alias("c"), (F.stddev_pop("l_tax") * 20).alias("d"), (F.avg("l_extendedprice") / 60000).alias("e"),
        F.stddev_pop("l_discount").alias("f"),
    )
    return m.withColumns({"c": F.when(F.col("k") % 4 != 0, F.col("c")), "d": F.when(F.col("k") % 3 != 0, F.col("d"))})


@query(f"with {_M} select k, round(0.35 * b + 0.35 * coalesce(c, 0) + 0.15 * (f * 10) + 0.15 * (coalesce(d, 0) * 100 / 100), 8) as score from m")
def aggregate_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return _metrics(spark, sf_dir).select("k", F.round(C.aggregate_score(c("b"), c("c"), c("f"), c("d") * 100), 8).alias("score"))


@query(f"with {_M} select k, round(0.4 * b + 0.3 * a + 0.3 * e, 8) as score, row_number() over (order by round(0.4 * b + 0.3 * a + 0.3 * e, 8) desc, k) = 1 as is_best from m")
def checkpoint_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of each checkpoint, and which is best; of equal ones the first."""
    c = F.col
    s = _metrics(spark, sf_dir).select("k", F.round(C.checkpoint_score(c("b"), c("a"), c("e")), 8).alias("score"))
    best = s.agg(F.min_by("k", F.struct(-F.col("score"), "k")).alias("best"))  # one row
    return s.crossJoin(F.broadcast(best)).select("k", "score", (F.col("k") == F.col("best")).alias("is_best"))


@query(f"""
with {_M}, s as (select k, round(0.30 * coalesce(c, b, 0) + 0.25 * coalesce(a, 0) + 0.20 * coalesce(d, e, 0) + 0.15 * coalesce(e, 0) + 0.10 * coalesce(f, 0), 8) as composite from m)
select k, composite, row_number() over (order by composite desc, k)::int as rank from s order by rank limit 20""")
def composite_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best by the composite with its fallbacks."""
    c = F.col
    s = _metrics(spark, sf_dir).select("k", F.round(C.composite_score(c("c"), c("b"), c("a"), c("d"), c("e"), c("f")), 8).alias("composite"))
    top = s.orderBy(F.desc("composite"), "k").limit(20)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("composite"), "k")))


@query(f"""
with {_M} select k, round(greatest(0, least(10, (e * 10 / 10 * 0.30 + b * 0.15 + coalesce(c, 0) * 0.20 + a * 0.10 + coalesce(d, 0) * 0.10 + f * 0.05 + a * 0.05 + b * 0.05) * 10)), 7) as score from m""")
def ensemble_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    values = {"aesthetics": c("e") * 10, "brisque": c("b"), "face": C.zero(c("c")), "sharpness": c("a"), "lighting": C.zero(c("d")), "contrast": c("f"), "pose": c("a"), "character": c("b")}
    return _metrics(spark, sf_dir).select("k", F.round(C.ensemble_score(values), 7).alias("score"))


def _has(text: str, words: list[str]) -> str:
    return "(" + " or ".join(f"contains({text}, '{w}')" for w in words) + ")"


# Invented texts hold no keywords, so some words follow each text.
_TAGS = ["", " full body", " waist up", " Close-up", " distant", " three-quarter body", " portrait behind a crowd", " two people, standing"]
_TAGGED = f"text || ({_TAGS})[doc_id % 8 + 1]"


def _tagged():  # noqa: ANN202
    return F.concat("text", F.element_at(F.array(*map(F.lit, _TAGS)), (F.col("doc_id") % 8 + 1).cast("int")))


_SHOTS = "case " + " ".join(f"when {_has('lower(text)', words)} then '{name}'" for name, words in C.SHOT_WORDS) + """ when x > 0.6 and q < 0.6 then 'far-shot' when q > 0.7 and x < 0.3 then 'close-up' when x > 0.3 and x < 0.6 then 'medium' else 'full-body' end"""
_LOOK = f"d as (select doc_id, source, {_TAGGED} as text, (n_chars % 100) / 100.0 as x, (doc_id % 89) / 89.0 as q from documents), s as (select *, {_SHOTS} as category from d)"


@query(f"with {_LOOK} select category, count(*)::bigint as n, round(avg(q * 0.4 + x * 0.3 + (1 - x) * 0.2 + q * 0.1 + case when category in ('far-shot', 'medium') then 0.1 else 0 end), 8) as avg_score from s group by category")
def curation_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shot category of each caption by keywords, else by how it looks, and its curation score; mean by category."""
    c = F.col
    d = table(spark, sf_dir, "documents").select("doc_id", _tagged().alias("text"), ((c("n_chars") % 100) / 100.0).alias("x"), ((c("doc_id") % 89) / 89.0).alias("q"))
    d = d.select("x", "q", C.shot_category(c("text"), c("x"), c("q")).alias("category"))
    return d.groupBy("category").agg(F.count("*").alias("n"), F.round(F.avg(C.curation_score(c("q"), c("x"), 1 - c("x"), c("q"), c("category"))), 8).alias("avg_score"))


# Keywords of the classes that a caption may fall into.
_SHOT = [
    ("close-up", ["close-up", "close up", "portrait", "face", "head shot", "shoulder"]), ("medium", ["medium shot", "waist up", "half body", "three-quarter"]),
    ("full-body", ["full body", "full-body", "entire body", "whole body", "standing"]), ("far", ["far", "distance", "distant", "wide shot", "long shot"]),
]
_AXES = {
    "multiple": ["alberto", "giulia", "two people", "multiple", "with others"], "complex": ["town", "street", "plaza", "crowd", "detailed background", "busy"],
    "occluded": ["behind", "partial", "obscured", "covered", "hidden"],
}
_CLASS_SQL = "case " + " ".join(f"when {_has('t', words)} then '{name}'" for name, words in _SHOT) + " else 'unclassified' end"


@query(f"""
with d as (select source, lower({_TAGGED}) as t from documents), c as (select source, {_CLASS_SQL} as shot, {', '.join(f"{_has('t', words)} as {name}" for name, words in _AXES.items())}, {_has('t', _SHOT[2][1])} as whole from d)
select source, shot, count(*)::bigint as n, {', '.join(f"count(*) filter ({name})::bigint as {name}" for name in _AXES)}, count(*) filter (whole)::bigint as whole from c group by source, shot""")
def caption_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captions by source and shot type (the first that fits), with counts on the other axes."""
    t = F.col("t")
    d = table(spark, sf_dir, "documents").select("source", F.lower(_tagged()).alias("t"))
    shot = F.coalesce(*(F.when(C.any_of(t, words), F.lit(name)) for name, words in _SHOT), F.lit("unclassified"))
    c = d.select("source", shot.alias("shot"), *(C.any_of(t, words).alias(name) for name, words in _AXES.items()), C.any_of(t, _SHOT[2][1]).alias("whole"))
    return c.groupBy("source", "shot").agg(F.count("*").alias("n"), *(F.count_if(name).alias(name) for name in (*_AXES, "whole")))


@query("""
with c as (select case when """ + " when ".join(f"{_has('lower(text)', words)} then '{name}'" for name, words in _SHOT) + f""" end as category, doc_id from (select doc_id, {_TAGGED} as text from documents))
select category, count(*)::bigint as n, min(doc_id) as first from c where category in ('full-body', 'medium') group by category""")
def underrepresented(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The categories of which more samples are wanted, with what there is of them."""
    low = F.lower(_tagged())
    shot = F.coalesce(*(F.when(C.any_of(low, words), F.lit(name)) for name, words in _SHOT))
    return table(spark, sf_dir, "documents").select(shot.alias("category"), "doc_id").filter(F.col("category").isin("full-body", "medium")).groupBy("category").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))


@query("select w, h, count(*)::bigint as n, case when w / h > 1.3 then 'landscape' when w / h < 0.77 then 'portrait' else 'square' end as shape from (select p_size * 40 as w, (p_partkey % 12 + 1) * 150 as h from part) group by all order by n desc, w, h limit 10")
def common_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten most common sizes and their shape."""
    from millrace.functions.geometry import aspect_class

    p = table(spark, sf_dir, "part").select((F.col("p_size") * 40).alias("w"), ((F.col("p_partkey") % 12 + 1) * 150).alias("h"))
    return p.groupBy("w", "h").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w", "h").limit(10).withColumn("shape", aspect_class(F.col("w"), F.col("h")))


@query("""
select l_returnflag, round(avg(l_quantity / 50), 6) as brightness, round(stddev_pop(l_quantity / 50), 6) as brightness_std, round(avg((l_quantity / 50 between 0.4 and 0.6)::int), 6) as brightness_share,
  round(avg((l_tax * 4 between 0.15 and 0.25)::int), 6) as contrast_share, round(avg((l_discount * 6 between 0.3 and 0.5)::int), 6) as saturation_share from lineitem group by l_returnflag""")
def in_range_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and deviation, and the share of rows within each metric's good range, ends included."""
    share = lambda c, low, high: F.round(F.avg(c.between(low, high).cast("int")), 6)
    light = F.col("l_quantity") / 50
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.round(F.avg(light), 6).alias("brightness"), F.round(F.stddev_pop(light), 6).alias("brightness_std"), share(light, 0.4, 0.6).alias("brightness_share"),
        share(F.col("l_tax") * 4, 0.15, 0.25).alias("contrast_share"), share(F.col("l_discount") * 6, 0.3, 0.5).alias("saturation_share"),
    )


@query("""
with e as (select event_type, value, event_id % 3 = 0 as matched, event_id % 5 <> 0 and user_id % 50 <> 7 as ok from events)
select event_type, count(*)::bigint as total, count(*) filter (ok)::bigint as successful, round(count(*) filter (ok) / count(*), 6) as detection_rate, round(count(*) filter (ok and matched) / nullif(count(*) filter (ok), 0), 6) as match_rate,
  round(avg(value) filter (ok), 6) as avg_confidence from e group by event_type""")
def detection_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections over all rows, all other rates over the successful ones."""
    ok, matched = F.col("ok"), F.col("event_id") % 3 == 0
    e = table(spark, sf_dir, "events").withColumn("ok", (F.col("event_id") % 5 != 0) & (F.col("user_id") % 50 != 7))
    good = F.count_if(ok)
    return e.groupBy("event_type").agg(
        F.count("*").alias("total"), good.alias("successful"), F.round(good / F.count("*"), 6).alias("detection_rate"), F.round(F.count_if(ok & matched) / F.nullif(good, F.lit(0)), 6).alias("match_rate"),
        F.round(F.avg(F.when(ok, F.col("value"))), 6).alias("avg_confidence"),
    )


@query("""
with e as (select user_id, value, event_id % 4 = 0 as matched from events where event_type <> 'error')
select user_id, count(*)::bigint as analysed, round(avg(matched::int), 6) as action_match_rate, round(avg(value), 6) as avg_blur, round(avg(least(value / 100, 1)), 6) as avg_confidence from e group by user_id""")
def action_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Match rate and means over successful rows only."""
    e = table(spark, sf_dir, "events").filter("event_type <> 'error'")
    return e.groupBy("user_id").agg(
        F.count("*").alias("analysed"), F.round(F.avg((F.col("event_id") % 4 == 0).cast("int")), 6).alias("action_match_rate"), F.round(F.avg("value"), 6).alias("avg_blur"),
        F.round(F.avg(F.least(F.col("value") / 100, F.lit(1.0))), 6).alias("avg_confidence"),
    )


@query("""
with x as (select label, unnest(embedding)::double as v, generate_subscripts(embedding, 1) as i, vec_id from embeddings),
p as (select a.label, list_inner_product(a.embedding::double[], b.embedding::double[]) * 100 as s from embeddings a join embeddings b on a.label = b.label and a.vec_id < b.vec_id)
select label, count(*)::bigint as pairs, round(avg(s), 5) as mean, round(stddev_pop(s), 4) as std from p group by label""")
def pair_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and deviation of the similarity of all pairs of a label, from sums of components and of their products, without pairs."""
    from millrace.operators.vectors import pair_moments

    return pair_moments(table(spark, sf_dir, "embeddings"), "label", "embedding").select("label", "pairs", F.round(F.col("mean") * 100, 5).alias("mean"), F.round(F.col("std") * 100, 4).alias("std"))


@query("""
with t as (select o_orderstatus, o_totalprice / 1000 as score, o_custkey % 100 / 100.0 as a, o_orderkey % 7 / 7.0 as b from orders where o_orderstatus <> 'P')
select unnest(['score', 'a', 'b']) as metric, round(unnest([avg(score), avg(a), avg(b)]), 6) as mean, round(unnest([stddev_pop(score), stddev_pop(a), stddev_pop(b)]), 6) as std, round(unnest([min(score), min(a), min(b)]), 6) as min, round(unnest([max(score), max(a), max(b)]), 6) as max from t""")
def trial_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of the score and two metrics over completed trials."""
    t = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'").select((F.col("o_totalprice") / 1000).alias("score"), (F.col("o_custkey") % 100 / 100.0).alias("a"), (F.col("o_orderkey") % 7 / 7.0).alias("b"))
    v = F.col("v")
    return t.unpivot([], ["score", "a", "b"], "metric", "v").groupBy("metric").agg(F.round(F.avg(v), 6).alias("mean"), F.round(F.stddev_pop(v), 6).alias("std"), F.round(F.min(v), 6).alias("min"), F.round(F.max(v), 6).alias("max"))


@query("select o_orderkey, o_totalprice as score, o_orderpriority from orders where o_orderstatus <> 'P' order by o_totalprice, o_orderkey limit 10")
def trial_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten trials with the lowest score, with the wanted columns that there are."""
    o = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'").withColumn("score", F.col("o_totalprice"))
    wanted = [c for c in ("o_orderkey", "score", "o_orderpriority", "no_such_column") if c in o.columns]
    return o.orderBy("score", "o_orderkey").limit(10).select(*wanted)


@query("""
with p as (select event_id, user_id, try_cast(json_extract_string(props, '$.k') as bigint) as k from events)
select user_id, count(k)::bigint as trials, max(k) filter (event_id % 2 = 0) as params_even, max(k) filter (event_id % 2 = 1) as params_odd from p group by user_id""")
def trial_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameters of trials, maps by name, as prefixed columns."""
    kind = F.when(F.col("event_id") % 2 == 0, "even").otherwise("odd")
    p = table(spark, sf_dir, "events").select("user_id", F.create_map(kind, F.get_json_object("props", "$.k").try_cast("long")).alias("params"))
    flat = p.select("user_id", F.explode("params").alias("name", "value")).withColumn("name", F.concat(F.lit("params_"), "name"))
    counts = flat.groupBy("user_id").agg(F.count("value").alias("trials"))
    return flat.groupBy("user_id").pivot("name", ["params_even", "params_odd"]).agg(F.max("value")).join(counts, "user_id").select("user_id", "trials", "params_even", "params_odd")


@query("""
with f as (select user_id, case when event_id % 6 <> 0 then value end as saturation, case when event_id % 4 <> 0 then value / 500 end as size, event_type as position from events)
select user_id, count(*) filter (saturation > 50)::bigint as warm, count(*) filter (saturation <= 50)::bigint as cool, round(coalesce(avg(saturation), 0), 6) as avg_saturation, round(coalesce(avg(size), 0), 6) as avg_size,
  count(*) filter (size is not null and position = 'click')::bigint as at_click, count(*) filter (size is not null and position = 'view')::bigint as at_view from f group by user_id""")
def scene_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warm and cool frames, means and positions over the rows where the part exists; 0 without any."""
    s, z = F.col("saturation"), F.col("size")
    f = table(spark, sf_dir, "events").select("user_id", "event_type", F.when(F.col("event_id") % 6 != 0, F.col("value")).alias("saturation"), F.when(F.col("event_id") % 4 != 0, F.col("value") / 500).alias("size"))
    at = lambda kind: F.count_if(z.isNotNull() & (F.col("event_type") == kind))
    return f.groupBy("user_id").agg(
        F.count_if(s > 50).alias("warm"), F.count_if(s <= 50).alias("cool"), F.round(F.coalesce(F.avg(s), F.lit(0.0)), 6).alias("avg_saturation"), F.round(F.coalesce(F.avg(z), F.lit(0.0)), 6).alias("avg_size"),
        at("click").alias("at_click"), at("view").alias("at_view"),
    )


@query("""
with p as (select l_orderkey, 0.2126 * (l_discount * 10) + 0.7152 * (l_quantity / 50) + 0.0722 * (l_tax * 12) as y from lineitem)
select l_orderkey, round(avg(y), 7) as luma_mean, round(stddev_pop(y), 7) as luma_std, round(avg((y > 0.95)::int), 6) as overexposed, round(avg((y < 0.05)::int), 6) as underexposed from p group by l_orderkey""")
def image_luma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Luma mean and deviation and the share of bright and dark pixels of each image; line items stand in for pixels."""
    y = F.col("y")
    p = table(spark, sf_dir, "lineitem").select("l_orderkey", C.luma(F.col("l_discount") * 10, F.col("l_quantity") / 50, F.col("l_tax") * 12).alias("y"))
    return p.groupBy("l_orderkey").agg(F.round(F.avg(y), 7).alias("luma_mean"), F.round(F.stddev_pop(y), 7).alias("luma_std"), F.round(F.avg((y > 0.95).cast("int")), 6).alias("overexposed"), F.round(F.avg((y < 0.05).cast("int")), 6).alias("underexposed"))


_FRAME_SQL = "case " + " ".join(f"when {_has('lower(text)', words)} then '{name}'" for name, words in C.FRAMING_WORDS) + " else 'unknown' end"
_WEIGHT_SQL = "case framing " + " ".join(f"when '{k}' then {v}" for k, v in C.FRAMING.items()) + " else 0.3 end"


@query(f"""
with d as (select doc_id, source, {_FRAME_SQL} as framing, (n_chars % 70)::double as edges, (doc_id % 90)::double as corners, doc_id % 40 as prompt from (select doc_id, source, n_chars, {_TAGGED} as text from documents)),
s as (select *, round(least(edges / 25.0, 2.0) + {_WEIGHT_SQL} * 1.5 - least(corners / 40.0, 1.5), 8) as score from d),
t as (select *, row_number() over (partition by source, prompt order by score desc, doc_id) as nth from s), r as (select *, row_number() over (partition by source order by score desc, doc_id) as rank from t where nth <= 2)
select source, doc_id, framing, score, rank::int as rank from r where rank <= 5""")
def best_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best of each source by sharpness, framing and background, at most two of a prompt."""
    c = F.col
    d = table(spark, sf_dir, "documents").select("doc_id", "source", C.framing(_tagged()).alias("framing"), (c("n_chars") % 70).cast("double").alias("edges"), (c("doc_id") % 90).cast("double").alias("corners"), (c("doc_id") % 40).alias("prompt"))
    s = d.select("doc_id", "source", "framing", "prompt", F.round(C.pair_image_score(c("edges"), c("corners"), c("framing")), 8).alias("score"))
    first = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "doc_id"))
    few = s.withColumn("nth", first("source", "prompt")).filter("nth <= 2")
    return few.withColumn("rank", first("source")).filter("rank <= 5").select("source", "doc_id", "framing", "score", "rank")


_NAME = {name: aliases for name, aliases in C.EXPRESSIONS.items()}
_EXPR_SQL = lambda c: f"coalesce({', '.join(f'''case when lower(trim({c})) in ({', '.join(repr(a) for a in aliases)}) then '{name}' end''' for name, aliases in _NAME.items())}, lower(trim({c})))"
_LABELS = ["Happy", "joy ", "sad", "mad", "shock", "scared", "disgust", "calm", "excited", "other"]


@query(f"""
with e as (select event_id, ({_LABELS})[event_id % 10 + 1] as d, ({_LABELS})[event_id // 10 % 10 + 1] as x, value from events), n as (select event_id, {_EXPR_SQL('d')} as a, {_EXPR_SQL('x')} as b, value from e),
s as (select *, least(a, b) || '|' || greatest(a, b) as p from n)
select event_id, a as detected, b as expected, case when a = b then 1.0 when p = 'excited|happy' then 0.7 when p = 'fearful|sad' then 0.5 when p = 'angry|disgusted' then 0.5 when p = 'fearful|surprised' then 0.4 when b in ('happy', 'sad') then round(least(value / 500, 1), 6) else 0.0 end::double as similarity,
  case when a = 'neutral' then 'moderate' when value / 500 < 0.35 then 'subtle' when value / 500 < 0.65 then 'moderate' else 'strong' end as level from s""")
def expression_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standard names of detected and expected expressions, how alike they are, and the intensity."""
    of = lambda n: F.element_at(F.array(*map(F.lit, _LABELS)), (n % 10 + 1).cast("int"))
    score = F.round(F.least(F.col("value") / 500, F.lit(1.0)), 6)
    e = table(spark, sf_dir, "events").select("event_id", "value", of(F.col("event_id")).alias("d"), of(F.floor(F.col("event_id") / 10)).alias("x"), F.create_map(F.lit("happy"), score, F.lit("sad"), score).alias("scores"))
    a = C.expression_name(F.col("d"))
    return e.select("event_id", a.alias("detected"), C.expression_name(F.col("x")).alias("expected"), C.expression_similarity(F.col("d"), F.col("x"), F.col("scores")).alias("similarity"), C.intensity_level(F.col("value") / 500, a).alias("level"))


@query("""
with g as (select source, count(*) as n, (['pose', 'action', 'expression'])[count(*) % 3 + 1] as kind from documents group by source),
e as (select *, case kind when 'pose' then 20 else 25 end as base, case kind when 'pose' then 112 when 'action' then 128 else 96 end as dim, case when n < 50 then 20 when n < 100 then 15 when n < 200 then 10 when n < 500 then 8 else 6 end as run_epochs from g),
f as (select *, case when n < 100 then greatest(base + 10, 30) when n < 300 then base + 5 when n > 1000 then base - 5 else base end as epochs, greatest(1, round_even(4000.0 / (n * run_epochs), 0))::bigint as repeats from e)
select source, n::bigint as images, kind, epochs::int as epochs, greatest(2, epochs // 10)::int as save_every, dim::int as dim, (dim // 2)::int as alpha, run_epochs::int as run_epochs, repeats, ((n * repeats // 2) * run_epochs)::bigint as steps from f""")
def training_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training parameters of each source by type and image count."""
    g = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("images"))
    g = g.withColumn("kind", F.element_at(F.array(F.lit("pose"), F.lit("action"), F.lit("expression")), (F.col("images") % 3 + 1).cast("int")))
    g = g.withColumns({"p": C.training_parameters(F.col("images"), F.col("kind")), "r": C.run_parameters(F.col("images"))})
    return g.select("source", "images", "kind", "p.epochs", "p.save_every", "p.dim", "p.alpha", F.col("r.epochs").alias("run_epochs"), "r.repeats", F.col("r.steps").cast("long").alias("steps"))


@query("""
with e as (select event_type, value from events), h as (select event_type, count(*) as n, avg(value) as mean from events group by event_type), c as (select quantile_cont(value, 0.8) as cut from events)
select e.event_type, count(*)::bigint as n, round(avg(value), 6) as mean, count(*) filter (value >= cut)::bigint as top from e, c group by e.event_type""")
def deep_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distribution and mean by type, and how many rows of each are in the best fifth of all."""
    e = table(spark, sf_dir, "events").select("event_type", "value")
    cut = quantiles(e, [], "value", [0.8]).select(F.col("quantile").alias("cut"))  # one row
    return e.crossJoin(F.broadcast(cut)).groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean"), F.count_if(F.col("value") >= F.col("cut")).alias("top"))
