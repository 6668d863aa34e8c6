"""Balanced, stratified, weighted and ordered samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators import records as R
from millrace.operators import sampling as S
from millrace.operators.rounds import positions
from millrace.plans.registry import query
from millrace.session import table


def _rnd(key: str) -> str:
    return f"('0x' || substr(md5('7:' || {key}), 1, 15))::bigint"


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")


@query("""
with t as (select doc_id, source, lang, n_chars, case when n_chars >= 3000 then 'A' when n_chars >= 1000 then 'B' else 'C' end as tier from documents),
r as (select *, row_number() over (partition by source, lang order by tier, n_chars desc, doc_id) as rank from t where tier <> 'C')
select doc_id, source, lang, tier, rank::bigint as rank from r where rank <= 15""")
def balanced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to 15 rows of each group, tier A first, then B."""
    t = _docs(spark, sf_dir).withColumn("tier", R.tier(F.col("n_chars"), 3000, 1000)).filter("tier <> 'C'")
    picked = S.fill_quota(t, ["source", "lang"], [F.col("tier"), F.desc("n_chars"), F.col("doc_id")], 15)
    return picked.select("doc_id", "source", "lang", "tier", F.col("rank").cast("long").alias("rank"))


_RATIOS = {"en": 0.30, "de": 0.25, "fr": 0.25, "es": 0.10}


@query("""
with r as (select doc_id, lang, n_chars, row_number() over (partition by lang order by n_chars desc, doc_id) as rank from documents),
q as (select *, rank <= case lang when 'en' then 30 when 'de' then 25 when 'fr' then 25 when 'es' then 10 else 0 end as quota from r),
f as (select * from q where not quota order by n_chars desc, doc_id limit (select 100 - count(*) from q where quota))
select doc_id, lang, n_chars, 'quota' as chosen from q where quota union all select doc_id, lang, n_chars, 'fill' from f""")
def category_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _docs(spark, sf_dir).select("doc_id", "lang", "n_chars")
    return S.category_quota(rows, "lang", _RATIOS, [F.desc("n_chars"), F.col("doc_id")], 100)


@query("""
with c as (select source, lang, count(*) as total from documents group by source, lang),
m as (select total from (select total, row_number() over (order by total, source, lang) - 1 as r, count(*) over () as n from c) where r = n // 2)
select source, lang, c.total::bigint as total, m.total::bigint as median_total, (case when c.total < m.total then c.total else least(c.total, 12) end)::bigint as take from c, m""")
def median_cap_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.median_cap(_docs(spark, sf_dir), ["source", "lang"], 12)


@query(f"""
with e as (select quantile_cont(n_chars, [0.2, 0.4, 0.6, 0.8]) as edges from documents),
s as (select doc_id, n_chars, len(list_filter(edges, lambda x: n_chars >= x)) as stratum from documents, e),
r as (select *, row_number() over (partition by stratum order by {_rnd('doc_id')}, doc_id) as rank from s)
select doc_id, n_chars, stratum::int as stratum from r where rank <= 20""")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.stratified(_docs(spark, sf_dir).select("doc_id", "n_chars"), "n_chars", "doc_id", 5, 20, 7).drop("rank")


@query(f"""
with r as (select doc_id, source, row_number() over (partition by source order by {_rnd('doc_id')}, doc_id) as turn from documents)
select doc_id, source, turn::int as turn from r where turn <= 10 order by turn, {_rnd('source')}, source limit 75""")
def round_robin_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.round_robin(_docs(spark, sf_dir).select("doc_id", "source"), "source", "doc_id", 75, 10, 7)


@query(f"""
select doc_id, n_chars from documents where n_chars > 0 order by round(-ln(({_rnd('doc_id')} + 0.5) / 1152921504606846976.0) / n_chars, 12), doc_id limit 50""")
def weighted_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.weighted_sample(_docs(spark, sf_dir).select("doc_id", "n_chars"), "n_chars", "doc_id", 50, 7).select("doc_id", "n_chars")


@query("""
with p as (select event_id, user_id, ts, value, row_number() over (partition by user_id order by ts, event_id) - 1 as position, count(*) over (partition by user_id) as size from events),
s as (select *, ((position + 1) * 8 - 1) // size as segment from p),
b as (select *, row_number() over (partition by user_id, segment order by value desc, position) as best from s)
select event_id, user_id, segment::int as segment, value from b where best = 1""")
def temporal_segments_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best event of each eighth of a user's events in time order."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    return S.temporal_segments(ev, "user_id", ["ts", "event_id"], "value", 8).select("event_id", "user_id", "segment", "value")


@query("select event_id, (row_number() over (order by ts, event_id) - 1)::bigint as position from events")
def global_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A place for each event in the order of the whole table, numbered by ranges."""
    return positions(table(spark, sf_dir, "events").select("event_id", "ts"), ["ts", "event_id"], "position").select("event_id", "position")


@query("""
with recursive p as (select event_id, user_id, value, row_number() over (partition by user_id order by ts, event_id) as position from events), o as (select *, row_number() over (partition by user_id order by value desc, position) as i from p),
r as (select *, [position] as picks, true as taken from o where i = 1
  union all select o.*, case when len(r.picks) < 12 and len(list_filter(r.picks, lambda x: abs(x - o.position) < 5)) = 0 then list_append(r.picks, o.position) else r.picks end, len(r.picks) < 12 and len(list_filter(r.picks, lambda x: abs(x - o.position) < 5)) = 0 from r join o on o.user_id = r.user_id and o.i = r.i + 1),
k as (select *, row_number() over (partition by user_id order by case when taken then 0 else 1 end, i) as rank from r) select event_id, user_id, position, value from k where rank <= 12""")
def quality_weighted_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user the best events at least 5 positions apart, then the best of the rest, twelve in all."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    spot = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    placed = ev.select("event_id", "user_id", spot.alias("position"), "value")
    return S.greedy_gap(placed, "user_id", "position", "value", 5, 12)


@query("""
with f as (select o_custkey as scene, (o_orderkey % 10)::int as pos, max(o_orderkey) as frame from orders group by all), w as (select distinct scene, unnest([1, 5, 8]) as pos from f)
select w.pos, count(frame)::bigint as sampled, count(*) filter (frame is null)::bigint as missing, coalesce(sum(frame), 0)::bigint as frames from w left join f on w.scene = f.scene and w.pos = f.pos group by w.pos""")
def scene_position_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each scene the wanted positions: how many frames there are and how many are missing; the last name of a place counts."""
    frames = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("scene"), (F.col("o_orderkey") % 10).cast("int").alias("pos")).agg(F.max("o_orderkey").alias("frame"))
    wanted = frames.select("scene").distinct().select("scene", F.explode(F.array(F.lit(1), F.lit(5), F.lit(8))).alias("pos"))
    found = wanted.join(frames, ["scene", "pos"], "left")
    return found.groupBy("pos").agg(F.count("frame").alias("sampled"), F.count_if(F.col("frame").isNull()).alias("missing"), F.coalesce(F.sum("frame"), F.lit(0)).alias("frames"))
