"""Ordered sequences, dedup contracts, balanced selections and their reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators import records as R
from millrace.operators import sampling as S
from millrace.operators import timeline as L
from millrace.operators import vectors as V
from millrace.operators.rounds import positions, quantiles
from millrace.plans.registry import query
from millrace.plans.vectors import _PRINTS, greedy_sql, _prints
from millrace.session import table


def _rnd(key: str, seed: int = 7) -> str:
    return f"('0x' || substr(md5('{seed}:' || {key}), 1, 15))::bigint"


# ordered sequences


@query("""
with c as (select quantile_cont(value, 0.3) as cut from events), e as (select user_id, event_id, value > cut as voice, row_number() over (partition by user_id order by event_id) as i from events, c),
s as (select *, sum(voice::int) over (partition by user_id order by i rows between 2 preceding and 2 following) >= 3 as smooth from e),
g as (select *, i - row_number() over (partition by user_id, smooth order by i) as run, max(i) over (partition by user_id) as last from s),
r as (select user_id, min(i) as start, max(i) + 1 as stop, max(last) as last from g where smooth group by user_id, run)
select user_id, start::int as start, stop::int as stop, round((stop - start) * 0.2, 6)::double as duration from r where stop <= last and (stop - start) * 0.2 >= 0.5""")
def voice_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of frames louder than the 30th percentile after a median filter over five; a run that is not over at the end doesn't count."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "value")
    cut = quantiles(e, [], "value", [0.3]).select(F.col("quantile").alias("cut"))  # one row
    loud = e.crossJoin(F.broadcast(cut)).select("user_id", "event_id", (F.col("value") > F.col("cut")).alias("voice"))
    return L.activity_runs(loud, "user_id", "event_id", "voice", 5, 0.2, 0.5)


@query("""
with p as (select event_id, user_id, row_number() over (partition by user_id order by ts, event_id) - 1 as i, count(*) over (partition by user_id) as n from events)
select user_id, event_id from p where n <= 9 or exists (select 1 from range(9) r(k) where k * n // 9 = i)""")
def strided_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine rows of each user, at floor(k n / 9) in time order."""
    return S.strided(table(spark, sf_dir, "events").select("user_id", "event_id", "ts"), "user_id", ["ts", "event_id"], 9).select("user_id", "event_id")


@query(r"""
with l as (select user_id, event_id, 'step ' || event_id || case when event_id % 3 = 0 then ' loss=' || value::varchar else ' saving' end as line from events),
p as (select user_id, event_id, try_cast(regexp_extract(line, 'loss=([0-9]*\.?[0-9]+)', 1) as double) as loss from l), r as (select *, row_number() over (partition by user_id order by event_id desc) as n from p where loss is not null)
select user_id, round(avg(loss), 6) as mean_of_ten, min(loss) as least, arg_max(loss, event_id) as last, count(*)::bigint as n from r where n <= 10 group by user_id""")
def last_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last ten losses of each job's log, and the last one."""
    line = F.concat(F.lit("step "), "event_id", F.when(F.col("event_id") % 3 == 0, F.concat(F.lit(" loss="), F.col("value").cast("string"))).otherwise(" saving"))
    p = table(spark, sf_dir, "events").select("user_id", "event_id", F.nullif(F.regexp_extract(line, r"loss=([0-9]*\.?[0-9]+)", 1), F.lit("")).try_cast("double").alias("loss")).filter("loss is not null")
    r = R.top_per_group(p, ["user_id"], [F.desc("event_id")], 10)
    return r.groupBy("user_id").agg(F.round(F.avg("loss"), 6).alias("mean_of_ten"), F.min("loss").alias("least"), F.max_by("loss", "event_id").alias("last"), F.count("*").alias("n"))


@query("select l_suppkey, l_orderkey * 10 + l_linenumber as idx from lineitem order by l_orderkey, l_linenumber limit 64")
def first_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of an order, as many as samples are wanted."""
    return table(spark, sf_dir, "lineitem").orderBy("l_orderkey", "l_linenumber").limit(64).select("l_suppkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("idx"))


@query("""
with r as (select p_brand, p_type, p_name, min(row) as row from (select p_brand, p_type, p_name, row_number() over (partition by p_brand, p_type order by p_retailprice desc, p_partkey) as row from part) where row <= 3 group by all)
select p_brand, p_name, min(row)::int as rank from r group by p_brand, p_name""")
def report_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three of each type's ranked list, each name once, with the best rank that it has."""
    top = R.top_per_group(table(spark, sf_dir, "part"), ["p_brand", "p_type"], [F.desc("p_retailprice"), F.col("p_partkey")], 3)
    return top.groupBy("p_brand", "p_name").agg(F.min("rank").alias("rank"))


# dedup contracts


_DUP = "h as (select doc_id, source, n_chars, md5(lower(text)) as d from documents), g as (select d, count(*) as n, min(doc_id) as first, arg_max(doc_id, (n_chars, -doc_id)) as largest, arg_min(doc_id, ({r}, doc_id)) as random from h group by d)".format(r=_rnd("doc_id"))


@query(f"with {_DUP} select d as digest, n::bigint as n, first, largest, random from g where n > 1")
def duplicate_representatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each group of equal texts the row that each mode keeps: first, largest, or random."""
    h = table(spark, sf_dir, "documents").select("doc_id", "n_chars", F.md5(F.lower("text")).alias("digest"))
    return V.representatives(h, "digest", "doc_id", "n_chars").filter("n > 1")


@query(f"with {_DUP} select source, count(*)::bigint as total, count(*) filter (doc_id = first)::bigint as kept, round(1 - count(*) filter (doc_id = first) / count(*), 6) as reduction_rate from h join g using (d) group by source")
def dedup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source the rows that dedup keeps, and the share that it removes."""
    h = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars", F.md5(F.lower("text")).alias("digest"))
    kept = V.representatives(h, "digest", "doc_id", "n_chars").select("digest", "first")
    count = F.count_if(F.col("doc_id") == F.col("first"))
    return h.join(kept, "digest").groupBy("source").agg(F.count("*").alias("total"), count.alias("kept"), F.round(1 - count / F.count("*"), 6).alias("reduction_rate"))


@query(_PRINTS + """, c as (select a.doc_id, count(b.doc_id) as n from h a left join h b on a.doc_id <> b.doc_id and bit_count(xor(a.bits, b.bits)) <= 8 group by a.doc_id)
select doc_id, n::bigint as duplicates from c where n > 0""")
def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many other texts are within 8 bits of each text, also of texts that are duplicates themselves."""
    prints = _prints(spark, sf_dir).select("doc_id", "bits")
    counted = V.near_counts(prints, "doc_id", F.col("bits"), 8, 60).select(F.col("h").alias("bits"), (F.col("same") - 1 + F.col("near")).alias("duplicates"))
    return prints.join(counted, "bits").filter("duplicates > 0").select("doc_id", "duplicates")


@query(_PRINTS + """, p as (select b.doc_id from h a join h b on a.doc_id < b.doc_id and bit_count(xor(a.bits, b.bits)) <= 3)
select doc_id, source, doc_id not in (select doc_id from p) as is_unique from documents""")
def unique_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a nearer earlier one: all less the duplicates, each kept row once; texts without words stay."""
    prints = _prints(spark, sf_dir)
    pairs = V.hamming_pairs(prints, "doc_id", F.col("bits"), 3, 60)
    firsts = prints.filter("bits is not null").groupBy("bits").agg(F.min("doc_id").alias("k"))
    late = firsts.join(pairs.select(F.col("k_b").alias("k")).distinct(), "k", "left_semi").select("bits", F.lit(True).alias("late"))
    j = prints.join(firsts, "bits", "left").join(late, "bits", "left")
    first = F.col("bits").isNull() | (F.col("doc_id") == F.col("k")) & F.col("late").isNull()
    return j.select("doc_id", "source", first.alias("is_unique"))


@query(greedy_sql("doc_id, source, n_chars, dup is null as kept", 3, "n_chars desc, d.doc_id"))
def keep_highest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates within each source, the highest score first: a row stays unless a kept one is within 3 bits."""
    scored = _prints(spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
    ranked = positions(scored.withColumn("less", -F.col("n_chars")), ["less", "doc_id"], "rank")
    return V.first_wins(ranked, "source", "rank", "bits", 3, 60).select("doc_id", "source", "n_chars", F.col("duplicate_of").isNull().alias("kept"))


# balanced selections


@query(f"""
with t as (select doc_id, source, lang, n_chars, case when n_chars >= 3000 then 'A' when n_chars >= 1000 then 'B' end as tier from documents), e as (select tier, quantile_cont(n_chars, [0.2, 0.4, 0.6, 0.8]) as edges from t where tier is not null group by tier),
b as (select t.*, len(list_filter(edges, lambda x: n_chars >= x)) as bin from t join e using (tier)), r as (select *, row_number() over (partition by source, tier, bin order by {_rnd('doc_id')}, doc_id) as nth from b),
k as (select *, row_number() over (partition by source, tier order by nth > case tier when 'A' then 2 else 1 end, {_rnd('doc_id')}, doc_id) as turn from r)
select doc_id, source, tier from k where turn <= case tier when 'A' then 10 else 5 end order by {_rnd('doc_id')}, doc_id limit 200""")
def balanced_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each source ten rows of tier A and five of B, over the bins of their lengths, filled at random; 200 in random order."""
    t = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars", F.when(F.col("n_chars") >= 3000, "A").when(F.col("n_chars") >= 1000, "B").alias("tier")).filter("tier is not null")
    return S.tiered_review(t, "source", "tier", "n_chars", "doc_id", {"A": 10, "B": 5}, 200, 7).select("doc_id", "source", "tier")


@query("""
with s as (select source, lang, case when n_chars >= 3000 then 'A' else 'B' end as tier, n_chars from documents where doc_id % 2 = 0)
select 'source' as axis, source as value, count(*)::bigint as n, min(n_chars)::bigint as least, max(n_chars)::bigint as most, round(avg(n_chars), 6) as mean, round(median(n_chars), 6) as median, round(stddev_pop(n_chars), 6) as std from s group by source
union all select 'lang', lang, count(*), min(n_chars), max(n_chars), round(avg(n_chars), 6), round(median(n_chars), 6), round(stddev_pop(n_chars), 6) from s group by lang
union all select 'tier', tier, count(*), min(n_chars), max(n_chars), round(avg(n_chars), 6), round(median(n_chars), 6), round(stddev_pop(n_chars), 6) from s group by tier""")
def sample_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample's counts and score statistics by three axes."""
    s = table(spark, sf_dir, "documents").filter("doc_id % 2 = 0").select("source", "lang", F.when(F.col("n_chars") >= 3000, "A").otherwise("B").alias("tier"), "n_chars")
    long = s.unpivot(["n_chars"], ["source", "lang", "tier"], "axis", "value")
    median = quantiles(long, ["axis", "value"], "n_chars", [0.5]).select("axis", "value", F.round("quantile", 6).alias("median"))
    n = F.col("n_chars")
    sums = long.groupBy("axis", "value").agg(F.count("*").alias("n"), F.min(n).alias("least"), F.max(n).alias("most"), F.round(F.avg(n), 6).alias("mean"), F.round(F.stddev_pop(n), 6).alias("std"))
    return sums.join(median, ["axis", "value"])


@query(f"""
with t as (select p_name, row_number() over (order by {_rnd('p_name', 3)}, p_name) - 1 as i, count(*) over () as n from (select distinct p_name from part)), s as (select k, case when k < n then k else ('0x' || substr(md5('3:' || k), 1, 15))::bigint % n end as pick from range(150) r(k), (select any_value(n) as n from t))
select k::bigint as k, p_name from s join t on pick = i""")
def template_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every template once, then more with replacement, 150 in all."""
    names = table(spark, sf_dir, "part").select("p_name").distinct()
    return S.with_coverage(names, "p_name", 150, 3)


@query(f"""
with r as (select p_partkey, p_brand, row_number() over (partition by p_brand order by {_rnd('p_partkey')}, p_partkey) as nth from part), c as (select * from r where nth <= 2),
f as (select p_partkey, p_brand from r order by {_rnd("'fill' || p_partkey")}, p_partkey limit greatest(0, 80 - (select count(*) from c))), u as (select p_partkey, p_brand, 0 as fill from c union all select p_partkey, p_brand, 1 from f)
select p_partkey, p_brand, fill::int as fill from u order by fill, {_rnd('p_partkey')}, p_partkey limit 80""")
def category_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two prompts of each category, then more of all, which may repeat those, 80 in all."""
    return S.category_sample(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_brand", "p_partkey", 2, 80, 7)


@query(f"""
with p as (select distinct p_brand || ' ' || p_type as prompt, {_rnd("p_brand || ' ' || p_type", 5)} as r from part where p_size % 2 = 0), a as (select prompt, row_number() over (order by r, prompt) as i from p qualify i <= 60),
f as (select distinct p_brand || ' ' || p_type as prompt, {_rnd("p_brand || ' ' || p_type", 6)} as r from part), b as (select prompt, 60 + row_number() over (order by r, prompt) as i from f qualify i <= 160),
u as (select prompt, min(i) as i from (select * from a union all select * from b) group by prompt)
select prompt, row_number() over (order by i)::int as place from u order by place limit 100""")
def prompts_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mode's prompts without repeats in their order, filled up once, and cut at 100."""
    p = table(spark, sf_dir, "part").select(F.concat_ws(" ", "p_brand", "p_type").alias("prompt"), "p_size")
    drawn = lambda df, seed, n: df.select("prompt").distinct().orderBy(*S.random_order(seed, "prompt")).limit(n)
    place = lambda seed, first: first + F.row_number().over(Window.orderBy(*S.random_order(seed, "prompt")))  # noqa: E731  of at most 100 rows
    a = drawn(p.filter("p_size % 2 = 0"), 5, 60).withColumn("i", place(5, F.lit(0)))
    b = drawn(p, 6, 100).withColumn("i", place(6, F.lit(60)))
    u = a.union(b).groupBy("prompt").agg(F.min("i").alias("i")).orderBy("i").limit(100)
    return u.select("prompt", F.row_number().over(Window.orderBy("i")).alias("place"))


@query("""
with c as (select r_name, row_number() over (order by r_regionkey) - 1 as ci, count(*) over () as cn from region), t as (select unnest(['pose', 'action', 'expression']) as kind, unnest([0, 1, 2]) as ti), p as (select n_name, n_nationkey as pi from nation),
s as (select k as round, r_name, kind, (k * cn + ci) * 3 + ti as turn from range(8) r(k), c, t)
select round::bigint as round, r_name, kind, turn::bigint as turn, n_name as prompt from s join p on turn // 3 % 25 = pi""")
def round_robin_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounds of characters of types; the prompt is a counter's place in the list, which starts again at its end."""
    c = table(spark, sf_dir, "region").select("r_name", (F.row_number().over(Window.orderBy("r_regionkey")) - 1).alias("ci"))  # a short list
    n, prompts = c.count(), table(spark, sf_dir, "nation").count()
    kinds = F.posexplode(F.array(F.lit("pose"), F.lit("action"), F.lit("expression"))).alias("ti", "kind")
    s = c.withColumn("round", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(7).cast("long")))).select("*", kinds)
    s = s.withColumn("turn", ((F.col("round") * n + F.col("ci")) * 3 + F.col("ti")).cast("long")).withColumn("pi", F.floor(F.col("turn") / 3) % prompts)
    return s.join(table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("pi"), F.col("n_name").alias("prompt")), "pi").select("round", "r_name", "kind", "turn", "prompt")


_VALUES = {"a": ("part", "p_brand"), "b": ("part", "p_type"), "c": ("customer", "c_mktsegment"), "d": ("orders", "o_orderpriority"), "e": ("region", "r_name")}


@query("with " + ", ".join(f"{n} as (select {c} as {n} from (select distinct {c} from {t}) order by {_rnd(c, 9)}, {c} limit 3)" for n, (t, c) in _VALUES.items()) + f"""
select a, b, c, d, e from a, b, c, d, e order by a, b, c, d, e limit 243""")
def grid_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """floor(n^(1/5)) values drawn of each of five lists, and their combinations up to n = 243."""
    each = int(round(243 ** (1 / 5), 9))
    lists = [table(spark, sf_dir, t).select(F.col(c).alias(n)).distinct().orderBy(*S.random_order(9, n)).limit(each) for n, (t, c) in _VALUES.items()]
    return S.combinations(lists, 243)


@query("""
with g as (select source, count(*) as n from documents group by source)
select source, n::bigint as n, (case when n < 500 then 10 when n < 2000 then 20 when n < 5000 then 25 else 30 end)::int as min_cluster_size, greatest(2, least(40, n // 25))::bigint as clusters from g""")
def cluster_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The least cluster size by the number of images, and a number of clusters for about 25 each."""
    n = F.col("n")
    size = F.when(n < 500, 10).when(n < 2000, 20).when(n < 5000, 25).otherwise(30)
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n")).select("source", "n", size.alias("min_cluster_size"), F.greatest(F.lit(2), F.least(F.lit(40), F.floor(n / 25))).alias("clusters"))


@query("""
with p as (select p_brand, p_retailprice % 256 as b, p_size / 25.0 as a, row_number() over (partition by p_brand order by p_partkey) - 1 as i, count(*) over (partition by p_brand) as n from part),
s as (select * from p where n <= 20 or (i % (n // 20) = 0 and i // (n // 20) < 20))
select p_brand, case when count(*) < 2 then 0.0 else round(least(1.0, (stddev_pop(b) / 128 + stddev_pop(a) / 0.5) / 2), 3) end as diversity from s group by p_brand""")
def diversity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much up to 20 evenly strided rows of each cluster differ in brightness and aspect."""
    w = Window.partitionBy("p_brand")
    p = table(spark, sf_dir, "part").select("p_brand", (F.col("p_retailprice") % 256).alias("b"), (F.col("p_size") / 25.0).alias("a"), (F.row_number().over(w.orderBy("p_partkey")) - 1).alias("i"), F.count("*").over(w).alias("n"))
    step = F.greatest(F.floor(F.col("n") / 20), F.lit(1))
    s = p.filter((F.col("n") <= 20) | ((F.col("i") % step == 0) & (F.floor(F.col("i") / step) < 20)))
    spread = F.least(F.lit(1.0), (F.stddev_pop("b") / 128 + F.stddev_pop("a") / 0.5) / 2)
    return s.groupBy("p_brand").agg(F.when(F.count("*") < 2, 0.0).otherwise(F.round(spread, 3)).alias("diversity"))
