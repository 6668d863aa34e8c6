"""Tracks, merged segments, range joins and streams over events and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import geometry as G
from millrace.operators import timeline as L
from millrace.plans.registry import query
from millrace.session import table
from millrace.streaming import incremental


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("sec", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)


_SEC = "epoch_us(ts) / 1e6"
_TRACK = f"""
with t as (select user_id || ':' || event_type as track, count(*) as num_frames, min({_SEC}) as start_frame, max({_SEC}) as end_frame, avg(coalesce(value, 0)) as avg_score, arg_min(user_id, {_SEC}) as owner from events where event_type is not null group by track)"""


@query(_TRACK + " select track, num_frames::bigint as num_frames, start_frame, end_frame, round(avg_score, 6) as avg_score, owner from t where num_frames >= 5")
def track_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per track: length, first and last time, mean score; tracks of fewer than 5 events are dropped."""
    return _tracks(spark, sf_dir, 5).withColumn("avg_score", F.round("avg_score", 6))


def _tracks(spark: SparkSession, sf_dir: str, min_length: int) -> DataFrame:
    ev = _events(spark, sf_dir).withColumn("track", F.concat(F.col("user_id").cast("string"), F.lit(":"), F.col("event_type")))
    return L.track_info(ev, "track", "sec", "value", "user_id", min_length)


@query(_TRACK + " select count(*)::bigint as tracks, round(avg(num_frames), 6) as avg_length, min(num_frames)::bigint as min_length, max(num_frames)::bigint as max_length, round(avg(avg_score), 6) as mean_of_means from t")
def track_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths, and the mean of the tracks' means, not weighted by length."""
    return _tracks(spark, sf_dir, 1).agg(
        F.count("*").alias("tracks"), F.round(F.avg("num_frames"), 6).alias("avg_length"), F.min("num_frames").alias("min_length"), F.max("num_frames").alias("max_length"), F.round(F.avg("avg_score"), 6).alias("mean_of_means")
    )


@query("""
with e as (select event_id, user_id, event_type, count(*) over (partition by user_id, event_type) as n from events where event_type is not null)
select event_id, user_id, event_type from e where n >= 12""")
def track_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of tracks with 12 events or more: track sizes are counted first and joined, so no track is held in one task."""
    ev = table(spark, sf_dir, "events").filter("event_type is not null").select("event_id", "user_id", "event_type")
    long_ = ev.groupBy("user_id", "event_type").agg(F.count("*").alias("n")).filter("n >= 12").drop("n")
    return ev.join(long_, ["user_id", "event_type"], "left_semi").select("event_id", "user_id", "event_type")


_SEG = f"""
with s as (select user_id, event_type, event_id, {_SEC} as s, {_SEC} + 60 + (event_id % 7) * 600 as e from events),
n as (select *, case when lag(event_type) over w is null or lag(event_type) over w <> event_type or s - lag(e) over w > 3600 then 1 else 0 end as new from s window w as (partition by user_id order by s, e)),
i as (select *, sum(new) over (partition by user_id order by s, e) as island from n),
m as (select user_id, island, arg_min(event_type, s) as event_type, min(s) as s, arg_max(e, s) as e, count(*) as parts from i group by user_id, island)"""


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    return ev.select("user_id", "event_type", "event_id", F.col("sec").alias("s"), (F.col("sec") + 60 + (F.col("event_id") % 7) * 600).alias("e"))


@query(_SEG + " select user_id, island::bigint as island, event_type, round(s, 3) as s, round(e, 3) as e, parts::bigint as parts from m")
def merge_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring segments of one type within an hour of each other become one."""
    merged = L.merge_segments(segments(spark, sf_dir), ["user_id"], "event_type", "s", "e", 3600)
    return merged.select("user_id", F.col("island").cast("long").alias("island"), "event_type", F.round("s", 3).alias("s"), F.round("e", 3).alias("e"), "parts")


@query("""
with g as (select role, count(*) as turns, sum(length(text)) as chars, count(distinct conv_id) as conversations from conversations group by role)
select coalesce(role, 'unknown') as role, turns::bigint as turns, chars::bigint as chars, conversations::bigint as conversations, round(chars / (select sum(chars) from g), 6) as share from g""")
def speaker_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per role: turns, characters, conversations, and its share of all characters."""
    g = table(spark, sf_dir, "conversations").groupBy("role").agg(F.count("*").alias("turns"), F.sum(F.char_length("text")).alias("chars"), F.countDistinct("conv_id").alias("conversations"))
    total = g.agg(F.sum("chars").alias("all_chars"))  # one row
    return g.crossJoin(F.broadcast(total)).select(F.coalesce("role", F.lit("unknown")).alias("role"), "turns", "chars", "conversations", F.round(F.col("chars") / F.col("all_chars"), 6).alias("share"))


_OVER = f"""
with a as (select event_id, user_id, floor({_SEC})::bigint as at, event_type from events),
v as (select event_id as seg, user_id, event_type as speaker, floor({_SEC})::bigint - 1800 as lo, floor({_SEC})::bigint + 5400 as hi from events where event_type in ('purchase', 'click')),
o as (select v.seg, v.user_id, v.speaker, a.event_type as face, count(*) as n from v join a on a.user_id = v.user_id and a.at between v.lo and v.hi and a.event_type <> v.speaker group by all)"""


def _overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").withColumn("at", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).cast("long"))
    points = ev.select("user_id", "at", F.col("event_type").alias("face"))
    spans = ev.filter(F.col("event_type").isin("purchase", "click")).select("user_id", F.col("event_id").alias("seg"), F.col("event_type").alias("speaker"), (F.col("at") - 1800).alias("lo"), (F.col("at") + 5400).alias("hi"))
    met = L.range_join(points, spans, ["user_id"], "at", "lo", "hi", 7200).filter("face <> speaker")
    return met.groupBy("seg", "user_id", "speaker", "face").agg(F.count("*").alias("n"))


@query(_OVER + " select seg, user_id, speaker, face, n::bigint as n from o")
def segment_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of a user's other events fall into the two hours around a purchase or click."""
    return _overlap(spark, sf_dir)


@query(_OVER + """, s as (select user_id, speaker, face, sum(least(n / 2.0, 3.0)) as overlap from o group by all),
t as (select user_id, event_type as speaker, count(*) * 3.0 as total from events where event_type in ('purchase', 'click') group by all),
c as (select t.user_id, t.speaker, face, round(least(1.0, overlap / total), 9) as confidence from t left join s on s.user_id = t.user_id and s.speaker = t.speaker),
r as (select *, row_number() over (partition by user_id, speaker order by confidence desc nulls last, face) as rank from c)
select user_id, speaker, case when confidence >= 0.2 then face else 'UNKNOWN' end as character, coalesce(confidence, 0.0)::double as confidence from r where rank = 1""")
def speaker_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each user and speaker the face that overlaps most; UNKNOWN below 0.2."""
    faces = _overlap(spark, sf_dir).groupBy("user_id", "speaker", "face").agg(F.sum(F.least(F.col("n") / 2.0, F.lit(3.0))).alias("overlap"))
    total = table(spark, sf_dir, "events").filter(F.col("event_type").isin("purchase", "click")).groupBy("user_id", F.col("event_type").alias("speaker")).agg((F.count("*") * 3.0).alias("total"))
    scored = total.join(faces, ["user_id", "speaker"], "left").withColumn("confidence", F.round(F.least(F.lit(1.0), F.col("overlap") / F.col("total")), 9))
    best = scored.groupBy("user_id", "speaker").agg(F.min_by(F.struct("face", "confidence"), F.struct(F.col("confidence").isNull(), -F.col("confidence"), "face")).alias("b"))
    return best.select("user_id", "speaker", F.when(F.col("b.confidence") >= 0.2, F.col("b.face")).otherwise("UNKNOWN").alias("character"), F.coalesce("b.confidence", F.lit(0.0)).alias("confidence"))


@query("""
with p as (select user_id, row_number() over (partition by user_id order by ts, event_id) as position, event_type from events), k as (select * from p where event_type = 'purchase')
select k.user_id, k.position::int as position, (b.position - k.position)::int as "offset", b.position::int as neighbour from k join k b on b.user_id = k.user_id and abs(b.position - k.position) <= 4 and b.position <> k.position""")
def temporal_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases with another purchase of the user within 4 of their events."""
    from pyspark.sql import Window

    p = table(spark, sf_dir, "events").select("user_id", "event_type", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).alias("position"))
    return L.neighbours(p.filter("event_type = 'purchase'").select("user_id", "position"), "user_id", "position", 4).select("user_id", "position", "offset", "neighbour")


@query("""
with n as (select user_id, event_id, value, lead(value) over (partition by user_id order by event_id) as next from events), k as (select *, unnest(case when next is null then [0] else [0, 1, 2] end) as step from n)
select user_id, event_id, step::int as step, round(value * (1 - step / 3) + coalesce(next, value) * (step / 3), 6) as value from k""")
def interpolate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rows between each pair of a user's events."""
    ev = table(spark, sf_dir, "events").select("user_id", "event_id", "value")
    return L.interpolate(ev, "user_id", "event_id", "value", 3).withColumn("value", F.round("value", 6))


@query("""
with l as (select user_id, ts, event_id, try_cast(json_extract_string(props, '$.k') as bigint) as k, case when value > 100 then value end as high from events)
select user_id, arg_max(k, (ts, event_id)) filter (k is not null) as k, arg_max(high, (ts, event_id)) filter (high is not null) as high from l group by user_id""")
def log_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last value seen of each field, by user."""
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", F.get_json_object("props", "$.k").try_cast("long").alias("k"), F.when(F.col("value") > 100, F.col("value")).alias("high"))
    return L.fold_last(ev, "user_id", ["ts", "event_id"], ["k", "high"])


@query("""
with s as (select o_orderkey, (o_orderkey % 50)::bigint as st, (o_orderkey % 50 + 5 + o_custkey % 90)::bigint as en from orders),
t as (select *, en - st as len, case when en - st > 7 then floor((en - st) * 0.1)::bigint else 0 end as trim from s)
select o_orderkey, unnest(case when len < 10 then []::bigint[] else [st + trim + floor((en - trim - 1 - st - trim) * i / 4)::bigint for i in range(5)] end) as frame from t""")
def scene_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five evenly spaced frames of each scene (orders stand in for scenes)."""
    o = table(spark, sf_dir, "orders")
    scenes = o.select("o_orderkey", (F.col("o_orderkey") % 50).alias("st"), (F.col("o_orderkey") % 50 + 5 + F.col("o_custkey") % 90).alias("en"))
    return scenes.select("o_orderkey", F.explode(G.scene_positions(F.col("st"), F.col("en"), 5)).alias("frame"))


@query("""
select event_type, count(*)::bigint as n, round(sum(value), 4) as total, max(value) as top from events group by event_type""")
def stream_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative statistics by type, made by a file stream that reads what is there and ends."""
    return incremental.stream_stats(spark, f"{sf_dir}/events.parquet").select("event_type", "n", F.round("total", 4).alias("total"), "top")


@query("select event_id, event_type, value from events where event_id % 3 <> 0")
def stream_new_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items that arrive on the stream and are not among those processed before."""
    done = table(spark, sf_dir, "events").filter("event_id % 3 = 0").select("event_id")
    return incremental.stream_new_items(spark, f"{sf_dir}/events.parquet", done, "event_id").select("event_id", "event_type", "value")


@query("select event_id, min(ts) as first_seen from events group by event_id")
def stream_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items marked as processed once."""
    return incremental.mark_processed(spark, f"{sf_dir}/events.parquet", "event_id").select("event_id", "first_seen")


@query("select u.user_id, coalesce(max(event_id) + 1, 0)::bigint as resume from (select c_custkey as user_id from customer) u left join events e on u.user_id = e.user_id and event_type <> 'error' group by u.user_id")
def resume_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each job goes on: one after its last index, 0 for one that has not begun."""
    done = incremental.resume_index(table(spark, sf_dir, "events").filter("event_type <> 'error'"), "user_id", "event_id")
    jobs = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    return jobs.join(done, "user_id", "left").select("user_id", F.coalesce("resume", F.lit(0)).cast("long").alias("resume"))


@query(r"""
with l as (select user_id, event_id, case event_id % 5 when 0 then 'epoch ' || event_id % 9 || '/10' when 1 then 'steps: ' || event_id || '/9000 loss=' || value::varchar when 2 then 'CUDA out of memory' when 3 then 'RuntimeError: x' else 'fine' end as line from events),
f as (select user_id, event_id, try_cast(regexp_extract(line, '(?i)epoch\s+(\d+)/\d+', 1) as int) as epoch, try_cast(regexp_extract(line, '(?i)steps?:?\s+(\d+)/\d+', 1) as int) as step, try_cast(regexp_extract(line, 'loss[=:\s]+([0-9]*\.?[0-9]+)', 1) as double) as loss,
  case when regexp_matches(line, '(?i)out of memory|oom') then 'oom_error' when regexp_matches(line, '(?i)error|exception|traceback') then 'generic_error' end as error from l)
select user_id, arg_max(epoch, event_id) filter (epoch is not null) as epoch, arg_max(step, event_id) filter (step is not null) as step, arg_max(loss, event_id) filter (loss is not null) as loss, arg_max(error, event_id) filter (error is not null) as error, count(error)::bigint as errors from f group by user_id""")
def log_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record that a job's log lines fold into, with its last error and their number."""
    from millrace.functions.scores import log_fields

    e, text = F.col("event_id"), F.col("event_id").cast("string")
    line = F.when(e % 5 == 0, F.concat(F.lit("epoch "), (e % 9).cast("string"), F.lit("/10"))).when(e % 5 == 1, F.concat(F.lit("steps: "), text, F.lit("/9000 loss="), F.col("value").cast("string")))
    line = line.when(e % 5 == 2, "CUDA out of memory").when(e % 5 == 3, "RuntimeError: x").otherwise("fine")
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", line.alias("line")).select("user_id", "event_id", *(v.alias(k) for k, v in log_fields(F.col("line")).items()))
    fields = ["epoch", "step", "loss", "error"]
    return L.fold_last(rows, "user_id", ["event_id"], fields).join(rows.groupBy("user_id").agg(F.count("error").alias("errors")), "user_id")


@query("""
with d as (select user_id as track, event_id as frame, value as x1, event_id % 7 as y1, value + 60 as x2, event_id % 7 + 10 as y2 from events),
w as (select *, row_number() over t - 1 as place, frame - lag(frame) over t as gap, lag(x1) over t as a1, lag(y1) over t as b1, lag(x2) over t as a2, lag(y2) over t as b2 from d window t as (partition by track order by frame)),
s as (select *, greatest(0, least(x2, a2) - greatest(x1, a1)) * greatest(0, least(y2, b2) - greatest(y1, b1)) as shared from w)
select track, frame, place::int as place, gap::bigint as gap, case when a1 is not null then round(shared / ((x2 - x1) * (y2 - y1) + (a2 - a1) * (b2 - b1) - shared), 9) end as overlap from s""")
def track_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections of each track in order, with the gap to the one before and the overlap with its box, by a table function in SQL."""
    from millrace.functions.tables import register_table_functions

    register_table_functions(spark)
    boxes = "select user_id as track, event_id as frame, value as x1, event_id % 7 as y1, value + 60 as x2, event_id % 7 + 10 as y2"
    table(spark, sf_dir, "events").createOrReplaceTempView("_millrace_events")
    rows = spark.sql(f"select * from track_rows(table({boxes} from _millrace_events), 'track', 'frame')")
    return rows.select("track", "frame", "place", "gap", F.round("overlap", 9).alias("overlap"))
