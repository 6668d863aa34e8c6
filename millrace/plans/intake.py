"""Rows of sources: frames of videos, positions at intervals, parsed names, flat tracks, merged folders and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import geometry as G
from millrace.operators import records as R
from millrace.operators.rounds import shared_dir
from millrace.plans.assessments import _IMG, _ISSUES, _images
from millrace.plans.captions import SD_SQL
from millrace.plans.registry import query
from millrace.session import table
from millrace.sources import files


@query("select p_partkey || '_' || lpad(k::varchar, 6, '0') as frame_id, p_partkey, k::bigint as frame_index from part, range(50) r(k) where k < p_size")
def video_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each frame of each video (parts stand in, with their size as the number of frames)."""
    return files.frame_rows(table(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_partkey", "p_size")


@query("select n_name || '_' || lpad(k::varchar, 6, '0') as frame_id, n_name as video_id, k::bigint as frame_index, sha1(n_name || '_' || lpad(k::varchar, 6, '0')) as phash from nation, range(3) r(k)")
def placeholder_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three frames without pictures of each video, with a hash of their id."""
    rows = files.frame_rows(table(spark, sf_dir, "nation").select(F.col("n_name").alias("video_id"), F.lit(3).alias("n")), "video_id", "n")
    return rows.select("frame_id", "video_id", "frame_index", F.sha1("frame_id").alias("phash"))


@query("""
with v as (select o_orderkey, o_custkey % 400 as total, 24 + o_orderkey % 7 as fps from orders), s as (select *, greatest(1, case o_orderkey % 3 when 0 then floor(fps * 2.5) when 1 then 40 else fps end)::bigint as step from v)
select o_orderkey, unnest(range(0, total, step))::bigint as frame from s""")
def interval_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames at equal steps from 0 on; the step comes from seconds, from frames, or is a second's."""
    key, fps = F.col("o_orderkey"), F.lit(24) + F.col("o_orderkey") % 7
    step = F.when(key % 3 == 0, files.interval_step(fps, seconds=2.5)).when(key % 3 == 1, files.interval_step(fps, frames=40)).otherwise(files.interval_step(fps))
    v = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 400).alias("total"), step.alias("step"))
    return v.select("o_orderkey", F.explode(files.interval_positions(F.col("total"), F.col("step"))).alias("frame"))


@query("""
with n as (select event_id, case event_id % 3 when 0 then 'scene' || user_id || '_pos' || event_id % 9 || '_frame' || lpad(event_id::varchar, 6, '0') || '_t' || value::varchar || 's.jpg' when 1 then 'x_' || lpad(event_id::varchar, 4, '0') || '.png' else 'plain.png' end as name from events)
select event_id, split_part(regexp_replace(name, '\\.[^.]+$', ''), '_', 1) as scene, case when event_id % 3 = 0 then (event_id % 9)::int end as pos, case when event_id % 3 = 2 then -1 else event_id end::int as number from n""")
def parsed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scene, position and frame number out of file names of three kinds."""
    e = F.col("event_id")
    digits = lambda n: F.lpad(e.cast("string"), F.greatest(F.lit(n), F.length(e.cast("string"))), F.lit("0"))  # noqa: E731  # lpad alone would cut longer numbers
    long = F.concat(F.lit("scene"), "user_id", F.lit("_pos"), e % 9, F.lit("_frame"), digits(6), F.lit("_t"), F.col("value").cast("string"), F.lit("s.jpg"))
    name = F.when(e % 3 == 0, long).when(e % 3 == 1, F.concat(F.lit("x_"), digits(4), F.lit(".png"))).otherwise("plain.png")
    named = table(spark, sf_dir, "events").select("event_id", name.alias("name"))
    parts = files.parse_frame_name(F.col("name"))
    return named.select("event_id", parts["scene"].alias("scene"), parts["pos"].alias("pos"), files.frame_number(F.col("name")).alias("number"))


@query("select user_id || ':' || event_type as track, event_id, value as score from events where event_type in ('click', 'view')")
def exported_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks with their detections, flat, written to the shared folder and read again."""
    ev = table(spark, sf_dir, "events").filter(F.col("event_type").isin("click", "view"))
    # a row has a stretch of a track, of a bounded number of events, so long tracks are not gathered in one
    stretch = F.floor(F.col("event_id") / 2000)
    tracks = ev.groupBy(F.concat_ws(":", F.col("user_id").cast("string"), "event_type").alias("track"), stretch.alias("stretch")).agg(F.array_sort(F.collect_list(F.struct("event_id", F.col("value").alias("score")))).alias("detections")).drop("stretch")
    import uuid

    path = files.export_tracks(tracks, "track", "detections", f"{shared_dir(spark)}/tracks-{uuid.uuid4().hex}.parquet")
    return files.load_records(spark, path, required=["track", "event_id"])


@query("select p_brand || '_' || p_name || '_' || p_partkey as name, 'merged' as target from part where p_brand in ('Brand#1', 'Brand#2', 'Brand#3')")
def merged_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of three clusters in one folder, with their source in front of the name."""
    p = table(spark, sf_dir, "part").select("p_brand", F.concat_ws("_", "p_name", F.col("p_partkey").cast("string")).alias("name"))
    return files.merged_names(p, "name", "p_brand", ["Brand#1", "Brand#2", "Brand#3"], "merged").select("name", "target")


@query("""
with n as (select p_name as name, row_number() over (partition by p_name order by p_partkey) - 1 as i, p_partkey from part) select p_partkey, case when i = 0 then name else name || '_' || i end as name from n""")
def unique_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of exported files; a name that is taken gets a number."""
    return files.with_unique_names(table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("name")), "name", ["p_partkey"])


@query("select 'region' as stage, count(*)::bigint as rows, 'complete' as status from region union all select 'nation', count(*), 'complete' from nation union all select 'none', 0, 'empty'")
def stage_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and status of each stage's table."""
    nation = table(spark, sf_dir, "nation")
    return files.manifest({"region": table(spark, sf_dir, "region"), "nation": nation, "none": nation.filter("n_nationkey < 0")})


@query("""
with r as (select case when o_orderkey % 11 = 0 then 'bad' else o_orderkey::varchar end as idx, case when o_orderkey % 7 = 0 then 'n/a' else o_totalprice::varchar end as sharp from orders)
select coalesce(try_cast(idx as int), -1) as idx, coalesce(try_cast(sharp as double), 0.0) as sharp from r where coalesce(try_cast(idx as int), -1) >= 0""")
def report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report's rows, written as CSV and read again: bad numbers are 0, rows with a bad index go."""
    import uuid

    key = F.col("o_orderkey")
    raw = table(spark, sf_dir, "orders").select(F.when(key % 11 == 0, "bad").otherwise(key.cast("string")).alias("idx"), F.when(key % 7 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("sharp"))
    path = files.save_records(raw, f"{shared_dir(spark)}/report-{uuid.uuid4().hex}.csv")
    return files.load_report_csv(spark, path, "idx", ["sharp"], [])


@query(_IMG + _ISSUES + """ , r as (select p_partkey, p_brand, round(score, 6) as score, array_to_string(issues, ';') as issues, row_number() over (order by round(score, 6), p_partkey) as place from s where not (len(issues) = 0 and score >= 50))
select p_partkey, p_brand, score, issues, place::int as place from r where place <= 100""")
def worst_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hundred worst rows that fail the assessment."""
    from pyspark.sql import Window

    s = _images(spark, sf_dir).filter(~((F.size("issues") == 0) & (F.col("score") >= 50))).select("p_partkey", "p_brand", F.round("score", 6).alias("score"), F.array_join("issues", ";").alias("issues"))
    top = s.orderBy("score", "p_partkey").limit(100)
    return top.withColumn("place", F.row_number().over(Window.orderBy("score", "p_partkey")))


@query(_IMG + _ISSUES + " select p_brand, split_part(issue, ':', 1) as issue, count(*)::bigint as n from (select p_brand, unnest(issues) as issue from s) group by all")
def issue_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each issue comes up in each folder."""
    named = _images(spark, sf_dir).select("p_brand", F.explode("issues").alias("issue"))
    return named.groupBy("p_brand", F.split_part("issue", F.lit(":"), F.lit(1)).alias("issue")).agg(F.count("*").alias("n"))


@query(f"""
with d as (select source, doc_id % 1900 + 100 as w, n_chars % 1900 + 100 as h, {SD_SQL} as tokens from documents),
b as (select *, case when w * h >= 2073600 then 'hd+' when w * h >= 921600 then 'hd' when w * h >= 409600 then 'medium' when w * h >= 102400 then 'small' else 'tiny' end as bucket from d)
select coalesce(source, 'total') as source, count(*)::bigint as images, min(w)::bigint as min_width, max(w)::bigint as max_width, floor(avg(w))::bigint as avg_width, count(*) filter (bucket = 'hd+')::bigint as hd_plus, count(*) filter (bucket = 'small')::bigint as small,
  round(avg(tokens), 6) as avg_tokens, (rank() over (partition by grouping(source) order by count(*) desc))::int as rank from b group by rollup (source)""")
def dataset_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, sizes and caption tokens of each dataset and of all, ranked by the number of images."""
    from pyspark.sql import Window

    from millrace.functions.text import sd_tokens

    d = table(spark, sf_dir, "documents").select("source", (F.col("doc_id") % 1900 + 100).alias("w"), (F.col("n_chars") % 1900 + 100).alias("h"), sd_tokens(F.col("text")).alias("tokens"))
    d = d.withColumn("bucket", G.resolution_bucket(F.col("w"), F.col("h")))
    g = d.rollup("source").agg(
        F.grouping("source").alias("whole"), F.count("*").alias("images"), F.min("w").alias("min_width"), F.max("w").alias("max_width"), F.floor(F.avg("w")).alias("avg_width"), F.count_if(F.col("bucket") == "hd+").alias("hd_plus"),
        F.count_if(F.col("bucket") == "small").alias("small"), F.round(F.avg("tokens"), 6).alias("avg_tokens"),
    )
    return g.withColumn("rank", F.rank().over(Window.partitionBy("whole").orderBy(F.desc("images")))).withColumn("source", F.coalesce("source", F.lit("total"))).drop("whole")


@query("""
with u as (select doc_id, n_chars, 0 as version, 'pending' as status from documents union all select doc_id, quality * 1000 + toxic, 1, case quality when 1 then 'approved' else 'rejected' end from labels)
select status, count(*)::bigint as n from (select doc_id, arg_max(status, version) as status from u group by doc_id) group by status""")
def review_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with the reviews that overwrite them, counted by status."""
    base = table(spark, sf_dir, "documents").select("doc_id", F.lit(0).alias("version"), F.lit("pending").alias("status"))
    review = table(spark, sf_dir, "labels").select("doc_id", F.lit(1).alias("version"), F.when(F.col("quality") == 1, "approved").otherwise("rejected").alias("status"))
    return R.upsert(base, review, ["doc_id"], "version").groupBy("status").agg(F.count("*").alias("n"))
