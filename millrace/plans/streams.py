"""Streams that come in three parts, with state that is kept between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.registry import query
from millrace.plans.vectors import _prints, greedy_sql
from millrace.session import table
from millrace.streaming import incremental
from millrace.streaming import stateful as S


def _thirds(df: DataFrame, value: Column) -> list[DataFrame]:
    """df by thirds of the range of a whole number."""
    ends = df.agg(F.min(value).alias("low"), F.max(value).alias("high")).first()
    low, width = ends["low"] or 0, (ends["high"] or 0) - (ends["low"] or 0)
    first, second = low + width // 3, low + 2 * width // 3
    return [df.filter(value < first), df.filter((value >= first) & (value < second)), df.filter(value >= second)]


@query(greedy_sql("source as \"group\", doc_id as k, dup as duplicate_of", 3))
def stream_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-wins dedup of fingerprints by source, with the kept ones as a stream's state: what the batch rule gives."""
    parts = _thirds(_prints(spark, sf_dir), F.col("doc_id"))
    return S.fed(spark, parts, lambda s: S.first_wins_stream(s, "source", "doc_id", "bits", 3, total_bits=60), "append", "stream-first-wins")[0]


_LINE = """case when event_id % 97 = 2 then 'CUDA out of memory' when event_id % 89 = 3 then 'RuntimeError: x' when event_id % 5 = 0 then 'epoch ' || event_id % 9 || '/10' when event_id % 5 = 1 then 'steps: ' || event_id || '/9000 loss=' || value::varchar else 'fine' end"""


@query(rf"""
with l as (select user_id, event_id, ts, {_LINE} as line from events), f as (select *, try_cast(regexp_extract(line, 'epoch (\d+)/', 1) as int) as epoch, try_cast(regexp_extract(line, 'steps: (\d+)/', 1) as int) as step, try_cast(regexp_extract(line, 'loss=([0-9.]+)', 1) as double) as loss,
  min(event_id) filter (line like 'CUDA%' or line like '%Error%') over (partition by user_id) as stop from l),
k as (select * from f where stop is null or event_id <= stop)
select user_id::varchar as job, arg_max(epoch, event_id) filter (epoch is not null) as epoch, arg_max(step, event_id) filter (step is not null) as step, arg_max(loss, event_id) filter (loss is not null) as loss,
  case when arg_max(line, event_id) like 'CUDA%' then 'oom_error' when arg_max(line, event_id) like '%Error%' then 'failed' when epoch_us(max(ts)) + 172800000000 <= (select epoch_us(max(ts)) from events) - 3600000000 then 'completed' else 'running' end as status,
  case when arg_max(line, event_id) like 'CUDA%' or arg_max(line, event_id) like '%Error%' then arg_max(line, event_id) end as message, max(event_id) as line, count(*)::bigint as lines from k group by user_id""")
def job_monitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record of each job (user) that its log lines give, up to its first error or until it is quiet for two days."""
    e, text = F.col("event_id"), F.col("event_id").cast("string")
    line = F.when(e % 97 == 2, "CUDA out of memory").when(e % 89 == 3, "RuntimeError: x").when(e % 5 == 0, F.concat(F.lit("epoch "), (e % 9).cast("string"), F.lit("/10")))
    line = line.when(e % 5 == 1, F.concat(F.lit("steps: "), text, F.lit("/9000 loss="), F.col("value").cast("string"))).otherwise("fine")
    lines = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", line.alias("line"))
    job = lambda s: S.monitor_jobs(s, "user_id", "event_id", "line", quiet_seconds=172_800)
    return S.fed(spark, _thirds(lines, F.unix_micros(F.col("ts").cast("timestamp"))), job, "update", "job-monitor", ["job"])[0].drop("rate")


@query("""
with b as (select min(epoch_us(ts)) as low, max(epoch_us(ts)) as high from events), e as (select user_id, ts from events, b where not (event_id % 50 = 0 and epoch_us(ts) < low + (high - low) // 3)),
n as (select *, case when ts - lag(ts) over w < interval 12 hour then 0 else 1 end as new from e window w as (partition by user_id order by ts)), i as (select *, sum(new) over (partition by user_id order by ts) as run from n),
s as (select user_id, min(ts) as start, max(ts) as stop, count(*)::bigint as parts from i group by user_id, run) select s.* from s, b where epoch_us(stop) + 43200000000 <= high - 86400000000""")
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of a user's events less than 12 hours apart that are over; some early events come with the last part, and are too late."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    first, second, third = _thirds(events, F.unix_micros(F.col("ts").cast("timestamp")))
    late = F.col("event_id") % 50 == 0
    parts = [first.filter(~late), second, third.unionByName(first.filter(late))]
    return S.fed(spark, parts, lambda s: S.sessions(s, "user_id", gap="12 hours"), "append", "stream-sessions")[0]


@query("""
with b as (select min(epoch_us(ts)) as low, max(epoch_us(ts)) as high from events), e as (select *, epoch_us(ts) < low + (high - low) // 3 as early from events, b),
m as (select max(ts) filter (early and event_id % 40 <> 0) - interval 2 days as mark from e), k as (select user_id, time_bucket(interval 1 hour, ts) as hour, early and event_id % 40 = 0 as late from e)
select user_id, hour, count(*)::bigint as n from k, m where not late or hour + interval 1 hour > mark group by user_id, hour""")
def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts by user. Some early events come late: those of the last two days before the first part's end count, the others don't."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    first, second, third = _thirds(events, F.unix_micros(F.col("ts").cast("timestamp")))
    late = F.col("event_id") % 40 == 0
    parts = [first.filter(~late), first.filter(late).unionByName(second).unionByName(third)]
    return S.fed(spark, parts, lambda s: incremental.windows(s, "1 hour"), "update", "stream-windows", ["user_id", "hour"])[0]
