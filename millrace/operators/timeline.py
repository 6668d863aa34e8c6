"""Tracks, segments and neighbours in ordered tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merge_segments(df: DataFrame, group: list[str], label: str, start: str, end: str, gap: float) -> DataFrame:
    """Join neighbouring segments of one label whose gap is at most `gap`; a merged segment ends where its last part ends."""
    w = Window.partitionBy(*group).orderBy(start, end)
    new = (F.lag(label).over(w).isNull() | (F.lag(label).over(w) != F.col(label)) | (F.col(start) - F.lag(end).over(w) > gap)).cast("int")
    island = F.sum("_new").over(w)
    rows = df.withColumn("_new", new).withColumn("island", island)
    return rows.groupBy(*group, "island").agg(
        F.min_by(label, F.struct(start, end)).alias(label), F.min(start).alias(start), F.max_by(end, F.struct(start, end)).alias(end), F.count("*").alias("parts")
    )


def range_join(points: DataFrame, intervals: DataFrame, key: list[str], at: str, low: str, high: str, width: int) -> DataFrame:
    """Points within intervals (both ends included): intervals are cut into bins of `width`, so it is an equi-join."""
    cut = intervals.filter(F.col(low) <= F.col(high)).withColumn("_bin", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))))
    binned = points.withColumn("_bin", F.floor(F.col(at) / width))
    return binned.join(cut, [*key, "_bin"]).filter(F.col(at).between(F.col(low), F.col(high))).drop("_bin")


def neighbours(df: DataFrame, group: str, position: str, window: int) -> DataFrame:
    """Rows (group, position, neighbour, offset) of the places within `window` of each place that the table has."""
    wanted = df.select(group, position, F.explode(F.sequence(F.lit(-window), F.lit(window))).alias("offset")).filter("offset <> 0")
    wanted = wanted.withColumn("neighbour", F.col(position) + F.col("offset"))
    return wanted.join(df.select(F.col(group), F.col(position).alias("neighbour")), [group, "neighbour"])


def track_info(df: DataFrame, track: str, frame: str, score: str, owner: str, min_length: int = 1) -> DataFrame:
    """Length, first and last frame, mean score and first owner of each track; null tracks and short ones are dropped."""
    info = df.filter(F.col(track).isNotNull()).groupBy(track).agg(
        F.count("*").alias("num_frames"), F.min(frame).alias("start_frame"), F.max(frame).alias("end_frame"),
        F.avg(F.coalesce(score, F.lit(0.0))).alias("avg_score"), F.min_by(owner, frame).alias("owner"),
    )
    return info.filter(F.col("num_frames") >= min_length)


def interpolate(df: DataFrame, group: str, order: str, value: str, times: int) -> DataFrame:
    """times - 1 rows between neighbours, weighted k / times; the last row of a group stays alone."""
    w = Window.partitionBy(group).orderBy(order)
    ahead = df.select(group, order, value, F.lead(value).over(w).alias("_next"))
    steps = ahead.withColumn("step", F.explode(F.when(F.col("_next").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(times - 1)))))
    weight = F.col("step") / times
    return steps.select(group, order, "step", (F.col(value) * (1 - weight) + F.coalesce("_next", value) * weight).alias(value))


def fold_last(df: DataFrame, group: str, order: list[str], fields: list[str]) -> DataFrame:
    """The last value that is not null of each field, by group."""
    return df.groupBy(group).agg(*(F.max_by(f, F.when(F.col(f).isNotNull(), F.struct(*order))).alias(f) for f in fields))


def activity_runs(df: DataFrame, group: str, order: str, voice: str, width: int, step: float, least: float) -> DataFrame:
    """group, start, stop (frames from 1, stop excluded), duration: runs of true after a median filter over `width` frames.

    Frames outside the sequence are false. A run ends at a false frame; one that reaches the end of the sequence is left out.
    """
    w = Window.partitionBy(group).orderBy(order)
    half = width // 2
    near = F.sum(F.col(voice).cast("int")).over(w.rowsBetween(-half, half))
    rows = df.select(group, order, F.row_number().over(w).alias("_i"), (near > half).alias("_on"), F.count("*").over(Window.partitionBy(group)).alias("_last"))
    rows = rows.withColumn("_run", F.col("_i") - F.row_number().over(Window.partitionBy(group, "_on").orderBy(order))).filter("_on")
    runs = rows.groupBy(group, "_run").agg(F.min("_i").alias("start"), (F.max("_i") + 1).alias("stop"), F.max("_last").alias("_last")).filter("stop <= _last")
    length = F.round((F.col("stop") - F.col("start")) * step, 6)
    return runs.select(group, "start", "stop", length.alias("duration")).filter(F.col("duration") >= least)
