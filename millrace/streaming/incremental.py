"""Polling jobs as Structured Streaming: a file stream, an aggregation or anti-join, and a Parquet or memory sink."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from millrace.operators.rounds import shared_dir


def _work_dir(spark: SparkSession, name: str) -> str:
    """A folder of the shared one for a stream's checkpoint and output."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def source(spark: SparkSession, path: str) -> DataFrame:
    """A stream of the Parquet files at path, present and future; one file or a folder."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rstrip("/").rpartition("/")
    reader = spark.readStream.schema(schema)
    if path.endswith(".parquet") and _is_file(spark, path):
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def _is_file(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isFile()


def timed(stream: DataFrame, column: str = "ts") -> DataFrame:
    """The stream with its event time in the type that watermarks need."""
    return stream.withColumn(column, F.col(column).cast("timestamp"))


def run_available(df: DataFrame, work: str, mode: str, key: list[str] | None = None, dropped: bool = False) -> DataFrame | tuple[DataFrame, int]:
    """Run a stream over what is there, keep its last complete table or all appended rows, and return that; with `dropped`, also how
    many rows came behind the watermark.

    A batch is written to a folder of its number, so one that runs again replaces itself. In update mode later batches
    win for each key.
    """
    out = f"{work}/out"

    def save(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(out if mode == "complete" else f"{out}/batch={epoch}")

    job = df.writeStream.outputMode(mode).foreachBatch(save).option("checkpointLocation", f"{work}/state").trigger(availableNow=True).start()
    job.awaitTermination()
    spark = df.sparkSession
    if dropped:
        late = sum(int(state.get("numRowsDroppedByWatermark", 0)) for step in job.recentProgress for state in step["stateOperators"])
        return _kept(spark, df, out, mode, key), late
    return _kept(spark, df, out, mode, key)


def _kept(spark: SparkSession, df: DataFrame, out: str, mode: str, key: list[str] | None) -> DataFrame:
    """What a stream's batches have written."""
    if mode == "complete":
        return spark.read.schema(df.schema).parquet(out)
    where = spark._jvm.org.apache.hadoop.fs.Path(out)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], df.schema)
    rows = spark.read.schema(StructType([*df.schema.fields, StructField("batch", LongType())])).parquet(out)
    if mode == "update" and key:
        rest = [c for c in df.columns if c not in key]
        return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), "batch").alias("_last")).select(*key, "_last.*").select(*df.columns)
    return rows.drop("batch")


def stream_stats(spark: SparkSession, path: str) -> DataFrame:
    """Count, sum and maximum by event type over all files seen."""
    totals = source(spark, path).groupBy("event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"), F.max("value").alias("top"))
    return run_available(totals, _work_dir(spark, "stream-stats"), "complete")


def windows(stream: DataFrame, size: str, late: str = "2 days") -> DataFrame:
    """user_id, hour, n: counts by user and tumbling window. Windows leave the state once the watermark has passed them; rows later than that don't count."""
    counts = timed(stream).withWatermark("ts", late).groupBy("user_id", F.window("ts", size)).agg(F.count("*").alias("n"))
    return counts.select("user_id", F.col("window.start").cast("timestamp_ntz").alias("hour"), "n")


def stream_new_items(spark: SparkSession, path: str, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in `done`, appended as they come."""
    fresh = source(spark, path).join(done.select(key).distinct(), key, "left_anti")
    return run_available(fresh, _work_dir(spark, "stream-new"), "append")


def mark_processed(spark: SparkSession, path: str, key: str, late: str = "30 days") -> DataFrame:
    """key, first_seen of each item on a stream, once, however often it comes within the watermark."""
    items = timed(source(spark, path)).withWatermark("ts", late).dropDuplicatesWithinWatermark([key]).select(key, F.col("ts").cast("timestamp_ntz").alias("first_seen"))
    return run_available(items, _work_dir(spark, "stream-marks"), "append")


def resume_index(marks: DataFrame, group: str, index: str) -> DataFrame:
    """group, resume: where each job goes on, one after its last index."""
    return marks.groupBy(group).agg((F.max(index) + 1).alias("resume"))
