"""Readers and writers of the formats that curation jobs exchange."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.operators.records import require_columns


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def load_records(spark: SparkSession, path: str, schema: StructType | None = None, required: list[str] | None = None) -> DataFrame:
    """A Parquet or CSV table by its suffix; where it is absent, the file with the other suffix.

    A missing column raises; an absent table gives no rows if a schema is given, else raises.
    """
    stem, dot, suffix = path.rpartition(".")
    tries = [path] + ([f"{stem}.csv" if suffix == "parquet" else f"{stem}.parquet"] if dot and suffix in ("parquet", "csv") else [])
    for place in tries:
        if _exists(spark, place):
            reader = spark.read.schema(schema) if schema else spark.read
            df = reader.csv(place, header=True, inferSchema=schema is None) if place.endswith(".csv") else reader.parquet(place)
            return require_columns(df, required or [])
    if schema is None:
        raise FileNotFoundError(f"no records at {' or '.join(tries)}")
    return require_columns(spark.createDataFrame([], schema), required or [])


def save_records(df: DataFrame, path: str, prefer: str | None = None) -> str:
    """Write as Parquet or CSV, as the suffix or `prefer` says, and as the other one where that format can't hold the columns; returns the path.

    The suffix is changed to what is written. An empty table keeps its schema.
    """
    stem, dot, suffix = path.rpartition(".")
    stem = stem if dot and suffix in ("parquet", "csv") else path
    first = prefer or (suffix if suffix in ("parquet", "csv") else "parquet")
    for kind in (first, "csv" if first == "parquet" else "parquet"):
        place = f"{stem}.{kind}"
        try:
            if kind == "csv":
                df.write.mode("overwrite").csv(place, header=True)
            else:
                df.write.mode("overwrite").parquet(place)
        except AnalysisException:  # a column type that the format doesn't have
            if kind != first:
                raise
            continue
        return place
    raise AssertionError


def load_report_csv(spark: SparkSession, path: str, index: str, numbers: list[str], texts: list[str]) -> DataFrame:
    """A report with an index: bad numbers become 0, rows with a bad index go, sorted by index."""
    raw = spark.read.csv(path, header=True)
    return raw.select(
        F.coalesce(F.col(index).try_cast("int"), F.lit(-1)).alias(index), *(F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)).alias(c) for c in numbers), *texts
    ).filter(F.col(index) >= 0).orderBy(index)


def load_json_folder(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    """One record for each JSON file, with `name`, the file's name without its suffix; unreadable files are skipped."""
    rows = spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").json(folder)
    return rows.withColumn("name", F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1))


def load_json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def load_captions(spark: SparkSession, folder: str) -> DataFrame:
    """stem, caption of each .txt file."""
    rows = spark.read.option("pathGlobFilter", "*.txt").text(folder, wholetext=True)
    return rows.select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.txt$", 1).alias("stem"), F.trim("value").alias("caption"))


def list_files(spark: SparkSession, folders: list[str], pattern: str) -> DataFrame:
    """Path, stem and size of the files of several folders, each path once; contents are not read."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folders).select("path", "length", "modificationTime")
    return rows.dropDuplicates(["path"]).withColumn("stem", F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1))


def parse_frame_name(name) -> dict:  # noqa: ANN001
    """Scene, position, frame number and time text out of a frame's file name."""
    parts = F.split(F.regexp_replace(name, r"\.[^.]+$", ""), "_")
    part = lambda p: F.get(F.filter(parts, lambda x: x.rlike(p)), F.lit(0))
    return {
        "scene": parts[0],
        "pos": F.regexp_extract(part(r"^pos\d+$"), r"\d+", 0).cast("int"),
        "frame": F.regexp_extract(part(r"^frame\d+$"), r"\d+", 0).cast("int"),
        "time": part(r"^t.*s$"),
    }


def frame_number(name):  # noqa: ANN001, ANN201
    """First of frame_123, _123. and 1234 that the name has; else -1."""
    tries = (r"(?i)frame[_-]?(\d+)", r"_(\d+)\.", r"(\d{4,})")
    return F.coalesce(*(F.nullif(F.regexp_extract(name, p, 1), F.lit("")).cast("int") for p in tries), F.lit(-1))


def save_routed(df: DataFrame, path: str, columns: list[str]) -> None:
    """A folder for each value of the columns (tier, first reason)."""
    df.write.mode("overwrite").partitionBy(*columns).parquet(path)


def with_unique_names(df: DataFrame, name: str, order: list[str]) -> DataFrame:
    """The second and later rows of a name get the suffix _1, _2, ..."""
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy(name).orderBy(*order)) - 1
    return df.withColumn(name, F.when(nth == 0, F.col(name)).otherwise(F.concat(F.col(name), F.lit("_"), nth.cast("string"))))


def manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and status of each named table."""
    parts = [df.agg(F.lit(name).alias("stage"), F.count("*").alias("rows")) for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", F.when(F.col("rows") > 0, "complete").otherwise("empty"))


def frame_rows(videos: DataFrame, video: str, frames: str) -> DataFrame:
    """A row for each frame of each video: frame_id is the video and the number in six digits."""
    rows = videos.filter(F.col(frames) > 0).select(video, F.explode(F.sequence(F.lit(0).cast("long"), F.col(frames).cast("long") - 1)).alias("frame_index"))
    return rows.select(F.concat(F.col(video).cast("string"), F.lit("_"), F.lpad(F.col("frame_index").cast("string"), 6, "0")).alias("frame_id"), video, "frame_index")


def stub_frames(spark: SparkSession, video: str, n: int, width: int = 64, height: int = 64) -> DataFrame:
    """n frames without pictures: the hash of each is the sha1 of its id."""
    rows = frame_rows(spark.range(1).select(F.lit(video).alias("video_id"), F.lit(n).alias("n")), "video_id", "n")
    return rows.select("frame_id", "video_id", "frame_index", F.lit(width).alias("width"), F.lit(height).alias("height"), F.sha1("frame_id").alias("phash"))


def interval_step(fps, seconds: float | None = None, frames: int | None = None):  # noqa: ANN001, ANN201
    """Frames between two samples: from seconds, from frames, or one second's; 1 at least."""
    step = F.floor(fps * seconds) if seconds is not None else F.lit(frames) if frames is not None else F.floor(fps)
    return F.greatest(step.cast("long"), F.lit(1).cast("long"))


def interval_positions(total, step):  # noqa: ANN001, ANN201
    """0, step, 2 step, ... below total; none of an empty video."""
    return F.when(total > 0, F.sequence(F.lit(0).cast("long"), total.cast("long") - 1, step.cast("long"))).otherwise(F.array().cast("array<bigint>"))


def flat_tracks(tracks: DataFrame, track: str, detections: str) -> DataFrame:
    """A row for each detection of each track; tracks without any have none."""
    return tracks.select(track, F.explode(detections).alias("d")).select(track, "d.*")


def export_tracks(tracks: DataFrame, track: str, detections: str, path: str) -> str:
    """Flat tracks as Parquet, CSV or JSON lines, by the suffix."""
    rows = flat_tracks(tracks, track, detections)
    if path.endswith(".json"):
        rows.write.mode("overwrite").json(path)
        return path
    return save_records(rows, path)


def merged_names(df: DataFrame, name: str, source: str, sources: list, target: str) -> DataFrame:
    """The rows of several sources under one target, each name with its source in front."""
    moved = df.filter(F.col(source).isin(sources))
    return moved.withColumns({name: F.concat_ws("_", F.col(source).cast("string"), F.col(name)), "target": F.lit(target)})
