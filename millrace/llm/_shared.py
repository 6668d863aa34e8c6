"""Shared folder, written tables and batch slicing used by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; on a local master, where it is unset, a temporary one."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if base is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
        base = sc.getCheckpointDir()
    return base.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/millrace/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it again: cuts the lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = 1 << 20, max_rows: int = 1000) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut Arrow batches into runs of rows with at most max_bytes of text (one row at least).

    Yields the rows, the UTF-8 bytes of their texts and the offsets of the texts in them; a null text is empty.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        if not pa.types.is_string(column.type):
            column = column.cast(pa.string())
        if column.null_count:
            column = column.fill_null("")
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] is not None and len(column.buffers()[2]) else np.zeros(0, np.uint8)
        start = 0
        while start < len(column):
            stop = int(np.searchsorted(offsets, offsets[start] + max_bytes, side="right")) - 1
            stop = min(max(stop, start + 1), start + max_rows, len(column))
            low, high = offsets[start], offsets[stop]
            yield batch.slice(start, stop - start), data[low:high], offsets[start : stop + 1] - low
            start = stop


def texts_of(data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """The texts of one slice as bytes."""
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
