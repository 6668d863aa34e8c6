"""Table functions for SQL: rows of tracks, over a table that is partitioned by track and ordered by frame."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn, udtf
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

#: Corners of a box, where a table has them.
CORNERS = ("x1", "y1", "x2", "y2")


class _TrackRows:
    """A row of a track at a time; only the row before is held."""

    @staticmethod
    def analyze(detections: AnalyzeArgument, track: AnalyzeArgument, frame: AnalyzeArgument) -> AnalyzeResult:
        names = {f.name: f.dataType for f in detections.dataType.fields}
        for given in (track, frame):
            if given.value not in names:
                raise ValueError(f"the table has no column {given.value}")
        more = [StructField("place", IntegerType()), StructField("gap", LongType()), StructField("overlap", DoubleType())]
        return AnalyzeResult(StructType([*detections.dataType.fields, *more]), partitionBy=[PartitioningColumn(track.value)], orderBy=[OrderingColumn(frame.value)])

    def __init__(self) -> None:
        self.place, self.before = 0, None

    def eval(self, detections: Row, track: str, frame: str) -> Any:
        row = detections.asDict()
        gap = overlap = None
        if self.before is not None and self.before[frame] is not None and row[frame] is not None:
            gap = int(row[frame] - self.before[frame])
        if self.before is not None and all(c in row and row[c] is not None and self.before[c] is not None for c in CORNERS):
            overlap = _overlap([float(self.before[c]) for c in CORNERS], [float(row[c]) for c in CORNERS])
        yield (*detections, self.place, gap, overlap)
        self.place, self.before = self.place + 1, row


def _overlap(a: list[float], b: list[float]) -> float:
    """Shared area of two boxes over the area of both; 0 where neither has any."""
    wide, high = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    shared = max(0.0, wide) * max(0.0, high)
    both = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - shared
    return shared / both if both > 0 else 0.0


def register_table_functions(spark: SparkSession) -> None:
    """track_rows(TABLE(t), track, frame): the table's columns with place in the track, gap to and overlap with the row before.

    The function itself asks for the table by track and in order of frame, so tracks are spread over tasks.
    """
    spark.udtf.register("track_rows", udtf(_TrackRows))
