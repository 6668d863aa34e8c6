"""Boxes, keypoints and image sizes as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iou(a: list[Column], b: list[Column]) -> Column:
    """Intersection over union of two boxes (x1, y1, x2, y2); 0 where they do not overlap."""
    wide = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    high = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    shared = wide * high
    area = lambda x: (x[2] - x[0]) * (x[3] - x[1])
    return F.when((wide <= 0) | (high <= 0), F.lit(0.0)).otherwise(shared / (area(a) + area(b) - shared))


def resolution_bucket(width: Column, height: Column) -> Column:
    """Name of the pixel count's band. 1920x1080, 1280x720, 640x640, 320x320."""
    pixels = width * height
    return F.when(pixels == 0, "unknown").when(pixels >= 2073600, "hd+").when(pixels >= 921600, "hd").when(pixels >= 409600, "medium").when(pixels >= 102400, "small").otherwise("tiny")


def aspect_class(width: Column, height: Column) -> Column:
    ratio = width / height
    return F.when(ratio > 1.3, "landscape").when(ratio < 0.77, "portrait").otherwise("square")


def angle_at(p1: tuple[Column, Column], p2: tuple[Column, Column], p3: tuple[Column, Column]) -> Column:
    """Angle at p2 in degrees."""
    ax, ay, bx, by = p1[0] - p2[0], p1[1] - p2[1], p3[0] - p2[0], p3[1] - p2[1]
    norm = F.sqrt(ax * ax + ay * ay) * F.sqrt(bx * bx + by * by) + 1e-8
    return F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (ax * bx + ay * by) / norm))))


def visible_share(scores: Column, joints: list[int], threshold: float = 0.5) -> Column:
    """Share of the named joints (from 0) whose score reaches the threshold."""
    return F.size(F.filter(F.array(*(F.element_at(scores, j + 1) for j in joints)), lambda s: s >= threshold)) / len(joints)


def scene_positions(start: Column, end: Column, k: int) -> Column:
    """k evenly spaced frames of a scene; a tenth is trimmed off both ends of long scenes, short scenes give none."""
    length = end - start
    trim = F.when(length > k + 2, F.floor(length * 0.1).cast("long")).otherwise(F.lit(0).cast("long"))
    first, last = start + trim, end - trim - 1
    even = F.array(F.floor((first + last) / 2).cast("long")) if k == 1 else F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: first + F.floor((last - first) * i / (k - 1)).cast("long"))
    return F.when(length < 10, F.array().cast("array<bigint>")).otherwise(even)
