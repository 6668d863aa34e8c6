"""Row filters as reasons: a filter is the reason for which a row fails, null where it passes; filters compose."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_failure(checks: list[tuple[Column, str]]) -> Column:
    """Name of the first check that fails a row; null where none does."""
    return F.coalesce(*(F.when(failed, F.lit(name)) for failed, name in checks))


def size_reason(width: Column, height: Column, least: int = 128, most: int | None = None, pixels: tuple[int | None, int | None] = (None, None), ratios: tuple[float, float] = (0.5, 2.0)) -> Column:
    """First failure of: width and height at least `least`, both at most `most`, pixels and aspect within bounds, ends allowed."""
    ratio, area = width / height, width * height
    checks = [(width < least, "width_below_minimum"), (height < least, "height_below_minimum")]
    if most is not None:
        checks += [(width > most, "width_above_maximum"), (height > most, "height_above_maximum")]
    checks += [(area < pixels[0], "too_few_pixels")] if pixels[0] is not None else []
    checks += [(area > pixels[1], "too_many_pixels")] if pixels[1] is not None else []
    return first_failure([*checks, (ratio < ratios[0], "aspect_below_minimum"), (ratio > ratios[1], "aspect_above_maximum")])


def blur_reason(score: Column, threshold: float, own: Column | None = None) -> Column:
    """Blurry where the score is below the row's own threshold, or the default where it has none."""
    return F.when(score < (F.lit(threshold) if own is None else F.coalesce(own, F.lit(threshold))), F.lit("blurry"))


def geometric_reason(width: Column, height: Column, box: tuple[Column, Column, Column, Column] | None = None, frame: tuple[int, int] = (1920, 1080), margin: int = 10) -> Column:
    """First failure of: shorter side at least 128, longer at most 1536, aspect within 0.3 and 3, box (x, y, w, h) off the frame's edges."""
    ratio = F.when(height > 0, width / height).otherwise(0.0)
    checks = [(F.least(width, height) < 128, "too_small"), (F.greatest(width, height) > 1536, "too_large"), ((ratio < 0.3) | (ratio > 3.0), "bad_aspect")]
    if box:
        x, y, w, h = box
        checks.append(((x < margin) | (y < margin) | (x + w > frame[0] - margin) | (y + h > frame[1] - margin), "edge_position"))
    return first_failure(checks)


def instance_reason(sharpness: Column, truncated: Column) -> Column:
    """Sharpness below 50, then over a fifth of the edge cut off."""
    return first_failure([(sharpness < 50, "too_blurry"), (truncated > 0.2, "truncated")])


def composite(filters: dict[str, Column], mode: str = "all") -> tuple[Column, Column]:
    """passed, reason of several filters: all or any must pass; every reason is told with its filter's name, also of rows that pass."""
    passed = reduce(and_ if mode == "all" else or_, (reason.isNull() for reason in filters.values()))
    told = F.array_compact(F.array(*(F.concat(F.lit(f"{name}: "), reason) for name, reason in filters.items())))
    return passed, F.when(F.size(told) > 0, F.array_join(told, "; "))


def exposure_flags(sharpness: Column, contrast: Column, over: Column, under: Column) -> Column:
    """Comma-joined flags of a report row: sharpness below 35, contrast below 0.08, over- or underexposed share above 0.08."""
    checks = [(sharpness < 35, "blurry"), (contrast < 0.08, "low_contrast"), (over > 0.08, "overexposed"), (under > 0.08, "underexposed")]
    return F.array_join(F.array_compact(F.array(*(F.when(failed, F.lit(name)) for failed, name in checks))), ",")


def passes_exposure(sharpness: Column, contrast: Column, mean: Column, over: Column, under: Column, flags: Column | None = None, bounds: tuple[float, ...] = (120.0, 0.10, 0.20, 0.90, 0.03, 0.03)) -> Column:
    """All bounds hold (sharpness, contrast, least and greatest mean, over- and underexposed share), and no flag is set where flags are given."""
    sharp, flat, dark, bright, most_over, most_under = bounds
    passed = (sharpness >= sharp) & (contrast >= flat) & mean.between(dark, bright) & (over <= most_over) & (under <= most_under)
    return passed if flags is None else (flags == "") & passed


def quality_tier(reasons: Column, blur: Column, excellent: float, good: float) -> Column:
    """rejected with any reason, acceptable where the blur score is missing, else excellent, good or acceptable by the score."""
    return F.when(F.size(reasons) > 0, "rejected").when(blur.isNull(), "acceptable").when(blur >= excellent, "excellent").when(blur >= good, "good").otherwise("acceptable")


def below_thresholds(values: dict[str, Column], thresholds: dict[str, float]) -> Column:
    """Names of the metrics below their thresholds, in the order of the thresholds; a missing value counts as 0."""
    return F.array_compact(F.array(*(F.when(F.coalesce(values[name], F.lit(0.0)) < least, F.lit(name)) for name, least in thresholds.items())))


def decoded_box(row: Column, scale_x: float, scale_y: float) -> Column:
    """struct(score, class_id, x1, y1, x2, y2) of a detector's row: centre, size, objectness, class scores. The first of equal scores is the class."""
    classes = F.slice(row, 6, F.size(row))
    top = F.array_max(classes)
    at = lambda i: F.get(row, F.lit(i)).cast("double")
    return F.struct(
        (at(4) * top.cast("double")).alias("score"), (F.array_position(classes, top) - 1).cast("int").alias("class_id"),
        ((at(0) - at(2) / 2) * scale_x).alias("x1"), ((at(1) - at(3) / 2) * scale_y).alias("y1"), ((at(0) + at(2) / 2) * scale_x).alias("x2"), ((at(1) + at(3) / 2) * scale_y).alias("y2"),
    )
