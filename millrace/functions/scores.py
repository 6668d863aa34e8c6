"""Quality scores, strategy ladders and weighted composites as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def image_issues(width: Column, height: Column, blur: Column, edges: Column, brightness: Column, contrast: Column, low: int = 256, high: int = 4096) -> Column:
    """Names of all failed checks of an image's statistics; a blur or edge score of 0 was not measured."""
    ratio = width / height
    checks = [
        (F.least(width, height) < low, "resolution_too_low"), (F.greatest(width, height) > high, "resolution_too_high"), ((blur < 100) & (blur > 0), "too_blurry"),
        ((edges < 0.01) & (edges > 0), "low_detail"), ((ratio < 0.3) | (ratio > 3.0), "extreme_aspect"),
    ]
    light = F.when(brightness < 20, "too_dark").when(brightness > 235, "too_bright")
    return F.array_compact(F.array(*(F.when(c, F.lit(n)) for c, n in checks), light, F.when(contrast < 20, "low_contrast")))


def image_score(width: Column, height: Column, blur: Column, edges: Column, contrast: Column, issues: Column) -> Column:
    """100 less penalties for size, blur, detail, contrast and each issue, kept within 0 and 100."""
    side = F.least(width, height)
    size = F.when(side < 256, 30).when(side < 512, 10).when(side > 2048, 5).otherwise(0)
    lacking = lambda value, most, have: F.when(value > 0, F.lit(float(most)) - F.least(F.lit(float(most)), have)).otherwise(0.0)
    total = 100 - size - lacking(blur, 30, blur * 0.3) - lacking(edges, 10, edges * 100) - lacking(contrast, 10, contrast / 10) - F.size(issues) * 10
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), total))


def weighted(parts: dict[str, float], scale: float = 1.0, default: float | None = None) -> Column:
    """Weighted sum of columns over the sum of the weights, times scale; with a default, nulls take it."""
    total = sum(parts.values())
    value = lambda c: F.col(c) if default is None else F.coalesce(c, F.lit(default))
    out = F.lit(0.0)
    for c, w in parts.items():
        out = out + value(c) * w
    return out / total * scale


def strategy(complexity: Column, lighting: Column, occlusion: Column, instances: Column, quality: Column, sharpness: Column, needs_occlusion: float = 0.0) -> Column:
    """struct(name, confidence) by ordered rules. 0.3 complexity, 0.7 lighting, 0.2 occlusion, 2 instances, 0.4 quality, 0.3 sharpness."""
    rule = lambda name, confidence: F.struct(F.lit(name).alias("name"), confidence.cast("double").alias("confidence"))
    full = (complexity < 0.3) & (lighting > 0.7) & (occlusion < 0.2)
    ladder = F.when(full, rule("keep_full", (1 - complexity) * 0.4 + lighting * 0.4 + (1 - occlusion) * 0.2))
    ladder = ladder.when((instances >= 2) | (complexity > 0.3), rule("segment", F.lit(0.8)))
    ladder = ladder.when((quality < 0.4) | (sharpness < 0.3), rule("enhance_segment", 1 - quality))
    if needs_occlusion > 0.5:
        ladder = ladder.when(F.lit(True), rule("create_occlusion", F.lit(0.7)))
    return ladder.otherwise(rule("segment", F.lit(0.6)))


def motion_match(magnitude: Column, coherence: Column, low: float, high: float) -> Column:
    """struct(matches, confidence): a magnitude of up to 50 pixels against an expected band."""
    m = F.least(magnitude / 50.0, F.lit(1.0))
    inside = m.between(low, high)
    away = F.when(m < low, low - m).otherwise(m - high)
    return F.struct(inside.alias("matches"), F.when(inside, 0.7 + 0.3 * coherence).otherwise(F.greatest(F.lit(0.3), 0.7 - away)).alias("confidence"))


def log_fields(line: Column) -> dict[str, Column]:
    """Epoch, step, loss and rate of a training log line, null where it has none, and the kind of error."""
    number = lambda p, kind: F.nullif(F.regexp_extract(line, p, 1), F.lit("")).try_cast(kind)
    return {
        "epoch": number(r"(?i)epoch\s+(\d+)/\d+", "int"), "step": number(r"(?i)steps?:?\s+(\d+)/\d+", "int"), "loss": number(r"loss[=:\s]+([0-9]*\.?[0-9]+)", "double"),
        "rate": number(r"lr[=:\s]+([0-9.]+(?:e-?[0-9]+)?)", "double"),
        "error": F.when(line.rlike(r"(?i)out of memory|\boom\b"), "oom_error").when(line.rlike("(?i)error|exception|traceback"), "generic_error"),
    }
