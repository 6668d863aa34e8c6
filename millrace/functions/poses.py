"""COCO keypoints (17 x (x, y) and scores) as Column expressions: normalisation, standing test, view."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# COCO joint numbers and the score from which a joint counts.
NOSE, LEFT_SHOULDER, RIGHT_SHOULDER, LEFT_WRIST, RIGHT_WRIST, LEFT_HIP, RIGHT_HIP, LEFT_KNEE, RIGHT_KNEE, LEFT_ANKLE, RIGHT_ANKLE = 0, 5, 6, 9, 10, 11, 12, 13, 14, 15, 16
BODY = (LEFT_SHOULDER, RIGHT_SHOULDER, LEFT_HIP, RIGHT_HIP, LEFT_KNEE, RIGHT_KNEE)
SEEN = 0.3


def joint(points: Column, i: int, axis: str) -> Column:
    return F.get(points, F.lit(i))[axis]


def seen(scores: Column, *joints: int) -> Column:
    out = F.lit(True)
    for j in joints:
        out = out & F.coalesce(F.get(scores, F.lit(j)) > SEEN, F.lit(False))
    return out


def middle(points: Column, a: int, b: int, axis: str) -> Column:
    return (joint(points, a, axis) + joint(points, b, axis)) / 2


def torso(points: Column) -> tuple[Column, Column]:
    """Vector from the hips' middle to the shoulders' middle."""
    return tuple(middle(points, LEFT_SHOULDER, RIGHT_SHOULDER, a) - middle(points, LEFT_HIP, RIGHT_HIP, a) for a in "xy")


def normalized(points: Column, scores: Column, least_torso: float = 10.0) -> Column:
    """Points about the hips in units of the torso; null where a shoulder or hip is not seen or the torso is too short."""
    dx, dy = torso(points)
    size = F.sqrt(dx * dx + dy * dy)
    hip = [middle(points, LEFT_HIP, RIGHT_HIP, a) for a in "xy"]
    moved = F.transform(points, lambda p: F.struct(((p["x"] - hip[0]) / size).alias("x"), ((p["y"] - hip[1]) / size).alias("y")))
    return F.when(seen(scores, LEFT_SHOULDER, RIGHT_SHOULDER, LEFT_HIP, RIGHT_HIP) & (size >= least_torso), moved)


def standing(points: Column) -> Column:
    """Upright within 15 degrees, knees closer than half the torso, and knees bent by over 0.3 of it."""
    dx, dy = torso(points)
    size = F.sqrt(dx * dx + dy * dy)
    spread = F.abs(joint(points, LEFT_KNEE, "x") - joint(points, RIGHT_KNEE, "x"))
    bend = middle(points, LEFT_HIP, RIGHT_HIP, "y") - middle(points, LEFT_KNEE, RIGHT_KNEE, "y")
    return (F.abs(F.degrees(F.atan2(dx, dy))) < 15) & (spread < 0.5 * size) & (bend > 0.3 * size)


def view(points: Column, scores: Column) -> Column:
    """struct(name, confidence). Shoulders narrower than 0.6 of the hips are a side view, than 0.85 a three-quarter one."""
    offset = joint(points, RIGHT_SHOULDER, "x") - joint(points, LEFT_SHOULDER, "x")
    hips = F.abs(joint(points, RIGHT_HIP, "x") - joint(points, LEFT_HIP, "x"))
    narrow = F.when(hips > 0, F.abs(offset) / hips).otherwise(1.0)
    arms = seen(scores, LEFT_WRIST).cast("int") + seen(scores, RIGHT_WRIST).cast("int")
    turn = F.when(offset > 0, "right").when(offset < 0, "left")  # null: neither
    angle = F.when(narrow < 0.6, "side").when((narrow < 0.85) | (arms == 1), "three_quarter").when(arms == 2, "front").otherwise("back")
    flat = {"front": ("front", 0.80), "three_quarter": ("front", 0.60), "side": ("back", 0.60), "back": ("back", 0.75)}
    turned = {"front": ("three_quarter", 0.70), "three_quarter": ("three_quarter", 0.75), "side": ("side", 0.80), "back": ("back", 0.70)}
    name, sure = F.lit("unknown"), F.lit(0.0)
    for kind in flat:
        name = F.when(angle == kind, F.when(turn.isNull(), flat[kind][0]).otherwise(F.concat(F.lit(f"{turned[kind][0]}_"), turn))).otherwise(name)
        sure = F.when(angle == kind, F.when(turn.isNull(), flat[kind][1]).otherwise(turned[kind][1])).otherwise(sure)
    return F.struct(name.alias("name"), sure.alias("confidence"))


def _apart(points: Column, a: int, b: int) -> Column:
    return F.sqrt(F.pow(joint(points, a, "x") - joint(points, b, "x"), 2) + F.pow(joint(points, a, "y") - joint(points, b, "y"), 2))


def features(points: Column, scores: Column) -> Column:
    """struct of torso height and angle, widths, spreads of the knees, bends and aspect; null where a joint of the body is not seen."""
    dx, dy = torso(points)
    height = F.sqrt(dx * dx + dy * dy)
    across, down = (F.abs(joint(points, LEFT_KNEE, a) - joint(points, RIGHT_KNEE, a)) for a in "xy")
    bend = lambda hip, knee: joint(points, hip, "y") - joint(points, knee, "y")
    found = F.struct(
        height.alias("torso_height"), F.degrees(F.atan2(dx, dy)).alias("torso_angle"), _apart(points, RIGHT_SHOULDER, LEFT_SHOULDER).alias("shoulder_width"), _apart(points, RIGHT_HIP, LEFT_HIP).alias("hip_width"),
        across.alias("leg_spread_horizontal"), down.alias("leg_spread_vertical"), bend(LEFT_HIP, LEFT_KNEE).alias("left_knee_bend"), bend(RIGHT_HIP, RIGHT_KNEE).alias("right_knee_bend"),
        (across / (height + 1e-6)).alias("aspect_ratio"),
    )
    return F.when(seen(scores, *BODY), found)


def classified(points: Column, scores: Column) -> Column:
    """struct(pose, confidence) by rules in the order jumping, running, walking, sitting, crouching, reaching, standing; unknown where a joint of the body is not seen or none fits."""
    dx, dy = torso(points)
    size, lean = F.sqrt(dx * dx + dy * dy), F.abs(F.degrees(F.atan2(dx, dy)))
    across, down = (F.abs(joint(points, LEFT_KNEE, a) - joint(points, RIGHT_KNEE, a)) for a in "xy")
    bend = middle(points, LEFT_HIP, RIGHT_HIP, "y") - middle(points, LEFT_KNEE, RIGHT_KNEE, "y")
    reach = middle(points, LEFT_ANKLE, RIGHT_ANKLE, "y") - middle(points, LEFT_HIP, RIGHT_HIP, "y")
    low = (joint(points, LEFT_KNEE, "y") > joint(points, LEFT_HIP, "y") + 20) | (joint(points, RIGHT_KNEE, "y") > joint(points, RIGHT_HIP, "y") + 20)
    arm = lambda wrist, shoulder: F.when(seen(scores, wrist, shoulder), _apart(points, wrist, shoulder)).otherwise(0.0)
    rules = [
        ("jumping", 0.75, (reach > size * 1.2) & (across < size * 0.4)),
        ("running", 0.75, ((across > size * 0.6) | (down > size * 0.3)) & (bend < size * 0.5)),
        ("walking", 0.70, (lean < 20) & ((across > size * 0.3) | (down > size * 0.2)) & (across < size * 0.8)),
        ("sitting", 0.75, (bend < size * 0.3) & low & (lean < 30)),
        ("crouching", 0.70, (bend < size * 0.2) & (reach < size * 0.8)),
        ("reaching", 0.65, (arm(LEFT_WRIST, LEFT_SHOULDER) > size) | (arm(RIGHT_WRIST, RIGHT_SHOULDER) > size)),
        ("standing", 0.70, (lean < 15) & (across < size * 0.5) & (bend > size * 0.3)),
    ]
    named = F.coalesce(*(F.when(fits, F.struct(F.lit(name).alias("pose"), F.lit(sure).alias("confidence"))) for name, sure, fits in rules))
    return F.coalesce(F.when(seen(scores, *BODY), named), F.struct(F.lit("unknown").alias("pose"), F.lit(0.0).alias("confidence")))
