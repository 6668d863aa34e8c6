"""Keypoint and box queries; a vector's components stand in for the coordinates of 17 joints and their scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import geometry as G
from millrace.functions import poses as B
from millrace.plans.registry import query
from millrace.session import table

# joint i: x = component i, y = component i + 17 and a lift by its height; score from component i + 34
_LIFT = [0.9, 0.95, 0.95, 0.9, 0.9, 0.6, 0.6, 0.3, 0.3, 0.0, 0.0, 0.0, 0.0, -0.5, -0.5, -1.0, -1.0]
_K = f"""k as (select vec_id, list_transform(range(17), lambda i: embedding[i + 1]::double * 100) as x, list_transform(range(17), lambda i: embedding[i + 18]::double * 100 + ({_LIFT})[i + 1] * 60) as y,
  list_transform(range(17), lambda i: 0.28 + abs(embedding[i + 35]::double) * 3) as s from embeddings),
b as (select *, s[6] > 0.3 and s[7] > 0.3 and s[12] > 0.3 and s[13] > 0.3 as torso_seen, s[6] > 0.3 and s[7] > 0.3 and s[12] > 0.3 and s[13] > 0.3 and s[14] > 0.3 and s[15] > 0.3 as body_seen, (x[12] + x[13]) / 2 as hx, (y[12] + y[13]) / 2 as hy,
  (x[6] + x[7]) / 2 - (x[12] + x[13]) / 2 as dx, (y[6] + y[7]) / 2 - (y[12] + y[13]) / 2 as dy from k),
t as (select *, sqrt(dx * dx + dy * dy) as size, degrees(atan2(dx, dy)) as angle, abs(x[14] - x[15]) as across, abs(y[14] - y[15]) as down, (y[12] + y[13]) / 2 - (y[14] + y[15]) / 2 as bend, (y[16] + y[17]) / 2 - hy as reach,
  y[14] > y[12] + 20 or y[15] > y[13] + 20 as low, case when s[10] > 0.3 and s[6] > 0.3 then sqrt((x[10] - x[6]) ** 2 + (y[10] - y[6]) ** 2) else 0 end as left_arm, case when s[11] > 0.3 and s[7] > 0.3 then sqrt((x[11] - x[7]) ** 2 + (y[11] - y[7]) ** 2) else 0 end as right_arm from b)"""


def _keypoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    lift = F.array(*(F.lit(v) for v in _LIFT))
    at = lambda i: F.get("embedding", i).cast("double")
    each = F.sequence(F.lit(0), F.lit(16))
    points = F.transform(each, lambda i: F.struct((at(i) * 100).alias("x"), (at(i + 17) * 100 + F.get(lift, i) * 60).alias("y")))
    return table(spark, sf_dir, "embeddings").select("vec_id", points.alias("p"), F.transform(each, lambda i: 0.28 + F.abs(at(i + 34)) * 3).alias("s"))


@query(f"with {_K} select vec_id, round((x[1] - hx) / size, 6) as nose_x, round((y[1] - hy) / size, 6) as nose_y, round((x[17] - hx) / size, 6) as ankle_x from t where torso_seen and size >= 10")
def normalized_poses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points about the hips in units of the torso, of poses whose torso is seen."""
    n = _keypoints(spark, sf_dir).select("vec_id", B.normalized(F.col("p"), F.col("s")).alias("n")).filter("n is not null")
    at = lambda i, a: F.round(F.col("n")[i][a], 6)
    return n.select("vec_id", at(0, "x").alias("nose_x"), at(0, "y").alias("nose_y"), at(16, "x").alias("ankle_x"))


@query(f"""
with {_K} select vec_id, round(size, 6) as torso_height, round(angle, 6) as torso_angle, round(sqrt((x[7] - x[6]) ** 2 + (y[7] - y[6]) ** 2), 6) as shoulder_width, round(sqrt((x[13] - x[12]) ** 2 + (y[13] - y[12]) ** 2), 6) as hip_width, round(across, 6) as leg_spread_horizontal,
  round(down, 6) as leg_spread_vertical, round(y[12] - y[14], 6) as left_knee_bend, round(y[13] - y[15], 6) as right_knee_bend, round(across / (size + 1e-6), 6) as aspect_ratio from t where body_seen""")
def pose_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _keypoints(spark, sf_dir).select("vec_id", B.features(F.col("p"), F.col("s")).alias("f")).filter("f is not null").select("vec_id", "f.*")
    return f.select("vec_id", *(F.round(c, 6).alias(c) for c in f.columns[1:]))


@query(f"""
with {_K}, c as (select vec_id, case when not body_seen then 'unknown' when reach > size * 1.2 and across < size * 0.4 then 'jumping' when (across > size * 0.6 or down > size * 0.3) and bend < size * 0.5 then 'running'
  when abs(angle) < 20 and (across > size * 0.3 or down > size * 0.2) and across < size * 0.8 then 'walking' when bend < size * 0.3 and low and abs(angle) < 30 then 'sitting' when bend < size * 0.2 and reach < size * 0.8 then 'crouching'
  when left_arm > size or right_arm > size then 'reaching' when abs(angle) < 15 and across < size * 0.5 and bend > size * 0.3 then 'standing' else 'unknown' end as pose from t)
select vec_id, pose, case pose when 'jumping' then 0.75 when 'running' then 0.75 when 'sitting' then 0.75 when 'reaching' then 0.65 when 'unknown' then 0.0 else 0.70 end::double as confidence from c""")
def pose_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keypoints(spark, sf_dir).select("vec_id", B.classified(F.col("p"), F.col("s")).alias("c")).select("vec_id", "c.pose", "c.confidence")


@query(f"""
with {_K}, v as (select vec_id, x[7] - x[6] as o, abs(x[13] - x[12]) as h, (s[10] > 0.3)::int + (s[11] > 0.3)::int as arms from t), n as (select *, case when h > 0 then abs(o) / h else 1.0 end as narrow from v),
a as (select *, case when narrow < 0.6 then 'side' when narrow < 0.85 or arms = 1 then 'three_quarter' when arms = 2 then 'front' else 'back' end as angle, case when o > 0 then 'right' when o < 0 then 'left' end as turn from n)
select vec_id, case when turn is null then case angle when 'side' then 'back' when 'back' then 'back' else 'front' end else case angle when 'front' then 'three_quarter' else angle end || '_' || turn end as view from a""")
def pose_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The side from which a pose is seen."""
    return _keypoints(spark, sf_dir).select("vec_id", B.view(F.col("p"), F.col("s"))["name"].alias("view"))


@query(f"""
with {_K}, v as (select vec_id, x[6] - x[8] as ax, y[6] - y[8] as ay, x[10] - x[8] as bx, y[10] - y[8] as "by", s from t)
select vec_id, round(degrees(acos(greatest(-1, least(1, (ax * bx + ay * "by") / (sqrt(ax * ax + ay * ay) * sqrt(bx * bx + "by" * "by") + 1e-8))))), 5) as elbow, ((s[6] >= 0.5)::int + (s[8] >= 0.5)::int + (s[10] >= 0.5)::int) / 3 as visible from v""")
def joint_angles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The left elbow's angle in degrees, and the share of the arm's joints that are visible."""
    p = lambda i: (F.col("p")[i]["x"], F.col("p")[i]["y"])
    return _keypoints(spark, sf_dir).select("vec_id", F.round(G.angle_at(p(5), p(7), p(9)), 5).alias("elbow"), G.visible_share(F.col("s"), [5, 7, 9]).alias("visible"))


@query("""
with b as (select l_orderkey, l_linenumber as n, l_partkey % 500 as x1, l_suppkey * 7 % 500 as y1, l_partkey % 500 + l_quantity * 4 as x2, l_suppkey * 7 % 500 + 80 + l_linenumber * 20 as y2 from lineitem),
p as (select a.l_orderkey, a.n as first, c.n as second, least(a.x2, c.x2) - greatest(a.x1, c.x1) as w, least(a.y2, c.y2) - greatest(a.y1, c.y1) as h, (a.x2 - a.x1) * (a.y2 - a.y1) + (c.x2 - c.x1) * (c.y2 - c.y1) as area from b a join b c on a.l_orderkey = c.l_orderkey and a.n < c.n)
select l_orderkey, first, second, round(w * h / (area - w * h), 8) as iou from p where w > 0 and h > 0""")
def box_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intersection over union of the boxes of a frame that overlap (at most seven boxes a frame)."""
    b = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("n"), F.array(F.col("l_partkey") % 500, F.col("l_suppkey") * 7 % 500, F.col("l_partkey") % 500 + F.col("l_quantity") * 4, F.col("l_suppkey") * 7 % 500 + 80 + F.col("l_linenumber") * 20).alias("b"))
    p = b.toDF("l_orderkey", "first", "a").join(b.toDF("l_orderkey", "second", "c"), "l_orderkey").filter("first < second")
    iou = G.iou([F.col("a")[i] for i in range(4)], [F.col("c")[i] for i in range(4)])
    return p.select("l_orderkey", "first", "second", F.round(iou, 8).alias("iou")).filter("iou > 0")
