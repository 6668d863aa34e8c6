"""Image queries: embeddings of 64 components, as grey grids of 8 x 8, stand in for small images."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.images import perceptual_hash
from millrace.operators.similarity import ssim_leaders
from millrace.plans.registry import query
from millrace.session import table


def _grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    grey = F.transform("embedding", lambda v: (v.cast("double") + 0.8) * 160)
    grid = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice(F.col("grey"), i * 8 + 1, 8))
    return table(spark, sf_dir, "embeddings").select("vec_id", grey.alias("grey")).select("vec_id", grid.alias("grid"))


_BITS = "list_aggregate(list_transform(range(64), lambda i: case when {} then '1' else '0' end), 'string_agg', '')"


@query(f"""
with g as (select vec_id, list_transform(embedding, lambda v: (v::double + 0.8) * 160) as g from embeddings)
select vec_id, {_BITS.format("g[i + 1] > list_sum(g) / 64")} as average_hash, {_BITS.format("g[(i // 8) * 8 + (i % 8 + 1) * 8 // 9 + 1] > g[(i // 8) * 8 + (i % 8) * 8 // 9 + 1]")} as dhash from g""")
def grid_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average and difference hashes of grids, as strings of bits."""
    bits = lambda name: F.lpad(F.bin(perceptual_hash(F.col("grid"), name)), 64, "0").alias(name)
    return _grids(spark, sf_dir).select("vec_id", bits("average_hash"), bits("dhash"))


@query()
def grid_phash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashes of the low frequencies of grids."""
    return _grids(spark, sf_dir).select("vec_id", perceptual_hash(F.col("grid"), "phash").alias("phash"))


@query()
def grid_leaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leader groups by structural similarity: each grid, and a copy of it with a pattern of faint noise."""
    g = _grids(spark, sf_dir)
    noise = lambda i, j: F.pmod(F.col("vec_id") * 7 + i * 5 + j * 3, F.lit(11)) * F.when(F.col("vec_id") % 3 == 0, 6.0).otherwise(0.5)
    copies = g.select((F.col("vec_id") * 2 + 1).alias("frame"), F.transform("grid", lambda r, i: F.transform(r, lambda v, j: v + noise(i, j))).alias("grid"))
    frames = g.select((F.col("vec_id") * 2).alias("frame"), "grid").unionByName(copies)
    return ssim_leaders(frames, "frame", "grid", 8, 8).select("frame", "leader")
