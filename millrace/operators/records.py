"""Record-table operators: merge, column checks, routing, upserts, differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.rounds import quantiles


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """df itself; raises where a required column is missing."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def merge_records(tables: list[DataFrame], key: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """All rows of the tables; with a key, only the first row of each key, earlier tables first, then by `order`.

    A null key is one value. First wins by a grouping with min_by, so a frequent key is combined before the shuffle.
    """
    numbered = [t.withColumn("_table", F.lit(i)) for i, t in enumerate(tables)]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)
    if not key:
        return merged.drop("_table")
    rest = [c for c in merged.columns if c not in (*key, "_table")]
    first = F.min_by(F.struct(*rest), F.struct("_table", *(order or rest))).alias("_first")
    return merged.groupBy(*key).agg(first).select(*key, *(F.col(f"_first.{c}").alias(c) for c in rest))


def unprocessed(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Items whose key has not been processed."""
    return items.join(done.select(key).distinct(), key, "left_anti")


def upsert(base: DataFrame, changes: DataFrame, key: list[str], version: str) -> DataFrame:
    """The row with the highest version of each key, of both tables; of equal versions the greatest row."""
    rows = base.unionByName(changes)
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(version, *rest)).alias("_last")).select(*key, *(F.col(f"_last.{c}").alias(c) for c in rest))


def reasons(checks: list[tuple[Column, str]]) -> Column:
    """Names of all checks that hold: every failure is collected, as an array."""
    return F.array_compact(F.array(*(F.when(failed, F.lit(name)) for failed, name in checks)))


def first_reason(checks: list[tuple[Column, str]]) -> Column:
    """Name of the first check that holds, or null: checks are in order of cost."""
    return F.coalesce(*(F.when(failed, F.lit(name)) for failed, name in checks))


def describe(df: DataFrame, columns: list[str], scale: int = 12) -> DataFrame:
    """count, mean, sample deviation, min, linear quartiles and max of each column, a row a column.

    Sums are of decimals with `scale` digits, so a mean is the same for any order of the rows.
    """
    rows = df.select(F.expr("stack({}, {}) as (metric, value)".format(len(columns), ", ".join(f"'{c}', cast(`{c}` as double)" for c in columns))))
    total = F.sum(F.col("value").cast(f"decimal(28,{scale})")).cast("double")
    sums = rows.groupBy("metric").agg(
        F.count("value").alias("n"), (total / F.nullif(F.count("value"), F.lit(0))).alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max")
    )
    at = lambda p: F.max(F.when(F.col("share") == p, F.col("quantile")))
    cuts = quantiles(rows, ["metric"], "value", [0.25, 0.5, 0.75]).groupBy("metric").agg(at(0.25).alias("q25"), at(0.5).alias("q50"), at(0.75).alias("q75"))
    return sums.join(cuts, "metric", "left")


def top_per_group(df: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group; Spark limits each group before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= k)


def tier(score: Column, a: float, b: float) -> Column:
    """A from a on, B from b on, else C; null stays null."""
    return F.when(score >= a, "A").when(score >= b, "B").when(score.isNotNull(), "C")


def merge_suggestions(clusters: DataFrame, name: str, size: str, k: int, noise: str = "noise", share: float = 0.2) -> DataFrame:
    """a, b, score: pairs of which one name contains the other (0.7), else both clusters are below a share of the mean size (0.5).

    A name meets its parts that are as long as some other name, so names are joined on equality and not pair by pair. Of
    the pairs of small clusters only the first k can be wanted, and these are among the k + 1 first small names.
    """
    mean = clusters.agg(F.avg(size).alias("_mean"))
    rows = clusters.crossJoin(F.broadcast(mean)).select(F.col(name).alias("name"), (F.col(size) < share * F.col("_mean")).alias("small")).filter(F.col("name") != noise)
    lengths = rows.select(F.char_length("name").alias("n")).agg(F.collect_set("n").alias("lengths"))  # as many as names have lengths
    parts = F.flatten(F.transform("lengths", lambda n: F.when(n < F.char_length("name"), F.transform(F.sequence(F.lit(1), F.char_length("name") - n + 1), lambda i: F.substring("name", i, n))).otherwise(F.array().cast("array<string>"))))
    inner = rows.crossJoin(F.broadcast(lengths)).select("name", F.explode(F.array_distinct(parts)).alias("part"))
    held = inner.join(rows.select(F.col("name").alias("part")), "part").select(F.least("name", "part").alias("a"), F.greatest("name", "part").alias("b"), F.lit(0.7).alias("score"))
    small = rows.filter("small").select("name").orderBy("name")
    first = small.limit(k + 1)
    both = first.toDF("a").join(F.broadcast(first.toDF("b")), F.col("a") < F.col("b")).withColumn("score", F.lit(0.5))
    return held.unionByName(both).groupBy("a", "b").agg(F.max("score").alias("score")).orderBy(F.desc("score"), "a", "b").limit(k)
