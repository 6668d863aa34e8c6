"""Quotas, balanced and stratified samples. Random order is by md5 of a seed and the row's id, so it repeats everywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.vector import md5_key, uniform
from millrace.operators.rounds import picked_in_rounds, quantiles


def random_order(seed: int, key: str) -> list[Column]:
    return [md5_key(F.lit(f"{seed}:"), F.col(key).cast("string")), F.col(key)]


def fill_quota(df: DataFrame, group: list[str], order: list[Column], target: int) -> DataFrame:
    """The first `target` rows of each group; put the tier first in `order` to fill from one tier, then the next."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= target)


def category_quota(df: DataFrame, category: str, ratios: dict[str, float], order: list[Column], target: int) -> DataFrame:
    """floor(target x ratio) rows of each category; what is missing comes from all other rows in the same order.

    Of a category no row after its quota and `target` more can be taken, so Spark limits each category before the shuffle.
    """
    quota = F.coalesce(*(F.when(F.col(category) == c, F.lit(int(target * r))) for c, r in ratios.items()), F.lit(0))
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(category).orderBy(*order))).filter(F.col("rank") <= 2 * target)
    marked = ranked.withColumn("chosen", F.when(F.col("rank") <= quota, "quota").otherwise("fill"))
    taken = F.sum(F.when(F.col("chosen") == "quota", 1)).over(Window.partitionBy(F.lit(0)))
    place = F.row_number().over(Window.partitionBy("chosen").orderBy(*order))
    return marked.withColumns({"taken": F.coalesce(taken, F.lit(0)), "place": place}).filter((F.col("chosen") == "quota") | (F.col("place") <= target - F.col("taken"))).drop("rank", "taken", "place")


def median_cap(df: DataFrame, group: list[str], target: int) -> DataFrame:
    """Rows to take of each group: all where the group is below the upper median of group sizes, else at most `target`."""
    counts = df.groupBy(*group).agg(F.count("*").alias("total"))
    ranked = counts.withColumn("_rank", F.row_number().over(Window.orderBy("total", *group)) - 1).withColumn("_n", F.count("*").over(Window.partitionBy()))
    median = ranked.filter(F.col("_rank") == F.floor(F.col("_n") / 2)).select(F.col("total").alias("median_total"))
    return counts.crossJoin(F.broadcast(median)).withColumn("take", F.when(F.col("total") < F.col("median_total"), F.col("total")).otherwise(F.least(F.col("total"), F.lit(target))))


def stratified(df: DataFrame, score: str, key: str, strata: int, per_stratum: int, seed: int) -> DataFrame:
    """per_stratum rows of each score stratum (linear percentiles, upper edges excluded), in random order."""
    edges = quantiles(df, [], score, [i / strata for i in range(1, strata)]).agg(F.collect_list("quantile").alias("edges"))
    cut = df.crossJoin(F.broadcast(edges)).withColumn("stratum", F.size(F.filter("edges", lambda e: F.col(score) >= e))).drop("edges")
    return fill_quota(cut, ["stratum"], random_order(seed, key), per_stratum)


def round_robin(df: DataFrame, group: str, key: str, needed: int, cap: int, seed: int) -> DataFrame:
    """Take one row of each group in turn, at most `cap` of a group, until `needed`."""
    turn = F.row_number().over(Window.partitionBy(group).orderBy(*random_order(seed, key)))
    dealt = df.withColumn("turn", turn).filter(F.col("turn") <= cap)
    return dealt.orderBy("turn", md5_key(F.lit(f"{seed}:"), F.col(group).cast("string")), group).limit(needed)


def weighted_sample(df: DataFrame, weight: str, key: str, n: int, seed: int) -> DataFrame:
    """n rows without replacement, with chances in proportion to the weights (exponential keys)."""
    draw = -F.log(uniform(F.lit(f"{seed}:"), F.col(key).cast("string"))) / F.col(weight)
    return df.filter(F.col(weight) > 0).withColumn("draw", draw).orderBy("draw", key).limit(n)


def temporal_segments(df: DataFrame, group: str, order: list[str], score: str, n: int) -> DataFrame:
    """The best row of each of n equal segments of a group's rows in order; segment i is [i len // n, (i + 1) len // n)."""
    spot = F.row_number().over(Window.partitionBy(group).orderBy(*order)) - 1
    size = F.count("*").over(Window.partitionBy(group))
    placed = df.withColumn("position", spot).withColumn("size", size)
    segment = F.floor(((F.col("position") + 1) * n - 1) / F.col("size")).cast("int")
    best = F.row_number().over(Window.partitionBy(group, "segment").orderBy(F.desc(score), "position"))
    return placed.withColumn("segment", segment).withColumn("best", best).filter("best = 1").drop("best")


def greedy_gap(df: DataFrame, group: str, position: str, score: str, gap: int, target: int) -> DataFrame:
    """Per group, rows by falling score that are at least `gap` positions from all taken ones, then the best of the rest.

    Positions are unique in a group. The sequential rule takes one row of each group in a round, `target` rounds in all.
    """
    apart = ~F.exists("picks", lambda p: F.abs(p[position] - F.col(position)) < gap)
    first = picked_in_rounds(df, group, position, [], F.col(score), apart, target, (score,)).select(group, position, "pick")
    named = df.join(first, [group, position], "left")
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.col("pick").isNull(), "pick", F.desc(score), position))
    return named.withColumn("rank", rank).filter(F.col("rank") <= target).select(*df.columns)


def strided(df: DataFrame, group: str, order: list[str], n: int) -> DataFrame:
    """The rows at floor(k len / n) for k from 0 to n - 1 in each group's order; all rows of a group of at most n."""
    w = Window.partitionBy(group)
    placed = df.withColumn("_i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("_n", F.count("*").over(w))
    # the first k whose place is not before the row
    k = F.ceil(F.col("_i") * n / F.col("_n"))
    return placed.filter((F.col("_n") <= n) | ((k < n) & (F.floor(k * F.col("_n") / n) == F.col("_i")))).drop("_i", "_n")


def with_coverage(names: DataFrame, name: str, n: int, seed: int) -> DataFrame:
    """k, name for k from 0 to n - 1: every name once in random order, then draws with replacement. names: a stated list of distinct names."""
    ranked = names.withColumn("i", (F.row_number().over(Window.orderBy(*random_order(seed, name))) - 1).cast("long"))
    size = names.count()
    turns = names.sparkSession.range(n).withColumnRenamed("id", "k")
    pick = F.when(F.col("k") < size, F.col("k")).otherwise(md5_key(F.lit(f"{seed}:"), F.col("k").cast("string")) % max(size, 1))
    return turns.withColumn("i", pick).join(ranked, "i").select("k", name)


def category_sample(df: DataFrame, category: str, key: str, each: int, n: int, seed: int) -> DataFrame:
    """`each` rows of every category in random order, then rows of all, which may repeat those, up to n; fill is 1 for the latter."""
    rank = F.row_number().over(Window.partitionBy(category).orderBy(*random_order(seed, key)))
    first = df.withColumn("_r", rank).filter(F.col("_r") <= each).drop("_r").withColumn("fill", F.lit(0))
    draw = [md5_key(F.lit(f"{seed}:fill"), F.col(key).cast("string")), F.col(key)]
    more = df.orderBy(*draw).limit(n).withColumn("fill", F.lit(1))
    return first.unionByName(more).withColumn("_d", F.when(F.col("fill") == 0, random_order(seed, key)[0]).otherwise(draw[0])).transform(lambda t: _filled(t, key, n, seed))


def _filled(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """The first rows, and of the fill (in the order of its draw) as many as are missing; of too many, the first n at random."""
    count = F.sum(F.when(F.col("fill") == 0, 1)).over(Window.partitionBy(F.lit(0)))  # a few rows a category
    place = F.row_number().over(Window.partitionBy("fill").orderBy("_d", key))
    kept = df.withColumns({"_c": F.coalesce(count, F.lit(0)), "_p": place}).filter((F.col("fill") == 0) | (F.col("_p") <= n - F.col("_c")))
    return kept.orderBy("fill", *random_order(seed, key)).limit(n).drop("_d", "_c", "_p")


def tiered_review(df: DataFrame, group: str, tier: str, score: str, key: str, wanted: dict[str, int], target: int, seed: int, bins: int = 5) -> DataFrame:
    """Of each group and tier so many rows, spread over bins of the tier's score, filled at random; `target` of all in random order."""
    edges = quantiles(df, [tier], score, [i / bins for i in range(1, bins)]).groupBy(tier).agg(F.collect_list("quantile").alias("_edges"))
    cut = df.join(edges, tier).withColumn("_bin", F.size(F.filter("_edges", lambda e: F.col(score) >= e))).drop("_edges")
    most = F.coalesce(*(F.when(F.col(tier) == t, F.lit(n)) for t, n in wanted.items()), F.lit(0))
    each = F.greatest(F.lit(1), F.floor(most / bins))
    nth = F.row_number().over(Window.partitionBy(group, tier, "_bin").orderBy(*random_order(seed, key)))
    turn = F.row_number().over(Window.partitionBy(group, tier).orderBy(F.col("_nth") > each, *random_order(seed, key)))
    few = cut.withColumn("_nth", nth).filter(F.col("_nth") <= most).withColumn("_turn", turn).filter(F.col("_turn") <= most)
    return few.orderBy(*random_order(seed, key)).limit(target).drop("_bin", "_nth", "_turn")


def combinations(lists: list[DataFrame], n: int) -> DataFrame:
    """All combinations of short lists, a column each, in order, up to n. The lists are stated and short; each is sent to all tasks."""
    out = lists[0]
    for part in lists[1:]:
        out = out.crossJoin(F.broadcast(part))
    return out.orderBy(*out.columns).limit(n)
