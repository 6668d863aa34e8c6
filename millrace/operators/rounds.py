"""Jobs of several rounds: written tables between rounds, connected components, and greedy rules settled round by round."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; on a local master, where that is unset, a temporary one."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if base is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        import tempfile

        sc.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
        base = sc.getCheckpointDir()
    return base.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: the lineage ends there, and a lost executor costs one round."""
    path = f"{shared_dir(df.sparkSession)}/rounds/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of links, and the least node of each one's component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j, label = at[: len(a)], at[len(a) :], np.arange(len(nodes))
    while (label[i] != label[j]).any():
        low = np.minimum(label[i], label[j])
        for end in (i, j):
            np.minimum.at(label, label[end], low)
        while (label[label] != label).any():
            label = label[label]
    return nodes, nodes[label]


def _settled(edges: DataFrame) -> DataFrame:
    """u, to: the nodes of a few links and the least node of each one's component, by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            whole = pa.Table.from_batches(held)
            kind = whole.schema.field(0).type
            found = stars(*(whole.column(c).to_numpy() for c in range(2)))
            yield pa.RecordBatch.from_arrays([pa.array(v, kind) for v in found], ["u", "to"])

    kind = edges.schema["a"].dataType.simpleString()
    return edges.select("a", "b").coalesce(1).mapInArrow(run, f"u {kind}, to {kind}")


def components(links: DataFrame, few: int = 100_000) -> DataFrame:
    """node, component (its least node) for every node that has a link; links: a, b of one orderable type.

    Each round replaces a node by that of least rank within two steps, ranks being hashes drawn anew, and drops links that
    become loops: chains shrink by a share in every round and stars go in one. A hub is only ever a key of a grouping.
    The last `few` links are settled by one task.
    """
    edges = written(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    rounds: list[DataFrame] = []
    while n := edges.count():
        if n <= few:
            rounds.append(written(_settled(edges), "moved"))
            break
        rank = lambda c, salt=len(rounds): F.xxhash64(F.lit(salt), F.col(c))
        both = edges.select("a", "b").union(edges.select("b", "a")).toDF("u", "v")
        near = both.union(both.select("u", F.col("u").alias("v"))).groupBy("u").agg(F.min_by("v", rank("v")).alias("m"))
        moved = both.join(near.toDF("v", "m"), "v").select("u", "m").union(near).groupBy("u").agg(F.min_by("m", rank("m")).alias("to"))
        rounds.append(written(moved, "moved"))
        ends = edges.join(rounds[-1].toDF("a", "x"), "a").join(rounds[-1].toDF("b", "y"), "b").filter("x <> y")
        edges = written(ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    if not rounds:
        return nodes.withColumn("component", F.col("node"))
    labels = rounds[0]
    for moved in rounds[1:]:
        labels = labels.join(moved.toDF("to", "next"), "to", "left").select("u", F.coalesce("next", "to").alias("to"))
    labels = written(labels, "labels")
    least = labels.join(labels.groupBy("to").agg(F.min("u").alias("least")), "to").select(F.col("u").alias("node"), "least")
    return nodes.join(least, "node", "left").select("node", F.coalesce("least", "node").alias("component"))


def settle_first_wins(nodes: DataFrame, conflicts: DataFrame) -> DataFrame:
    """k, leader: going up the keys, a node is kept unless a kept one is in conflict with it; then that least one leads it.

    nodes: k; conflicts: a, b with a < b. In a round all nodes without an open smaller neighbour are kept, and their
    neighbours go; rounds go on until no conflict is open. The result is that of the sequential rule.
    """
    edges = written(conflicts.select("a", "b").distinct(), "conflicts")
    open_, kept = edges, None
    while not open_.isEmpty():
        firsts = written(open_.select("a").distinct().join(open_.select(F.col("b").alias("a")).distinct(), "a", "left_anti"), "kept")
        kept = firsts if kept is None else kept.union(firsts)
        gone = open_.join(firsts, "a").select("b").distinct()
        left = open_.join(gone, "b", "left_anti").join(gone.toDF("a"), "a", "left_anti")
        lone = left.select("a").union(left.select("b")).distinct()
        touched = open_.select(F.col("b").alias("a")).distinct()
        # nodes whose smaller neighbours have all gone are kept, too, though no link of theirs is left
        free = touched.join(gone.toDF("a"), "a", "left_anti").join(lone, "a", "left_anti")
        kept = kept.union(written(free, "kept"))
        open_ = written(left, "open")
    if kept is None:
        return nodes.select("k", F.col("k").alias("leader"))
    kept = kept.distinct()
    dropped = edges.join(kept, "a").join(kept.toDF("b"), "b", "left_anti").groupBy(F.col("b").alias("k")).agg(F.min("a").alias("leader"))
    return nodes.join(dropped, "k", "left").select("k", F.coalesce("leader", "k").alias("leader"))


def picked_in_rounds(df: DataFrame, group: str, key: str, columns: list[str], score: Column, allowed: Column, n: int, reads: tuple[str, ...] = ()) -> DataFrame:
    """Up to n rows of each group, one for each group and round: the greatest score among rows that are allowed.

    score and allowed read key, columns and `reads`, and see `picks`, the rows taken so far as an array of structs of key and columns. A round is one
    grouping with a running maximum, so a group of any size is spread over tasks. Adds pick (0, 1, ...); ties go to the least key.
    """
    row = F.struct(key, *columns)
    kinds = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in df.select(key, *columns).schema.fields)
    df, taken = written(df.select(*dict.fromkeys([group, key, *columns, *reads])), "candidates"), None  # the rounds read it again and again
    for _ in range(n):
        rows = df.withColumn("picks", F.array().cast(f"array<struct<{kinds}>>")) if taken is None else df.join(taken, group)
        free = rows.filter(allowed & ~F.exists("picks", lambda p: p[key] == F.col(key)))
        best = free.groupBy(group).agg(F.max_by(row, F.struct(score, -F.col(key))).alias("best"))
        if taken is None:
            taken = best.select(group, F.array("best").alias("picks"))
        else:
            taken = taken.join(best, group, "left").select(group, F.when(F.col("best").isNull(), F.col("picks")).otherwise(F.array_append("picks", F.col("best"))).alias("picks"))
        taken = written(taken, "picks")
    return taken.select(group, F.posexplode("picks").alias("pick", "p")).select(group, "pick", "p.*")


def positions(df: DataFrame, order: list[str], name: str, parts: int | None = None, group: list[str] | None = None) -> DataFrame:
    """Add name: 0, 1, ... in the given order, in the whole table or in each group, without one task for all rows.

    Rows are dealt by ranges of group and order, sorted and written with their part and place in it; the counts of the
    written parts, a row a part and group, tell where a part begins.
    """
    keys = [*(group or []), *order]
    dealt = df.repartitionByRange(parts, *keys) if parts else df.repartitionByRange(*keys)
    kept = dealt.sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33))
    kept = written(kept, "positions")
    counts = kept.groupBy(*(group or []), "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    window = Window.partitionBy(*(group or [F.lit(0)])).orderBy("_part")
    begins = counts.withColumn("_before", F.sum("_n").over(window) - F.col("_n"))
    begins = begins.select(F.col("_part").alias("_p"), "_first", "_before", *(F.col(c).alias(f"_g{i}") for i, c in enumerate(group or [])))
    same = [F.col("_part") == F.col("_p"), *(F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group or []))]
    return kept.join(begins, same).select(*df.columns, (F.col("_before") + F.col("_at") - F.col("_first")).cast("long").alias(name))


def quantiles(df: DataFrame, group: list[str], value: str, shares: list[float], bins: int = 1 << 16, salts: int = 4) -> DataFrame:
    """group, share, quantile: exact quantiles with linear interpolation; nulls and NaN are left out.

    A histogram of at most `bins` bins tells in which bin each wanted place lies; that bin's least and greatest values are the
    ends of the next histogram, until they are equal. A bin holds the ends alone, so each round gets on, whatever the values.
    Only counts of bins are shuffled, and no row or value comes to the driver. Salts spread a group that has most rows.
    """
    names = [f"_g{i}" for i in range(len(group))]
    v = F.col(value).cast("double")
    values = df.select(*(F.col(c).alias(n) for c, n in zip(group, names, strict=True)), v.alias("_v")).filter(v.isNotNull() & ~F.isnan(v))
    values = written(values, "values").withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    spot = (F.col("_all") - 1) * F.col("share")
    ends = values.groupBy(*names).agg(F.count("*").alias("_all"), F.min("_v").alias("_low"), F.max("_v").alias("_high")).filter("_all > 0")
    wanted = ends.withColumn("share", F.explode(F.array(*(F.lit(float(s)) for s in shares)))).withColumn("_spot", spot)
    wanted = wanted.withColumn("_at", F.explode(F.array_distinct(F.array(F.floor("_spot"), F.ceil("_spot"))))).withColumn("_left", F.col("_at"))
    wanted = wanted.select(*names, "share", "_spot", "_at", "_left", "_low", "_high")
    done = None
    while True:
        wanted = written(wanted, "wanted")  # a few rows a group
        done = wanted.filter("_low = _high") if done is None else done.unionByName(wanted.filter("_low = _high"))
        open_ = wanted.filter("_low < _high")
        if open_.isEmpty():
            break
        spans = open_.select(*(F.col(n).alias(f"{n}s") for n in names), F.col("_low").alias("_lo"), F.col("_high").alias("_hi")).distinct().withColumn("_s", F.explode(F.array(*map(F.lit, range(salts)))))
        meets = [F.col("_salt") == F.col("_s"), *(F.col(n).eqNullSafe(F.col(f"{n}s")) for n in names), (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))]
        width = F.col("_hi") / bins - F.col("_lo") / bins
        inner = F.when(width > 0, F.least(F.lit(bins - 3), F.floor((F.col("_v") - F.col("_lo")) / width))).otherwise(0)
        bin_ = F.when(F.col("_v") <= F.col("_lo"), 0).when(F.col("_v") >= F.col("_hi"), bins - 1).otherwise(1 + inner)
        counts = values.join(spans, meets).groupBy(*names, "_lo", "_hi", bin_.alias("_bin")).agg(F.count("*").alias("_n"), F.min("_v").alias("_first"), F.max("_v").alias("_last"))
        upto = F.sum("_n").over(Window.partitionBy(*names, "_lo", "_hi").orderBy("_bin"))  # at most `bins` rows a span
        counts = counts.withColumn("_upto", upto).select(*(F.col(n).alias(f"{n}c") for n in names), "_lo", "_hi", "_n", "_upto", "_first", "_last")
        inside = [F.col("_low") == F.col("_lo"), F.col("_high") == F.col("_hi"), *(F.col(n).eqNullSafe(F.col(f"{n}c")) for n in names), (F.col("_left") < F.col("_upto")) & (F.col("_left") >= F.col("_upto") - F.col("_n"))]
        found = open_.join(counts, inside)
        wanted = found.select(*names, "share", "_spot", "_at", (F.col("_left") - F.col("_upto") + F.col("_n")).alias("_left"), F.col("_first").alias("_low"), F.col("_last").alias("_high"))
    both = done.groupBy(*names, "share", "_spot").agg(F.min_by("_low", "_at").alias("_lo"), F.max_by("_low", "_at").alias("_hi"))
    quantile = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_spot") - F.floor("_spot"))
    return both.select(*(F.col(n).alias(c) for c, n in zip(group, names, strict=True)), "share", quantile.alias("quantile"))
