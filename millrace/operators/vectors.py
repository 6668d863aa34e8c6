"""Best match, centroids, consistency and near-duplicates over vectors and bit hashes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.vector import dot, hamming, md5_key
from millrace.operators.rounds import picked_in_rounds, settle_first_wins, written


def fingerprints(df: DataFrame, text: str) -> DataFrame:
    """df with bits: 60 bits of a text, each the last bit of the least hash among the words that fall to it; null without words.

    Stands in for an image's perceptual hash: texts that differ in few words differ in few bits. All of it is made in the row.
    """
    words = F.filter(F.array_distinct(F.split(F.lower(text), r"\s+")), lambda w: w != "")
    # one long a word: the place in the upper bits, the rest of the hash in the lower 55; sorted, the least of each place comes first
    place = lambda x: F.shiftright(x, 55)
    coded = F.transform(F.transform(words, lambda w: md5_key(w)), lambda m: F.shiftleft(m % 60, 55).bitwiseOR(F.call_function("div", m, F.lit(60))))
    firsts = lambda xs: F.filter(xs, lambda x, i: (i == 0) | (place(x) != place(F.get(xs, i - 1))))
    bit = lambda x: F.call_function("shiftleft", x.bitwiseAND(F.lit(1)), place(x).cast("int"))
    bits = lambda xs: F.when(F.size(xs) > 0, F.aggregate(firsts(xs), F.lit(0).cast("long"), lambda s, x: s.bitwiseOR(bit(x))))
    return df.withColumn("bits", F.transform(F.array(F.sort_array(coded)), bits)[0])  # as a lambda's variable the array is made once


def _long(x: int) -> Column:
    """The 64 bits of a number as a long."""
    return F.lit(x - (1 << 64) if x >> 63 else x).cast("long")


def best_match(rows: DataFrame, references: DataFrame, key: str, vector: str, name: str, threshold: float, block: int = 10_000) -> DataFrame:
    """The reference name with the greatest dot product; null below the threshold, the lesser name where two are equal.

    references: a stated set (name, vector), averaged or chosen beforehand. It is sent to all tasks in blocks of about
    `block` vectors, and each block meets every row.
    """
    refs = written(references.select(F.col(name).alias("_name"), F.col(vector).alias("_ref")), "references")
    blocks = max(1, -(-refs.count() // block))
    best = None
    for i in range(blocks):
        part = refs.filter(F.pmod(F.xxhash64("_name"), F.lit(blocks)) == i) if blocks > 1 else refs
        scored = rows.crossJoin(F.broadcast(part)).withColumn("score", F.round(dot(F.col(vector), F.col("_ref")), 9))
        own = scored.select(key, F.struct((-F.col("score")).alias("less"), "_name").alias("s"))
        best = own if best is None else best.union(own)
    best = best.groupBy(key).agg(F.min("s").alias("b"))
    return best.select(key, F.when(-F.col("b.less") >= threshold, F.col("b._name")).alias("match"), (-F.col("b.less")).alias("score"))


def centroids(df: DataFrame, label: str, vector: str) -> DataFrame:
    """Mean vector and size of each label: component sums are combined before the shuffle."""
    parts = df.select(label, F.posexplode(vector).alias("i", "x"))
    means = parts.groupBy(label, "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    vectors = means.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("centroid"))
    return vectors.join(df.groupBy(label).agg(F.count("*").alias("n")), label)


def nearest_to_centroid(df: DataFrame, key: str, label: str, vector: str, k: int) -> DataFrame:
    """The k members of each label that are closest to its centroid."""
    near = df.join(centroids(df, label, vector), label)
    squares = F.aggregate(F.zip_with(vector, "centroid", lambda x, m: (x - m) * (x - m)), F.lit(0.0), lambda s, x: s + x)
    near = near.withColumn("distance", F.round(F.sqrt(squares), 6))
    rank = F.row_number().over(Window.partitionBy(label).orderBy("distance", key))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k).select(key, label, "distance", "rank")


def pair_consistency(df: DataFrame, label: str, vector: str) -> DataFrame:
    """Mean dot product over all pairs of a label, without making pairs: (|sum|^2 - sum |x|^2) / (n (n - 1))."""
    parts = df.select(label, F.posexplode(vector).alias("i", "x")).groupBy(label, "i").agg(F.sum(F.col("x").cast("double")).alias("s"), F.sum(F.col("x").cast("double") * F.col("x").cast("double")).alias("q"), F.count("*").alias("n"))
    return parts.groupBy(label).agg(F.max("n").alias("n"), ((F.sum(F.col("s") * F.col("s")) - F.sum("q")) / (F.max("n") * (F.max("n") - 1))).alias("consistency"))


def transitions(df: DataFrame, group: str, order: str, vector: str, threshold: float) -> DataFrame:
    """First and last row of each group, and rows like the previous or next one: dot product at least the threshold."""
    w = Window.partitionBy(group).orderBy(order)
    before, after = dot(F.lag(vector).over(w), F.col(vector)), dot(F.col(vector), F.lead(vector).over(w))
    ends = F.lag(order).over(w).isNull() | F.lead(order).over(w).isNull()
    return df.withColumn("kept", ends | F.coalesce(F.round(before, 9) >= threshold, F.lit(False)) | F.coalesce(F.round(after, 9) >= threshold, F.lit(False)))


#: Hashes of a chunk, and pairs of hashes that are compared at once.
CHUNK, AREA = 1 << 14, 1 << 18


def _chunk_pairs(classes: DataFrame, distance: int, group: list[str], chunk: int) -> DataFrame:
    """Pairs of classes at most `distance` bits apart: of each group every chunk of hashes meets every other one, in a task of their own."""
    names = [f"_g{i}" for i in range(len(group))]
    rows = written(classes.select(*(F.col(c).alias(n) for c, n in zip(group, names, strict=True)), "k", "h", "members"), "classes")
    parts = rows.groupBy(*names).agg(F.ceil(F.count("*") / chunk).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("h"), F.col("parts")).cast("int")
    placed = (rows.join(parts, names) if names else rows.crossJoin(F.broadcast(parts))).withColumn("own", own)
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select(*names, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "k", "h", "members")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).combine_chunks()
        at, first = table.column("own").to_numpy(), table.column("i")[0].as_py()
        left, right = np.flatnonzero(at == first), np.flatnonzero(at == table.column("j")[0].as_py())
        h, k = table.column("h").to_numpy().view(np.uint64), table.column("k").to_numpy()
        inside, there = first == table.column("j")[0].as_py(), h[right]
        step = max(1, AREA // max(1, len(right)))
        for lo in range(0, len(left), step):
            apart = np.bitwise_count(h[left[lo : lo + step], None] ^ there)
            near = np.flatnonzero(apart.ravel() <= distance)
            far, x, y = apart.ravel()[near], left[lo + near // len(right)], right[near % len(right)]
            if inside:
                once = k[x] < k[y]
                far, x, y = far[once], x[once], y[once]
            if len(x):
                swap = k[y] < k[x]
                x, y = pa.array(np.where(swap, y, x)), pa.array(np.where(swap, x, y))
                a, b = table.take(x), table.take(y)
                columns = [*(a.column(n) for n in names), a.column("k"), b.column("k"), a.column("members"), b.column("members"), pa.chunked_array([pa.array(far.astype(np.int32))])]
                yield from pa.Table.from_arrays(columns, [*names, "k_a", "k_b", "members_a", "members_b", "distance"]).to_batches()

    kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join([*(f"{n} {kind[n]}" for n in names), f"k_a {kind['k']}, k_b {kind['k']}, members_a long, members_b long, distance int"])
    found = dealt.groupBy(*names, "i", "j").applyInArrow(run, schema)
    return found.select(*(F.col(n).alias(c) for c, n in zip(group, names, strict=True)), "k_a", "k_b", "members_a", "members_b", "distance")


#: Hashes of a part that `near_counts` sends to a task, at most.
PART = 1 << 20


def close_pairs(left: np.ndarray, right: np.ndarray, distance: int, total_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indexes of all pairs of hashes of left and right at most `distance` bits apart, each pair once, some at a time.

    The bits are cut into bands so that in one of them a near pair is at most 1 bit apart. For each band the right hashes are sorted by
    it, and those of a value meet the left ones whose values are that near; a pair counts in the first band that has it so. Where few
    values hold most hashes, as of short texts, that would make more pairs than there are, and all meet all instead.
    """
    cuts = np.linspace(0, total_bits, max(distance // 2 + 1, -(-total_bits // 16)) + 1).astype(int).tolist()
    masks = [np.uint64((1 << b) - (1 << a)) for a, b in zip(cuts, cuts[1:], strict=False)]
    bands, met = [], 0
    for a, b, mask in zip(cuts, cuts[1:], masks, strict=False):
        flips = np.array([0, *(1 << i for i in range(b - a))])
        side = [((h & mask) >> np.uint64(a)).astype(np.int64) for h in (left, right)]
        sizes = [np.bincount(v, minlength=1 << (b - a)) for v in side]
        met += sum(int((sizes[0] * sizes[1][np.arange(1 << (b - a)) ^ f]).sum()) for f in flips.tolist()) + (AREA << (b - a) >> 2)
        bands.append((flips, [np.argsort(v, kind="stable") for v in side], [np.append(0, np.cumsum(n)) for n in sizes]))
    if met > len(left) * len(right):
        step = max(1, AREA // max(1, len(right)))
        for lo in range(0, len(left), step):
            near = np.flatnonzero(np.bitwise_count(left[lo : lo + step, None] ^ right) <= distance)
            yield lo + near // len(right), near % len(right)
        return
    for n, (flips, order, begins) in enumerate(bands):
        sorted_right = right[order[1]]
        for value in np.flatnonzero(np.diff(begins[0])).tolist():
            there = value ^ flips
            low, high = begins[1][there], begins[1][there + 1]
            low, size = low[high > low], (high - low)[high > low]
            if not len(low):
                continue
            columns = np.arange(int(size.sum())) + np.repeat(low - np.cumsum(size) + size, size)
            there, rows = sorted_right[columns], order[0][begins[0][value] : begins[0][value + 1]]
            step = max(1, AREA // len(columns))
            for lo in range(0, len(rows), step):
                apart = left[rows[lo : lo + step], None] ^ there
                near = np.flatnonzero(np.bitwise_count(apart) <= distance)
                x = apart.ravel()[near]
                for mask in masks[:n]:
                    later = np.bitwise_count(x & mask) > 1
                    near, x = near[later], x[later]
                if len(near):
                    yield rows[lo + near // len(columns)], order[1][columns[near % len(columns)]]


def near_counts(df: DataFrame, key: str, bits: Column, distance: int, total_bits: int = 64, part: int = PART) -> DataFrame:
    """k, h, same, near: each distinct hash with its least key, its rows, and the rows of other hashes within `distance` bits.

    Hashes are dealt to parts, and a part meets a part in one task that adds up what is near, so there is no row a pair.
    """
    classes = written(df.select(F.col(key).alias("k"), bits.cast("long").alias("h")).filter("h is not null").groupBy("h").agg(F.min("k").alias("k"), F.count("*").alias("same")), "classes")
    n, cores = classes.count(), df.sparkSession.sparkContext.defaultParallelism
    parts = max(-(-n // part), min(-(-n // 4096), math.ceil(math.sqrt(12 * cores))), 1)
    own = F.pmod(F.xxhash64("h"), F.lit(parts)).cast("int")
    dealt = classes.select("h", "same", own.alias("own")).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    dealt = dealt.select(F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "h", "same")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        i, j = (v.as_py() for v in key)
        own, h, same = (table.column(c).to_numpy() for c in ("own", "h", "same"))
        sides = [(h[own == p], same[own == p]) for p in (i, j)]
        near = [np.zeros(len(s[0]), np.int64) for s in sides]
        for x, y in close_pairs(sides[0][0].view(np.uint64), sides[1][0].view(np.uint64), distance, total_bits):
            if i == j:  # each pair comes up in both orders, and each hash with itself
                x, y = x[x != y], y[x != y]
            np.add.at(near[0], x, sides[1][1][y])
            if i != j:
                np.add.at(near[1], y, sides[0][1][x])
        found = [(s[0][n > 0], n[n > 0]) for s, n in zip(sides, near, strict=True)][: 1 if i == j else 2]
        return pa.table({"h": np.concatenate([f[0] for f in found]), "near": np.concatenate([f[1] for f in found])})

    met = dealt.repartition(max(1, min(parts * (parts + 1) // 2, 8 * cores)), "i", "j").groupBy("i", "j").applyInArrow(run, "h long, near long")
    return classes.join(met.groupBy("h").agg(F.sum("near").alias("near")), "h", "left").select("k", "h", "same", F.coalesce("near", F.lit(0)).alias("near"))


def hamming_pairs(df: DataFrame, key: str, bits: Column, distance: int, total_bits: int = 64, group: list[str] | None = None, chunk: int = CHUNK) -> DataFrame:
    """Pairs of distinct hashes within `distance` bits, in each group.

    Up to 3 bits: of 4 bands (one more than the bits) one is equal, so only hashes that share a band meet. More bits: bands would be
    short, and of texts of few words most bits are 0, so frequent ones would hold most hashes; there chunks of `chunk` hashes meet in
    tasks of bounded memory and all their pairs are counted, a nanosecond or two each.
    Rows without a hash have no pairs. Equal hashes are one class: the pairs are between the classes' least keys, `members` has their sizes.
    """
    group = group or []
    classes = df.select(*group, F.col(key).alias("k"), bits.cast("long").alias("h")).filter("h is not null").groupBy(*group, "h").agg(F.min("k").alias("k"), F.count("*").alias("members"))
    if distance > 3:
        return _chunk_pairs(classes, distance, group, chunk)
    bands = distance + 1
    width = total_bits // bands
    part = lambda i: F.shiftrightunsigned("h", i * width).bitwiseAND(_long((1 << width) - 1))
    cut = F.array(*(F.struct(F.lit(i).alias("band"), part(i).alias("part")) for i in range(bands)))
    entries = classes.withColumn("b", F.explode(cut)).select(*group, "k", "h", "members", "b.*")
    a, b = (entries.select(*group, "band", "part", *(F.col(c).alias(f"{c}_{s}") for c in ("k", "h", "members"))) for s in "ab")
    met = a.join(b, [*group, "band", "part"]).filter("k_a < k_b").withColumn("distance", hamming(F.col("h_a"), F.col("h_b"))).filter(F.col("distance") <= distance)
    return met.select(*group, "k_a", "k_b", "members_a", "members_b", "distance").distinct()


def first_wins(df: DataFrame, group: str, key: str, bits: str, distance: int, total_bits: int = 64) -> DataFrame:
    """Greedy dedup within groups: a row is kept unless it is within `distance` bits of a row kept before, in key order.

    Adds duplicate_of, the first kept row that is near (null for kept rows). Rows without a hash are kept. Keys are unique. Rows with a kept leader are
    also what leader clustering gives: there each free row takes every later free row that is near.
    """
    firsts = df.filter(F.col(bits).isNotNull()).groupBy(group, bits).agg(F.min(key).alias("k"))
    pairs = hamming_pairs(df, key, F.col(bits), distance, total_bits, [group]).select(F.col("k_a").alias("a"), F.col("k_b").alias("b"))
    led = firsts.join(settle_first_wins(firsts.select("k"), pairs), "k").select(group, bits, "leader")
    led = led.select(F.col(group).alias("_group"), F.col(bits).alias("_bits"), "leader")
    same = df[group].eqNullSafe(F.col("_group")) & (df[bits] == F.col("_bits"))
    return df.join(led, same, "left").withColumn("duplicate_of", F.when(F.col("leader") != F.col(key), F.col("leader"))).select(*df.columns, "duplicate_of")


def farthest_points(df: DataFrame, group: str, key: str, bits: str, n: int) -> DataFrame:
    """n rows of each group by the max-min rule on Hamming distance, from the row with the least key on: a round a row."""
    away = F.coalesce(F.array_min(F.transform("picks", lambda p: hamming(F.col(bits), p[bits]))), F.lit(0))
    return df.join(picked_in_rounds(df, group, key, [bits], away, F.lit(True), n).select(group, key, "pick"), [group, key]).select(*df.columns, "pick")


def exact_dedup(df: DataFrame, digest: Column, order: list[str], key: str) -> DataFrame:
    """Each row with its digest, the key of the first row that has it, and whether it is that row."""
    rows = df.withColumn("digest", digest)
    first = rows.groupBy("digest").agg(F.min(F.struct(*order, key)).alias("_f"))
    return rows.join(first, "digest").withColumn("is_kept", F.col(key) == F.col(f"_f.{key}")).withColumn("duplicate_of", F.when(~F.col("is_kept"), F.col(f"_f.{key}"))).drop("_f")


def kmeans_report(df: DataFrame, vector: str, k: int, seed: int = 42) -> DataFrame:
    """Size and mean distance to the centre of each cluster of standardised vectors."""
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import StandardScaler
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = df.withColumn("raw", array_to_vector(F.transform(vector, lambda x: x.cast("double"))))
    model = Pipeline(stages=[StandardScaler(inputCol="raw", outputCol="scaled", withMean=True), KMeans(k=k, seed=seed, featuresCol="scaled", predictionCol="cluster", maxIter=300)]).fit(rows)
    centres = df.sparkSession.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.stages[-1].clusterCenters())], "cluster int, centre array<double>")
    placed = model.transform(rows).select("cluster", vector_to_array("scaled").alias("x")).join(F.broadcast(centres), "cluster")
    squares = F.aggregate(F.zip_with("x", "centre", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    return placed.groupBy("cluster").agg(F.count("*").alias("size"), F.avg(F.sqrt(squares)).alias("mean_distance"))


def leader_clusters(df: DataFrame, group: str, key: str, bits: str, distance: int, total_bits: int = 64) -> DataFrame:
    """Leader clustering within groups: in key order each free row leads and takes every later free row within `distance` bits.

    Adds leader (its own key for leaders).
    """
    return first_wins(df, group, key, bits, distance, total_bits).withColumn("leader", F.coalesce("duplicate_of", key)).drop("duplicate_of")


def merge_clusters(df: DataFrame, label: str, merged: list[int]) -> DataFrame:
    """Members of the merged labels get a new label: the greatest one plus 1."""
    new = df.agg(F.max(label) + 1).first()[0]
    return df.withColumn(label, F.when(F.col(label).isin(merged), F.lit(new)).otherwise(F.col(label)))


def split_cluster(df: DataFrame, key: str, label: str, split: int, assignment: DataFrame) -> DataFrame:
    """Members of one label get the labels of the assignment (key, new_label); those it doesn't list go."""
    named = df.filter(F.col(label) == split).join(assignment, key).withColumn(label, F.col("new_label")).drop("new_label")
    return df.filter(F.col(label) != split).unionByName(named.select(*df.columns))


def outlier_clusters(df: DataFrame, label: str, noise: int = -1, share: float = 0.2) -> DataFrame:
    """label, n, is_outlier: noise always, and of two or more clusters those below a share of the mean size."""
    sizes = df.groupBy(label).agg(F.count("*").alias("n"))
    mean = sizes.agg(F.avg("n").alias("_mean"), F.count("*").alias("_k"))
    small = (F.col("_k") >= 2) & (F.col("n") < share * F.col("_mean"))
    return sizes.crossJoin(F.broadcast(mean)).select(label, "n", ((F.col(label) == noise) | small).alias("is_outlier"))


def cluster_sizes(df: DataFrame, label: str, noise: int = -1) -> DataFrame:
    """One row: clusters without noise, mean, population deviation, least, greatest and median size, and the share of noise."""
    sizes = df.groupBy(label).agg(F.count("*").alias("n"))
    real = F.when(F.col(label) != noise, F.col("n"))
    return sizes.agg(
        F.count(real).alias("clusters"), F.avg(real).alias("mean"), F.stddev_pop(real).alias("std"), F.min(real).alias("least"), F.max(real).alias("most"),
        F.median(real).alias("median"), (F.coalesce(F.sum(F.when(F.col(label) == noise, F.col("n"))), F.lit(0)) / F.sum("n")).alias("noise"),
    )


def pair_moments(df: DataFrame, label: str, vector: str) -> DataFrame:
    """label, pairs, mean, std of the dot products over all pairs of a label, without making pairs.

    The sum over pairs is (|s|^2 - q) / 2, the sum of squares (|P|^2 - r) / 2: s is the sum of the vectors, P that of their
    outer products, q and r are those of |x|^2 and |x|^4. All are sums, made by Spark's own summary of each component product.
    """
    parts = df.select(label, F.transform(vector, lambda x: x.cast("double")).alias("x"))
    norms = parts.withColumn("m", F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)).groupBy(label).agg(F.count("*").alias("n"), F.sum("m").alias("q"), F.sum(F.col("m") * F.col("m")).alias("r"))
    rows = parts.select(label, "x", F.posexplode("x").alias("i", "xi"))
    sums = rows.groupBy(label, "i").agg(F.sum("xi").alias("s")).groupBy(label).agg(F.sum(F.col("s") * F.col("s")).alias("ss"))
    width = parts.select(F.size("x").alias("d")).agg(F.max("d")).first()[0] or 0
    products = rows.groupBy(label, "i").agg(*(F.sum(F.col("xi") * F.get("x", F.lit(j))).alias(f"p{j}") for j in range(width)))
    squares = products.select(label, sum((F.col(f"p{j}") * F.col(f"p{j}") for j in range(width)), F.lit(0.0)).alias("pp")).groupBy(label).agg(F.sum("pp").alias("pp"))
    pairs = F.col("n") * (F.col("n") - 1) / 2
    mean = (F.col("ss") - F.col("q")) / 2 / pairs
    both = norms.filter("n > 1").join(sums, label).join(squares, label)
    return both.select(label, pairs.cast("long").alias("pairs"), mean.alias("mean"), F.sqrt(F.greatest(F.lit(0.0), (F.col("pp") - F.col("r")) / 2 / pairs - mean * mean)).alias("std"))


def representatives(df: DataFrame, digest: str, key: str, size: str, seed: int = 7) -> DataFrame:
    """digest, n, first, largest, random: the row of each group that a mode keeps; the least key of equally large ones."""
    draw = md5_key(F.lit(f"{seed}:"), F.col(key).cast("string"))
    return df.groupBy(digest).agg(F.count("*").alias("n"), F.min(key).alias("first"), F.max_by(key, F.struct(size, -F.col(key))).alias("largest"), F.min_by(key, F.struct(draw, key)).alias("random"))
