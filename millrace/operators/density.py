"""Density clusters of vectors of any length: DBSCAN, and HDBSCAN by an exact spanning tree and its condensed hierarchy.

Equal vectors are one point with members. Points meet by the cells of `neighbours`; blocks give counts, spanning links or least
edges, never a row for each near pair. Hierarchies are made by halving: the lighter half of a problem's edges falls into components,
each of which is a problem of its own and one node of the heavier half's, until every problem fits one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.neighbours import Cells, deal_cells, distances, distinct_vectors, exact_distance, matrix, meet_cells, near_pairs, nearest, searches
from millrace.operators.rounds import components, positions, stars, written

#: The least distance that counts in 1 / distance; nearer points have the density of this one.
LEAST = 1e-9


def standardized(df: DataFrame, vector: str) -> DataFrame:
    """Components less their mean, over their deviation (of all rows; 1 where it is 0). Null vectors stay null."""
    parts = df.select(F.posexplode(vector).alias("i", "v")).groupBy("i").agg(F.avg(F.col("v").cast("double")).alias("m"), F.stddev_pop(F.col("v").cast("double")).alias("s"))
    rows = sorted(parts.collect(), key=lambda r: r["i"])  # a row a component
    mean, scale = (F.array(*(F.lit(float(r[c])) for r in rows)) for c in "ms")
    away = F.zip_with(F.zip_with(vector, mean, lambda v, m: v.cast("double") - m), scale, lambda v, s: v / F.when(s > 0, s).otherwise(1.0))
    return df.withColumn(vector, away) if rows else df


def _cells(df: DataFrame, key: str, vector: str, scale: bool, pivots: int | None) -> Cells:
    rows = df.select(F.col(key).cast("long").alias(key), vector)
    return deal_cells(written(distinct_vectors(standardized(rows, vector) if scale else rows, key, vector), "vectors"), pivots)


def _spread_out(df: DataFrame, key: str, vector: str, scale: bool, found: DataFrame, columns: list[str], none: list[Column]) -> DataFrame:
    """The result of each distinct vector for every row; rows without a sound vector get `none`."""
    rows = df.select(F.col(key).cast("long").alias(key), vector)
    scaled = (standardized(rows, vector) if scale else rows).select(key, F.transform(vector, lambda v: v.cast("double") + F.lit(0.0)).alias("x"))
    joined = scaled.join(found.select("x", *(F.col(c).alias(f"_{c}") for c in columns)), "x", "left")
    return joined.select(key, *(F.coalesce(F.col(f"_{c}"), n).alias(c) for c, n in zip(columns, none, strict=True)))


def dbscan_vectors(df: DataFrame, key: str, vector: str, eps: float, least: int, standardize: bool = False, pivots: int | None = None) -> DataFrame:
    """key, cluster (the least key of its core points; null: noise), is_core: DBSCAN by Euclidean distance.

    A point is core if `least` rows, itself included, are at most eps away. A border point goes to the cluster of the least core
    key that is near. Rows without a sound vector are noise.
    """
    cells = _cells(df, key, vector, standardize, pivots)
    if not len(cells.pivots):
        return df.select(F.col(key).cast("long").alias(key), F.lit(None).cast("long").alias("cluster"), F.lit(False).alias("is_core"))

    def count(s: dict[str, np.ndarray], t: dict[str, np.ndarray]) -> None:
        """Rows near each point, until they are enough."""
        n = s.setdefault("n", np.zeros(len(s["k"]), np.int64))
        rows = np.flatnonzero(n < least)
        if len(rows):
            for i, j, d in near_pairs({c: s[c][rows] for c in ("x", "f")} | {"long": s["long"]}, t, eps):
                np.add.at(n, rows[i[d <= eps]], t["members"][j[d <= eps]])

    def counted(s: dict[str, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(s["k"]), pa.array(s["n"])], ["k", "n"])

    def link(s: dict[str, np.ndarray], t: dict[str, np.ndarray]) -> pa.RecordBatch | None:
        """Links between components of the task, which are known so far; the greatest one's own pairs aren't made."""
        task, out = s["task"], []
        labels = task.setdefault("labels", [task[c]["comp"].copy() for c in "st"])
        if "main" not in s:
            names, sizes = np.unique(labels[1], return_counts=True)
            s["main"] = names[sizes.argmax()]
        for inside in (False, True):
            rows = np.flatnonzero((labels[0][s["at"]] == s["main"]) == inside)
            for columns in np.array_split(np.flatnonzero(labels[1][t["at"]] != s["main"]) if inside else np.arange(len(t["k"])), 4):
                own, theirs = labels[0][s["at"]][rows], labels[1][t["at"]][columns]
                if not len(rows) or not len(columns) or own.min() == own.max() == theirs.min() == theirs.max():
                    continue
                pairs: list[np.ndarray] = []
                for i, j, d in near_pairs({c: s[c][rows] for c in ("x", "f")} | {"long": s["long"]}, {c: t[c][columns] for c in ("x", "f")} | {"long": t["long"]}, eps):
                    good = (d <= eps) & (own[i] != theirs[j])
                    pairs.append(np.stack([own[i[good]], theirs[j[good]]]))
                a, b = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)
                if len(a):
                    nodes, to = stars(a, b)
                    out.append((nodes, to))
                    for label in labels:
                        at = np.minimum(np.searchsorted(nodes, label), len(nodes) - 1)
                        label[:] = np.where(nodes[at] == label, to[at], label)
        if not out:
            return None
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in zip(*out, strict=True)], ["a", "b"])

    def touch(s: dict[str, np.ndarray], t: dict[str, np.ndarray]) -> pa.RecordBatch:
        top = np.iinfo(np.int64).max
        core = np.full(len(s["k"]), top)
        for i, j, d in near_pairs(s, t, eps):
            np.minimum.at(core, i[d <= eps], t["k"][j[d <= eps]])
        return pa.RecordBatch.from_arrays([pa.array(s["k"][core < top]), pa.array(core[core < top])], ["k", "core"])

    def total(r: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        k, at = np.unique(r["k"], return_inverse=True)
        n = np.zeros(len(k), np.int64)
        np.add.at(n, at, r["n"])
        return {"k": k, "n": n}

    def first(r: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        order = np.lexsort((r["core"], r["k"]))
        k, at = np.unique(r["k"][order], return_index=True)
        return {"k": k, "core": r["core"][order][at]}

    def tie(r: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        return dict(zip("ab", stars(r["a"], r["b"]), strict=True))

    def enough(points: DataFrame, place: str) -> DataFrame:
        """k, n of points, and rows near them in such tiles; n is right up to `least`."""
        met = meet_cells(cells, searches(cells, points, F.lit(eps), place=place), cells.points, ["k", "x"], ["k", "x", "members"], count, "k long, n long", "near-counts", total, last=counted)
        return met.groupBy("k").agg(F.sum("n").alias("n"))

    def tied(cores: DataFrame, place: str, lone: np.ndarray | None = None) -> DataFrame:
        """node, component: components of cores that are linked by pairs of such tiles."""
        names = ["k", "x", "comp"]
        return components(meet_cells(cells, searches(cells, cores, F.lit(eps), lone, "comp", place), cores, names, names, link, "a long, b long", "core-links", tie))

    # most points have enough rows near them, and most cores are tied, in their own tile; the others meet the rest
    some = written(cells.points.join(enough(cells.points, "own"), "k", "left").withColumn("n", F.coalesce("n", F.lit(0))), "own-counts")
    few = some.filter(F.col("n") < least)
    more = enough(few.select(*cells.points.columns), "others").withColumnRenamed("n", "more")
    dense = some.filter(F.col("n") >= least).unionByName(few.join(more, "k").filter(F.col("n") + F.col("more") >= least).drop("more"))
    cores = written(dense.select(*cells.points.columns, F.col("k").alias("comp")), "cores")
    for place in ("own", "later"):
        lone = np.full(len(cells.pivots), -1, np.int64)
        for r in cores.groupBy("home").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low = high").collect():  # a row a pivot
            lone[r["home"]] = r["low"]
        if place == "later" and cores.select("comp").distinct().limit(2).count() < 2:
            break
        joined = tied(cores, place, lone)
        moved = cores.join(joined.select(F.col("node").alias("comp"), "component"), "comp", "left")
        cores = written(moved.select(*cells.points.columns, F.coalesce("component", "comp").alias("comp")), "cores")
    labels = cores.select("k", "x", F.col("comp").alias("cluster"))
    thin = written(cells.points.join(cores.select("k"), "k", "left_anti").select(*cells.points.columns), "thin")
    touched = meet_cells(cells, searches(cells, thin, F.lit(eps)), cores, ["k", "x"], ["k", "x"], touch, "k long, core long", "borders", first).groupBy("k").agg(F.min("core").alias("core"))
    border = thin.select("k", "x").join(touched, "k").join(labels.select(F.col("k").alias("core"), "cluster"), "core")
    found = labels.select("x", "cluster", F.lit(True).alias("is_core")).unionByName(border.select("x", "cluster", F.lit(False).alias("is_core")))
    return _spread_out(df, key, vector, standardize, found, ["cluster", "is_core"], [F.lit(None).cast("long"), F.lit(False)])


# the spanning tree of mutual reachability


def _edge() -> Column:
    return F.struct("w", "a", "b").alias("edge")


def _least_edges(comp: np.ndarray, w: np.ndarray, a: np.ndarray, b: np.ndarray, name: str = "comp") -> pa.RecordBatch:
    """The least edge (weight, lesser key, greater key) of each component."""
    low, high = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((high, low, w, comp))
    first = order[np.concatenate([[True], comp[order][1:] != comp[order][:-1]])] if len(order) else order
    return pa.RecordBatch.from_arrays([pa.array(comp[first]), pa.array(w[first]), pa.array(low[first]), pa.array(high[first])], [name, "w", "a", "b"])


def reachability_tree(cells: Cells, cores: DataFrame, near: DataFrame) -> DataFrame:
    """a, b, w: the least spanning tree of max(core of a, core of b, distance), by rounds of least outgoing edges.

    cores: k, core, reach (distance of the last known neighbour); near: the nearest neighbours a, b, distance. In a round every
    component has an outgoing edge from known neighbours and from pivots; only points that may have a lighter one search, within its
    weight, in cells that are not all the component's. Edges are ordered by weight and keys, so the tree is the only one.
    """
    points = written(cells.points.join(cores, "k"), "tree-points")
    c = points.select("k", "core")
    known = near.join(c.toDF("a", "ca"), "a").join(c.toDF("b", "cb"), "b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.greatest("distance", "ca", "cb").alias("w")).distinct()
    known = written(known, "known-edges")
    comp, tree = points.select("k", F.col("k").alias("comp")), None
    schema = "comp long, w double, a long, b long"
    while True:
        placed = written(points.join(comp, "k"), "placed")
        if placed.select("comp").distinct().limit(2).count() < 2:
            return tree if tree is not None else known.filter("false").select("a", "b", "w")
        spots = {r["k"]: (r["comp"], r["core"]) for r in placed.filter(F.col("k").isin(cells.pivot_keys.tolist())).select("k", "comp", "core").collect()}  # pivots only
        sent = placed.sparkSession.sparkContext.broadcast((cells.pivots, cells.pivot_keys, np.array([spots[k][0] for k in cells.pivot_keys.tolist()]), np.array([spots[k][1] for k in cells.pivot_keys.tolist()])))

        def to_pivots(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            pivots, keys, groups, core = sent.value
            for batch in batches:
                if batch.num_rows:
                    k, x, own, mine = batch.column(0).to_numpy(), matrix(batch.column(1)), batch.column(2).to_numpy(), batch.column(3).to_numpy()
                    w = np.maximum(np.maximum(distances(x, pivots), mine[:, None]), core)
                    w[groups == own[:, None]] = np.inf
                    best = w.argmin(axis=1)
                    real = np.isfinite(w[np.arange(len(k)), best])
                    k, x, own, mine, best = k[real], x[real], own[real], mine[real], best[real]
                    yield _least_edges(own, np.maximum(np.maximum(exact_distance(x, pivots[best]), mine), core[best]), k, keys[best])

        pivotal = placed.select("k", "x", "comp", "core").mapInArrow(to_pivots, schema)
        ends = placed.select("k", "comp")
        crossing = known.join(ends.toDF("a", "comp_a"), "a").join(ends.toDF("b", "comp_b"), "b").filter("comp_a <> comp_b")
        both = crossing.select(F.col("comp_a").alias("comp"), "w", "a", "b").unionByName(crossing.select(F.col("comp_b").alias("comp"), "w", "a", "b")).unionByName(pivotal)
        bound = written(both.groupBy("comp").agg(F.min(_edge()).alias("edge")), "bounds")
        seeking = placed.join(bound.select("comp", F.col("edge.w").alias("least")), "comp").filter(F.greatest("core", "reach") <= F.col("least"))
        # the greatest component needs no edge of its own: the others' edges shrink their number by half at least
        main = placed.groupBy("comp").count().orderBy(F.desc("count"), "comp").first()["comp"]
        seeking = seeking.filter(F.col("comp") != main)
        lone = np.full(len(cells.pivots), -1, np.int64)
        for r in placed.groupBy("home").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low = high").collect():  # a row a pivot
            lone[r["home"]] = r["low"]

        def lightest(s: dict[str, np.ndarray], t: dict[str, np.ndarray]) -> pa.RecordBatch | None:
            out, first = [], 256 if "cut" not in s else 0  # a few points first, as they may have nearer ones than the bound
            cut = s.setdefault("cut", s["least"].copy())
            for part in (slice(0, first), slice(first, None)) if first else (slice(None),):
                for i, j, d in near_pairs(s, {c: t[c][part] for c in ("x", "f")} | {"long": t["long"]}, cut):
                    j = j + (part.start or 0)
                    w = np.maximum(np.maximum(d, s["core"][i]), t["core"][j])
                    good = (w <= cut[i]) & (s["comp"][i] != t["comp"][j])
                    i, j, w = i[good], j[good], w[good]
                    if len(i):
                        np.minimum.at(cut, i, w)
                        out.append((s["comp"][i], w, s["k"][i], t["k"][j]))
            return _least_edges(*(np.concatenate(v) for v in zip(*out, strict=True))) if out else None

        def least(r: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
            rows = _least_edges(r["comp"], r["w"], r["a"], r["b"])
            return {n: rows.column(n).to_numpy() for n in rows.schema.names}

        names = ["k", "x", "home", "away", "comp", "core", "least"]
        searched = meet_cells(cells, searches(cells, seeking.select(*names), F.col("least"), lone, "comp"), placed, ["k", "x", "comp", "core", "least"], ["k", "x", "comp", "core"], lightest, schema, "lightest", least)
        every = bound.unionByName(searched.select("comp", _edge())).filter(F.col("comp") != main).groupBy("comp").agg(F.min("edge").alias("edge"))
        chosen = written(every.select("edge.*").distinct().select("a", "b", "w"), "tree-edges")
        tree = chosen if tree is None else tree.unionByName(chosen)
        across = chosen.join(ends.toDF("a", "x"), "a").join(ends.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
        merged = components(across).toDF("comp", "to")
        comp = ends.join(merged, "comp", "left").select("k", F.coalesce("to", "comp").alias("comp"))


# the condensed hierarchy


def _solved(least: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        """The merges of one problem in order of weight. A node of fewer rows than `least` is no cluster."""
        problem, out = frame["problem"].iloc[0], []
        root: dict[str, str] = {}
        size: dict[str, int] = {}
        cluster: dict[str, str | None] = {}
        small: dict[str, list[str]] = {}
        made = 0

        def new() -> str:
            nonlocal made
            made += 1
            return f"c:{problem}/{made}"

        def add(node: str, rows: int) -> None:
            if node in root:
                return
            root[node], size[node], small[node], cluster[node] = node, rows, [], None
            if rows < least:
                small[node] = [node]
            elif node.startswith("L"):
                cluster[node] = f"top:{node}"
            else:
                cluster[node] = new()
                out.append(("fall", node, cluster[node], 1 / LEAST, rows))

        def find(node: str) -> str:
            while root[node] != node:
                root[node] = root[root[node]]
                node = root[node]
            return node

        rows = frame.sort_values("ord")
        own = dict(zip(rows["u"], rows["size_u"], strict=True)) | dict(zip(rows["v"], rows["size_v"], strict=True))
        for u, v, w, nu, nv in zip(rows["u"], rows["v"], rows["w"], rows["size_u"], rows["size_v"], strict=True):
            add(u, nu)
            add(v, nv)
            a, b = find(u), find(v)
            if size[a] < size[b]:
                a, b = b, a
            density, both = 1 / max(w, LEAST), size[a] + size[b]
            if cluster[a] and cluster[b]:
                parent = new()
                out += [("split", cluster[x], parent, density, size[x]) for x in (a, b)]
                cluster[a] = parent
            elif cluster[a] or both >= least:
                cluster[a] = cluster[a] or new()
                out += [("fall", x, cluster[a], density, own[x]) for x in small[a] + small[b]]
                small[a] = []
            else:
                small[a] += small[b]
            root[b], size[a] = a, both
        top = find(rows["u"].iloc[0])
        out.append(("root", problem, cluster[top], 0.0, size[top]))
        return pd.DataFrame(out, columns=["kind", "x", "y", "density", "size"])

    return run


def condensed_tree(tree: DataFrame, points: DataFrame, least: int, limit: int = 20_000) -> tuple[DataFrame, DataFrame]:
    """(cluster, parent, born, stability) and (k, cluster): clusters of at least `least` rows, and where each point leaves them.

    tree: a, b, w; points: k, members. A problem of more than `limit` edges is halved at its median edge.
    """
    edges = positions(tree, ["w", "a", "b"], "ord")
    name = lambda c: F.concat(F.lit("p"), F.col(c).cast("string"))
    open_ = written(edges.select(F.lit("top").alias("problem"), name("a").alias("u"), name("b").alias("v"), "ord", "w"), "problems")
    sizes, members = points.select(name("k").alias("node"), F.col("members").alias("size")), []
    while True:
        big = open_.groupBy("problem").agg(F.count("*").alias("n"), F.percentile_approx("ord", 0.5, 1000).alias("mid")).filter(F.col("n") > limit).select("problem", "mid")
        if big.isEmpty():
            break
        cut = written(open_.join(big, "problem", "left").withColumn("low", F.coalesce(F.col("ord") <= F.col("mid"), F.lit(False))), "halved")
        parts = components(cut.filter("low").select(F.col("u").alias("a"), F.col("v").alias("b")))
        whole = written(parts.select("node", F.concat(F.lit(f"L{len(members)}:"), "component").alias("whole")), "wholes")
        members.append(whole)
        grown = whole.join(sizes, "node").groupBy("whole").agg(F.sum("size").alias("size")).withColumnRenamed("whole", "node")
        sizes = written(sizes.unionByName(grown), "sizes")
        named = cut.join(whole.toDF("u", "wu"), "u", "left").join(whole.toDF("v", "wv"), "v", "left")
        up = [F.when(F.col("low"), F.col(c)).otherwise(F.coalesce(f"w{c}", c)).alias(c) for c in "uv"]
        open_ = written(named.select(F.when(F.col("low"), F.col("wu")).otherwise(F.col("problem")).alias("problem"), *up, "ord", "w"), "problems")
    sized = open_.join(sizes.toDF("u", "size_u"), "u").join(sizes.toDF("v", "size_v"), "v")
    events = written(sized.groupBy("problem").applyInPandas(_solved(least), "kind string, x string, y string, density double, size long"), "events")
    alias = events.filter("kind = 'root' and x <> 'top'").select(F.concat(F.lit("top:"), "x").alias("name"), F.col("y").alias("is"))
    for _ in members:
        alias = written(alias.join(alias.select(F.col("name").alias("is"), F.col("is").alias("next")), "is", "left").select("name", F.coalesce("next", "is").alias("is")), "aliases")
    called = lambda df, c: df.join(alias.select(F.col("name").alias(c), "is"), c, "left").withColumn(c, F.coalesce("is", c)).drop("is")
    falls = written(called(events.filter("kind = 'fall'").select(F.col("x").alias("node"), F.col("y").alias("cluster"), "density", "size"), "cluster"), "falls")
    splits = written(called(events.filter("kind = 'split'").select(F.col("x").alias("cluster"), F.col("y").alias("parent"), "density", "size"), "cluster"), "splits")
    roots = called(events.filter("kind = 'root' and x = 'top'").select(F.col("y").alias("cluster")).filter("cluster is not null"), "cluster")
    left = falls.select("cluster", "density", "size").unionByName(splits.select(F.col("parent").alias("cluster"), "density", "size"))
    left = left.groupBy("cluster").agg(F.sum(F.col("density") * F.col("size")).alias("mass"), F.sum("size").alias("rows"))
    born = splits.select("cluster", "parent", F.col("density").alias("born")).unionByName(roots.select("cluster", F.lit(None).cast("string").alias("parent"), F.lit(0.0).alias("born")))
    clusters = born.join(left, "cluster").select("cluster", "parent", "born", (F.col("mass") - F.col("born") * F.col("rows")).alias("stability"))
    places = falls.select("node", "cluster")
    for whole in reversed(members):
        places = places.unionByName(whole.join(places.withColumnRenamed("node", "whole"), "whole").select("node", "cluster"))
    own = places.filter("node like 'p%'").select(F.substring("node", 2, 30).cast("long").alias("k"), "cluster")
    return written(clusters, "clusters"), written(own, "places")


def _selected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rule of most_stable for a whole hierarchy, given as cluster, parent, stability: leaves first, then back."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    cluster, parent, stability = (pa.Table.from_batches(held).column(c).to_pylist() for c in range(3))
    above, own = dict(zip(cluster, parent, strict=True)), dict(zip(cluster, stability, strict=True))
    open_ = dict.fromkeys(cluster, 0)
    for p in parent:
        if p is not None:
            open_[p] += 1
    under, inner, chosen, order = dict.fromkeys(cluster, 0.0), {c for c, n in open_.items() if n}, set(), [c for c, n in open_.items() if not n]
    for c in order:  # grows by the parents whose children are all settled
        p = above[c]
        wins = p is not None and (c not in inner or own[c] >= under[c])
        if wins:
            chosen.add(c)
        if p is not None:
            under[p] += own[c] if wins else under[c]
            open_[p] -= 1
            if not open_[p]:
                order.append(p)
    label: dict[str, str | None] = {}
    for c in reversed(order):
        label[c] = (label[above[c]] if above[c] is not None else None) or (c if c in chosen else None)
    yield pa.RecordBatch.from_arrays([pa.array(order, pa.string()), pa.array([label[c] for c in order], pa.string())], ["cluster", "label"])


def most_stable(clusters: DataFrame, few: int = 500_000) -> DataFrame:
    """cluster, label: the selected cluster that each cluster is in (null: none), by excess of mass; the root is never selected.

    A cluster is selected if it is at least as stable as the best of those under it; settled level by level, upwards, then downwards.
    Up to `few` clusters are settled by one task, as a hierarchy may have as many levels as clusters.
    """
    if clusters.count() <= few:
        return written(clusters.select("cluster", "parent", "stability").coalesce(1).mapInArrow(_selected, "cluster string, label string"), "labels")
    inner = clusters.filter("parent is not null").groupBy(F.col("parent").alias("cluster")).agg(F.count("*").alias("children"))
    rows = written(clusters.join(inner, "cluster", "left").select("cluster", "parent", "stability", F.coalesce("children", F.lit(0)).alias("children")), "tree")
    best = written(rows.filter("children = 0").select("cluster", "parent", F.col("stability").alias("best"), F.col("parent").isNotNull().alias("chosen")), "best")
    while True:
        under = best.filter("parent is not null").groupBy(F.col("parent").alias("cluster")).agg(F.sum("best").alias("under"), F.count("*").alias("ready"))
        ready = rows.join(under, "cluster").filter("ready = children").join(best.select("cluster"), "cluster", "left_anti")
        wins = (F.col("stability") >= F.col("under")) & F.col("parent").isNotNull()
        more = written(ready.select("cluster", "parent", F.when(wins, F.col("stability")).otherwise(F.col("under")).alias("best"), wins.alias("chosen")), "best")
        if more.isEmpty():
            break
        best = written(best.unionByName(more), "best")
    level = best.filter("parent is null").select("cluster", F.lit(None).cast("string").alias("label"))
    labels = level = written(level, "labels")
    while True:
        down = best.join(level.select(F.col("cluster").alias("parent"), "label"), "parent")
        level = written(down.select("cluster", F.coalesce("label", F.when(F.col("chosen"), F.col("cluster"))).alias("label")), "labels")
        if level.isEmpty():
            return labels
        labels = labels.unionByName(level)


def hdbscan(df: DataFrame, key: str, vector: str, min_cluster_size: int = 10, min_samples: int = 2, standardize: bool = True, pivots: int | None = None, limit: int = 20_000) -> DataFrame:
    """key, cluster: clusters of at least min_cluster_size rows by excess of mass, numbered by their least keys; -1 is noise.

    A point's core distance is that to its min_samples-th nearest other row. Rows without a sound vector are noise.
    """
    cells = _cells(df, key, vector, standardize, pivots)
    if not len(cells.pivots):
        return df.select(F.col(key).cast("long").alias(key), F.lit(-1).cast("long").alias("cluster"))
    near = nearest(cells, max(min_samples, 8))
    members = cells.points.select(F.col("k").alias("b"), F.col("members").alias("m"))
    counted = near.join(members, "b").groupBy("a").agg(F.array_sort(F.collect_list(F.struct("distance", "b", "m"))).alias("n"))
    least = cells.points.join(counted.withColumnRenamed("a", "k"), "k", "left")
    # the first neighbour with which `min_samples` other rows are reached
    start = F.struct((F.col("members") - 1).cast("long").alias("have"), F.lit(0.0).cast("double").alias("core"))
    step = lambda s, n: F.when(s["have"] >= min_samples, s).otherwise(F.struct((s["have"] + n["m"]).alias("have"), n["distance"].alias("core")))
    reached = F.aggregate(F.coalesce("n", F.array().cast("array<struct<distance:double,b:bigint,m:bigint>>")), start, step)["core"]
    full = F.size("n") >= max(min_samples, 8)
    cores = least.select("k", reached.alias("core"), F.when(full, F.element_at("n", -1)["distance"]).otherwise(F.lit(float("inf"))).alias("reach"))
    tree = reachability_tree(cells, written(cores, "core-distances"), near)
    clusters, places = condensed_tree(tree, cells.points.select("k", "members"), min_cluster_size, limit)
    labelled = places.join(most_stable(clusters), "cluster").filter("label is not null").select("k", "label")
    named = cells.points.select("k", "x").join(labelled, "k")
    numbers = positions(named.groupBy("label").agg(F.min("k").alias("least")), ["least"], "cluster").select("label", "cluster")
    return _spread_out(df, key, vector, standardize, named.join(numbers, "label"), ["cluster"], [F.lit(-1).cast("long")])
