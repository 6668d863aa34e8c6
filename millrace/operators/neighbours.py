"""Exact joins of vectors by distance: pivots, cells and the triangle inequality, so that few cells meet.

Every point's home is the cell of its nearest pivot. A point meets another cell only if a point within its radius may live there:
half the difference of its distances to both pivots, and its distance to the pivot less the cell's own radius, must not exceed it.
Cells are put together in about 8 tiles of at most 65,536 points, and a tile meets a tile in one task, so a point is shuffled once a
tile, not once a cell. Inside, blocks of searching points meet the cells that one of them needs: a product in single precision tells
of whole blocks which pairs may be near, with a bound of its rounding, and those are measured exactly. What they give is reduced in
the task, and there is no row for a pair that isn't wanted. Where cells exclude little (many dimensions)
the arithmetic grows with the square of the points; rows shuffled and memory don't, up to half a million points, and memory never does.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.rounds import written

#: Points that search at once, and how many of a tile they meet at once.
BLOCK, WIDE = 256, 4096
#: Points of a tile, and rows or pairs that are held at once.
TILE, AREA = 1 << 16, 1 << 20


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equally long vectors as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of a and b, by one matrix product; near ones may be off by rounding."""
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0.0))


def exact_distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of rows that stand beside each other, as a sum of squares of differences."""
    return np.sqrt(((a - b) ** 2).sum(axis=1))


def half_squares(s: dict[str, np.ndarray], t: dict[str, np.ndarray]) -> tuple[np.ndarray, float]:
    """Half the squared distances of all points of s and t, turned negative, by one product; and how far they may be off by rounding."""
    return s["f"] @ t["f"].T, (s["f"].shape[1] + 8) * 2 * float(np.finfo(s["f"].dtype).eps) * (s["long"] + t["long"]) + 1e-30


def lifted(x: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Points as factors of `half_squares`, for the searching and the other side, and their greatest squared length from the centre.

    Single precision if no square overflows, else double.
    """
    moved = x - centre
    squares = (moved * moved).sum(axis=1)
    longest = float(squares[np.isfinite(squares)].max(initial=0.0))
    kind = np.float32 if longest < 1e30 else np.float64
    one, half = np.ones((len(x), 1)), squares[:, None] / 2
    return np.hstack([moved, -half, one]).astype(kind), np.hstack([moved, one, -half]).astype(kind), longest


def near_pairs(s: dict[str, np.ndarray], t: dict[str, np.ndarray], radius: np.ndarray | float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row, column and exact distance of pairs, all those within the radius (one, or one a row of s) among them; some thousands at once."""
    rough, off = half_squares(s, t)
    with np.errstate(over="ignore"):
        least = np.asarray(-0.5 * np.square(np.asarray(radius, np.float64)) - off).astype(rough.dtype)
    least = np.nextafter(least, np.array(-np.inf, rough.dtype))
    at = np.flatnonzero(rough >= (least[:, None] if least.ndim else least))
    for lo in range(0, len(at), AREA // 16):
        i, j = np.divmod(at[lo : lo + AREA // 16], rough.shape[1])
        yield i, j, exact_distance(s["x"][i], t["x"][j])


class Cells(NamedTuple):
    """points: k, x, members and further columns, with home (cell) and away (distance to its pivot); pivots, radii and points of the cells."""

    points: DataFrame
    pivots: np.ndarray
    pivot_keys: np.ndarray
    radii: np.ndarray
    sizes: np.ndarray


class Tiles(NamedTuple):
    """Cells in a row that make a tile: starts (and the end), and the chunks of bounded size that each tile's points are dealt to."""

    starts: np.ndarray
    chunks: np.ndarray

    def chunk(self, home: np.ndarray, key: np.ndarray) -> np.ndarray:
        """The chunk of points, by their tile and a hash of their key."""
        tile = np.searchsorted(self.starts, home, side="right") - 1
        mixed = key.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
        return self.chunks[tile] + (mixed % np.diff(self.chunks)[tile].astype(np.uint64)).astype(np.int64)


def tiles(cells: Cells, times: int = 1) -> Tiles:
    """About 8 tiles of equal numbers of points; more, if they would have over TILE. Great cells, and `times` as many points, make chunks."""
    room = min(TILE, max(BLOCK, -(-int(cells.sizes.sum()) // 8)))
    number = (np.cumsum(cells.sizes) - cells.sizes) // room
    starts = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
    parts = -(-np.add.reduceat(cells.sizes, starts) * times // (2 * room))
    return Tiles(np.append(starts, len(cells.sizes)), np.append(0, np.cumsum(np.maximum(parts, 1))))


def distinct_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """k (least key), x, members: equal vectors are one point. Null vectors and those with null entries are left out."""
    x = F.transform(vector, lambda v: v.cast("double") + F.lit(0.0))
    sound = F.col(vector).isNotNull() & F.forall(F.col(vector), lambda v: v.isNotNull() & ~F.isnan(v.cast("double")))
    return df.filter(sound).select(F.col(key).alias("k"), x.alias("x")).groupBy("x").agg(F.min("k").alias("k"), F.count("*").alias("members")).select("k", "x", "members")


def deal_cells(points: DataFrame, pivots: int | None = None, seed: int = 7) -> Cells:
    """Homes of all points. pivots: how many (a point in 200 by default, at most 1024), drawn by a hash of the key."""
    n = points.count()
    pivots = pivots or max(1, min(1024, n // 200 + 8))
    drawn = points.select("k", "x").orderBy(F.xxhash64(F.lit(seed), "k"), "k").limit(pivots).collect()  # a bounded sample
    keys = np.array([r["k"] for r in drawn], np.int64)
    where = np.array([r["x"] for r in drawn], np.float64).reshape(len(drawn), -1 if drawn else 0)
    shipped = points.sparkSession.sparkContext.broadcast(where)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                away = distances(matrix(batch.column(batch.schema.get_field_index("x"))), shipped.value)
                home = away.argmin(axis=1)
                columns = [*batch.columns, pa.array(home.astype(np.int32)), pa.array(away[np.arange(len(home)), home])]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "home", "away"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema.fields)
    homed = written(points.mapInArrow(run, f"{kinds}, home int, away double"), "homes")
    radii, sizes = np.zeros(len(drawn)), np.zeros(len(drawn), np.int64)
    for r in homed.groupBy("home").agg(F.max("away").alias("radius"), F.count("*").alias("n")).collect():  # a row a pivot
        radii[r["home"]], sizes[r["home"]] = r["radius"], r["n"]
    return Cells(homed, where, keys, radii * (1 + 1e-9) + 1e-9, sizes)


def rehomed(points: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Points with home and away by these pivots."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                away = distances(matrix(batch.column(batch.schema.get_field_index("x"))), pivots)
                home = away.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home.astype(np.int32)), pa.array(away[np.arange(len(home)), home])], [*batch.schema.names, "home", "away"])

    return points.mapInArrow(run, f"{kinds}, home int, away double")


def searches(cells: Cells, points: DataFrame, radius: Column, skip: np.ndarray | None = None, group: str | None = None, place: str | None = None, times: int = 1) -> DataFrame:
    """points (columns of cells.points and more) with a row for each chunk of a tile in which something may lie within the radius.

    s and t are the point's own chunk and that of the tile, wanted has a bit for each cell of the tile. place: only the own tile, the
    others, the own and later ones, or later ones. skip: a group a cell, or -1; points of the same group don't visit such a cell.
    times: how many times as many as the cells' points these may be.
    """
    goes = {None: lambda tile, own: own >= 0, "own": np.equal, "others": np.not_equal, "from": np.greater_equal, "later": np.greater}[place]
    shipped = points.sparkSession.sparkContext.broadcast((cells.pivots, cells.radii, skip, tiles(cells), tiles(cells, times)))
    wide = points.withColumn("_radius", radius.cast("double"))
    names = points.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, radii, skipped, live, seek = shipped.value
        for batch in batches:
            if not batch.num_rows:
                continue
            column = lambda c, batch=batch: batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False)
            away = distances(matrix(batch.column(batch.schema.get_field_index("x"))), pivots)
            own, r = column("home"), column("_radius")[:, None]
            slack = r + 1e-6 * (1 + np.where(np.isfinite(r), r, 0)) + 1e-7 * away  # for rounding; pairs are checked exactly
            may = (away - column("away")[:, None] <= 2 * slack) & (away - radii <= slack)
            if skipped is not None:
                may &= skipped != column(group)[:, None]
            chunk, place_of = seek.chunk(own, column("k")), np.searchsorted(live.starts, own, side="right") - 1
            for tile, (low, high) in enumerate(zip(live.starts[:-1], live.starts[1:], strict=True)):
                rows = np.flatnonzero(may[:, low:high].any(axis=1) & goes(tile, place_of))
                bits = np.packbits(may[rows, low:high], axis=1)
                for t in range(live.chunks[tile], live.chunks[tile + 1]):
                    for lo in range(0, len(rows), 4096):
                        part = rows[lo : lo + 4096]
                        taken = batch.take(pa.array(part))
                        wanted = pa.array([b.tobytes() for b in bits[lo : lo + 4096]], pa.binary())
                        yield pa.RecordBatch.from_arrays([*(taken.column(i) for i in range(len(names))), pa.array(chunk[part]), pa.array(np.full(len(part), t)), wanted], [*names, "s", "t", "wanted"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema.fields)
    return wide.select(*names, "_radius").mapInArrow(run, f"{kinds}, s long, t long, wanted binary")


Pair = Callable[[dict[str, np.ndarray], dict[str, np.ndarray]], pa.RecordBatch | None]
Fold = Callable[[dict[str, np.ndarray]], dict[str, np.ndarray]]
_KINDS = {"long": pa.int64(), "double": pa.float64(), "string": pa.string()}


def _spans(begins: np.ndarray, need: np.ndarray) -> Iterator[slice | np.ndarray]:
    """The rows of cells (sorted by cell, cell c from begins[c] on) in parts of about WIDE: slices of long runs, and short runs together."""
    low, high = begins[need], begins[need + 1]
    new = np.flatnonzero(low[1:] != high[:-1]) + 1
    held, size = [], 0
    for a, b in zip(low[np.append(0, new)].tolist(), high[np.append(new - 1, len(high) - 1)].tolist(), strict=True):
        while b - a >= WIDE:
            yield slice(a, a + WIDE)
            a += WIDE
        if b > a:
            held.append(np.arange(a, b))
            size += b - a
        if size >= WIDE:
            yield np.concatenate(held)
            held, size = [], 0
    if len(held) == 1:
        yield slice(int(held[0][0]), int(held[0][-1]) + 1)
    elif held:
        yield np.concatenate(held)


def meet_cells(cells: Cells, seeking: DataFrame, resident: DataFrame, seek_columns: list[str], live_columns: list[str], found: Pair, schema: str, name: str, fold: Fold | None = None, times: int = 1, last: Callable[[dict[str, np.ndarray]], pa.RecordBatch | None] | None = None) -> DataFrame:
    """What `found` makes of blocks of searching points and the points of the cells that one of them needs; a written table.

    seeking: what `searches` gives, with the same `times`; resident: points with their home. found gets a dict of arrays a side and
    returns rows of the schema, or None; a pair comes up once at most. A side also has f and long, for `half_squares`, and at, its
    places in the task; the searching one is the same dict for all it meets, and what found keeps there `last` makes rows of. Its
    "task" is a dict that lasts as long as the task, and has all points of it under s and t. fold reduces the rows of a task: what it
    gives, for rows of several tasks, must be what the caller's own grouping of them reads.
    """
    centre = cells.pivots.mean(axis=0) if len(cells.pivots) else np.zeros(0)
    sent = seeking.sparkSession.sparkContext.broadcast((tiles(cells), np.where(np.isfinite(centre), centre, 0.0)))
    fields = [f.split() for f in schema.split(", ")]
    kind = pa.schema([(n, _KINDS[t]) for n, t in fields])
    own = list(dict.fromkeys([*live_columns, "home"]))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in resident.select(*own).schema.fields)
    everyone = int(tiles(cells, times).chunks[-1])

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                chunk = sent.value[0].chunk(batch.column(own.index("home")).to_numpy(), batch.column(own.index("k")).to_numpy())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chunk)], [*own, "t"])

    def arrays(table: pa.Table, names: list[str]) -> dict[str, np.ndarray]:
        whole = table.select(names).combine_chunks()
        return {n: matrix(whole.column(n).combine_chunks()) if pa.types.is_list(whole.schema.field(n).type) else whole.column(n).to_numpy() for n in names}

    def folded(held: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        if not fold or not held:
            return held
        table = pa.Table.from_batches(held)
        rows = fold({n: table.column(n).to_numpy() for n in table.column_names})
        return [pa.RecordBatch.from_arrays([pa.array(rows[n]) for n in table.column_names], table.column_names)]

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        held: list[pa.RecordBatch] = []
        if left.num_rows and right.num_rows:
            tiled, centre = sent.value
            tile = int(np.searchsorted(tiled.chunks, key[1].as_py(), side="right")) - 1
            cell = np.arange(tiled.starts[tile], tiled.starts[tile + 1] + 1)
            t = arrays(right, own)
            t = {n: v[np.argsort(t["home"], kind="stable")] for n, v in t.items()}
            begins = np.searchsorted(t["home"], cell)
            s = arrays(left, list(dict.fromkeys([*seek_columns, "home"])))
            order = np.argsort(s["home"], kind="stable")
            s = {n: v[order] for n, v in s.items()}
            wanted = np.frombuffer(b"".join(left.column("wanted").to_pylist()), np.uint8).reshape(left.num_rows, -1)[order]
            wanted = np.unpackbits(wanted, axis=1)[:, : len(cell) - 1].astype(bool)
            wanted &= np.diff(begins) > 0
            (s["f"], _, long), (_, t["f"], wide) = lifted(s["x"], centre), lifted(t["x"], centre)
            if s["f"].dtype != t["f"].dtype:
                s["f"], t["f"] = s["f"].astype(np.float64), t["f"].astype(np.float64)
            task = {"s": s, "t": t}
            rows = 0
            for at in range(0, len(order), BLOCK):
                part = slice(at, at + BLOCK)
                need = np.flatnonzero(wanted[part].any(axis=0))
                if not len(need):
                    continue
                mine = {n: v[part] for n, v in s.items()} | {"at": part, "long": long, "task": task}
                out = []
                for live in _spans(begins, need):
                    out.append(found(mine, {n: v[live] for n, v in t.items()} | {"at": live, "long": wide}))
                out.append(last(mine) if last else None)
                held += [b for b in out if b is not None and b.num_rows]
                rows += sum(b.num_rows for b in out if b is not None)
                if fold and rows > AREA:
                    held = folded(held)
                    rows = held[0].num_rows // 2  # what can't be reduced is not folded again at once
            held = folded(held)
        return pa.Table.from_batches(held).cast(kind) if held else kind.empty_table()

    spare = [c for c in seek_columns if c != "home"]
    left = seeking.select("s", "t", *spare, "home", "wanted")
    right = resident.select(*own).mapInArrow(dealt, f"{kinds}, t long").withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(everyone - 1)))).withColumn("s", F.col("s").cast("long"))
    tasks = min(everyone * int(tiles(cells).chunks[-1]), 4 * seeking.sparkSession.sparkContext.defaultParallelism)
    left, right = (side.repartition(tasks, "s", "t") for side in (left, right))
    return written(left.groupBy("s", "t").cogroup(right.groupBy("s", "t")).applyInArrow(run, ", ".join(f"{n} {t}" for n, t in fields)), name)


def pairs_within(cells: Cells, eps: float) -> DataFrame:
    """a, b, distance of all pairs of points at most eps apart, a < b."""

    def near(s: dict[str, np.ndarray], t: dict[str, np.ndarray]) -> pa.RecordBatch | None:
        out = []
        for i, j, d in near_pairs(s, t, eps):
            a, b, good = s["k"][i], t["k"][j], d <= eps
            good &= a < b
            out.append(pa.RecordBatch.from_arrays([pa.array(v[good]) for v in (a, b, d)], ["a", "b", "distance"]))
        return pa.Table.from_batches(out).combine_chunks().to_batches()[0] if sum(b.num_rows for b in out) else None

    seeking = searches(cells, cells.points, F.lit(eps))
    return meet_cells(cells, seeking, cells.points, ["k", "x"], ["k", "x"], near, "a long, b long, distance double", "pairs")


def _nearest(cells: Cells, seeking: DataFrame, k: int, times: int = 1) -> DataFrame:
    """a, b, distance: of each chunk that a point meets, the k nearest others within its bound."""

    def best(s: dict[str, np.ndarray], t: dict[str, np.ndarray]) -> None:
        if "cut" not in s:
            s["cut"] = s["bound"].copy()
            s["near"] = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        wide = np.flatnonzero(~np.isfinite(s["cut"]))
        if len(wide):  # k and one more (it may be the point itself) of a few points are a bound
            few = {"f": t["f"][: max(BLOCK, 64 * (k + 1))], "long": t["long"]}
            rough, off = half_squares({"f": s["f"][wide], "long": s["long"]}, few)
            if rough.shape[1] > k:
                high = 2 * (off - np.partition(rough, rough.shape[1] - k - 1, axis=1)[:, rough.shape[1] - k - 1].astype(np.float64))
                s["cut"][wide] = np.sqrt(np.maximum(high, 0.0)) * (1 + 1e-9)
        new = [s["near"]]
        for i, j, d in near_pairs(s, t, s["cut"]):
            good = (d <= s["cut"][i]) & (s["k"][i] != t["k"][j])
            new.append([i[good], t["k"][j[good]], d[good]])
        if sum(len(n[0]) for n in new[1:]):
            i, b, d = (np.concatenate(v) for v in zip(*new, strict=True))
            order = np.lexsort((b, d, i))
            i, b, d = i[order], b[order], d[order]
            first = np.searchsorted(i, np.arange(len(s["k"]) + 1))
            keep = np.arange(len(i)) - first[i] < k
            full = np.flatnonzero(np.diff(first) >= k)
            s["cut"][full] = np.minimum(s["cut"][full], d[first[full] + k - 1])
            s["near"] = [i[keep], b[keep], d[keep]]

    def last(s: dict[str, np.ndarray]) -> pa.RecordBatch:
        i, b, d = s["near"]
        return pa.RecordBatch.from_arrays([pa.array(v) for v in (s["k"][i], b, d)], ["a", "b", "distance"])

    return meet_cells(cells, seeking, cells.points, ["k", "x", "bound"], ["k", "x"], best, "a long, b long, distance double", "nearest", times=times, last=last)


def nearest(cells: Cells, k: int) -> DataFrame:
    """a, b, distance, rank (from 1): the k nearest other points of each point, ties by key.

    The own tile gives a radius that holds k points; only cells that may have nearer ones are searched then.
    """
    open_ = cells.points.withColumn("bound", F.lit(float("inf")))
    own = _nearest(cells, searches(cells, open_, F.col("bound"), place="own"), k)
    bound = own.groupBy("a").agg(F.when(F.count("*") >= k, F.array_sort(F.collect_list("distance"))[k - 1]).alias("bound"))
    placed = cells.points.join(bound.withColumnRenamed("a", "k"), "k", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
    placed = written(placed, "bounds")
    others = _nearest(cells, searches(cells, placed, F.col("bound"), place="others"), k)
    every = own.unionByName(others).groupBy("a").agg(F.slice(F.array_sort(F.collect_set(F.struct("distance", "b"))), 1, k).alias("near"))
    rows = every.select("a", F.posexplode("near").alias("at", "n"))
    return written(rows.select("a", F.col("n.b").alias("b"), F.col("n.distance").alias("distance"), (F.col("at") + 1).alias("rank")), "neighbours")
