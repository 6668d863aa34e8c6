"""Merkle manifest of a table: one tree of digests a group, their subroots under one root, and a proof for every row.

A tree's nodes are logged in the order in which they are completed, so that a node comes after all under it. The place of a node in
such a log has a closed form (`postorder`): it needs the number of leaves and no search. Builders are aligned: each takes 512
consecutive leaves, which are a whole subtree, and writes its stretch of the log as one row; the roots of these stretches are the leaves
of the next tier of builders, until one is left. Proofs are read back from the stretches: the siblings of each step are addressed by
their closed-form places, from the last tier down, so a row meets its own stretch once and gets all that lies above from one short path.

Leaves are numbered in their group by one range partitioning; numbers come from the counts of the written parts, so a group of any size
is spread over all tasks, and no task sees more than 512 leaves of a tree at a time.

Defined results: a null field is `-` and so differs from an empty one; a null group is a group of its own, before all others; null keys
come before others; of rows with one key the digests decide, and equal rows are equal leaves with places of their own; a null key is
never tampered with; an empty table has no root and gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm._shared import written
from millrace.llm.kd_shards import CRC_TABLE_SQL, crc32_sql

FAN, LEVELS = 8, 3  # digests a node; levels a builder
BLOCK = FAN**LEVELS


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height_of(leaves: int) -> int:
    """Levels above the leaves of a whole tree: runs of FAN become one node until one node is left."""
    height, nodes = 0, leaves
    while nodes > 1:
        height, nodes = height + 1, -(-nodes // FAN)
    return height


def postorder(level: int, index: np.ndarray | int, leaves: int, height: int) -> np.ndarray | int:
    """The place in the log of a node, 0 being the first leaf's: the nodes up to its last leaf, less those completed after it.

    Subtrees up to that leaf have ceil(end / FAN^m) nodes on each level m up to its own; above, only nodes that end before that
    leaf have been logged.
    """
    end = np.minimum((np.asarray(index) + 1) * FAN**level, leaves)
    under = sum((-(-end // FAN**m) for m in range(level + 1)), np.zeros_like(end))
    return under + sum(((end - 1) // FAN**m for m in range(level + 1, height + 1)), np.zeros_like(end)) - 1


def append_log(leaves: list[str], height: int) -> list[str]:
    """All nodes of a tree of hex digests in the order of their completion; the last is the root."""
    log: list[str] = []
    runs: list[list[str]] = [[] for _ in range(height + 1)]

    def add(level: int, digest: str) -> None:
        log.append(digest)
        runs[level].append(digest)
        if level < height and len(runs[level]) == FAN:
            close(level)

    def close(level: int) -> None:
        run, runs[level] = runs[level], []
        add(level + 1, sha256("".join(run)))

    for leaf in leaves:
        add(0, leaf)
    for level in range(height):
        if runs[level]:
            close(level)
    return log


class Stretch:
    """A builder's part of the log, to be read by places."""

    def __init__(self, nodes: bytes, leaves: int, height: int) -> None:
        self.hex, self.leaves, self.height = nodes.hex(), leaves, height
        self.place = [postorder(level, np.arange(-(-leaves // FAN**level)), leaves, height).tolist() for level in range(height + 1)]
        self.runs: dict[tuple[int, int], str] = {}

    def node(self, level: int, index: int) -> str:
        at = 64 * self.place[level][index]
        return self.hex[at : at + 64]

    def steps(self, leaf: int) -> list[tuple[int, str]]:
        """For each level from the leaf up: its place in its run, and the siblings' digests."""
        found = []
        for level in range(self.height):
            index = leaf // FAN**level
            run, place = divmod(index, FAN)
            if (level, run) not in self.runs:
                self.runs[level, run] = "".join(self.node(level, i) for i in range(run * FAN, min(run * FAN + FAN, len(self.place[level]))))
            digests = self.runs[level, run]
            found.append((place, digests[: 64 * place] + digests[64 * place + 64 :]))
        return found


def fold(digest: str, steps: list[tuple[int, str]]) -> str:
    """The root that a leaf's digest gives with the siblings of its steps."""
    for place, others in steps:
        digest = sha256(others[: 64 * place] + digest + others[64 * place :])
    return digest


def field_digest(fields: list[Column]) -> Column:
    """Hex sha256 of all fields: `-` for null, else byte count, `:` and the value as a string."""
    parts = [F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string"))) for c in fields]
    return F.sha2(F.concat(*parts), 256)


def numbered(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """df, written, with rank (0, 1, ... in its group, by order) and total (rows of the group). Order tells all rows apart."""
    dealt = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order).withColumn("_at", F.monotonically_increasing_id())
    kept = written(dealt.withColumn("_part", F.shiftright("_at", 33)), name)
    counts = kept.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))  # a row a part and group
    before = counts.withColumn("_before", F.sum("_n").over(Window.partitionBy(group).orderBy("_part")) - F.col("_n")).withColumn("total", F.sum("_n").over(Window.partitionBy(group)))
    placed = kept.join(before.drop("_n"), [group, "_part"])
    return placed.select(*df.columns, (F.col("_before") + F.col("_at") - F.col("_first")).cast("long").alias("rank"), F.col("total").cast("long").alias("total"))


def _built(table: pa.Table) -> pa.Table:
    table = table.sort_by("rank")
    total = table["total"][0].as_py()
    height = LEVELS if total > BLOCK else height_of(total)
    nodes = append_log([d.hex() for d in table["digest"].to_pylist()], height)
    row = {"tree": table["tree"][0].as_py(), "block": table["rank"][0].as_py() // BLOCK, "total": total, "leaves": table.num_rows, "height": height, "nodes": bytes.fromhex("".join(nodes)), "top": bytes.fromhex(nodes[-1])}
    return pa.Table.from_pylist([row], schema=pa.schema([("tree", pa.string()), ("block", pa.int64()), ("total", pa.int64()), ("leaves", pa.int32()), ("height", pa.int32()), ("nodes", pa.binary()), ("top", pa.binary())]))


def _block() -> Column:
    return F.floor(F.col("rank") / BLOCK).cast("long").alias("block")


def log_tiers(leaves: DataFrame) -> list[DataFrame]:
    """Stretches of the logs of all trees, a row each, tier by tier. leaves: tree, rank, total, digest (binary)."""
    rows, tiers = leaves.select("tree", "rank", "total", "digest"), []
    while True:
        built = rows.groupBy("tree", _block()).applyInArrow(_built, "tree string, block long, total long, leaves int, height int, nodes binary, top binary")
        tiers.append(written(built, "merkle-tier"))
        more = tiers[-1].filter(F.col("total") > BLOCK)
        if more.isEmpty():
            return tiers
        rows = more.select("tree", F.col("block").alias("rank"), F.ceil(F.col("total") / BLOCK).cast("long").alias("total"), F.col("top").alias("digest"))


def tree_roots(tiers: list[DataFrame]) -> DataFrame:
    """tree, root (binary): the last node of each tree's log."""
    tops = [t.filter(F.col("total") <= BLOCK).select("tree", F.col("top").alias("root")) for t in tiers]
    found = tops[0]
    for top in tops[1:]:
        found = found.unionByName(top)
    return found


_PATH = "array<struct<place:int,others:string>>"


def _children(stretches: pa.Table, above: pa.Table) -> pa.Table:
    """Of one stretch, the steps from each of its leaves up to the root of all."""
    row, path = stretches.to_pylist()[0], above["path"].to_pylist()[0]
    stretch = Stretch(row["nodes"], row["leaves"], row["height"])
    rows = [{"tree": row["tree"], "block": row["block"] * BLOCK + i, "path": [{"place": p, "others": o} for p, o in stretch.steps(i)] + path} for i in range(row["leaves"])]
    step = pa.struct([("place", pa.int32()), ("others", pa.string())])
    return pa.Table.from_pylist(rows, schema=pa.schema([("tree", pa.string()), ("block", pa.int64()), ("path", pa.list_(step))]))


def stretch_paths(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """tree, block, path: the steps from the top of each stretch of the first tier to the root of all. above: tree, path of the trees' roots."""
    paths = None
    for i, tier in reversed(list(enumerate(tiers))):
        own = tier.filter(F.col("total") <= BLOCK).select(F.col("tree").alias("tree"), F.col("block").alias("block")).join(above, "tree")
        paths = own if paths is None else own.unionByName(paths)
        if i:
            down = tier.groupBy("tree", "block").cogroup(paths.groupBy("tree", "block")).applyInArrow(_children, f"tree string, block long, path {_PATH}")
            paths = written(down, "merkle-paths")
    return paths


class Manifest(NamedTuple):
    """leaves: rows with tree, rank, total; tiers: the trees' logs; top: the log of the trees' roots; subroots: tree, place, digest."""

    leaves: DataFrame
    tiers: list[DataFrame]
    top: list[DataFrame]
    subroots: DataFrame
    root: str | None


def build_manifest(df: DataFrame, fields: list[str], group: str, key: str, tamper: tuple[str, Column, Column] | None = None) -> Manifest:
    """The logs of df's trees. tamper: a field, its value after tampering, and for which rows; kept with the leaves as `other`."""
    columns = [F.col(c) for c in fields]
    other = F.lit(None).cast("binary")
    if tamper:
        name, value, where = tamper
        other = F.when(where, F.unhex(field_digest([value if c == name else F.col(c) for c in fields])))
    tree = F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    leaves = df.select(F.col(key).alias("key"), tree.alias("tree"), F.unhex(field_digest(columns)).alias("digest"), other.alias("other"), F.monotonically_increasing_id().alias("row"))
    leaves = written(leaves, "merkle-leaves")
    ranked = written(numbered(leaves, "tree", ["key", "digest", "row"], "merkle-dealt").drop("row"), "merkle-ranked")
    tiers = log_tiers(ranked)
    roots = tree_roots(tiers).select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest"))
    subroots = written(numbered(roots, "tree", ["name"], "merkle-roots"), "merkle-subroots")
    top = log_tiers(subroots)
    root = tree_roots(top).select(F.hex("root").alias("root")).first()
    return Manifest(ranked, tiers, top, subroots, root["root"].lower() if root else None)


def manifest_proofs(manifest: Manifest) -> DataFrame:
    """key, leaf, subroot, root, proof (steps), folded_root: a row a leaf; folded_root is made of the tampered digest, where there is one."""
    empty = manifest.subroots.select("tree").distinct().withColumn("path", F.array().cast(_PATH))
    above = stretch_paths(manifest.top, empty)
    kind, root = manifest.leaves.schema["key"].dataType, manifest.root

    def top_paths(table: pa.Table, stretches: pa.Table) -> pa.Table:
        """Of one stretch of the trees' roots, the steps of each."""
        row = stretches.to_pylist()[0]
        stretch = Stretch(row["nodes"], row["leaves"], row["height"])
        rows = [{"tree": r["name"], "subroot": r["digest"].hex(), "path": [{"place": p, "others": o} for p, o in stretch.steps(r["rank"] % BLOCK)] + row["path"]} for r in table.to_pylist()]
        step = pa.struct([("place", pa.int32()), ("others", pa.string())])
        return pa.Table.from_pylist(rows, schema=pa.schema([("tree", pa.string()), ("subroot", pa.string()), ("path", pa.list_(step))]))

    first = manifest.top[0].select("tree", "block", "leaves", "height", "nodes").join(above, ["tree", "block"])
    trees = manifest.subroots.groupBy("tree", _block()).cogroup(first.groupBy("tree", "block")).applyInArrow(top_paths, f"tree string, subroot string, path {_PATH}")
    trees = written(trees, "merkle-trees")  # a row a tree
    paths = stretch_paths(manifest.tiers, trees.select("tree", "path"))
    stretches = manifest.tiers[0].select("tree", "block", "leaves", "height", "nodes").join(paths, ["tree", "block"]).join(trees.select("tree", "subroot"), "tree")
    key_type = pa.int64() if kind.simpleString() == "bigint" else pa.int32() if kind.simpleString() == "int" else pa.string()

    def extract(table: pa.Table, stretches: pa.Table) -> pa.Table:
        row = stretches.to_pylist()[0]
        stretch, path = Stretch(row["nodes"], row["leaves"], row["height"]), [(p["place"], p["others"]) for p in row["path"]]
        upper, height = "".join(o for _, o in path), height_of(table["total"][0].as_py())
        out: list[tuple] = []
        for key, rank, total, other in zip(table["key"].to_pylist(), table["rank"].to_pylist(), table["total"].to_pylist(), table["other"].to_pylist(), strict=True):
            steps, leaf = stretch.steps(rank % BLOCK), stretch.node(0, rank % BLOCK)
            folded = fold(other.hex() if other is not None else leaf, steps + path)
            proof = sha256("".join(o for _, o in steps) + upper)
            out.append((key, leaf, row["subroot"], root, proof, folded, folded == root, int(postorder(0, rank, total, height))))
        kinds = [key_type, *[pa.string()] * 5, pa.bool_(), pa.int64()]
        names = ["key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "log_place"]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    leaves = manifest.leaves.select("tree", "key", "rank", "total", "other")
    schema = f"key {kind.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, log_place long"
    return leaves.groupBy("tree", _block()).cogroup(stretches.groupBy("tree", "block")).applyInArrow(extract, schema)


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def document_manifest(df: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, log_place of documents, some of whose texts are put in lower case."""
    lowered = F.translate("text", _UPPER, _UPPER.lower())
    where = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return manifest_proofs(build_manifest(df, FIELDS, "lang", "doc_id", tamper=("text", lowered, where))).withColumnRenamed("key", "doc_id")


def oracle_sql(levels: int = 8, top_levels: int = 4) -> str:
    """The same rows in DuckDB, for trees of at most FAN^levels leaves and FAN^top_levels trees: each level groups the last one."""
    field = lambda c: f"coalesce(strlen({c}::varchar)::varchar || ':' || {c}::varchar, '-')"
    digest = lambda text: "sha256(" + " || ".join(field(text if c == "text" else c) for c in FIELDS) + ")"
    lowered = f"translate(text, '{_UPPER}', '{_UPPER.lower()}')"

    def tree(name: str, first: str, depth: int) -> str:
        """name0.. have the nodes of each level with the digests left and right of them in their runs; name_up has all steps of each leaf."""
        parts = [f"{name}0 as materialized ({first})"]
        for k in range(1, depth + 1):
            parts.append(f"{name}{k} as materialized (select t, i // {FAN} as i, sha256(string_agg(h, '' order by i)) as h from {name}{k - 1} where t in (select t from {name}{k - 1} group by t having count(*) > 1) group by t, i // {FAN})")
        for k in range(depth):
            side = lambda a, b: f"coalesce(string_agg(h, '') over (partition by t, i // {FAN} order by i rows between {a} and {b}), '')"
            parts.append(f"{name}_s{k} as materialized (select t, i, {side('unbounded preceding', '1 preceding')} as l, {side('1 following', 'unbounded following')} as r from {name}{k} where t in (select t from {name}{k} group by t having count(*) > 1))")
        tops = " union all ".join(f"select t, h from {name}{k} where t in (select t from {name}{k} group by t having count(*) = 1)" for k in range(depth + 1))
        parts.append(f"{name}_top as materialized ({tops})")
        return ",\n".join(parts)

    def folds(name: str, start: str, t: str, i: str, depth: int, out: str) -> str:
        parts = [f"{out}0 as ({start})"]
        for k in range(depth):
            parts.append(f"{out}{k + 1} as materialized (select d.* exclude (proof, f), proof || coalesce(l || r, '') as proof, case when l is null then f else sha256(l || f || r) end as f from {out}{k} d left join {name}_s{k} s on s.t = d.{t} and s.i = d.{i} // {FAN**k})")
        return ",\n".join(parts)

    return f"""with {CRC_TABLE_SQL},
d as materialized (select doc_id, coalesce('=' || lang, '') as t, {digest('text')} as leaf, case when {crc32_sql("encode(doc_id::varchar)")} % 3 = 0 then {digest(lowered)} end as other from documents, crc_table),
n as materialized (select *, row_number() over (partition by t order by doc_id nulls first, leaf) - 1 as i from d),
{tree("a", "select t, i, leaf as h from n", levels)},
b as materialized (select t as name, h, row_number() over (order by encode(t)) - 1 as i from a_top),
{tree("c", "select 1 as t, i, h from b", top_levels)},
{folds("a", "select *, '' as proof, coalesce(other, leaf) as f from n", "t", "i", levels, "u")},
{folds("c", f"select u.doc_id, u.leaf, u.i as place, u.t as name, b.h as subroot, b.i, 1 as t, proof, f from u{levels} u join b on b.name = u.t", "t", "i", top_levels, "v")},
sizes as (select t as name, count(*) as n from n group by t)
select doc_id, leaf, subroot, c_top.h as root, sha256(proof) as proof_sha256, f as folded_root, f = c_top.h as verified,
  (place + {" + ".join(f"place // {FAN**m}" for m in range(1, levels + 1))})::bigint as log_place from v{top_levels}, c_top"""
