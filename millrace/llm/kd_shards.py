"""Sharding by a k-d tree: split at weighted medians along the widest metadata dimension, DataFrame functions only.

A node that must give n leaves is cut along the dimension in which its rows reach widest, at the weighted quantile
(n // 2) / n, and its halves give n // 2 and n - n // 2 leaves; n leaves is the total weight over the target bytes.
All nodes of one depth are cut at the same time. Dimensions are the size, the source and the language (the latter two by
a hash), each scaled to 24 bits over the whole table. A row's coordinate in a dimension has 24 further bits of a hash of
its text, so rows that are equal in a dimension can be cut between texts, and 12 of a hash of its text and id. A cut is
found by refining histograms of 2^16 bins a node down to single texts. Equal texts stay in one shard if they weigh at
most a twentieth of a leaf; a heavier group is cut by the last 12 bits where a cut falls into it. Only one row for each
node comes to the driver, and nothing is counted or compared in floating point.

Defined results: a null text has no bytes; a null source or language is an empty one; rows that are the same in text and
doc_id stay together; an empty table gives an empty result; with fewer rows than shards, some shards are empty; further
columns are ignored, and weigh nothing.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm._shared import written

BINS, VALUE, TEXT, ID, WHOLE = 16, 24, 24, 12, 20


def _known(columns: str, values: dict[int, tuple]) -> Column:
    """What the driver knows of a row's node, or null: a constant array with a place for each leaf, found by index."""
    names = [c.partition(":")[0].strip() for c in columns.split(",")]
    listed = [dict(zip(names, values[k], strict=True)) if k in values else None for k in range(max(values) + 1)]
    return F.get(F.from_json(F.lit(json.dumps(listed)), f"array<struct<{columns}>>"), F.col("node").cast("int"))


def drawn(text: Column, digits: int) -> Column:
    """A number of 4 bits a digit from the md5 of a string."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def scaled(df: DataFrame, dims: list[str]) -> DataFrame:
    """Replace whole numbers by their place between the least and the greatest of the table, in 24 bits."""
    ends = df.agg(*(f(d).alias(f"{n}_{d}") for d in dims for n, f in (("low", F.min), ("high", F.max)))).first()
    top = (1 << VALUE) - 1
    place = lambda d, low, high: F.expr(f"(`{d}` - {low}L) * {top}L div {high - low}L") if high > low else F.lit(0).cast("long")
    return df.withColumns({d: place(d, ends[f"low_{d}"], ends[f"high_{d}"]) for d in dims if ends[f"low_{d}"] is not None})


def kd_leaves(df: DataFrame, dims: int, weight: str, leaves: int) -> DataFrame:
    """Add leaf (0 to leaves - 1) to rows that have k0, k1, ... (60-bit coordinates), a whole weight, and node (0)."""
    nodes = {0: leaves}  # the first leaf of each node: its leaves
    heavy = (df.agg(F.sum(weight)).first()[0] or 0) // leaves // WHOLE
    key = lambda axis: F.element_at(F.array(*(f"k{i}" for i in range(dims))), F.col(axis))
    while any(n > 1 for n in nodes.values()):
        # the widest dimension of each node, and its weight
        value = lambda i: F.shiftright(f"k{i}", TEXT + ID)
        ends = (f(value(i)).alias(f"{n}{i}") for i in range(dims) for n, f in (("low", F.min), ("high", F.max)))
        stats = df.groupBy("node").agg(F.sum(weight).alias("w"), *ends).collect()
        axis = {r["node"]: max(range(dims), key=lambda i, r=r: r[f"high{i}"] - r[f"low{i}"]) for r in stats}
        goal = {r["node"]: r["w"] * (nodes[r["node"]] // 2) // nodes[r["node"]] for r in stats}
        prefix, below, cut = dict.fromkeys(axis, 0), dict.fromkeys(axis, 0), {k: 1 << 60 for k in axis if nodes[k] == 1}
        shift = VALUE + TEXT + ID
        while undecided := [k for k in axis if k not in cut]:
            facts = {k: (axis[k] + 1, prefix[k], goal[k] - below[k]) for k in undecided}
            rows = df.withColumn("known", _known("axis: int, prefix: bigint, want: bigint", facts))
            rows = rows.select("node", weight, "known.prefix", "known.want", key("known.axis").alias("key")).filter(F.shiftright("key", shift) == F.col("prefix"))
            shift = max(shift - BINS, ID) if shift > ID else 0
            bins = rows.groupBy("node", "want", F.shiftright("key", shift).alias("bin")).agg(F.sum(weight).alias("w"))
            bins = bins.withColumn("upto", F.sum("w").over(Window.partitionBy("node").orderBy("bin")))
            for r in bins.filter("upto >= want").groupBy("node").agg(F.min(F.struct("bin", "w", "upto")).alias("at")).collect():
                k, (b, w, upto) = r["node"], r["at"]
                before = below[k] + upto - w
                if shift == 0 or shift == ID and w <= heavy:  # cut at the nearer end of the group
                    cut[k] = (b if goal[k] - before < before + w - goal[k] else b + 1) << shift
                prefix[k], below[k] = b, before
        facts = {k: (axis[k] + 1, cut[k], nodes[k] // 2) for k in axis} or {0: (1, 0, 0)}
        side = F.when(key("known.axis") < F.col("known.cut"), F.col("node")).otherwise(F.col("node") + F.col("known.half"))
        df = written(df.withColumn("known", _known("axis: int, cut: bigint, half: bigint", facts)).withColumn("node", side).drop("known"), "kd-nodes")
        nodes = {k: n for first, all_ in nodes.items() for k, n in (((first, all_ // 2), (first + all_ // 2, all_ - all_ // 2)) if all_ > 1 else ((first, 1),))}
    return df.withColumn("leaf", F.col("node").cast("int")).drop("node")


def numbered(df: DataFrame, group: str, draw: str, order: list[str], name: str, rows_each: int = 20_000) -> DataFrame:
    """Add name: 0, 1, ... within each group without gaps, in the order of draw (a 60-bit hash) and order.

    A group is numbered in parts, by the first bits of draw, whose counts add up.
    """
    bits = max(0, (df.count() // rows_each).bit_length())
    cut = df.withColumn("part", F.shiftright(draw, 60 - bits))
    counts = cut.groupBy(group, "part").agg(F.count("*").alias("n"))
    before = counts.select(group, "part", (F.sum("n").over(Window.partitionBy(group).orderBy("part")) - F.col("n")).alias("before"))
    nth = F.row_number().over(Window.partitionBy(group, "part").orderBy(draw, *order)) - 1
    return cut.withColumn("nth", nth).join(before, [group, "part"]).withColumn(name, (F.col("nth") + F.col("before")).cast("long")).drop("part", "nth", "before")


def kd_shards(df: DataFrame, shards: int | None = 40, target_bytes: int | None = None, text: str = "text", doc_id: str = "doc_id", source: str = "source", lang: str = "lang", overhead: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: shards of near equal bytes.

    shards: how many leaves; target_bytes, where given, sets them by the bytes of a leaf instead.
    """
    raw = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (F.octet_length(raw) + overhead).cast("long").alias("size"),
        F.crc32(raw.cast("binary")).alias("text_crc32"),
        F.md5(raw).alias("digest"),
        (F.octet_length(raw) + overhead).cast("long").alias("d0"),
        *(drawn(F.coalesce(F.col(c).cast("string"), F.lit("")), VALUE // 4).alias(d) for c, d in ((source, "d1"), (lang, "d2"))),
    )
    rows = rows.withColumn("text_draw", F.conv(F.substring("digest", 1, TEXT // 4), 16, 10).cast("long"))
    rows = rows.withColumn("draw", drawn(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "digest"), 15)).drop("digest")
    rows = scaled(written(rows, "kd-rows"), ["d0", "d1", "d2"])
    tie = F.shiftleft("text_draw", ID) + F.shiftright("draw", 60 - ID)
    keys = {f"k{i}": F.shiftleft(f"d{i}", TEXT + ID) + tie for i in range(3)}
    rows = written(rows.withColumns(keys).select("doc_id", "size", "text_crc32", "draw", *keys, F.lit(0).cast("long").alias("node")), "kd-keys")
    if target_bytes:
        shards = max(1, -(-(rows.agg(F.sum("size")).first()[0] or 0) // target_bytes))
    placed = kd_leaves(rows, 3, "size", shards).withColumnRenamed("leaf", "shard")
    placed = numbered(placed, "shard", "draw", ["doc_id", "size"], "slot")
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


CRC_TABLE_SQL = """crc_table as (select list(x order by i) as t from (
  select i, list_reduce(list_prepend(i, range(8)), lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end) as x from range(256) r(i)))"""


def crc32_sql(blob: str) -> str:
    """DuckDB: the CRC of a blob; needs CRC_TABLE_SQL among the tables joined."""
    listed = f"list_transform(regexp_extract_all(hex({blob}), '..'), lambda h: ('0x' || h)::bigint)"
    return f"xor(list_reduce(list_prepend(4294967295, {listed}), lambda c, x: xor(c // 256, t[xor(c, x) % 256 + 1])), 4294967295)"


def oracle_sql(shards: int = 40) -> str:
    """The same rows in DuckDB: every depth cuts each node by a running sum over its single texts."""

    def draw(text: str, digits: int) -> str:
        return f"('0x' || substr(md5({text}), 1, {digits}))::bigint"

    depth, nodes, levels = 0, {0: shards}, []
    while any(n > 1 for n in nodes.values()):
        parts = ", ".join(f"({k}, {n})" for k, n in nodes.items())
        at, to = f"r{depth}", f"r{depth + 1}"
        levels.append(f"""
n{depth}(node, n) as (values {parts}),
s{depth} as (select node, n, sum(size)::bigint as w, (sum(size) * (n // 2) // n)::bigint as want, max(k0 >> 36) - min(k0 >> 36) as e0, max(k1 >> 36) - min(k1 >> 36) as e1, max(k2 >> 36) - min(k2 >> 36) as e2 from {at} join n{depth} using (node) group by node, n),
a{depth} as (select r.*, n, want, case when e0 >= e1 and e0 >= e2 then k0 when e1 >= e2 then k1 else k2 end as k from {at} r join s{depth} using (node)),
g{depth} as (select node, want, k >> 12 as g, sum(size)::bigint as w, sum(sum(size)) over (partition by node order by k >> 12)::bigint as upto from a{depth} where n > 1 group by node, want, k >> 12),
h{depth} as (select node, want, min(g) as g, arg_min(w, g) as w, arg_min(upto, g) as upto from g{depth} where upto >= want group by node, want),
i{depth} as (select a.node, a.want, a.k as g, sum(size)::bigint as w, (h.upto - h.w + sum(sum(size)) over (partition by a.node order by a.k))::bigint as upto from a{depth} a join h{depth} h on a.node = h.node and a.k >> 12 = h.g, total where h.w > heavy group by a.node, a.want, a.k, h.upto, h.w),
j{depth} as (select node, want, min(g) as g, arg_min(w, g) as w, arg_min(upto, g) as upto from i{depth} where upto >= want group by node, want),
c{depth} as (select node, case when want - (upto - w) < upto - want then g << 12 else (g + 1) << 12 end as cut from h{depth}, total where w <= heavy union all select node, case when want - (upto - w) < upto - want then g else g + 1 end from j{depth}),
{to} as (select a.doc_id, size, text_crc32, draw, k0, k1, k2, case when cut is null or k < cut then a.node else a.node + n // 2 end as node from a{depth} a left join c{depth} c on a.node = c.node)""")
        nodes = {k: n for first, all_ in nodes.items() for k, n in (((first, all_ // 2), (first + all_ // 2, all_ - all_ // 2)) if all_ > 1 else ((first, 1),))}
        depth += 1
    place = lambda d: f"coalesce(({d} - min({d}) over ()) * {(1 << VALUE) - 1} // nullif(max({d}) over () - min({d}) over (), 0), 0)"
    return f"""with {CRC_TABLE_SQL},
d as (select doc_id, strlen(coalesce(text, '')) + 16 as size, {crc32_sql("encode(coalesce(text, ''))")} as text_crc32, {draw("coalesce(text, '')", 6)} as text_draw,
  {draw("coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, ''))", 15)} as draw, strlen(coalesce(text, '')) + 16 as d0, {draw("coalesce(source, '')", 6)} as d1, {draw("coalesce(lang, '')", 6)} as d2 from documents, crc_table),
total as (select sum(size)::bigint // {shards} // {WHOLE} as heavy from d),
r0 as (select doc_id, size, text_crc32, draw, {", ".join(f"(({place(f'd{i}')}) << 36) + (text_draw << 12) + (draw >> 48) as k{i}" for i in range(3))}, 0 as node from d),{",".join(levels)}
select doc_id, size::bigint as size, text_crc32::bigint as text_crc32, 'bytes' as law, node::int as shard, (row_number() over (partition by node order by draw, doc_id nulls first, size) - 1)::bigint as slot, null::int as grown_shard from r{depth}"""
