"""The manifest against a plain tree, DuckDB, and odd rows; the closed form against the log itself."""

import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import merkle as M
from millrace.llm import queries as Q

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        run = i // 8 * 8
        out.append((i - run, [h for k, h in enumerate(level[run : run + 8], run) if k != i]))
        i //= 8
    return out


def plain(rows):
    """The rows of the contract by a plain walk; rows: dicts of the five fields."""

    def leaf(r):
        return sha("".join("-" if r[c] is None else f"{len(str(r[c]).encode())}:{r[c]}" for c in M.FIELDS))

    langs = sorted({r["lang"] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    trees = {v: sorted(((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r), i) for i, r in enumerate(rows) if r["lang"] == v)) for v in langs}
    levels = {v: levels_of([x[2] for x in trees[v]]) for v in langs}
    top = levels_of([levels[v][-1][0] for v in langs])
    out = []
    for place, v in enumerate(langs):
        for rank, (_, _, digest, i) in enumerate(trees[v]):
            steps, r = siblings(levels[v], rank) + siblings(top, place), rows[i]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
                text = r["text"] and "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"])
                folded = leaf(r | {"text": text})
            else:
                folded = digest
            for at, others in steps:
                folded = sha("".join([*others[:at], folded, *others[at:]]))
            out.append((r["doc_id"], digest, levels[v][-1][0], top[-1][0], sha("".join(h for _, o in steps for h in o)), folded, folded == top[-1][0]))
    return out


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


@pytest.mark.parametrize("leaves", [1, 2, 7, 8, 9, 63, 64, 65, 71, 512, 513, 600])
def test_closed_form_is_the_order_of_the_log(leaves):
    digests = [sha(str(i)) for i in range(leaves)]
    height = M.height_of(leaves)
    log, levels = M.append_log(digests, height), levels_of(digests)
    assert sum(map(len, levels)) == len(log) and log[-1] == levels[-1][0]
    for level, nodes in enumerate(levels):
        assert [log[p] for p in M.postorder(level, np.arange(len(nodes)), leaves, height)] == nodes
    stretch = M.Stretch(bytes.fromhex("".join(log)), leaves, height)
    for i in {0, leaves // 2, leaves - 1}:
        steps = stretch.steps(i)
        assert steps == [(p, "".join(o)) for p, o in siblings(levels, i)] and M.fold(digests[i], steps) == log[-1]
        assert not steps or M.fold(sha("other"), steps) != log[-1]


def test_documents_equal_a_plain_tree(spark):
    rows = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = Q.op12_merkle(spark, SF)
    assert found(got) == sorted(plain(rows), key=repr)
    assert {r["verified"] for r in got.collect()} == {True, False}


def test_documents_equal_duckdb(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    rel = con.execute(Q.ORACLES["op12_merkle"])
    names, df = [d[0] for d in rel.description], Q.op12_merkle(spark, SF)
    assert sorted(names) == sorted(df.columns)
    assert sorted(tuple(r) for r in df.select(*names).collect()) == sorted(rel.fetchall())


def test_tiers_and_many_trees(spark):
    """A tree of several builders and more trees than one builder takes, hot group included."""
    rows = [(i, "s", "hot" if i % 2 else f"l{i:05d}", i, f"Text {i % 7}") for i in range(1300)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert found(M.document_manifest(df.repartition(5))) == sorted(plain([dict(zip(M.FIELDS, r, strict=True)) for r in rows]), key=repr)


def test_odd_rows(spark):
    rows = [(None, None, None, None, None), (None, "s", None, 1, "x"), (5, "s", "en", 1, "A"), (5, "s", "en", 1, "A"), (5, "s", "en", 1, "a"), (-3, "", "", 0, ""), (8, "é", "ü", None, "É A" * 50_000), (9, "s", "Z", 1, None), (10, "1:2", "z", 1, "-")]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    clash = df.withColumns({c: F.lit("x") for c in ("tree", "key", "digest", "other", "row", "rank", "total", "block", "path", "_at", "_part")})
    assert found(M.document_manifest(clash)) == sorted(plain([dict(zip(M.FIELDS, r, strict=True)) for r in rows]), key=repr)
    one = [r for r in rows if r[0] == 8]
    assert found(M.document_manifest(df.filter("doc_id = 8"))) == plain([dict(zip(M.FIELDS, one[0], strict=True))])
    assert M.document_manifest(df.limit(0)).count() == 0
