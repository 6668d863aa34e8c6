"""Streams with state: files in parts, restarts, resets, repeated and late lines, against batch rules."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators.vectors import first_wins
from millrace.streaming import stateful as S


@pytest.fixture(scope="module")
def prints(spark):
    rows = [(i, "ab"[i % 3 == 0], None if i % 17 == 0 else (i * 2654435761 % 64) << (i % 5)) for i in range(120)]
    return spark.createDataFrame(rows, "id long, g string, bits long")


def in_thirds(df, key="id", n=120):
    return [df.filter((F.col(key) >= lo) & (F.col(key) < lo + n // 3)) for lo in range(0, n, n // 3)]


def test_first_wins_in_parts_is_the_batch_rule(spark, prints):
    want = {(r["g"], r["id"], r["duplicate_of"]) for r in first_wins(prints, "g", "id", "bits", 2).collect()}
    got, _ = S.fed(spark, in_thirds(prints), lambda s: S.first_wins_stream(s, "g", "id", "bits", 2), "append", "test-wins")
    assert {tuple(r) for r in got.collect()} == want and any(d for *_, d in want)


def test_first_wins_of_wide_hashes_with_nulls(spark):
    rng = random.Random(5)
    bits = [rng.getrandbits(60) for _ in range(400)]
    for i in range(50, 400, 2):  # some are 1 to 5 bits from an earlier one
        bits[i] = bits[rng.randrange(i)] ^ sum(1 << b for b in rng.sample(range(60), 1 + i % 5))
    rows = spark.createDataFrame([(i, "a" if i % 9 else "b", None if i % 40 == 7 else b) for i, b in enumerate(bits)], "id long, g string, bits long")
    want = {(r["g"], r["id"], r["duplicate_of"]) for r in first_wins(rows, "g", "id", "bits", 3, 60).collect()}
    got, _ = S.fed(spark, in_thirds(rows, n=402), lambda s: S.first_wins_stream(s, "g", "id", "bits", 3, total_bits=60), "append", "test-wide")
    assert {tuple(r) for r in got.collect()} == want and any(d for *_, d in want)


@pytest.mark.parametrize("distance", [0, 3, 12, 64])
def test_kept_hashes_are_found_as_by_comparing_all(distance):
    rng = random.Random(distance)
    kept, plain = S._Kept(distance, 64), []
    for i in range(3000):
        value = rng.getrandbits(64) - (1 << 63)
        if plain and i % 3:
            value = plain[rng.randrange(len(plain))][1]
            for b in rng.sample(range(64), i % 6):
                value ^= (1 << b) if b < 63 else -1 << 63
        near = next((k for k, v in plain if ((v ^ value) & (1 << 64) - 1).bit_count() <= distance), None)
        assert kept.first(value) == near
        if near is None:
            kept.add(i, value)
            plain.append((i, value))


def test_a_reset_clears_its_group_only(spark, prints):
    rows = prints.withColumn("reset", F.lit(False)).unionByName(spark.createDataFrame([(60, "a", None, True)], "id long, g string, bits long, reset boolean"))
    got, _ = S.fed(spark, in_thirds(rows), lambda s: S.first_wins_stream(s, "g", "id", "bits", 2, "reset"), "append", "test-reset")
    parts = [prints.filter("g = 'b'"), prints.filter("g = 'a' and id < 60"), prints.filter("g = 'a' and id >= 60")]
    want = {(r["g"], r["id"], r["duplicate_of"]) for p in parts for r in first_wins(p, "g", "id", "bits", 2).collect()}
    assert {tuple(r) for r in got.collect()} == want


def test_job_records_after_each_part(spark):
    at = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    lines = [
        [("a", 1, "epoch 1/10", at(0)), ("a", 2, "steps: 5/90 loss=0.5", at(1)), ("b", 1, "loss: 2.25 lr=1e-4", at(0)), ("c", 1, "fine", at(0))],
        [("a", 2, "epoch 9/10", at(2)), ("a", 3, "epoch 2/10", at(2)), ("b", 2, "CUDA out of memory now", at(2)), ("b", 3, "epoch 7/9", at(2.5))],
        [("a", 4, "loss=0.25", at(40)), ("b", 4, "epoch 8/9", at(40)), ("a", 5, "epoch 3/10", at(1))],
        [("c", 2, "epoch 4/5", at(41))],
    ]
    seen, parts = [], [spark.createDataFrame(p, "job string, n long, line string, ts timestamp_ntz") for p in lines]
    for k in range(1, len(parts) + 1):
        got, late = S.fed(spark, parts[:k], lambda s: S.monitor_jobs(s, "job", "n", "line", delay="1 hour", quiet_seconds=4 * 3600), "update", "test-jobs", ["job"])
        seen.append(({r["job"]: (r["epoch"], r["step"], r["loss"], r["status"], r["message"], r["line"], r["lines"]) for r in got.collect()}, late))
    assert seen[0][0] == {"a": (1, 5, 0.5, "running", None, 2, 2), "b": (None, None, 2.25, "running", None, 1, 1), "c": (None, None, None, "running", None, 1, 1)}
    assert seen[1][0]["a"] == (2, 5, 0.5, "running", None, 3, 3)  # line 2 came again
    assert seen[1][0]["b"] == (None, None, 2.25, "oom_error", "CUDA out of memory now", 2, 2)  # and nothing after the error
    assert seen[2][0]["a"] == (2, 5, 0.25, "running", None, 4, 4) and seen[2][1] == 1  # line 5 is behind the watermark
    assert seen[2][0]["c"][3] == "completed" and seen[2][0]["b"][3] == "oom_error"
    assert seen[3][0]["c"] == (4, None, None, "running", None, 2, 2)


@pytest.mark.parametrize("shards", [1, 7])
def test_jobs_of_a_shard_keep_records_of_their_own(spark, shards):
    at = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    texts = ["epoch {}/90", "steps: {}/900 loss=0.{}", "fine", "loss: {}.5 lr=1e-4"]
    lines = [(f"j{j}", n, "CUDA out of memory" if j % 5 == 0 and n == 4 else texts[(j + n) % 4].format(n, j), at(n * (1 + j % 7))) for j in range(60) for n in range(9)]
    lines.append(("end", 0, "fine", at(49)))  # the watermark ends at 48 hours, when the quiet time of the jobs of 5 hours a line is just over
    edges, seen, want = [(-1, 16), (16, 32), (32, 50)], {}, {}
    parts = [[r for r in lines if at(lo) < r[3] <= at(hi)] for lo, hi in edges]
    for job, n, line, ts in sorted(sum(parts, []), key=lambda r: r[:2]):
        last = want.get(job, (None, "running", -1, 0, None))
        if last[1] == "running":
            epoch = int(line.split()[1].split("/")[0]) if line.startswith("epoch") else last[0]
            want[job] = (epoch, "oom_error" if "CUDA" in line else "running", n, last[3] + 1, ts)
    end = at(49) - dt.timedelta(hours=1)
    want = {j: (e, "completed" if s == "running" and t + dt.timedelta(hours=8) <= end else s, n, k) for j, (e, s, n, k, t) in want.items()}
    frames = [spark.createDataFrame(p, "job string, n long, line string, ts timestamp_ntz") for p in parts]
    got, _ = S.fed(spark, frames, lambda s: S.monitor_jobs(s, "job", "n", "line", quiet_seconds=8 * 3600, shards=shards), "update", "test-shards", ["job"])
    for r in got.collect():
        seen[r["job"]] = (r["epoch"], r["status"], r["line"], r["lines"])
    assert seen == want and {s for _, s, _, _ in want.values()} == {"running", "completed", "oom_error"}


def test_a_batch_costs_calls_by_shard_not_by_job():
    calls = []

    class Value:
        kept = None

        def get(self):
            calls.append("get")
            return self.kept

        def update(self, value):
            calls.append("update")
            self.kept = value

    class Handle:
        def getValueState(self, *_):  # noqa: N802
            return Value()

        def registerTimer(self, at):  # noqa: N802
            calls.append(("register", at))

        def deleteTimer(self, at):  # noqa: N802
            calls.append(("delete", at))

    records = S._JobRecords(1000)
    records.init(Handle())
    for k in (0, 1):
        lines = pd.DataFrame([(f"j{j}", k, None, 5000 * k + j, k, None, None, None, None) for j in range(500)], columns=["job", "line_no", "line", "at", "epoch", "step", "loss", "rate", "error"])
        (rows,) = records.handleInputRows((0,), iter([lines]), None)
        assert len(rows) == 500 and set(rows["lines"]) == {k + 1}
    assert calls == ["get", "update", ("register", 1000), "get", "update", ("delete", 1000), ("register", 6000)]


def test_sessions_and_late_rows(spark):
    at = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    rows = [[("u", at(0)), ("u", at(0.3)), ("v", at(1))], [("u", at(0.6)), ("u", at(30)), ("w", at(30.2))], [("u", at(1.0)), ("v", at(29.9)), ("u", at(80)), ("w", at(30.6))]]
    parts = [spark.createDataFrame(p, "who string, ts timestamp_ntz") for p in rows]
    got, late = S.fed(spark, parts, lambda s: S.sessions(s, "who", gap="30 minutes", delay="5 hours"), "append", "test-sessions")
    # the row of 1.0 comes behind the watermark of 25; that of 80 is still open
    assert sorted(tuple(r) for r in got.collect()) == [("u", at(0), at(0.6), 3), ("u", at(30), at(30), 1), ("v", at(1), at(1), 1), ("v", at(29.9), at(29.9), 1), ("w", at(30.2), at(30.6), 2)]
    assert late == 1
