"""Streams with a state of their own: first-wins dedup with resets, records of running jobs, and sessions with late rows counted."""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from itertools import pairwise
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from millrace.functions.scores import log_fields
from millrace.streaming.incremental import _work_dir, run_available, source, timed

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _rocks(spark: SparkSession) -> Iterator[None]:
    """The state store that these processors need, while a stream starts and runs."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


def fed(spark: SparkSession, parts: list[DataFrame], job: Callable[[DataFrame], DataFrame], mode: str, name: str, key: list[str] | None = None) -> tuple[DataFrame, int]:
    """The rows that a stream gives when its files come part by part, and how many rows it dropped as too late.

    After each part the stream runs over what is there, ends, and goes on from its checkpoint with the next one.
    """
    work, late, out = _work_dir(spark, name), 0, None
    for part in parts:
        part.write.mode("append").parquet(f"{work}/in")
        with _rocks(spark):
            out, dropped = run_available(job(source(spark, f"{work}/in")), work, mode, key, dropped=True)
        late += dropped
    return out, late


_ALL = (1 << 64) - 1


class _Kept:
    """Kept hashes in the order in which they were kept.

    They are found by bands of bits, as hashes at most `distance` bits apart agree in one of distance + 1 bands. Those that agree in a
    band are a chain, from the last one back. Where the chains hold a good part of all, all are compared at once.
    """

    def __init__(self, distance: int, total_bits: int) -> None:
        edges = [total_bits * i // (distance + 1) for i in range(distance + 1)] + [64]
        self.distance, self.keys, self.bits = distance, array("q"), array("q")
        self.bands = [(low, (1 << high - low) - 1, {}, array("q"), array("q")) for low, high in pairwise(edges)]

    def add(self, key: int, value: int) -> None:
        for low, mask, last, before, length in self.bands:
            at = last.get(value >> low & mask, -1)
            before.append(at)
            length.append(length[at] + 1 if at >= 0 else 1)
            last[value >> low & mask] = len(self.keys)
        self.keys.append(key)
        self.bits.append(value)

    def first(self, value: int) -> int | None:
        """The key that was kept first of those near a value."""
        chains = [(before, length[at], at) for low, mask, last, before, length in self.bands if (at := last.get(value >> low & mask, -1)) >= 0]
        if 64 * sum(n for _, n, _ in chains) > len(self.keys):
            near = np.flatnonzero(np.bitwise_count((np.frombuffer(self.bits, np.int64) ^ np.int64(value)).view(np.uint64)) <= self.distance)
            return self.keys[int(near[0])] if len(near) else None
        best = None
        for before, _, at in chains:
            while at >= 0:
                if (best is None or at < best) and ((self.bits[at] ^ value) & _ALL).bit_count() <= self.distance:
                    best = at
                at = before[at]
        return None if best is None else self.keys[best]


class _FirstWins(StatefulProcessor):
    """Kept hashes of one group, in the order in which they were kept."""

    def __init__(self, distance: int, ttl: int | None, total_bits: int) -> None:
        self.distance, self.ttl, self.total_bits = distance, ttl, total_bits

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getListState("kept", "k long, bits long", self.ttl)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = _Kept(self.distance, self.total_bits)
        for k, value in self.kept.get() if self.kept.exists() else []:
            held.add(int(k), int(value))
        new, out, cleared = [], [], False
        batch = pd.concat(list(rows)).sort_values(["k", "is_reset"], ascending=[True, False])
        for k, value, is_blank, is_reset in zip(batch["k"], batch["bits"], batch["is_blank"], batch["is_reset"], strict=True):
            if is_reset:
                held, new, cleared = _Kept(self.distance, self.total_bits), [], True
                continue
            if is_blank:
                out.append((*key, k, None))
                continue
            near = held.first(int(value))
            if near is None:
                held.add(int(k), int(value))
                new.append((int(k), int(value)))
            out.append((*key, k, near))
        if cleared:
            self.kept.clear()
        if new:
            self.kept.appendList(new)
        yield pd.DataFrame({"group": [o[0] for o in out], "k": [o[1] for o in out], "duplicate_of": pd.array([o[2] for o in out], "Int64")})

    def close(self) -> None:
        pass


def first_wins_stream(stream: DataFrame, group: str, key: str, bits: str, distance: int, reset: str | None = None, ttl_hours: int | None = None, total_bits: int = 64) -> DataFrame:
    """group, k, duplicate_of: each row is kept unless a row of its group kept before is within `distance` bits.

    Rows of a batch are taken in key order, batches as they come. A row whose `reset` is true clears its group's state and gives
    no row. With a time to live, kept rows are forgotten so long after they came. Rows without bits are kept, but nothing is near them.
    A row meets the kept ones that agree with it in a band of the lower `total_bits`. A group is one key of the state and one task.
    """
    cleared = F.coalesce(F.col(reset), F.lit(False)) if reset else F.lit(False)
    value = F.col(bits).cast("long")  # pandas would make floats of a column with nulls, which have 53 bits
    values = [F.coalesce(value, F.lit(0).cast("long")).alias("bits"), value.isNull().alias("is_blank")]
    rows = stream.select(F.col(group).cast("string").alias("group"), F.col(key).cast("long").alias("k"), *values, cleared.alias("is_reset"))
    processor = _FirstWins(distance, ttl_hours * 3_600_000 if ttl_hours else None, total_bits)
    out = StructType.fromDDL("group string, k long, duplicate_of long")
    return rows.groupBy("group").transformWithStateInPandas(processor, out, "Append", "ProcessingTime" if ttl_hours else "None")


_RECORD = "epoch int, step int, loss double, rate double, status string, message string, line long, lines long"
_NAMES = ["job", *(f.split()[0] for f in _RECORD.split(", "))]
#: The records of a shard as one value, an array a field; due is when a running job is quiet, in milliseconds.
_RECORDS = ", ".join(f"{f.split()[0]} array<{f.split()[1]}>" for f in f"job string, {_RECORD}, due long".split(", "))


class _JobRecords(StatefulProcessor):
    """What the logs of a shard of jobs say so far. A record ends with the first error, or when no line has come for some time.

    The state costs some calls a shard and batch, not a job. The shard has one timer, at the least due of its running jobs.
    """

    def __init__(self, quiet: int) -> None:
        self.quiet = quiet

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("records", _RECORDS)

    def _records(self) -> dict[str, list]:
        jobs, *fields = self.state.get() or ([],) * (len(_NAMES) + 1)
        return dict(zip(jobs, map(list, zip(*fields, strict=True)), strict=True))

    def _save(self, records: dict[str, list]) -> None:
        self.state.update(tuple(map(list, zip(*((job, *r) for job, r in records.items()), strict=True))))

    def _due(self, records: dict[str, list]) -> int | None:
        return min((r[-1] for r in records.values() if r[-1] is not None), default=None)

    def _rows(self, records: dict[str, list], jobs: Iterable[str]) -> pd.DataFrame:
        rows = pd.DataFrame([(job, *records[job][:-1]) for job in jobs], columns=_NAMES)
        return rows.astype({"epoch": "Int32", "step": "Int32", "line": "Int64", "lines": "Int64", "loss": "float64", "rate": "float64"})

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        records = self._records()
        before, seen = self._due(records), {}
        batch = pd.concat(list(rows)).sort_values("line_no", kind="stable")
        columns = ["job", "line_no", "line", "at", "epoch", "step", "loss", "rate", "error"]
        for job, line_no, text, at, *values, error in zip(*(batch[c] for c in columns), strict=True):
            seen[job] = True
            record = records.setdefault(job, [None, None, None, None, "running", None, -1, 0, None])
            if record[4] not in ("running", "completed") or line_no <= record[6]:
                continue  # after an error, or read before
            for i, value in enumerate(values):
                if not pd.isna(value):
                    record[i] = int(value) if i < 2 else float(value)
            record[4], record[6], record[7], record[8] = "running", int(line_no), record[7] + 1, int(at) + self.quiet
            if isinstance(error, str):
                record[4], record[5], record[8] = "oom_error" if error == "oom_error" else "failed", text.strip(), None
        self._save(records)
        after = self._due(records)
        if after != before:
            if before is not None:
                self.handle.deleteTimer(before)
            if after is not None:
                self.handle.registerTimer(after)
        yield self._rows(records, seen)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        records, now = self._records(), timerValues.getCurrentWatermarkInMs()
        quiet = [job for job, r in records.items() if r[8] is not None and r[8] <= now]
        for job in quiet:
            records[job][4], records[job][8] = "completed", None
        self._save(records)
        if (after := self._due(records)) is not None:
            self.handle.registerTimer(after)
        yield self._rows(records, quiet)

    def close(self) -> None:
        pass


def monitor_jobs(stream: DataFrame, job: str, line_no: str, line: str, ts: str = "ts", delay: str = "1 hour", quiet_seconds: int = 3600, shards: int = 1024) -> DataFrame:
    """job, epoch, step, loss, rate, status, message, line, lines: a job's record after each batch that has lines of it.

    Lines are numbered, so those that come again or after a later one of the job are passed over. status is running, oom_error or
    failed (from the first line with an error on, whose text is the message; later lines don't count), or completed when the
    watermark is quiet_seconds past the last line; a later line sets a completed job running again. Jobs are dealt to `shards` by
    their hash; a batch rewrites the records of the shards that it has lines of, so some hundred jobs a shard are a good number.
    """
    fields = log_fields(F.col("line"))
    rows = timed(stream, ts).withWatermark(ts, delay).select(F.col(job).cast("string").alias("job"), F.col(line_no).cast("long").alias("line_no"), F.col(line).alias("line"), F.col(ts).alias("ts"))
    text, shard = F.when(fields["error"].isNotNull(), F.col("line")), F.pmod(F.xxhash64("job"), F.lit(shards))
    rows = rows.select(shard.alias("shard"), "job", "line_no", text.alias("line"), "ts", F.unix_millis("ts").alias("at"), *(v.alias(k) for k, v in fields.items()))
    out = StructType.fromDDL(f"job string, {_RECORD}")
    return rows.groupBy("shard").transformWithStateInPandas(_JobRecords(quiet_seconds * 1000), out, "Update", "EventTime")


def sessions(stream: DataFrame, group: str, ts: str = "ts", gap: str = "30 minutes", delay: str = "1 day") -> DataFrame:
    """group, start, stop, parts: runs of rows less than `gap` apart, once the watermark is past a run's end; rows behind it are dropped."""
    rows = timed(stream, ts).withWatermark(ts, delay)
    runs = rows.groupBy(group, F.session_window(ts, gap).alias("run")).agg(F.min(ts).alias("start"), F.max(ts).alias("stop"), F.count("*").alias("parts"))
    return runs.select(group, F.col("start").cast("timestamp_ntz").alias("start"), F.col("stop").cast("timestamp_ntz").alias("stop"), "parts")
