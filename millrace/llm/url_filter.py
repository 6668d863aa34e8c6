"""URL filters: rules on host and path, and a logistic regression on hashed character n-grams for the rest.

Host: what follows the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; path: what follows it up to `?`,
`#` or the end; a null url or one without `://` has neither. A rule `host/path` fits its host and all subdomains, if
the path begins with the rule's path; the longest rule decides. Other urls are judged by the regression on hashed n-grams
of 3 to 5 characters of host and path, each counted once, scaled to unit length.

The regression is trained from a small table of labelled urls, a parameter of at most 100,000 rows (of more, those with
the least hashes are taken). The default table is made of words of this module, in pairs: words of hosts that bet, sell,
advertise or spam, and words of plain ones. Every third pair is left out of it; the tests measure the accuracy on these.

Defined results: null or malformed urls have an empty host and path and get the verdict of the model on these; repeated
rows get equal verdicts; a score of the threshold blocks; null page_ids are kept; further columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm._hashing import mix
from millrace.llm._shared import slices

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
BLOCKED_WORDS = [
    "adult", "ads", "banner", "bet", "bets", "bingo", "bonus", "casino", "cheap", "clicks", "dating", "escort", "free", "gamble", "jackpot", "loans", "lottery", "payday", "pharma", "pills",
    "poker", "popup", "porn", "promo", "roulette", "slots", "spam", "tracker", "viagra", "win",
]
ALLOWED_WORDS = [
    "academy", "archive", "art", "atlas", "bakery", "books", "bridge", "chess", "city", "college", "cook", "farm", "film", "forest", "forum", "garden", "guide", "harbor", "health", "history",
    "journal", "kitchen", "language", "law", "library", "maps", "market", "math", "museum", "music", "news", "nature", "ocean", "opera", "paper", "physics", "poem", "radio", "recipe", "river",
    "school", "science", "sport", "story", "studio", "theatre", "travel", "village", "weather", "wiki",
]
DOMAINS = ["example.com", "example.org", "test.info", "site.co"]
PATHS = ["/", "/en/12", "/a/page.html", "/index/7/"]
BUCKETS, LABELLED = 1 << 16, 100_000
_U = np.uint64


def labelled_urls(held_out: bool = False) -> list[tuple[str, int]]:
    """url and label (1: block) of pairs of words of one kind: two thirds of the pairs, or the third that is held out."""
    out = []
    for label, words in ((1, BLOCKED_WORDS), (0, ALLOWED_WORDS)):
        for a in words:
            for b in words:
                draw = zlib.crc32(f"{a}-{b}".encode())
                if a != b and (draw % 3 == 1) == held_out and draw // 3 % 3 == 0:
                    host = f"{a}-{b}" if draw & 64 else a + b
                    out.append((f"https://{host}.{DOMAINS[draw // 128 % len(DOMAINS)]}{PATHS[draw // 1024 % len(PATHS)]}", label))
    return out


def host_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit("")), F.coalesce(path, F.lit(""))


def ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of each distinct n-gram bucket of texts given as bytes and offsets."""
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    keys = [np.zeros(0, np.int64)]
    rolled = data.astype(_U) + _U(1)
    for n in (2, 3, 4, 5):
        if len(data) < n:
            break
        rolled = rolled[: len(data) - n + 1] * _U(0x9E3779B97F4A7C15) + data[n - 1 :].astype(_U) + _U(n)
        if n > 2:
            inside = doc[: len(rolled)] == doc[n - 1 :]
            keys.append(doc[: len(rolled)][inside] * BUCKETS + (mix(rolled[inside]) >> _U(48)).astype(np.int64))
    found = np.unique(np.concatenate(keys))
    return found // BUCKETS, found % BUCKETS


def encoded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def train(rows: list[tuple[str, str, int]], l2: float = 1e-4, steps: int = 400, rate: float = 8.0) -> tuple[np.ndarray, float]:
    """Weights and intercept by gradient descent on (host, path, label); the two labels weigh the same."""
    doc, bucket = ngrams(*encoded([marked(host, path) for host, path, _ in rows]))
    y = np.array([label for *_, label in rows], float)
    value = 1 / np.sqrt(np.bincount(doc, minlength=len(rows)))[doc]
    share = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    weights, intercept = np.zeros(BUCKETS), 0.0
    for _ in range(steps):
        error = share * (1 / (1 + np.exp(-(np.bincount(doc, weights[bucket] * value, len(rows)) + intercept))) - y)
        weights -= rate * (np.bincount(bucket, error[doc] * value, BUCKETS) + l2 * weights)
        intercept -= rate / 8 * error.sum()
    return weights, float(intercept)


def marked(host: str, path: str) -> str:
    return f"^{host}|{path}$"


def scores(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray, intercept: float) -> np.ndarray:
    """Chance of a block for each marked url."""
    n = len(offsets) - 1
    doc, bucket = ngrams(data, offsets)
    total = np.bincount(doc, weights[bucket], n) / np.sqrt(np.maximum(np.bincount(doc, minlength=n), 1))
    return 1 / (1 + np.exp(-(total + intercept)))


def judge_urls(df: DataFrame, url: str = "url", page_id: str = "page_id", rules: list[tuple[str, str]] | None = None, labelled: list[tuple[str, int]] | None = None, threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict, score (null where a rule decides): one row for each row of df."""
    rules = RULES if rules is None else rules
    spark = df.sparkSession
    given = labelled_urls() if labelled is None else labelled
    given = sorted(given, key=lambda r: zlib.crc32(r[0].encode()))[:LABELLED] if len(given) > LABELLED else given
    examples = spark.createDataFrame(given, "url string, label int")
    weights, intercept = train([tuple(r) for r in examples.select(*host_path(F.col("url")), "label").collect()])
    shipped = spark.sparkContext.broadcast(weights)  # 65,536 numbers, whatever the data

    host, path = host_path(F.col(url))
    rows = df.select(F.col(page_id).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    chosen, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, what in sorted(rules, key=lambda r: len(r[0])):  # the longest comes last and goes outermost
        home, slash, below = rule.partition("/")
        fits = ((F.col("host") == home) | F.col("host").endswith("." + home)) & F.col("path").startswith(slash + below)
        chosen, verdict = F.when(fits, F.lit(rule)).otherwise(chosen), F.when(fits, F.lit(what)).otherwise(verdict)
    rows = rows.select("page_id", "host", "path", chosen.alias("rule"), verdict.alias("ruled"), F.concat(F.lit("^"), "host", F.lit("|"), "path", F.lit("$")).alias("marked"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in slices(batches, "marked", max_rows=10_000):
            page, hosts, paths, rule, ruled, _ = batch.columns
            found = scores(data, offsets, shipped.value, intercept)
            judged = np.where(found >= threshold, "block", "allow").tolist()
            final = [w or j for w, j in zip(ruled.to_pylist(), judged, strict=True)]
            kept = pa.array(found, mask=ruled.is_valid().to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([page, hosts, paths, rule, pa.array(final, pa.string()), kept], ["page_id", "host", "path", "rule", "verdict", "score"])

    return rows.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string, score double")
