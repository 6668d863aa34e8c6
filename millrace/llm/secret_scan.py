"""Secret scans with multipart credential linking; DataFrame functions only.

Three strong kinds are always reported: `assign` (a keyword, a separator and a value of 6 or more characters), `access`
(AKIA and 16 or more capitals or digits) and `hex` (24 or more lower-case hex digits). Three weak kinds are candidates:
`ident` (account names and mail addresses), `endpoint` (URL hosts and IPv4 addresses) and `opaque` (tokens of 16 or
more characters with letters and digits). A candidate is reported only when a complementary part lies within its scope,
at most 200 characters away: an identifier or an endpoint needs a secret (assign, hex or opaque), an opaque token needs
an identifier (access or ident) or an endpoint. Candidates that overlap a strong span are not candidates.

The scopes are an interval join: a part covers the 256-character bins that its span, widened by the scope, reaches; a
candidate covers the bins of its own span; the semi-join on text and bin then tests the exact distance. Overlaps with
strong spans are an anti-join of the same kind. So a text's parts are never paired with one another as a whole, and the
work on a text grows with its length.

Positions are code points, ends exclusive. Defined results: a null text counts as empty and has no spans; rows may
repeat and doc_ids may be null, a row's result depends on its doc_id and text only; further columns are kept where
asked for; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm._shared import written

KINDS = ["assign", "access", "hex", "ident", "endpoint", "opaque"]
STRONG = 3
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = {
    "assign": ASSIGN,
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{24,}",
    "ident": r"""(?i:user(?:name)?|login|account|client_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@+._-]{3,}|[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9.-]{1,128}\.[A-Za-z]{2,}""",
    "endpoint": r"https?://[A-Za-z0-9.-]+(?::[0-9]+)?|(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9.])",
    "opaque": r"(?<![A-Za-z0-9+/_])[A-Za-z+/_]*+[0-9][A-Za-z0-9+/_]*+",
}
#: A text without this has no match; the test costs less than the pattern.
HINTS = {"access": "AKIA", "ident": r"@|(?i:user|login|account|client)", "endpoint": r"://|[0-9]\.[0-9]", "opaque": "[0-9]"}
ROLES = {"assign": "secret", "access": "id", "hex": "secret", "ident": "id", "endpoint": "endpoint", "opaque": "secret"}
SCOPE, BIN, BLOCK = 200, 256, 256


def _before(sizes: Column, i: Column) -> Column:
    """Sum of the first i of sizes. The sums of whole blocks are made once a block, so n sums take about 128 n steps."""
    return F.aggregate(F.slice(sizes, i - i % BLOCK + 1, i % BLOCK), F.lit(0), lambda a, x: a + x)


def _located(text: Column, kind: str) -> Column:
    """Spans of all leftmost non-overlapping matches of a kind: array of (start, kind, end), before any filter but the kind's own."""
    pattern = F.lit(PATTERNS[kind])
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.split(text, PATTERNS[kind], -1)
    pair = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: F.struct(F.char_length(g).alias("gap"), F.char_length(h).alias("len"), h.alias("hit")))
    number = F.lit(KINDS.index(kind))

    # the intermediate arrays are bound by one-element transforms, so each is made once a text
    bound = F.transform(F.array(pair), lambda p: F.struct(p.alias("p"), F.transform(p, lambda x: x["gap"] + x["len"]).alias("s")))
    blocks = F.transform(
        bound,
        lambda q: F.struct(
            q["p"].alias("p"),
            q["s"].alias("s"),
            F.transform(F.sequence(F.lit(0), F.floor((F.size(q["p"]) - 1) / BLOCK).cast("int")), lambda b: F.aggregate(F.slice(q["s"], b * BLOCK + 1, BLOCK), F.lit(0), lambda a, x: a + x)).alias("b"),
        ),
    )
    totals = F.transform(
        blocks,
        lambda q: F.struct(q["p"].alias("p"), q["s"].alias("s"), F.transform(q["b"], lambda _, k: F.aggregate(F.slice(q["b"], F.lit(1), k), F.lit(0), lambda a, x: a + x)).alias("t")),
    )
    located = F.transform(
        totals,
        lambda q: F.transform(
            q["p"],
            lambda p, i: F.struct(
                (F.element_at(q["t"], F.floor(i / BLOCK).cast("int") + 1) + _before(q["s"], i) + p["gap"]).alias("start"),
                number.alias("kind"),
                (F.element_at(q["t"], F.floor(i / BLOCK).cast("int") + 1) + _before(q["s"], i) + p["gap"] + p["len"]).alias("end"),
                p["hit"].alias("hit"),
            ),
        ),
    )
    found = F.element_at(located, 1)
    if kind == "assign":
        found = F.filter(found, lambda s: F.char_length(F.regexp_extract(s["hit"], ASSIGN, 2)) >= 6)
    elif kind == "access":
        found = F.filter(found, lambda s: s["end"] - s["start"] >= 20)
    elif kind == "opaque":
        found = F.filter(found, lambda s: (s["end"] - s["start"] >= 16) & s["hit"].rlike("[A-Za-z]"))
    found = F.transform(found, lambda s: F.struct(s["start"], s["kind"], s["end"]))
    test = text.rlike(PATTERNS[kind]) if kind not in HINTS else text.contains("AKIA") if kind == "access" else text.rlike(HINTS[kind]) & text.rlike(PATTERNS[kind])
    return F.when(test, found).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int>>"))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(df: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, base (strong spans), spans (these and the linked weak ones), both sorted arrays of (start, kind, end), and the columns in keep."""
    raw = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(F.col(doc_id).alias("_id"), raw.alias("_text"), F.xxhash64(raw).alias("_h1"), F.xxhash64(raw, F.lit(7)).alias("_h2"), F.struct(*(F.col(c) for c in keep)).alias("_kept") if keep else F.lit(None).alias("_kept"))
    rows = rows.select("_id", "_h1", "_h2", "_kept", *(_located(F.col("_text"), k).alias(k) for k in KINDS))
    rows = rows.select("_id", "_h1", "_h2", *(["_kept"] if keep else []), F.sort_array(F.concat(*KINDS[:STRONG])).alias("base"), F.concat(*KINDS[STRONG:]).alias("weak"))
    rows = written(rows, "secret-spans")

    role = F.element_at(F.array(*(F.lit(ROLES[k]) for k in KINDS)), F.col("s.kind") + 1)
    key = ["_id", "_h1", "_h2"]
    lone = F.coalesce((F.size("weak") == 0) | (F.size("weak") + F.size("base") == 1), F.lit(True))
    several = rows.filter(~lone)
    parts = several.select(*key, F.explode(F.concat("base", "weak")).alias("s")).withColumn("role", role).distinct()
    bins = lambda low, high: F.explode(F.sequence(F.floor(low / BIN), F.floor(high / BIN)))
    strong = parts.filter(F.col("s.kind") < STRONG)
    taken = strong.select(*(F.col(k).alias(f"w{k}") for k in key), F.col("s.start").alias("w_start"), F.col("s.end").alias("w_end"))
    taken = taken.withColumn("w_bin", bins(F.col("w_start"), F.col("w_end") - 1))
    weak = parts.filter(F.col("s.kind") >= STRONG).withColumn("bin", bins(F.col("s.start"), F.col("s.end") - 1))
    same = F.col("_id").eqNullSafe(F.col("w_id")) & (F.col("_h1") == F.col("w_h1")) & (F.col("_h2") == F.col("w_h2")) & (F.col("bin") == F.col("w_bin"))
    covered = weak.join(taken, same & (F.col("w_start") < F.col("s.end")) & (F.col("s.start") < F.col("w_end")), "left_semi").select(*key, "s", "role").distinct()
    free = written(parts.filter(F.col("s.kind") >= STRONG).subtract(covered), "secret-candidates")

    wide = strong.unionByName(free).select(*(F.col(k).alias(f"w{k}") for k in key), F.col("role").alias("w_role"), F.col("s.start").alias("w_start"), F.col("s.end").alias("w_end"))
    wide = wide.withColumn("w_bin", bins(F.col("w_start") - SCOPE, F.col("w_end") + SCOPE))
    weak = free.withColumn("bin", bins(F.col("s.start"), F.col("s.end")))
    met = (F.col("s.start") - SCOPE <= F.col("w_end")) & (F.col("w_start") <= F.col("s.end") + SCOPE)
    fits = F.when(F.col("role") == "secret", F.col("w_role") != "secret").otherwise(F.col("w_role") == "secret")
    linked = weak.join(wide, same & met & fits, "left_semi").select(*key, "s").distinct().groupBy(*key).agg(F.collect_list("s").alias("linked"))

    out = [F.col("_id").alias("doc_id"), F.col("base")] + ([F.col("_kept")] if keep else [])
    joined = several.join(linked.toDF("r_id", "r_h1", "r_h2", "linked"), F.col("_id").eqNullSafe(F.col("r_id")) & (F.col("_h1") == F.col("r_h1")) & (F.col("_h2") == F.col("r_h2")), "left")
    both = F.sort_array(F.concat("base", F.coalesce("linked", F.array().cast("array<struct<start:int,kind:int,end:int>>"))))
    result = rows.filter(lone).select(*out, F.col("base").alias("spans")).unionByName(joined.select(*out, both.alias("spans")))
    return result.select("doc_id", "base", "spans", *(F.col("_kept").getField(c).alias(f"kept_{c}") for c in keep))


def secret_report(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked: one row for each row of df."""
    found = find_secrets(df, text, doc_id)
    of = lambda k: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return found.select("doc_id", of("assign"), of("access"), of("hex"), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_linked"))


def redact(df: DataFrame, text: str = "text", doc_id: str = "doc_id", mask: str = "[secret]") -> DataFrame:
    """df with every reported span of its texts replaced by mask; texts without spans stay as they are, null stays null."""
    columns = df.columns
    found = find_secrets(df, text, doc_id, keep=tuple(columns))
    body = F.col(f"kept_{text}")
    new = F.when(F.size("spans") > 0, _bound(_merged(F.col("spans")), lambda m: _masked(body, m, mask))).otherwise(body)
    return found.select(*(new.alias(c) if c == text else F.col(f"kept_{c}").alias(c) for c in columns))


def _bound(value: Column, use) -> Column:  # noqa: ANN001
    """use(value), with value made once a row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _merged(spans: Column) -> Column:
    """Sorted spans as (start, end) with those that overlap joined: by running maxima of the ends, made by blocks."""
    size, none = 64, F.array().cast("array<int>")

    def joined(s: Column) -> Column:
        ends = F.transform(s, lambda x: x["end"])
        tops = F.transform(F.sequence(F.lit(0), F.floor((F.size(s) - 1) / size).cast("int")), lambda b: F.array_max(F.transform(F.slice(s, b * size + 1, size), lambda x: x["end"])))
        tops = _bound(tops, lambda t: F.transform(t, lambda _, k: F.coalesce(F.array_max(F.slice(t, F.lit(1), k)), F.lit(-1))))
        # the greatest end before each span
        before = lambda t, e: F.transform(s, lambda x, i: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.greatest(F.element_at(t, F.floor(i / size).cast("int") + 1), F.coalesce(F.array_max(F.when(i % size > 0, F.slice(e, i - i % size + 1, i % size)).otherwise(none)), F.lit(-1))).alias("upto")))
        return _bound(ends, lambda e: _bound(tops, lambda t: _bound(before(t, e), islands)))

    def islands(r: Column) -> Column:
        first = F.filter(r, lambda x: x["start"] >= x["upto"])
        last = F.concat(F.slice(F.transform(first, lambda x: x["upto"]), F.lit(2), F.size(first)), F.array(F.array_max(F.transform(r, lambda x: F.greatest(x["end"], x["upto"])))))
        return F.zip_with(first, last, lambda a, b: F.struct(a["start"].alias("start"), b.alias("end")))

    return _bound(spans, joined)


def _masked(body: Column, spans: Column, mask: str, size: int = 64) -> Column:
    """body with each of the disjoint spans replaced. It is cut into sections of some spans first, so that the search for a position never goes over the whole text."""
    end = lambda m, i: F.when(i > 0, F.element_at(m, F.greatest(i, F.lit(1)))["end"]).otherwise(F.lit(0))  # noqa: E731  of the span before the i-th

    def section(k: Column) -> Column:
        own, start = F.slice(spans, k * size + 1, size), end(spans, k * size)
        part = F.substring(body, start + 1, F.element_at(own, -1)["end"] - start)
        piece = lambda p, o, at: F.array_join(F.transform(o, lambda s, i: F.concat(F.substring(p, F.greatest(end(o, i), at) - at + 1, s["start"] - F.greatest(end(o, i), at)), F.lit(mask))), "")
        return _bound(F.struct(part.alias("p"), own.alias("o"), start.alias("at")), lambda b: piece(b["p"], b["o"], b["at"]))

    sections = F.transform(F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / size).cast("int")), section)
    return F.concat(F.array_join(sections, ""), F.substring(body, F.element_at(spans, -1)["end"] + 1, F.char_length(body)))


def oracle_sql() -> str:
    """The same report in DuckDB. Its patterns have no look-around: whole runs of characters are taken and then tested."""
    run, dots = "[A-Za-z0-9+/_]+", "[0-9.]+"
    patterns = {"assign": ASSIGN, "access": PATTERNS["access"], "hex": PATTERNS["hex"], "ident": PATTERNS["ident"], "url": r"https?://[A-Za-z0-9.-]+(?::[0-9]+)?", "ip": dots, "opaque": run}
    tests = {
        "assign": f"length(regexp_extract(hit, '{ASSIGN.replace(chr(39), chr(39) * 2)}', 2)) >= 6", "access": "length(hit) >= 20", "hex": "true", "ident": "true", "url": "true",
        "ip": r"regexp_full_match(hit, '[0-9]{1,3}(\.[0-9]{1,3}){3}')", "opaque": "length(hit) >= 16 and regexp_matches(hit, '[A-Za-z]') and regexp_matches(hit, '[0-9]')",
    }
    kinds = {"url": "endpoint", "ip": "endpoint"}
    tables = []
    for k, p in patterns.items():
        p = p.replace("'", "''")
        tables.append(f"""
u_{k} as (select rid, unnest(regexp_extract_all(body, '{p}')) as hit, unnest(string_split_regex(body, '{p}')) as gap, generate_subscripts(string_split_regex(body, '{p}'), 1) as i from t where regexp_matches(body, '{p}')),
s_{k} as (select rid, {KINDS.index(kinds.get(k, k))} as kind, hit, (sum(length(gap) + length(hit)) over (partition by rid order by i))::bigint as stop from u_{k} where hit is not null),
f_{k} as (select rid, kind, stop - length(hit) as start, stop from s_{k} where {tests[k]})""")
    named = f"({KINDS})[kind + 1] || ':' || start || ':' || stop"
    role = "({})[{}.kind + 1]"
    roles = str([ROLES[k] for k in KINDS])
    return f"""with t as (select row_number() over () as rid, doc_id, coalesce(text, '') as body from documents),{",".join(tables)},
base as (select * from f_assign union all select * from f_access union all select * from f_hex),
ips as (select * from f_ip i where not exists (select 1 from f_url u where u.rid = i.rid and u.start < i.stop and i.start < u.stop)),
weak as (select * from (select * from f_ident union all select * from f_url union all select * from ips union all select * from f_opaque) w where not exists (select 1 from base b where b.rid = w.rid and b.start < w.stop and w.start < b.stop)),
parts as (select * from base union all select * from weak),
linked as (select * from weak w where exists (select 1 from parts p where p.rid = w.rid and w.start - {SCOPE} <= p.stop and p.start <= w.stop + {SCOPE} and ({role.format(roles, 'w')} = 'secret') <> ({role.format(roles, 'p')} = 'secret'))),
b as (select rid, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access, count(*) filter (kind = 2) as n_hex, string_agg({named}, ',' order by start, kind) as listed from base group by rid),
a as (select rid, string_agg({named}, ',' order by start, kind) as listed, count(*) filter (kind >= {STRONG}) as n from (select * from base union all select * from linked) group by rid)
select doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access, coalesce(n_hex, 0)::bigint as n_hex, sha256(coalesce(b.listed, '')) as base_sha256, coalesce(a.listed, '') as spans, coalesce(a.n, 0)::bigint as n_linked
from t left join b on t.rid = b.rid left join a on t.rid = a.rid"""
