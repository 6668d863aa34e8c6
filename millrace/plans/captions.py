"""Caption queries: documents are captions, source is the character, lang the model type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.plans.registry import query
from millrace.session import spread, table

_CLEAN = """translate({0}, '.,!?;:()[]{{}}"''-', repeat(' ', 15))"""
_WORDS = rf"list_filter(string_split_regex({{0}}, '{T.SPACE.replace('{', '{{').replace('}', '}}')}+'), lambda w: w <> '')"


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"))


def words_sql(text: str) -> str:
    return _WORDS.format(_CLEAN.format(text))


def plain_words_sql(text: str) -> str:
    return _WORDS.format(text)


TOKENS_SQL = rf"len(regexp_extract_all(lower(text), '[{T.WORD}]+|[^{T.WORD}{T.SPACE[1:-1]}]'))"
SD_SQL = f"(len({words_sql('text')}) + length(text) // 8)"


def _has_any(terms: list[str]) -> str:
    return "(" + " or ".join(f"contains(lower(text), '{t}')" for t in terms) + ")"


STYLE_SQL = f"case when {_has_any(T.STYLE_2D)} and {_has_any(T.STYLE_3D)} then 'mixed' when {_has_any(T.STYLE_3D)} then '3d' when {_has_any(T.STYLE_2D)} then '2d' else 'unknown' end"


@query(f"""
select doc_id, len({plain_words_sql('text')})::bigint as n_words, {SD_SQL}::bigint as sd_tokens, {TOKENS_SQL}::bigint as pattern_tokens,
  (length(text) // 4 + 1)::bigint as quarter_tokens, len({_WORDS.format("translate(text, ',.', '  ')")})::bigint as list_tokens,
  {STYLE_SQL} as style, md5(lower(text)) as digest, contains(lower(text), 'the') as has_trigger
from documents""")
def caption_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    rows = _docs(spark, sf_dir).select("doc_id", "text", F.lower("text").alias("low"))
    return rows.select(
        "doc_id", F.size(T.split_words(t)).cast("long").alias("n_words"), T.sd_tokens(t).cast("long").alias("sd_tokens"), T.pattern_tokens(t).cast("long").alias("pattern_tokens"),
        T.quarter_tokens(t).cast("long").alias("quarter_tokens"), T.list_tokens(t).cast("long").alias("list_tokens"), T.style(t, F.col("low")).alias("style"), F.md5("low").alias("digest"),
        F.col("low").contains("the").alias("has_trigger"),
    )


_REPEATED_SQL = """
{name} as (
  select doc_id, min_by(w, first_at) as word from (
    select doc_id, w, count(*) as n, min(spot) as first_at from (
      select doc_id, unnest(ws) as w, generate_subscripts(ws, 1) as spot from (select doc_id, {words} as ws from documents)
    ) group by doc_id, w
  ) where n > {over} and length(w) > 3 group by doc_id
)"""
_ISSUES_CTE = "with " + _REPEATED_SQL.format(name="rep", words=words_sql("lower(text)"), over=3) + """,
issues as (
  select d.doc_id, source, lang, list_filter([""" + ", ".join(f"case when regexp_matches(text, '(?i){p}') then '{n}' end" for n, p in T.ISSUE_PATTERNS) + f""",
    case when {SD_SQL} > 100 then 'too_long' when {SD_SQL} < 10 then 'too_short' end, 'word_repeated:' || rep.word], lambda x: x is not null) as issues
  from documents d left join rep on d.doc_id = rep.doc_id
)"""


def _issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _docs(spark, sf_dir).select("doc_id", "source", "lang", "text", T.caption_words(F.lower("text")).alias("words"))
    tokens = F.size("words") + F.floor(F.char_length("text") / 8)  # as many words as in the text as it is
    rows = rows.withColumn("tokens", tokens)
    return rows.select("doc_id", "source", "lang", T.caption_issues(F.col("text"), F.col("words"), F.col("tokens")).alias("issues"))


@query(_ISSUES_CTE + " select doc_id, len(issues)::bigint as n_issues, array_to_string(issues, '; ') as issues from issues")
def caption_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _issues(spark, sf_dir).select("doc_id", F.size("issues").cast("long").alias("n_issues"), F.array_join("issues", "; ").alias("issues"))


@query(_ISSUES_CTE + """
select issue, count(*)::bigint as n from (select split_part(unnest(issues), ':', 1) as issue from issues) group by issue order by n desc, issue limit 10""")
def issue_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = _issues(spark, sf_dir).select(F.explode("issues").alias("issue")).select(F.split("issue", ":")[0].alias("issue"))
    return named.groupBy("issue").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "issue").limit(10)


def _quoted(s: str) -> str:
    return s.replace("'", "''")


_VALID_CTE = "with " + _REPEATED_SQL.format(name="rep", words=plain_words_sql("lower(text)"), over=2) + f""",
tok as (select *, {TOKENS_SQL} as tokens from documents),
valid as (
  select d.doc_id, source, lang, tokens, list_filter([
    case when tokens < 10 then 'Too short (' || tokens || ' tokens)' when tokens < 40 then 'Below optimal length (' || tokens || ' tokens)'
         when tokens > 150 then 'Too long (' || tokens || ' tokens)' when tokens > 77 then 'Above optimal length (' || tokens || ' tokens)' end,
    """ + ", ".join(f"case when regexp_matches(text, '{p}') then '{_quoted(n)}' end" for p, n in T.VALIDATION_PATTERNS) + ", " + ", ".join(
    f"case when contains(lower(text), '{w}') then 'Contains ''{w}'' (avoid style/quality tags)' end" for w in T.FORBIDDEN) + r""",
    case when regexp_matches(text, '\A\s|\s\z') then 'Leading/trailing whitespace' end, case when contains(text, '  ') then 'Double spaces' end,
    case when suffix(text, ',') then 'Ends with comma' end, 'Repeated words: ' || rep.word], lambda x: x is not null) as issues
  from tok d left join rep on d.doc_id = rep.doc_id
),
scored as (select *, greatest(0, least(100, 100 - case when tokens < 10 then 30 when tokens < 40 then 15 when tokens > 150 then 25 when tokens > 77 then 10 else 0 end
  - least(40, 5 * len(issues))))::double as score from valid)"""


def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    rows = _docs(spark, sf_dir).select("doc_id", "source", "lang", "text", T.pattern_tokens(t).alias("tokens"), F.lower(t).alias("low"))
    rows = rows.select("doc_id", "source", "lang", "tokens", T.validation_issues(t, None, F.col("tokens"), F.col("low")).alias("issues"))
    return rows.withColumn("score", T.validation_score(F.col("tokens"), F.col("issues")))


@query(_VALID_CTE + " select doc_id, tokens::bigint as tokens, array_to_string(issues, '; ') as issues, score from scored")
def caption_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validated(spark, sf_dir).select("doc_id", F.col("tokens").cast("long"), F.array_join("issues", "; ").alias("issues"), "score")


@query(_VALID_CTE + """
select source, count(*)::bigint as total, count(*) filter (score >= 70)::bigint as valid, count(*) filter (tokens < 40)::bigint as short, count(*) filter (tokens > 77)::bigint as long_,
  round(avg(score), 6) as avg_score, round(avg(tokens), 6) as avg_tokens, count(*) filter (score >= 70) / count(*) < 0.8 as needs_review from scored group by source""")
def caption_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = F.count_if(F.col("score") >= 70)
    return validated(spark, sf_dir).groupBy("source").agg(
        F.count("*").alias("total"), good.alias("valid"), F.count_if(F.col("tokens") < 40).alias("short"), F.count_if(F.col("tokens") > 77).alias("long_"),
        F.round(F.avg("score"), 6).alias("avg_score"), F.round(F.avg("tokens"), 6).alias("avg_tokens"), (good / F.count("*") < 0.8).alias("needs_review"),
    )


# white space with the vertical tab, and capitals of one letter that are several: DuckDB's own \s and upper() lack them
_FIX = r"regexp_replace(text, '\A[\s\x0b]+|[\s\x0b]+\z', '', 'g')"
_FIX = rf"case when contains({_FIX}, '  ') then regexp_replace({_FIX}, '[\s\x0b]+', ' ', 'g') else {_FIX} end"
_FIX = rf"regexp_replace(regexp_replace(regexp_replace({_FIX}, '\.{{2,}}', '.', 'g'), '!{{2,}}', '!', 'g'), '\?{{2,}}', '?', 'g')"
_FIX = f"case when contains(lower({_FIX}), 'the') then {_FIX} else 'the, ' || {_FIX} end"


_LONG_CAPITALS = " ".join(f"when '{c}' then '{c.upper()}'" for c in map(chr, range(0x10000)) if len(c.upper()) > 1)


@query(rf"""
with f as (select doc_id, {_FIX} as t from documents), c as (select doc_id, regexp_replace(case t[1:1] {_LONG_CAPITALS} else upper(t[1:1]) end || t[2:], ',\z', '') as t from f)
select doc_id, md5(t) as fixed_md5, length(t)::bigint as fixed_chars from c""")
def caption_fix(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = _docs(spark, sf_dir).select("doc_id", T.fix_caption(F.col("text"), "the").alias("t"))
    return fixed.select("doc_id", F.md5("t").alias("fixed_md5"), F.char_length("t").cast("long").alias("fixed_chars"))


@query(r"select doc_id, md5(regexp_replace(regexp_replace(text, '\s+', ' ', 'g'), '\A[ ,]+|[ ,]+\z', '', 'g')) as normalized_md5, md5(case when starts_with(lower(trim(text)), 'the,') or starts_with(lower(trim(text)), 'the ') or starts_with(lower(trim(text)), 'a 3d animated character, the') then trim(text) else 'the, ' || trim(text) end) as prefixed_md5 from documents")
def caption_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return _docs(spark, sf_dir).select("doc_id", F.md5(T.normalized_caption(t)).alias("normalized_md5"), F.md5(T.with_prefix(t, "the")).alias("prefixed_md5"))


@query(f"""
with t as (select source, lang, {SD_SQL} as n from documents)
select source, lang, count(*)::bigint as total, count(*) filter (n < 20)::bigint as under_20, count(*) filter (n >= 20 and n < 40)::bigint as from_20, count(*) filter (n >= 40 and n < 60)::bigint as from_40,
  count(*) filter (n >= 60 and n < 77)::bigint as from_60, count(*) filter (n >= 77)::bigint as from_77, round(avg(n), 6) as avg_tokens, min(n)::bigint as min_tokens, max(n)::bigint as max_tokens
from t group by source, lang""")
def token_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n")
    band = lambda low, high: F.count_if((n >= low) & (n < high))
    return _docs(spark, sf_dir).select("source", "lang", T.sd_tokens(F.col("text")).alias("n")).groupBy("source", "lang").agg(
        F.count("*").alias("total"), F.count_if(n < 20).alias("under_20"), band(20, 40).alias("from_20"), band(40, 60).alias("from_40"), band(60, 77).alias("from_60"),
        F.count_if(n >= 77).alias("from_77"), F.round(F.avg("n"), 6).alias("avg_tokens"), F.min("n").cast("long").alias("min_tokens"), F.max("n").cast("long").alias("max_tokens"),
    )


@query(f"""
select word, count(*)::bigint as n from (select unnest({words_sql('lower(text)')}) as word from documents)
where length(word) > 1 and word not in ({', '.join(f"'{w}'" for w in T.STOPWORDS)}) group by word order by n desc, word limit 50""")
def word_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _docs(spark, sf_dir).select(F.explode(T.content_words(F.col("text"))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(50)


@query()
def caption_simplified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain captions; tested on stated captions and by what must hold of each."""
    from millrace.functions.simplify import simplified

    more = F.when(F.col("doc_id") % 5 == 0, ", 8K, high-resolution PBR materials , , a young Italian boy with wild, curly brown hair .  . Stunning")
    more = more.when(F.col("doc_id") % 5 == 1, ". Rendered at 4k resolution, sun-kissed tanned skin, yellow tank top, close-up, smiling").otherwise("")
    return _docs(spark, sf_dir).select("doc_id", simplified(F.concat("text", more), "alberto").alias("caption"))


@query(r"""
select doc_id, floor(len(""" + plain_words_sql("text") + r""") * 1.3 + len(regexp_extract_all(text, '[,.:;!?()]')) + (length(text) - length(replace(text, '-', ''))) * 0.5)::bigint as tokens, case when doc_id % 3 = 0 then 'misc' else 'prompt_' || lpad((doc_id % 100)::varchar, 4, '0') end as key,
  md5(concat_ws(', ', case when doc_id % 2 = 0 then 'masterpiece' end, nullif(text, ''), 'soft light')) as expanded_md5 from documents""")
def caption_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token estimate of the converter, prompt key of a name, and the caption with its prefix and details."""
    from millrace.functions import simplify as P

    name = F.concat(F.lit("/a/b/"), F.when(F.col("doc_id") % 3 == 0, "image_1_2.png").otherwise(F.concat(F.lit("prompt_"), F.lpad((F.col("doc_id") % 100).cast("string"), 4, "0"), F.lit("_img_01.png"))))
    full = P.expanded(F.col("text"), F.when(F.col("doc_id") % 2 == 0, "masterpiece").otherwise(""), F.lit("soft light"))
    return _docs(spark, sf_dir).select("doc_id", P.converter_tokens(F.col("text")).alias("tokens"), P.prompt_key(name).alias("key"), F.md5(full).alias("expanded_md5"))


_GROUP_CTE = _ISSUES_CTE.replace("issues as (", "named as (", 1) + f""",
m as (select d.doc_id, d.source, {SD_SQL} as tokens, contains(lower(text), 'the') as has_trigger, {STYLE_SQL} as style, md5(lower(text)) as digest, len(i.issues) as n_issues from documents d join named i on d.doc_id = i.doc_id),
u as (select source, count(*) filter (n > 1) as duplicates from (select source, digest, count(*) as n from m group by source, digest) group by source),
y as (select source, any_value(style order by n desc, style) as top, max(n) as most, count(*) as kinds from (select source, style, count(*) as n from m group by source, style) group by source),
g as (select source, count(*) as captions, avg(tokens) as mean, stddev_pop(tokens) as std, avg(has_trigger::int) as trigger_rate, sum(n_issues) as issues from m group by source),
q as (select g.source, captions, mean, trigger_rate, duplicates, issues, case when kinds = 1 then top when most / captions > 0.8 then 'mostly_' || top else 'mixed' end as style,
  greatest(0, least(100, 100.0 - least(30, issues / captions * 10) - case when trigger_rate < 0.9 then (1 - trigger_rate) * 20 else 0 end - least(20, duplicates / captions * 50) - case when std > 20 then 10 else 0 end)) as score,
  (mean > 77)::int + (mean < 20)::int + (trigger_rate < 0.9)::int + (duplicates > 0)::int as complaints from g join u using (source) join y using (source))"""


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Caption statistics and score of each source."""
    t, low = F.col("text"), F.col("low")
    m = _docs(spark, sf_dir).select("source", "text", F.lower("text").alias("low")).withColumn("words", T.caption_words(low))
    m = m.withColumn("tokens", F.size("words") + F.floor(F.char_length("text") / 8))
    m = m.select("source", "tokens", low.contains("the").alias("has_trigger"), T.style(t, low).alias("style"), F.md5("low").alias("digest"), F.size(T.caption_issues(t, F.col("words"), F.col("tokens"))).alias("n_issues"))
    g = m.groupBy("source").agg(F.count("*").alias("captions"), F.avg("tokens").alias("mean"), F.stddev_pop("tokens").alias("std"), F.avg(F.col("has_trigger").cast("int")).alias("trigger_rate"), F.sum("n_issues").alias("issues"))
    u = m.groupBy("source", "digest").agg(F.count("*").alias("n")).groupBy("source").agg(F.count_if(F.col("n") > 1).alias("duplicates"))
    y = m.groupBy("source", "style").agg(F.count("*").alias("n")).groupBy("source").agg(F.min_by("style", F.struct(-F.col("n"), "style")).alias("top"), F.max("n").alias("most"), F.count("*").alias("kinds"))
    c = F.col
    q = g.join(u, "source").join(y, "source")
    style = F.when(c("kinds") == 1, c("top")).when(c("most") / c("captions") > 0.8, F.concat(F.lit("mostly_"), "top")).otherwise("mixed")
    missing = F.when(c("trigger_rate") < 0.9, (1 - c("trigger_rate")) * 20).otherwise(0.0)
    score = 100.0 - F.least(F.lit(30.0), c("issues") / c("captions") * 10) - missing - F.least(F.lit(20.0), c("duplicates") / c("captions") * 50) - F.when(c("std") > 20, 10).otherwise(0)
    complaints = sum(((c("mean") > 77).cast("int"), (c("mean") < 20).cast("int"), (c("trigger_rate") < 0.9).cast("int"), (c("duplicates") > 0).cast("int")), F.lit(0))
    return q.select("source", "captions", "mean", "trigger_rate", "duplicates", "issues", style.alias("style"), F.greatest(F.lit(0.0), F.least(F.lit(100.0), score)).alias("score"), complaints.alias("complaints"))


@query(_GROUP_CTE + " select source, captions::bigint as captions, round(mean, 6) as mean_tokens, round(trigger_rate, 6) as trigger_rate, duplicates::bigint as duplicates, issues::bigint as issues, style, round(score, 6)::double as score, complaints::int as complaints from q")
def caption_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Caption quality of each source: tokens, trigger rate, duplicates, style, and a score of 0 to 100."""
    return _groups(spark, sf_dir).select(
        "source", "captions", F.round("mean", 6).alias("mean_tokens"), F.round("trigger_rate", 6).alias("trigger_rate"), "duplicates", "issues", "style", F.round("score", 6).alias("score"), "complaints"
    )


@query(_GROUP_CTE + """,
t as (select 'total' as ranking, null as source, count(*)::int as place, round(avg(score), 1)::double as value, sum(captions)::bigint as captions, sum(duplicates)::bigint as duplicates from q),
r as (select 'best' as ranking, source, row_number() over (order by round(score, 6) desc, source)::int as place, round(score, 1)::double as value, captions::bigint as captions, duplicates::bigint as duplicates from q
  union all select 'worst', source, row_number() over (order by round(score, 6), source), round(score, 1), captions, duplicates from q union all select 'issues', source, row_number() over (order by complaints desc, source), complaints, captions, duplicates from q where complaints > 0)
select ranking, source, place::int as place, value, captions, duplicates from (select * from t union all select * from r) where ranking = 'total' or place <= case ranking when 'best' then 20 else 10 end""")
def caption_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals over all sources, and three rankings of them: the twenty best, the ten worst, the ten with most complaints."""
    from pyspark.sql import Window

    from millrace.operators.rounds import written

    q = written(_groups(spark, sf_dir), "caption-groups")
    total = q.agg(F.count("*").cast("int").alias("place"), F.round(F.avg("score"), 1).alias("value"), F.sum("captions").alias("captions"), F.sum("duplicates").alias("duplicates"))
    out = total.select(F.lit("total").alias("ranking"), F.lit(None).cast("string").alias("source"), "place", "value", "captions", "duplicates")
    score = F.round("score", 6)
    for name, n, order, value, rows in (("best", 20, -score, F.round("score", 1), q), ("worst", 10, score, F.round("score", 1), q), ("issues", 10, -F.col("complaints"), F.col("complaints").cast("double"), q.filter("complaints > 0"))):
        top = rows.withColumn("_o", order).orderBy("_o", "source").limit(n)
        out = out.unionByName(top.select(F.lit(name).alias("ranking"), "source", F.row_number().over(Window.orderBy("_o", "source")).alias("place"), value.alias("value"), "captions", "duplicates"))
    return out
