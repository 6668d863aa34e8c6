"""Caption text metrics as Column expressions."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The punctuation, stop words, style terms and issue patterns of the caption rules.
PUNCTUATION = ".,!?;:()[]{}\"'-"
STOPWORDS = ["a", "an", "the", "is", "are", "was", "were", "in", "on", "at", "to", "for", "of", "with", "and", "or"]
STYLE_2D = ["2d", "animated", "cartoon", "cel", "shaded", "western", "animation", "drawn", "illustrated", "anime", "lineart", "flat"]
STYLE_3D = ["3d", "pixar", "rendered", "cgi", "smooth", "shading", "lighting", "studio", "realistic", "digital", "pbr"]
ISSUE_PATTERNS = [
    ("too_short", r"^.{0,20}$"),
    ("no_description", r"^[a-z_]+$"),
    ("placeholder", r"(placeholder|todo|fixme|xxx)"),
    ("url_present", r"https?://"),
    ("excessive_punctuation", r"[!?]{3,}"),
    ("all_caps", r"^[A-Z\s,]+$"),
]
VALIDATION_PATTERNS = [
    (r"\bvery\s+very\b|\breally\s+really\b|\bextremely\s+extremely\b|\babsolutely\s+absolutely\b", "Repeated intensifier"),
    (r"[.!?]{2,}", "Multiple punctuation"),
    (r"\s{2,}", "Multiple spaces"),
    (r"^[a-z]", "Doesn't start with capital"),
    (r"(\A|[^\p{L}\p{M}\p{N}_])[A-Z]{3,}(\z|[^\p{L}\p{M}\p{N}_])", "ALL CAPS words"),
    (r"(?i)\b(beautiful|gorgeous|stunning|amazing)\b", "Overused adjective"),
    (r"\d{4,}", "Long number sequence"),
]
#: Texts without any of a pattern's hints don't match it; the test costs less than the pattern.
HINTS = {"Repeated intensifier": "(?:ver|reall|extremel|absolutel)y\\s", "ALL CAPS words": "[A-Z]{3}"}
FORBIDDEN = ["anime", "manga", "cartoon", "image", "picture", "photo", "screenshot", "hd", "4k", "8k", "high resolution", "masterpiece", "best quality"]
#: White space as Python has it, and word characters, in the classes that all engines read alike.
SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
WORD = r"a-zA-Z0-9_\p{L}\p{M}\p{N}"
MIN_TOKENS, OPTIMAL_MIN, OPTIMAL_MAX, MAX_TOKENS = 10, 40, 77, 150


def bound(value: Column, use) -> Column:  # noqa: ANN001
    """use(value) with value computed once a row, however often use names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def split_words(text: Column) -> Column:
    """Words between white space; none for an empty text."""
    return F.array_remove(F.split(text, f"{SPACE}+"), "")


def caption_words(text: Column) -> Column:
    """Words between white space and punctuation marks."""
    return F.array_remove(F.split(text, f"[{re.escape(PUNCTUATION)}{SPACE[1:-1]}]+"), "")


def sd_tokens(text: Column) -> Column:
    """Rough diffusion-model token estimate: words and one for each 8 characters."""
    return F.size(caption_words(text)) + F.floor(F.char_length(text) / 8)


def pattern_tokens(text: Column) -> Column:
    """Count of Unicode words and single other marks."""
    return F.size(F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\w+|[^\w\s\x1c-\x1f]"), F.lit(0)))


def quarter_tokens(text: Column) -> Column:
    return F.floor(F.char_length(text) / 4) + 1


def list_tokens(text: Column) -> Column:
    """Words after commas and dots became spaces."""
    return F.size(F.array_remove(F.split(text, f"[,.{SPACE[1:-1]}]+"), ""))


def content_words(text: Column) -> Column:
    """Lower-case caption words of two characters or more that are not stop words."""
    return F.filter(caption_words(F.lower(text)), lambda w: (F.char_length(w) > 1) & ~w.isin(STOPWORDS))


def style(text: Column, low: Column | None = None) -> Column:
    low = F.lower(text) if low is None else low
    flat, solid = (reduce(or_, (low.contains(t) for t in terms)) for terms in (STYLE_2D, STYLE_3D))
    return F.when(flat & solid, "mixed").when(solid, "3d").when(flat, "2d").otherwise("unknown")


def first_repeated(words: Column, over: int, min_chars: int) -> Column:
    """The earliest word of over min_chars characters that occurs more than `over` times; null if none.

    Equal words are neighbours in the sorted words, so one pass over neighbours at distance `over` finds them.
    """
    placed = F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("at")))
    placed = F.sort_array(F.filter(placed, lambda p: F.char_length(p["word"]) > min_chars))

    def least(p: Column) -> Column:
        later = F.slice(p, over + 1, F.greatest(F.size(p), F.lit(1)))
        return F.array_min(F.zip_with(p, later, lambda a, b: F.when(a["word"] == b["word"], F.struct(a["at"].alias("at"), a["word"].alias("word")))))

    return bound(placed, least)["word"]


def caption_issues(text: Column, words: Column | None = None, tokens: Column | None = None) -> Column:
    """Names of all failed caption checks, in the order of the checks; patterns ignore case.

    words: the caption words of the lower-case text, and tokens: the estimate, where they have been made before.
    """
    tokens = sd_tokens(text) if tokens is None else tokens
    repeated = first_repeated(caption_words(F.lower(text)) if words is None else words, 3, 3)
    found = [F.when(text.rlike(f"(?i){p}"), F.lit(name)) for name, p in ISSUE_PATTERNS]
    length = F.when(tokens > 100, F.lit("too_long")).when(tokens < 10, F.lit("too_short"))
    return F.array_compact(F.array(*found, length, F.concat(F.lit("word_repeated:"), repeated)))


def validation_issues(text: Column, trigger: str | None = None, tokens: Column | None = None, low: Column | None = None) -> Column:
    """Issues of the stricter validator, in the order of its checks; tokens and the lower-case text where they have been made before."""
    tokens = pattern_tokens(text) if tokens is None else tokens
    low = F.lower(text) if low is None else low
    checks = []
    if trigger:
        at = F.locate(trigger.lower(), low) - 1
        checks.append(F.when(at > 20, "Trigger word not at beginning").when(at < 0, "Missing trigger word"))
    named = lambda label: F.concat(F.lit(f"{label} ("), tokens.cast("string"), F.lit(" tokens)"))
    checks.append(
        F.when(tokens < MIN_TOKENS, named("Too short"))
        .when(tokens < OPTIMAL_MIN, named("Below optimal length"))
        .when(tokens > MAX_TOKENS, named("Too long"))
        .when(tokens > OPTIMAL_MAX, named("Above optimal length"))
    )
    checks += [F.when(text.rlike(HINTS[name]) & text.rlike(p) if name in HINTS else text.rlike(p), F.lit(name)) for p, name in VALIDATION_PATTERNS]
    checks += [F.when(low.contains(w), F.lit(f"Contains '{w}' (avoid style/quality tags)")) for w in FORBIDDEN]
    checks.append(F.when(text.rlike(r"\A\s|\s\z"), "Leading/trailing whitespace"))
    checks.append(F.when(text.contains("  "), "Double spaces"))
    checks.append(F.when(text.endswith(","), "Ends with comma"))
    checks.append(F.concat(F.lit("Repeated words: "), first_repeated(split_words(low), 2, 3)))
    return F.array_compact(F.array(*checks))


def validation_score(tokens: Column, issues: Column, has_trigger: Column | None = None, trigger_at: Column | None = None) -> Column:
    """100 less the penalties for length, trigger and issues, kept within 0 and 100."""
    length = F.when(tokens < MIN_TOKENS, 30).when(tokens < OPTIMAL_MIN, 15).when(tokens > MAX_TOKENS, 25).when(tokens > OPTIMAL_MAX, 10).otherwise(0)
    trigger = F.lit(0) if has_trigger is None else F.when(~has_trigger, 20).when(trigger_at > 20, 10).otherwise(0)
    return F.greatest(F.lit(0), F.least(F.lit(100), 100 - length - trigger - F.least(F.lit(40), F.size(issues) * 5))).cast("double")


def fix_caption(text: Column, trigger: str | None = None) -> Column:
    """White space, repeated marks, trigger, first capital and a last comma put right."""
    fixed = F.regexp_replace(text, r"\A\s+|\s+\z", "")
    fixed = F.when(fixed.contains("  "), F.regexp_replace(fixed, r"\s+", " ")).otherwise(fixed)
    for mark in (r"\.", "!", r"\?"):
        fixed = F.regexp_replace(fixed, f"{mark}{{2,}}", mark[-1])
    if trigger:
        fixed = F.when(F.lower(fixed).contains(trigger.lower()), fixed).otherwise(F.concat(F.lit(f"{trigger}, "), fixed))
    fixed = F.concat(F.upper(F.substring(fixed, 1, 1)), F.substring(fixed, 2, 1 << 30))
    return F.regexp_replace(fixed, r",\z", "")


def normalized_caption(text: Column) -> Column:
    """White space collapsed, spaces and commas taken off both ends."""
    return F.regexp_replace(F.regexp_replace(text, r"\s+", " "), r"\A[ ,]+|[ ,]+\z", "")


def with_prefix(text: Column, trigger: str) -> Column:
    """`trigger, ` put in front unless the caption begins with it."""
    bare, low = F.trim(text), F.lower(F.trim(text))
    t = trigger.lower()
    begins = low.startswith(f"{t},") | low.startswith(f"{t} ") | low.startswith(f"a 3d animated character, {t}")
    return F.when(begins, bare).otherwise(F.concat(F.lit(f"{trigger}, "), bare))
