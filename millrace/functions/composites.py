"""Weighted scores of evaluations and curation as Column expressions, with their own weights and fallbacks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The weights of the ensemble; the aesthetics score is of 10 and is divided by that first.
ENSEMBLE = {"aesthetics": 0.30, "brisque": 0.15, "face": 0.20, "sharpness": 0.10, "lighting": 0.10, "contrast": 0.05, "pose": 0.05, "character": 0.05}
SHOT_WORDS = [("close-up", ["close", "portrait", "face"]), ("full-body", ["full body", "full-body", "standing"]), ("medium", ["medium", "waist"]), ("far-shot", ["far", "distant", "wide"])]
FRAMING = {"full_body": 1.0, "three_quarter_body": 0.8, "medium": 0.4, "close_up": 0.1, "unknown": 0.3}
FRAMING_WORDS = [("full_body", ["full body", "full-body"]), ("three_quarter_body", ["three-quarter body", "3/4 body", "three quarter body"]), ("medium", ["medium shot", "waist up"]), ("close_up", ["close-up", "close up"])]


def zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def any_of(text: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | text.contains(w)
    return out


def aggregate_score(clip: Column, face: Column, diversity: Column, quality: Column) -> Column:
    """Prompt and face at 0.35 each, diversity times 10 and quality over 100 at 0.15 each; missing ones are 0."""
    return 0.35 * zero(clip) + 0.35 * zero(face) + 0.15 * (zero(diversity) * 10) + 0.15 * (zero(quality) / 100)


def checkpoint_score(clip: Column, consistency: Column, quality: Column) -> Column:
    return 0.4 * clip + 0.3 * consistency + 0.3 * quality


def composite_score(prompt: Column, clip: Column, consistency: Column, aesthetic: Column, quality: Column, diversity: Column) -> Column:
    """Prompt alignment (the better model's score, else the plain one) 0.30, consistency 0.25, aesthetics (else quality) 0.20, quality 0.15, diversity 0.10."""
    return 0.30 * zero(F.coalesce(prompt, clip)) + 0.25 * zero(consistency) + 0.20 * zero(F.coalesce(aesthetic, quality)) + 0.15 * zero(quality) + 0.10 * zero(diversity)


def ensemble_score(values: dict[str, Column]) -> Column:
    """Eight scores of 0 to 1 (aesthetics of 10) by their weights, times 10, kept within 0 and 10."""
    total = F.lit(0.0)
    for name, weight in ENSEMBLE.items():
        total = total + (values[name] / 10 if name == "aesthetics" else values[name]) * weight
    return F.greatest(F.lit(0.0), F.least(F.lit(10.0), total / sum(ENSEMBLE.values()) * 10))


def shot_category(caption: Column, complexity: Column, quality: Column) -> Column:
    """Category by the first keywords that the caption has, else by complexity and quality."""
    low = F.lower(caption)
    by_word = F.coalesce(*(F.when(any_of(low, words), F.lit(name)) for name, words in SHOT_WORDS))
    by_look = F.when((complexity > 0.6) & (quality < 0.6), "far-shot").when((quality > 0.7) & (complexity < 0.3), "close-up").when((complexity > 0.3) & (complexity < 0.6), "medium").otherwise("full-body")
    return F.coalesce(by_word, by_look)


def curation_score(quality: Column, sharpness: Column, lighting: Column, contrast: Column, category: Column) -> Column:
    """Weighted quality, and a tenth more for the categories that are rare."""
    return quality * 0.4 + sharpness * 0.3 + lighting * 0.2 + contrast * 0.1 + F.when(category.isin("far-shot", "medium"), 0.1).otherwise(0.0)


def framing(prompt: Column) -> Column:
    low = F.lower(prompt)
    return F.coalesce(*(F.when(any_of(low, words), F.lit(name)) for name, words in FRAMING_WORDS), F.lit("unknown"))


def framing_score(kind: Column) -> Column:
    return F.coalesce(*(F.when(kind == name, F.lit(weight)) for name, weight in FRAMING.items()), F.lit(0.3))


def pair_image_score(edges: Column, corners: Column, kind: Column) -> Column:
    """Sharpness up to 2, framing times 1.5, less up to 1.5 for a busy background."""
    return F.least(edges / 25.0, F.lit(2.0)) + framing_score(kind) * 1.5 - F.least(corners / 40.0, F.lit(1.5))


def intensity_level(score: Column, emotion: Column) -> Column:
    return F.when(emotion == "neutral", "moderate").when(score < 0.35, "subtle").when(score < 0.65, "moderate").otherwise("strong")


# Names of expressions with their aliases, and the pairs that are alike.
EXPRESSIONS = {
    "happy": ["joy", "smile", "excited"], "sad": ["sadness", "sorrow"], "angry": ["anger", "mad"], "surprised": ["surprise", "shock"], "fearful": ["fear", "afraid", "scared"],
    "disgusted": ["disgust", "revulsion"], "neutral": ["calm", "relaxed"],
}
ALIKE = {("happy", "excited"): 0.7, ("sad", "fearful"): 0.5, ("angry", "disgusted"): 0.5, ("surprised", "fearful"): 0.4}


def expression_name(label: Column) -> Column:
    """The standard name of an expression: lower case, trimmed, aliases replaced."""
    plain = F.lower(F.trim(label))
    return F.coalesce(*(F.when(plain.isin(aliases), F.lit(name)) for name, aliases in EXPRESSIONS.items()), plain)


def expression_similarity(detected: Column, expected: Column, scores: Column) -> Column:
    """1 for equal names, a fixed share for alike pairs in either order, else the score that was found for the expected name (0 without one)."""
    a, b = expression_name(detected), expression_name(expected)
    pair = F.concat_ws("|", F.least(a, b), F.greatest(a, b))
    alike = F.coalesce(*(F.when(pair == "|".join(sorted(names)), F.lit(share)) for names, share in ALIKE.items()))
    return F.when(a == b, F.lit(1.0)).otherwise(F.coalesce(alike, F.try_element_at(scores, b), F.lit(0.0)))


def luma(red: Column, green: Column, blue: Column) -> Column:
    return 0.2126 * red + 0.7152 * green + 0.0722 * blue


def training_parameters(images: Column, kind: Column, universal: bool = False) -> Column:
    """struct(epochs, save_every, dim, alpha) by type and image count. Dimensions and base epochs of the types."""
    dims, base = ({"pose": 128, "action": 160}, {"pose": 30}) if universal else ({"pose": 112, "action": 128}, {"pose": 20})
    rest_dim, rest_base = (112, 35) if universal else (96, 25)
    dim = F.coalesce(*(F.when(kind == k, F.lit(v)) for k, v in dims.items()), F.lit(rest_dim))
    first = F.coalesce(*(F.when(kind == k, F.lit(v)) for k, v in base.items()), F.lit(rest_base))
    epochs = F.when(images < 100, F.greatest(first + 10, F.lit(30))).when(images < 300, first + 5).when(images > 1000, first - 5).otherwise(first)
    return F.struct(epochs.alias("epochs"), F.greatest(F.lit(2), F.floor(epochs / 10).cast("int")).alias("save_every"), dim.alias("dim"), F.floor(dim / 2).cast("int").alias("alpha"))


def run_parameters(images: Column, model: str = "sdxl", target: int = 2000, memory_gb: int = 24) -> Column:
    """struct(batch, epochs, repeats, steps) for a target of steps; repeats are rounded half to even and 1 at least."""
    batch = (2 if memory_gb >= 24 else 1) if model == "sdxl" else 4 if memory_gb >= 16 else 2 if memory_gb >= 8 else 1
    epochs = F.when(images < 50, 20).when(images < 100, 15).when(images < 200, 10).when(images < 500, 8).otherwise(6)
    repeats = F.greatest(F.lit(1), F.bround(F.lit(float(target * batch)) / (images * epochs), 0).cast("long"))
    return F.struct(F.lit(batch).alias("batch"), epochs.alias("epochs"), repeats.alias("repeats"), (F.floor(images * repeats / batch).cast("long") * epochs).alias("steps"))
