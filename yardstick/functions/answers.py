"""Answer extraction from model output text (ANS-1..6), one ``Column`` builder per mode.

Modes (the reference uses five distinct rules in different scripts; all are kept):

``contains``   text after the last ``</reasoning>`` (any case), lowered, ``'`` removed:
               ``yes`` if it contains ``yes`` else ``no``.  Without a tag the original-case
               text is tested (so ``"Yes"`` gives ``no``).  Empty/NULL content -> NULL.
``raw_tail``   the stripped, lowered text after the last tag (quotes kept); without a tag
               the lowered text.  Empty/NULL -> NULL.
``first_tag``  text after the first tag (any case), stripped, lowered, ``'`` removed;
               ``no`` without a tag.  Success iff it equals ``yes``.
``word``       after the first case-sensitive tag (else the whole stripped text), the first
               whole word ``Yes`` or ``No``; ``Unknown`` when there is none.
``json_label`` strip ```` ```json ```` fences, parse JSON, keep ``recommendation`` when it is in
               the label table; success iff it is ``acceptable``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of, ustrip

TAG = "</reasoning>"

# The seven output labels of the JSON-answer evaluator, in enum order.
OUTPUT_LABELS = [
    "acceptable",
    "geometry_artifacts",
    "texture_lighting_color_issues",
    "wrong_orientation",
    "background_issues",
    "irrelevant_objects",
    "non_relevant_main_image",
]
ACCEPTABLE = "acceptable"


def _empty(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == F.lit("")


def _after_first_tag_lower(c: Column) -> tuple[Column, Column]:
    low = F.lower(c)
    pos = F.instr(low, TAG)
    return pos, F.substr(low, pos + len(TAG))


def contains_answer(content: Column | str) -> Column:
    c = col_of(content)
    pos, after = _after_first_tag_lower(c)
    last_tail = F.substring_index(F.replace(after, F.lit("'"), F.lit("")), TAG, -1)
    tested = F.when(pos > 0, last_tail).otherwise(c)
    return F.when(~_empty(c), F.when(tested.contains("yes"), F.lit("yes")).otherwise(F.lit("no")))


def raw_tail_answer(content: Column | str) -> Column:
    c = col_of(content)
    pos, after = _after_first_tag_lower(c)
    tail = ustrip(F.substring_index(after, TAG, -1))
    return F.when(~_empty(c), F.when(pos > 0, tail).otherwise(F.lower(c)))


def first_tag_answer(content: Column | str) -> Column:
    c = col_of(content)
    pos, after = _after_first_tag_lower(c)
    ans = F.replace(ustrip(after), F.lit("'"), F.lit(""))
    return F.when(F.coalesce(pos, F.lit(0)) > 0, ans).otherwise(F.lit("no"))


def first_tag_success(content: Column | str) -> Column:
    return ustrip(first_tag_answer(content)) == F.lit("yes")


def word_answer(content: Column | str) -> Column:
    c = ustrip(col_of(content))
    pos = F.instr(c, TAG)
    tail = F.when(pos > 0, F.substr(c, pos + len(TAG))).otherwise(c)
    # Python's \b on str patterns: the word characters are letters, numbers and "_"
    # (Java's \b also counts combining marks as word characters, so it is spelled out)
    hit = F.regexp_extract(tail, r"(?<![\p{L}\p{N}_])(Yes|No)(?![\p{L}\p{N}_])", 1)
    return F.coalesce(F.nullif(hit, F.lit("")), F.lit("Unknown"))


def answer(content: Column | str, mode: str = "contains") -> Column:
    builders = {
        "contains": contains_answer,
        "raw_tail": raw_tail_answer,
        "first_tag": first_tag_answer,
        "word": word_answer,
    }
    if mode not in builders:
        raise ValueError(f"unknown answer mode {mode!r}; expected one of {sorted(builders)} or 'json_label'")
    return builders[mode](content)


def json_label_fields(content: Column | str, labels: list[str] | None = None) -> Column:
    """ANS-5 as one struct: ``parsed`` (JSON ok), ``recommendation`` (``ERROR`` when not
    parseable), ``label`` (valid recommendation or ``''``), ``verdict`` and ``success``."""
    labels = labels or OUTPUT_LABELS
    c = col_of(content)
    unfenced = F.when(c.contains("```json"), F.replace(F.replace(c, F.lit("```json"), F.lit("")), F.lit("```"), F.lit(""))).otherwise(c)
    v = F.try_parse_json(unfenced)
    rec = F.try_variant_get(v, "$.recommendation", "string")
    valid = F.coalesce(rec.isin(*labels), F.lit(False))
    label = F.when(valid, rec).otherwise(F.lit(""))
    verdict = F.when(valid, F.coalesce(F.try_variant_get(v, "$.verdict", "string"), F.lit(""))).otherwise(F.lit(""))
    return F.struct(
        v.isNotNull().alias("parsed"),
        F.when(v.isNull(), F.lit("ERROR")).otherwise(rec).alias("recommendation"),
        label.alias("label"),
        verdict.alias("verdict"),
        (label == F.lit(ACCEPTABLE)).alias("success"),
    )


def canonical_label(s: Column | str) -> Column:
    """ANS-6: free label string -> canonical key used for the lookup join
    (strip, lower, drop both quote characters)."""
    return F.translate(F.lower(ustrip(col_of(s))), "'\"", "")
