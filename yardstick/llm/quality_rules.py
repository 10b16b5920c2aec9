"""Quality rules (operator 2): a threshold table compiled into one Spark projection.

Every measure is a built-in column expression, so no Python runs on the executors and
no row leaves its task: the plan is scan -> project.  ``RULES`` is a table of integer
comparisons ``100 * measure  (<|>)  limit * denominator``; ``compile_rules`` turns it
into one boolean column per rule and the verdict.

Defined cases: a null or empty text has no words, symbols or lines (it fails the base
rule); a null ``lang`` skips the stop-word rule, as does a language without a list;
repeated rows are judged one by one; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5

# Stop words per language; the stop-word rule only speaks about these languages.
STOP_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "was", "on", "are", "as", "with", "by", "be", "this", "from", "or", "an", "at"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht", "ein", "eine"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un", "para", "con", "no", "una"],
}

# (name, measure, relation, per cent, denominator): fails if 100 * measure REL per cent * denominator.
RULES = [
    ("too_short_words", "word_chars", "<", 200, "n_words"),
    ("too_long_words", "word_chars", ">", 1500, "n_words"),
    ("symbols", "n_symbols", ">", 10, "n_words"),
    ("few_stop_words", "n_stop_words", "<", 4, "n_ruled_words"),
    ("dup_lines", "n_dup_lines", ">", 30, "n_lines"),
]
BASE_RULES = [
    ("base_short", "n_words", "<", 1000, "one"),
    ("base_repeats", "n_repeat_words", ">", 20, "n_words"),
]


def compile_rules(rules, measures: dict[str, Column]) -> list[Column]:
    """One failing-condition column per row of the threshold table."""
    out = []
    for name, measure, rel, percent, denom in rules:
        left, right = measures[measure] * 100, measures[denom] * percent
        out.append((left < right if rel == "<" else left > right).alias(name))
    return out


def repeat_words(words: str, hashes: str) -> Column:
    """Words inside 5-word windows that occur at least twice; ``hashes`` are the window
    hashes in order.  Only texts with a repeated window take the sorting branch."""
    h = F.col(hashes)
    n = F.size(h)
    tagged = F.sort_array(F.transform(h, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

    def repeated(s):  # positions whose window hash equals a neighbour's in hash order
        last = F.size(s) - 1
        near = lambda x, k: ((k > 0) & (F.get(s, k - 1)["g"] == x["g"])) | ((k < last) & (F.get(s, k + 1)["g"] == x["g"]))
        return F.sort_array(F.transform(F.filter(s, near), lambda x: x["i"]))

    def covered(p):
        return F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))),
            F.lit(0).cast("bigint"),
            lambda acc, x: acc + x,
        )

    # transform over a one-element array binds the sorted array once instead of once per use
    once = F.transform(F.transform(F.array(tagged), repeated), covered)
    return F.when(F.size(F.array_distinct(h)) < n, F.element_at(once, 1)).otherwise(F.lit(0).cast("bigint"))


def is_one_of(listed: list[str]):
    return lambda word: F.lower(word).isin(listed)


def measure(docs: DataFrame, lang_col: str = "lang") -> DataFrame:
    """doc_id and every measure the rules may name, one projection per document."""
    lang = F.col(lang_col) if lang_col in docs.columns else F.lit(None).cast("string")
    base = docs.select("doc_id", lang.alias("_lang"), F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    split = base.select(
        "doc_id",
        "_lang",
        "_text",
        F.array_remove(F.split("_text", SPACE), "").alias("_words"),
        F.filter(F.split("_text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("_lines"),
    )
    k = F.size("_words")
    w = F.col("_words")
    grams = F.when(
        k >= WINDOW,
        F.transform(F.sequence(F.lit(0), k - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(WINDOW)])),
    ).otherwise(F.array().cast("array<bigint>"))
    stop = None
    for code, listed in STOP_WORDS.items():
        n = F.size(F.filter("_words", is_one_of(listed)))
        stop = F.when(F.col("_lang") == code, n) if stop is None else stop.when(F.col("_lang") == code, n)
    hashed = split.select(
        "doc_id",
        "_words",
        grams.alias("_grams"),
        k.cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(stop.cast("bigint"), F.lit(0).cast("bigint")).alias("n_stop_words"),
        F.when(F.col("_lang").isin(list(STOP_WORDS)), k.cast("bigint")).otherwise(F.lit(0).cast("bigint")).alias("n_ruled_words"),
    )
    return hashed.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        repeat_words("_words", "_grams").alias("n_repeat_words"),
        "n_lines", "n_stop_words", "n_ruled_words",
    )


def quality_rules(docs: DataFrame, rules=None, base_rules=None, lang_col: str = "lang") -> DataFrame:
    """Per document the measures, ``base_failed``, ``failed`` (names of failed rules of
    the table) and ``kept``."""
    rules = RULES if rules is None else rules
    base_rules = BASE_RULES if base_rules is None else base_rules
    m = measure(docs, lang_col)
    columns = {c: F.col(c) for c in m.columns} | {"one": F.lit(1).cast("bigint")}
    base_failed = F.lit(False)
    for c in compile_rules(base_rules, columns):
        base_failed = base_failed | c
    named = F.array_compact(F.array(*[F.when(c, F.lit(r[0])) for r, c in zip(rules, compile_rules(rules, columns))]))
    judged = m.select("*", base_failed.alias("base_failed"), F.concat_ws(",", named).alias("failed"))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("failed") == ""))
