"""Registered queries for label and rejection-reason normalisation (LBL-1..9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.payloads import label_list_text
from ..operators import categories
from ..sources import derived
from .oracle_common import G_CTE, with_ctes

R_STYLE = ["pairs-r"]


def g(spark, sf):
    return derived.ground_truth(spark, sf)


def q_label_bool(spark, sf):
    df = g(spark, sf)
    return df.select("dataset", "sample_id", "label", L.label_bool(df).alias("is_positive"))


def q_label_answer(spark, sf):
    return g(spark, sf).select("dataset", "sample_id", L.label_answer("label").alias("answer"))


def q_label_lenient(spark, sf):
    return g(spark, sf).select("dataset", "sample_id", L.label_lenient("label").alias("label_norm"))


def q_category(spark, sf):
    return g(spark, sf).select(
        "dataset", "sample_id", L.sampling_category("rejection_reason", "dataset", R_STYLE).alias("category")
    )


def q_bucket(spark, sf):
    df = g(spark, sf)
    return df.select("dataset", "sample_id", L.eval_bucket(L.label_bool(df), "rejection_reason").alias("bucket"))


def q_category_check(spark, sf):
    df = g(spark, sf).select(F.col("dataset").alias("split"), L.sampling_category("rejection_reason", "dataset", R_STYLE).alias("category"))
    expected = categories.expected_categories(spark, {"pairs-r": categories.R_REASONS, "pairs-s": categories.S_REASONS})
    return categories.category_check(df, expected)


def q_label_flags(spark, sf):
    """LBL-2: ground truth from the second column choice, as a boolean and as a number."""
    marks = derived.read_table(spark, sf, "labels")
    flag = marks.select("doc_id", ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("is_generation_successful"))
    number = marks.select("doc_id", (F.col("quality") - F.col("toxic")).alias("is_generation_successful"))
    return flag.select("doc_id", L.label_bool(flag).alias("by_flag")).join(number.select("doc_id", L.label_bool(number).alias("by_number")), "doc_id")


def q_label_prompt(spark, sf):
    """BAT-17: the label list of a prompt in enum order, each label with its rows per split."""
    cats = g(spark, sf).select(F.col("dataset").alias("split"), L.sampling_category("rejection_reason", "dataset", R_STYLE).alias("category"))
    names = [*categories.R_REASONS, *categories.S_REASONS]
    counts = cats.groupBy("split").agg(*[F.count_if(F.col("category") == n).alias(f"n{k}") for k, n in enumerate(names)])
    text = label_list_text("Use one of:", [*[(n, F.concat(F.col(f"n{k}").cast("string"), F.lit(" rows"))) for k, n in enumerate(names)], ("other", "anything else")])
    return counts.select("split", text.alias("text"))


QUERIES = {
    "label_flags": q_label_flags,
    "label_prompt": q_label_prompt,
    "label_bool": q_label_bool,
    "label_answer": q_label_answer,
    "label_lenient": q_label_lenient,
    "category": q_category,
    "bucket": q_bucket,
    "category_check": q_category_check,
}

_G = with_ctes(G_CTE)
_CAT = """CASE WHEN coalesce(CASE WHEN dataset = 'pairs-r' THEN rejection_reason IN ('accepted')
                               ELSE rejection_reason IN ('', 'accept') END, false)
          THEN 'accepted' ELSE rejection_reason END"""

_NAMES = [*categories.R_REASONS, *categories.S_REASONS]
_LINES = " || ".join(f"chr(10) || '- ''{n}'': ' || CAST(count(*) FILTER (WHERE category = '{n}') AS VARCHAR) || ' rows'" for n in _NAMES)

ORACLE = {
    "label_flags": """SELECT doc_id, coalesce(quality = 1 AND toxic = 0, false) AS by_flag, coalesce(quality - toxic <> 0, false) AS by_number FROM labels""",
    "label_prompt": _G + f""", c AS (SELECT dataset AS split, {_CAT} AS category FROM g)
SELECT split, 'Use one of:' || {_LINES} || chr(10) || '- ''other'': anything else' AS text FROM c GROUP BY split""",
    "label_bool": _G + "SELECT dataset, sample_id, label, coalesce(lower(trim(label)) IN ('accept','accepted','true','yes','1'), false) AS is_positive FROM g",
    "label_answer": _G + "SELECT dataset, sample_id, CASE WHEN lower(trim(label)) IN ('accepted','accept') THEN 'Yes' ELSE 'No' END AS answer FROM g",
    "label_lenient": _G + "SELECT dataset, sample_id, CASE WHEN lower(trim(coalesce(label, ''))) IN ('accepted','accept') THEN 'accepted' ELSE 'rejected' END AS label_norm FROM g",
    "category": _G + f"SELECT dataset, sample_id, {_CAT} AS category FROM g",
    "bucket": _G + """SELECT dataset, sample_id,
       CASE WHEN lower(trim(label)) IN ('accept','accepted','true','yes','1') THEN 'accepted'
            WHEN coalesce(trim(rejection_reason), '') = '' THEN 'rejected (no reason)'
            ELSE trim(rejection_reason) END AS bucket FROM g""",
    "category_check": _G + f""", o AS (SELECT dataset AS split, {_CAT} AS category, count(*) AS n FROM g GROUP BY ALL),
e(split, category) AS (VALUES
  ('pairs-r', 'Irrelevant Objects'), ('pairs-r', 'Geometry Artifacts'), ('pairs-r', 'Texture/Lighting/Color Issues'),
  ('pairs-r', 'Wrong Orientation'), ('pairs-r', 'Generated-Main Image Mismatch (Color/Material/Pattern)'),
  ('pairs-r', 'Background Issues'), ('pairs-r', 'accepted'),
  ('pairs-s', 'wrong_orientation'), ('pairs-s', 'wrong_product_same_pt'), ('pairs-s', 'wrong_product_different_pt'),
  ('pairs-s', 'accepted'))
SELECT coalesce(o.split, e.split) AS split, coalesce(o.category, e.category) AS category,
       CAST(coalesce(o.n, 0) AS BIGINT) AS n_observed,
       CASE WHEN o.split IS NULL THEN 'missing' WHEN e.split IS NULL THEN 'unexpected' ELSE 'ok' END AS status
FROM o FULL OUTER JOIN e ON o.split = e.split AND o.category IS NOT DISTINCT FROM e.category
""",
}
