"""Registered queries for chat-format examples (CHT-1..7, JON-7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import chat as C
from ..operators import chat as CH
from ..sources import derived
from .oracle_common import G_CTE, with_ctes

PROMPT = "Do the two images show the same product? Reason first, then answer Yes or No."
# The rejection reasons whose rule text is looked up (JON-7); the
# explanations are the engine's own wording.
RULES = {
    "Geometry Artifacts": "Core structure differs: shape or geometry changed.",
    "Texture/Lighting/Color Issues": "Material, lighting or color does not match.",
    "Wrong Orientation": "The product faces the wrong way.",
    "Irrelevant Objects": "Objects that must not appear are present.",
    "Generated-Main Image Mismatch (Color/Material/Pattern)": "Color, material or pattern differs from the source.",
    "Background Issues": "The background is not clean.",
    "wrong_orientation": "The product faces the wrong way.",
    "wrong_product_same_pt": "A different product of the same type is shown.",
    "wrong_product_different_pt": "A product of another type is shown.",
}


def examples(spark, sf):
    g = derived.ground_truth(spark, sf).select(
        "sample_id",
        "label",
        "rejection_reason",
        "object_description",
        F.encode(F.concat(F.lit("source "), F.col("sample_id").cast("string")), "UTF-8").alias("xsource_image"),
        F.encode(F.concat(F.lit("target "), F.col("sample_id").cast("string")), "UTF-8").alias("xtarget_image"),
    )
    return CH.format_examples(g, CH.rules_table(spark, RULES), PROMPT, "xsource_image", "xtarget_image")


def q_chat_examples(spark, sf):
    e = examples(spark, sf)
    m = F.col("messages")
    return e.select(
        "sample_id",
        "answer",
        F.size(m).cast("bigint").alias("n_messages"),
        F.size(m[0]["content"]).cast("bigint").alias("n_user_items"),
        m[1]["role"].alias("role1"),
        m[0]["content"][2]["text"].alias("prompt"),
        F.md5(m[1]["content"][0]["text"]).alias("assistant_md5"),
        F.size(C.message_images(m)).cast("bigint").alias("n_images"),
        F.decode(C.message_images(m)[1], "UTF-8").alias("second_image"),
    )


def q_reasoning_text(spark, sf):
    return examples(spark, sf).select("sample_id", "reasoning")


def q_chat_flatten(spark, sf):
    conv = derived.read_table(spark, sf, "conversations")
    return CH.conversation_images(conv).select(
        "conv_id", F.col("pos").cast("bigint").alias("pos"), F.decode("image", "UTF-8").alias("image_text")
    )


def q_rows_lists(spark, sf):
    docs = derived.read_table(spark, sf, "documents").select(
        F.expr("doc_id div 50").alias("batch"), "doc_id", "lang", "n_chars"
    )
    lists = CH.columns_to_lists(docs, "batch", ["doc_id", "lang", "n_chars"], order_cols=["doc_id"])
    return CH.lists_to_rows(lists, "batch", ["doc_id", "lang", "n_chars"])


QUERIES = {
    "chat_examples": q_chat_examples,
    "reasoning_text": q_reasoning_text,
    "chat_flatten": q_chat_flatten,
    "rows_lists": q_rows_lists,
}


def _sql_text(template: str, **exprs: str) -> str:
    """A template as a DuckDB string expression (newlines as chr(10))."""
    import re

    parts = []
    for part in re.split(r"(\{\w+\})", template):
        m = re.fullmatch(r"\{(\w+)\}", part)
        if m and m.group(1) in exprs:
            parts.append(f"({exprs[m.group(1)]})")
        elif part:
            for k, seg in enumerate(part.split("\n")):
                if k:
                    parts.append("chr(10)")
                if seg:
                    parts.append("'" + seg.replace("'", "''") + "'")
    return " || ".join(parts)


_RULES_VALUES = ", ".join("('" + k.replace("'", "''") + "', '" + v.replace("'", "''") + "')" for k, v in RULES.items())
_DESC = "coalesce(object_description, 'a product')"
_REASON = "coalesce(rejection_reason, '')"
_ACC = _sql_text(CH.ACCEPTED_TEMPLATE, desc=_DESC)
_REJ = _sql_text(CH.REJECTED_TEMPLATE, desc=_DESC, reason=_REASON, rule=f"coalesce(rule_text, 'Rejected for: ' || {_REASON} || '.')")
_EX = with_ctes(G_CTE) + f""",
rules(reason, rule_text) AS (VALUES {_RULES_VALUES}),
x AS (SELECT g.*, rules.rule_text,
             CASE WHEN lower(trim(label)) IN ('accepted', 'accept') THEN 'Yes' ELSE 'No' END AS answer
      FROM g LEFT JOIN rules ON g.rejection_reason = rules.reason),
y AS (SELECT *, CASE WHEN answer = 'Yes' THEN {_ACC} ELSE {_REJ} END AS reasoning FROM x)
"""

ORACLE = {
    "chat_examples": _EX + f"""
SELECT sample_id, answer, CAST(2 AS BIGINT) AS n_messages, CAST(3 AS BIGINT) AS n_user_items, 'assistant' AS role1,
       '{PROMPT}' AS prompt,
       md5('<reasoning>' || chr(10) || reasoning || chr(10) || '</reasoning>' || chr(10) || chr(10) || answer) AS assistant_md5,
       CAST(2 AS BIGINT) AS n_images, 'target ' || CAST(sample_id AS VARCHAR) AS second_image
FROM y
""",
    "reasoning_text": _EX + "SELECT sample_id, reasoning FROM y",
    "chat_flatten": """
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS pos, text AS image_text
FROM conversations WHERE turn % 3 = 2
""",
    "rows_lists": "SELECT doc_id // 50 AS batch, doc_id, lang, n_chars FROM documents",
}
