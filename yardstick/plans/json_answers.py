"""Registered queries for JSON-label answers and label lookup (ANS-5, ANS-6, JON-8,
UDF-5/UDF-7 on the JSON backend)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import answers as A
from ..operators import scoring
from ..sources import derived
from .stub_scorer import StubScorer

# Free-form label spellings derived from the document id (i % 9).
_SPELLINGS = [" 'Acceptable' ", '"WRONG_ORIENTATION"', "background_issues ", "Non_Relevant_Main_Image",
              "irrelevant objects", "TEXTURE_LIGHTING_COLOR_ISSUES\n", "'geometry_artifacts'", "acceptable!", ""]


def _docs(spark, sf):
    return derived.read_table(spark, sf, "documents").select(F.col("doc_id").alias("sample_id"))


def label_table(spark):
    """The output-label table (label, description, position); a fixed seven-row table.
    Descriptions here are generated from the label name."""
    rows = [(lab, lab.replace("_", " ").capitalize(), i) for i, lab in enumerate(A.OUTPUT_LABELS)]
    return spark.createDataFrame(rows, "label string, description string, position int")


def q_answers_json_label(spark, sf):
    d = _docs(spark, sf)
    i = F.col("sample_id").cast("string")
    k = F.col("sample_id") % 4
    content = (
        F.when(k == 0, F.concat(F.lit('```json\n{"verdict": "looks right '), i, F.lit('", "recommendation": "acceptable"}\n```')))
        .when(k == 1, F.concat(F.lit('{"verdict": "bent frame '), i, F.lit('", "recommendation": "geometry_artifacts"}')))
        .when(k == 2, F.concat(F.lit('{"verdict": "odd '), i, F.lit('", "recommendation": "blurry"}')))
        .otherwise(F.concat(F.lit("no JSON here for "), i))
    )
    return d.select("sample_id", A.json_label_fields(content).alias("f")).select("sample_id", "f.*")


def q_label_lookup(spark, sf):
    d = _docs(spark, sf)
    spelled = F.element_at(F.array(*[F.lit(s) for s in _SPELLINGS]), (F.col("sample_id") % len(_SPELLINGS) + 1).cast("int"))
    free = d.select("sample_id", spelled.alias("raw"), A.canonical_label(spelled).alias("key"))
    labels = F.broadcast(label_table(spark))  # fixed seven rows
    j = free.join(labels, free["key"] == labels["label"], "left")
    return j.select("sample_id", "raw", "label", "description", F.col("position").cast("bigint").alias("position"))


def q_score_json_label(spark, sf):
    s = scoring.score(_docs(spark, sf), StubScorer("sample_id", "json"), ["sample_id"], max_retries=3, retry_delay=0.0)
    out = scoring.with_answers(s, "json_label")
    return out.select("sample_id", "model_predicted_label", "model_prediction_is_generation_successfull",
                      F.col("attempts").cast("bigint").alias("attempts"))


QUERIES = {
    "answers_json_label": q_answers_json_label,
    "label_lookup": q_label_lookup,
    "score_json_label": q_score_json_label,
}

_LABELS = ", ".join(f"('{lab}', '{lab.replace('_', ' ').capitalize()}', {i})" for i, lab in enumerate(A.OUTPUT_LABELS))
_SPELL = " ".join("WHEN {} THEN '{}'".format(i, s.replace("'", "''").replace("\n", "' || chr(10) || '")) for i, s in enumerate(_SPELLINGS))

ORACLE = {
    "answers_json_label": """
SELECT doc_id AS sample_id, doc_id % 4 <> 3 AS parsed,
       CASE doc_id % 4 WHEN 0 THEN 'acceptable' WHEN 1 THEN 'geometry_artifacts' WHEN 2 THEN 'blurry' ELSE 'ERROR' END AS recommendation,
       CASE doc_id % 4 WHEN 0 THEN 'acceptable' WHEN 1 THEN 'geometry_artifacts' ELSE '' END AS label,
       CASE doc_id % 4 WHEN 0 THEN 'looks right ' || CAST(doc_id AS VARCHAR) WHEN 1 THEN 'bent frame ' || CAST(doc_id AS VARCHAR) ELSE '' END AS verdict,
       doc_id % 4 = 0 AS success
FROM documents
""",
    "label_lookup": f"""
WITH t(label, description, position) AS (VALUES {_LABELS}),
d AS (SELECT doc_id AS sample_id, CASE doc_id % {len(_SPELLINGS)} {_SPELL} END AS raw FROM documents),
k AS (SELECT *, replace(replace(lower(trim(raw, ' ' || chr(10))), '''', ''), '"', '') AS key FROM d)
SELECT sample_id, raw, t.label, t.description, CAST(t.position AS BIGINT) AS position
FROM k LEFT JOIN t ON k.key = t.label
""",
    "score_json_label": """
SELECT doc_id AS sample_id,
       CASE WHEN doc_id % 17 = 0 THEN 'ERROR' WHEN doc_id % 4 = 0 THEN 'acceptable' WHEN doc_id % 4 = 1 THEN 'geometry_artifacts' ELSE '' END AS model_predicted_label,
       doc_id % 17 <> 0 AND doc_id % 4 = 0 AS model_prediction_is_generation_successfull,
       CAST(CASE WHEN doc_id % 17 = 0 THEN 3 ELSE doc_id % 3 + 1 END AS BIGINT) AS attempts
FROM documents
""",
}
