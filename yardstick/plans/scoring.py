"""Registered queries for distributed scoring (UDF-3..7, JON-9, SRT-3, AGG-16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels as L
from ..operators import metrics, scoring
from ..session import scratch_path
from ..sources import derived
from .stub_scorer import StubScorer


def scored(spark, sf):
    docs = derived.read_table(spark, sf, "documents").select(F.col("doc_id").alias("sample_id"), "lang")
    s = scoring.score(docs, StubScorer("sample_id"), ["sample_id"], max_retries=3, retry_delay=0.0)
    return scoring.with_answers(s, "first_tag")


def q_score_with_retry(spark, sf):
    return scored(spark, sf).select(
        "sample_id", "lang", "model_response", "model_predicted_label",
        "model_prediction_is_generation_successfull", F.col("attempts").cast("bigint").alias("attempts"),
    )


def q_scored_metrics(spark, sf):
    """UDF-7 + AGG-1..3: metrics of the scored rows against the labels (ground truth
    positive when quality = 1 and toxic = 0); one class missing gives zero counts."""
    labels = derived.read_table(spark, sf, "labels").select(
        F.col("doc_id").alias("sample_id"), ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("gt")
    )
    s = scored(spark, sf).join(labels, "sample_id")
    p = F.col("model_prediction_is_generation_successfull")
    t = F.col("gt")
    c = s.groupBy("lang").agg(
        F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"),
        F.count_if(t & ~p).alias("fn"), F.count_if(~t & ~p).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    cols = metrics.confusion_columns(tp, fp, fn, tn, 6)
    return c.select(
        "lang", *cols[:4],
        *[F.col(x).cast("bigint").alias(x) for x in ("tp", "fp", "fn", "tn")],
    )


def q_online_metrics(spark, sf):
    """L6's metrics record (accuracy, precision, recall, f1_score, counts, sample totals)
    of the scored rows per language, ground truth from the labels."""
    labels = derived.read_table(spark, sf, "labels").select(
        F.col("doc_id").alias("sample_id"), ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("gt")
    )
    s = scored(spark, sf).join(labels, "sample_id")
    return metrics.online_metrics(s, "gt", "model_prediction_is_generation_successfull", ["lang"], digits=6)


def q_score_resumed(spark, sf):
    """UDF-4 + JON-9: a first job scores the even ids with an answer log, a second one all ids
    with the same log: only records without an answer are sent to the model."""
    docs = derived.read_table(spark, sf, "documents").select(F.col("doc_id").alias("sample_id"))
    log = scratch_path(spark, "answer-log")
    ask = lambda rows: scoring.score(rows, StubScorer("sample_id"), ["sample_id"], retry_delay=0.0, answer_log=log)
    ask(docs.filter("sample_id % 2 = 0")).write.format("noop").mode("overwrite").save()
    return ask(docs).select("sample_id", "model_response", F.col("attempts").cast("bigint").alias("attempts"), "failed", "reused")


QUERIES = {
    "score_resumed": q_score_resumed,
    "score_with_retry": q_score_with_retry,
    "scored_metrics": q_scored_metrics,
    "online_metrics": q_online_metrics,
}

_S = """WITH s AS (SELECT doc_id AS sample_id, lang,
       CASE WHEN doc_id % 17 = 0 THEN 'ERROR: endpoint unavailable for ' || CAST(doc_id AS VARCHAR)
            ELSE '<reasoning>sample ' || CAST(doc_id AS VARCHAR) || '</reasoning> ' || CASE WHEN doc_id % 2 = 0 THEN 'Yes' ELSE 'No' END END AS model_response,
       CASE WHEN doc_id % 17 = 0 THEN 'ERROR' WHEN doc_id % 2 = 0 THEN 'yes' ELSE 'no' END AS model_predicted_label,
       doc_id % 17 <> 0 AND doc_id % 2 = 0 AS model_prediction_is_generation_successfull,
       CAST(CASE WHEN doc_id % 17 = 0 THEN 3 ELSE doc_id % 3 + 1 END AS BIGINT) AS attempts
FROM documents)
"""


def _r(x):
    return f"round(coalesce(CAST({x} AS DOUBLE), 0.0), 6)"


ORACLE = {
    "score_with_retry": _S + "SELECT * FROM s",
    "score_resumed": _S + """SELECT sample_id, model_response, attempts, sample_id % 17 = 0 AS failed,
       sample_id % 2 = 0 AND sample_id % 17 <> 0 AS reused FROM s""",
    "online_metrics": _S + f""", j AS (SELECT s.lang, l.quality = 1 AND l.toxic = 0 AS t, model_prediction_is_generation_successfull AS p
                FROM s JOIN labels l ON l.doc_id = s.sample_id),
c AS (SELECT lang, count(*) FILTER (WHERE t AND p) AS tp, count(*) FILTER (WHERE NOT t AND p) AS fp,
             count(*) FILTER (WHERE t AND NOT p) AS fn, count(*) FILTER (WHERE NOT t AND NOT p) AS tn FROM j GROUP BY lang)
SELECT lang, {_r('(tp + tn) / nullif(tp + fp + fn + tn, 0)')} AS accuracy,
       {_r('tp / nullif(tp + fp, 0)')} AS precision, {_r('tp / nullif(tp + fn, 0)')} AS recall,
       {_r('2 * tp / nullif(2 * tp + fp + fn, 0)')} AS f1_score,
       CAST(tp AS BIGINT) AS true_positives, CAST(tn AS BIGINT) AS true_negatives,
       CAST(fp AS BIGINT) AS false_positives, CAST(fn AS BIGINT) AS false_negatives,
       CAST(tp + fp + fn + tn AS BIGINT) AS total_samples, CAST(tp + fn AS BIGINT) AS positive_samples,
       CAST(tn + fp AS BIGINT) AS negative_samples FROM c
""",
    "scored_metrics": _S + f""", j AS (SELECT s.lang, l.quality = 1 AND l.toxic = 0 AS t, model_prediction_is_generation_successfull AS p
                FROM s JOIN labels l ON l.doc_id = s.sample_id),
c AS (SELECT lang, count(*) FILTER (WHERE t AND p) AS tp, count(*) FILTER (WHERE NOT t AND p) AS fp,
             count(*) FILTER (WHERE t AND NOT p) AS fn, count(*) FILTER (WHERE NOT t AND NOT p) AS tn FROM j GROUP BY lang)
SELECT lang, {_r('(tp + tn) / nullif(tp + fp + fn + tn, 0)')} AS accuracy,
       {_r('tp / nullif(tp + fp, 0)')} AS precision_positive, {_r('tp / nullif(tp + fn, 0)')} AS recall_positive,
       {_r('2 * tp / nullif(2 * tp + fp + fn, 0)')} AS f1_positive,
       CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn FROM c
""",
}
