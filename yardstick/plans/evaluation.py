"""Registered queries for the extraction and evaluation legs (L2, L3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import answers, labels as L, records
from ..functions.text import html_escape, shorten
from ..operators import align, extract, metrics
from ..session import checkpoint, scratch_path
from ..sinks import writers
from ..sources import derived, scans
from .oracle_common import ANSWERS_CTE, G_CTE, GT_CTE, O_CTE, P_CTE, R_CTE, with_ctes

YES_NO = ("no", "yes")
D = 6  # doubles are rounded to 6 places on both sides of the oracle compare


def raw_lines(spark: SparkSession, sf: str) -> DataFrame:
    return derived.raw_output_lines(spark, sf)


def all_lines(spark: SparkSession, sf: str) -> DataFrame:
    return derived.all_output_lines(spark, sf)


def raw_preds(spark: SparkSession, sf: str, mode: str = "contains") -> DataFrame:
    """Deduplicated predictions from the raw lines, dataset/model from the file path."""
    preds = extract.raw_predictions(raw_lines(spark, sf), derived.RAW_PREFIX, mode)
    return align.last_write_wins(preds, answers=YES_NO if mode == "contains" else None)


def gt_table(spark: SparkSession, sf: str) -> DataFrame:
    return align.ground_truth_table(derived.ground_truth(spark, sf))


def q_eval_metrics(spark, sf):
    return metrics.eval_metrics(raw_preds(spark, sf), gt_table(spark, sf), digits=D)


def q_eval_metrics_by_reason(spark, sf):
    return metrics.metrics_by_reason(raw_preds(spark, sf), gt_table(spark, sf), digits=D)


def q_eval_accept_reject_rollup(spark, sf):
    by_reason = metrics.metrics_by_reason(raw_preds(spark, sf), gt_table(spark, sf))
    return metrics.accept_reject_rollup(by_reason, digits=D)


def q_extract_predictions(spark, sf):
    return extract.extracted_predictions(all_lines(spark, sf), derived.RAW_PREFIX)


def q_parse_drops(spark, sf):
    parsed = extract.parse_raw_lines(all_lines(spark, sf), "contains", derived.RAW_PREFIX)
    return metrics.drop_counts(parsed)


def q_content_shapes(spark, sf):
    lines = all_lines(spark, sf)
    v = records.parse_line("value")
    # the parsed value is pinned so the NULL filter does not re-run the parse
    with_v = extract.pin_columns(lines.select("source_file", "line_pos", v.alias("_v"))).filter(~records.malformed(F.col("_v")))
    chat = F.nullif(records.chat_content(F.col("_v")), F.lit(""))
    block = F.nullif(records.block_content(F.col("_v")), F.lit(""))
    bp = records.batch_path("source_file", derived.RAW_PREFIX)
    return with_v.select(
        records.model_name(bp).alias("model"),
        F.col("line_pos"),
        records.sample_index(records.record_id(F.col("_v"))).alias("sample_id"),
        F.when(chat.isNotNull(), F.lit("chat")).when(block.isNotNull(), F.lit("block")).otherwise(F.lit("none")).alias("shape"),
        records.content(F.col("_v")).alias("content"),
    )


def _answers(spark, sf) -> DataFrame:
    parsed = extract.parse_raw_lines(raw_lines(spark, sf), "contains", derived.RAW_PREFIX)
    return parsed.filter(F.col("drop_reason").isNull()).select("dataset", "model", "sample_id", "content")


def q_answers_contains(spark, sf):
    return _answers(spark, sf).select("dataset", "model", "sample_id", answers.contains_answer("content").alias("answer"))


def q_answers_raw_tail(spark, sf):
    return _answers(spark, sf).select("dataset", "model", "sample_id", answers.raw_tail_answer("content").alias("answer"))


def q_answers_first_tag(spark, sf):
    return _answers(spark, sf).select(
        "dataset", "model", "sample_id",
        answers.first_tag_answer("content").alias("answer"),
        answers.first_tag_success("content").alias("success"),
    )


def q_answers_word(spark, sf):
    return _answers(spark, sf).select("dataset", "model", "sample_id", answers.word_answer("content").alias("answer"))


def q_coverage_gaps(spark, sf):
    return align.coverage_gaps(raw_preds(spark, sf), gt_table(spark, sf))


def q_datasets_without_truth(spark, sf):
    """SRC-11 + JON-5 + AGG-8: ground truth is supplied for ``pairs-r`` only (a NAME=PATH
    mapping of one entry); datasets with predictions but no mapping are reported."""
    g = derived.ground_truth(spark, sf)
    mapping = {"pairs-r": g.filter(F.col("dataset") == "pairs-r").drop("dataset")}
    gt = align.ground_truth_table(scans.ground_truth_from_mapping(mapping))
    return align.without_truth(align.outcome_counts(raw_preds(spark, sf), gt), align.truth_counts(gt))


def q_prediction_distribution(spark, sf):
    return metrics.value_counts(raw_preds(spark, sf), "dataset", "model", "prediction")


def q_reason_counts(spark, sf):
    gt = gt_table(spark, sf)
    return metrics.value_counts(gt.filter(F.col("rejection_reason") != ""), "dataset", "rejection_reason")


def q_nested_metrics(spark, sf):
    return nested_rows(nested_document(spark, sf))


def nested_document(spark, sf):
    """Both metric tables read the counts of one alignment."""
    gt = gt_table(spark, sf)
    outcomes = checkpoint(align.outcome_counts(raw_preds(spark, sf), gt))
    return metrics.nested_metrics(metrics.eval_metrics_of(outcomes, align.truth_counts(gt)), metrics.metrics_by_reason_of(outcomes))


def nested_rows(doc: DataFrame) -> DataFrame:
    """One row per (dataset, model) of the nested metrics documents."""
    schema = "map<string, struct<accuracy: double, total_evaluated: bigint, per_rejection_reason: map<string, struct<count: bigint>>>>"
    parsed = doc.select("dataset", F.explode(F.from_json("metrics_json", schema)).alias("model", "m"))
    return parsed.select(
        "dataset",
        "model",
        F.round("m.accuracy", D).alias("accuracy"),
        F.col("m.total_evaluated").alias("total_evaluated"),
        F.size("m.per_rejection_reason").cast("bigint").alias("n_reasons"),
        F.col("m.per_rejection_reason")["accepted"]["count"].alias("accepted_count"),
    )


def q_overlap_errors(spark, sf):
    """JON-1's error: model-b's ids are moved out of the ground truth's range."""
    shifted = F.when(F.col("model") == "model-b", F.col("sample_id") + F.lit(10**12)).otherwise(F.col("sample_id"))
    return align.overlap_errors(raw_preds(spark, sf).withColumn("sample_id", shifted), gt_table(spark, sf))


def q_metrics_file(spark, sf):
    """SNK-3: the metrics documents written as a file and read back."""
    path = scratch_path(spark, "metrics")
    writers.write_metrics(nested_document(spark, sf), path)
    return nested_rows(spark.read.schema("dataset string, metrics_json string").json(path))


def q_display_text(spark, sf):
    """The report's text forms of whole documents: HTML-escaped and shortened."""
    docs = derived.read_table(spark, sf, "documents")
    return docs.select("doc_id", F.md5(html_escape("text")).alias("escaped_md5"), shorten("text").alias("short"))


QUERIES = {
    "overlap_errors": q_overlap_errors,
    "metrics_file": q_metrics_file,
    "display_text": q_display_text,
    "eval_metrics": q_eval_metrics,
    "eval_metrics_by_reason": q_eval_metrics_by_reason,
    "eval_accept_reject_rollup": q_eval_accept_reject_rollup,
    "extract_predictions": q_extract_predictions,
    "parse_drops": q_parse_drops,
    "content_shapes": q_content_shapes,
    "answers_contains": q_answers_contains,
    "answers_raw_tail": q_answers_raw_tail,
    "answers_first_tag": q_answers_first_tag,
    "answers_word": q_answers_word,
    "coverage_gaps": q_coverage_gaps,
    "datasets_without_truth": q_datasets_without_truth,
    "prediction_distribution": q_prediction_distribution,
    "reason_counts": q_reason_counts,
    "nested_metrics": q_nested_metrics,
}

_ALIGNED = with_ctes(G_CTE, GT_CTE, R_CTE, P_CTE) + """,
a AS (SELECT p.dataset, p.model, p.sample_id, p.prediction, gt.is_positive, gt.rejection_reason,
             gt.sample_id IS NOT NULL AS matched
      FROM p LEFT JOIN gt ON p.dataset = gt.dataset AND p.sample_id = gt.sample_id)
"""

_BUCKETED = _ALIGNED.rstrip() + """,
b AS (SELECT dataset, model, sample_id, prediction, is_positive,
             CASE WHEN is_positive THEN 'accepted'
                  WHEN rejection_reason = '' THEN 'rejected (no reason)' ELSE rejection_reason END AS reason
      FROM a WHERE matched),
br AS (SELECT dataset, model, reason, count(*) AS cnt,
              count(*) FILTER (WHERE (prediction = 'yes') = is_positive) AS correct,
              count(*) FILTER (WHERE prediction = 'yes') AS pyes,
              count(*) FILTER (WHERE prediction <> 'yes') AS pno,
              min(sample_id) AS first_index
       FROM b GROUP BY ALL)
"""


def _r(x: str) -> str:
    return f"round(coalesce(CAST({x} AS DOUBLE), 0.0), 6)"


ORACLE = {
    "eval_metrics": _ALIGNED + f"""
, c AS (SELECT dataset, model, count(*) AS total_predictions,
        count(*) FILTER (WHERE matched) AS total_evaluated,
        count(*) FILTER (WHERE matched AND is_positive AND prediction = 'yes') AS tp,
        count(*) FILTER (WHERE matched AND NOT is_positive AND prediction = 'yes') AS fp,
        count(*) FILTER (WHERE matched AND is_positive AND prediction <> 'yes') AS fn,
        count(*) FILTER (WHERE matched AND NOT is_positive AND prediction <> 'yes') AS tn,
        count(*) FILTER (WHERE prediction = 'yes') AS pyes,
        count(*) FILTER (WHERE prediction = 'no') AS pno
      FROM a GROUP BY dataset, model),
 n AS (SELECT dataset, count(*) AS total_ground_truth FROM gt GROUP BY dataset)
SELECT c.dataset, c.model,
  CAST(total_evaluated AS BIGINT) AS total_evaluated, CAST(total_predictions AS BIGINT) AS total_predictions,
  CAST(total_ground_truth AS BIGINT) AS total_ground_truth,
  {_r('(tp + tn) / nullif(tp + fp + fn + tn, 0)')} AS accuracy,
  {_r('tp / nullif(tp + fp, 0)')} AS precision_positive,
  {_r('tp / nullif(tp + fn, 0)')} AS recall_positive,
  {_r('2 * tp / nullif(2 * tp + fp + fn, 0)')} AS f1_positive,
  {_r('tn / nullif(tn + fn, 0)')} AS precision_negative,
  {_r('tn / nullif(tn + fp, 0)')} AS recall_negative,
  {_r('2 * tn / nullif(2 * tn + fn + fp, 0)')} AS f1_negative,
  CAST(tp AS BIGINT) AS true_positives, CAST(tn AS BIGINT) AS true_negatives,
  CAST(fp AS BIGINT) AS false_positives, CAST(fn AS BIGINT) AS false_negatives,
  CAST(tp + fn AS BIGINT) AS gt_positive_count, CAST(fp + tn AS BIGINT) AS gt_negative_count,
  CAST(pyes AS BIGINT) AS pred_yes_count, CAST(pno AS BIGINT) AS pred_no_count
FROM c JOIN n ON c.dataset = n.dataset
""",
    "eval_metrics_by_reason": _BUCKETED + f"""
SELECT dataset, model, reason, CAST(cnt AS BIGINT) AS count,
       {_r('correct / cnt')} AS accuracy,
       CAST(correct AS BIGINT) AS correct_predictions, CAST(pyes AS BIGINT) AS predicted_yes,
       CAST(pno AS BIGINT) AS predicted_no,
       {_r("CASE WHEN reason = 'accepted' THEN pyes ELSE pno END / cnt")} AS recall,
       CAST(row_number() OVER (PARTITION BY dataset, model ORDER BY cnt DESC, first_index) AS BIGINT) AS reason_rank
FROM br
""",
    "eval_accept_reject_rollup": _BUCKETED + f"""
SELECT dataset, model, CASE WHEN reason = 'accepted' THEN 'accepted' ELSE 'rejected' END AS side,
       CAST(sum(cnt) AS BIGINT) AS samples, CAST(sum(correct) AS BIGINT) AS correct,
       {_r('sum(correct) * 100 / sum(cnt)')} AS pct_correct
FROM br GROUP BY ALL
""",
    "extract_predictions": with_ctes(R_CTE, ANSWERS_CTE, O_CTE) + """
SELECT CAST(sample_id AS BIGINT) AS sample, prediction,
       concat('outputs/', dataset, '/', model, '/batch_', CAST(sample_id // 50 AS VARCHAR), '/part.jsonl.out') AS batch_path,
       concat('s3://bucket/proj/outputs/', dataset, '/', model, '/batch_', CAST(sample_id // 50 AS VARCHAR), '/part.jsonl.out') AS source_file
FROM (SELECT dataset, model, sample_id, a_raw_tail AS prediction FROM ans
      UNION ALL SELECT dataset, model, doc_id, lower(content) FROM o WHERE outcome = 'ok')
""",
    "parse_drops": with_ctes(R_CTE, O_CTE) + """
SELECT dataset, model, drop_reason, CAST(count(*) AS BIGINT) AS n
FROM (SELECT dataset, model,
             CASE WHEN v = 6 THEN 'error_record' WHEN v = 7 THEN 'malformed' WHEN v = 8 THEN 'no_record_id' ELSE 'ok' END AS drop_reason FROM r
      UNION ALL SELECT dataset, model, outcome FROM o) GROUP BY ALL
""",
    "content_shapes": with_ctes(R_CTE, O_CTE) + """
SELECT model, doc_id AS line_pos, CAST(doc_id AS BIGINT) AS sample_id,
       CASE WHEN o = 8 THEN 'chat' WHEN content IS NULL THEN 'none' ELSE 'block' END AS shape, content
FROM o WHERE outcome <> 'malformed'
UNION ALL
SELECT model, doc_id AS line_pos,
       CASE WHEN v = 8 THEN NULL ELSE CAST(doc_id AS BIGINT) END AS sample_id,
       CASE WHEN v IN (2, 5) THEN 'chat' WHEN v = 6 THEN 'none' ELSE 'block' END AS shape,
       CASE v WHEN 0 THEN '<reasoning>ok</reasoning>' || chr(10) || 'Yes'
              WHEN 1 THEN '<reasoning>bad</reasoning>No'
              WHEN 2 THEN '<reasoning>ok</reasoning>''Yes'''
              WHEN 3 THEN '<reasoning>a</reasoning>Yes</REASONING> No'
              WHEN 4 THEN 'Yes' WHEN 5 THEN 'yes' WHEN 6 THEN NULL
              WHEN 8 THEN '<reasoning>ok</reasoning>Yes'
              ELSE '<reasoning>x</reasoning>eyes only' END AS content
FROM r WHERE v <> 7
""",
    "answers_contains": with_ctes(R_CTE, ANSWERS_CTE) + "SELECT dataset, model, CAST(sample_id AS BIGINT) AS sample_id, a_contains AS answer FROM ans",
    "answers_raw_tail": with_ctes(R_CTE, ANSWERS_CTE) + "SELECT dataset, model, CAST(sample_id AS BIGINT) AS sample_id, a_raw_tail AS answer FROM ans",
    "answers_first_tag": with_ctes(R_CTE, ANSWERS_CTE)
    + "SELECT dataset, model, CAST(sample_id AS BIGINT) AS sample_id, a_first_tag AS answer, a_first_tag = 'yes' AS success FROM ans",
    "answers_word": with_ctes(R_CTE, ANSWERS_CTE) + "SELECT dataset, model, CAST(sample_id AS BIGINT) AS sample_id, a_word AS answer FROM ans",
    "coverage_gaps": _ALIGNED + """
, c AS (SELECT dataset, model, count(*) AS np, count(*) FILTER (WHERE matched) AS m FROM a GROUP BY ALL),
  n AS (SELECT dataset, count(*) AS ng FROM gt GROUP BY ALL)
SELECT c.dataset, c.model, CAST(m AS BIGINT) AS matched, CAST(ng - m AS BIGINT) AS gt_without_prediction,
       CAST(np - m AS BIGINT) AS prediction_without_gt
FROM c JOIN n ON c.dataset = n.dataset
""",
    "datasets_without_truth": with_ctes(R_CTE, P_CTE) + """
SELECT dataset, CAST(count(*) AS BIGINT) AS n_predictions, CAST(count(DISTINCT model) AS BIGINT) AS n_models
FROM p WHERE dataset <> 'pairs-r' GROUP BY dataset
""",
    "prediction_distribution": with_ctes(R_CTE, P_CTE)
    + "SELECT dataset, model, prediction, CAST(count(*) AS BIGINT) AS n FROM p GROUP BY ALL",
    "reason_counts": with_ctes(G_CTE, GT_CTE)
    + "SELECT dataset, rejection_reason, CAST(count(*) AS BIGINT) AS n FROM gt WHERE rejection_reason <> '' GROUP BY ALL",
    "nested_metrics": _BUCKETED + f"""
, c AS (SELECT dataset, model, count(*) FILTER (WHERE matched) AS m,
        count(*) FILTER (WHERE matched AND is_positive = (prediction = 'yes')) AS ok FROM a GROUP BY ALL),
  nr AS (SELECT dataset, model, count(*) AS n_reasons,
         max(cnt) FILTER (WHERE reason = 'accepted') AS accepted_count FROM br GROUP BY ALL)
SELECT c.dataset, c.model, {_r('ok / nullif(m, 0)')} AS accuracy, CAST(m AS BIGINT) AS total_evaluated,
       CAST(coalesce(n_reasons, 0) AS BIGINT) AS n_reasons, CAST(accepted_count AS BIGINT) AS accepted_count
FROM c LEFT JOIN nr ON c.dataset = nr.dataset AND c.model = nr.model
""",
}

ORACLE["metrics_file"] = ORACLE["nested_metrics"]
ORACLE["overlap_errors"] = with_ctes(G_CTE, R_CTE, ANSWERS_CTE) + """
SELECT DISTINCT dataset, model, 'no prediction has a ground-truth row' AS error FROM ans
WHERE model = 'model-b' AND dataset IN (SELECT dataset FROM g)
"""
ORACLE["display_text"] = """
SELECT doc_id, md5(replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), chr(39), '&#x27;')) AS escaped_md5,
       CASE WHEN length(text) > 40 THEN substr(text, 1, 38) || '..' ELSE text END AS short FROM documents
"""
