"""Registered queries that go through files: every sink writes into a fresh folder
under the session's checkpoint directory (shared storage on a cluster), and the
scans read it back, so sinks and sources are checked against the same oracles as
the in-memory queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import align, batching, extract, metrics, reports
from ..session import scratch_path
from ..sinks import writers
from ..sources import derived, scans
from ..streaming.extract import stream_extract
from . import evaluation as ev
from . import jobs
from .oracle_common import ANSWERS_CTE, R_CTE, with_ctes
from .scoring import _S, scored


def _raw_files(spark, sf, name):
    """R lines written as text files, one folder per (dataset, model)."""
    path = scratch_path(spark, name)
    lines = derived.raw_output_lines(spark, sf).select(
        "value",
        F.regexp_extract("source_file", r"outputs/([^/]+)/", 1).alias("dataset"),
        F.regexp_extract("source_file", r"outputs/[^/]+/([^/]+)/", 1).alias("model"),
        "line_pos",
    )
    # range partitioning keeps each file's lines in order and splits a large (dataset, model)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines.repartitionByRange(n, "dataset", "model", "line_pos").sortWithinPartitions("dataset", "model", "line_pos").drop(
        "line_pos"
    ).write.partitionBy("dataset", "model").text(path)
    return path


def q_sink_roundtrip(spark, sf):
    """SNK-1 then SRC-4: extracted predictions written as JSON parts and read back tolerantly."""
    path = scratch_path(spark, "parts")
    writers.write_predictions(extract.extracted_predictions(ev.all_lines(spark, sf), derived.RAW_PREFIX), path)
    back = scans.parts_json(spark, path)
    return back.filter(~F.col("malformed")).select("sample", "prediction", "batch_path", "source_file")


def q_scan_roundtrip(spark, sf):
    """SRC-1 + WIN-2 with real file order: raw lines written as files, scanned with the
    file path, block start and line id, then evaluated as in ``eval_metrics``."""
    path = _raw_files(spark, sf, "raw")
    lines = spark.read.text(path).select(
        "value", "dataset", "model",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("file_block_start"),
        F.monotonically_increasing_id().alias("line_pos"),
    )
    parsed = extract.parse_raw_lines(lines, "contains", carry=["dataset", "model"])
    preds = align.last_write_wins(parsed.filter(F.col("drop_reason").isNull()), answers=ev.YES_NO)
    return metrics.eval_metrics(preds, ev.gt_table(spark, sf), digits=ev.D)


def q_batch_files(spark, sf):
    """BAT-13 + SNK-2: one JSON line per record, one ``batch_<k>.jsonl`` file per batch
    (the reference's layout) in position order, read back."""
    docs = derived.read_table(spark, sf, "documents").select(F.col("doc_id").alias("sample_id"), "lang")
    b = batching.routed_batches(docs, batch_size=100, seed=42)
    b = b.withColumn("jsonl", F.to_json(F.struct("record_id", "lang")))
    path = scratch_path(spark, "batches")
    writers.write_batches(b, path, batch_file_names=True, placed=True)
    back = spark.read.text(path).select(
        F.regexp_extract(F.col("_metadata.file_path"), r"batch_(\d+)\.jsonl$", 1).alias("batch_idx"),
        "value", F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("ln"),
    )
    g = back.groupBy("batch_idx").agg(
        F.count_distinct("f").cast("bigint").alias("n_files"),
        F.count(F.lit(1)).cast("bigint").alias("n_lines"),
        F.min_by(F.get_json_object("value", "$.record_id"), "ln").alias("first_record"),
        F.max_by(F.get_json_object("value", "$.record_id"), "ln").alias("last_record"),
    )
    return g.select(F.col("batch_idx").cast("bigint").alias("batch_idx"), "n_files", "n_lines", "first_record", "last_record")


def q_sample_predictions(spark, sf):
    """SNK-4 + SNK-5: per-sample prediction rows and the reasoning table, written and read back."""
    labels = derived.read_table(spark, sf, "labels").select(
        F.col("doc_id").alias("sample_id"), ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("gt")
    )
    s = scored(spark, sf).join(labels, "sample_id", "left")
    # both outputs from one projection: the scorer runs once per row (no self-join)
    rows = s.select(*writers.sample_prediction_cols("sample_id", "gt"), *writers.reasoning_cols("sample_id"))
    path = scratch_path(spark, "samples")
    rows.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def q_summary_text(spark, sf):
    """SNK-6: the plain-text summary per (dataset, model), written as text and read back."""
    m = metrics.eval_metrics(ev.raw_preds(spark, sf), ev.gt_table(spark, sf))
    path = scratch_path(spark, "summary")
    writers.summary_lines(m, ["dataset", "model"]).write.mode("overwrite").partitionBy("dataset", "model").text(path)
    back = spark.read.text(path, wholetext=True)
    return back.select("dataset", "model", F.col("value").alias("summary"))


def q_log_files(spark, sf):
    """SNK-9: the per-metric series written one folder per metric and read back."""
    from .reports import q_log_unpivot

    path = scratch_path(spark, "logs")
    writers.write_log_series(q_log_unpivot(spark, sf), path)
    back = spark.read.json(path)
    return back.groupBy("metric").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.min("step").cast("bigint").alias("first_step"),
        F.max("step").cast("bigint").alias("last_step"),
        F.round(F.sum("value"), 6).alias("total"),
    )


def q_stream_extract(spark, sf):
    """The extraction job as a Structured Streaming query (AvailableNow) over the files."""
    src = _raw_files(spark, sf, "stream-in")
    out = scratch_path(spark, "stream-out")
    stream_extract(spark, src, out, scratch_path(spark, "stream-ckpt"), src, glob="*.txt")
    back = spark.read.schema(scans.PARTS_SCHEMA).json(out)
    return back.select(
        "sample", "prediction", F.regexp_extract("source_file", "dataset=([^/]+)", 1).alias("dataset"),
        F.regexp_extract("source_file", "model=([^/]+)", 1).alias("model"),
    )


def q_extract_counts(spark, sf):
    """AGG-15: the extraction job over files; the counts it observes while it writes its rows,
    and its distributions, as one row per figure."""
    path = _raw_files(spark, sf, "extract-in")
    out = jobs.extract_job(spark, path, scratch_path(spark, "extract-out"), glob="*.txt")
    counts = spark.createDataFrame(sorted((f"parse {k}", v) for k, v in out["parse_counts"].items()), "figure string, n bigint")
    told = out["by_prediction"].select(F.concat(F.lit("answer "), "prediction").alias("figure"), "n")
    return counts.unionByName(told)


QUERIES = {
    "extract_counts": q_extract_counts,
    "sink_roundtrip": q_sink_roundtrip,
    "scan_roundtrip": q_scan_roundtrip,
    "batch_files": q_batch_files,
    "sample_predictions": q_sample_predictions,
    "summary_text": q_summary_text,
    "log_files": q_log_files,
    "stream_extract": q_stream_extract,
}


def _f4(x):
    return f"printf('%.4f', coalesce(CAST({x} AS DOUBLE), 0.0))"


ORACLE = {
    "extract_counts": with_ctes(R_CTE, ANSWERS_CTE) + """
SELECT 'parse lines' AS figure, CAST(count(*) AS BIGINT) AS n FROM r
UNION ALL SELECT 'parse malformed', CAST(count(*) FILTER (WHERE v = 7) AS BIGINT) FROM r
UNION ALL SELECT 'parse no_record_id', CAST(count(*) FILTER (WHERE v = 8) AS BIGINT) FROM r
UNION ALL SELECT 'parse error_record', CAST(count(*) FILTER (WHERE v = 6) AS BIGINT) FROM r
UNION ALL SELECT 'parse no_content', CAST(0 AS BIGINT)
UNION ALL SELECT 'answer ' || a_raw_tail, CAST(count(*) AS BIGINT) FROM ans GROUP BY a_raw_tail
""",
    "sink_roundtrip": ev.ORACLE["extract_predictions"],
    "scan_roundtrip": ev.ORACLE["eval_metrics"],
    "batch_files": """WITH d AS (SELECT doc_id AS sample_id,
       row_number() OVER (ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS pos FROM documents)
SELECT CAST(pos // 100 AS BIGINT) AS batch_idx, CAST(1 AS BIGINT) AS n_files, CAST(count(*) AS BIGINT) AS n_lines,
       'sample_' || CAST(arg_min(sample_id, pos) AS VARCHAR) AS first_record,
       'sample_' || CAST(arg_max(sample_id, pos) AS VARCHAR) AS last_record
FROM d GROUP BY ALL
""",
    "sample_predictions": _S + """
SELECT s.sample_id AS index, l.quality = 1 AND l.toxic = 0 AS ground_truth, model_predicted_label AS predicted_label,
       model_prediction_is_generation_successfull AS predicted_success, substr(model_response, 1, 2000) AS reasoning,
       CASE WHEN s.sample_id < 1000000000 THEN lpad(CAST(s.sample_id AS VARCHAR), 9, '0') ELSE CAST(s.sample_id AS VARCHAR) END AS sample_key, model_response AS response
FROM s LEFT JOIN labels l ON l.doc_id = s.sample_id
""",
    "summary_text": ev._ALIGNED + f"""
, c AS (SELECT dataset, model,
        count(*) FILTER (WHERE matched AND is_positive AND prediction = 'yes') AS tp,
        count(*) FILTER (WHERE matched AND NOT is_positive AND prediction = 'yes') AS fp,
        count(*) FILTER (WHERE matched AND is_positive AND prediction <> 'yes') AS fn,
        count(*) FILTER (WHERE matched AND NOT is_positive AND prediction <> 'yes') AS tn
      FROM a GROUP BY dataset, model)
SELECT dataset, model,
  'dataset: ' || dataset || chr(10) || 'model: ' || model ||
  chr(10) || 'Accuracy:  ' || {_f4('(tp + tn) / nullif(tp + fp + fn + tn, 0)')} ||
  chr(10) || 'Precision: ' || {_f4('tp / nullif(tp + fp, 0)')} ||
  chr(10) || 'Recall:    ' || {_f4('tp / nullif(tp + fn, 0)')} ||
  chr(10) || 'F1 Score:  ' || {_f4('2 * tp / nullif(2 * tp + fp + fn, 0)')} ||
  chr(10) || 'TP: ' || CAST(tp AS VARCHAR) || ', TN: ' || CAST(tn AS VARCHAR) ||
  chr(10) || 'FP: ' || CAST(fp AS VARCHAR) || ', FN: ' || CAST(fn AS VARCHAR) || chr(10) AS summary
FROM c
""",
    "log_files": """
SELECT event_type AS metric, CAST(count(*) AS BIGINT) AS n, CAST(min(event_id) AS BIGINT) AS first_step,
       CAST(max(event_id) AS BIGINT) AS last_step, round(sum(value), 6) AS total
FROM events WHERE value IS NOT NULL GROUP BY ALL
""",
    "stream_extract": with_ctes(R_CTE, ANSWERS_CTE) + "SELECT CAST(sample_id AS BIGINT) AS sample, a_raw_tail AS prediction, dataset, model FROM ans",
}
