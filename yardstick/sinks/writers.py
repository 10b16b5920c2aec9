"""Sinks (SNK-1..9).  Every writer is a distributed DataFrame write (no ``coalesce(1)``,
no driver-side file loop); callers pass a folder on shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.metrics import DISPLAY_NAMES
from ..sources import heads


def write_predictions(df: DataFrame, path: str) -> None:
    """SNK-1: extracted predictions as partitioned JSON lines, overwrite."""
    df.write.mode("overwrite").json(path)


def write_batches(df: DataFrame, path: str, json_col: str = "jsonl", batch_col: str = "batch_idx", order_col: str = "pos",
                  num_partitions: int | None = None, batch_file_names: bool = False, placed: bool = False) -> None:
    """SNK-2: each batch's JSON lines in position order, one file per batch.  Files land in
    ``batch_idx=<k>/`` folders, or with ``batch_file_names`` as ``<path>/batch_<k>.jsonl``,
    the reference's layout, published by the job's commit (``sinks.batch_files``).  A
    batch's rows are hash-partitioned into one task and sorted within it, unless they are
    ``placed`` already (``batching.routed_batches``): then the write moves no row."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(batch_col, order_col, F.col(json_col).alias("value"))
    if not placed:
        rows = rows.repartition(n, batch_col).sortWithinPartitions(batch_col, order_col)
    if not batch_file_names:
        rows.select(batch_col, "value").write.mode("overwrite").partitionBy(batch_col).text(path)
        return
    from . import batch_files

    if not heads.reachable(path):
        raise ValueError(f"no file system for {path}: batch files are written to {', '.join(heads.SCHEMES)} or local paths")
    batch_files.register(df.sparkSession)
    named = rows.select(F.concat(F.lit("batch_"), F.col(batch_col).cast("string"), F.lit(".jsonl")).alias("name"), "value")
    named.write.format(batch_files.NAME).mode("overwrite").save(path)


def write_metrics(nested: DataFrame, path: str) -> None:
    """SNK-3: the nested dataset -> model -> metrics documents, one JSON line per dataset."""
    nested.write.mode("overwrite").json(path)


def sample_prediction_cols(index_col: str, ground_truth: str, max_reasoning: int = 2000) -> list:
    """SNK-4 columns: index, ground truth, label, success, reasoning cut to 2000 chars."""
    return [
        F.col(index_col).alias("index"),
        F.col(ground_truth).alias("ground_truth"),
        F.coalesce(F.col("model_predicted_label"), F.lit("")).alias("predicted_label"),
        F.col("model_prediction_is_generation_successfull").alias("predicted_success"),
        F.substring(F.coalesce(F.col("model_response"), F.lit("")), 1, max_reasoning).alias("reasoning"),
    ]


def reasoning_cols(index_col: str) -> list:
    """SNK-5 re-aimed: (sample_key = id of at least 9 digits, response) instead of a file
    per row; longer ids are kept whole."""
    key = F.col(index_col).cast("string")
    return [
        F.when(F.length(key) < 9, F.lpad(key, 9, "0")).otherwise(key).alias("sample_key"),
        F.coalesce(F.col("model_response"), F.lit("")).alias("response"),
    ]


def sample_predictions(scored: DataFrame, index_col: str, ground_truth: str, max_reasoning: int = 2000) -> DataFrame:
    """SNK-4: per-sample rows (see ``sample_prediction_cols``)."""
    return scored.select(*sample_prediction_cols(index_col, ground_truth, max_reasoning))


def reasoning_table(scored: DataFrame, index_col: str) -> DataFrame:
    """SNK-5 re-aimed: one table (sample_key, response) instead of a file per row."""
    return scored.select(*reasoning_cols(index_col))


def summary_lines(metrics: DataFrame, title_cols: list[str]) -> DataFrame:
    """SNK-6: a plain-text run summary per group, as one string column for ``write.text``.
    Takes either metrics record: the offline one (``precision_positive``...) or the online
    evaluators' one (``precision``, ``recall``, ``f1_score``)."""
    f = lambda c: F.format_string("%.4f", F.col(c))
    pick = lambda *names: next(n for n in names if n in metrics.columns)
    head = F.concat_ws("\n", *[F.concat(F.lit(f"{c}: "), F.col(c)) for c in title_cols])
    body = F.concat(
        F.lit("\nAccuracy:  "), f("accuracy"),
        F.lit("\nPrecision: "), f(pick("precision", "precision_positive")),
        F.lit("\nRecall:    "), f(pick("recall", "recall_positive")),
        F.lit("\nF1 Score:  "), f(pick("f1_score", "f1_positive")),
        F.lit("\nTP: "), F.col("true_positives").cast("string"), F.lit(", TN: "), F.col("true_negatives").cast("string"),
        F.lit("\nFP: "), F.col("false_positives").cast("string"), F.lit(", FN: "), F.col("false_negatives").cast("string"),
    )
    return metrics.select(*title_cols, F.concat(head, body).alias("value"))


def write_log_series(series: DataFrame, path: str, num_partitions: int | None = None) -> None:
    """SNK-9: one folder per metric holding its (step, epoch, value) series.  Range
    partitioning on (metric, step) splits a long series over several tasks, each
    writing one contiguous, ordered step range."""
    n = num_partitions or int(series.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        series.repartitionByRange(n, "metric", "step")
        .sortWithinPartitions("metric", "step")
        .write.mode("overwrite")
        .partitionBy("metric")
        .json(path)
    )


def display_metrics(metrics: DataFrame) -> DataFrame:
    """Metric columns renamed to the reference's display keys for JSON output."""
    return metrics.select(*[F.col(c).alias(DISPLAY_NAMES.get(c, c)) for c in metrics.columns])


def write_sample(sample: DataFrame, manifest_doc: DataFrame, path: str) -> None:
    """SNK-7: the sampled rows as Parquet and the index manifest (one JSON line per
    split: categories -> ids, all_indices) next to them."""
    sample.write.mode("overwrite").parquet(f"{path}/data")
    manifest_doc.write.mode("overwrite").json(f"{path}/train_indices")


def write_holdout_results(summary: DataFrame, predictions: DataFrame, path: str, elapsed_s: float | None = None) -> None:
    """SNK-8: hold-out summary (accuracy, correct, total, elapsed) and the per-row
    predictions, as JSON folders."""
    s = summary if elapsed_s is None else summary.withColumn("elapsed_s", F.lit(round(elapsed_s, 1)))
    s.write.mode("overwrite").json(f"{path}/summary")
    predictions.write.mode("overwrite").json(f"{path}/predictions")


def name_data_files(spark, path: str, suffix: str | dict[str, str]) -> int:
    """Give the data files Spark wrote below ``path`` (``part-*``) the file-name suffix a
    consumer selects on, e.g. ``.jsonl.out`` for raw batch outputs (Spark's text writer
    always ends names in ``.txt``).  Metadata only: one rename per written file through
    the Hadoop file system (any shared store), never a read of the rows; the number of
    files is the number of write tasks.  ``suffix`` may map a folder name below ``path``
    (e.g. ``kind=raw``) to its suffix; files in other folders keep their names.
    Returns the number of files renamed."""
    import re

    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path  # resolved once, not per file
    root = Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.listFiles(root, True)
    todo = []
    while found.hasNext():
        p = found.next().getPath().toString()
        if p.rsplit("/", 1)[-1].startswith("part-"):
            todo.append(p)
    base = str(root.toUri().getPath()).rstrip("/") + "/"
    done = 0
    for p in todo:
        if isinstance(suffix, dict):
            top = p.split(base, 1)[-1].split("/", 1)[0]
            if top not in suffix:
                continue
            end = suffix[top]
        else:
            end = suffix
        fs.rename(Path(p), Path(re.sub(r"(\.c\d{3})?\.(txt|json)$", "", p) + end))
        done += 1
    return done
