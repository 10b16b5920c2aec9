"""Classification metrics over aligned predictions (AGG-1..11, AGG-16, AGG-18).

Every metric is a conditional aggregate in one ``groupBy`` pass (partial + final
aggregation), so a (dataset, model) group holding a third of all rows is reduced
map-side; nothing is collected per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import labels as L
from .align import outcome_counts, truth_counts

# Metric names, in the reference's record order (the JSON sink maps
# the *_positive/_negative names to their display keys).
METRIC_COLUMNS = [
    "total_evaluated",
    "total_predictions",
    "total_ground_truth",
    "accuracy",
    "precision_positive",
    "recall_positive",
    "f1_positive",
    "precision_negative",
    "recall_negative",
    "f1_negative",
    "true_positives",
    "true_negatives",
    "false_positives",
    "false_negatives",
    "gt_positive_count",
    "gt_negative_count",
    "pred_yes_count",
    "pred_no_count",
]
DISPLAY_NAMES = {
    "precision_positive": "precision_positive (Yes)",
    "recall_positive": "recall_positive (Yes)",
    "f1_positive": "f1_positive (Yes)",
    "precision_negative": "precision_negative (No)",
    "recall_negative": "recall_negative (No)",
    "f1_negative": "f1_negative (No)",
}


# The online evaluators' metrics record (scoring legs), in the reference's order.
ONLINE_METRIC_COLUMNS = [
    "accuracy",
    "precision",
    "recall",
    "f1_score",
    "true_positives",
    "true_negatives",
    "false_positives",
    "false_negatives",
    "total_samples",
    "positive_samples",
    "negative_samples",
]


def ratio(num: Column, den: Column, digits: int | None = None) -> Column:
    """``num/den`` as DOUBLE with zero_division=0."""
    r = F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))
    return F.round(r, digits) if digits is not None else r


def confusion_columns(tp: Column, fp: Column, fn: Column, tn: Column, digits: int | None = None) -> list[Column]:
    """AGG-2..4 from the four counts (F1 = 2tp / (2tp + fp + fn))."""
    n = tp + fp + fn + tn
    return [
        ratio(tp + tn, n, digits).alias("accuracy"),
        ratio(tp, tp + fp, digits).alias("precision_positive"),
        ratio(tp, tp + fn, digits).alias("recall_positive"),
        ratio(2 * tp, 2 * tp + fp + fn, digits).alias("f1_positive"),
        ratio(tn, tn + fn, digits).alias("precision_negative"),
        ratio(tn, tn + fp, digits).alias("recall_negative"),
        ratio(2 * tn, 2 * tn + fn + fp, digits).alias("f1_negative"),
    ]


def online_metrics(df: DataFrame, truth: str, predicted: str, group=(), digits: int | None = None) -> DataFrame:
    """UDF-7 + AGG-1..3 in the online evaluators' record: positive-class precision,
    recall and F1 (zero_division=0) and the confusion counts over the scored rows, per
    ``group`` (one row overall when empty); one pass with partial aggregation."""
    t, p = F.col(truth), F.col(predicted)
    c = df.groupBy(*group).agg(
        F.count_if(t & p).alias("true_positives"),
        F.count_if(~t & p).alias("false_positives"),
        F.count_if(t & ~p).alias("false_negatives"),
        F.count_if(~t & ~p).alias("true_negatives"),
    )
    tp, fp, fn, tn = (F.col(x) for x in ("true_positives", "false_positives", "false_negatives", "true_negatives"))
    acc, prec, rec, f1 = confusion_columns(tp, fp, fn, tn, digits)[:4]
    named = {
        "accuracy": acc.alias("accuracy"),
        "precision": prec.alias("precision"),
        "recall": rec.alias("recall"),
        "f1_score": f1.alias("f1_score"),
        "total_samples": (tp + fp + fn + tn).cast("bigint").alias("total_samples"),
        "positive_samples": (tp + fn).cast("bigint").alias("positive_samples"),
        "negative_samples": (tn + fp).cast("bigint").alias("negative_samples"),
    }
    return c.select(*group, *[named[n] if n in named else F.col(n).cast("bigint").alias(n) for n in ONLINE_METRIC_COLUMNS])


def eval_metrics(preds: DataFrame, gt: DataFrame, digits: int | None = None) -> DataFrame:
    """AGG-5/AGG-6: the 18-field metrics record per (dataset, model).

    Populations follow the reference: confusion counts and gt +/- over matched rows,
    ``pred_yes/no_count`` over all predictions, ``total_ground_truth`` over the whole
    dataset.  Datasets without ground truth are skipped (JON-5)."""
    return eval_metrics_of(outcome_counts(preds, gt), truth_counts(gt), digits)


def eval_metrics_of(outcomes: DataFrame, truths: DataFrame, digits: int | None = None) -> DataFrame:
    """``eval_metrics`` from the counts of the alignment."""
    m, t = F.col("matched"), F.col("is_positive")
    yes = F.coalesce(F.col("answer") == F.lit("yes"), F.lit(False))
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    counts = outcomes.groupBy("dataset", "model").agg(
        F.sum("n").alias("total_predictions"),
        total(m).alias("total_evaluated"),
        total(m & t & yes).alias("true_positives"),
        total(m & ~t & yes).alias("false_positives"),
        total(m & t & ~yes).alias("false_negatives"),
        total(m & ~t & ~yes).alias("true_negatives"),
        total(yes).alias("pred_yes_count"),
        total(F.col("answer") == F.lit("no")).alias("pred_no_count"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("true_positives", "false_positives", "false_negatives", "true_negatives"))
    ints = {
        "total_evaluated": F.col("total_evaluated"),
        "total_predictions": F.col("total_predictions"),
        "total_ground_truth": F.col("total_ground_truth"),
        "true_positives": tp,
        "true_negatives": tn,
        "false_positives": fp,
        "false_negatives": fn,
        "gt_positive_count": tp + fn,
        "gt_negative_count": fp + tn,
        "pred_yes_count": F.col("pred_yes_count"),
        "pred_no_count": F.col("pred_no_count"),
    }
    rcols = {name: col for name, col in zip(
        ["accuracy", "precision_positive", "recall_positive", "f1_positive", "precision_negative", "recall_negative", "f1_negative"],
        confusion_columns(tp, fp, fn, tn, digits),
    )}
    out = [F.col("dataset"), F.col("model")]
    for name in METRIC_COLUMNS:
        out.append(rcols[name] if name in rcols else ints[name].cast("bigint").alias(name))
    return counts.join(truths, "dataset").select(*out)


def metrics_by_reason(preds: DataFrame, gt: DataFrame, digits: int | None = None) -> DataFrame:
    """AGG-7: per (dataset, model, bucket) over matched rows; bucket = LBL-7.
    ``reason_rank`` orders buckets by count desc, ties by first sample id."""
    return metrics_by_reason_of(outcome_counts(preds, gt), digits)


def metrics_by_reason_of(outcomes: DataFrame, digits: int | None = None) -> DataFrame:
    """``metrics_by_reason`` from the counts of the alignment."""
    yes = F.coalesce(F.col("answer") == F.lit("yes"), F.lit(False))
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    agg = outcomes.filter("matched").groupBy("dataset", "model", "reason").agg(
        F.sum("n").alias("count"),
        total(yes == F.col("is_positive")).alias("correct_predictions"),
        total(yes).alias("predicted_yes"),
        total(~yes).alias("predicted_no"),
        F.min("first_index").alias("first_index"),
    )
    is_acc = F.col("reason") == F.lit(L.ACCEPTED)
    rank = F.row_number().over(Window.partitionBy("dataset", "model").orderBy(F.desc("count"), F.asc("first_index")))
    return agg.select(
        "dataset",
        "model",
        "reason",
        F.col("count").cast("bigint").alias("count"),
        ratio(F.col("correct_predictions"), F.col("count"), digits).alias("accuracy"),
        F.col("correct_predictions").cast("bigint").alias("correct_predictions"),
        F.col("predicted_yes").cast("bigint").alias("predicted_yes"),
        F.col("predicted_no").cast("bigint").alias("predicted_no"),
        ratio(F.when(is_acc, F.col("predicted_yes")).otherwise(F.col("predicted_no")), F.col("count"), digits).alias("recall"),
        rank.cast("bigint").alias("reason_rank"),
    )


def accept_reject_rollup(by_reason: DataFrame, digits: int | None = None) -> DataFrame:
    """AGG-9: accepted vs rejected totals from the per-reason rows."""
    side = F.when(F.col("reason") == F.lit(L.ACCEPTED), F.lit("accepted")).otherwise(F.lit("rejected"))
    g = by_reason.groupBy("dataset", "model", side.alias("side")).agg(
        F.sum("count").alias("samples"), F.sum("correct_predictions").alias("correct")
    )
    return g.select(
        "dataset",
        "model",
        "side",
        F.col("samples").cast("bigint").alias("samples"),
        F.col("correct").cast("bigint").alias("correct"),
        ratio(F.col("correct") * 100, F.col("samples"), digits).alias("pct_correct"),
    )


def value_counts(df: DataFrame, *cols: str, name: str = "n") -> DataFrame:
    """AGG-10: value distribution with counts (order at the sink: count desc)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).cast("bigint").alias(name))


def drop_counts(parsed: DataFrame, group=("dataset", "model")) -> DataFrame:
    """AGG-11: parse-error accounting by reason over the unfiltered parse output."""
    reason = F.coalesce(F.col("drop_reason"), F.lit("ok"))
    return parsed.groupBy(*group, reason.alias("drop_reason")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def nested_metrics(metrics: DataFrame, by_reason: DataFrame) -> DataFrame:
    """AGG-18/SNK-3: one JSON document per dataset, ``{model: {metrics..., per_rejection_reason: {...}}}``
    with the reference's display keys.  Collection is per dataset over per-model rows, which are
    bounded by models x reasons, never by samples."""
    reason_fields = ["count", "accuracy", "correct_predictions", "predicted_yes", "predicted_no", "recall"]
    per_reason = by_reason.groupBy("dataset", "model").agg(
        F.map_from_entries(
            F.collect_list(F.struct(F.col("reason"), F.struct(*[F.col(c) for c in reason_fields])))
        ).alias("per_rejection_reason")
    )
    body = F.struct(
        *[F.col(c).alias(DISPLAY_NAMES.get(c, c)) for c in METRIC_COLUMNS],
        F.coalesce(F.col("per_rejection_reason"), F.create_map().cast("map<string,struct<count:bigint,accuracy:double,correct_predictions:bigint,predicted_yes:bigint,predicted_no:bigint,recall:double>>")).alias("per_rejection_reason"),
    )
    per_model = metrics.join(per_reason, ["dataset", "model"], "left").select("dataset", "model", body.alias("m"))
    return per_model.groupBy("dataset").agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("model", "m")))).alias("metrics_json")
    )
