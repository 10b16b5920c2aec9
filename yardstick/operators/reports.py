"""Report reshaping: training-log series (AGG-14), facets and filters (AGG-17, SET-4),
report rows (LBL-8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L


# Training-log keys and the series names they are summarised under.
TRAINER_LOG_METRICS = {
    "loss": "train_loss",
    "eval_loss": "eval_loss",
    "learning_rate": "learning_rate",
    "grad_norm": "grad_norm",
    "mean_token_accuracy": "mean_token_accuracy",
}


def log_series(wide: DataFrame, metrics: list[str] | dict[str, str], step: str = "step", epoch: str = "epoch") -> DataFrame:
    """AGG-14: a ragged wide log (one nullable column per metric) -> long rows
    (metric, step, epoch, value) with NULL entries dropped.  ``metrics`` lists the metric
    columns, or maps each column to its series name (``TRAINER_LOG_METRICS``); columns
    absent from the log give no rows.  The per-metric series is kept as rows (a sink
    writes it partitioned by metric), never collected into one array."""
    names = metrics if isinstance(metrics, dict) else {m: m for m in metrics}
    present = {c: n for c, n in names.items() if c in wide.columns}
    if not present:
        return wide.sparkSession.createDataFrame([], "metric string, step bigint, epoch double, value double")
    wide = wide.select(step, epoch, *[F.col(c).cast("double").alias(n) for c, n in present.items()])
    long = wide.unpivot([step, epoch], list(present.values()), "metric", "value")
    return long.filter(F.col("value").isNotNull()).select(
        "metric", F.col(step).alias("step"), F.col(epoch).alias("epoch"), F.col("value").cast("double").alias("value")
    )


def report_rows(df: DataFrame, fields: list[str], split_col: str = "split", keep: list[str] = ()) -> DataFrame:
    """LBL-8: the report projection: normalised label, reason and metadata with ''
    for missing values; an absent ``split`` column reads ``unknown``."""
    split = F.col(split_col) if split_col in df.columns else F.lit("unknown")
    label = F.col("label") if "label" in df.columns else F.lit(None).cast("string")
    cols = [*keep, split.alias("split"), L.label_lenient(label).alias("label_norm")]
    for f in fields:
        cols.append(L.report_field(F.col(f) if f in df.columns else F.lit(None).cast("string")).alias(f))
    return df.select(*cols)


def facets(rows: DataFrame, cols: list[str]) -> DataFrame:
    """AGG-17/SET-4: distinct values with counts of several columns in one pass: the
    columns are unpivoted to (facet, value) and counted with partial aggregation.
    Empty values are left out, as in the reference's filter lists."""
    long = rows.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "facet", "value")
    long = long.filter(F.coalesce(F.col("value"), F.lit("")) != "")
    return long.groupBy("facet", "value").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def filter_counts(rows: DataFrame, cols: list[str], all_marker: str = "all") -> DataFrame:
    """AGG-17 filter: the visible row count for every combination of "all or equals"
    on each column, via ``cube`` (one shuffle over partial aggregates)."""
    g = rows.cube(*cols).agg(F.count(F.lit(1)).cast("bigint").alias("n"), *[F.grouping(c).alias(f"_g_{c}") for c in cols])
    return g.select(
        *[F.when(F.col(f"_g_{c}") == 1, F.lit(all_marker)).otherwise(F.col(c)).alias(c) for c in cols], "n"
    )
