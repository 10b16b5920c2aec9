"""Expected sampling categories per split and the check against observed ones (LBL-9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import ACCEPTED

# The expected rejection reasons of the two dataset styles.
R_REASONS = [
    "Irrelevant Objects",
    "Geometry Artifacts",
    "Texture/Lighting/Color Issues",
    "Wrong Orientation",
    "Generated-Main Image Mismatch (Color/Material/Pattern)",
    "Background Issues",
]
S_REASONS = [
    "wrong_orientation",
    "wrong_product_same_pt",
    "wrong_product_different_pt",
]


def expected_categories(spark: SparkSession, by_split: dict[str, list[str]]) -> DataFrame:
    """A small fixed table (split, category): each split's reasons plus ``accepted``."""
    rows = [(split, c) for split, reasons in by_split.items() for c in [*reasons, ACCEPTED]]
    return spark.createDataFrame(rows, "split string, category string")


def category_check(observed: DataFrame, expected: DataFrame) -> DataFrame:
    """Observed categories (split, category) against the expected table: ``ok``,
    ``unexpected`` (seen, not expected) or ``missing`` (expected, not seen).
    The observed side is aggregated first (partial aggregation), so the join only
    sees one row per (split, category); the expected side is a fixed small table.  A full
    outer join has no broadcast form, so both small sides meet in one shuffle join."""
    o = observed.groupBy("split", "category").agg(F.count(F.lit(1)).alias("n")).alias("o")
    e = expected.alias("e")
    cond = (F.col("o.split") == F.col("e.split")) & F.col("o.category").eqNullSafe(F.col("e.category"))
    j = o.join(e, cond, "full_outer")
    return j.select(
        F.coalesce("o.split", "e.split").alias("split"),
        F.coalesce("o.category", "e.category").alias("category"),
        F.coalesce("o.n", F.lit(0)).cast("bigint").alias("n_observed"),
        F.when(F.col("o.split").isNull(), F.lit("missing"))
        .when(F.col("e.split").isNull(), F.lit("unexpected"))
        .otherwise(F.lit("ok"))
        .alias("status"),
    )
