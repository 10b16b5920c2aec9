"""Exact, seeded sampling (SMP-1..4, WIN-3, WIN-4, AGG-12, SET-2).

The contract is exact counts and seed determinism: rows are ranked by
``md5('<seed>:<id>')`` (identical in Spark and DuckDB), never by a Python RNG or
the approximate ``sampleBy``/``randomSplit``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .indexing import dense_index


def seeded_hash(seed: int, id_col: str = "sample_id") -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def stratified_sample(df: DataFrame, strata: list[str], n: int, seed: int = 42, id_col: str = "sample_id") -> DataFrame:
    """SMP-1/WIN-3: exactly ``min(n, |group|)`` rows per stratum.

    ``row_number() <= n`` lets Catalyst plan a ``WindowGroupLimit`` before the
    shuffle, so each map task ships at most ``n`` rows per stratum and a hot
    stratum never lands whole in one task."""
    w = Window.partitionBy(*strata).orderBy(seeded_hash(seed, id_col), F.col(id_col))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


# Fixed value: the key a missing category has in the JSON manifest.
NULL_CATEGORY = "null"


def manifest_lists(sampled: DataFrame, split_col: str = "split", category_col: str = "category", id_col: str = "sample_id") -> DataFrame:
    """AGG-12/SNK-7: sorted id list per (split, category), NULL being a category of its
    own, plus the flat sorted list per split (``all_categories`` true, category NULL).
    Runs on the sample only, bounded by n x categories."""
    n, ids = F.count(F.lit(1)).cast("bigint").alias("n"), F.sort_array(F.collect_list(id_col)).alias("ids")
    per_cat = sampled.groupBy(split_col, category_col).agg(n, ids).withColumn("all_categories", F.lit(False))
    flat = sampled.groupBy(split_col).agg(n, ids).withColumn("all_categories", F.lit(True))
    return per_cat.unionByName(flat, allowMissingColumns=True)


def manifest_document(
    manifest: DataFrame,
    split_col: str = "split",
    category_col: str = "category",
    seed: int | None = None,
    samples_per_category: int | None = None,
) -> DataFrame:
    """Nested manifest for the JSON sink: one row per split with ``categories``
    (category -> sorted ids) and ``all_indices`` (the flat sorted list), plus the
    sampling ``seed`` and ``samples_per_category`` when given.  A NULL category is listed
    under ``null``; its ids join those of a category of that very name."""
    cats = manifest.filter(~F.col("all_categories")).withColumn(category_col, F.coalesce(F.col(category_col), F.lit(NULL_CATEGORY)))
    cats = cats.groupBy(split_col, category_col).agg(F.sort_array(F.flatten(F.collect_list("ids"))).alias("ids"))
    flat = manifest.filter(F.col("all_categories")).select(split_col, F.col("ids").alias("all_indices"))
    per_split = cats.groupBy(split_col).agg(F.map_from_entries(F.collect_list(F.struct(category_col, "ids"))).alias("categories"))
    doc = per_split.join(flat, split_col, "full_outer")
    if seed is not None:
        doc = doc.withColumn("seed", F.lit(seed).cast("bigint"))
    if samples_per_category is not None:
        doc = doc.withColumn("samples_per_category", F.lit(samples_per_category).cast("bigint"))
    return doc


def manifest_rows(doc: DataFrame, split_col: str = "split") -> DataFrame:
    """SRC-9: manifest document rows (as written by the JSON sink and read back with
    ``spark.read.json``) -> excluded ids (split, sample_id)."""
    return doc.select(F.col(split_col).alias("split"), F.explode("all_indices").alias("sample_id")).select(
        "split", F.col("sample_id").cast("bigint").alias("sample_id")
    )


def exclude(df: DataFrame, manifest_rows: DataFrame, keys=("split", "sample_id")) -> DataFrame:
    """SMP-4/JON-6: rows not used for training (left anti join on split and id)."""
    return df.join(manifest_rows.select(*keys), list(keys), "left_anti")


def pair_at(keyed: DataFrame, k: int, id_col: str):
    """The (hash, id) pair at position ``k`` of the seeded order, None beyond the end.
    Only the pairs are indexed; one row reaches the driver."""
    pairs = keyed.select("_h", F.col(id_col).alias("_id"))
    return dense_index(pairs, ["_h", "_id"], out="_at").filter(F.col("_at") == k).select("_h", "_id").first()


def at_most(cut, id_col: str, strict: bool = False) -> Column:
    """Rows up to a (hash, id) pair in the seeded order (NULL hash and id first)."""
    h, i = F.col("_h"), F.col(id_col)
    if cut["_h"] is None:  # a NULL id has a NULL hash
        return F.lit(False) if strict else h.isNull()
    equal = (h == cut["_h"]) & (i == cut["_id"])
    below = h.isNull() | (h < cut["_h"]) | ((h == cut["_h"]) & (i < cut["_id"]))
    return below if strict else below | equal


def holdout_split(df: DataFrame, seed: int = 42, share: float = 0.2, id_col: str = "sample_id") -> DataFrame:
    """SMP-3/WIN-4: exact hold-out of ``max(1, int(share * n))`` rows when ``n > 2``
    (none otherwise), chosen by seeded hash.  The distributed index runs on the narrow
    (hash, id) pairs and yields the pair at the cut; the rows are split by one filter and
    are not shuffled.  Rows that share the pair at the cut are numbered to keep the count."""
    n = df.count()
    k = max(1, int(n * share)) if n > 2 else 0
    keyed = df.withColumn("_h", seeded_hash(seed, id_col))
    part = lambda held: F.when(held, F.lit("eval")).otherwise(F.lit("train")).alias("part")
    if k == 0:
        return df.select("*", part(F.lit(False)))
    cut = pair_at(keyed, k - 1, id_col)
    before, upto = at_most(cut, id_col, strict=True), at_most(cut, id_col)
    counts = keyed.agg(F.count_if(before).alias("below"), F.count_if(upto).alias("upto")).first()
    if counts["upto"] == k:
        return keyed.select(*df.columns, part(upto))
    ties = dense_index(keyed.filter(upto & ~before), [id_col], out="_rank")
    ties = ties.select(*df.columns, part(F.col("_rank") < k - counts["below"]))
    return keyed.filter(before | ~upto).select(*df.columns, part(before)).unionByName(ties)
