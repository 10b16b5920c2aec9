"""Distributed dense row index (WIN-5, and WIN-1's re-index).

``row_number()`` over an unpartitioned (or coarsely partitioned) window pulls a
whole group into one task.  Here the rows are range-partitioned on
(group, order) keys so a hot group is split across many tasks; each task numbers
its rows locally, and a small per-(partition, group) count table turns local
positions into global ones.  The range-partitioned rows are checkpointed first so
positions cannot move if a task is re-run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint

POS_BITS = 33  # monotonically_increasing_id = partition index << 33 | position
BROADCAST_ROWS = 2_000_000  # the count table has at most partitions + groups rows


def dense_index(
    df: DataFrame,
    order_cols: list,
    group_cols: list[str] | tuple = (),
    out: str = "idx",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``out`` = 0-based position of each row within its group in ``order_cols``
    order (ties must be broken by the caller's keys for determinism)."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    group_cols = list(group_cols)
    keys = [*group_cols, *order_cols]
    ranged = (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    ranged = checkpoint(ranged)
    ranged = ranged.select(
        "*",
        F.shiftrightunsigned("_mid", POS_BITS).alias("_pid"),
        F.col("_mid").bitwiseAND(F.lit((1 << POS_BITS) - 1)).alias("_pos"),
    ).drop("_mid")
    seg = ranged.groupBy("_pid", *group_cols).agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    seg = checkpoint(seg.select("_pid", *group_cols, "_first", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off")))
    # seg has at most (partitions + groups) rows; broadcast it only when that is small.
    seg_side = F.broadcast(seg) if seg.count() <= BROADCAST_ROWS else seg
    # Null-safe on the group keys so a NULL group is indexed like any other.
    r, s = ranged.alias("_r"), seg_side.alias("_s")
    cond = [F.col("_r._pid") == F.col("_s._pid")] + [F.col(f"_r.{c}").eqNullSafe(F.col(f"_s.{c}")) for c in group_cols]
    joined = r.join(s, cond).select("_r.*", "_s._first", "_s._off")
    return joined.withColumn(out, F.col("_off") + F.col("_pos") - F.col("_first")).drop("_pid", "_pos", "_first", "_off")


# A group above this many rows is split over tasks by ``dense_index``; at most
# rows / HOT_ROWS groups can be that large, and their key list is broadcast only below
# MAX_HOT_GROUPS keys (otherwise every group takes the distributed index).
HOT_ROWS = 1_000_000
MAX_HOT_GROUPS = 100_000


def grouped_index(
    df: DataFrame,
    order_cols: list,
    group_cols: list[str] | tuple,
    out: str = "idx",
    hot_rows: int = HOT_ROWS,
    num_partitions: int | None = None,
) -> DataFrame:
    """``out`` = 0-based position of each row within its group in ``order_cols`` order
    (ties must be broken by the caller's keys for determinism).

    Hot keys are split off: group sizes come from one partial aggregate; the groups
    above ``hot_rows`` rows go through ``dense_index``, which spreads one group over
    many tasks, and every other group is numbered by a window in one shuffle, each
    group holding at most ``hot_rows`` rows.  Many small groups (one per conversation)
    thus avoid the index's offset join, and one huge group never lands in one task."""
    group_cols = list(group_cols)
    if not group_cols:  # one global order: the distributed index (no single-task window)
        return dense_index(df, order_cols, (), out, num_partitions).withColumn(out, F.col(out).cast("bigint"))
    sizes = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_n"))
    hot = checkpoint(sizes.filter(F.col("_n") > hot_rows).select(*group_cols))
    n_hot = hot.count()
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    if n_hot == 0:
        return df.withColumn(out, (F.row_number().over(w) - 1).cast("bigint"))
    if n_hot > MAX_HOT_GROUPS:
        return dense_index(df, order_cols, group_cols, out, num_partitions).withColumn(out, F.col(out).cast("bigint"))
    keys = [f"_hot_k{i}" for i in range(len(group_cols))]
    h = F.broadcast(hot.select(*[F.col(c).alias(k) for c, k in zip(group_cols, keys)], F.lit(True).alias("_hot")))
    cond = [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(group_cols, keys)]
    tagged = df.join(h, cond, "left").drop(*keys)
    cold = tagged.filter(F.col("_hot").isNull()).drop("_hot").withColumn(out, (F.row_number().over(w) - 1).cast("bigint"))
    warm = dense_index(tagged.filter(F.col("_hot")).drop("_hot"), order_cols, group_cols, out, num_partitions)
    return cold.unionByName(warm.withColumn(out, F.col(out).cast("bigint")))
