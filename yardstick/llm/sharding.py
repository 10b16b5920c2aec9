"""Sharding (operator 9): k-d tree partitioning at distributed weighted medians.

Every metadata column is a dimension, scaled to [0, 2^20); a tree node is split along its
widest dimension, at the weight (text bytes plus 8) that gives each side its share of the
shards, until a leaf is one shard of about the target bytes.  All nodes of a level are
split together.

A weighted median is found by refining a histogram: rows are binned between the node's
bounds, one partial aggregate sums the bins, a running sum per node picks the bin that
holds the wanted weight, and that bin is binned again until it weighs little or is one
key.  A key is the scaled dimension followed by a hash of id and text, so one source, or
one value, that holds a third of all rows is still cut where the bytes are equal.  The
driver sees one row per node and round.  Slots come from the distributed dense index.

Only DataFrame functions run here.

Defined cases: a null or empty text weighs 8 bytes and has checksum 0; null metadata is
the smallest value of its dimension, a null id is hashed like any value; rows repeated
with equal id and text stay together; an empty table gives an empty result; columns that
are not named as dimensions are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.indexing import dense_index
from .tables import written

SCALE_BITS = 20
TIE_BITS = 42
BIN_BITS = 10
TOLERANCE = 0.0005  # of a shard's target bytes


def rows_of(docs: DataFrame, dims: list[str]) -> DataFrame:
    """doc_id, size, text_crc32, the dimensions as longs, and the tie hash."""
    types = dict(docs.dtypes)
    text = F.coalesce(F.col("text"), F.lit(""))

    def number(c):
        if c == "size":
            return F.octet_length(text).cast("bigint") + 8
        if types[c] == "string":
            return F.coalesce(F.crc32(F.col(c)), F.lit(-1)).cast("bigint")
        return F.coalesce(F.col(c).cast("bigint"), F.lit(0).cast("bigint"))

    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text).cast("bigint") + 8).alias("size"),
        F.crc32(text).cast("bigint").alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 64 - TIE_BITS).alias("_tie"),
        *[number(c).alias(f"_v{i}") for i, c in enumerate(dims)],
    )


def scaled(rows: DataFrame, n_dims: int) -> DataFrame:
    """The dimensions as sortable keys: scaled value, then the tie hash."""
    bounds = rows.agg(*[f(F.col(f"_v{i}").cast("double")) for i in range(n_dims) for f in (F.min, F.max)]).first()
    out = []
    for i in range(n_dims):
        lo, hi = bounds[2 * i] or 0.0, bounds[2 * i + 1] or 0.0
        top = (1 << SCALE_BITS) - 1
        v = F.lit(0).cast("bigint") if hi <= lo else F.floor((F.col(f"_v{i}").cast("double") - lo) * (top / (hi - lo))).cast("bigint")
        out.append((F.shiftleft(v, TIE_BITS) + F.col("_tie")).alias(f"_k{i}"))
    return rows.select("doc_id", "size", "text_crc32", *out)


def widest(rows: DataFrame, n_dims: int) -> dict[int, tuple[int, float]]:
    """Per node the widest dimension (the first of equals) and the node's bytes."""
    spread = [(F.shiftright(F.max(f"_k{i}"), TIE_BITS) - F.shiftright(F.min(f"_k{i}"), TIE_BITS)).alias(f"w{i}") for i in range(n_dims)]
    stats = rows.groupBy("node").agg(F.sum("size").alias("bytes"), *spread).collect()  # one row per node
    return {r["node"]: (max(range(n_dims), key=lambda i: (r[f"w{i}"], -i)), r["bytes"]) for r in stats}


def small_table(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows as literals of a plan, so that no Python worker has to read them."""
    columns = [c.split() for c in schema.split(", ")]
    values = [F.struct(*[F.lit(v).cast(t).alias(c) for v, (c, t) in zip(row, columns)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*values)))


def split_points(rows: DataFrame, wanted: dict[int, tuple[int, float]], target: float, n_dims: int) -> dict[int, int]:
    """Per node the key at which the wanted weight lies: rows below it go left."""
    spark = rows.sparkSession
    open_ = {n: (dim, 0, SCALE_BITS + TIE_BITS, 0.0, want) for n, (dim, want) in wanted.items()}
    cuts: dict[int, int] = {}
    while open_:
        plan = [(n, dim, lo, bits, max(0, bits - BIN_BITS), float(below), float(want)) for n, (dim, lo, bits, below, want) in open_.items()]
        plan = F.broadcast(small_table(spark, plan, "node int, dim int, lo bigint, bits int, shift int, below double, want double"))  # one row per node
        key = F.coalesce(*[F.when(F.col("dim") == i, F.col(f"_k{i}")) for i in range(n_dims)])
        inside = rows.join(plan, "node").withColumn("_key", key).where("_key >= lo and shiftright(_key - lo, bits) = 0")
        bins = inside.groupBy("node", "lo", "shift", "below", "want", F.expr("shiftright(_key - lo, shift)").alias("bin")).agg(F.sum("size").alias("w"))
        run = Window.partitionBy("node").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        placed = bins.withColumn("before", F.col("below") + F.coalesce(F.sum("w").over(run), F.lit(0)))
        # the bin that holds the wanted weight, or the last one
        holding = placed.withColumn("_ok", F.col("before") <= F.col("want")).where("_ok")
        last = holding.groupBy("node").agg(F.max(F.struct("bin", "lo", "shift", "before", "w", "want")).alias("x")).select("node", "x.*")
        for r in last.collect():  # one row per node
            lo, n = r["lo"] + (r["bin"] << r["shift"]), r["node"]
            if r["shift"] == 0 or r["w"] <= TOLERANCE * target:
                up = r["want"] - r["before"] > r["before"] + r["w"] - r["want"]  # the nearer edge of the bin
                cuts[n] = lo + (1 << r["shift"]) if up else lo
                del open_[n]
            else:
                open_[n] = (open_[n][0], lo, r["shift"], r["before"], r["want"])
    return cuts


def kd_shards(docs: DataFrame, shards: int, dims: list[str]) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    rows = written(scaled(written(rows_of(docs, dims), "kd-rows"), len(dims)), "kd-keys")
    rows = rows.withColumn("node", F.lit(0))
    leaves = {0: shards}  # first shard of a node -> its number of shards
    while any(k > 1 for k in leaves.values()):
        shape = widest(rows, len(dims))
        if not shape:
            break
        target = sum(b for _, b in shape.values()) / shards
        wanted = {n: (dim, w * (leaves[n] // 2) / leaves[n]) for n, (dim, w) in shape.items() if leaves[n] > 1}
        cuts = split_points(rows, wanted, target, len(dims))
        plan = [(n, wanted[n][0], cut, n + leaves[n] // 2) for n, cut in cuts.items()]
        plan = F.broadcast(small_table(rows.sparkSession, plan, "node int, dim int, cut bigint, right_node int"))  # one row per node
        key = F.coalesce(*[F.when(F.col("dim") == i, F.col(f"_k{i}")) for i in range(len(dims))])
        moved = rows.join(plan, "node", "left").withColumn("_node", F.when(key >= F.col("cut"), F.col("right_node")).otherwise(F.col("node")))
        rows = written(moved.drop("node", "dim", "cut", "right_node").withColumnRenamed("_node", "node"), "kd-level")
        leaves = {m: k for n, c in leaves.items() for m, k in (((n, c // 2), (n + c // 2, c - c // 2)) if c > 1 else ((n, c),))}
    placed = rows.select("doc_id", "size", "text_crc32", F.col("node").cast("int").alias("shard"))
    slots = dense_index(placed, ["doc_id", "text_crc32", "size"], ["shard"], "slot")
    return slots.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
