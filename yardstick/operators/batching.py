"""Shuffle, slice, batch and manifest of inference inputs (BAT-1..5, BAT-19, BAT-20, WIN-5).

Positions are explicit columns: a seeded shuffle is an order by ``md5(seed:id)``
turned into a dense position by the distributed index; the original ``sample_id``
always travels with the row (so predictions align with ground truth later, which
the positional ids of the reference do not guarantee after a shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .indexing import POS_BITS, dense_index
from .sampling import at_most, pair_at, seeded_hash


def positions(df: DataFrame, seed: int | None = None, id_col: str = "sample_id") -> DataFrame:
    """BAT-4/WIN-5: ``pos`` = dense 0-based position, in id order or seeded-shuffle order."""
    if seed is None:
        return dense_index(df, [id_col], out="pos")
    keyed = df.withColumn("_h", seeded_hash(seed, id_col))
    return dense_index(keyed, ["_h", id_col], out="pos").drop("_h")


def slice_batches(df: DataFrame, batch_size: int = 500, start: int = 0, max_samples: int | None = None, id_col: str = "sample_id") -> DataFrame:
    """BAT-1..3: rows with ``start <= pos < start + max_samples``, ``record_id = sample_<id>``
    and ``batch_idx = (pos - start) div batch_size``."""
    cond = F.col("pos") >= start
    if max_samples is not None:
        cond = cond & (F.col("pos") < start + max_samples)
    return df.filter(cond).select(
        "*",
        F.concat(F.lit("sample_"), F.col(id_col).cast("string")).alias("record_id"),
        F.expr(f"(pos - {int(start)}) div {int(batch_size)}").alias("batch_idx"),
    )


def routed_batches(
    df: DataFrame,
    batch_size: int = 500,
    start: int = 0,
    max_samples: int | None = None,
    seed: int | None = None,
    id_col: str = "sample_id",
    routes: int | None = None,
) -> DataFrame:
    """BAT-1..4/WIN-5 with the wide rows moved once: ``pos``, ``record_id`` and ``batch_idx``
    as by ``slice_batches(positions(...))``, the rows of a batch together in one partition
    in position order.

    The index runs on the narrow (hash, id) keys.  The keys at the borders of at most
    ``routes`` runs of whole batches reach the driver; every row finds its run by a binary
    search among them, rows outside the slice are dropped before the exchange, and one
    exchange takes the others straight to their partition, where the sorted place gives
    the position.  Where a key is repeated across a border (ids that are not unique), the
    keys cannot part the rows and the whole rows are indexed."""
    n_routes = routes or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df if seed is None else df.withColumn("_h", seeded_hash(seed, id_col))
    keys = [id_col] if seed is None else ["_h", id_col]
    narrow = keyed.select(F.struct(*keys).alias("_key"))
    indexed = dense_index(narrow, ["_key"], out="_at")
    n = indexed.count()
    stop = n if max_samples is None else min(n, start + max_samples)
    if stop <= start:
        return slice_batches(df.filter(F.lit(False)).withColumn("pos", F.lit(0).cast("bigint")), batch_size, start, None, id_col)
    step = batch_size * max(1, -(-(stop - start) // (batch_size * n_routes)))
    edges = list(range(start, stop, step))
    at = F.col("_at")
    near = F.pmod(at - start, F.lit(step)).isin(0, step - 1) | (at == stop - 1) | (at == stop)
    found = {r["_at"]: r["_key"] for r in indexed.filter((at >= start - 1) & (at <= stop) & near).collect()}  # two keys per route
    parted = [e for e in (*edges, stop) if 0 < e < n]
    if any(found[e] == found[e - 1] for e in parted):
        b = slice_batches(positions(df, seed, id_col), batch_size, start, max_samples, id_col)
        return b.repartition(n_routes, "batch_idx").sortWithinPartitions("batch_idx", "pos")

    kinds = [keyed.schema[k].dataType for k in keys]

    def literal(key) -> Column:
        return F.struct(*[F.lit(v).cast(t).alias(k) for v, t, k in zip(key, kinds, keys)])

    key = F.struct(*keys)
    inside = F.lit(True)
    if start > 0:
        inside = inside & (key >= literal(found[start]))
    if stop < n:
        inside = inside & (key < literal(found[stop]))
    borders = [literal(found[e]) for e in edges[1:]]
    route = F.lit(0)
    if borders:
        listed = F.array(*borders)
        bits = F.array(*[F.lit(1 << k) for k in reversed(range(len(borders).bit_length()))])
        # the number of borders up to the key, from the highest bit down
        route = F.aggregate(bits, F.lit(0), lambda c, bit: F.when((c + bit <= len(borders)) & (F.get(listed, c + bit - 1) <= key), c + bit).otherwise(c))
    placed = (
        keyed.filter(inside)
        .withColumn("_route", route)
        .repartitionById(len(edges), F.col("_route"))
        .sortWithinPartitions(*keys)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    place = F.col("_mid").bitwiseAND(F.lit((1 << POS_BITS) - 1))
    pos = (F.lit(start) + F.col("_route") * F.lit(step).cast("bigint") + place).cast("bigint")
    return slice_batches(placed.withColumn("pos", pos).drop("_h", "_route", "_mid"), batch_size, start, None, id_col)


def output_prefix(input_prefix: str) -> str:
    """BAT-20: ``input`` -> ``output`` in the prefix, else ``<prefix>_output``."""
    out = input_prefix.replace("input", "output")
    return out if out != input_prefix else input_prefix + "_output"


def output_prefix_col(prefix: Column) -> Column:
    replaced = F.replace(prefix, F.lit("input"), F.lit("output"))
    return F.when(replaced == prefix, F.concat(prefix, F.lit("_output"))).otherwise(replaced)


def safe_model_name(model: Column) -> Column:
    """BAT-20: a model id usable as a folder name (``/`` and ``\\`` -> ``_``)."""
    return F.translate(model, "/\\", "__")


def batch_manifest(
    batched: DataFrame,
    bucket: str,
    input_prefix: str,
    job_prefix: str,
    timestamp: str,
    out_prefix: str | None = None,
    batch_start: int = 0,
    batch_end: int | None = None,
) -> DataFrame:
    """BAT-19: one row per batch in ``[batch_start, batch_end)`` with its record count,
    input/output URIs and job name (a partial aggregate over the batched rows)."""
    out_prefix = out_prefix or output_prefix(input_prefix)
    counts = batched.groupBy("batch_idx").agg(F.count(F.lit(1)).cast("bigint").alias("n_records"))
    cond = F.col("batch_idx") >= batch_start
    if batch_end is not None:
        cond = cond & (F.col("batch_idx") < batch_end)
    b = F.col("batch_idx").cast("string")
    return counts.filter(cond).select(
        "batch_idx",
        "n_records",
        F.concat(F.lit(f"s3://{bucket}/{input_prefix}/batch_"), b, F.lit(".jsonl")).alias("input_uri"),
        F.concat(F.lit(f"s3://{bucket}/{out_prefix}/batch_"), b, F.lit("/")).alias("output_uri"),
        F.concat(F.lit(f"{job_prefix}-batch-"), b, F.lit(f"-{timestamp}")).alias("job_name"),
    )


def seeded_head(df: DataFrame, n: int, seed: int = 42, id_col: str = "sample_id") -> DataFrame:
    """BAT-5: the first ``n`` rows of a seeded shuffle (all rows when fewer exist) with
    their position; exactly ``n`` rows, repeated and NULL ids included.  The index runs on
    the narrow (hash, id) pairs and yields the pair at the cut; only the rows up to that
    pair are then numbered, so wide rows beyond the head are never shuffled."""
    keyed = df.withColumn("_h", seeded_hash(seed, id_col))
    cut = pair_at(keyed, n - 1, id_col)
    if cut is not None:
        keyed = keyed.filter(at_most(cut, id_col))
    return dense_index(keyed, ["_h", id_col], out="pos").filter(F.col("pos") < n).drop("_h")
