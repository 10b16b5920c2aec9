"""Intermediate tables and fixed-size bit filters of this package.

``written`` cuts lineage with a Parquet table below the session's shared checkpoint
folder, so a lost executor costs no more than the tasks it ran.  ``BitFilter`` is a
bitmap of at most a fixed size, whatever it is built from: it only spares rows a shuffle, a
join afterwards decides.
"""

from __future__ import annotations

import sys as _sys
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

BITS = 26  # at most: 8 MiB
TEXT_ROWS = 1000

_listing: list[list[DataFrame]] = []


def written(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("error").option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.written_to = path
    for made in _listing:
        made.append(back)
    return back


def bucketed(df: DataFrame, name: str, buckets: int, by: str, partition_by: str) -> DataFrame:
    """``written``, in buckets of a column: a join or grouping by it needs no exchange of this
    side.  Buckets are only known to tables with a name; ``drop_listed`` takes that back."""
    spark = df.sparkSession
    table = f"{name}-{uuid.uuid4().hex}"
    path, listed = f"{checkpoint_dir(spark).rstrip('/')}/{table}", table.replace("-", "_")
    writer = df.write.mode("error").option("compression", "zstd").option("path", path)
    writer.partitionBy(partition_by).bucketBy(buckets, by).saveAsTable(listed)
    back = spark.table(listed)
    back.written_to, back.listed = path, listed
    for made in _listing:
        made.append(back)
    return back


def drop_listed(*tables: DataFrame) -> None:
    """Forget the names of bucketed tables; their files stay until ``discard``."""
    for table in tables:
        table.sparkSession.sql(f"DROP TABLE IF EXISTS {table.listed}")


@contextmanager
def made_tables() -> Iterator[list[DataFrame]]:
    """Lists the tables written inside, so that those of no further use can be discarded."""
    made: list[DataFrame] = []
    _listing.append(made)
    try:
        yield made
    finally:
        _listing[:] = [x for x in _listing if x is not made]


def discard(*tables: DataFrame) -> None:
    """Delete written tables that no later step reads: everything built on them must have
    been written itself."""
    for table in tables:
        spark = table.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.written_to)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def setting(spark, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shuffles_cleaned(spark):
    """Inside, the shuffle files of a write or an action go when it ends, not when the driver's
    garbage collector finds them: for steps that write a table each and read only such tables."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def small_batches(spark):
    """Inside, whole texts reach Python by fewer rows at a time; a setting of the user's own stays."""
    name, default = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
    now = spark.conf.get(name, default)
    return setting(spark, name, str(TEXT_ROWS) if now == default else now)


def bit_position(col: Column) -> Column:
    """The bit of a long: the upper bits of the long times a fixed odd number."""
    return F.shiftrightunsigned(F.xxhash64(col), 64 - BITS)


class BitFilter:
    """Bitmap over a long column; holds every value it was built from.  It has at most
    2^BITS bits, and fewer (sixteen for each set one) where it is built from few values: the
    bits of a longer one, folded."""

    def __init__(self, df: DataFrame, col: str):
        bits = df.select((bit_position(F.col(col)) + 1).alias("b"))  # Spark counts these from 1
        parts = bits.groupBy(F.expr("bitmap_bucket_number(b)").alias("n")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(b))").alias("m"))
        data = np.zeros(1 << (BITS - 3), np.uint8)
        for row in parts.collect():  # at most 2^BITS / 2^15 rows of 4 KiB
            at = (row["n"] - 1) * 4096
            data[at : at + 4096] |= np.frombuffer(row["m"], np.uint8)
        self.shared = df.sparkSession.sparkContext.broadcast(folded(data))

    def may_hold(self, keys: Column) -> Column:
        """Whether the filter may hold a long.  Only the longs reach Python, so the rest of a
        row (its text) stays in Spark."""
        shared = self.shared

        @F.arrow_udf("boolean")
        def held(keys: pa.Array) -> pa.Array:
            return pa.array(holds(shared.value, keys.to_numpy(zero_copy_only=False)))

        return held(keys)

    def done(self) -> None:
        """Frees the executors' copies; a later use would send them again."""
        self.shared.unpersist()


def folded(data: np.ndarray) -> np.ndarray:
    """The shortest bitmap (64 bytes at least) with sixteen bits for each set one: each of its
    bits is set if one of the neighbours it stands for is."""
    used = np.flatnonzero(data)
    values = np.unpackbits(data[used], bitorder="little").reshape(-1, 8) if len(used) < 1 << 20 else None
    if values is None:
        return data
    which, bit = np.nonzero(values)
    bits = max(9, (16 * len(which)).bit_length())
    if bits >= BITS:
        return data
    at = (used[which].astype(np.int64) * 8 + bit) >> (BITS - bits)
    out = np.zeros(1 << (bits - 3), np.uint8)
    np.bitwise_or.at(out, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
    return out


def holds(data: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which longs may be in the filter."""
    bits = (len(data) * 8).bit_length() - 1
    h = xxhash64_longs(values) >> np.uint64(64 - bits)
    return (data[(h >> np.uint64(3)).astype(np.int64)] >> (h & np.uint64(7)).astype(np.uint8)) & 1 == 1


def xxhash64_longs(values: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of a long column (seed 42)."""
    # The constants of xxHash64.
    p1, p2, p3, p4, p5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turn = lambda x, k: (x << np.uint64(k)) | (x >> np.uint64(64 - k))
    with np.errstate(over="ignore"):
        h = np.uint64(42) + p5 + np.uint64(8)
        h = h ^ (turn(values.astype(np.int64).view(np.uint64) * p2, 31) * p1)
        h = turn(h, 27) * p1 + p4
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        return h ^ (h >> np.uint64(32))
