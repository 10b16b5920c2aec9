"""The distributed dense index equals a global row_number, also under skew."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from yardstick.operators.indexing import dense_index


def test_global_index_matches_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"), F.col("id"))
    got = dense_index(df, ["k", "id"], out="i", num_partitions=7)
    want = df.withColumn("j", F.row_number().over(Window.orderBy("k", "id")) - 1)
    assert got.join(want, ["k", "id"]).filter("i != j").count() == 0
    assert got.count() == 5000


def test_grouped_index_with_hot_group(spark):
    # one group holds most rows; the index restarts per group and stays dense
    df = spark.range(0, 6000).select(F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 5).cast("string"))).alias("g"), F.col("id"))
    got = dense_index(df, ["id"], ["g"], out="i", num_partitions=9)
    stats = got.groupBy("g").agg(F.min("i").alias("lo"), F.max("i").alias("hi"), F.count(F.lit(1)).alias("n"), F.countDistinct("i").alias("d")).collect()
    for r in stats:
        assert r.lo == 0 and r.hi == r.n - 1 and r.d == r.n


def test_hot_key_split_index_matches_per_group_row_number(spark):
    from yardstick.operators.indexing import grouped_index

    # one hot group, a NULL group and many small groups
    g = (F.when(F.col("id") % 10 < 6, F.lit("hot")).when(F.col("id") % 10 == 6, F.lit(None))
         .otherwise(F.concat(F.lit("g"), (F.col("id") % 97).cast("string"))))
    df = spark.range(0, 8000).select(g.alias("g"), ((F.col("id") * 7919) % 8000).alias("k"))
    want = {(r.g, r.k): r.j for r in df.withColumn("j", F.row_number().over(Window.partitionBy("g").orderBy("k")) - 1).collect()}
    for hot_rows in (100, 10**9):  # the hot and NULL groups split off, or all by window
        got = {(r.g, r.k): r.i for r in grouped_index(df, ["k"], ["g"], out="i", hot_rows=hot_rows, num_partitions=5).collect()}
        assert got == want


def test_split_index_without_groups_is_the_global_index(spark):
    from yardstick.operators.indexing import grouped_index

    df = spark.range(0, 3000).select(((F.col("id") * 7919) % 3000).alias("k"))
    got = sorted((r.k, r.i) for r in grouped_index(df, ["k"], [], out="i", num_partitions=4).collect())
    assert got == [(k, k) for k in range(3000)]
