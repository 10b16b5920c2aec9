"""Batches routed by narrow keys, and files published at commit."""

import os

import pytest
from pyspark.sql import functions as F

from yardstick.operators import batching
from yardstick.plans import jobs
from yardstick.sinks import batch_files, writers


def _rows(df):
    return sorted((r.pos, str(r.sample_id), r.record_id, r.batch_idx) for r in df.select("pos", "sample_id", "record_id", "batch_idx").collect())


@pytest.mark.parametrize("seed", [None, 7])
@pytest.mark.parametrize("start,size,most", [(0, 10, None), (3, 10, 40), (0, 500, None), (95, 7, 100), (200, 10, None), (0, 1, 5), (10, 10, 0)])
def test_routed_batches_equal_the_index_on_whole_rows(spark, seed, start, size, most):
    df = spark.range(0, 100).selectExpr("id * 3 as sample_id", "repeat('x', 50) as image", "'e' as _end")
    for routes in (1, 3, 50):
        got = batching.routed_batches(df, size, start, most, seed, routes=routes)
        want = batching.slice_batches(batching.positions(df, seed), size, start, most)
        assert _rows(got) == _rows(want)
        assert got.columns == want.columns
        homes = got.select("batch_idx", F.spark_partition_id().alias("p")).distinct().collect()
        assert len(homes) == len({r.batch_idx for r in homes})


def test_missing_and_repeated_ids(spark):
    one_null = spark.range(0, 30).selectExpr("nullif(id, 7) as sample_id")
    text_ids = spark.range(0, 30).selectExpr("concat('é', id) as sample_id")
    for df in (one_null, text_ids):
        for seed in (None, 1):
            assert _rows(batching.routed_batches(df, 4, 2, 21, seed, routes=5)) == _rows(batching.slice_batches(batching.positions(df, seed), 4, 2, 21))
    tied = spark.range(0, 300).selectExpr("if(id < 200, 5, id) as sample_id", "id as row")
    got = batching.routed_batches(tied, 10, routes=8, seed=2).select("row", "pos", "batch_idx").collect()
    assert sorted(r.pos for r in got) == list(range(300)) and len({r.row for r in got}) == 300
    empty = spark.createDataFrame([], "sample_id bigint, image string")
    assert batching.routed_batches(empty, 10, seed=1).collect() == []


def test_images_pass_one_exchange_and_no_checkpoint(spark, tmp_path, monkeypatch):
    df = spark.range(0, 200).select(F.col("id").alias("sample_id"), F.encode(F.repeat(F.lit("p"), 20), "UTF-8").alias("a"))
    narrow = []
    from yardstick.operators import indexing

    kept = indexing.checkpoint
    monkeypatch.setattr(indexing, "checkpoint", lambda d: narrow.append(d.columns) or kept(d))
    b = jobs.prepare_batches(df, [("source", "a")], "Same?", "claude", batch_size=10, seed=3)
    assert narrow and not any("a" in c for c in narrow)
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Window" not in plan and "RDDScan" not in plan and "Scan ExistingRDD" not in plan


def _lines(spark, path):
    return {n: open(os.path.join(path, n)).read().splitlines() for n in sorted(os.listdir(path)) if n.endswith(".jsonl")}


def test_files_are_named_at_commit(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(0, 95).selectExpr("id as sample_id", "id div 10 as batch_idx", "id as pos", "concat('é', id) as jsonl")
    for _ in range(2):  # the second write replaces the first
        writers.write_batches(df.repartition(4), path, batch_file_names=True)
        got = _lines(spark, path)
        assert got == {f"batch_{k}.jsonl": [f"é{i}" for i in range(10 * k, min(95, 10 * k + 10))] for k in range(10)}
        assert sorted(set(os.listdir(path)) - set(got)) == ["_SUCCESS"]
    assert os.listdir(tmp_path) == ["out"]
    writers.write_batches(df.limit(0), path, batch_file_names=True)
    assert os.listdir(path) == ["_SUCCESS"]


def test_a_failed_job_leaves_the_old_files_and_nothing_else(spark, tmp_path):
    path = str(tmp_path / "out")
    good = spark.range(0, 20).selectExpr("concat('batch_', id div 10, '.jsonl') as name", "'old' as value").coalesce(1)
    batch_files.register(spark)
    good.write.format("batch_files").mode("overwrite").save(path)
    bad = spark.range(0, 20, 1, 2).selectExpr("concat('batch_', id div 10, '.jsonl') as name", "if(id = 15, raise_error('lost'), 'new') as value")
    with pytest.raises(Exception, match="lost"):
        bad.write.format("batch_files").mode("overwrite").save(path)
    assert {v for lines in _lines(spark, path).values() for v in lines} == {"old"}
    assert os.listdir(tmp_path) == ["out"]


def test_a_killed_attempt_is_replaced(spark, tmp_path):
    """Attempts of one partition write the same files; what the killed one wrote is gone."""
    path = str(tmp_path / "out")
    writer = batch_files._Writer(path, True)
    filesystem, staging = batch_files._filesystem(writer.staging)
    filesystem.create_dir(f"{staging}/attempts/0-0", recursive=True)
    with filesystem.open_output_stream(f"{staging}/attempts/0-0/batch_0.jsonl") as out:
        out.write(b"half a li")
    import pyarrow as pa
    from unittest import mock

    rows = pa.RecordBatch.from_pydict({"name": ["batch_0.jsonl"] * 2, "value": ["a", "b"]})
    for attempt in (1, 2):
        with mock.patch("pyspark.TaskContext.get", return_value=mock.Mock(partitionId=lambda: 0, taskAttemptId=lambda a=attempt: a)):
            message = writer.write(iter([rows.slice(0, 1), rows.slice(1)]))
    assert (message.files, message.rows) == (1, 2)
    writer.commit([message])
    assert _lines(spark, path) == {"batch_0.jsonl": ["a", "b"]} and os.listdir(tmp_path) == ["out"]
    with pytest.raises(ValueError, match="not together"), mock.patch("pyspark.TaskContext.get", return_value=mock.Mock(partitionId=lambda: 0, taskAttemptId=lambda: 9)):
        writer.write(iter([pa.RecordBatch.from_pydict({"name": ["x", "y", "x"], "value": ["1", "2", "3"]})]))
    with pytest.raises(FileExistsError):
        batch_files._Writer(path, False)


def test_lists_keep_the_order_of_the_rows(spark):
    from yardstick.operators import chat

    df = spark.createDataFrame([(0, 2, "a", 9), (0, 0, "c", 1), (0, 1, "b", 5), (1, 0, "z", None)], "batch int, pos int, x string, y int").repartition(3)
    lists = {r.batch: (r.x, r.y) for r in chat.columns_to_lists(df, "batch", ["x", "y"], order_cols=["pos"]).collect()}
    assert lists == {0: (["c", "b", "a"], [1, 5, 9]), 1: (["z"], [None])}
