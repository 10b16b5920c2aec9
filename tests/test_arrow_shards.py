"""The Arrow-shard data source reads every shard in parallel and skips missing ones."""

import json

import pyarrow as pa

from yardstick.sources.arrow_shards import register, shard_listing


def _shard(path, ids):
    img = pa.array([{"bytes": str(i).encode(), "path": None} for i in ids],
                   type=pa.struct([("bytes", pa.binary()), ("path", pa.string())]))
    t = pa.table({"xsource_image": img, "label": pa.array(["accept" if i % 2 else "reject" for i in ids]),
                  "rejection_reason": pa.array(["" if i % 2 else "Wrong Orientation" for i in ids])})
    with pa.OSFile(str(path), "wb") as f, pa.ipc.new_stream(f, t.schema) as w:
        for b in t.to_batches(max_chunksize=3):
            w.write_batch(b)


def test_shards_of_the_evaluation_grow_in_number(spark, sf_small, monkeypatch):
    from yardstick.plans import files
    from yardstick.sources import arrow_shards

    names, write = [], arrow_shards.write_arrow_shards

    def listed(df, path, state=True):
        names.append(write(df, path, state))
        return names[-1]

    monkeypatch.setattr(arrow_shards, "write_arrow_shards", listed)
    whole = files.q_eval_from_shards(spark, sf_small).collect()
    monkeypatch.setattr(files, "SHARD_BYTES", 5000)
    cut = files.q_eval_from_shards(spark, sf_small).collect()
    size = spark.read.parquet(f"{sf_small}/documents.parquet").selectExpr("sum(octet_length(text))").first()[0]
    assert whole == cut and len(names[0]) == 4 and len(names[1]) == -(-size // 5000) > 4


def test_read_shards(spark, tmp_path):
    d = tmp_path / "ds"
    d.mkdir()
    _shard(d / "data-00000-of-00003.arrow", range(0, 7))
    _shard(d / "data-00001-of-00003.arrow", range(7, 10))
    (d / "state.json").write_text(json.dumps({"_data_files": [
        {"filename": "data-00000-of-00003.arrow"}, {"filename": "data-00001-of-00003.arrow"},
        {"filename": "data-00002-of-00003.arrow"}]}))
    register(spark)
    df = spark.read.format("arrow_shards").load(str(d))
    assert df.rdd.getNumPartitions() == 2
    rows = df.collect()
    assert len(rows) == 10
    assert sorted(int(bytes(r.xsource_image.bytes)) for r in rows) == list(range(10))
    assert shard_listing(str(d))[1] == 1


def test_read_shards_by_uri(spark, tmp_path):
    d = tmp_path / "uri"
    d.mkdir()
    _shard(d / "data-00000-of-00001.arrow", range(0, 4))
    register(spark)
    df = spark.read.format("arrow_shards").load(f"file://{d}")
    assert sorted(r.label for r in df.collect()) == ["accept", "accept", "reject", "reject"]
    assert shard_listing(f"file://{d}") == ([f"file://{d}/data-00000-of-00001.arrow"], 0)


def test_write_then_read_shards(spark, tmp_path):
    from yardstick.sources.arrow_shards import write_arrow_shards

    d = str(tmp_path / "written")
    src = spark.range(0, 50, numPartitions=4).selectExpr("id AS sample_id", "CAST(id % 3 AS STRING) AS label")
    names = write_arrow_shards(src, d)
    assert names == [f"data-{i:05d}-of-00004.arrow" for i in range(4)]
    register(spark)
    back = spark.read.format("arrow_shards").load(d)
    assert back.rdd.getNumPartitions() == 4
    assert sorted(r.sample_id for r in back.collect()) == list(range(50))
    assert shard_listing(d)[1] == 0


def test_positions_and_columns(spark, tmp_path):
    from yardstick.sources.arrow_shards import positioned

    d = tmp_path / "positions"
    d.mkdir()
    _shard(d / "b.arrow", range(0, 7))
    _shard(d / "a.arrow", range(7, 10))
    names = ["b.arrow", "missing.arrow", "a.arrow"]  # the listed order counts, not the names'
    (d / "state.json").write_text(json.dumps({"_data_files": [{"filename": n} for n in names]}))
    register(spark)
    rows = positioned(spark, str(d)).collect()
    assert sorted((r.sample_id, int(bytes(r.xsource_image.bytes))) for r in rows) == [(i, i) for i in range(10)]
    narrow = positioned(spark, str(d), ["rejection_reason", "label"])
    assert narrow.columns == ["rejection_reason", "label", "sample_id"]
    assert sorted((r.sample_id, r.label) for r in narrow.collect()) == [(i, "accept" if i % 2 else "reject") for i in range(10)]


def test_unread_columns_are_not_decoded(spark, tmp_path):
    """A label query works on a shard whose image buffers are damaged."""
    from yardstick.sources.arrow_shards import _batches

    path = tmp_path / "damaged.arrow"
    t = pa.table({"image": pa.array([b"x" * 4096] * 4, pa.binary()), "label": ["a", "b", "c", "d"]})
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.OSFile(str(path), "wb") as f, pa.ipc.new_stream(f, t.schema, options=options) as w:
        w.write_table(t)
    data = path.read_bytes()
    at = data.index(b"\x28\xb5\x2f\xfd", data.index(b"\x28\xb5\x2f\xfd") + 1)  # the second compressed buffer: the images
    path.write_bytes(data[:at] + b"\x00" * 4 + data[at + 4 :])
    assert [x for b in _batches(str(path), ["label"]) for x in b.column(0).to_pylist()] == ["a", "b", "c", "d"]
