"""Reader for datasets stored as Arrow IPC shards with a ``state.json`` listing them
(the layout of a dataset saved to disk by the common dataset library), as a Spark
Python Data Source (SRC-6, SRC-7).

One input partition per shard; each task opens its shard and yields Arrow record
batches, so nothing passes through the driver but the shard list and one schema.
Shards listed in ``state.json`` but missing on disk are skipped (their number is
reported by ``shard_listing``); reading fails when none is left.  Paths are URIs of
any file system pyarrow reaches (``s3://``, ``hdfs://``, ``gs://``) or local paths.

    from yardstick.sources.arrow_shards import register
    register(spark)
    df = spark.read.format("arrow_shards").load("/data/pairs-r")

Option ``columns`` (comma-separated) reads only these columns: the buffers of the others
(images) are not decoded.  ``positioned`` adds the row's position in the dataset, shards
in listed order, which is the sample id the evaluators use.
"""

from __future__ import annotations

import json
import os
import sys as _sys
from dataclasses import dataclass

from pyspark import cloudpickle as _cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# A function object, not a module import inside worker code: ``heads`` is pickled by
# value, so this travels with the task and workers need no package path.
from .heads import filesystem as _heads_filesystem

NAME = "arrow_shards"

# Code from this module runs inside Python workers; pickle it by value so the
# workers need not have this package on their path (no --py-files needed).
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])


def _filesystem(path: str):
    """(pyarrow file system, path inside it) for a URI (``s3://``, ``gs://``, ``file:``) or
    a plain local path; local files are memory-mapped."""
    return _heads_filesystem(path, mmap=True)


def shard_listing(path: str) -> tuple[list[str], int]:
    """(existing shard files, number of listed shards that are missing).  A metadata
    pass on the driver: ``state.json`` (or a folder listing) and one existence check
    per listed shard; no shard is read."""
    from pyarrow import fs

    filesystem, inner = _filesystem(path)
    base, inner = path.rstrip("/"), inner.rstrip("/")
    state = f"{inner}/state.json"
    if filesystem.get_file_info(state).type != fs.FileType.NotFound:
        with filesystem.open_input_stream(state) as f:
            names = [d["filename"] for d in json.loads(f.read().decode("utf-8")).get("_data_files", [])]
    else:
        found = filesystem.get_file_info(fs.FileSelector(inner))
        names = sorted(i.base_name for i in found if i.base_name.endswith(".arrow"))
    infos = filesystem.get_file_info([f"{inner}/{n}" for n in names])
    kept = [f"{base}/{n}" for n, i in zip(names, infos) if i.type != fs.FileType.NotFound]
    if not kept:
        raise FileNotFoundError(f"no shard of {path} exists ({len(names)} listed)")
    return kept, len(names) - len(kept)


def _open(path: str, columns: list[str] | None = None):
    """IPC reader of a shard, decoding only ``columns`` when given."""
    import pyarrow as pa

    filesystem, inner = _filesystem(path)

    def opened(options):
        source = filesystem.open_input_file(inner)
        try:
            return pa.ipc.open_stream(source, options=options)
        except pa.ArrowInvalid:
            return pa.ipc.open_file(filesystem.open_input_file(inner), options=options)

    reader = opened(None)
    if columns is None:
        return reader
    return opened(pa.ipc.IpcReadOptions(included_fields=[reader.schema.get_field_index(c) for c in columns]))


def _batches(path: str, columns: list[str] | None = None):
    reader = _open(path, columns)
    if hasattr(reader, "num_record_batches"):
        for i in range(reader.num_record_batches):
            yield reader.get_batch(i)
    else:
        yield from reader


@dataclass
class _Shard(InputPartition):
    path: str
    first: int  # position of its first row


class _Reader(DataSourceReader):
    def __init__(self, shards: list[str], firsts: list[int], columns: list[str] | None, position: str | None):
        self.shards, self.firsts, self.columns, self.position = shards, firsts, columns, position

    def partitions(self):
        return [_Shard(p, n) for p, n in zip(self.shards, self.firsts)]

    def read(self, partition):
        import pyarrow as pa

        at = partition.first
        for batch in _batches(partition.path, self.columns):
            if self.columns is not None:
                batch = batch.select(self.columns)
            if self.position:
                rows = pa.array(range(at, at + batch.num_rows), pa.int64())
                batch = pa.RecordBatch.from_arrays([*batch.columns, rows], names=[*batch.schema.names, self.position])
                at += batch.num_rows
            yield batch


class ArrowShardSource(DataSource):
    @classmethod
    def name(cls):
        return NAME

    def _shards(self) -> list[str]:
        if "firsts" in self.options:  # the listing the positions were counted on
            return [p for p, _ in json.loads(self.options["firsts"])]
        return shard_listing(self.options["path"])[0]

    def _columns(self) -> list[str] | None:
        listed = self.options.get("columns")
        return None if listed is None else [c.strip() for c in listed.split(",") if c.strip()]

    def schema(self):
        from pyspark.sql.pandas.types import from_arrow_schema
        from pyspark.sql.types import LongType, StructField, StructType

        whole = from_arrow_schema(_open(self._shards()[0]).schema)
        fields = whole.fields if self._columns() is None else [whole[c] for c in self._columns()]
        position = self.options.get("position")
        return StructType([*fields, StructField(position, LongType())] if position else list(fields))

    def reader(self, schema):
        shards = self._shards()
        firsts = [n for _, n in json.loads(self.options["firsts"])] if "firsts" in self.options else [0] * len(shards)
        return _Reader(shards, firsts, self._columns(), self.options.get("position"))


def register(spark) -> None:
    spark.dataSource.register(ArrowShardSource)


def positioned(spark, path: str, columns: list[str] | None = None, out: str = "sample_id"):
    """The dataset with ``out`` = position of the row, shards in listed order (a missing
    shard has no positions).  Row counts come from one task per shard that decodes a
    single column; the driver keeps one number per shard."""
    shards = shard_listing(path)[0]

    def count(batches):
        import pyarrow as pa

        for listed in batches:
            for k, shard in zip(listed.column(0).to_pylist(), listed.column(1).to_pylist()):
                narrow = sorted(_open(shard).schema, key=lambda f: (pa.types.is_nested(f.type), pa.types.is_large_binary(f.type) or pa.types.is_binary(f.type)))
                yield pa.RecordBatch.from_pydict({"k": [k], "n": [sum(b.num_rows for b in _batches(shard, [narrow[0].name]))]})

    listed = spark.createDataFrame(list(enumerate(shards)), "k bigint, path string").repartition(len(shards), "k")
    counts = {r["k"]: r["n"] for r in listed.mapInArrow(count, "k bigint, n bigint").collect()}  # one row per shard
    firsts, at = [], 0
    for k, shard in enumerate(shards):
        firsts.append((shard, at))
        at += counts[k]
    reader = spark.read.format(NAME).option("position", out).option("firsts", json.dumps(firsts))
    return (reader if columns is None else reader.option("columns", ",".join(columns))).load(path)


def write_state(path: str, filenames: list[str]) -> None:
    """``state.json`` naming the shards in order (the part of the format the reader uses)."""
    filesystem, inner = _filesystem(path)
    filesystem.create_dir(inner.rstrip("/"), recursive=True)
    with filesystem.open_output_stream(f"{inner.rstrip('/')}/state.json") as f:
        f.write(json.dumps({"_data_files": [{"filename": n} for n in filenames]}, indent=2).encode("utf-8"))


def write_arrow_shards(df, path: str, state: bool = True) -> list[str]:
    """Write ``df`` in the Arrow-shard layout: each task streams its partition's Arrow
    batches into one shard ``data-<k>-of-<n>.arrow`` (written under a per-attempt name,
    then moved into place, so a retried or speculative task never leaves a partial
    shard), and the driver writes ``state.json`` from the one row per shard the tasks
    return.  Returns the shard names in partition order."""
    from pyspark.sql.pandas.types import to_arrow_schema

    n = df.rdd.getNumPartitions()
    arrow_schema = to_arrow_schema(df.schema)
    base = path.rstrip("/")

    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        ctx = TaskContext.get()
        name = f"data-{ctx.partitionId():05d}-of-{n:05d}.arrow"
        filesystem, inner = _filesystem(f"{base}/{name}")
        tmp = f"{inner}.attempt-{ctx.attemptNumber()}-{ctx.taskAttemptId()}"
        filesystem.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        rows = 0
        with filesystem.open_output_stream(tmp) as out, pa.ipc.new_stream(out, arrow_schema) as w:
            for b in batches:
                w.write_batch(b)
                rows += b.num_rows
        filesystem.move(tmp, inner)
        yield pa.RecordBatch.from_pydict({"filename": [name], "num_rows": [rows]})

    written = df.mapInArrow(write, "filename string, num_rows bigint").collect()  # one row per shard
    names = sorted(r.filename for r in written)
    if state:
        write_state(path, names)
    return names
