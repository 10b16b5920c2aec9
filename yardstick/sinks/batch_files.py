"""Files named by a column, published when the job commits (SNK-2), as a Spark Python Data
Source writer.

Input rows are (name, value) with the rows of one name together in one partition, in the
order they are to be written.  A task streams each run of rows into a file of its own
attempt folder and moves the finished files into the job's staging folder at its end, so a
killed or speculative attempt never leaves a partial file there.  The job's commit is one
rename of the staging folder to the target, whatever the number of files; until then
the target is untouched, and an abort removes the staging folder as a whole.  On object
stores, which have no rename but whose files appear only when complete, tasks write to the
target directly and the commit adds ``_SUCCESS``.

    register(spark)
    rows.write.format("batch_files").mode("overwrite").save("/data/batches")

Paths are those pyarrow's file systems reach (see ``sources.heads``).
"""

from __future__ import annotations

import sys as _sys
import uuid
from dataclasses import dataclass

from pyspark import cloudpickle as _cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..sources.heads import filesystem as _heads_filesystem

NAME = "batch_files"

# Code from this module runs inside Python workers; pickle it by value so the
# workers need not have this package on their path (no --py-files needed).
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])


def _filesystem(path: str):
    return _heads_filesystem(path)


@dataclass
class Written(WriterCommitMessage):
    files: int
    rows: int


def _runs(names):
    """(name, first row, end row) of the runs of equal names in an Arrow column."""
    import pyarrow.compute as pc

    ends = pc.run_end_encode(names)
    start = 0
    for name, end in zip(ends.values.to_pylist(), ends.run_ends.to_pylist()):
        yield name, start, end
        start = end


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        from pyarrow import fs

        self.path, self.overwrite = path.rstrip("/"), overwrite
        filesystem, inner = _filesystem(self.path)
        self.direct = filesystem.type_name not in ("local", "hdfs")
        if not overwrite and filesystem.get_file_info(inner).type != fs.FileType.NotFound:
            raise FileExistsError(f"{self.path} exists; write with mode('overwrite')")
        self.staging = f"{self.path}.staging-{uuid.uuid4().hex}"
        if self.direct and overwrite:
            filesystem.delete_dir_contents(inner, missing_dir_ok=True)

    def write(self, iterator):
        from pyspark import TaskContext

        task = TaskContext.get()
        filesystem, target = _filesystem(self.path if self.direct else f"{self.staging}/files")
        own = target if self.direct else f"{_filesystem(self.staging)[1]}/attempts/{task.partitionId()}-{task.taskAttemptId()}"
        done, rows, out, current = set(), 0, None, None
        filesystem.create_dir(own, recursive=True)
        try:
            for batch in iterator:
                values = batch.column(1)
                for name, a, b in _runs(batch.column(0)):
                    if name != current:
                        if out is not None:
                            out.close()
                        if name in done:
                            raise ValueError(f"the rows of {name} are not together")
                        current = name
                        done.add(name)
                        out = filesystem.open_output_stream(f"{own}/{name}")
                    for value in values.slice(a, b - a):
                        out.write(value.as_py().encode("utf-8"))
                        out.write(b"\n")
                    rows += b - a
        finally:
            if out is not None:
                out.close()
        if not self.direct:
            filesystem.create_dir(target, recursive=True)
            for name in done:
                _replace(filesystem, f"{own}/{name}", f"{target}/{name}")
        return Written(len(done), rows)

    def commit(self, messages):
        filesystem, target = _filesystem(self.path)
        if self.direct:
            filesystem.create_dir(target, recursive=True)
        else:
            staging = _filesystem(self.staging)[1]
            filesystem.create_dir(f"{staging}/files", recursive=True)  # a write without rows
            _remove(filesystem, target)
            filesystem.move(f"{staging}/files", target)
            _remove(filesystem, staging)
        with filesystem.open_output_stream(f"{target}/_SUCCESS") as out:
            out.write(b"")

    def abort(self, messages):
        if not self.direct:
            filesystem, staging = _filesystem(self.staging)
            _remove(filesystem, staging)


def _replace(filesystem, source: str, target: str) -> None:
    """Move a file over another one (the same batch from another attempt)."""
    if filesystem.type_name == "hdfs":
        from pyarrow import fs

        if filesystem.get_file_info(target).type != fs.FileType.NotFound:
            filesystem.delete_file(target)
    filesystem.move(source, target)


def _remove(filesystem, folder: str) -> None:
    from pyarrow import fs

    if filesystem.get_file_info(folder).type != fs.FileType.NotFound:
        filesystem.delete_dir(folder)


class BatchFileSink(DataSource):
    @classmethod
    def name(cls):
        return NAME

    def schema(self):
        return "name string, value string"

    def writer(self, schema, overwrite):
        if [f.name for f in schema.fields] != ["name", "value"]:
            raise ValueError("batch_files takes the columns name and value")
        return _Writer(self.options["path"], overwrite)


def register(spark) -> None:
    spark.dataSource.register(BatchFileSink)
