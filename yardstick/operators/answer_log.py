"""A durable log of model answers (UDF-4, JON-9).

Scoring is the one step whose rows cost more than reading them again.  Every answer is
appended to a line file below the log folder as soon as the model gives it, by the task
that holds the row; a file belongs to one attempt of one task.  A retried attempt first
reads what earlier attempts of its task wrote, and a later job reads the whole log, so an
answered record is not sent to the model again, whether a task, an executor or the job
was lost.  Failures are not logged: they are tried again.

A line counts only if it is complete; the last one of a lost attempt may not be.  Where a
file appears only once it is closed (object stores), files are closed every
``ROTATE_ROWS`` answers, which bounds what a lost task can lose.
"""

from __future__ import annotations

import json
import sys as _sys
import threading

from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.heads import filesystem

# Code from this module runs inside Python workers; pickle it by value so the
# workers need not have this package on their path (no --py-files needed).
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

SCHEMA = "key string, response string, attempts int, done boolean"
ROTATE_ROWS = 64


def record_key(cols) -> Column:
    """What the log knows a record by: a digest of the named columns (NULLs included)."""
    return F.md5(F.to_json(F.struct(*cols)))


def logged(spark: SparkSession, path: str) -> DataFrame | None:
    """(key, response, attempts), one row per answered record of earlier jobs; None without a log."""
    from pyarrow import fs

    filesystem_, inner = filesystem(path)
    if filesystem_.get_file_info(inner).type == fs.FileType.NotFound:
        return None
    lines = spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jsonl").json(path)
    first = F.min(F.struct("response", "attempts")).alias("a")
    return lines.filter("done and key is not null").groupBy("key").agg(first).select("key", "a.response", "a.attempts")


class TaskLog:
    """The log of one attempt of one task."""

    def __init__(self, path: str, run: str, partition: int, attempt: int):
        self.filesystem, inner = filesystem(path)
        self.folder = f"{inner.rstrip('/')}/run-{run}/task-{partition:06d}"
        self.attempt, self.files, self.rows, self.out = attempt, 0, 0, None
        self.lock = threading.Lock()
        self.rotate = self.filesystem.type_name not in ("local", "hdfs")
        self.filesystem.create_dir(self.folder, recursive=True)

    def answers(self) -> dict[str, tuple[str, int]]:
        """What earlier attempts of this task were answered."""
        from pyarrow import fs

        known = {}
        for info in self.filesystem.get_file_info(fs.FileSelector(self.folder)):
            with self.filesystem.open_input_stream(info.path) as f:
                for line in f.read().split(b"\n"):
                    try:
                        row = json.loads(line)
                    except ValueError:  # a line that a lost attempt did not finish
                        continue
                    known.setdefault(row["key"], (row["response"], row["attempts"]))
        return known

    def add(self, key: str, response: str, attempts: int) -> None:
        line = json.dumps({"key": key, "response": response, "attempts": attempts, "done": True})
        with self.lock:  # requests in flight end in their own threads
            if self.out is None:
                self.out = self.filesystem.open_output_stream(f"{self.folder}/{self.attempt}-{self.files}.jsonl")
                self.files += 1
            self.out.write(line.encode("utf-8") + b"\n")
            self.out.flush()
            self.rows += 1
            if self.rotate and self.rows % ROTATE_ROWS == 0:
                self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None
