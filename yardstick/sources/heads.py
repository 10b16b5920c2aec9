"""First lines of files, read on the executors (SRC-3).

Deciding whether a file is a parts-json file needs only its first line.  A Spark text
scan would read every byte of every candidate file; here each task opens its share of
the listed files through pyarrow's file systems (local, ``s3://``/``s3a://``,
``gs://``) and reads up to the first line break, so the cost is one small read per
file whatever the file size.  The check is the reference's own: the stripped first
line parses as JSON and holds both ``sample`` and ``prediction``.  A file without line
breaks is never held: see ``has_record``.
"""

from __future__ import annotations

import json
import os
import re
import sys as _sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import DataFrame

# Runs inside Python workers: pickle by value so workers need no package path.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

# Path schemes pyarrow reaches without extra native libraries.
SCHEMES = ("file:", "s3://", "s3a://", "gs://", "gcs://")


def reachable(path: str) -> bool:
    return "://" not in path and not path.startswith("file:") or path.startswith(SCHEMES)


def filesystem(path: str, mmap: bool = False):
    """(pyarrow file system, path inside it).  Only the scheme and bucket go through URI
    parsing, so names with spaces or ``%`` pass through as they are."""
    from pyarrow import fs

    if path.startswith("file:"):
        rest = path[len("file:"):]
        rest = "/" + rest.lstrip("/") if rest.startswith("//") else rest
        return fs.LocalFileSystem(use_mmap=mmap), rest
    if "://" not in path:
        return fs.LocalFileSystem(use_mmap=mmap), os.path.abspath(path)
    scheme, rest = path.split("://", 1)
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    bucket = rest.split("/", 1)[0]
    filesystem, _ = fs.FileSystem.from_uri(f"{scheme}://{bucket}")
    return filesystem, rest


CHUNK = 1 << 16
WHOLE_LINE = 1 << 20  # a first line up to this size is parsed as a whole

_NEXT = re.compile(rb'["{}\[\]:,]')


class KeyScanner:
    """Keys of the top-level object of a JSON text that comes in pieces; holds one key or a
    few bytes at a time, never a value.  ``ok`` turns False at a text that starts with no
    object or closes what it did not open."""

    def __init__(self):
        self.keys: set[str] = set()
        self.depth = 0
        self.ok = True
        self.open_string: bytes | None = None  # the unfinished string, cut to what a key can need
        self.escaped = False
        self.last: bytes | None = None  # the last finished string at depth 1

    def feed(self, data: bytes) -> None:
        at = 0
        while self.ok and at < len(data):
            if self.open_string is not None:
                at = self._string(data, at)
                continue
            m = _NEXT.search(data, at)
            if self.depth == 0 and data[at : m.start() if m else len(data)].strip():
                self.ok = False
                return
            if m is None:
                return
            at = m.end()
            c = m[0]
            if self.depth == 0 and c != b"{":
                self.ok = False
            elif c == b'"':
                self.open_string, self.escaped = b"", False
            elif c in b"{[":
                self.depth += 1
            elif c in b"}]":
                self.depth -= 1
                self.last = None
            elif c == b":" and self.depth == 1 and self.last is not None:
                self._key(self.last)
                self.last = None
            elif c == b",":
                self.last = None

    def _string(self, data: bytes, at: int) -> int:
        """Reads on in a string; returns the place after what it took."""
        start = at
        while at < len(data):
            if self.escaped:
                self.escaped = False
                at += 1
                continue
            quote, slash = data.find(b'"', at), data.find(b"\\", at)
            if slash >= 0 and (quote < 0 or slash < quote):
                self.escaped = True
                at = slash + 1
            elif quote >= 0:
                self._keep(data[start:quote])
                if self.depth == 1:
                    self.last = self.open_string
                self.open_string = None
                return quote + 1
            else:
                at = len(data)
        self._keep(data[start:at])
        return at

    def _keep(self, piece: bytes) -> None:
        self.open_string = (self.open_string + piece[: max(0, 256 - len(self.open_string))])[:256]

    def _key(self, raw: bytes) -> None:
        try:
            self.keys.add(json.loads(b'"' + raw + b'"'))
        except ValueError:
            pass  # a key longer than any asked for


def has_record(path: str, wanted=("sample", "prediction"), chunk: int = CHUNK) -> bool:
    """Whether the first line of a file is a JSON object with the wanted keys, in bounded
    memory.  A line of up to WHOLE_LINE bytes is parsed as a whole, as the reference does;
    of a longer one the keys are collected piece by piece, and reading ends when all are
    there, so the rest of that line is not checked."""
    filesystem_, inner = filesystem(path)
    head, scanner = b"", None
    with filesystem_.open_input_stream(inner) as f:
        while True:
            data = f.read(chunk)
            cuts = [i for i in (data.find(b"\n"), data.find(b"\r")) if i >= 0]
            piece = data[: min(cuts)] if cuts else data
            if scanner is None:
                head += piece
                if not data or cuts:
                    return is_parts_line(head, wanted)
                if len(head) > WHOLE_LINE:
                    scanner = KeyScanner()
                    piece, head = head, b""
            if scanner is not None:
                for k in range(0, len(piece), chunk):
                    scanner.feed(piece[k : k + chunk])
                if not scanner.ok:
                    return False
                if scanner.keys.issuperset(wanted):
                    return True
                if not data or cuts:
                    return False


def is_parts_line(line: bytes, wanted=("sample", "prediction")) -> bool:
    try:
        text = line.decode("utf-8").strip()
        if not text:
            return False
        record = json.loads(text)
        return all(k in record for k in wanted)
    except (ValueError, TypeError):  # bad JSON or text; a record that has no membership test
        return False


def parts_files(paths: DataFrame, path_col: str = "path", threads: int = 16) -> DataFrame:
    """``(path)`` of the listed files whose first line is a parts record; one small read
    per file, spread over the tasks that hold the listing.  Reads are I/O-bound (an
    object-store open costs tens of milliseconds), so each task overlaps up to
    ``threads`` of them."""
    def sniff(batches):
        from concurrent.futures import ThreadPoolExecutor

        with ThreadPoolExecutor(max_workers=threads) as pool:
            for pdf in batches:
                listed = list(pdf[path_col])
                oks = pool.map(has_record, listed)
                keep = [p for p, ok in zip(listed, oks) if ok]
                yield pd.DataFrame({path_col: pd.Series(keep, dtype="object")})

    return paths.select(path_col).mapInPandas(sniff, f"{path_col} string")


def existing(spark, paths: list[str], threads: int = 16) -> list[str]:
    """The paths that exist, in the given order; checked in tasks, up to ``threads`` at a
    time each."""
    import pyarrow as pa

    def check(batches):
        from concurrent.futures import ThreadPoolExecutor

        from pyarrow import fs

        def there(path):
            filesystem_, inner = filesystem(path)
            return filesystem_.get_file_info(inner).type != fs.FileType.NotFound

        with ThreadPoolExecutor(max_workers=threads) as pool:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(pool.map(there, batch.column(1).to_pylist())))], names=["k", "there"])

    n = max(1, min(len(paths) // 64, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    listed = spark.createDataFrame(list(enumerate(paths)), "k bigint, path string").repartition(n)
    kept = {r["k"] for r in listed.mapInArrow(check, "k bigint, there boolean").filter("there").select("k").collect()}
    return [p for k, p in enumerate(paths) if k in kept]


IN_FLIGHT_BYTES = 64 << 20  # file contents a task holds at once (a larger file is held alone)


def contents(paths: list, threads: int = 8, in_flight: int = IN_FLIGHT_BYTES):
    """(content, error) of each path in order, in lists of files of together at most
    ``in_flight`` bytes; a None path gives (None, None)."""
    from concurrent.futures import ThreadPoolExecutor

    from pyarrow import fs

    def size(path):
        if path is None:
            return 0, None
        try:
            filesystem_, inner = filesystem(path)
            info = filesystem_.get_file_info(inner)
            return (info.size, None) if info.type == fs.FileType.File else (0, "no such file")
        except Exception as problem:  # an unknown store or a bad path is this row's error
            return 0, f"{type(problem).__name__}: {problem}"

    def fetch(path, error):
        if path is None or error is not None:
            return None, error
        try:
            filesystem_, inner = filesystem(path)
            with filesystem_.open_input_stream(inner, compression=None) as f:
                return f.read(), None
        except Exception as problem:
            return None, f"{type(problem).__name__}: {problem}"

    with ThreadPoolExecutor(max_workers=threads) as pool:
        for k in range(0, len(paths), 256):
            part = paths[k : k + 256]
            sizes = list(pool.map(size, part))
            start = held = 0
            for i, (n, _) in enumerate(sizes):
                if i > start and held + n > in_flight:
                    yield list(pool.map(fetch, part[start:i], [e for _, e in sizes[start:i]]))
                    start, held = i, 0
                held += n
            yield list(pool.map(fetch, part[start:], [e for _, e in sizes[start:]]))


def contents_udf():
    """Path column -> struct<content, error>.  Only the paths reach Python; contents go back
    in pieces of bounded size, whatever the size of an input batch."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("struct<content: binary, error: string>")
    def fetched(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for paths in batches:
            for found in contents([p if isinstance(p, str) else None for p in paths]):
                yield pd.DataFrame({"content": pd.Series([c for c, _ in found], dtype="object"), "error": pd.Series([e for _, e in found], dtype="object")})

    return fetched
