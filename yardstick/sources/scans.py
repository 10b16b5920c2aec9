"""File scans (SRC-1..11).

All scans are ``spark.read`` with options; the file's path, block start and a
monotonically increasing id travel with each row so that "last line wins"
(WIN-2) has a deterministic order without any per-file Python loop.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import records
from ..functions.text import regex_quote
from ..operators.extract import non_blank, pin_columns

PARTS_SCHEMA = T.StructType(
    [
        T.StructField("sample", T.LongType()),
        T.StructField("prediction", T.StringType()),
        T.StructField("batch_path", T.StringType()),
        T.StructField("source_file", T.StringType()),
    ]
)


def _with_file_order(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("file_block_start"),
        F.monotonically_increasing_id().alias("line_pos"),
    )


def raw_output_text(
    spark: SparkSession, prefix: str, glob: str = "*.jsonl.out", recursive: bool = True, literal: bool = False
) -> DataFrame:
    """SRC-1: text scan of raw output files with the file path per line: at any depth
    (``recursive``), or only the files directly in ``prefix`` (a Hadoop glob, so nested
    files are never listed or read).  Spark reads a prefix as a glob; ``literal`` takes
    it as a plain folder name (the flat form always does)."""
    if recursive:
        src = _glob_escape(prefix) if literal else prefix
        df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(src)
    else:
        df = spark.read.text(_glob_escape(prefix.rstrip("/")) + "/" + glob)
    return _with_file_order(df).select("value", "source_file", "file_block_start", "line_pos")


def _glob_escape(path: str) -> str:
    """A literal path inside a Hadoop glob (glob characters escaped)."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


# Discovery classes in the reference's fallback order (SRC-2):
# (class, file-name glob, recursive).  The first class with any file wins.
_RAW_CLASSES = [
    (0, "*.jsonl.out", False),
    (1, "*.jsonl.out.*", False),
    (2, "*.jsonl", False),
    (3, "*.jsonl.out", True),
    (4, "*.jsonl.out.*", True),
    (5, "*.jsonl", True),
]
_CLASS_NAME_RE = {"*.jsonl.out": r"\.jsonl\.out$", "*.jsonl.out.*": r"\.jsonl\.out\.[^/]*$", "*.jsonl": r"\.jsonl$"}


def listed_files(spark: SparkSession, output_dir: str) -> DataFrame:
    """SRC-2: the files below a folder by path, from a ``binaryFile`` scan that reads no
    content."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(_glob_escape(output_dir)).select("path")


def file_classes(spark: SparkSession, output_dir: str) -> tuple[int | None, int | None]:
    """SRC-2: the winning class of the raw side and of the parts side (None: no file), by one
    job over one listing; two integers reach the driver."""
    rel = F.regexp_replace(F.col("path"), _below(qualified(spark, output_dir)), "")
    raw = F.lit(None).cast("int")
    for cls, glob, recursive in reversed(_RAW_CLASSES):
        name_ok = rel.rlike(_CLASS_NAME_RE[glob])
        depth_ok = F.lit(True) if recursive else ~rel.contains("/")
        raw = F.when(name_ok & depth_ok, F.lit(cls)).otherwise(raw)
    is_json, name = rel.endswith(".json"), F.element_at(F.split(rel, "/"), -1)
    parts = F.when(is_json & ~rel.contains("/"), F.lit(0)).when(is_json & name.startswith("part-"), F.lit(1))
    return tuple(listed_files(spark, output_dir).agg(F.min(raw), F.min(parts)).first())


def discover_raw_lines(spark: SparkSession, output_dir: str, classes: tuple | None = None) -> DataFrame:
    """SRC-2 (raw side).  Files are ranked from a listing (``file_classes``, or ``classes``
    if the caller has them), and only files of the best class are scanned as text: large
    input files lying next to the outputs are never read when output files exist."""
    best = (classes or file_classes(spark, output_dir))[0]
    if best is None:
        return spark.createDataFrame([], "value string, source_file string, file_block_start bigint, line_pos bigint")
    _, glob, recursive = _RAW_CLASSES[best]
    # the class is selected at file level (glob or file-name filter): no per-row path test
    return raw_output_text(spark, output_dir, glob=glob, recursive=recursive, literal=True)


def plain_path(c) -> "F.Column":
    """``_metadata.file_path`` is URI-encoded (a space is ``%20``); this is the exact
    percent-decoding back to the path as listed (``+`` is kept as a literal ``+``)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.try_url_decode(F.replace(col, F.lit("+"), F.lit("%2B")))


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder as the file system lists it, without scheme and authority, ending in ``/``:
    ``dir``, ``/dir/``, ``file:///dir`` and ``hdfs:///dir`` all match the paths below it."""
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    path = Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(path).toUri().getPath().rstrip("/") + "/"


def _below(base: str) -> str:
    """Pattern of a listed path up to the base folder."""
    return r"^(?:[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?)?" + regex_quote(base)


def parts_json(spark: SparkSession, path: str, glob: str = "*.json", recursive: bool = True, literal: bool = False) -> DataFrame:
    """SRC-4: tolerant parts-json read: a text scan with one strict value per line, as the
    raw lines are read.  Blank lines vanish; a line that is not exactly one JSON object is
    a ``malformed`` row.  An id is whole: text holding an integer counts, a fraction is cut,
    anything else is NULL.  Files match ``glob`` at any depth (``recursive``) or directly in
    ``path``."""
    if recursive:
        src = _glob_escape(path) if literal else path
        df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(src)
    else:
        df = spark.read.text(_glob_escape(path.rstrip("/")) + "/" + glob)
    names = [f.name for f in PARTS_SCHEMA.fields]
    lines = _with_file_order(df).filter(non_blank("value"))
    parsed = lines.select(
        records.strict_object(F.col("value"), ", ".join(f"{n} string" for n in names)).alias("_v"),
        F.col("source_file").alias("file_path"),
        "file_block_start",
        "line_pos",
    )
    v = F.col("_v")
    bad = records.malformed(v)
    value = lambda n: F.when(~bad, records.field(v, n))
    sample = F.coalesce(value("sample").try_cast("bigint"), F.floor(F.abs(value("sample").try_cast("double"))) * F.signum(value("sample").try_cast("double")))
    rows = parsed.select(
        sample.cast("bigint").alias("sample"),
        value("prediction").alias("prediction"),
        value("batch_path").alias("batch_path"),
        F.coalesce(value("source_file"), F.lit("")).alias("source_file"),
        "file_path",
        "file_block_start",
        "line_pos",
        bad.alias("malformed"),
    )
    return pin_columns(rows)


def discover_parts(spark: SparkSession, output_dir: str, sniff: bool = True, classes: tuple | None = None) -> DataFrame:
    """SRC-2 (parts side) and SRC-3, in the reference's fallback order.

    Any flat ``*.json`` file (``metrics.json`` included) selects the flat class, and
    then the recursive ``part-*.json`` search is not made; ``metrics.json`` itself is
    never read.  With ``sniff`` a chosen file is kept only when its first line is a
    JSON object holding ``sample`` and ``prediction``.  Files are ranked from a
    content-free listing (``file_classes``, or ``classes`` if the caller has them), then
    only the chosen class is scanned tolerantly (SRC-4)."""
    best = (classes or file_classes(spark, output_dir))[1]
    if best is None:
        return spark.createDataFrame([], parts_json_schema())
    # the class is selected at file level: flat *.json by a glob, part-*.json at any depth
    # by a file-name filter; only metrics.json needs a row test (a constant per file)
    df = parts_json(spark, output_dir, glob="*.json" if best == 0 else "part-*.json", recursive=best == 1, literal=True)
    df = df.filter(F.element_at(F.split("file_path", "/"), -1) != F.lit("metrics.json"))
    if not sniff:
        return df
    from . import heads

    if heads.reachable(output_dir):
        # SRC-3 by first lines: one small read per chosen file on the executors
        base = qualified(spark, output_dir)
        chosen = listed_files(spark, output_dir).filter(_parts_class_filter(F.col("path"), base, best))
        ok = heads.parts_files(chosen).select(F.col("path").alias("_plain"))
        return df.withColumn("_plain", plain_path("file_path")).join(ok, "_plain", "left_semi").drop("_plain")
    # Other stores: the first line of each chosen file from a text scan.  Only rows of a
    # file's first split qualify; min_by keeps one candidate per file and task before the
    # shuffle, so the per-file table has one row per file and AQE broadcasts it when small.
    base = qualified(spark, output_dir)
    text = _with_file_order(
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(_glob_escape(output_dir))
    ).select("value", F.col("source_file").alias("file_path"), "file_block_start", "line_pos")
    first = (
        text.filter((F.col("file_block_start") == 0) & _parts_class_filter(plain_path("file_path"), base, best))
        .groupBy("file_path")
        .agg(F.min_by("value", "line_pos").alias("_first"))
        .filter(is_parts_record("_first"))
        .select("file_path")
    )
    return df.join(first, "file_path", "left_semi")


def _parts_class_filter(path: "F.Column", base: str, best: int):
    frel = F.regexp_replace(path, _below(base), "")
    fname = F.element_at(F.split(frel, "/"), -1)
    chosen = (~frel.contains("/")) if best == 0 else fname.startswith("part-")
    return chosen & (fname != "metrics.json")


def parts_json_schema() -> str:
    return ("sample bigint, prediction string, batch_path string, source_file string, file_path string, "
            "file_block_start bigint, line_pos bigint, malformed boolean")


def is_parts_record(value: str = "value"):
    """SRC-3 per row: a JSON object holding both ``sample`` and ``prediction``."""
    v = F.try_parse_json(F.col(value))
    return F.coalesce(
        F.try_variant_get(v, "$.sample", "variant").isNotNull() & F.try_variant_get(v, "$.prediction", "variant").isNotNull(), F.lit(False)
    )


def labelled_dataset(spark: SparkSession, path: str, ignore_missing: bool = True) -> DataFrame:
    """SRC-6/SRC-7: a labelled dataset stored as Parquet; missing files are skipped."""
    reader = spark.read.option("ignoreMissingFiles", str(ignore_missing).lower())
    return reader.parquet(path)


def ground_truth_from_mapping(mapping: dict[str, DataFrame]) -> DataFrame:
    """SRC-11: NAME -> dataset mapping as one table with a ``dataset`` column."""
    if not mapping:
        raise ValueError("empty dataset mapping")
    frames = [df.withColumn("dataset", F.lit(name)) for name, df in mapping.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def parse_mapping(items: list[str]) -> dict[str, str]:
    """``NAME=PATH`` strings -> dict, split on the first ``=`` (driver-side parameters)."""
    out = {}
    for item in items:
        if "=" not in item:
            raise ValueError(f"Invalid dataset mapping {item!r}. Expected NAME=PATH")
        name, path = item.split("=", 1)
        out[name.strip()] = path.strip()
    return out


__all__ = [
    "raw_output_text",
    "discover_raw_lines",
    "parts_json",
    "is_parts_record",
    "labelled_dataset",
    "ground_truth_from_mapping",
    "parse_mapping",
    "non_blank",
]


def existing_paths(spark: SparkSession, paths: list[str]) -> tuple[list[str], int]:
    """SRC-7 helper: keep the shard paths that exist (metadata only, no data read) and report
    how many were skipped.  The checks run in tasks, many at a time, where pyarrow reaches
    the store; one by one through the Hadoop file system elsewhere."""
    from . import heads

    if all(heads.reachable(p) for p in paths) and len(paths) > 1:
        kept = heads.existing(spark, paths)
        return kept, len(paths) - len(kept)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    kept = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if hp.getFileSystem(conf).exists(hp):
            kept.append(p)
    return kept, len(paths) - len(kept)


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The data files (``part-*``) Spark wrote below ``path``: a metadata listing through
    the Hadoop file system, one entry per written file (not per row)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    found = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(root, True)
    out = []
    while found.hasNext():
        p = found.next().getPath()
        if p.getName().startswith("part-"):
            out.append(p.toString())
    return sorted(out)


def robust_dataset(spark: SparkSession, shard_paths: list[str]) -> tuple[DataFrame, int]:
    """SRC-7: load a dataset from its shard list while skipping missing shards; raise
    when none is left.  Files that vanish between listing and reading are skipped
    by ``ignoreMissingFiles``.  Returns the DataFrame and the number skipped."""
    kept, skipped = existing_paths(spark, shard_paths)
    if not kept:
        raise FileNotFoundError(f"all {len(shard_paths)} shards are missing")
    return spark.read.option("ignoreMissingFiles", "true").parquet(*kept), skipped


def training_manifest(spark: SparkSession, path: str) -> DataFrame:
    """SRC-9: the rows used for training, ``(split, sample_id)``, from a manifest.

    A ``*.json`` file is read as one JSON document whose ``all_indices`` maps each split
    to its ids (the reference's ``train_indices.json``).  A folder is read as the
    per-split JSON lines written by ``writers.write_sample``.  A missing manifest
    excludes nothing: an empty table and a warning, as in the reference."""
    import logging

    if not existing_paths(spark, [path])[0]:
        logging.getLogger(__name__).warning("No manifest at %s: no rows excluded", path)
        return spark.createDataFrame([], "split string, sample_id bigint")
    if path.rstrip("/").endswith(".json"):
        doc = spark.read.schema("all_indices map<string, array<bigint>>").option("multiLine", "true").json(path)
        per_split = doc.select(F.explode("all_indices").alias("split", "ids"))
        return per_split.select("split", F.explode("ids").alias("sample_id"))
    from ..operators.sampling import manifest_rows

    return manifest_rows(spark.read.json(path))


def cached_or_build(spark: SparkSession, path: str, build, force: bool = False) -> DataFrame:
    """SRC-8: reuse a stored table unless ``force``; otherwise build, write and read it back."""
    if not force and existing_paths(spark, [path])[0]:
        return spark.read.parquet(path)
    build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def resolve_images(df: DataFrame, image_col: str, files: DataFrame | None = None) -> DataFrame:
    """SRC-10/JON-10: an image cell ``struct<bytes, path>`` -> bytes: the stored bytes, else
    the content of the file at ``path``, else an error message in ``<image_col>_error``.

    A file is opened in the task that holds its row, so no content is shuffled; only the
    paths cross into Python, and a task holds a bounded number of bytes (``heads.contents``).
    ``files``, a ``binaryFile`` scan, is joined by path instead, for stores pyarrow does not
    reach."""
    img = F.col(image_col)
    stored = F.when(F.octet_length(img["bytes"]) > 0, img["bytes"])  # empty bytes are no image
    path = F.nullif(img["path"], F.lit(""))
    if files is None:
        from . import heads

        out = df.withColumn("_img", heads.contents_udf()(F.when(stored.isNull(), path)))
        resolved, why = F.coalesce(stored, F.col("_img.content")), F.col("_img.error")
    else:
        f = files.select(F.regexp_replace("path", "^file:", "").alias("_file_path"), F.col("content").alias("_file_bytes"))
        out = df.withColumn("_img_path", F.regexp_replace(path, "^file:", ""))
        from_file = stored.isNull() & path.isNotNull()
        need, have = out.filter(from_file), out.filter(~from_file)
        need = need.join(f, F.col("_img_path") == F.col("_file_path"), "left").drop("_file_path")
        out = have.withColumn("_file_bytes", F.lit(None).cast("binary")).unionByName(need)
        resolved, why = F.coalesce(stored, F.col("_file_bytes")), F.lit(None).cast("string")
    err = F.when(resolved.isNull(), F.concat_ws(": ", F.lit("Cannot resolve image"), F.coalesce(path, F.lit("no bytes and no path")), why))
    out = out.withColumn(f"{image_col}_bytes", resolved).withColumn(f"{image_col}_error", err)
    return out.drop("_img", "_img_path", "_file_bytes")
