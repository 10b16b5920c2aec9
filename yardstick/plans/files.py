"""Registered queries over file trees (SRC-2..8, SRC-10, JON-10).

Each query writes files derived from the driver tables into a fresh folder under the
session's checkpoint directory (shared storage on a cluster), in the layouts the
reference reads, then runs the source operator on that folder.  Every write is a
distributed DataFrame write; file names are adjusted by metadata-only renames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import align, batching, extract, metrics
from ..session import scratch_path
from ..sinks import batch_files, writers
from ..sources import derived, scans
from . import evaluation as ev
from .jobs import discovered_predictions
from .oracle_common import ANSWERS_CTE, G_CTE, R_CTE, S_CTE, with_ctes


# Records per output file in the written trees: the reference's default batch size.
BATCH_SIZE = 500
# Text bytes of one Arrow shard, about.
SHARD_BYTES = 64 << 20


def _n(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _model_lines(spark, sf) -> DataFrame:
    """R and O lines with their dataset, model and output batch of ``BATCH_SIZE`` ids."""
    return derived.all_output_lines(spark, sf).select(
        "value",
        F.regexp_extract("source_file", r"outputs/([^/]+)/", 1).alias("dataset"),
        F.regexp_extract("source_file", r"outputs/[^/]+/([^/]+)/", 1).alias("model"),
        F.expr(f"line_pos div {BATCH_SIZE}").alias("batch"),
        "source_file",
        "file_block_start",
        "line_pos",
    )


def _write_text(df: DataFrame, path: str, suffix: str, partition_cols=(), order=("line_pos",)) -> None:
    """``value`` lines written in ``order`` (range partitioned, so a large group is split
    over tasks and each file holds one ordered run), then named with ``suffix``."""
    keys = [*partition_cols, *order]
    (
        df.repartitionByRange(_n(df.sparkSession), *keys)
        .sortWithinPartitions(*keys)
        .select(*partition_cols, "value")
        .write.mode("overwrite")
        .partitionBy(*partition_cols)
        .text(path)
    )
    writers.name_data_files(df.sparkSession, path, suffix)


def q_scan_discovery(spark, sf):
    """SRC-2/SRC-3 + JON-4 on an output folder named after its dataset (``pairs-r``):

    * ``kind=raw/batch=<k>/*.jsonl.out``: model-a's raw lines (recursive ``*.jsonl.out``, chosen);
    * ``kind=stale/batch=<k>/*.jsonl``: model-b's raw lines (recursive ``*.jsonl``, a later
      fallback: not read);
    * ``extract/part-*.json``: the extraction job's parts rows of model-b's lines (chosen);
    * ``kind=old/batch=<k>/part-*.json``: parts rows that all say ``yes`` under a first line
      that is not a parts record (the sniff drops the whole file).

    Result: the merged predictions (parts rows by batch_path; raw rows as dataset
    ``pairs-r``, model ``unknown``)."""
    out = f"{scratch_path(spark, 'discovery')}/pairs-r"
    lines = _model_lines(spark, sf).filter(F.col("model") != "model-odd")
    b = lines.filter(F.col("model") == "model-b")
    parts = extract.extracted_predictions(b, derived.RAW_PREFIX)
    kind = F.when(F.col("model") == "model-a", F.lit("raw")).otherwise(F.lit("stale"))
    raw = lines.select(kind.alias("kind"), "batch", "line_pos", "value")
    old = parts.select(
        F.lit("old").alias("kind"),
        F.expr(f"sample div {BATCH_SIZE}").alias("batch"),
        F.col("sample").alias("line_pos"),
        F.to_json(F.struct("sample", F.lit("yes").alias("prediction"), "batch_path", "source_file")).alias("value"),
    )
    # one note per batch of model-b's lines (from the lines, not the parsed rows, so the
    # parse runs once; a batch whose lines all drop gets a note-only file, which adds nothing)
    note = b.select(F.lit("old").alias("kind"), F.col("batch")).distinct().select(
        "kind", "batch", F.lit(-1).cast("bigint").alias("line_pos"),
        F.to_json(F.struct(F.lit("superseded run").alias("note"))).alias("value"),
    )
    # One write for the three text trees.  Hash partitioning on (kind, batch) keeps each
    # file whole (so every old file starts with its note line); a (kind, batch) group
    # holds at most BATCH_SIZE lines, so no task gets a group that grows with the data.
    (
        raw.unionByName(old).unionByName(note)
        .repartition(_n(spark), "kind", "batch")
        .sortWithinPartitions("kind", "batch", "line_pos")
        .select("kind", "batch", "value")
        .write.mode("overwrite").partitionBy("kind", "batch").text(out)
    )
    writers.name_data_files(spark, out, {"kind=raw": ".jsonl.out", "kind=stale": ".jsonl", "kind=old": ".json"})
    writers.write_predictions(parts, f"{out}/extract")  # after the tree: its overwrite clears the folder
    merged, _ = discovered_predictions(spark, out)
    return merged.select("dataset", "model", "sample_id", "prediction")


def q_scan_tolerant(spark, sf):
    """SRC-4: parts-json files with blank, whitespace-only and broken lines mixed in: blanks
    vanish; a truncated line, single quotes, text after the record, a second record, an
    array and a bare value are one ``malformed`` row each; an id given as text counts."""
    s = derived.parts_rows(spark, sf)
    js = F.to_json(F.struct("sample", "prediction", "batch_path", "source_file"))
    pieces = F.array(
        js,
        F.when(F.col("line_pos") % 7 == 0, F.lit("")),
        F.when(F.col("line_pos") % 5 == 0, F.lit(" \t ")),
        F.when(F.col("line_pos") % 11 == 0, F.substring(js, 1, 12)),
        F.when(F.col("line_pos") % 13 == 0, F.replace(js, F.lit('"'), F.lit("'"))),
        F.when(F.col("line_pos") % 17 == 0, F.concat(js, F.lit(" trailing"))),
        F.when(F.col("line_pos") % 19 == 0, F.concat(js, js)),
        F.when(F.col("line_pos") % 23 == 0, F.concat(F.lit("["), js, F.lit("]"))),
        F.when(F.col("line_pos") % 29 == 0, F.concat(js, F.lit("]"))),
        F.when(F.col("line_pos") % 31 == 0, F.lit("5")),
        F.when(F.col("line_pos") % 37 == 0, F.to_json(F.struct(F.col("sample").cast("string").alias("sample"), F.lit("text id").alias("prediction")))),
    )
    rows = s.select("arrival", "line_pos", F.posexplode(F.filter(pieces, lambda x: x.isNotNull())).alias("k", "value"))
    path = scratch_path(spark, "tolerant-parts")
    _write_text(rows, path, ".json", order=("arrival", "line_pos", "k"))
    back = scans.parts_json(spark, path)
    return back.select("sample", "prediction", "batch_path", "source_file", "malformed")


def q_scan_tolerant_raw(spark, sf):
    """SRC-1 + SRC-5 + AGG-11: raw ``*.jsonl.out`` files with blank and whitespace-only
    lines, scanned recursively with the file path; blanks are skipped, every other line
    is a row or a counted drop (same counts as ``parse_drops``)."""
    lines = _model_lines(spark, sf)
    pieces = F.array(
        F.col("value"),
        F.when(F.col("line_pos") % 4 == 0, F.lit("")),
        F.when(F.col("line_pos") % 9 == 0, F.lit("  \t")),
    )
    rows = lines.select(
        "dataset", "model", "batch", "line_pos", F.posexplode(F.filter(pieces, lambda x: x.isNotNull())).alias("k", "value")
    )
    root = scratch_path(spark, "tolerant-raw")
    _write_text(rows, root, ".jsonl.out", partition_cols=("dataset", "model", "batch"), order=("line_pos", "k"))
    scanned = scans.raw_output_text(spark, root)
    parsed = extract.parse_raw_lines(scanned, "contains", input_prefix=root)
    # the partition folders are named ``dataset=<d>``/``model=<m>``: strip the column names
    named = parsed.withColumn("dataset", F.regexp_replace("dataset", "^dataset=", "")).withColumn(
        "model", F.regexp_replace("model", "^model=", "")
    )
    return metrics.drop_counts(named)


def q_scan_missing_files(spark, sf):
    """SRC-6/SRC-7/SRC-8: a labelled dataset stored once as Parquet shards (built only when
    absent), then loaded from a shard list naming two shards that do not exist: the
    missing shards are skipped and counted."""
    path = scratch_path(spark, "dataset")
    g = derived.ground_truth(spark, sf)
    scans.cached_or_build(spark, path, lambda: g.repartitionByRange(_n(spark), "sample_id"))
    listed = scans.data_files(spark, path) + [f"{path}/part-missing-{i}.parquet" for i in range(2)]
    df, skipped = scans.robust_dataset(spark, listed)
    return df.withColumn("skipped_shards", F.lit(skipped).cast("bigint"))


def _shards_of(docs: DataFrame) -> int:
    """Shards that hold about ``SHARD_BYTES`` of text each: a task's share does not grow with the table."""
    size = docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    return max(4, -(-size // SHARD_BYTES))


def q_eval_from_shards(spark, sf):
    """SRC-6 + L3 on the saved-dataset layout: the labelled rows are written as Arrow
    shards without an id, read back with the row position as ``sample_id`` and only the
    label columns, and predictions by position are evaluated against them."""
    from ..sources import arrow_shards as AS

    docs = derived.read_table(spark, sf, "documents").select("doc_id", "text")
    labels = derived.read_table(spark, sf, "labels").select("doc_id", "quality")
    good = F.coalesce(F.col("quality") == 1, F.lit(False))
    rows = docs.join(labels, "doc_id", "left").repartitionByRange(_shards_of(docs), "doc_id").sortWithinPartitions("doc_id")
    rows = rows.select(
        F.encode("text", "UTF-8").alias("image"),
        F.when(good, F.lit("accept")).otherwise(F.lit("reject")).alias("label"),
        F.when(good, F.lit("")).otherwise(F.lit("Wrong Orientation")).alias("rejection_reason"),
    )
    path = scratch_path(spark, "eval-shards")
    AS.write_arrow_shards(rows, path)
    AS.register(spark)
    gt = align.ground_truth_table(AS.positioned(spark, path, ["label", "rejection_reason"]), "docs")
    predicted = F.when(F.length("text") % 3 > 0, F.lit("yes")).otherwise(F.lit("no"))
    numbered = batching.positions(docs.select(F.col("doc_id").alias("sample_id"), predicted.alias("prediction")))  # without the texts
    preds = numbered.select(F.lit("docs").alias("dataset"), F.lit("m").alias("model"), F.col("pos").alias("sample_id"), "prediction")
    m = metrics.eval_metrics(preds, gt)
    counts = ["true_positives", "false_positives", "false_negatives", "true_negatives"]
    return m.select("dataset", "model", F.round("accuracy", 6).alias("accuracy"), *[F.col(c).cast("bigint").alias(c) for c in counts])


def q_arrow_shards(spark, sf):
    """SRC-6/SRC-7 in the Arrow-shard layout: the labelled dataset written as one shard
    per task plus ``state.json``, which then also lists a shard that does not exist; the
    Python data source reads one partition per existing shard and the missing one is
    skipped and counted."""
    from ..sources import arrow_shards as AS

    path = scratch_path(spark, "arrow-dataset")
    g = derived.ground_truth(spark, sf).repartitionByRange(_n(spark), "sample_id")
    names = AS.write_arrow_shards(g, path, state=False)
    AS.write_state(path, names + [f"data-{len(names):05d}-of-{len(names):05d}.arrow"])
    AS.register(spark)
    skipped = AS.shard_listing(path)[1]
    return spark.read.format(AS.NAME).load(path).withColumn("skipped_shards", F.lit(skipped).cast("bigint"))


def q_image_resolve(spark, sf):
    """SRC-10/JON-10: image cells ``struct<bytes, path>`` over ``pages``: a third carry the
    bytes, a third only a path to a file written from the page, a third a path to a
    missing file (an error row).  Files are opened by the tasks that hold their rows."""
    pages = derived.read_table(spark, sf, "pages").select("page_id", "html")
    v = F.col("page_id") % 3
    root = scratch_path(spark, "images")
    name = F.concat(F.lit("page_"), F.col("page_id").cast("string"), F.lit(".html"))
    batch_files.register(spark)
    pages.filter(v == 1).select(name.alias("name"), F.col("html").alias("value")).write.format(batch_files.NAME).mode("overwrite").save(root)
    cell = F.struct(
        F.when(v == 0, F.encode("html", "UTF-8")).alias("bytes"),
        F.when(v == 1, F.concat(F.lit(f"{root}/"), name)).when(v == 2, F.concat(F.lit(f"{root}/missing_"), name)).alias("path"),
    )
    out = scans.resolve_images(pages.select("page_id", cell.alias("image")), "image")
    return out.select("page_id", F.md5("image_bytes").alias("image_md5"), F.col("image_error").isNotNull().alias("failed"))


QUERIES = {
    "scan_discovery": q_scan_discovery,
    "scan_tolerant": q_scan_tolerant,
    "scan_tolerant_raw": q_scan_tolerant_raw,
    "scan_missing_files": q_scan_missing_files,
    "arrow_shards": q_arrow_shards,
    "eval_from_shards": q_eval_from_shards,
    "image_resolve": q_image_resolve,
}

ORACLE = {
    "scan_discovery": with_ctes(R_CTE, ANSWERS_CTE) + """
SELECT dataset, 'model-b' AS model, CAST(sample_id AS BIGINT) AS sample_id, lower(trim(a_raw_tail)) AS prediction
FROM ans WHERE model = 'model-b' AND lower(trim(a_raw_tail)) IN ('yes', 'no')
UNION ALL
SELECT 'pairs-r', 'unknown', CAST(sample_id AS BIGINT), a_contains FROM ans WHERE model = 'model-a'
""",
    "scan_tolerant": with_ctes(S_CTE) + """
SELECT CAST(sample AS BIGINT) AS sample, prediction, batch_path, source_file, false AS malformed FROM s
UNION ALL
SELECT NULL, NULL, NULL, '', true FROM s, unnest([11, 13, 17, 19, 23, 29, 31]) t(k) WHERE line_pos % k = 0
UNION ALL
SELECT CAST(sample AS BIGINT), 'text id', NULL, '', false FROM s WHERE line_pos % 37 = 0
""",
    "scan_tolerant_raw": ev.ORACLE["parse_drops"],
    "scan_missing_files": with_ctes(G_CTE) + "SELECT *, CAST(2 AS BIGINT) AS skipped_shards FROM g",
    "eval_from_shards": """
WITH r AS (SELECT length(text) % 3 > 0 AS p, coalesce(quality = 1, false) AS t FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
c AS (SELECT count(*) FILTER (WHERE t AND p) AS tp, count(*) FILTER (WHERE NOT t AND p) AS fp,
             count(*) FILTER (WHERE t AND NOT p) AS fn, count(*) FILTER (WHERE NOT t AND NOT p) AS tn FROM r)
SELECT 'docs' AS dataset, 'm' AS model, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
       CAST(tp AS BIGINT) AS true_positives, CAST(fp AS BIGINT) AS false_positives,
       CAST(fn AS BIGINT) AS false_negatives, CAST(tn AS BIGINT) AS true_negatives FROM c
""",
    "arrow_shards": with_ctes(G_CTE) + "SELECT *, CAST(1 AS BIGINT) AS skipped_shards FROM g",
    "image_resolve": """
SELECT page_id,
       CASE page_id % 3 WHEN 0 THEN md5(html) WHEN 1 THEN md5(html || chr(10)) END AS image_md5,
       page_id % 3 = 2 AS failed
FROM pages
""",
}
