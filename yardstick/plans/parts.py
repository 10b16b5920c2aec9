"""Registered queries over parts-json prediction rows (S): path fields, filtering,
re-indexing, last-write-wins dedup and precedence merge."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import records
from ..operators import align, extract
from ..sources import derived
from .oracle_common import P_CTE, R_CTE, S_CTE, with_ctes


def parts(spark, sf):
    return derived.parts_rows(spark, sf)


def parts_preds(spark, sf):
    return extract.parts_predictions(parts(spark, sf))


def q_path_fields(spark, sf):
    s = parts(spark, sf)
    return s.select(
        F.col("sample").cast("bigint").alias("sample"),
        "arrival",
        "line_pos",
        records.dataset_name("batch_path").alias("dataset"),
        records.model_name("batch_path").alias("model"),
        records.batch_number("source_file").alias("batch_num"),
        records.batch_path("source_file", "s3://bucket/proj/outputs/").alias("bp_prefix"),
        records.batch_path("source_file", "s3://other/x/outputs/").alias("bp_folder"),
        records.batch_path("source_file", "s3://z/y/nomatch").alias("bp_bucket"),
        records.dataset_name(records.batch_path("source_file", "s3://bucket/proj/outputs/")).alias("dataset_from_file"),
        records.directory_dataset("/data/outputs/pairs-run").alias("dir_dataset"),
    )


def q_parts_filter(spark, sf):
    return parts_preds(spark, sf).select("dataset", "model", "sample_id", "prediction", "arrival", "line_pos")


def q_reindex_auto(spark, sf):
    r = align.resolve_indices(parts_preds(spark, sf), mode="auto")
    return r.select("dataset", "model", "sample_id", "raw_sample_id", "prediction", "arrival", "line_pos")


def q_last_write_wins(spark, sf):
    p = parts_preds(spark, sf)
    return align.last_write_wins(p, order_cols=("source_file", "line_pos"), values=("prediction", "arrival"), answers=("no", "yes"))


def q_merge_precedence(spark, sf):
    """Parts rows (primary) over raw rows (secondary), each deduplicated by file/line
    order, in one aggregation."""
    primary = parts_preds(spark, sf)
    secondary = extract.raw_predictions(derived.raw_output_lines(spark, sf), derived.RAW_PREFIX)
    return align.merge_precedence(primary, secondary, order_cols=("source_file", "line_pos"), answers=("no", "yes"))


def q_flat_merge(spark, sf):
    return align.flat_merge(parts_preds(spark, sf))


QUERIES = {
    "flat_merge": q_flat_merge,
    "path_fields": q_path_fields,
    "parts_filter": q_parts_filter,
    "reindex_auto": q_reindex_auto,
    "last_write_wins": q_last_write_wins,
    "merge_precedence": q_merge_precedence,
}

_F = with_ctes(S_CTE) + """,
f AS (SELECT split_part(batch_path, '/', 2) AS dataset, split_part(batch_path, '/', 3) AS model,
             CAST(sample AS BIGINT) AS sample, lower(trim(prediction)) AS prediction, source_file, arrival, line_pos
      FROM s WHERE lower(trim(prediction)) IN ('yes', 'no') AND sample IS NOT NULL)
"""

_DEDUP = _F.rstrip() + """,
d AS (SELECT dataset, model, sample AS sample_id, prediction, arrival FROM (
        SELECT *, row_number() OVER (PARTITION BY dataset, model, sample ORDER BY replace(source_file, '/', chr(1)) DESC, line_pos DESC) AS rn FROM f)
      WHERE rn = 1)
"""

ORACLE = {
    "flat_merge": _F + """,
fr AS (SELECT dataset, source_file, line_pos FROM (
         SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY replace(source_file, '/', chr(1)), line_pos) AS rn FROM f) WHERE rn = 1),
rk AS (SELECT dataset, row_number() OVER (ORDER BY replace(source_file, '/', chr(1)), line_pos) AS r FROM fr),
w AS (SELECT f.*, rk.r, row_number() OVER (PARTITION BY sample ORDER BY rk.r DESC, replace(source_file, '/', chr(1)) DESC, line_pos DESC) AS rn
      FROM f JOIN rk ON f.dataset = rk.dataset)
SELECT sample AS sample_id, prediction, dataset FROM w WHERE rn = 1
""",
    "path_fields": with_ctes(S_CTE) + """
SELECT CAST(sample AS BIGINT) AS sample, arrival, line_pos,
       split_part(batch_path, '/', 2) AS dataset, split_part(batch_path, '/', 3) AS model,
       coalesce(TRY_CAST(regexp_extract(source_file, 'batch_(\\d+)', 1) AS BIGINT), 0) AS batch_num,
       'outputs/' || substr(source_file, length('s3://bucket/proj/outputs/') + 1) AS bp_prefix,
       'outputs/' || regexp_extract(source_file, 'outputs/(.*)', 1) AS bp_folder,
       'nomatch/' || regexp_extract(source_file, 's3://[^/]+/[^/]+/(.*)', 1) AS bp_bucket,
       split_part(source_file, '/', 6) AS dataset_from_file,
       'pairs-run' AS dir_dataset
FROM s
""",
    "parts_filter": _F + "SELECT dataset, model, sample AS sample_id, prediction, arrival, line_pos FROM f",
    "reindex_auto": _F + """,
st AS (SELECT dataset, model, max(sample) > 2 * count(*) AS needs FROM f GROUP BY ALL)
SELECT f.dataset, f.model,
       CAST(CASE WHEN needs THEN row_number() OVER (PARTITION BY f.dataset, f.model
            ORDER BY coalesce(TRY_CAST(regexp_extract(source_file, 'batch_(\\d+)', 1) AS BIGINT), 0), sample, replace(source_file, '/', chr(1)), line_pos) - 1
            ELSE sample END AS BIGINT) AS sample_id,
       sample AS raw_sample_id, prediction, arrival, line_pos
FROM f JOIN st ON f.dataset = st.dataset AND f.model = st.model
""",
    "last_write_wins": _DEDUP + "SELECT dataset, model, sample_id, prediction, arrival FROM d",
    "merge_precedence": _DEDUP.rstrip() + ",\n" + R_CTE + ",\n" + P_CTE + """
SELECT coalesce(d.dataset, p.dataset) AS dataset, coalesce(d.model, p.model) AS model,
       CAST(coalesce(d.sample_id, p.sample_id) AS BIGINT) AS sample_id,
       coalesce(d.prediction, p.prediction) AS prediction, d.sample_id IS NULL AS from_secondary
FROM d FULL OUTER JOIN p ON d.dataset = p.dataset AND d.model = p.model AND d.sample_id = p.sample_id
""",
}
