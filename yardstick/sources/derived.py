"""Inputs derived from the driver tables, so every query's work grows with them.

* ``ground_truth_sql`` (G): a labelled pair dataset built from ``labels``.
* ``parts_rows_sql`` (S): parts-json prediction rows with duplicates and
  partition-offset style ids, built from ``documents``.
* ``raw_output_lines`` (R): raw batch-output JSON lines, one per (document, model),
  in the ten line shapes the parser must handle.
* ``odd_output_lines`` (O): one more line per document, in the shapes a tolerant reader
  takes wrongly (no single value on the line, odd elements in lists).

G and S are portable SQL texts: Spark runs them through ``spark.sql`` with the
table bound as a DataFrame argument, and the DuckDB oracle runs the very same
text, so the oracle and the engine start from identical inputs.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


_SCHEMAS: dict[str, object] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table.  Its schema is inferred once per path and process (Parquet schema
    inference runs a job that reads a footer); later reads pass it to the reader."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    schema = _SCHEMAS.get(path)
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    df = spark.read.parquet(path)
    _SCHEMAS[path] = df.schema
    return df


# The derived fixtures' SQL.  ``{labels}``/``{documents}`` are bound to
# DataFrames in Spark and replaced by the view names for DuckDB.
GROUND_TRUTH_SQL = """
SELECT doc_id AS sample_id,
       CASE WHEN doc_id % 20 < 10 THEN 'pairs-r' ELSE 'pairs-s' END AS dataset,
       CASE WHEN quality = 1 AND toxic = 0
            THEN CASE doc_id % 4 WHEN 0 THEN 'accepted' WHEN 1 THEN 'accept' WHEN 2 THEN ' Accepted ' ELSE 'ACCEPT' END
            ELSE CASE doc_id % 2 WHEN 0 THEN 'rejected' ELSE 'reject' END END AS label,
       CASE WHEN quality = 1 AND toxic = 0 THEN CASE WHEN doc_id % 20 < 10 THEN 'accepted' ELSE '' END
            WHEN doc_id % 20 < 10
            THEN CASE doc_id % 7 WHEN 0 THEN 'Irrelevant Objects' WHEN 1 THEN 'Geometry Artifacts'
                 WHEN 2 THEN 'Texture/Lighting/Color Issues' WHEN 3 THEN 'Wrong Orientation'
                 WHEN 4 THEN 'Background Issues' WHEN 5 THEN ' ' ELSE NULL END
            ELSE CASE doc_id % 3 WHEN 0 THEN 'wrong_orientation' WHEN 1 THEN 'wrong_product_same_pt'
                 ELSE 'wrong_product_different_pt' END END AS rejection_reason,
       CASE WHEN doc_id % 11 = 0 THEN NULL ELSE concat('item ', CAST(doc_id AS VARCHAR(20))) END AS object_description
FROM {labels}
"""

PARTS_ROWS_SQL = """
SELECT CASE WHEN doc_id % 20 < 10 THEN CAST((doc_id - doc_id % 20) / 2 AS BIGINT) + doc_id % 20
            ELSE doc_id + (doc_id % 4) * 8589934592 END AS sample,
       CASE doc_id % 5 WHEN 0 THEN 'yes' WHEN 1 THEN 'NO' WHEN 2 THEN ' Yes ' WHEN 3 THEN 'maybe' ELSE 'no' END AS prediction,
       concat('outputs/', CASE WHEN doc_id % 20 < 10 THEN 'pairs-r' ELSE 'pairs-s' END, '/model-a/run') AS batch_path,
       concat('s3://bucket/proj/outputs/', CASE WHEN doc_id % 20 < 10 THEN 'pairs-r' ELSE 'pairs-s' END,
              '/model-a/batch_', CAST(CAST((doc_id - doc_id % 100) / 100 AS BIGINT) AS VARCHAR(20)), '/part.json') AS source_file,
       1 AS arrival, doc_id AS line_pos
FROM {documents}
UNION ALL
SELECT CAST(doc_id / 2 AS BIGINT), 'no', 'outputs/pairs-r/model-a/run', 's3://bucket/proj/outputs/pairs-r/model-a/rerun/part.json', 2, doc_id
FROM {documents} WHERE doc_id % 20 = 0
"""

RAW_PREFIX = "s3://bucket/proj/outputs/"
MODELS = (("model-a", 1, 0), ("model-b", 3, 1))  # variant v = (doc_id * a + b) % 10


def oracle_text(sql: str) -> str:
    """The fixture SQL with plain view names, for DuckDB."""
    return sql.replace("{labels}", "labels").replace("{documents}", "documents")


def ground_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G: (sample_id, dataset, label, rejection_reason, object_description)."""
    labels = read_table(spark, sf_dir, "labels")
    return spark.sql(GROUND_TRUTH_SQL, labels=labels)


def parts_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S: (sample, prediction, batch_path, source_file, arrival, line_pos)."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id")
    return spark.sql(PARTS_ROWS_SQL, documents=documents)


# The ten raw line shapes, by variant v; %d is the document id.
_LINE_SHAPES = [
    '{"recordId": "sample_%d", "modelOutput": {"content": [{"type": "text", "text": "<reasoning>ok</reasoning>\\nYes"}]}}',
    '{"recordId": "sample_%d", "modelOutput": "{\\"content\\": [{\\"type\\": \\"image\\"}, {\\"type\\": \\"text\\", \\"text\\": \\"<reasoning>bad</reasoning>No\\"}]}"}',
    '{"payload": {"record_id": "sample_%d"}, "SageMakerOutput": {"choices": [{"message": {"content": "<reasoning>ok</reasoning>\'Yes\'"}}]}}',
    '{"recordId": "sample_%d", "modelOutput": {"content": [{"type": "text", "text": "<reasoning>a</reasoning>Yes</REASONING> No"}]}}',
    '{"recordId": "sample_%d", "modelOutput": {"content": [{"text": "Yes"}]}}',
    '{"record_id": "sample_%d", "SageMakerOutput": {"choices": [{"message": {"content": "yes"}}]}}',
    '{"recordId": "sample_%d", "error": {"errorCode": 400, "errorMessage": "model error"}}',
    '{"recordId": "sample_',
    '{"recordId": "row-%d", "modelOutput": {"content": [{"type": "text", "text": "<reasoning>ok</reasoning>Yes"}]}}',
    '{"recordId": "sample_%d", "modelOutput": {"content": [{"type": "text", "text": "<reasoning>x</reasoning>eyes only"}]}}',
]


def raw_output_lines(spark: SparkSession, sf_dir: str, prefix: str = RAW_PREFIX) -> DataFrame:
    """R: one raw output line per (document, model).

    Columns mirror a text scan of the output folder: ``value`` (the line),
    ``source_file`` and the line-order keys ``file_block_start``/``line_pos``.
    The model fan-out is an ``explode`` of a two-element literal array (no join).
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    models = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(a).alias("a"), F.lit(b).alias("b")) for m, a, b in MODELS])
    rows = docs.select("doc_id", F.explode(models).alias("m"))
    v = (F.col("doc_id") * F.col("m.a") + F.col("m.b")) % 10
    shape = F.element_at(F.array(*[F.lit(s) for s in _LINE_SHAPES]), (v + 1).cast("int"))
    dataset = F.when(F.col("doc_id") % 20 < 10, F.lit("pairs-r")).otherwise(F.lit("pairs-s"))
    source_file = F.concat(
        F.lit(prefix.rstrip("/") + "/"), dataset, F.lit("/"), F.col("m.model"),
        F.lit("/batch_"), F.floor(F.col("doc_id") / 50).cast("string"), F.lit("/part.jsonl.out"),
    )
    return rows.select(
        F.replace(shape, F.lit("%d"), F.col("doc_id").cast("string")).alias("value"),
        source_file.alias("source_file"),
        F.lit(0).cast("bigint").alias("file_block_start"),
        F.col("doc_id").alias("line_pos"),
    )


# The odd line shapes, by doc_id % 13; %d is the document id.
_ODD_SHAPES = [
    "{'recordId': 'sample_%d', 'modelOutput': {'content': [{'type': 'text', 'text': 'yes'}]}}",
    '{"recordId": "sample_%d", "modelOutput": {"content": [{"type": "text", "text": "yes"}]}} trailing',
    '{"recordId": "sample_%d", "modelOutput": {"content": [{"text": "yes"}]}}{"recordId": "sample_%d"}',
    '[{"recordId": "sample_%d", "modelOutput": {"content": [{"text": "yes"}]}}]',
    '{"recordId": "sample_%d", "modelOutput": {"content": [{"text": "yes"}]}}]',
    '{"recordId": "sample_%d", "modelOutput": {"content": [{"text": "yes"}]}},',
    "5",
    '{"recordId": "sample_%d", "modelOutput": {"content": ["x", 7, null, {"type": "text", "text": "Yes"}]}}',
    '{"recordId": "sample_%d", "SageMakerOutput": {"choices": [{"message": {"content": "Yes"}}, 5, "y"]}}',
    '{"recordId": "sample_%d", "SageMakerOutput": {"choices": [5, {"message": {"content": "Yes"}}]}, "modelOutput": {"content": [{"text": "No"}]}}',
    '{"recordId": "sample_%d", "modelOutput": "{\\"content\\": [{\\"text\\": \\"yes\\"}]} trailing"}',
    '{"recordId": "sample_%d", "modelOutput": {"content": [{"text": null}, {"type": "text", "text": "Yes"}]}}',
    '{"recordId": "sample_0", "recordId": "sample_%d", "score": NaN, "modelOutput": {"content": [{"text": "yes"}]}}',
]


def odd_output_lines(spark: SparkSession, sf_dir: str, prefix: str = RAW_PREFIX) -> DataFrame:
    """O: one line per document of model ``model-odd``, in the columns of R."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    shape = F.element_at(F.array(*[F.lit(s) for s in _ODD_SHAPES]), (F.col("doc_id") % len(_ODD_SHAPES) + 1).cast("int"))
    dataset = F.when(F.col("doc_id") % 20 < 10, F.lit("pairs-r")).otherwise(F.lit("pairs-s"))
    batch = F.floor(F.col("doc_id") / 50).cast("string")
    return docs.select(
        F.replace(shape, F.lit("%d"), F.col("doc_id").cast("string")).alias("value"),
        F.concat(F.lit(prefix.rstrip("/") + "/"), dataset, F.lit("/model-odd/batch_"), batch, F.lit("/part.jsonl.out")).alias("source_file"),
        F.lit(0).cast("bigint").alias("file_block_start"),
        F.col("doc_id").alias("line_pos"),
    )


def all_output_lines(spark: SparkSession, sf_dir: str, prefix: str = RAW_PREFIX) -> DataFrame:
    """R and O."""
    return raw_output_lines(spark, sf_dir, prefix).unionByName(odd_output_lines(spark, sf_dir, prefix))
