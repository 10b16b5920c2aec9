"""Incremental extraction of raw output lines with Structured Streaming.

The parse is the same stateless projection as the batch job (``operators.extract``),
so a ``readStream`` over the output folder with ``Trigger.AvailableNow`` processes
exactly the files not yet seen and records progress in its checkpoint: a rerun
after a failure or with new files picks up only what is new.  No state store is
needed because nothing is aggregated across micro-batches.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.extract import extracted_predictions


def stream_extract(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    checkpoint_dir: str,
    input_prefix: str,
    glob: str = "*.jsonl.out",
    max_files_per_trigger: int | None = None,
):
    """Run the extraction over every new file of ``input_dir`` and append parts-json rows
    to ``output_dir``; returns the finished query handle."""
    reader = spark.readStream.format("text").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(input_dir).select(
        "value",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("file_block_start"),
    )
    rows = extracted_predictions(lines, input_prefix)
    q = (
        rows.writeStream.format("json")
        .option("path", output_dir)
        .option("checkpointLocation", checkpoint_dir)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return q
