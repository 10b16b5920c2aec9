"""Raw output lines -> predictions (SRC-5, PRJ-1..8, ANS-1/2, AGG-11, AGG-15).

Replaces the reference's row-at-a-time Python UDF with native expressions: the
whole parse is one narrow projection inside whole-stage codegen, with no
``BatchEvalPython`` node and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import answers, records
from ..functions.text import col_of

ORDER_COLS = ("source_file", "file_block_start", "line_pos")


def non_blank(value: str = "value"):
    """Lines that are not empty after a Python-style strip."""
    return F.regexp_like(col_of(value), F.lit(r"(?U)[^\s\x{1c}-\x{1f}]"))


def parse_raw_lines(lines: DataFrame, mode: str = "contains", input_prefix: str | None = None, carry: list[str] = ()) -> DataFrame:
    """Parse every non-blank line.  Output keeps dropped lines with a ``drop_reason``
    (NULL for lines that yield a prediction), so accounting and filtering share one scan.

    Input columns: ``value``, ``source_file`` and optionally the line-order keys
    ``file_block_start``/``line_pos``.  Output: ``sample_id``, ``content``,
    ``prediction``, ``drop_reason``, ``source_file``, order keys, and, when an input
    prefix is given, ``batch_path``/``dataset``/``model`` derived from the file path.
    """
    keep = [*carry, *[c for c in ORDER_COLS if c in lines.columns]]
    parsed = lines.filter(non_blank("value")).select(*keep, records.parse_line("value").alias("_v"))
    v = F.col("_v")
    step = parsed.select(
        *keep,
        "_v",
        records.sample_index(records.record_id(v)).alias("sample_id"),
        records.content(v).alias("content"),
    )
    text = F.col("content")
    reason = records.drop_reason(v, F.col("sample_id"), text)
    out_cols = [
        *keep,
        F.col("sample_id"),
        text,
        F.when(reason.isNull(), answers.answer(text, mode)).alias("prediction"),
        reason.alias("drop_reason"),
    ]
    if input_prefix is not None:
        bp = records.batch_path("source_file", input_prefix)
        out_cols += [
            bp.alias("batch_path"),
            records.dataset_name(bp).alias("dataset"),
            records.model_name(bp).alias("model"),
        ]
    return pin_columns(step.select(*out_cols))


def pin_columns(df: DataFrame) -> DataFrame:
    """A 1:1 ``inline`` of a one-element array.  Catalyst pushes a filter through any
    deterministic projection by inlining the projected expressions, which would run the
    whole parse a second time inside the caller's ``drop_reason``/``prediction``
    predicate.  Predicates on generator output cannot move below a Generate, so the
    caller's filter reads the computed columns."""
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))


def extracted_predictions(lines: DataFrame, input_prefix: str) -> DataFrame:
    """The L2 extraction job's rows: (sample, prediction, batch_path, source_file),
    prediction in ``raw_tail`` mode, rows without id or prediction dropped."""
    parsed = parse_raw_lines(lines, mode="raw_tail", input_prefix=input_prefix)
    return parsed.filter(F.col("sample_id").isNotNull() & F.col("prediction").isNotNull()).select(
        F.col("sample_id").alias("sample"), "prediction", "batch_path", "source_file"
    )


def raw_predictions(lines: DataFrame, input_prefix: str, mode: str = "contains") -> DataFrame:
    """Canonical predictions table from raw lines, dataset and model taken from the path:
    (dataset, model, sample_id, prediction, source_file, file_block_start, line_pos)."""
    parsed = parse_raw_lines(lines, mode=mode, input_prefix=input_prefix)
    cols = ["dataset", "model", "sample_id", "prediction", *[c for c in ORDER_COLS if c in parsed.columns]]
    return parsed.filter(F.col("drop_reason").isNull() & F.col("prediction").isNotNull()).select(*cols)


def parts_predictions(parts: DataFrame) -> DataFrame:
    """Parts-json rows -> canonical predictions (PRJ-9, PRJ-10, PRJ-12).

    Rows with a NULL sample or a prediction other than yes/no (after lower+strip)
    are dropped, as the reference counts them as parse errors."""
    keep = [c for c in ("file_path", "file_block_start", "line_pos", "arrival") if c in parts.columns]
    pred = records.normalized_prediction("prediction")
    return parts.select(
        records.dataset_name("batch_path").alias("dataset"),
        records.model_name("batch_path").alias("model"),
        F.col("sample").cast("bigint").alias("sample_id"),
        pred.alias("prediction"),
        F.coalesce(F.col("source_file"), F.lit("")).alias("source_file"),
        *keep,
    ).filter(F.col("sample_id").isNotNull() & F.col("prediction").isNotNull())
