"""Distributed scoring with a user-supplied scorer (UDF-3..7, JON-9, SRT-3).

The reference scores samples from a thread or process pool and retries failures.
Here the scorer runs inside ``mapInPandas``: Spark tasks are the workers, the
number of partitions bounds concurrency, Arrow batches carry the rows, and the
scorer is created once per task (a lazily created client).  Input columns pass
through untouched, so the result stays joined to its input row without a shuffle
(JON-9).  Answer extraction on the response is a native expression afterwards.

A scorer factory is a picklable zero-argument callable returning
``score(row: dict) -> str``; raising means "retry".
"""

from __future__ import annotations

import sys as _sys
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, as_completed

import pandas as pd
from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import answers
from .answer_log import TaskLog, logged, record_key
from .common import bounded_side

# Code from this module runs inside Python workers; pickle it by value so the
# workers need not have this package on their path (no --py-files needed).
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

IN_FLIGHT = 12  # requests going at once per task
ROWS_AT_ONCE = 256  # rows whose responses a task holds at once

KEY, KNOWN, KNOWN_ATTEMPTS = "_record_key", "_known_response", "_known_attempts"
LOG_ROWS = 100_000  # answers of earlier jobs are broadcast up to this number

RESULT_FIELDS = [
    T.StructField("model_response", T.StringType()),
    T.StructField("attempts", T.IntegerType()),
    T.StructField("failed", T.BooleanType()),
]


def _score_partition(factory: Callable, input_cols: list[str], max_retries: int, retry_delay: float, in_flight: int, log: tuple[str, str] | None = None):
    def run(batches):
        score = factory()  # once per task: the lazily created client of the reference
        task, known = None, {}
        if log:
            from pyspark import TaskContext

            ctx = TaskContext.get()
            task = TaskLog(*log, ctx.partitionId(), ctx.taskAttemptId())
            known = task.answers()

        def tried(record):
            """(response, attempts, failed) of one row; a raise means another try."""
            error = None
            for k in range(max_retries):
                if k:
                    time.sleep(retry_delay * k)
                try:
                    return str(score(record)), k + 1, False
                except Exception as exc:
                    error = exc
            return f"ERROR: {error}", max_retries, True

        def asked(key, record):
            """The result of one row; an answer is in the log before its thread goes on."""
            result = tried(record)
            if task and not result[2]:
                task.add(key, result[0], result[1])
            return result

        def answered(part):
            """The results of some rows in their order."""
            records = part[input_cols].to_dict("records")
            keys = part[KEY].tolist() if log else list(range(len(part)))
            waiting, done = {}, {}
            for k, (key, record) in enumerate(zip(keys, records)):
                earlier = part[KNOWN].iloc[k] if log else None
                if earlier is not None:
                    done[key] = (earlier, int(part[KNOWN_ATTEMPTS].iloc[k]), False, True)
                elif key in known:
                    done[key] = (*known[key], False, True)
                elif key not in done and key not in waiting.values():
                    waiting[pool.submit(asked, key, record)] = key
            for future in as_completed(waiting):
                key, result = waiting[future], future.result()
                if task and not result[2]:
                    known[key] = result[:2]
                done[key] = (*result, False)
            return [done[key] for key in keys]

        try:
            with ThreadPoolExecutor(in_flight) as pool:
                for pdf in batches:
                    for start in range(0, len(pdf), ROWS_AT_ONCE):
                        part = pdf.iloc[start : start + ROWS_AT_ONCE].copy()
                        done = answered(part)
                        fields = [("model_response", "object"), ("attempts", "int32"), ("failed", "bool"), *([("reused", "bool")] if log else [])]
                        for k, (name, kind) in enumerate(fields):
                            part[name] = pd.Series([d[k] for d in done], index=part.index, dtype=kind)
                        yield part.drop(columns=[KEY, KNOWN, KNOWN_ATTEMPTS]) if log else part
        finally:
            if task:
                task.close()

    return run


def score(
    df: DataFrame,
    scorer_factory: Callable,
    input_cols: list[str],
    max_retries: int = 3,
    retry_delay: float = 2.0,
    concurrency: int | None = None,
    keep_input: bool = True,
    in_flight: int = IN_FLIGHT,
    answer_log: str | None = None,
    key_cols: list[str] | None = None,
) -> DataFrame:
    """UDF-3/UDF-4: every row scored, with up to ``max_retries`` attempts and a linear
    backoff ``retry_delay * attempt`` (none after the last); an exhausted row gets
    ``model_response = 'ERROR: ...'`` and ``failed = true``.  ``concurrency`` repartitions
    to bound the number of scorers running at once; each task keeps up to ``in_flight``
    requests (back-off included) going and returns rows in input order, so the scorer must
    allow calls from several threads; ``keep_input=False`` drops the input
    columns other than ``input_cols`` before scoring (the reference's ``remove_columns``),
    so wide columns such as images never cross into Python needlessly.

    With ``answer_log``, a folder on shared storage, every answer is logged when the model
    gives it and a record (its ``key_cols``, by default the input columns) that has one is
    not sent again: by a retried task, by another action on the result, or by a later job
    with the same log.  ``reused`` tells these rows.  Answers of earlier jobs are joined by
    key, broadcast only behind a check of their number."""
    if not keep_input:
        df = df.select(*input_cols)
    log = None
    fields = list(RESULT_FIELDS)
    columns = df.schema.fields
    if answer_log:
        log = (answer_log, uuid.uuid4().hex)
        fields.append(T.StructField("reused", T.BooleanType()))
        df = df.withColumn(KEY, record_key(key_cols or input_cols))
        earlier = logged(df.sparkSession, answer_log)
        if earlier is None:
            df = df.withColumn(KNOWN, F.lit(None).cast("string")).withColumn(KNOWN_ATTEMPTS, F.lit(None).cast("int"))
        else:
            earlier = bounded_side(earlier.select(F.col("key").alias(KEY), F.col("response").alias(KNOWN), F.col("attempts").alias(KNOWN_ATTEMPTS)), LOG_ROWS)
            df = df.join(earlier, KEY, "left")
    if concurrency:
        df = df.repartition(concurrency)
    schema = T.StructType(columns + fields)
    return df.mapInPandas(_score_partition(scorer_factory, input_cols, max_retries, retry_delay, in_flight, log), schema)


def with_answers(scored: DataFrame, mode: str = "first_tag") -> DataFrame:
    """UDF-5/UDF-7: predicted label and success per backend.

    ``first_tag``: label = ANS-3 answer, success iff it is ``yes``.
    ``json_label``: label = a valid recommendation (ANS-5), success iff ``acceptable``.
    Failed rows get label ``ERROR`` and success false."""
    resp = F.col("model_response")
    if mode == "first_tag":
        label = F.trim(answers.first_tag_answer(resp))
        success = answers.first_tag_success(resp)
    elif mode == "json_label":
        fields = answers.json_label_fields(resp)
        label, success = fields["label"], fields["success"]
    else:
        raise ValueError(f"unknown scoring mode {mode!r}")
    failed = F.col("failed")
    return scored.withColumn("model_predicted_label", F.when(failed, F.lit("ERROR")).otherwise(label)).withColumn(
        "model_prediction_is_generation_successfull", F.when(failed, F.lit(False)).otherwise(success)
    )
