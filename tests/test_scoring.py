"""Scoring with retry (UDF-4): attempts, exhausted rows and order-free results."""

import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from yardstick.operators import scoring
from yardstick.plans.stub_scorer import StubScorer

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the scorers below run in workers


def test_retry_and_error_rows(spark):
    df = spark.range(0, 60).select(F.col("id").alias("sample_id"))
    out = scoring.with_answers(scoring.score(df, StubScorer(), ["sample_id"], max_retries=3, retry_delay=0.0, concurrency=4))
    rows = {r.sample_id: r for r in out.collect()}
    assert len(rows) == 60
    for i, r in rows.items():
        if i % 17 == 0:
            assert r.failed and r.model_predicted_label == "ERROR" and r.model_response.startswith("ERROR: ")
            assert r.model_prediction_is_generation_successfull is False
        else:
            assert not r.failed and r.attempts == i % 3 + 1
            assert r.model_prediction_is_generation_successfull == (i % 2 == 0)


def test_too_few_retries_exhaust(spark):
    df = spark.range(0, 10).select(F.col("id").alias("sample_id"))
    out = scoring.score(df, StubScorer(), ["sample_id"], max_retries=1, retry_delay=0.0)
    failed = {r.sample_id for r in out.filter("failed").collect()}
    assert failed == {i for i in range(10) if i % 3 != 0 or i % 17 == 0}


def test_drop_input_columns(spark):
    df = spark.range(0, 6).select(F.col("id").alias("sample_id"), F.lit(b"big").alias("image"))
    out = scoring.score(df, StubScorer(), ["sample_id"], retry_delay=0.0, keep_input=False)
    assert out.columns == ["sample_id", "model_response", "attempts", "failed"]


def test_seeded_head(spark):
    from yardstick.operators.batching import seeded_head

    df = spark.range(0, 500).select(F.col("id").alias("sample_id"))
    a = {r.sample_id for r in seeded_head(df, 30, seed=5).collect()}
    b = {r.sample_id for r in seeded_head(df, 30, seed=5).collect()}
    assert len(a) == 30 and a == b
    assert seeded_head(df, 1000).count() == 500


def test_seeded_head_of_repeated_and_missing_ids(spark):
    from yardstick.operators.batching import seeded_head

    df = spark.range(0, 60).selectExpr("nullif(id % 20, 7) as sample_id", "id as row")
    for n in (1, 30, 59, 60, 100):
        rows = seeded_head(df, n, seed=3).collect()
        assert sorted(r.pos for r in rows) == list(range(min(n, 60))) and len({r.row for r in rows}) == min(n, 60)


def test_holdout_is_exact_with_repeated_ids(spark):
    from yardstick.operators.sampling import holdout_split

    df = spark.range(0, 100).selectExpr("id % 3 as sample_id", "id as row")
    rows = holdout_split(df, seed=1).collect()
    assert len(rows) == 100 and sum(r.part == "eval" for r in rows) == 20
    assert all(r.part == "train" for r in holdout_split(df.limit(2)).collect())


def test_requests_overlap_and_keep_their_order(spark):
    import time

    def sleeping():
        def score(row):
            time.sleep(0.2)
            return str(row["sample_id"])

        return score

    df = spark.range(0, 60, 1, 1).select(F.col("id").alias("sample_id"))
    scoring.score(df.limit(1), sleeping, ["sample_id"]).collect()
    began = time.time()
    rows = scoring.score(df, sleeping, ["sample_id"], in_flight=12).collect()
    assert time.time() - began < 60 * 0.2 / 2
    assert [r.model_response for r in rows] == [str(i) for i in range(60)] and [r.sample_id for r in rows] == list(range(60))


def test_long_ids_keep_their_digits(spark):
    from yardstick.sinks import writers

    df = spark.createDataFrame([(7, "a"), (123456789, "b"), (8589934592, "c"), (8589934593, "d")], "sample_id bigint, model_response string")
    keys = [r.sample_key for r in writers.reasoning_table(df, "sample_id").orderBy("response").collect()]
    assert keys == ["000000007", "123456789", "8589934592", "8589934593"]


def test_chat_payload_of_a_large_image(spark):
    import json

    from yardstick.functions import payloads as P

    df = spark.range(1).select(F.expr("encode(repeat('x', 17000000), 'UTF-8')").alias("img"), F.lit("sample_1").alias("rid"))
    j = P.envelope(F.col("rid"), P.chat_payload([("SOURCE", F.col("img")), ("NONE", F.lit(None).cast("binary"))], 'say "hi"', "sys"), F.lit(True))
    body = json.loads(df.select(j).first()[0])
    assert list(body) == ["record_id", "payload", "ground_truth"] and body["ground_truth"] is True
    user = body["payload"]["messages"][1]["content"]
    assert [x["type"] for x in user] == ["text", "image_url", "text"] and len(user[1]["image_url"]["url"]) > 22_000_000
    assert user[2]["text"] == 'say "hi"' and body["payload"]["messages"][0] == {"role": "system", "content": "sys"}
    none = json.loads(df.select(P.envelope(F.lit(None).cast("string"), F.lit("{}"))).first()[0])
    assert none == {"payload": {}}


# --- durable answers -------------------------------------------------------------------


class Counting:
    """Writes down every call; from the given call on the worker process dies."""

    def __init__(self, calls, die_after=None, fail=()):
        self.calls, self.die_after, self.fail = calls, die_after, fail

    def __call__(self):
        import os

        def score(row):
            if self.die_after is not None and os.path.exists(self.calls):
                with open(self.calls) as f:
                    if len(f.readlines()) >= self.die_after:
                        os._exit(1)
            with open(self.calls, "a") as f:
                f.write(f"{row['sample_id']}\n")
            if row["sample_id"] in self.fail:
                raise RuntimeError("no")
            return f"answer {row['sample_id']}"

        return score


def _calls(path):
    from collections import Counter

    with open(path) as f:
        return Counter(int(x) for x in f)


def test_a_rerun_asks_only_for_records_without_an_answer(spark, tmp_path):
    import pytest

    calls, log = str(tmp_path / "calls"), str(tmp_path / "log")
    df = spark.range(0, 40, 1, 2).select(F.col("id").alias("sample_id"))
    with pytest.raises(Exception):
        scoring.score(df, Counting(calls, die_after=15), ["sample_id"], retry_delay=0.0, in_flight=1, answer_log=log).collect()
    before = _calls(calls)
    assert 10 < sum(before.values()) < 40
    out = scoring.score(df, Counting(calls, fail=(3,)), ["sample_id"], retry_delay=0.0, in_flight=1, answer_log=log)
    rows = {r.sample_id: r for r in out.collect()}
    answered = {i for i, r in rows.items() if r.reused}
    assert len(rows) == 40 and all(r.model_response == f"answer {i}" for i, r in rows.items() if i != 3 or r.reused)
    # a worker may die between an answer and its line; every logged answer was asked for once
    assert answered <= set(before) and len(answered) >= sum(before.values()) - 2
    assert all(n == 1 for i, n in _calls(calls).items() if i in answered)
    again = out.collect()  # another action on the same result: answers come from the log
    assert all(r.reused for r in again if r.sample_id != 3)
    assert all(n == 1 for i, n in _calls(calls).items() if i in answered)


def test_a_killed_attempt_is_resumed_by_the_next(tmp_path):
    """A session that retries tasks: the worker dies midway, the next attempt goes on."""
    import os
    import subprocess
    import sys

    calls, log = str(tmp_path / "calls"), str(tmp_path / "log")
    script = f"""
import sys
sys.path[:0] = [{os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r}, {os.path.dirname(os.path.abspath(__file__))!r}]
from pyspark.sql import SparkSession, functions as F
spark = SparkSession.builder.master("local[1,4]").config("spark.ui.enabled", "false").getOrCreate()
from test_scoring import Counting
from yardstick.operators import scoring
class DiesOnce(Counting):
    def __call__(self):
        import os
        inner = Counting(self.calls)()
        def score(row):
            if row["sample_id"] == 12 and not os.path.exists(self.calls + ".died"):
                open(self.calls + ".died", "w").close()
                os._exit(1)
            return inner(row)
        return score

df = spark.range(0, 20, 1, 1).select(F.col("id").alias("sample_id"))
out = scoring.score(df, DiesOnce({calls!r}), ["sample_id"], retry_delay=0.0, in_flight=1, answer_log={log!r}).collect()
assert sorted(r.sample_id for r in out) == list(range(20))
assert {{r.sample_id for r in out if r.reused}} == set(range(12)), out
print("resumed")
"""
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300)
    assert "resumed" in done.stdout, done.stderr[-3000:]
    assert all(n == 1 for n in _calls(calls).values()) and len(_calls(calls)) == 20


def test_broken_lines_and_repeated_records_in_the_log(spark, tmp_path):
    import os

    calls, log = str(tmp_path / "calls"), str(tmp_path / "log")
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "sample_id bigint, note string").coalesce(1)
    one = scoring.score(df, Counting(calls), ["sample_id", "note"], retry_delay=0.0, answer_log=log).collect()
    assert [r.model_response for r in one] == ["answer 1", "answer 1", "answer 2"] and _calls(calls) == {1: 1, 2: 1}
    folder = next(os.path.join(d, f) for d, _, fs in os.walk(log) for f in fs if f.endswith(".jsonl"))
    with open(folder, "a") as f:
        f.write('{"key": "x", "response": "half')
    two = scoring.score(df, Counting(calls), ["sample_id", "note"], retry_delay=0.0, answer_log=log)
    assert two.columns == ["sample_id", "note", "model_response", "attempts", "failed", "reused"]
    assert all(r.reused for r in two.collect()) and _calls(calls) == {1: 1, 2: 1}
