"""Job-level entry points on small files written into pytest's temporary folder."""

import json
import os

import pytest

from pyspark.sql import functions as F

from yardstick.plans.stub_scorer import StubScorer
from yardstick.plans import jobs


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_evaluate_outputs(spark, tmp_path):
    d = str(tmp_path / "outputs")
    parts = [json.dumps({"sample": i, "prediction": p, "batch_path": "o/ds1/mA/x", "source_file": "s3://b/p/o/ds1/mA/batch_0/f"})
             for i, p in [(0, "yes"), (1, "no"), (2, "Yes "), (3, "maybe")]]
    parts.append(json.dumps({"sample": 1, "prediction": "yes", "batch_path": "o/ds1/mA/x", "source_file": "s3://b/p/o/ds1/mA/batch_0/f"}))
    _write(f"{d}/part-00000.json", parts)
    _write(f"{d}/metrics.json", [json.dumps({"sample": 9, "prediction": "yes", "batch_path": "o/ds1/mA/x"})])
    raw = [json.dumps({"recordId": f"sample_{i}", "modelOutput": {"content": [{"type": "text", "text": t}]}})
           for i, t in [(0, "<reasoning>r</reasoning>No"), (5, "<reasoning>r</reasoning>yes")]]
    _write(f"{d}/x.jsonl.out", raw)
    gt = spark.createDataFrame([(0, "accept", ""), (1, "reject", "Wrong Orientation"), (2, "reject", None), (5, "accepted", "")],
                               "sample_id bigint, label string, rejection_reason string")
    out = jobs.evaluate_outputs(spark, d, {"ds1": gt, "outputs": gt})
    m = {(r.dataset, r.model): r for r in out["metrics"].collect()}
    a = m[("ds1", "mA")]
    # ids 0 yes (gt +), 1 yes (last line wins; gt -), 2 yes (gt -); 3 dropped; metrics.json ignored
    assert (a.true_positives, a.false_positives, a.total_predictions) == (1, 2, 3)
    b = m[("outputs", "unknown")]
    assert (b.true_negatives, b.false_negatives, b.true_positives) == (0, 1, 1)
    reasons = {(r.dataset, r.reason): r["count"] for r in out["by_reason"].collect()}
    assert reasons[("ds1", "rejected (no reason)")] == 1 and reasons[("ds1", "Wrong Orientation")] == 1


def test_extract_job(spark, tmp_path):
    d = str(tmp_path / "in" / "folder")
    _write(f"{d}/ds/m/batch_0/a.jsonl.out", [json.dumps({"recordId": "sample_3", "modelOutput": {"content": [{"type": "text", "text": "<reasoning>r</reasoning> Yes"}]}}), "{bad"])
    res = jobs.extract_job(spark, d, str(tmp_path / "parts"))
    rows = res["rows"].collect()
    assert [(r.sample, r.prediction) for r in rows] == [(3, "yes")]
    assert rows[0].batch_path.startswith("folder/ds/m/batch_0/")
    assert spark.read.json(str(tmp_path / "parts")).count() == 1
    assert res["parse_counts"]["lines"] == 2 and res["parse_counts"]["malformed"] == 1


def test_prepare_batches_and_score(spark, tmp_path):
    df = spark.range(0, 25).select(F.col("id").alias("sample_id"), F.encode(F.col("id").cast("string"), "UTF-8").alias("a"),
                                   F.encode(F.lit("b"), "UTF-8").alias("b"), (F.col("id") % 2 == 0).alias("is_generation_successful"))
    b = jobs.prepare_batches(df, [("source_image_main", "a"), ("generated_image", "b")], "Same?", "meta.llama", batch_size=10,
                             seed=7, output_path=str(tmp_path / "batches"))
    assert sorted(r[0] for r in b.groupBy("batch_idx").count().select("count").collect()) == [5, 10, 10]
    assert spark.read.text(str(tmp_path / "batches")).count() == 25
    visible = sorted(n for n in os.listdir(tmp_path / "batches") if not n.startswith("."))  # no checksum files
    assert visible == ["_SUCCESS", "batch_0.jsonl", "batch_1.jsonl", "batch_2.jsonl"]
    res = jobs.score_dataset(df, StubScorer(), ["sample_id"], retry_delay=0.0)
    m = res["metrics"].first()
    assert m.true_positives + m.false_positives + m.false_negatives + m.true_negatives == m.total_samples == 25
    assert m.false_positives == 0 and m.positive_samples + m.negative_samples == 25
    assert res["elapsed_s"] > 0 and res["rows_per_s"] > 0


@pytest.mark.parametrize("model", ["claude", "nova", "meta", "mistral", "other"])
def test_records_without_a_payload_are_reported_not_written(spark, tmp_path, model):
    df = spark.range(0, 6).selectExpr("id as sample_id", "encode('a', 'UTF-8') as a", "if(id % 3 = 0, null, encode('b', 'UTF-8')) as b")
    out = jobs.prepare_batches(df, [("source", "a"), ("generated", "b")], "Same?", model, batch_size=10, output_path=str(tmp_path / "b"))
    rows = {r.sample_id: (r.jsonl is None, r.error) for r in out.collect()}
    if model == "other":
        assert set(rows.values()) == {(True, "no payload builder for family unknown")}
    else:
        assert rows == {i: (True, "no image in generated") if i % 3 == 0 else (False, None) for i in range(6)}
        assert spark.read.text(str(tmp_path / "b")).count() == 4


def test_sample_and_holdout_sinks(spark, tmp_path):
    from yardstick.sinks import writers

    r = spark.createDataFrame([(i, "accept" if i % 2 else "reject", "accepted" if i % 2 else "Wrong Orientation") for i in range(20)],
                              "sample_id bigint, label string, rejection_reason string")
    s = spark.createDataFrame([(i, "accept" if i % 3 else "reject", "" if i % 3 else "wrong_orientation") for i in range(15)],
                              "sample_id bigint, label string, rejection_reason string")
    res = jobs.sample_for_finetune({"r": r, "s": s}, ["r"], n_per_category=2, seed=1)
    assert res["sample"].count() == 8
    p = str(tmp_path / "sample")
    writers.write_sample(res["sample"], res["manifest_doc"], p)
    back = spark.read.json(f"{p}/train_indices")
    assert sorted(len(x.all_indices) for x in back.collect()) == [4, 4]
    assert {(x.seed, x.samples_per_category) for x in back.collect()} == {(1, 2)}
    summary = spark.createDataFrame([(3, 4)], "correct bigint, total bigint").withColumn("accuracy", F.col("correct") / F.col("total"))
    writers.write_holdout_results(summary, res["sample"], str(tmp_path / "holdout"), elapsed_s=1.234)
    assert spark.read.json(str(tmp_path / "holdout" / "summary")).first().elapsed_s == 1.2


def test_summary_lines_take_the_online_record(spark):
    from yardstick.operators import metrics
    from yardstick.sinks import writers

    df = spark.createDataFrame([(True, True), (True, False), (False, False), (False, True), (True, True)], "t boolean, p boolean")
    m = metrics.online_metrics(df, "t", "p")
    text = writers.summary_lines(m.withColumn("model", F.lit("m1")), ["model"]).first().value
    assert "Precision: 0.6667" in text and "Recall:    0.6667" in text and "TP: 2, TN: 1" in text


def test_save_online_results(spark, tmp_path):
    df = spark.range(0, 12).select(F.col("id").alias("sample_id"), (F.col("id") % 2 == 0).alias("is_generation_successful"))
    res = jobs.score_dataset(df, StubScorer(), ["sample_id"], retry_delay=0.0)
    out = jobs.save_online_results(res["scored"], res["metrics"], str(tmp_path / "results"), "org/model-x", "first_tag",
                                   "pairs", timestamp="20260101_000000")
    assert out.endswith("/org_model-x_20260101_000000")
    meta = spark.read.json(f"{out}/metrics").first()
    assert (meta.model_name, meta.evaluator_type, meta.dataset_name) == ("org/model-x", "first_tag", "pairs")
    assert meta.metrics.total_samples == 12
    assert spark.read.json(f"{out}/predictions").count() == 12
    assert spark.read.parquet(f"{out}/reasoning").count() == 12
    assert "Accuracy:" in spark.read.text(f"{out}/summary", wholetext=True).first().value


def test_scoring_calls_the_model_once_per_row(spark, tmp_path):
    # the scorer appends one line per call to a file; every output of the run reads the
    # materialised rows, so there are exactly as many calls as rows
    calls = tmp_path / "calls.txt"

    class CountingScorer:
        def __call__(self, row):
            with open(calls, "a") as f:
                f.write(f"{row['sample_id']}\n")
            return "<reasoning>r</reasoning> Yes"

    df = spark.range(0, 20).select(F.col("id").alias("sample_id"), F.lit(True).alias("is_generation_successful"))
    res = jobs.score_dataset(df, lambda: CountingScorer(), ["sample_id"], retry_delay=0.0)
    jobs.save_online_results(res["scored"], res["metrics"], str(tmp_path / "out"), "m", "first_tag", timestamp="t")
    res["metrics"].collect()
    assert sorted(int(x) for x in calls.read_text().split()) == list(range(20))
