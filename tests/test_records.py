"""Record parsing (PRJ-1..13) on hand-made lines, including the tolerant cases."""

import json

from pyspark.sql import functions as F

from yardstick.functions import records as R
from yardstick.operators import extract

PREFIX = "s3://bucket/proj/outputs/"


def _lines(spark, values, src="s3://bucket/proj/outputs/ds/m1/batch_3/part.jsonl.out"):
    return spark.createDataFrame([(v, src, 0, i) for i, v in enumerate(values)],
                                 "value string, source_file string, file_block_start bigint, line_pos bigint")


def test_parse_shapes_and_drops(spark):
    vals = [
        json.dumps({"payload": {"record_id": "sample_7"}, "SageMakerOutput": {"choices": [{"message": {"content": "yes"}}]}}),
        json.dumps({"recordId": "sample_8", "modelOutput": json.dumps({"content": [{"type": "image"}, {"text": "<reasoning>r</reasoning>No"}]})}),
        json.dumps({"payload": "not-a-dict", "recordId": "x-sample_9-y", "modelOutput": {"content": [{"type": "text", "text": "Yes"}]}}),
        json.dumps({"recordId": "", "record_id": "sample_10", "modelOutput": {"content": "not a list"}}),
        json.dumps({"recordId": "sample_11", "error": {"code": 1}}),
        json.dumps({"recordId": "sample_12", "error": ""}),
        '{"recordId": "sample_',
        "   ",
        json.dumps({"recordId": "sample_99999999999999999999"}),
    ]
    rows = extract.parse_raw_lines(_lines(spark, vals), "contains", PREFIX).orderBy("line_pos").collect()
    assert len(rows) == 8  # the blank line is skipped, not counted
    by = {r.line_pos: r for r in rows}
    assert (by[0].sample_id, by[0].prediction) == (7, "yes")
    assert (by[1].sample_id, by[1].prediction) == (8, "no")
    assert (by[2].sample_id, by[2].content) == (9, "Yes")
    assert by[3].sample_id == 10 and by[3].drop_reason == "no_content"
    assert by[4].drop_reason == "error_record"
    assert by[5].drop_reason == "no_content"  # falsy error: not an error record
    assert by[6].drop_reason == "malformed"
    assert by[8].drop_reason == "record_id_out_of_range"  # id overflows BIGINT
    assert {r.dataset for r in rows} == {"ds"} and {r.model for r in rows} == {"m1"}


def test_lines_of_any_size_duplicate_keys_and_nan(spark):
    answer = '"modelOutput": {"content": [{"text": "yes"}]}'
    vals = [
        '{"modelInput": {"image": "' + "A" * 22_000_000 + '"}, "recordId": "sample_1", ' + answer + "}",
        '{"recordId": "sample_5", "recordId": "sample_2", ' + answer + "}",
        '{"recordId": "sample_3", "score": NaN, ' + answer + "}",
        "[1, 2]",
        '"text"',
        "{} trailing",
    ]
    rows = extract.parse_raw_lines(_lines(spark, vals), "contains", PREFIX).orderBy("line_pos").select("sample_id", "prediction", "drop_reason").collect()
    assert [tuple(r) for r in rows[:3]] == [(1, "yes", None), (2, "yes", None), (3, "yes", None)]
    assert all(r.drop_reason in ("malformed", "no_record_id") for r in rows[3:])


def test_truth_of_error_fields(spark):
    errors = ['"0"', '"false"', '"[]"', '{"a": 1}', "[0]", "1", "true", '""', "0", "0.0", "-0", "false", "null", "{}", "[]"]
    vals = ['{"recordId": "sample_1", "error": ' + e + "}" for e in errors]
    rows = extract.parse_raw_lines(_lines(spark, vals), "contains", PREFIX).orderBy("line_pos").collect()
    assert [r.drop_reason for r in rows] == ["error_record"] * 7 + ["no_content"] * 8


def test_batch_path_fallbacks(spark):
    df = spark.createDataFrame(
        [("s3://bucket/proj/outputs/ds/m/batch_1/f.jsonl.out",), ("s3://other/x/outputs/ds/m/f",), ("s3://b/p/q/r",), ("local/file",)],
        "f string",
    )
    got = [r[0] for r in df.select(R.batch_path("f", PREFIX)).collect()]
    assert got == ["outputs/ds/m/batch_1/f.jsonl.out", "outputs/ds/m/f", "outputs/q/r", "outputs/local/file"]


def test_path_fields(spark):
    df = spark.createDataFrame([("a/b/c",), ("a",), ("",), (None,)], "p string")
    got = df.select(R.dataset_name("p"), R.model_name("p"), R.batch_number(F.lit("x/batch_12/batch_3"))).collect()
    assert [tuple(r) for r in got] == [("b", "c", 12), ("unknown", "unknown", 12), ("unknown", "unknown", 12), ("unknown", "unknown", 12)]


def test_normalized_prediction(spark):
    df = spark.createDataFrame([(" Yes\n",), ("NO",), ("maybe",), (None,)], "p string")
    assert [r[0] for r in df.select(R.normalized_prediction("p")).collect()] == ["yes", "no", None, None]


def test_trainer_log_series(spark):
    from yardstick.operators.reports import TRAINER_LOG_METRICS, log_series

    log = spark.createDataFrame(
        [(1, 0.1, 2.5, None, 1e-4), (2, 0.2, None, 2.1, 9e-5), (3, 0.3, 2.0, None, None)],
        "step bigint, epoch double, loss double, eval_loss double, learning_rate double",
    )
    got = sorted(map(tuple, log_series(log, TRAINER_LOG_METRICS).select("metric", "step", "value").collect()))
    assert got == [("eval_loss", 2, 2.1), ("learning_rate", 1, 1e-4), ("learning_rate", 2, 9e-5),
                   ("train_loss", 1, 2.5), ("train_loss", 3, 2.0)]


def test_one_strict_value_per_line(spark):
    good = '{"recordId": "sample_1", "modelOutput": {"content": [{"text": "yes"}]}}'
    bad = [
        good.replace('"', "'"), good + " trailing", good + good, "[" + good + "]", "[" + good + ",", good + ",", good + "]", good + "}",
        good[:-1], "5", '"text"', "null", "[]", good + "," + good, "{" + good + "}", good.replace('"yes"', "yes"), good.replace("}]}}", "},]}}"),
    ]
    rows = extract.parse_raw_lines(_lines(spark, [good, " \t" + good + "\r", *bad]), "contains", PREFIX).orderBy("line_pos").collect()
    assert [r.prediction for r in rows[:2]] == ["yes", "yes"]
    assert {(r.drop_reason, r.prediction) for r in rows[2:]} == {("malformed", None)}


def test_odd_elements_do_not_spoil_their_neighbours(spark):
    lines = [
        '{"recordId": "sample_1", "modelOutput": {"content": ["x", 1, null, [2], {"type": "image"}, {"type": "text", "text": "yes"}]}}',
        '{"recordId": "sample_2", "SageMakerOutput": {"choices": [{"message": {"content": "yes"}}, 5, null, "z"]}}',
        '{"recordId": "sample_3", "SageMakerOutput": {"choices": ["z", {"message": {"content": "yes"}}]}, "modelOutput": {"content": [{"text": "no"}]}}',
        '{"recordId": "sample_4", "SageMakerOutput": {"choices": 5}, "modelOutput": "{\\"content\\": [7, {\\"text\\": \\"yes\\"}]}"}',
        '{"recordId": "sample_5", "modelOutput": "{\\"content\\": [{\\"text\\": \\"Yes\\"}]} x"}',
        '{"recordId": "sample_6", "modelOutput": "{\'content\': [{\'text\': \'Yes\'}]}"}',
        '{"recordId": "sample_7", "modelOutput": {"content": [{"text": null}, {"text": "Yes"}]}}',
        '{"recordId": "sample_8", "modelOutput": 5}',
        '{"recordId": "sample_9", "modelOutput": {"content": {"text": "Yes"}}}',
    ]
    rows = extract.parse_raw_lines(_lines(spark, lines), "contains", PREFIX).orderBy("line_pos").collect()
    assert [(r.sample_id, r.prediction) for r in rows] == [(1, "yes"), (2, "yes"), (3, "no"), (4, "yes"), *[(k, None) for k in (5, 6, 7, 8, 9)]]
    assert {r.drop_reason for r in rows[4:]} == {"no_content"}


def test_parts_lines_are_read_strictly(spark, tmp_path):
    from yardstick.sources import scans

    good = '{"sample": 3, "prediction": "yes", "batch_path": "a/b/c"}'
    lines = [good, "", good.replace('"', "'"), good + " x", good + good, "[" + good + "]", "7", '{"sample": "12", "prediction": 1}', '{"sample": -2.9}', '{"sample": "x"}']
    (tmp_path / "part-0.json").write_text("\n".join(lines))
    rows = scans.parts_json(spark, str(tmp_path)).orderBy("line_pos").collect()
    assert [(r["sample"], r.prediction, r.malformed) for r in rows] == [(3, "yes", False), *[(None, None, True)] * 5, (12, "1", False), (-2, None, False), (None, None, False)]
