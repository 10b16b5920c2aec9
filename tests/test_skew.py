"""Hot keys: one key, group of copies or stratum holding most rows.  Results are checked
against brute force in Python, and the plans reduce the hot group before the shuffle."""

from collections import defaultdict

from pyspark.sql import functions as F

from yardstick.operators import align, metrics, sampling


def _plan(df):
    df._jdf.queryExecution().toRdd().count()
    return df._jdf.queryExecution().executedPlan().toString()


def _preds(spark, n=9000):
    # a third of all rows are copies of sample 7 of (ds-hot, m-hot); most other rows are
    # in the same (dataset, model) group too
    return spark.range(0, n).select(
        F.when(F.col("id") % 9 < 7, F.lit("ds-hot")).otherwise(F.lit("ds-cold")).alias("dataset"),
        F.when(F.col("id") % 9 < 7, F.lit("m-hot")).otherwise(F.lit("m-cold")).alias("model"),
        F.when((F.col("id") % 3 == 0) & (F.col("id") % 9 < 7), F.lit(7)).otherwise(F.col("id")).cast("bigint").alias("sample_id"),
        F.when(F.col("id") % 4 == 0, F.lit("yes")).otherwise(F.lit("no")).alias("prediction"),
        F.concat(F.lit("f"), (F.col("id") % 5).cast("string")).alias("source_file"),
        F.lit(0).cast("bigint").alias("file_block_start"),
        F.col("id").alias("line_pos"),
    )


def test_last_write_wins_on_a_hot_group_of_copies(spark):
    df = _preds(spark)
    got = {(r.dataset, r.model, r.sample_id): r.prediction for r in align.last_write_wins(df).collect()}
    best = {}
    for r in df.collect():
        k = (r.dataset, r.model, r.sample_id)
        o = (r.source_file, r.file_block_start, r.line_pos)
        if k not in best or o > best[k][0]:
            best[k] = (o, r.prediction)
    assert got == {k: v for k, (o, v) in best.items()}
    plan = _plan(align.last_write_wins(df))
    assert plan.index("partial_max_by") > plan.index("Exchange")  # the partial aggregate sits below the exchange


def test_metrics_with_one_group_holding_most_rows(spark):
    preds = align.last_write_wins(_preds(spark))
    gt = spark.range(0, 9000).select(
        F.when(F.col("id") % 9 < 7, F.lit("ds-hot")).otherwise(F.lit("ds-cold")).alias("dataset"),
        F.col("id").alias("sample_id"),
        (F.col("id") % 2 == 0).alias("is_positive"),
        F.lit("").alias("rejection_reason"),
    )
    got = {(r.dataset, r.model): r for r in metrics.eval_metrics(preds, gt).collect()}
    truth = {(r.dataset, r.sample_id): r.is_positive for r in gt.collect()}
    c = defaultdict(lambda: [0, 0, 0, 0, 0])
    for r in preds.collect():
        t = truth.get((r.dataset, r.sample_id))
        k = c[(r.dataset, r.model)]
        k[4] += 1
        if t is None:
            continue
        p = r.prediction == "yes"
        k[(0 if p else 2) if t else (1 if p else 3)] += 1
    for key, (tp, fp, fn, tn, n) in c.items():
        r = got[key]
        assert (r.true_positives, r.false_positives, r.false_negatives, r.true_negatives, r.total_predictions) == (tp, fp, fn, tn, n)


def test_stratified_sample_with_a_hot_stratum(spark):
    df = spark.range(0, 20000).select(
        F.col("id").alias("sample_id"),
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise(F.concat(F.lit("c"), (F.col("id") % 4).cast("string"))).alias("category"),
    )
    s = sampling.stratified_sample(df, ["category"], 5, seed=11)
    sizes = {r.category: r.n for r in s.groupBy("category").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sizes == {"hot": 5, "c0": 5, "c1": 5, "c2": 5, "c3": 5}
    plan = _plan(s)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_last_write_wins_uses_part_by_part_path_order(spark):
    # sorted paths: "o/a/b/x" < "o/a-c/x" part by part ("a" < "a-c"), although as plain
    # strings "o/a-c/x" < "o/a/b/x" ("-" < "/"); the later file's line wins
    df = spark.createDataFrame(
        [("d", "m", 1, "no", "o/a/b/x", 0, 0), ("d", "m", 1, "yes", "o/a-c/x", 0, 0)],
        "dataset string, model string, sample_id bigint, prediction string, source_file string, file_block_start bigint, line_pos bigint",
    )
    assert [r.prediction for r in align.last_write_wins(df).collect()] == ["yes"]
    assert sorted(["o/a/b/x", "o/a-c/x"], key=lambda p: p.split("/"))[-1] == "o/a-c/x"


def _all_orders(spark):
    """Rows that differ in every part of the order, NULL parts and extreme lines included."""
    rows = []
    for k, (f, b, ln) in enumerate([("o/a/b", 0, 5), ("o/a-c", 0, 1), ("o/a-c", 128, 0), ("o/a-c", 128, 2**62), (None, None, None), ("o/a", 0, -(2**63)), ("o/a-c", None, 9)] * 3):
        rows.append(("d", "m", k % 4, "yes" if k % 3 else "no", f, b, ln, k))
    return spark.createDataFrame(rows, "dataset string, model string, sample_id bigint, prediction string, source_file string, file_block_start bigint, line_pos bigint, arrival int")


def test_packed_order_gives_the_rows_of_the_struct_order(spark):
    import itertools

    df = _all_orders(spark)
    everything = ("source_file", "file_block_start", "line_pos")
    for n in range(4):
        for order in itertools.permutations(everything, n):
            packed = align.packed_order(df, order)
            if packed is None:
                assert order[-1] != "line_pos" and "line_pos" in order
                continue
            rows = packed.select("arrival", "_ord", F.struct(F.lit(0), *[align.order_value(c) for c in order]).alias("_s"), F.col("_ord").cast("string").alias("t")).collect()
            by_pack = sorted(rows, key=lambda r: int(r.t))
            want = [r.arrival for r in packed.orderBy(F.struct(F.lit(0), *[align.order_value(c) for c in order])).select("arrival").collect()]
            ranks = {r.arrival: r.t for r in rows}
            assert [ranks[a] for a in want] == [r.t for r in by_pack]


def test_last_write_has_no_sort_around_its_aggregate(spark, sf_small):
    from yardstick.plans import evaluation, parts

    for q in (parts.q_last_write_wins, parts.q_merge_precedence):
        plan = _plan(q(spark, sf_small)).split("== Initial Plan ==")[0]
        sorts = [ln for ln in plan.splitlines() if " Sort [" in ln]  # only the small table of file splits
        assert "SortAggregate" not in plan and "HashAggregate" in plan and all("_w0" in ln for ln in sorts)
    plan = _plan(evaluation.q_eval_metrics(spark, sf_small)).split("== Initial Plan ==")[0]
    assert "SortAggregate" not in plan


def test_large_split_tables_are_ranked_by_the_index(spark, monkeypatch):
    df = _preds(spark, 3000).withColumn("source_file", F.concat(F.lit("f/"), (F.col("line_pos") % 40).cast("string")))
    want = sorted(map(tuple, align.last_write_wins(df).collect()))
    monkeypatch.setattr(align, "RANK_ROWS", 0)
    assert sorted(map(tuple, align.last_write_wins(df, answers=("no", "yes")).collect())) == want


def test_one_alignment_for_all_outputs(spark, tmp_path, monkeypatch):
    import json

    from yardstick.plans import jobs

    (tmp_path / "part-0.json").write_text("\n".join(json.dumps({"sample": i, "prediction": "yes", "batch_path": f"o/ds{i % 2}/m/x"}) for i in range(20)))
    gt = spark.range(0, 9).selectExpr("id as sample_id", "'accept' as label", "'' as rejection_reason")
    joins = []
    aligned = align.align
    monkeypatch.setattr(align, "align", lambda *a: joins.append(1) or aligned(*a))
    out = jobs.evaluate_outputs(spark, str(tmp_path), {"ds0": gt})
    assert [(r.total_evaluated, r.total_predictions, r.total_ground_truth) for r in out["metrics"].collect()] == [(5, 10, 9)]
    assert [tuple(r) for r in out["skipped"].collect()] == [("ds1", 10, 1)]
    assert [tuple(r) for r in out["gaps"].collect()] == [("ds0", "m", 5, 4, 5)]
    assert out["errors"].collect() == [] and [r["count"] for r in out["by_reason"].collect()] == [5]
    assert [r.samples for r in out["rollup"].collect()] == [5] and out["nested"].count() == 1
    assert joins == [1]
    for name in ("metrics", "by_reason", "rollup", "nested", "skipped", "gaps", "errors"):
        assert "FileScan" not in out[name]._jdf.queryExecution().executedPlan().toString()
