"""Invariants of the evaluation, sampling and batching operators."""

from pyspark.sql import functions as F

import __spark_entry__ as entry

Q = entry.queries()


def test_confusion_adds_up(spark, sf_mid):
    for r in Q["eval_metrics"](spark, sf_mid).collect():
        assert r.true_positives + r.false_positives + r.false_negatives + r.true_negatives == r.total_evaluated
        assert r.gt_positive_count + r.gt_negative_count == r.total_evaluated
        assert r.pred_yes_count + r.pred_no_count == r.total_predictions


def test_reason_counts_sum_to_matched_and_recall_is_accuracy(spark, sf_mid):
    m = {(r.dataset, r.model): r.total_evaluated for r in Q["eval_metrics"](spark, sf_mid).collect()}
    by = Q["eval_metrics_by_reason"](spark, sf_mid).collect()
    sums = {}
    for r in by:
        sums[(r.dataset, r.model)] = sums.get((r.dataset, r.model), 0) + r["count"]
        assert abs(r.recall - r.accuracy) < 1e-9
    assert sums == m


def test_golden_confusion_counts(spark, sf_mid):
    got = {(r.dataset, r.model): (r.true_positives, r.false_positives, r.false_negatives, r.true_negatives)
           for r in Q["eval_metrics"](spark, sf_mid).collect()}
    assert got == {
        ("pairs-r", "model-a"): (55, 26, 40, 14),
        ("pairs-r", "model-b"): (55, 23, 41, 12),
        ("pairs-s", "model-a"): (52, 23, 52, 13),
        ("pairs-s", "model-b"): (69, 13, 48, 14),
    }


def test_sample_size_and_exclusion(spark, sf_mid):
    from yardstick.plans import sampling as S

    cats = S.categorised(spark, sf_mid)
    sizes = {(r.split, r.category): r.n for r in cats.groupBy("split", "category").agg(F.count(F.lit(1)).alias("n")).collect()}
    got = Q["stratified_sample"](spark, sf_mid)
    assert got.count() == sum(min(S.N_PER_CATEGORY, n) for n in sizes.values())
    held = Q["train_exclusion"](spark, sf_mid)
    assert held.join(got, ["split", "sample_id"]).count() == 0
    assert held.count() + got.count() == cats.count()


def test_holdout_exact_share(spark, sf_mid):
    h = Q["holdout_split"](spark, sf_mid)
    n = h.count()
    assert h.filter("part = 'eval'").count() == max(1, int(n * 0.2))


def test_batches_cover_every_id_once(spark, sf_mid):
    b = Q["slice_batches"](spark, sf_mid)
    n = b.count()
    assert b.select("sample_id").distinct().count() == n
    assert b.select("pos").distinct().count() == n
    assert b.agg(F.min("pos"), F.max("pos")).first() == (0, n - 1)
    sizes = [r[1] for r in b.groupBy("batch_idx").count().orderBy("batch_idx").collect()]
    assert all(s == 100 for s in sizes[:-1]) and 0 < sizes[-1] <= 100


def test_determinism_across_partitions(spark, sf_mid):
    keys = ["reindex_auto", "slice_batches", "stratified_sample", "last_write_wins", "eval_subset", "chat_flatten", "holdout_split"]
    before = {k: sorted(map(repr, map(tuple, Q[k](spark, sf_mid).collect()))) for k in keys}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        after = {k: sorted(map(repr, map(tuple, Q[k](spark, sf_mid).collect()))) for k in keys}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert before == after
