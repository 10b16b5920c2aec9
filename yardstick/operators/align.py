"""Deterministic dedup, re-indexing, precedence merge and alignment (WIN-1, WIN-2,
AGG-13, JON-1..5, SET-1, SET-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions import records
from ..session import checkpoint, materialised
from .common import bounded_side
from .indexing import dense_index, grouped_index

PRED_KEYS = ("dataset", "model", "sample_id")
GT_KEYS = ("dataset", "sample_id")


# Columns holding file paths.  Files are read in sorted path order, and a path sorts part
# by part (as Python's sorted Path objects do), not as one string: with "/" replaced by
# U+0001, a character below any other in a name, a plain string comparison is exactly
# that part-by-part order ("a/b" before "a-c", where the raw strings sort the other way).
PATH_COLS = ("source_file", "file_path")


def order_value(c: str) -> F.Column:
    """The order key of one column (file paths part by part, others as they are)."""
    return F.translate(F.col(c), "/", "\u0001").alias(c) if c in PATH_COLS else F.col(c)


def _order_struct(df: DataFrame, order_cols) -> F.Column:
    return F.struct(*[order_value(c) for c in order_cols if c in df.columns])


# Columns that place a row's file split; the split's rank stands for them in the packed order.
SPLIT_COLS = (*PATH_COLS, "file_block_start")
RANK_ROWS = 200_000  # a table of file splits up to this size is ranked in one task and broadcast
INTEGRAL = ("tinyint", "smallint", "int", "bigint")
FIXED_WIDTH = (*INTEGRAL, "boolean", "float", "double", "date", "timestamp")


def packed_order(df: DataFrame, order_cols, priority: str | None = None) -> DataFrame | None:
    """``df`` with ``_ord``, one decimal(38,0) that orders its rows as (priority, file, block,
    line) does, so that a hash aggregate can hold it; None if the columns do not allow it.

    The distinct (file, block) pairs are ranked in order, and ``_ord`` is the rank above
    the 64 bits of the line.  The pairs are one per file split, far fewer than rows."""
    from pyspark.sql import Window

    cols = [c for c in order_cols if c in df.columns]
    splits = [c for c in cols if c in SPLIT_COLS]
    lines = [c for c in cols if c not in SPLIT_COLS]
    kinds = dict(df.dtypes)
    if cols != splits + lines or len(lines) > 1 or any(kinds[c] not in INTEGRAL for c in lines):
        return None
    line = F.coalesce(F.col(lines[0]).cast("decimal(20,0)"), F.lit(str(-(2**63))).cast("decimal(20,0)")) if lines else F.lit(0).cast("decimal(20,0)")
    rank = F.lit(0)
    if splits:
        key = F.struct(*[order_value(c) for c in splits])
        df = materialised(df, "ordered").withColumn("_split", F.xxhash64(*splits))
        pairs = checkpoint(df.select("_split", *splits).distinct())
        if pairs.count() <= RANK_ROWS:
            ranked = F.broadcast(pairs.withColumn("_rank", F.row_number().over(Window.orderBy(key)).cast("bigint")))
        else:
            ranked = dense_index(pairs.withColumn("_key", key), ["_key"], out="_rank").drop("_key")
        # joined on the hash and confirmed on the columns, NULLs equal
        same = [F.col(f"_a.{c}").eqNullSafe(F.col(f"_b.{c}")) for c in ("_split", *splits)]
        df = df.alias("_a").join(ranked.alias("_b"), same).select("_a.*", "_b._rank").drop("_split")
        rank = F.col("_rank")
    if priority is not None:
        rank = rank + F.col(priority).cast("bigint") * F.lit(10**13)
    packed = rank.cast("decimal(15,0)") * F.lit(str(2**64)).cast("decimal(20,0)") + line
    return df.withColumn("_ord", packed.cast("decimal(38,0)")).drop("_rank")


def _coded(df: DataFrame, values, answers) -> DataFrame | None:
    """The value columns with ``prediction`` as its number in ``answers``; None if one of
    them has no fixed width."""
    kinds = dict(df.dtypes)
    if any(v != "prediction" and kinds[v] not in FIXED_WIDTH for v in values):
        return None
    if "prediction" not in values:
        return df
    return None if answers is None else df.withColumn("prediction", F.array_position(F.array(*map(F.lit, answers)), F.col("prediction")).cast("tinyint"))


def _decoded(values, answers) -> list:
    """The value columns, numbers in ``answers`` turned back into text."""
    listed = F.array(*map(F.lit, answers)) if answers else None
    return [F.get(listed, F.col(v) - 1).alias(v) if v == "prediction" and answers else F.col(v) for v in values]


def last_write_wins(
    preds: DataFrame,
    keys=PRED_KEYS,
    order_cols=("source_file", "file_block_start", "line_pos"),
    values=("prediction",),
    answers: tuple[str, ...] | None = None,
) -> DataFrame:
    """WIN-2: one row per key, the value of the last row in (file, block, line) order.

    ``max_by`` is a declarative aggregate, so copies of a hot key collapse in the
    map-side partial aggregation before the shuffle (no window sort of a whole group).
    With ``answers``, all values ``prediction`` can take, the state of the aggregate has a
    fixed width (``packed_order``) and no row is sorted; without, text values make it a
    sort-based aggregate."""
    narrow = preds.select(*keys, *values, *[c for c in order_cols if c in preds.columns and c not in values])
    coded = _coded(narrow, values, answers)
    ordered = packed_order(coded, order_cols) if coded is not None else None
    if ordered is None:
        order = _order_struct(preds, order_cols)
        picked = F.max_by(F.struct(*[F.col(v) for v in values]), order).alias("_w")
        return preds.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"_w.{v}").alias(v) for v in values])
    last = ordered.groupBy(*keys).agg(*[F.max_by(v, "_ord").alias(v) for v in values])
    return last.select(*keys, *_decoded(values, answers))


def group_id_stats(preds: DataFrame, group=("dataset", "model")) -> DataFrame:
    """AGG-13: max/min/count of ids per group and the re-index decision ``max > 2n``."""
    return preds.groupBy(*group).agg(
        F.max("sample_id").alias("max_id"),
        F.min("sample_id").alias("min_id"),
        F.count(F.lit(1)).alias("n_records"),
    ).withColumn("needs_reindex", F.col("max_id") > F.col("n_records") * 2)


def resolve_indices(preds: DataFrame, mode: str = "never", group=("dataset", "model")) -> DataFrame:
    """WIN-1: ``never`` keeps ids; ``always`` re-numbers every group 0..n-1 by
    (batch number, id, file, line); ``auto`` re-numbers only groups whose
    ``max(id) > 2 * count`` (the reference's heuristic).  Output has ``sample_id``
    replaced and the original id in ``raw_sample_id``."""
    preds = preds.withColumn("raw_sample_id", F.col("sample_id"))
    if mode == "never":
        return preds
    if mode not in ("auto", "always"):
        raise ValueError(f"unknown re-index mode {mode!r}")
    preds = materialised(preds, "reindex")  # read three times below
    if mode == "always":
        flagged = preds.withColumn("needs_reindex", F.lit(True))
    else:
        stats = bounded_side(group_id_stats(preds, group).select(*group, "needs_reindex"))
        flagged = preds.join(stats, list(group))
    keep = flagged.filter(~F.col("needs_reindex")).drop("needs_reindex")
    todo = flagged.filter(F.col("needs_reindex")).drop("needs_reindex").withColumn(
        "_batch", records.batch_number("source_file")
    )
    ties = [c for c in ("file_path", "source_file", "file_block_start", "line_pos") if c in todo.columns]
    # the reference's stable sort keeps file then line order for ties of (batch, id)
    todo = todo.select("*", *[order_value(c).alias(f"_k{i}") for i, c in enumerate(ties)])
    order = ["_batch", "raw_sample_id", *[f"_k{i}" for i in range(len(ties))]]
    renum = grouped_index(todo, order, list(group), out="_idx").withColumn("sample_id", F.col("_idx")).drop(
        "_idx", "_batch", *[f"_k{i}" for i in range(len(ties))]
    )
    return keep.unionByName(renum)


def merge_precedence(
    primary: DataFrame,
    secondary: DataFrame,
    keys=PRED_KEYS,
    values=("prediction",),
    order_cols: tuple[str, ...] = (),
    answers: tuple[str, ...] | None = None,
) -> DataFrame:
    """JON-4: primary rows win; secondary rows fill keys the primary lacks; within one
    source the last row in ``order_cols`` order wins (WIN-2).

    Dedup and precedence are one aggregation: a tagged union reduced by ``max_by`` on
    (source priority, order), with partial aggregation before the shuffle; ``answers`` as
    in ``last_write_wins``.  Inputs may already be deduplicated (``order_cols`` empty)."""
    kinds = dict(secondary.dtypes) | dict(primary.dtypes)

    def side(df: DataFrame, prio: int) -> DataFrame:
        order = [F.col(c) if c in df.columns else F.lit(None).cast(kinds[c]).alias(c) for c in order_cols if c in kinds and c not in values]
        return df.select(*keys, *values, *order, F.lit(prio).alias("_p"))

    tagged = side(primary, 1).unionByName(side(secondary, 0))
    coded = _coded(tagged, values, answers)
    ordered = packed_order(coded, order_cols, "_p") if coded is not None else None
    if ordered is not None:
        last = ordered.groupBy(*keys).agg(*[F.max_by(v, "_ord").alias(v) for v in values], F.max("_p").alias("_best"))
        return last.select(*keys, *_decoded(values, answers), (F.col("_best") == 0).alias("from_secondary"))
    order = F.struct("_p", *[order_value(c) for c in order_cols if c in tagged.columns])
    w = F.max_by(F.struct(*[F.col(v) for v in values]), order).alias("_w")
    return tagged.groupBy(*keys).agg(w, F.max("_p").alias("_best")).select(
        *keys, *[F.col(f"_w.{v}").alias(v) for v in values], (F.col("_best") == 0).alias("from_secondary")
    )


def ground_truth_table(gt: DataFrame, dataset: str | None = None) -> DataFrame:
    """Canonical ground truth (dataset, sample_id, is_positive, rejection_reason) via LBL-1/2/5."""
    ds = F.col("dataset") if dataset is None else F.lit(dataset)
    reason = L.reason_text("rejection_reason") if "rejection_reason" in gt.columns else F.lit("")
    return gt.select(
        ds.alias("dataset"),
        F.col("sample_id").cast("bigint").alias("sample_id"),
        L.label_bool(gt).alias("is_positive"),
        reason.alias("rejection_reason"),
    )


def align(preds: DataFrame, gt: DataFrame) -> DataFrame:
    """JON-1..3 in one join: every prediction with its ground truth (NULL when none).
    ``matched`` marks the inner-join rows.  Sort-merge (or AQE broadcast) on
    (dataset, sample_id); no cross product, no per-group collection."""
    g = gt.select(*GT_KEYS, "is_positive", "rejection_reason", F.lit(True).alias("matched"))
    return preds.join(g, list(GT_KEYS), "left").withColumn("matched", F.coalesce(F.col("matched"), F.lit(False)))


def outcome_counts(preds: DataFrame, gt: DataFrame) -> DataFrame:
    """The one alignment behind all evaluation outputs: predictions counted per (dataset,
    model, matched, is_positive, reason bucket, answer), with the first sample id.  A few
    rows per model, whatever the number of predictions; ``answer`` is yes, no or NULL."""
    p = F.col("prediction")
    answer = F.when(p.isin("yes", "no"), p).alias("answer")
    bucket = F.when(F.col("matched"), L.eval_bucket("is_positive", "rejection_reason")).alias("reason")
    return align(preds, gt).groupBy("dataset", "model", "matched", "is_positive", bucket, answer).agg(
        F.count(F.lit(1)).alias("n"), F.min("sample_id").alias("first_index")
    )


def truth_counts(gt: DataFrame) -> DataFrame:
    """Ground-truth rows per dataset."""
    return gt.groupBy("dataset").agg(F.count(F.lit(1)).alias("total_ground_truth"))


def coverage_gaps(preds: DataFrame, gt: DataFrame) -> DataFrame:
    """JON-2/JON-3/SET-1 counts per (dataset, model) for datasets that have ground truth.

    Keys are unique on both sides (deduped predictions, positional ground truth), so
    ``gt_without_prediction = |gt(dataset)| - matched`` and
    ``prediction_without_gt = |preds| - matched``: one left join plus two partial
    aggregates, with no fan-out of the ground truth per model."""
    return gaps_of(outcome_counts(preds, gt), truth_counts(gt))


def gaps_of(outcomes: DataFrame, truths: DataFrame) -> DataFrame:
    """``coverage_gaps`` from counts that are there already."""
    per_model = outcomes.groupBy("dataset", "model").agg(
        F.sum("n").alias("_np"), F.coalesce(F.sum(F.when(F.col("matched"), F.col("n"))), F.lit(0)).alias("_m")
    )
    return per_model.join(truths, "dataset").select(
        "dataset",
        "model",
        F.col("_m").cast("bigint").alias("matched"),
        (F.col("total_ground_truth") - F.col("_m")).cast("bigint").alias("gt_without_prediction"),
        (F.col("_np") - F.col("_m")).cast("bigint").alias("prediction_without_gt"),
    )


def flat_merge(preds: DataFrame, order_cols=("source_file", "line_pos"), key: str = "sample_id") -> DataFrame:
    """SET-3 (legacy flat mode): predictions of all datasets merged on the id alone; a
    dataset seen later (by its first row in file/line order) overwrites earlier ones,
    and within a dataset the last row wins.  The dataset ranking is a tiny aggregate
    (one row per dataset), broadcast behind its size check; the merge is one partial
    ``max_by`` over (dataset rank, file, line)."""
    from pyspark.sql import Window

    first = preds.groupBy("dataset").agg(F.min(F.struct(*[order_value(c) for c in order_cols])).alias("_first"))
    ranked = bounded_side(first.select("dataset", F.row_number().over(Window.orderBy("_first")).alias("_rank")))
    j = preds.join(ranked, "dataset")
    w = F.max_by(F.struct("prediction", "dataset"), F.struct("_rank", *[order_value(c) for c in order_cols])).alias("_w")
    return j.groupBy(key).agg(w).select(key, "_w.prediction", "_w.dataset")


def overlap_errors(preds: DataFrame, gt: DataFrame) -> DataFrame:
    """JON-1: (dataset, model, error) for every group whose dataset has ground truth but
    none of whose predictions matches it; its metrics of zero mean nothing."""
    return errors_of(coverage_gaps(preds, gt))


def errors_of(gaps: DataFrame) -> DataFrame:
    """``overlap_errors`` from the coverage gaps."""
    none = gaps.filter(F.col("matched") == 0)
    return none.select("dataset", "model", F.lit("no prediction has a ground-truth row").alias("error"))


def without_truth(outcomes: DataFrame, truths: DataFrame) -> DataFrame:
    """JON-5/AGG-8: predictions and models of the datasets that have no ground truth."""
    return outcomes.join(truths, "dataset", "left_anti").groupBy("dataset").agg(
        F.sum("n").cast("bigint").alias("n_predictions"), F.count_distinct("model").cast("bigint").alias("n_models")
    )
