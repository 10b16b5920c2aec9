"""Registered queries for stratified sampling, manifests, exclusion and hold-out (L4, L5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import answers, labels as L
from ..operators import align, extract, sampling
from ..session import checkpoint, scratch_path
from ..sinks import writers
from ..sources import derived, scans
from . import jobs
from .evaluation import raw_lines
from .oracle_common import G_CTE, R_CTE, ANSWERS_CTE, with_ctes

SEED = 42
N_PER_CATEGORY = 3
R_STYLE = ["pairs-r"]


def categorised(spark, sf):
    """G with the sampling columns: split (= dataset name) and category (LBL-6)."""
    g = derived.ground_truth(spark, sf)
    return g.select(
        "sample_id",
        F.col("dataset").alias("split"),
        L.sampling_category("rejection_reason", "dataset", R_STYLE).alias("category"),
        "label",
        "rejection_reason",
        "object_description",
    )


def sampled(spark, sf):
    return sampling.stratified_sample(categorised(spark, sf), ["split", "category"], N_PER_CATEGORY, SEED)


def q_stratified_sample(spark, sf):
    return sampled(spark, sf).select("split", "category", "sample_id")


def q_stratified_sample_docs(spark, sf):
    docs = derived.read_table(spark, sf, "documents").select(F.col("doc_id").alias("sample_id"), "lang", "source")
    return sampling.stratified_sample(docs, ["lang", "source"], 2, SEED).select("lang", "source", "sample_id")


def q_manifest_lists(spark, sf):
    m = sampling.manifest_lists(sampled(spark, sf))
    return m.select("split", "category", "all_categories", "n", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


def q_train_exclusion(spark, sf):
    """SNK-7 + SRC-9 + SMP-4: the sample and its manifest are written, the manifest is
    read back, and the training rows are excluded from the labelled rows."""
    s = sampled(spark, sf)
    doc = sampling.manifest_document(sampling.manifest_lists(s), seed=SEED, samples_per_category=N_PER_CATEGORY)
    path = scratch_path(spark, "finetune-sample")
    writers.write_sample(s, doc, path)
    excluded = scans.training_manifest(spark, f"{path}/train_indices")
    return sampling.exclude(categorised(spark, sf), excluded).select("split", "sample_id")


def q_holdout_split(spark, sf):
    docs = derived.read_table(spark, sf, "documents").select(F.col("doc_id").alias("sample_id"), "lang")
    return sampling.holdout_split(docs, SEED).select("sample_id", "lang", "part")


def q_finetune_sample(spark, sf):
    """SMP-2 + SET-2: the sampling job over two labelled splits given apart."""
    g = derived.ground_truth(spark, sf)
    splits = {name: g.filter(F.col("dataset") == name).drop("dataset") for name in ("pairs-r", "pairs-s")}
    out = jobs.sample_for_finetune(splits, R_STYLE, N_PER_CATEGORY, SEED)
    return out["sample"].select("split", "category", "sample_id")


def holdout_rows(spark, sf):
    """split, sample_id, predicted and ok of the rows that were not sampled: model-a's word-mode
    answer (ANS-4) against the Yes/No ground truth; ``Unknown`` counts as wrong."""
    doc = sampling.manifest_document(sampling.manifest_lists(sampled(spark, sf)))
    held = sampling.exclude(categorised(spark, sf), sampling.manifest_rows(doc))
    parsed = extract.parse_raw_lines(raw_lines(spark, sf), "contains", derived.RAW_PREFIX)
    answered = parsed.filter(F.col("drop_reason").isNull() & (F.col("model") == "model-a"))
    latest = align.last_write_wins(answered.select("dataset", "model", "sample_id", answers.word_answer("content").alias("prediction"), *extract.ORDER_COLS), answers=("Yes", "No", "Unknown"))
    preds = latest.select(F.col("dataset").alias("split"), "sample_id", F.col("prediction").alias("predicted"))
    gt = F.when(L.label_lenient("label") == "accepted", F.lit("Yes")).otherwise(F.lit("No"))
    predicted = F.coalesce(F.col("predicted"), F.lit("Unknown"))
    return held.join(preds, ["split", "sample_id"], "left").select("split", "sample_id", predicted.alias("predicted"), (predicted == gt).alias("ok"))


def q_holdout_accuracy(spark, sf):
    """AGG-16: training rows excluded, accuracy of the others."""
    return accuracy_of(holdout_rows(spark, sf))


def accuracy_of(rows):
    agg = rows.groupBy("split").agg(F.count_if("ok").alias("correct"), F.count(F.lit(1)).alias("total"))
    return agg.select(
        "split",
        F.col("correct").cast("bigint").alias("correct"),
        F.col("total").cast("bigint").alias("total"),
        F.round(F.col("correct") / F.col("total"), 6).alias("accuracy"),
    )


def q_holdout_files(spark, sf):
    """SNK-8: the hold-out summary and its per-row predictions written as files and read back."""
    rows = checkpoint(holdout_rows(spark, sf))
    path = scratch_path(spark, "holdout")
    writers.write_holdout_results(accuracy_of(rows), rows, path)
    per_row = spark.read.json(f"{path}/predictions").groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("ok").alias("n_ok"), F.count_if(F.col("predicted") == "Unknown").alias("n_unknown")
    )
    return spark.read.json(f"{path}/summary").join(per_row, "split")


QUERIES = {
    "finetune_sample": q_finetune_sample,
    "holdout_files": q_holdout_files,
    "stratified_sample": q_stratified_sample,
    "stratified_sample_docs": q_stratified_sample_docs,
    "manifest_lists": q_manifest_lists,
    "train_exclusion": q_train_exclusion,
    "holdout_split": q_holdout_split,
    "holdout_accuracy": q_holdout_accuracy,
}

_CAT = """CASE WHEN coalesce(CASE WHEN dataset = 'pairs-r' THEN rejection_reason IN ('accepted')
                               ELSE rejection_reason IN ('', 'accept') END, false)
          THEN 'accepted' ELSE rejection_reason END"""
_SAMPLED = with_ctes(G_CTE) + f""",
c AS (SELECT sample_id, dataset AS split, {_CAT} AS category, label FROM g),
sm AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY split, category
        ORDER BY md5('{SEED}:' || CAST(sample_id AS VARCHAR)), sample_id) AS rn FROM c) WHERE rn <= {N_PER_CATEGORY})
"""

ORACLE = {
    "stratified_sample": _SAMPLED + "SELECT split, category, sample_id FROM sm",
    "finetune_sample": _SAMPLED + "SELECT split, category, sample_id FROM sm",
    "stratified_sample_docs": f"""
SELECT lang, source, sample_id FROM (
  SELECT doc_id AS sample_id, lang, source, row_number() OVER (PARTITION BY lang, source
         ORDER BY md5('{SEED}:' || CAST(doc_id AS VARCHAR)), doc_id) AS rn FROM documents) WHERE rn <= 2
""",
    "manifest_lists": _SAMPLED + """
SELECT split, category, false AS all_categories, CAST(count(*) AS BIGINT) AS n, string_agg(CAST(sample_id AS VARCHAR), ',' ORDER BY sample_id) AS ids
FROM sm GROUP BY ALL
UNION ALL
SELECT split, NULL, true, CAST(count(*) AS BIGINT), string_agg(CAST(sample_id AS VARCHAR), ',' ORDER BY sample_id)
FROM sm GROUP BY ALL
""",
    "train_exclusion": _SAMPLED + "SELECT split, sample_id FROM c WHERE NOT EXISTS (SELECT 1 FROM sm WHERE sm.split = c.split AND sm.sample_id = c.sample_id)",
    "holdout_split": f"""
WITH d AS (SELECT doc_id AS sample_id, lang,
                  row_number() OVER (ORDER BY md5('{SEED}:' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS rk,
                  count(*) OVER () AS n FROM documents)
SELECT sample_id, lang,
       CASE WHEN rk < (CASE WHEN n > 2 THEN greatest(1, CAST(floor(n * 0.2) AS BIGINT)) ELSE 0 END) THEN 'eval' ELSE 'train' END AS part
FROM d
""",
    "holdout_files": _SAMPLED.rstrip() + ",\n" + R_CTE + ",\n" + ANSWERS_CTE + """,
h AS (SELECT c.split, c.sample_id, c.label FROM c
      WHERE NOT EXISTS (SELECT 1 FROM sm WHERE sm.split = c.split AND sm.sample_id = c.sample_id)),
j AS (SELECT h.split, coalesce(ans.a_word, 'Unknown') AS predicted,
             CASE WHEN lower(trim(coalesce(h.label, ''))) IN ('accepted', 'accept') THEN 'Yes' ELSE 'No' END AS gt
      FROM h LEFT JOIN ans ON ans.sample_id = h.sample_id AND ans.model = 'model-a')
SELECT split, CAST(count(*) FILTER (WHERE predicted = gt) AS BIGINT) AS correct, CAST(count(*) AS BIGINT) AS total,
       round(count(*) FILTER (WHERE predicted = gt) / count(*), 6) AS accuracy, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(*) FILTER (WHERE predicted = gt) AS BIGINT) AS n_ok, CAST(count(*) FILTER (WHERE predicted = 'Unknown') AS BIGINT) AS n_unknown
FROM j GROUP BY split
""",
    "holdout_accuracy": _SAMPLED.rstrip() + ",\n" + R_CTE + ",\n" + ANSWERS_CTE + """,
h AS (SELECT c.split, c.sample_id, c.label FROM c
      WHERE NOT EXISTS (SELECT 1 FROM sm WHERE sm.split = c.split AND sm.sample_id = c.sample_id)),
j AS (SELECT h.split, coalesce(ans.a_word, 'Unknown') =
             CASE WHEN lower(trim(coalesce(h.label, ''))) IN ('accepted', 'accept') THEN 'Yes' ELSE 'No' END AS ok
      FROM h LEFT JOIN ans ON ans.sample_id = h.sample_id AND ans.model = 'model-a')
SELECT split, CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS correct, CAST(count(*) AS BIGINT) AS total,
       round(count(*) FILTER (WHERE ok) / count(*), 6) AS accuracy
FROM j GROUP BY ALL
""",
}
