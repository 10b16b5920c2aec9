"""Training-example formatting over DataFrames (CHT-1..7, JON-7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import chat as C
from ..functions import labels as L

# The engine's own default wording; callers pass their own templates.
ACCEPTED_TEMPLATE = "Source shows {desc}. The generated image matches it on every rule.\nAll rules satisfied."
REJECTED_TEMPLATE = "Source shows {desc}. The generated image was rejected as '{reason}'.\n- {rule}\nSo the answer is No."


def rules_table(spark: SparkSession, rules: dict[str, str]) -> DataFrame:
    """The reason -> rule-text lookup as a small inline table (its size is the dict's).
    Being literals over a one-row range, its size statistics are tiny and exact, so
    Catalyst broadcasts it without a hint."""
    rows = [F.struct(F.lit(k).alias("reason"), F.lit(v).alias("rule_text")) for k, v in rules.items()]
    return spark.range(1).select(F.inline(F.array(*rows)))


def format_examples(
    df: DataFrame,
    rules: DataFrame,
    prompt: str,
    image_a: str,
    image_b: str,
    accepted_template: str = ACCEPTED_TEMPLATE,
    rejected_template: str = REJECTED_TEMPLATE,
    strict: bool = True,
) -> DataFrame:
    """CHT-2: every row -> ``answer``, ``reasoning``, ``assistant`` text and ``messages``.

    The rules lookup (JON-7) is a left join against a caller-supplied table.  No hint:
    a table built from a Python dict (``rules_table``) is a local relation of known exact
    size, which Catalyst broadcasts by its statistics; a large caller table stays a
    shuffle join.  ``strict`` raises on an unknown label (LBL-3), otherwise such rows
    get NULLs."""
    answer = L.label_answer("label") if strict else L.label_answer_or_null("label")
    r = rules.select(F.col("reason").alias("_rule_reason"), "rule_text")
    j = df.join(r, F.col("rejection_reason") == F.col("_rule_reason"), "left").drop("_rule_reason")
    reasoning = F.when(
        answer == F.lit("Yes"), C.accepted_reasoning("object_description", accepted_template)
    ).otherwise(C.rejected_reasoning("object_description", "rejection_reason", "rule_text", rejected_template))
    out = j.withColumn("answer", answer).withColumn("reasoning", reasoning).drop("rule_text")
    out = out.withColumn("assistant", C.assistant_text(F.col("reasoning"), F.col("answer")))
    return out.withColumn("messages", C.example_messages(F.col(image_a), F.col(image_b), prompt, F.col("assistant")))


def turn_items(conv: DataFrame) -> DataFrame:
    """Flat content items of conversation turns (conv_id, turn, item_pos, type, text, image):
    every third turn carries an image item (the bytes of its text)."""
    item_text = F.struct(F.lit("text").alias("type"), F.col("text").alias("text"), F.lit(None).cast("binary").alias("image"))
    item_img = F.struct(F.lit("image").alias("type"), F.lit(None).cast("string").alias("text"), F.encode("text", "UTF-8").alias("image"))
    content = F.when(F.col("turn") % 3 == 2, F.array(item_text, item_img)).otherwise(F.array(item_text))
    return conv.select("conv_id", "turn", F.posexplode(content).alias("item_pos", "item")).select(
        "conv_id", "turn", "item_pos", "item.*"
    )


def conversation_images(conv: DataFrame) -> DataFrame:
    """CHT-6 over flat turns: the images of each conversation in (turn, item) order with
    their position.  The per-conversation position comes from the hot-key split index:
    ordinary conversations are numbered by a window, and a very long one is spread over
    many tasks, so none is gathered into one task or one row."""
    from .indexing import grouped_index

    imgs = turn_items(conv).filter(F.col("type") == "image").select("conv_id", "turn", "item_pos", "image")
    return grouped_index(imgs, ["turn", "item_pos"], ["conv_id"], out="pos")


def columns_to_lists(df: DataFrame, batch_col: str, cols: list[str], order_cols: list[str] = ()) -> DataFrame:
    """CHT-7 (rows -> columns of lists) per batch, rows in the order of ``order_cols`` (the
    position of the input row, where its order counts), else of their values; batches are
    bounded by the batch size."""
    z = F.sort_array(F.collect_list(F.struct(*[F.col(c).alias(f"_order{k}") for k, c in enumerate(order_cols)], *cols)))
    g = df.groupBy(batch_col).agg(z.alias("_rows"))
    return g.select(batch_col, *[F.transform("_rows", _field(c)).alias(c) for c in cols])


def _field(name: str):
    return lambda r: r[name]


def lists_to_rows(df: DataFrame, batch_col: str, cols: list[str]) -> DataFrame:
    """CHT-7 (columns of lists -> rows): ``arrays_zip`` + ``explode``, one pass, no shuffle."""
    z = F.explode(F.arrays_zip(*[F.col(c) for c in cols])).alias("_r")
    return df.select(batch_col, z).select(batch_col, *[F.col(f"_r.{c}").alias(c) for c in cols])
