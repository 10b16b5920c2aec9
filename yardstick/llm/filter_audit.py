"""Filter interaction audit (operator 13): what each of five filters removes alone, in any
order and on average over all orders, per source.

The documents of a part play the removal game: the worth of a coalition of filters is the
number of documents that fail at least one of them.  Its Hart-Mas-Colell potential follows
the recursion ``|S| P(S) = v(S) + sum of P(S without i)`` from the empty coalition to the
grand one; the Shapley value of a filter is ``P(all) - P(all without it)``.  All figures
are integers: the potential is kept times 120, which every ``|S|!`` of five filters
divides.  A step of an order is the difference of two coalitions' worths, so the 120 orders
need no second look at the documents.

How it is spread: one projection turns a text into four failure bits and a digest, equal
rows collapse before the first shuffle, and everything after it is narrow.  A copy is found
by joining on (digest, doc_id) with the smallest id of the digest: the pair is hardly ever
repeated, so a text that a third of all rows share makes no hot key.  Per part at most 32
counts remain, whatever the input; the game is played on those.

Defined cases: a null text is the empty text, a null source the part ``""``; a row without
id is never a copy nor the first of copies, and has no label; repeated rows of one id count
each, none being a copy of the other; an id with several label rows is good (toxic) if one
of them says so; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import written

# The filters in their listed order; filter k is bit 2^k of a failure mask.
FILTERS = "ABCDE"
GRAND = (1 << len(FILTERS)) - 1
SCALE = 120  # orders of five filters

_WORD_GAP = r"[\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_failures(text: Column) -> Column:
    """The bits of filters A to D for a text that is not null."""
    words = F.array_remove(F.split(text, _WORD_GAP), "")
    distinct = F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, _UPPER, ""))
    failed = (
        F.size(words) < 50,
        100 * distinct.cast("long") < 65 * F.size(words).cast("long"),
        100 * capitals.cast("long") > 5 * F.length(text).cast("long"),
        text.rlike("[#$%&*|]"),
    )
    return sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(failed)), F.lit(0))


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents per part and exact set of failed filters."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("id"),
        F.when(F.col("doc_id").isNotNull(), F.unhex(F.sha2(text, 256))).alias("digest"),
        F.coalesce(F.col("source"), F.lit("")).alias("part"),
        text_failures(text).alias("mask"),
    )
    rows = written(rows.groupBy("id", "digest", "part", "mask").agg(F.count("*").alias("n")), "audit-rows")
    firsts = rows.where("id is not null").groupBy("digest").agg(F.min("id").alias("id"), F.lit(True).alias("first"))
    marks = (
        labels.where("doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("id"))
        .agg(F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
        .where("good or toxic")
    )
    known = rows.where("id is not null").join(firsts, ["id", "digest"], "left").join(marks, "id", "left")
    known = known.select("part", F.when(F.col("first"), F.col("mask")).otherwise(F.col("mask") + 16).alias("mask"), "n", "good", "toxic")
    nameless = rows.where("id is null").select("part", "mask", "n", F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    return (
        known.unionByName(nameless)
        .groupBy("part", "mask")
        .agg(F.sum("n").alias("n"), *[F.coalesce(F.sum(F.when(F.col(c), F.col("n"))), F.lit(0)).alias(c) for c in ("good", "toxic")])
    )


def worths(counts: Column) -> Column:
    """Array of the worths of all 32 coalitions: documents whose mask meets the coalition."""
    masks = F.sequence(F.lit(0), F.lit(GRAND))
    return F.transform(
        masks,
        lambda s: F.aggregate(
            counts,
            F.lit(0).cast("long"),
            lambda total, c: total + F.when(c["mask"].bitwiseAND(s) != 0, c["n"]).otherwise(F.lit(0).cast("long")),
        ),
    )


def potentials(worth: Column) -> Column:
    """Array of 120 times the potential of all 32 coalitions.  A coalition without one of
    its members has a smaller number, so the array is built up in that order."""

    def grown(known: Column, s: Column) -> Column:
        parents = sum(
            (F.when(s.bitwiseAND(1 << k) != 0, F.get(known, s - (1 << k))).otherwise(F.lit(0).cast("long")) for k in range(len(FILTERS))),
            F.lit(0).cast("long"),
        )
        total = SCALE * F.get(worth, s) + parents
        return F.array_append(known, F.call_function("div", total, F.bit_count(s).cast("long")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(GRAND)), F.array(F.lit(0).cast("long")), grown)


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, order of the filters and step: kept, removed, redundant, unique_fails,
    good_lost, toxic_lost and shapley (the removals of the step's filter, summed over all
    orders)."""
    game = failure_counts(docs, labels).groupBy("part").agg(
        F.sum("n").alias("total"),
        *[F.collect_list(F.struct("mask", F.col(c).alias("n"))).alias(c) for c in ("n", "good", "toxic")],  # at most 32 masks
    )
    game = game.select("part", "total", *[worths(F.col(c)).alias(c) for c in ("n", "good", "toxic")])
    game = game.withColumn("potential", potentials(F.col("n")))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = game.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))

    def bits(letters: Column) -> Column:
        return sum((F.when(F.contains(letters, F.lit(f)), 1 << k).otherwise(0) for k, f in enumerate(FILTERS)), F.lit(0))

    order, step = F.col("filter_order"), F.col("step")
    steps = steps.select("*", bits(F.substring(order, F.lit(1), step - 1)).alias("before"), bits(F.substring(order, step, F.lit(1))).alias("own"))
    before, own = F.col("before"), F.col("own")
    gain = lambda c: F.get(F.col(c), before + own) - F.get(F.col(c), before)
    without = lambda c: F.get(F.col(c), F.lit(GRAND)) - F.get(F.col(c), GRAND - own)
    return steps.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.get("n", before + own)).alias("kept"),
        gain("n").alias("removed"),
        (F.get("n", own) - gain("n")).alias("redundant"),
        without("n").alias("unique_fails"),
        gain("good").alias("good_lost"),
        gain("toxic").alias("toxic_lost"),
        without("potential").alias("shapley"),
    )
