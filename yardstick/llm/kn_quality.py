"""Quality classifier (operator 7): interpolated modified Kneser-Ney n-gram perplexity.

With ``whole``, as the queries use it, every labelled good row counts: three fourths of them, by
their ids, train the model, the other fourth and all bad rows set the thresholds.  That model grows
with the input, so it stays in shards and the scoring is a join of n-gram keys (``kn_spread``).
What follows is the form without it, for a model that fits into every worker.

Training.  The trusted text is a bounded sample of the labelled good rows: per language
in the order of a hash of their id, together at most ``MAX_TRAIN_DOCS`` rows and
``MAX_TRAIN_CHARS`` code points of whole texts; a text that does not fit is passed over.
Its n-grams are counted with sharded (hash-partitioned) aggregates; lower
orders use continuation counts, three discounts per order come from the counts of counts,
and joins on the context give every n-gram its discounted share and every context its
back-off weight.

Scoring.  The model's size is bounded by the sample, so it is broadcast, and every batch
of documents is joined to it by hashed n-gram keys: no document is shuffled.

Threshold.  All labelled rows outside the training sample are scored.  The mean of few
tokens varies more, so the threshold of a document of n tokens is 10^(q + spread / sqrt(n)):
for every spread of ``SPREADS``, q is the ``QUANTILE`` of the good rows' log10 perplexity less
spread / sqrt(n), and the spread that rejects most rows labelled bad or toxic is taken.  That
is done per language; a language with fewer than ``MIN_HELD_OUT`` good rows uses the limit
over all.  A document above its threshold is rejected.

Defined cases: a null or empty text has one token (the end) and is scored like any
other; a null language uses the overall threshold; without labels or trusted rows nothing
is rejected and perplexity is null; trusted rows of which none can be trained on or held out
are an error; a row repeated is scored each time; duplicate labels
of an id count once and the lowest quality holds; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import sys as _sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrow_text import column, split_words, text_slices, texts_of, word_codes
from .minhash import mix
from .tables import BitFilter, discard, holds, made_tables, shuffles_cleaned, small_batches, written

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

ORDER = 3
MAX_TRAIN_DOCS = 8000
MAX_TRAIN_CHARS = 4_000_000
QUANTILE = 0.995
SPREADS = (0, 0.25, 0.5, 0.75, 1, 1.5, 2, 3)
SPREAD = 1.5  # standard deviation of a token's log10 probability, about: taken if spreads reject the same
MIN_HELD_OUT = 30
STEPS = 4096  # of a quantile, per power of ten of the perplexity
SLICE = 512 << 10
START, END = np.uint64(1), np.uint64(2)
GOLD = np.uint64(0x9E3779B97F4A7C15)


def chain(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Key of the n-gram (context, word)."""
    with np.errstate(over="ignore"):
        return mix(context * GOLD + word)


def token_grid(texts: pa.Array, order: int):
    """(doc number, grid) with one row per token of all texts: its ``order`` - 1
    predecessors and the token itself as 64-bit word hashes, ends included."""
    import xxhash

    bounds, words = split_words(pc.ascii_lower(texts))
    codes, distinct = word_codes(words)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))
    sizes = np.diff(bounds)
    n_docs, pad = len(sizes), order - 1
    flat = np.full(int(sizes.sum()) + n_docs * (pad + 1), START, np.uint64)
    starts = np.cumsum(sizes + pad + 1) - (sizes + pad + 1)  # of each document with its padding
    doc_of_word = np.repeat(np.arange(n_docs), sizes)
    at = np.arange(len(doc_of_word)) - (bounds[:-1] - bounds[0])[doc_of_word] + starts[doc_of_word] + pad
    flat[at] = hashes[codes]
    ends = starts + pad + sizes
    flat[ends] = END
    here = np.sort(np.concatenate([at, ends]))
    docs = np.repeat(np.arange(n_docs), sizes + 1)
    return docs, np.stack([flat[here - pad + j] for j in range(order)])


def gram_keys(grid: np.ndarray):
    """Per order n = 1..ORDER: (n-gram key, context key) arrays; the context of a unigram is 0."""
    order = len(grid)
    out = []
    for n in range(1, order + 1):
        context = np.zeros(grid.shape[1], np.uint64)
        for j in range(order - n, order - 1):
            context = chain(context, grid[j])
        out.append((chain(context, grid[order - 1]), context))
    return out


def marks_of(labels: DataFrame) -> DataFrame:
    """doc_id and good (of quality 1 and not toxic) of every labelled id."""
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    marks = marks.agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    return marks.select("doc_id", F.expr("coalesce(q = 1 and coalesce(t, 0) = 0, false)").alias("good"))


def trusted_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).join(marks_of(labels).where("good"), "doc_id")


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, lang and held (out) of the training sample.  No row of it is held out:
    thresholds come from all other trusted rows (``held_scores``)."""
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", lang.cast("string").alias("lang"))
    picked = picked_rows(rows, marks_of(labels).where("good"))
    # at most MAX_TRAIN_DOCS ids
    return written(rows.join(F.broadcast(picked), "doc_id", "left_semi").withColumn("held", F.lit(False)), "kn-sample")


def picked_rows(rows: DataFrame, good: DataFrame) -> DataFrame:
    """doc_id of the training sample.  Every language has its own room: the smaller ones as
    much as they have, the others equal shares of what is left.  A fourth of the ids is
    never trained on, so every language keeps rows for its threshold."""
    least = MAX_TRAIN_CHARS / MAX_TRAIN_DOCS  # a row takes that much room at least, which bounds their number
    size = F.greatest(F.length(F.coalesce("text", F.lit(""))), F.lit(least).cast("bigint"))
    # narrow rows: the size of an id is that of all rows that have it
    lengths = rows.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), size.alias("n")).join(good, "doc_id")
    lengths = lengths.groupBy("doc_id").agg(F.sum("n").cast("bigint").alias("n"), F.min("part").alias("part"))
    lengths = lengths.where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) != 0).where(F.col("n") <= MAX_TRAIN_CHARS)
    lengths = written(lengths.withColumn("_h", F.xxhash64("doc_id")), "kn-lengths")
    totals = lengths.groupBy("part").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("rows"))
    # one row per language here
    order = Window.orderBy("all", "part")
    before, left = F.sum("all").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("all"), F.count(F.lit(1)).over(Window.partitionBy()) - F.row_number().over(order) + 1
    level = F.max((F.lit(MAX_TRAIN_CHARS) - F.col("_before")) / F.col("_left")).over(Window.partitionBy())
    rooms = totals.withColumn("_before", before).withColumn("_left", left).withColumn("room", F.least(F.col("all"), F.floor(level)).cast("bigint"))
    # the first ids in hash order, four times as many as have room, so a part's candidates are bounded
    share = F.greatest(4 * F.col("room") / F.col("all"), 64 / F.col("rows"))
    few = lengths.join(rooms.select("part", "room", share.alias("_share")), "part")
    few = few.where(F.shiftrightunsigned("_h", 1) <= F.col("_share") * float(1 << 63))
    return written(fitting(few.withColumn("_h", F.shiftrightunsigned("_h", 1)), "part"), "kn-picked")


def fitting(lengths: DataFrame, part: str) -> DataFrame:
    """doc_id of the rows that fit into the ``room`` of their part, taken in hash order; a
    row that does not fit is passed over.  Parts hold narrow rows of bounded number."""

    def work(table):
        left = table.column("room")[0].as_py() if table.num_rows else 0
        ordered = table.sort_by([("_h", "ascending"), ("doc_id", "ascending")])
        taken = []
        for doc, n in zip(ordered.column("doc_id").to_pylist(), ordered.column("n").to_pylist()):
            if n <= left:
                taken.append(doc)
                left -= n
        return pa.table({"doc_id": pa.array(taken, pa.int64())})

    return lengths.select(part, "doc_id", "_h", "n", "room").groupBy(part).applyInArrow(work, "doc_id bigint")


def train(texts: DataFrame):
    """The model as {"grams": [(keys, shares)], "contexts": [(keys, back-offs)], "base": 1 / (V + 1)}."""

    def work(batches):
        for part in text_slices(batches):
            _, grid = token_grid(texts_of(part), ORDER)
            keys = gram_keys(grid)
            arrays = [pa.array(x.view(np.int64)) for g, c in keys for x in (g, c)]
            yield pa.RecordBatch.from_arrays(arrays, names=[f"{x}{n}" for n in range(1, ORDER + 1) for x in "gc"])

    columns = [f"{x}{n}" for n in range(1, ORDER + 1) for x in "gc"]
    counts = texts.select("text").mapInArrow(work, ", ".join(f"{c} bigint" for c in columns))
    top = written(counts.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")), "kn-counts")
    grams, contexts, base = {}, {}, 1.0
    for order in range(ORDER, 0, -1):
        g, c = f"g{order}", f"c{order}"
        table = top.select(F.col(g).alias("g"), F.col(c).alias("c"), "n")
        of = {r["k"]: r["m"] for r in table.groupBy(F.least("n", F.lit(4)).alias("k")).agg(F.count(F.lit(1)).alias("m")).collect()}  # four rows
        n1, n2, n3, n4 = (max(1, of.get(k, 0)) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        discounts = [min(k - 0.05, max(0.05, k - (k + 1) * y * b / a)) for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
        cut = F.when(F.col("n") == 1, discounts[0]).when(F.col("n") == 2, discounts[1]).otherwise(discounts[2])
        table = table.withColumn("d", cut)
        sums = table.groupBy("c").agg(F.sum("n").alias("total"), F.sum("d").alias("mass"))
        shares = table.join(sums, "c").select("g", ((F.col("n") - F.col("d")) / F.col("total")).alias("x"))
        # at most one row per token of the bounded sample
        for store, rows in ((grams, shares), (contexts, sums.select("c", (F.col("mass") / F.col("total")).alias("x")))):
            found = rows.toArrow()
            keys = found.column(0).to_numpy().view(np.uint64)
            order_of = np.argsort(keys)
            store[order] = (keys[order_of], found.column(1).to_numpy()[order_of])
        if order == 1:
            base = 1.0 / (len(grams[1][0]) + 1)
        else:  # continuation counts: in how many distinct longer n-grams
            rest = columns[: 2 * (order - 1)]
            top = written(top.groupBy(*rest).agg(F.count(F.lit(1)).alias("n")), "kn-counts")
    return {"grams": grams, "contexts": contexts, "base": base}


def look_up(table, keys: np.ndarray, missing: float) -> np.ndarray:
    known, values = table
    if not len(known):
        return np.full(len(keys), missing)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, values[at], missing)


def log_probabilities(model, grid: np.ndarray) -> np.ndarray:
    """log10 probability of every token of a grid."""
    p = np.full(grid.shape[1], model["base"])
    known = None
    for n, (gram, context) in enumerate(gram_keys(grid), 1):
        if known is None:
            weight, known = look_up(model["contexts"][n], context[:1], 1.0) if len(context) else np.ones(0), np.ones(len(context), bool)
            p = look_up(model["grams"][n], gram, 0.0) + weight * p
            continue
        # a context that was never met hands the lower order's probability on, and so do all longer ones
        rows = np.flatnonzero(known)
        weight = look_up(model["contexts"][n], context[rows], np.nan)
        met = ~np.isnan(weight)
        rows, weight = rows[met], weight[met]
        p[rows] = look_up(model["grams"][n], gram[rows], 0.0) + weight * p[rows]
        known[:] = False
        known[rows] = True
    return np.log10(p)


def scored_texts(model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, the end included; log10 probability) of every text."""
    which, grid = token_grid(texts, ORDER)
    n = len(texts)
    return np.bincount(which, minlength=n), np.bincount(which, log_probabilities(model, grid), n)


def scores(docs: DataFrame, model, only: BitFilter | None = None) -> DataFrame:
    """doc_id, lang, n_tokens (the end included) and log10 probability of every document;
    with ``only`` of the documents whose ids may be in the filter."""
    ids = only.shared if only else None
    shared = docs.sparkSession.sparkContext.broadcast(model)
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")

    def work(batches):
        if ids is not None:
            batches = (b.filter(pa.array(holds(ids.value, column(b, "doc_id").to_numpy(zero_copy_only=False)))) for b in batches)
        for part in text_slices(batches, max_bytes=SLICE):
            counts, logs = scored_texts(shared.value, texts_of(part))
            arrays = [column(part, "doc_id"), column(part, "lang"), pa.array(counts), pa.array(logs)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "lang", "n_tokens", "log10_prob"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), lang.cast("string").alias("lang"), "text")
    return rows.mapInArrow(work, "doc_id bigint, lang string, n_tokens bigint, log10_prob double")


def score_of(docs: DataFrame, model):
    """Text column -> struct<n_tokens, log10_prob>.  Only the texts reach Python; the rows
    they belong to stay in Spark."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<n_tokens: bigint, log10_prob: double>")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in text_slices((pa.RecordBatch.from_arrays([b], names=["text"]) for b in batches), max_bytes=SLICE):
            counts, logs = scored_texts(shared.value, texts_of(part))
            yield pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(logs)], names=["n_tokens", "log10_prob"])

    return scored.asNondeterministic()  # evaluated once, below the filter on its result


def perplexity():
    return F.expr("pow(10.0D, -log10_prob / n_tokens)")


def held_scores(docs: DataFrame, marks: DataFrame, texts: DataFrame, model) -> DataFrame:
    """doc_id, lang, n_tokens, log10_prob and the marks of every marked row outside the
    training sample; only these narrow rows are shuffled."""
    apart = written(marks.join(F.broadcast(texts.select("doc_id").distinct()), "doc_id", "left_anti"), "kn-apart")
    found = scores(docs.where("doc_id is not null"), model, only=BitFilter(apart, "doc_id"))
    return written(found.join(apart, "doc_id"), "kn-held")


def limits_of(held: DataFrame, by: list[str]) -> DataFrame:
    """Per group: _spread and _q, the quantile of the good rows' log10 perplexity less
    _spread / sqrt(tokens), of the spread that rejects most of the group's bad rows; _n good
    rows.  Rows are counted per step of the logarithm, so a group is a bounded number of rows."""
    spread = F.explode(F.array(*[F.lit(float(x)) for x in SPREADS])).alias("_spread")
    rows = held.select(*by, "good", (-F.col("log10_prob") / F.col("n_tokens")).alias("_x"), "n_tokens", spread)
    step = F.floor((F.col("_x") - F.col("_spread") / F.sqrt("n_tokens")) * STEPS)
    cells = rows.groupBy(*by, "_spread", step.alias("_step")).agg(F.count_if("good").alias("_good"), F.count_if(~F.col("good")).alias("_bad"))
    group = Window.partitionBy(*by, "_spread")
    run = group.orderBy("_step").rowsBetween(Window.unboundedPreceding, 0)
    cells = cells.withColumn("_run", F.sum("_good").over(run)).withColumn("_n", F.sum("_good").over(group))
    need = F.ceil(F.col("_n") * QUANTILE - 1e-9)
    above = F.when(F.col("_run") - F.col("_good") >= need, F.col("_bad")).otherwise(0)  # the cells past the quantile's own
    each = cells.where("_n > 0").groupBy(*by, "_spread").agg(
        F.max("_n").alias("_n"), F.sum(above).alias("_rejected"), ((F.min(F.when(F.col("_run") >= need, F.col("_step"))) + 1) / STEPS).alias("_q")
    )
    order = F.struct("_rejected", -F.abs(F.col("_spread") - SPREAD))
    best = each.groupBy(*by).agg(F.max_by(F.struct("_spread", "_q", "_n"), order).alias("_best"))
    return best.select(*by, "_best.*")


def fit(docs: DataFrame, labels: DataFrame):
    """(model, limits per language, limit over all) or None without trusted rows."""
    with made_tables() as made:
        fitted = fitted_on(docs, labels)
    discard(*[t for t in made if fitted is None or t is not fitted[1]])
    return fitted


def fitted_on(docs: DataFrame, labels: DataFrame):
    texts = sample(docs, labels)
    every = None
    if not texts.isEmpty():
        model = train(texts)
        held = held_scores(docs, marks_of(labels), texts, model)
        every = limits_of(held, []).first()
    if every is None:
        if trusted_rows(docs, labels).isEmpty():
            return None
        raise ValueError("trusted rows exist, but none is left to train on or to set thresholds with: label more rows or shorter ones")
    by_lang = limits_of(held.where("lang is not null"), ["lang"]).where(F.col("_n") >= MIN_HELD_OUT)
    return model, written(by_lang.select(F.col("lang").alias("_lang"), "_q", "_spread"), "kn-limits"), every


def judge(rows: DataFrame, limits: DataFrame, every) -> DataFrame:
    """Adds perplexity, threshold and kept to rows with lang, n_tokens and log10_prob."""
    # limits has a row per language of MIN_HELD_OUT held-out rows or more
    judged = rows.join(F.broadcast(limits), F.col("lang") == F.col("_lang"), "left")
    quantile, spread = (F.coalesce(F.col(c), F.lit(every[c])) for c in ("_q", "_spread"))
    threshold = F.pow(F.lit(10.0), quantile + spread / F.sqrt("n_tokens"))
    judged = judged.withColumn("perplexity", perplexity()).withColumn("threshold", threshold)
    return judged.withColumn("kept", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)))


def in_training(good):
    """Whether an id trains the whole model: a good one outside the fourth held out."""
    return good & (F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) != 0)


def row_key():
    """What the verdict of a row depends on, its id included, as a long."""
    return F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text"), F.col("lang"))


def whole_fit(docs: DataFrame, labels: DataFrame):
    """(scores of all rows, limits per language, limit over all) by the model of all trusted
    rows in training, or None without trusted rows.  ``docs`` has doc_id, text and lang."""
    with shuffles_cleaned(docs.sparkSession), small_batches(docs.sparkSession):
        return whole_fit_on(docs, labels)


def whole_fit_on(docs: DataFrame, labels: DataFrame):
    from .kn_spread import Spread, spread_scores

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", row_key().alias("row"), "text")
    marks = written(marks_of(labels), "kn-marks")
    ids = marks.where(in_training(F.col("good"))).select("doc_id")
    maybe = BitFilter(ids, "doc_id")
    texts = rows.where("doc_id is not null").where(maybe.may_hold(F.col("doc_id"))).join(ids, "doc_id", "left_semi")
    size = docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    model, every = Spread(texts, size), None
    if model.first["kinds"]:
        found = spread_scores(rows, model)
        held = written(found.join(marks.where(~in_training(F.col("good"))), "doc_id"), "kn-held")
        every = limits_of(held, []).first()
    model.done()
    if every is None:
        if trusted_rows(docs, labels).isEmpty():
            return None
        raise ValueError("trusted rows exist, but none is left to train on or to set thresholds with: label more rows")
    by_lang = limits_of(held.where("lang is not null"), ["lang"]).where(F.col("_n") >= MIN_HELD_OUT)
    return found, written(by_lang.select(F.col("lang").alias("_lang"), "_q", "_spread"), "kn-limits"), every


def with_lang(docs: DataFrame):
    return (F.col("lang") if "lang" in docs.columns else F.lit(None)).cast("string").alias("lang")


def classify(docs: DataFrame, labels: DataFrame, whole: bool = False) -> DataFrame:
    """doc_id, lang, n_tokens, perplexity, threshold, kept."""
    fitted = whole_fit(docs.select("doc_id", "text", with_lang(docs)), labels) if whole else fit(docs, labels)
    if fitted is None:
        none = F.lit(None).cast("double")
        lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
        words = F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), ""))
        return docs.select("doc_id", lang.alias("lang"), (words + 1).cast("bigint").alias("n_tokens"), none.alias("perplexity"), none.alias("threshold"), F.lit(True).alias("kept"))
    model, limits, every = fitted
    found = model if whole else scores(docs, model)
    return judge(found, limits, every).select("doc_id", "lang", "n_tokens", "perplexity", "threshold", "kept")


def keep_good_whole(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``keep_good`` by the model of all trusted rows; only rejected rows, and those a bit
    filter takes for such, are shuffled."""
    fitted = whole_fit(docs.select("doc_id", "text", with_lang(docs)), labels)
    if fitted is None:
        return docs
    bad = judge(*fitted).where("not kept").select(F.col("row").alias("key")).distinct()
    bad = written(bad, "kn-rejected")
    maybe = BitFilter(bad, "key")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")  # so that no name clashes
    keyed = docs.select(row, "doc_id", "text", with_lang(docs)).select("row", row_key().alias("key"))
    clear, doubted = keyed.where(~maybe.may_hold(F.col("key"))), keyed.where(maybe.may_hold(F.col("key")))
    return clear.unionByName(doubted.join(bad, "key", "left_anti").select("row", "key")).select("row.*")


def keep_good(docs: DataFrame, labels: DataFrame, whole: bool = False) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with their columns; without ``whole``
    no row is shuffled."""
    if whole:
        return keep_good_whole(docs, labels)
    fitted = fit(docs, labels)
    if fitted is None:
        return docs
    model, limits, every = fitted
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")  # so that no name clashes
    scored = docs.select(row, lang.cast("string").alias("lang"), score_of(docs, model)("text").alias("_s"))
    return judge(scored.select("row", "lang", "_s.*"), limits, every).where("kept").select("row.*")
