"""Spelling variant grouping (operator 12): words one edit apart by asymmetric q-chunks.

Words.  The runs ``[A-Za-z\\u00C0-\\u00FF]+`` of every text are found on its UTF-8 bytes
(the accented letters are exactly the pairs that start with C3), lower-cased in A-Z and
counted; one run in 31, by the CRC-32 of id and run, loses a letter.  Counts are combined
in the task and in Spark's partial aggregate before the one shuffle of words.

Near words.  Of two words one edit apart the shorter (of two equally long ones, either)
contributes two disjoint chunks, its first half and the rest; the other contributes its
positional grams of those lengths.  One edit leaves one chunk intact, in its place if the
edit comes after it and else shifted by the difference of the lengths, so grams join
within shift one.  A join leaves the *open* stretch of both words, outside the chunk, in
which the edit must be.  Where a chunk is so common that its group would make more than
``GROUP_PAIRS`` pairs, the group is not joined: the open stretch is cut into two chunks
again and the members meet on both, until groups are small or the open stretch is one
letter (then the alphabet bounds the group).  All rows of a group take the same way, as a
fixed-size bitmap of the common keys decides it.  Every pair is verified by its edit
distance, so a key collision or a bitmap's false alarm costs time only.

Forms and roots.  The near words of a word meet in one aggregate.  Occurrences grow at
least tenfold from a word to its form, so following forms ends after at most 18 steps;
roots are found by pointer doubling.

Defined cases: a null or empty text has no words; the runs of a row without id lose no
letter; repeated rows count each; runs of any length are taken whole; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import sys as _sys
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow_text import column, ragged_take, text_slices, texts_of
from .tables import BitFilter, holds, written

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

MIN_LENGTH = 7
MIN_COUNT = 2
DROP_ONE_IN = 31
FORM_RATIO = 10
GROUP_PAIRS = 256
LONG_RUN = 64  # bytes; longer runs are digested one by one


def crc_table() -> np.ndarray:
    """Remainders of the 256 bytes by the reflected polynomial of CRC-32."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


def crc32_runs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seeds: np.ndarray, table: np.ndarray) -> np.ndarray:
    """CRC-32 of ``data[start:start + length]`` appended to a text whose CRC-32 is the seed."""
    order = np.argsort(-lengths, kind="stable")
    first = int(np.searchsorted(-lengths[order], -LONG_RUN, side="left"))
    out = np.zeros(len(starts), np.uint32)
    for i in order[:first]:
        out[i] = zlib.crc32(data[starts[i] : starts[i] + lengths[i]].tobytes(), int(seeds[i]))
    order = order[first:]
    at, size, crc = starts[order], lengths[order], ~seeds[order]
    for k in range(int(size[0]) if len(size) else 0):
        live = int(np.searchsorted(-size, -k, side="left"))
        crc[:live] = table[(crc[:live] ^ data[at[:live] + k]) & np.uint32(255)] ^ (crc[:live] >> np.uint32(8))
    out[order] = ~crc
    return out


def runs_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, starts, lengths, row numbers) of the runs of MIN_LENGTH letters."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    raw = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer is not None else np.zeros(0, np.uint8)
    bounds = offsets - offsets[0]
    upper = (raw >= 65) & (raw <= 90)
    lead = raw == 0xC3
    letter = upper | ((raw >= 97) & (raw <= 122)) | lead
    letter[1:] |= lead[:-1]
    edge = np.zeros(len(raw) + 1, bool)
    edge[bounds] = True
    before = np.concatenate([[False], letter[:-1]]) if len(raw) else letter
    after = np.concatenate([letter[1:], [False]]) if len(raw) else letter
    starts = np.flatnonzero(letter & (~before | edge[:-1]))
    stops = np.flatnonzero(letter & (~after | edge[1:])) + 1
    pairs = np.concatenate([[0], np.cumsum(lead)])
    long = stops - starts - (pairs[stops] - pairs[starts]) >= MIN_LENGTH
    starts, stops = starts[long], stops[long]
    return raw + (upper * np.uint8(32)), starts, stops - starts, np.searchsorted(bounds, starts, side="right") - 1


def counted(texts: pa.Array, ids: list) -> pa.RecordBatch:
    """(word, n) of the runs of some texts after the deletions."""
    data, starts, lengths, row = runs_of(texts)
    seeds = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)
    named = np.array([i is not None for i in ids], bool)
    crc = crc32_runs(data, starts, lengths, seeds[row], crc_table())
    drop = (crc % DROP_ONE_IN == 0) & named[row]
    cut = []
    for a, size, h in zip(starts[drop], lengths[drop], crc[drop]):
        run = data[a : a + size].tobytes().decode()
        at = int(h) % len(run)
        cut.append(run[:at] + run[at + 1 :])
    starts, lengths = starts[~drop], lengths[~drop]
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    whole = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data[ragged_take(starts, lengths)]))
    cut = pa.array([w for w in cut if len(w) >= MIN_LENGTH], pa.large_string())
    found = pc.value_counts(pa.concat_arrays([whole, cut]))
    return pa.RecordBatch.from_arrays([found.field(0), found.field(1)], names=["word", "n"])


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): the distinct words of MIN_LENGTH letters and MIN_COUNT occurrences."""

    def work(batches):
        for part in text_slices(batches):
            out = counted(texts_of(part), column(part, "doc_id").to_pylist())
            for rows in text_slices([out], "word"):  # one very long word makes a batch of its own
                yield pa.RecordBatch.from_arrays([rows.column(0).cast(pa.string()), rows.column(1)], names=["word", "n"])

    found = docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(work, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def halves(members: DataFrame) -> DataFrame:
    """Each member once per chunk of its open stretch [lo, hi): the key takes the chunk up
    and the other part stays open.  ``extra`` is 1 for the longer word, whose open stretch
    has a letter more than that of the word it must meet."""
    lo, hi, extra = F.col("lo"), F.col("hi"), F.col("extra")
    open_ = hi - lo - extra
    head = F.call_function("div", open_, F.lit(2)).cast("int")
    tail = open_ - head

    def kept(which: int, start: Column, size: Column, lo: Column, hi: Column) -> Column:
        key = F.xxhash64(F.col("key"), F.lit(which), F.substring(F.col("word"), start + 1, size))
        return F.struct(key.alias("key"), lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))

    chunks = F.array(kept(0, lo, head, lo + head, hi), kept(1, hi - tail, tail, lo, hi - tail))
    return members.select("word", "n", "extra", F.explode(chunks).alias("c")).select("word", "n", "extra", "c.*")


def split_by_common(members: DataFrame, common: BitFilter) -> DataFrame:
    """The members with ``again``: whether their key is (or looks) common."""
    shared = common.shared
    schema = members.schema.simpleString()[len("struct<") : -1] + ",again:boolean"

    def work(batches):
        for batch in batches:
            hot = holds(shared.value, column(batch, "key").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hot)], names=[*batch.schema.names, "again"])

    return members.mapInArrow(work, schema)


def near_pairs(words: DataFrame, limit: int = GROUP_PAIRS) -> DataFrame:
    """(word, n, other, other_n) for all words exactly one edit apart, each pair both ways
    and possibly repeated."""
    size = F.length("word")
    roles = F.array(F.struct(size.alias("key"), F.lit(0).alias("extra")), F.struct((size - 1).alias("key"), F.lit(1).alias("extra")))
    members = words.select("word", "n", F.explode(roles).alias("r")).select(
        "word", "n", F.col("r.extra").alias("extra"), F.col("r.key").cast("long").alias("key"), F.lit(0).alias("lo"), F.length("word").alias("hi")
    )
    ready, level = [], halves(members)
    while True:
        level = written(level, "spelling-members")
        own = F.sum(1 - F.col("extra"))
        groups = level.groupBy("key").agg(own.alias("own"), F.sum("extra").alias("longer"), F.max(F.col("hi") - F.col("lo") - F.col("extra")).alias("open"))
        common = groups.where((F.col("own") * (F.col("own") - 1) / 2 + F.col("own") * F.col("longer") > limit) & (F.col("open") > 1)).select("key")
        common = written(common, "spelling-common")
        if common.isEmpty():
            ready.append(level)
            break
        tagged = split_by_common(level, BitFilter(common, "key"))
        ready.append(tagged.where("not again").drop("again"))
        level = halves(tagged.where("again").drop("again"))
    rows = ready[0]
    for more in ready[1:]:
        rows = rows.unionByName(more)
    rows = rows.select("key", "word", "n", "extra")
    a = rows.where("extra = 0").select("key", F.col("word").alias("word"), F.col("n").alias("n"))
    b = rows.select("key", F.col("word").alias("other"), F.col("n").alias("other_n"), "extra")
    pairs = a.join(b, "key").where("(extra = 1 or word < other) and levenshtein(word, other, 1) = 1")
    both = F.array(F.struct("word", "n", "other", "other_n"), F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    return pairs.select(F.explode(both).alias("p")).select("p.*")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form), by pointer doubling."""
    found = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = found.select(F.col("word").alias("at"), F.col("root").alias("ahead"))
        step = found.join(ahead, F.col("root") == F.col("at"), "left")
        step = written(step.select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")), "spelling-roots")
        found = step.select("word", "root")
        if step.where("moved").isEmpty():
            return found


def spelling_variants(docs: DataFrame, limit: int = GROUP_PAIRS) -> DataFrame:
    """Per word: n, n_near, form, form_n and root."""
    words = written(word_counts(docs), "spelling-words")
    pairs = near_pairs(words, limit).repartition("word").groupBy("word", "n", "other", "other_n").agg(F.lit(1).alias("one"))
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word")))
    near = pairs.groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    formed = -F.col("best.n") >= FORM_RATIO * F.col("n")
    near = near.select("word", "n_near", F.when(formed, F.col("best.word")).alias("form"), F.when(formed, -F.col("best.n")).alias("form_n"))
    near = written(near, "spelling-near")
    found = words.join(near, "word", "left").join(roots(near.where("form is not null")), "word", "left")
    return found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"))
