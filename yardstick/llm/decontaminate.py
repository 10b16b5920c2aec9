"""Benchmark decontamination (operator 1): Wu-Manber multi-pattern search over words.

Patterns are windows of ``WINDOW`` consecutive item words (a shorter item is one
pattern).  Patterns of one length m form one matcher: blocks of two words (one if m is 1)
index the shift table, an unknown block skips m - 1 positions, a block that ends a
pattern (shift 0) opens the bucket of patterns with that suffix block, a prefix block
narrows the bucket, and the words are then compared one by one.  The tables are sorted
arrays of blocks over the numbers of the items' words, behind a fixed-size bitmap of the
known blocks.

Items are searched in blocks of at most ``BLOCK_BYTES`` of item text, each broadcast on
its own, so what is broadcast has a fixed bound however many items there are; with more
than one block the hit spans are merged per document.

Defined cases: a null or empty text has no words; an item without words has no windows;
an item with a null id is ignored; rows that share an item id are one item; repeated
document rows are searched one by one; an empty table of documents gives an empty result
and an empty benchmark contaminates nothing; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import sys as _sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow_text import column, ragged_take, text_slices, texts_of

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

WINDOW = 10
BLOCK_BYTES = 16 << 20
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"  # on text whose A-Z are lower-cased
GOLD = 0x9E3779B97F4A7C15
BITS = 26  # of the filter before the shift table (8 MiB)


def blocks_of(codes: np.ndarray, b: int) -> np.ndarray:
    """The block of ``b`` words that ends at each word, as one integer (b = 2: the first has none)."""
    wide = codes.astype(np.uint64)
    return wide if b == 1 else np.concatenate([[np.uint64(0)], wide[:-1] << np.uint64(32) | wide[1:]])


class Matcher:
    """Wu-Manber tables for the windows of ``m`` words of some items, as arrays over the numbers
    of the items' words: windows that overlap share them, so the tables take about forty
    bytes a word."""

    def __init__(self, m: int, items: np.ndarray, bounds: np.ndarray, codes: np.ndarray, at: dict[str, int]):
        self.m, self.items, self.bounds, self.codes, self.at = m, items, bounds, codes, at
        self.b = b = min(2, m)
        self.skip = m - b + 1
        blocks = blocks_of(codes, b)
        ends = (np.arange(1, len(codes) + 1) - np.repeat(bounds[:-1], np.diff(bounds))).astype(np.int32)  # words of the item up to each word
        # a block that ends a window shifts by 0, one that is too near the item's start by what is missing
        real = np.flatnonzero(ends >= b).astype(np.int32)
        real = real[np.argsort(blocks[real], kind="stable")]
        keys = blocks[real]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        shifts = np.maximum(0, m - ends[real]).astype(np.uint8)
        self.keys, self.shifts = keys[first], np.minimum.reduceat(shifts, first) if len(first) else shifts
        del real, keys, shifts, first
        # windows by suffix block, then prefix block
        stops = (np.flatnonzero(ends >= m) + 1).astype(np.int32)
        order = np.lexsort((blocks[stops - m + b - 1], blocks[stops - 1]))
        self.stops = stops[order]
        del order, stops
        self.suffix, self.prefix = blocks[self.stops - 1], blocks[self.stops - m + b - 1]
        with np.errstate(over="ignore"):
            place = (self.keys * np.uint64(GOLD)) >> np.uint64(64 - BITS)
        bits = np.zeros(1 << (BITS - 3), np.uint8)
        np.bitwise_or.at(bits, (place >> np.uint64(3)).astype(np.int64), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))
        self.bits = bits.tobytes()

    def search(self, words: list[str]):
        """(start, items) of every occurrence."""
        m, b, skip, keys, bits, get = self.m, self.b, self.skip, self.keys, self.bits, self.at.get
        n, i = len(words), self.m - 1
        while i < n:
            block = get(words[i])
            if block is None:  # no window holds this word
                i += m
                continue
            if b > 1:
                before = get(words[i - 1])
                if before is None:
                    i += skip
                    continue
                block |= before << 32
            place = (block * GOLD & 0xFFFFFFFFFFFFFFFF) >> (64 - BITS)
            if not bits[place >> 3] >> (place & 7) & 1:
                i += skip
                continue
            block = np.uint64(block)
            k = int(np.searchsorted(keys, block))
            s = int(self.shifts[k]) if k < len(keys) and keys[k] == block else skip
            if s:
                i += s
                continue
            yield from self.at_suffix(words, i, block)
            i += 1

    def at_suffix(self, words: list[str], i: int, block: np.uint64):
        """The window that ends at word i of a document, if its prefix block and then its words agree."""
        start = i - self.m + 1
        here = [self.at.get(w) for w in words[start : i + 1]]
        if None in here:
            return
        head = np.uint64(here[self.b - 1] if self.b == 1 else here[0] << 32 | here[1])
        lo, hi = np.searchsorted(self.suffix, block, "left"), np.searchsorted(self.suffix, block, "right")
        lo, hi = lo + np.searchsorted(self.prefix[lo:hi], head, "left"), lo + np.searchsorted(self.prefix[lo:hi], head, "right")
        found = set()
        for stop in self.stops[lo:hi].tolist():
            item = int(self.items[np.searchsorted(self.bounds, stop - 1, side="right") - 1])
            if item not in found and self.codes[stop - self.m : stop].tolist() == here:
                found.add(item)
        if found:
            yield start, found


def matchers(items: list[tuple[int, str]], window: int = WINDOW) -> list[Matcher]:
    at: dict[str, int] = {}
    codes, sizes, word = [], [], re.compile(WORD)
    batch = pa.RecordBatch.from_arrays([pa.array([t or "" for _, t in items], pa.large_string())], names=["text"])
    for part in text_slices([batch], max_bytes=1 << 20):  # the words of a slice at a time
        for text in pc.ascii_lower(texts_of(part)).to_pylist():
            found = word.findall(text)
            codes.append(np.fromiter((at.setdefault(w, len(at)) for w in found), np.int32, len(found)))
            sizes.append(len(found))
    if not sizes:
        return []
    codes, sizes, ids = np.concatenate(codes), np.array(sizes), np.array([i for i, _ in items], np.int64)
    least, starts = np.minimum(sizes, window), np.cumsum(sizes) - sizes
    out = []
    for m in sorted(set(least.tolist()) - {0}):
        mine = np.flatnonzero(least == m)
        own = codes[ragged_take(starts[mine], sizes[mine])]
        out.append(Matcher(int(m), ids[mine], np.concatenate([[0], np.cumsum(sizes[mine])]), own, at))
    return out


def searched(tables: list[Matcher], texts: pa.Array):
    """(number of words, [(start, end, items)]) of every text."""
    word = re.compile(WORD)
    for text in pc.ascii_lower(texts).to_pylist():
        words = word.findall(text)
        yield len(words), [(start, start + t.m, found) for t in tables for start, found in t.search(words)]


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES):
    """Lists of (item_id, text) of at most ``block_bytes`` (one larger item is alone)."""
    block, size = [], 0
    for row in benchmark.selectExpr("cast(item_id as bigint) item_id", "text").where("item_id is not null").toLocalIterator():
        n = len((row["text"] or "").encode())
        if block and size + n > block_bytes:
            yield block
            block, size = [], 0
        block.append((row["item_id"], row["text"]))
        size += n
    yield block


def merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def digest(items) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


def search_block(docs: DataFrame, block, window: int) -> DataFrame:
    """Every document with its word count, hit word spans and items for one item block."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def work(batches):
        tables = matchers(shared.value, window)
        for part in text_slices(batches):
            counts, spans, found = [], [], []
            for n, hits in searched(tables, texts_of(part)):
                counts.append(n)
                spans.append([{"a": a, "b": b} for a, b in merged((a, b) for a, b, _ in hits)])
                found.append(sorted(set().union(*(who for _, _, who in hits))))
            yield pa.RecordBatch.from_arrays(
                [
                    column(part, "_row"),
                    column(part, "doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
                    pa.array(found, pa.list_(pa.int64())),
                ],
                names=["_row", "doc_id", "n_words", "spans", "items"],
            )

    return docs.mapInArrow(work, "_row string, doc_id bigint, n_words bigint, spans array<struct<a:bigint,b:bigint>>, items array<bigint>")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated, spans (merged
    hit word ranges) and items (their ids)."""
    base = docs.selectExpr("cast(doc_id as bigint) doc_id", "text")
    # each block goes into its broadcast as it is read: the driver holds two at most
    blocks = item_blocks(benchmark, block_bytes)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        hits = search_block(base.withColumn("_row", F.lit("")), first, window)
    else:
        # a row is known by its id and whole text, so equal rows share one (equal) answer
        keyed = base.withColumn("_row", F.sha2(F.coalesce("text", F.lit("")), 256))
        each = [search_block(keyed, first, window), search_block(keyed, second, window)]
        del first, second
        each += (search_block(keyed, b, window) for b in blocks)
        hits = each[0]
        for more in each[1:]:
            hits = hits.unionByName(more)
        hits = hits.groupBy("doc_id", "_row").agg(
            F.max("n_words").alias("n_words"),
            (F.count(F.lit(1)) / len(each)).cast("bigint").alias("_times"),
            F.array_sort(F.flatten(F.collect_set("spans"))).alias("_spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
        step = F.expr("""aggregate(_spans, cast(array() as array<struct<a:bigint,b:bigint>>), (acc, x) ->
            case when size(acc) > 0 and x.a <= element_at(acc, -1).b
              then concat(slice(acc, 1, size(acc) - 1), array(named_struct('a', element_at(acc, -1).a, 'b', greatest(element_at(acc, -1).b, x.b))))
              else concat(acc, array(x)) end)""")
        hits = hits.withColumn("spans", step).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times"))))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda acc, x: acc + x["b"] - x["a"])
    named = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return hits.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(named, 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        "spans",
        "items",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` without any occurrence of a window, with their columns: one map
    per item block, no shuffle."""

    def keep(shared):
        def work(batches):
            tables = matchers(shared.value, window)
            for part in text_slices(batches):
                clean = [not hits for _, hits in searched(tables, texts_of(part))]
                yield part.filter(pa.array(clean, pa.bool_()))

        return work

    for block in item_blocks(benchmark, block_bytes):
        docs = docs.mapInArrow(keep(docs.sparkSession.sparkContext.broadcast(block)), docs.schema)
    return docs
