"""Substring dedup (operator 6) by unit hashing.

A text is cut into words (white space separates, ASCII letters count lower-cased) and these
into units: a unit ends at a line break and after a word that ends in sentence punctuation;
a sentence of more than ``SENTENCE`` words is cut after each of its anchor words (one word in
eight, by its hash), so that passages without marks have units too.  Units are digested to
128 bits and grouped globally.  The occurrence in the document of the smallest id, there
the first one, is kept; every other one is a repeat.  Consecutive repeats of a document
form a run.  The first and last unit of a run of ``SEED_WORDS`` words are the first and last
*whole* units of a repeated passage; it is extended by the words, up to ``CONTEXT`` on
either side, that agree with the words around the kept occurrence, and runs that meet are
one.  Runs of ``MIN_WORDS`` words, and whole lines of ``LINE_WORDS``, are reported with their
code-point offsets in the original text, and ``remove_runs`` takes them out.  Shorter
repeats (stock phrases, headings) are no copied passages and stay.

The grouping aggregates partially, so a unit that a third of all documents hold is one
row per task.  A fixed-size bit filter of the repeated digests keeps all other units out
of the second shuffle.  Units are narrow rows; words are fetched for the edges of runs only.

Defined cases: a null or empty text has no units; rows that differ in id or text are
different documents, of which those with the smaller id rank first, of one id those with
the smaller text hash; rows equal in both are one document; a row without id takes no
part; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import sys as _sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrow_text import column, split_words, text_slices, texts_of, word_codes
from .tables import BitFilter, discard, holds, written

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

MIN_WORDS = 25
LINE_WORDS = 20
SEED_WORDS = 10
SENTENCE = 20
ANCHORS = 8
CONTEXT = 20
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LINE_END = "\x01\x02"  # a token that stands for a line break
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))  # odd


class Units:
    """The words and units of some texts as arrays."""

    def __init__(self, texts: pa.Array):
        import xxhash

        marked = pc.replace_substring(pc.ascii_lower(texts), "\n", f" {LINE_END} ")
        bounds, tokens = split_words(marked)
        codes, distinct = word_codes(tokens)
        distinct = distinct.to_pylist()
        is_end = np.array([w == LINE_END for w in distinct], bool)[codes] if len(codes) else np.zeros(0, bool)
        word = ~is_end
        before = np.concatenate([[0], np.cumsum(word)])
        self.bounds = before[bounds]  # of the words of each text
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in distinct], np.uint64)
        stops = np.array([w[-1] in ".!?" for w in distinct], bool)
        codes = codes[word]
        n = len(codes)
        self.hashes = hashes[codes] if n else np.zeros(0, np.uint64)
        self.text_of = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        # line and sentence ends: after the last word before a line break or the text's end
        self.line_end = np.zeros(n + 1, bool)
        self.line_end[before[:-1][is_end]] = True
        self.line_end[self.bounds] = True
        self.line_end = self.line_end[1:]
        ends = self.line_end | (stops[codes] if n else np.zeros(0, bool))
        sentence = np.concatenate([[0], np.cumsum(ends)[:-1]]) if n else np.zeros(0, np.int64)
        long = np.bincount(sentence, minlength=1)[sentence] > SENTENCE
        cut = ends | (long & (self.hashes % np.uint64(ANCHORS) == 0))
        self.stops = np.flatnonzero(cut) + 1  # of the units, in words
        self.starts = np.concatenate([[0], self.stops[:-1]]) if len(self.stops) else self.stops

    def digests(self) -> list[np.ndarray]:
        """Two 64-bit hashes of every unit's words in their order."""
        out = []
        with np.errstate(over="ignore"):
            for base in BASES:
                powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(self.hashes), base)]))
                sums = np.concatenate([[np.uint64(0)], np.cumsum(self.hashes * powers[:-1])])
                inverse = pow(int(base), -1, 1 << 64)
                back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(self.hashes), np.uint64(inverse))]))
                out.append(((sums[self.stops] - sums[self.starts]) * back[self.starts] + (self.stops - self.starts).astype(np.uint64)).view(np.int64))
        return out


def named_texts(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id is not null and text is not null").selectExpr("cast(doc_id as bigint) doc_id", "xxhash64(text) as h", "text")


def unit_digests(docs: DataFrame) -> DataFrame:
    """d1, d2 (digest) and doc_id of every unit."""

    def work(batches):
        for part in text_slices(batches):
            u = Units(texts_of(part))
            d1, d2 = u.digests()
            text = u.text_of[u.starts] if len(u.starts) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(d1), pa.array(d2), column(part, "doc_id").take(pa.array(text))], names=["d1", "d2", "doc_id"])

    texts = docs.where("doc_id is not null and text is not null").selectExpr("cast(doc_id as bigint) doc_id", "text")
    return texts.mapInArrow(work, "d1 bigint, d2 bigint, doc_id bigint")


def unit_rows(docs: DataFrame, only: BitFilter) -> DataFrame:
    """The units whose digest may be in the filter, with their place (pos among the units, w0
    and w1 among the words of the document) and whether they start and end a line."""
    shared = only.shared

    def work(batches):
        for part in text_slices(batches, max_bytes=2 << 20):
            u = Units(texts_of(part))
            d1, d2 = u.digests()
            rows = np.flatnonzero(holds(shared.value, d1))
            if not len(rows):
                continue
            text = u.text_of[u.starts]
            first_unit = np.searchsorted(text, np.arange(part.num_rows))
            starts_line = np.concatenate([[True], u.line_end[u.starts[1:] - 1]])
            of = text[rows]
            ints = (rows - first_unit[of], u.starts[rows] - u.bounds[of], u.stops[rows] - u.bounds[of])
            arrays = [
                pa.array(d1[rows]), pa.array(d2[rows]), column(part, "doc_id").take(pa.array(of)), column(part, "h").take(pa.array(of)),
                *(pa.array(x, pa.int32()) for x in ints), pa.array(starts_line[rows]), pa.array(u.line_end[u.stops[rows] - 1]),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["d1", "d2", "doc_id", "h", "pos", "w0", "w1", "bol", "eol"])

    schema = "d1 bigint, d2 bigint, doc_id bigint, h bigint, pos int, w0 int, w1 int, bol boolean, eol boolean"
    return named_texts(docs).mapInArrow(work, schema)


def agreeing(a: str, b: str) -> Column:
    """How many words agree from the start of two lists."""
    differ = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(differ > 0, differ - 1).otherwise(F.least(F.size(a), F.size(b))).cast("int")


def word_runs(docs: DataFrame, min_words: int = MIN_WORDS, line_words: int = LINE_WORDS) -> DataFrame:
    """A written table of doc_id, h, w0, w1 (words of the run), n_units, kept_doc_id and
    kept_doc_ids."""
    # met more than once; units of rows that are one document drop out where they are placed
    seen = unit_digests(docs).groupBy("d1", "d2").agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("_n"))
    repeated = written(seen.where("_n > 1").select("d1", "d2", "first_doc"), "units-repeated")
    only = BitFilter(repeated, "d1")
    met = written(unit_rows(docs, only).join(repeated, ["d1", "d2"]), "units-met")
    only.done()
    # the kept occurrence: the first unit of the first text of the smallest id
    at_first = met.where("doc_id = first_doc").groupBy("d1", "d2").agg(F.min(F.struct("h", "pos", "w0", "w1")).alias("k"))
    kept = at_first.select("d1", "d2", *[F.col(f"k.{c}").alias(f"k{c}") for c in ("h", "pos", "w0", "w1")])
    repeats = met.join(kept, ["d1", "d2"]).where((F.col("doc_id") != F.col("first_doc")) | (F.col("h") != F.col("kh")) | (F.col("pos") != F.col("kpos")))
    doc = Window.partitionBy("doc_id", "h")
    repeats = repeats.select("doc_id", "h", "pos", "w0", "w1", "first_doc", "kh", "kw0", "kw1", "bol", "eol")
    runs = repeats.withColumn("_run", F.col("pos") - F.dense_rank().over(doc.orderBy("pos"))).groupBy("doc_id", "h", "_run").agg(
        F.min(F.struct("pos", "w0", "bol", "first_doc", "kh", "kw0")).alias("a"),
        F.max(F.struct("pos", "w1", "eol", "first_doc", "kh", "kw1")).alias("b"),
        F.collect_set("first_doc").alias("kept"),
    )
    size = F.col("b.w1") - F.col("a.w0")
    runs = runs.select("*", (F.col("a.bol") & F.col("b.eol") & (size >= line_words)).alias("lines")).where((size >= SEED_WORDS) | F.col("lines"))
    runs = written(runs, "units-runs")
    discard(repeated, met)
    edges = []
    for side, edge, w in ((0, "a", "w0"), (1, "b", "w1")):
        columns = [F.col(f"{edge}.{c}").alias(n) for c, n in ((w, "w"), ("first_doc", "kdoc"), ("kh", "kh"), (f"k{w}", "kw"))]
        edges.append(runs.select("doc_id", "h", "_run", F.lit(side).alias("side"), *columns))
    edges = edges[0].unionByName(edges[1])
    words = words_around(docs, edges.select("doc_id", "h", "w").unionByName(edges.select("kdoc", "kh", "kw").toDF("doc_id", "h", "w")))
    theirs = words.select(F.col("doc_id").alias("kdoc"), F.col("h").alias("kh"), F.col("w").alias("kw"), F.col("before").alias("kbefore"), F.col("after").alias("kafter"))
    met_at = edges.join(words, ["doc_id", "h", "w"]).join(theirs, ["kdoc", "kh", "kw"])
    more = F.when(F.col("side") == 0, agreeing("before", "kbefore")).otherwise(agreeing("after", "kafter"))
    grown = met_at.groupBy("doc_id", "h", "_run").agg(F.max(F.when(F.col("side") == 0, more)).alias("left"), F.max(F.when(F.col("side") == 1, more)).alias("right"))
    runs_at = runs.join(grown, ["doc_id", "h", "_run"]).select(
        "doc_id", "h", (F.col("a.w0") - F.col("left")).alias("w0"), (F.col("b.w1") + F.col("right")).alias("w1"),
        (F.col("b.pos") - F.col("a.pos") + 1).alias("n_units"), "kept", "lines",
    )
    # runs whose extensions meet are one
    ordered = doc.orderBy("w0", "w1")
    reach = F.max("w1").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    spans = runs_at.withColumn("_new", F.coalesce(F.col("w0") > reach, F.lit(True)).cast("int"))
    spans = spans.withColumn("_span", F.sum("_new").over(ordered.rowsBetween(Window.unboundedPreceding, 0))).groupBy("doc_id", "h", "_span").agg(
        F.min("w0").alias("w0"), F.max("w1").alias("w1"), F.sum("n_units").alias("n_units"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("kept")))).alias("kept_doc_ids"), F.max("lines").alias("lines"),
    )
    spans = spans.where((F.col("w1") - F.col("w0") >= min_words) | F.col("lines"))
    out = written(spans.select("doc_id", "h", "w0", "w1", "n_units", "kept_doc_ids"), "units-spans")
    discard(runs, words)
    return out


def words_around(docs: DataFrame, places: DataFrame) -> DataFrame:
    """A written table of doc_id, h, w, before and after: hashes of the words around the places
    w of documents."""
    of_doc = written(places.distinct().groupBy("doc_id", "h").agg(F.collect_list("w").alias("ws")), "units-places")
    wanted = BitFilter(of_doc.select(F.xxhash64("doc_id", "h").alias("k")), "k")
    texts = named_texts(docs).where(wanted.may_hold(F.xxhash64("doc_id", "h"))).dropDuplicates(["doc_id", "h"])

    def work(batches):
        import xxhash

        for part in text_slices(batches):
            doc, h, at, before, after = [], [], [], [], []
            lowered = pc.ascii_lower(texts_of(part)).to_pylist()
            for i, k, text, ws in zip(*(column(part, c).to_pylist() for c in ("doc_id", "h")), lowered, column(part, "ws").to_pylist()):
                words = WORD.findall(text)
                for w in ws:
                    doc.append(i)
                    h.append(k)
                    at.append(w)
                    before.append([xxhash.xxh32_intdigest(x) for x in words[max(0, w - CONTEXT) : w][::-1]])  # nearest first
                    after.append([xxhash.xxh32_intdigest(x) for x in words[w : w + CONTEXT]])
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(h, pa.int64()), pa.array(at, pa.int32()), pa.array(before, lists), pa.array(after, lists)], names=["doc_id", "h", "w", "before", "after"]
            )

    found = texts.join(of_doc, ["doc_id", "h"]).mapInArrow(work, "doc_id bigint, h bigint, w int, before array<bigint>, after array<bigint>")
    found = written(found, "units-around")
    wanted.done()
    discard(of_doc)
    return found


def remove_runs(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """doc_id, h, text without its runs, and spans (the runs as array<struct<start, stop, w0>>
    in code points of the original), of the documents that have runs of ``word_runs``."""
    wanted = BitFilter(runs.select(F.xxhash64("doc_id", "h").alias("k")).distinct(), "k")
    texts = named_texts(docs).where(wanted.may_hold(F.xxhash64("doc_id", "h")))
    words = runs.groupBy("doc_id", "h").agg(F.sort_array(F.collect_list(F.struct("w0", "w1"))).alias("words"))

    def work(batches):
        for part in text_slices(batches):
            texts, spans = [], []
            for text, runs_ in zip(column(part, "text").to_pylist(), column(part, "words").to_pylist()):
                places = [m.span() for m in WORD.finditer(text)]
                found = [{"start": places[r["w0"]][0], "stop": places[r["w1"] - 1][1], "w0": r["w0"]} for r in runs_]
                at, out = 0, []
                for s in found:
                    out.append(text[at : s["start"]])
                    at = s["stop"]
                texts.append("".join([*out, text[at:]]))
                spans.append(found)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("w0", pa.int32())]))
            yield pa.RecordBatch.from_arrays([column(part, "doc_id"), column(part, "h"), pa.array(texts, pa.string()), pa.array(spans, kind)], names=["doc_id", "h", "text", "spans"])

    return texts.join(words, ["doc_id", "h"]).mapInArrow(work, "doc_id bigint, h bigint, text string, spans array<struct<start: bigint, stop: bigint, w0: int>>")


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, line_words: int = LINE_WORDS) -> DataFrame:
    """One row per removed run (of each row that has it): doc_id, start, stop (code points,
    stop exclusive), n_units, n_words, kept_doc_id (smallest document that keeps a unit of the
    run), kept_doc_ids (all of them, sorted) and left_sha256 (of the document's text
    without its runs)."""
    runs = word_runs(docs, min_words, line_words)
    left = remove_runs(docs, runs).select("doc_id", "h", F.sha2("text", 256).alias("left_sha256"), F.explode("spans").alias("s"))
    left = left.select("doc_id", "h", "left_sha256", "s.start", "s.stop", F.col("s.w0").alias("w0"))
    return left.join(runs, ["doc_id", "h", "w0"]).select(
        "doc_id", "start", "stop", F.col("n_units").cast("bigint").alias("n_units"), (F.col("w1") - F.col("w0")).cast("bigint").alias("n_words"),
        F.col("kept_doc_ids")[0].alias("kept_doc_id"), "kept_doc_ids", "left_sha256",
    )
