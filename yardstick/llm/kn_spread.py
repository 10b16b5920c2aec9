"""Kneser-Ney model of any amount of text, spread over shards (operator 7).

Counting.  Blocks of texts (units of about ``UNIT_BYTES``) are turned into their distinct
trigrams with counts, one packed row per unit and shard.  A trigram lies in the shard of its last
two words, so a shard that merges its rows has the trigrams' counts and also all continuations of
its bigrams, without another exchange.  It tells the shards of the contexts, per context, its
total and how many n-grams have it once, twice and more often, and the shards of the words their
continuation counts; these are added up in a second step.  Words travel as 64-bit hashes.  The
driver sees six sums per order, from which the discounts come.

Scoring.  A unit asks the shards of its distinct n-grams of every order, as packed keys in
ascending order, gets their counts and context numbers back, and scores its documents by array
look-ups.  Nothing is broadcast and no text is shuffled: a document travels as the codes of its
words.  That is done in ``ROUNDS`` parts of the documents, one after another, so only one part's
questions are on disk at a time.  The model's tables are bucketed by shard, so the questions
travel to them and the model itself is never shuffled.
"""

from __future__ import annotations

import sys as _sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow_text import column, give_back, split_words, text_slices, texts_of, word_codes
from .kn_quality import END, ORDER, START, chain
from .lm_scoring import numbers, pack, planes, risen, risen_keys, rising, summed, unpack
from .tables import bucketed, discard, drop_listed, written

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

UNIT_BYTES = 8 << 20
SHARD_BYTES = 32 << 20  # text bytes per shard
SLICE = 2 << 20
ROUNDS = 8
STATS = 4  # of a context: total, n-grams counted once, twice and more often
SHARD_BITS = 20  # the upper bits of a key, which give its shard
BLOCK = 1 << 16  # n-grams whose keys are made at a time

ROWS = "kind string, unit bigint, shard bigint, payload binary"
SUMS = f"{ROWS}, sums array<bigint>"
SCORES = "doc_id bigint, lang string, row bigint, n_tokens bigint, log10_prob double"


def row_batch(rows: list) -> pa.RecordBatch:
    kinds, units, shards, payloads = zip(*rows)
    arrays = [pa.array(kinds), pa.array(units, pa.int64()), pa.array(shards, pa.int64()), pa.array(payloads, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, names=["kind", "unit", "shard", "payload"])


def key_of(words: np.ndarray) -> np.ndarray:
    """Keys of n-grams given as one row of hashes per position.  A trigram has the upper bits,
    and so the shard, of the bigram it ends with."""
    out = np.empty(words.shape[1], np.uint64)
    for a in range(0, len(out), BLOCK):  # what is made on the way is as short as a block
        some = words[:, a : a + BLOCK]
        key = np.zeros(some.shape[1], np.uint64)
        for row in some:
            key = chain(key, row)
        if len(words) == ORDER:
            low = np.uint64(64 - SHARD_BITS)
            key = (key_of(some[1:]) >> low << low) | (key >> np.uint64(SHARD_BITS))
        out[a : a + BLOCK] = key
    return out


def coded_keys(words: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """``key_of`` of n-grams given as places of their words, of which a block is hashes at a time."""
    blocks = (key_of(words[codes[:, a : a + BLOCK]]) for a in range(0, codes.shape[1], BLOCK))
    return np.concatenate([np.zeros(0, np.uint64), *blocks])


def firsts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, order, starts): the order that sorts the keys and where in it each distinct
    key begins, so ``order[starts]`` are the places of the distinct keys."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
    return keys[starts], order, starts


def shard_cuts(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's stretch of sorted keys begins, and the end."""
    starts = [-(-(s << SHARD_BITS) // shards) << (64 - SHARD_BITS) for s in range(shards)]
    return np.concatenate([np.searchsorted(keys, np.array(starts, np.uint64)), [len(keys)]])


def class_sums(n: np.ndarray) -> list[int]:
    return [int(x) for x in ((n == 1).sum(), (n == 2).sum(), (n == 3).sum(), (n > 3).sum(), n.sum(), len(n))]


def count_entries(words: np.ndarray, codes: np.ndarray, n: np.ndarray, keys: np.ndarray, shards: int):
    """(shard, packed n-grams) of n-grams sorted by key; ``codes`` are the places of their
    words in ``words``, which ascend."""
    cuts = shard_cuts(keys, shards)
    for s, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if a < b:
            known = np.zeros(len(words), bool)
            known[codes[:, a:b]] = True
            at = (np.cumsum(known, dtype=np.uint32) - 1)[codes[:, a:b]]
            order = np.lexsort(at[::-1])  # which packs well
            at = at[:, order]
            yield s, pack({"words": rising(words[known]), "first": rising(at[0]), "at": [planes(x) for x in at[1:]], "n": planes(n[a:b][order])})


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(tokens per text, tokens) as 64-bit hashes of the lower-cased words, ends included."""
    import xxhash

    bounds, words = split_words(pc.ascii_lower(texts))
    codes, distinct = word_codes(words)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))
    sizes = np.diff(bounds) + 1
    tokens = np.full(int(sizes.sum()), END, np.uint64)
    word = np.ones(len(tokens), bool)
    word[np.cumsum(sizes) - 1] = False
    tokens[word] = hashes[codes]
    return sizes, tokens


def unit_tokens(batches, columns: list[str], unit_bytes: int):
    """(values of the columns, tokens per text, tokens) of blocks of texts."""
    kept, sizes, tokens, size = [[] for _ in columns], [], [], 0
    for part in text_slices(batches, max_bytes=SLICE):
        texts = texts_of(part)
        for values, name in zip(kept, columns):
            values += column(part, name).to_pylist()
        for store, found in zip((sizes, tokens), tokens_of(texts)):
            store.append(found)
        size += texts.nbytes
        del part, texts, found
        if size >= unit_bytes:
            yield kept, joined(sizes), joined(tokens)
            kept, size = [[] for _ in columns], 0
    if sizes:
        yield kept, joined(sizes), joined(tokens)


def joined(parts: list[np.ndarray]) -> np.ndarray:
    """One array of the list's, which is empty afterwards."""
    whole = np.concatenate(parts, axis=-1)
    parts.clear()
    return whole


def narrow(packed) -> np.ndarray:
    """Whole numbers in four bytes each where they fit."""
    found = numbers(packed)
    return found.astype(np.uint32) if len(packed[1]) <= 4 else found


def grid_of(sizes: np.ndarray, tokens: np.ndarray, start=START) -> np.ndarray:
    """Every token below its predecessors in its text."""
    starts = np.cumsum(sizes) - sizes
    grid = np.empty((ORDER, len(tokens)), tokens.dtype)
    grid[-1] = tokens
    for k in range(ORDER - 1, 0, -1):
        grid[k - 1, 1:] = grid[k, :-1]
        grid[k - 1, starts] = start
    return grid


def word_places(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, with that before a text; the place of every token among them)."""
    words = np.unique(np.append(tokens, START))
    return words, np.searchsorted(words, tokens).astype(np.uint32)


def unit_grams(words: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple:
    """(codes, counts, keys) of a unit's distinct n-grams, in ascending order of the keys."""
    grid = grid_of(sizes, codes, np.searchsorted(words, START))
    keys, order, starts = firsts(coded_keys(words, grid))
    at = order[starts]
    del order
    return grid[:, at], np.diff(starts, append=grid.shape[1]), keys


def counted(texts: DataFrame, shards: int) -> DataFrame:
    def work(batches):
        number = TaskContext.get().partitionId() << 24
        for _, sizes, tokens in unit_tokens(batches, [], UNIT_BYTES):
            words, tokens = word_places(tokens)
            grams = unit_grams(words, sizes, tokens)
            del sizes, tokens
            for shard, data in count_entries(words, *grams, shards):
                yield row_batch([("count", number, shard, data)])
            del words, grams
            give_back()
            number += 1

    return texts.select("text").mapInArrow(work, ROWS)


def grouped(keys: np.ndarray, columns: list) -> tuple[np.ndarray, list]:
    """(distinct keys, sums of the columns per key)."""
    keys, at = np.unique(keys, return_inverse=True)
    return keys, [np.bincount(at, x, len(keys)).astype(np.int64) for x in columns]


def context_stats(words: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, list]:
    return grouped(key_of(words[:-1]), [n, n == 1, n == 2, n > 2])


def packed_at(keys: np.ndarray, columns: list, a: int, b: int) -> tuple:
    return rising(keys[a:b]), [planes(x[a:b]) for x in columns]


def entries_of(payloads: pa.ChunkedArray) -> tuple:
    """(words, codes, counts) of the n-grams of packed rows, one row unpacked at a time."""
    known, codes, counts = [np.zeros(0, np.uint64)], [np.zeros((ORDER, 0), np.uint32)], [np.zeros(0, np.uint32)]
    for data in payloads:
        if data.is_valid:
            part = unpack(data.as_py())
            known.append(risen_keys(part["words"]))
            codes.append(np.stack([x.astype(np.uint32) for x in (risen(part["first"]), *map(numbers, part["at"]))]))
            counts.append(narrow(part["n"]))
    words = np.unique(np.concatenate(known))
    for k, own in enumerate(known):
        codes[k] = np.searchsorted(words, own).astype(np.uint32)[codes[k]]
    return words, joined(codes), joined(counts)


def merged(shards: int):
    """One shard's trigrams and bigrams with their counts (kind model; with the sums of both
    orders), and what they add to the contexts of both orders and to the words (kind count, with
    the shard it is for as ``unit``)."""

    def work(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        known, codes, n = entries_of(table.column("payload"))
        keys, order, starts = firsts(coded_keys(known, codes))
        n = np.add.reduceat(n[order], starts, dtype=np.int64) if len(n) else n.astype(np.int64)
        words = known[codes[:, order[starts]]]
        del known, codes, order, starts
        top, sums, told = (rising(keys), planes(n)), class_sums(n), [context_stats(words, n)]
        keys, order, starts = firsts(key_of(words[1:]))
        words, n = words[1:, order[starts]], np.diff(starts, append=len(order))
        del order, starts
        told += [context_stats(words, n), grouped(key_of(words[1:]), [np.ones(len(n), np.int64)])]
        out = [("model", 0, shard, pack({"grams": [(rising(keys), planes(n)), top]}))]
        cuts = [shard_cuts(known, shards) for known, _ in told]
        for s in range(shards):
            if s == shard or any(c[s] < c[s + 1] for c in cuts):
                out.append(("count", s, shard, pack([packed_at(*x, *c[s : s + 2]) for x, c in zip(told, cuts)])))
        made = pa.Table.from_batches([row_batch(out)])
        made = made.append_column("sums", pa.array([sums + class_sums(n)] + [None] * (len(out) - 1), pa.list_(pa.int64())))
        del told, words
        give_back()
        return made

    return work


def added_up(table: pa.Table) -> pa.Table:
    """One shard's contexts of trigrams and of bigrams, and its words, added up over all
    shards' rows; with the sums of the words."""
    parts = [unpack(x) for x in table.column("payload").to_pylist()]
    found = []
    for same in zip(*parts):
        columns = [np.concatenate([numbers(x) for x in xs]) for xs in zip(*(columns for _, columns in same))]
        found.append(grouped(np.concatenate([risen_keys(keys) for keys, _ in same]), columns))
    del parts
    trigrams, bigrams, (words, (n,)) = found
    contexts = [(rising(keys), [planes(x) for x in stats]) for keys, stats in (bigrams, trigrams)]
    row = ("model", 0, table.column("unit")[0].as_py(), pack({"grams": [(rising(words), planes(n))], "contexts": contexts}))
    made = pa.Table.from_batches([row_batch([row])]).append_column("sums", pa.array([class_sums(n)], pa.list_(pa.int64())))
    del found, trigrams, bigrams, words, n
    give_back()
    return made


def discounts(once: int, twice: int, thrice: int, more: int) -> list[float]:
    n1, n2, n3, n4 = (max(1, x) for x in (once, twice, thrice, more))
    y = n1 / (n1 + 2 * n2)
    return [0.0] + [min(k - 0.05, max(0.05, k - (k + 1) * y * b / a)) for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]


class Spread:
    """The model: ``rows`` has one row per shard with its packed tables (``upper``: trigrams and
    bigrams, ``lower``: words and contexts), ``cut`` the discounts per order, ``first`` the total,
    classes and number of the words."""

    def __init__(self, texts: DataFrame, size: int):
        """Counts all ``texts``; ``size`` is the text bytes that are to be scored."""
        self.shards = max(4, -(-size // SHARD_BYTES))
        buckets = 2 * self.shards  # shards are dealt to them by hash
        every = texts.sparkSession.range(self.shards).selectExpr("'seed' kind", "0L unit", "id shard", "cast(null as binary) payload")
        rows = counted(texts, self.shards).unionByName(every)  # so that no shard is without a row
        upper = bucketed(rows.groupBy("shard").applyInArrow(merged(self.shards), SUMS), "kn-upper", buckets, "shard", "kind")
        told = upper.where("kind = 'count'").select("unit", "payload")
        lower = bucketed(told.groupBy("unit").applyInArrow(added_up, SUMS), "kn-lower", buckets, "shard", "kind")
        told.written_to = f"{upper.written_to}/kind=count"
        discard(told)
        self.made = [upper, lower]
        upper, lower = (x.where("kind = 'model'") for x in self.made)
        sums = summed(upper) + summed(lower)
        self.cut = {order: discounts(*sums[k : k + 4]) for order, k in ((3, 0), (2, 6), (1, 12))}
        sums = sums[12:]
        self.first = {"total": sums[4], "classes": [sums[0], sums[1], sums[2] + sums[3]], "kinds": sums[5]}
        lower = lower.select("shard", F.col("payload").alias("lower"))
        self.rows = upper.select("shard", F.col("payload").alias("upper")).join(lower, "shard")

    def done(self) -> None:
        drop_listed(*self.made)
        discard(*self.made)


def asked_keys(grid: np.ndarray):
    """Per order the keys of a unit's tokens, and after them that of a text's beginning: all
    contexts of the next order are among them."""
    key = lambda rows: np.append(key_of(rows), key_of(np.full((len(rows), 1), START, np.uint64)))
    return (key(grid[len(grid) - n :]) for n in range(1, len(grid) + 1))


def sorted_distinct(keys: np.ndarray) -> np.ndarray:
    """The distinct keys in ascending order; sorts the given ones."""
    keys.sort()
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)]]


def questions(docs: DataFrame, shards: int) -> DataFrame:
    """Per unit its documents (kind docs, a group of their own) and its keys per shard (ask)."""

    def work(batches):
        number = TaskContext.get().partitionId() << 24
        for (ids, langs, rows), sizes, tokens in unit_tokens(batches, ["doc_id", "lang", "row"], UNIT_BYTES):
            words, codes = np.unique(tokens, return_inverse=True)
            doc = {"ids": ids, "langs": langs, "rows": rows, "sizes": planes(sizes), "words": rising(words), "codes": planes(codes)}
            yield row_batch([("docs", number, -1 - number, pack(doc))])
            grid = grid_of(sizes, tokens)
            del doc, words, codes, sizes, tokens
            asked = [sorted_distinct(keys) for keys in asked_keys(grid)]
            del grid
            cuts = [shard_cuts(keys, shards) for keys in asked]
            for s in range(shards):
                if any(c[s] < c[s + 1] for c in cuts):
                    yield row_batch([("ask", number, s, pack([rising(keys[c[s] : c[s + 1]]) for keys, c in zip(asked, cuts)]))])
            del asked
            give_back()
            number += 1

    return docs.select("doc_id", "lang", "row", "text").mapInArrow(work, ROWS)


def found_at(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which keys are known, their places)."""
    if not len(known):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    hit = np.flatnonzero(known[at] == keys)
    return hit, at[hit]


def looked_up(known: np.ndarray, columns: list, keys: np.ndarray) -> list:
    hit, at = found_at(known, keys)
    out = []
    for x in columns:
        y = np.zeros(len(keys), np.int64)
        y[hit] = x[at]
        out.append(planes(y))
    return out


def answers(table: pa.Table, model: pa.Table) -> pa.Table:
    """To every unit the counts and context numbers of its keys of one shard, per order; a
    unit's documents go on as they are."""
    if not table.num_rows or not model.num_rows:  # documents have no shard of the model
        return table
    upper, lower = (unpack(model.column(x)[0].as_py()) for x in ("upper", "lower"))
    grams = [(risen_keys(keys), [narrow(n)]) for keys, n in lower["grams"] + upper["grams"]]
    contexts = [(risen_keys(keys), [narrow(x) for x in stats]) for keys, stats in lower["contexts"]]
    del upper, lower
    known = [[g, *contexts[k : k + 1]] for k, g in enumerate(grams)]  # the longest n-grams are no contexts
    out = []
    for unit, shard, data in zip(table.column("unit").to_pylist(), table.column("shard").to_pylist(), table.column("payload")):
        asked = [risen_keys(x) for x in unpack(data.as_py())]
        out.append(("answer", unit, shard, pack([[y for k in some for y in looked_up(*k, keys)] for some, keys in zip(known, asked)])))
    del grams, contexts, known
    give_back()
    return pa.Table.from_batches([row_batch(out)])


def answered(docs: DataFrame, model: Spread) -> DataFrame:
    """Per unit of ``docs`` its documents and the answers of all shards.  Only the questions are shuffled."""
    asked = questions(docs, model.shards).groupBy("shard")
    return asked.cogroup(model.rows.groupBy("shard")).applyInArrow(answers, ROWS)


def log_probabilities(sizes: np.ndarray, tokens: np.ndarray, told: list, cut: dict, first: dict) -> np.ndarray:
    """log10 probability of every token; ``told`` has per order the count and context numbers
    of the unit's asked keys."""
    grid = grid_of(sizes, tokens)
    starts = np.cumsum(sizes) - sizes
    mass = lambda classes, d: sum(x * k for x, k in zip(classes, d[1:]))
    p = np.full(len(tokens), 1.0 / (first["kinds"] + 1))
    context = None
    for n, keys in enumerate(asked_keys(grid), 1):
        d = np.array(cut[n])
        _, at = np.unique(keys, return_inverse=True)
        at, beginning = at[:-1], at[-1]
        count = told[n - 1][0][at]
        share = count - d[np.minimum(count, 3)]
        if n == 1:
            total = max(1, first["total"])
            p = share / total + mass(first["classes"], d) / total * p
        else:  # a context that was never met hands the lower order's probability on
            total = context[0]
            met = total > 0
            p = np.where(met, (share + mass(context[1:], d) * p) / np.maximum(1, total), p)
        if n < len(grid):  # this order's n-gram before a token is its context in the next one
            before = np.concatenate([[0], at[:-1]])
            before[starts] = beginning
            context = [x[before] for x in told[n - 1][1:]]
    return np.log10(p)


def score_unit(cut: dict, first: dict):
    def work(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("shard").to_pylist(), table.column("payload").to_pylist()))
        doc = unpack(rows[0][1])  # a negative shard: the documents
        told = [[] for _ in range(ORDER)]
        for _, data in rows[1:]:
            for store, found in zip(told, unpack(data)):
                store.append([numbers(x).astype(np.int32) for x in found])
        del rows
        told = [[np.concatenate(x) for x in zip(*parts)] for parts in told]
        sizes = numbers(doc["sizes"])
        logs = log_probabilities(sizes, risen_keys(doc["words"])[numbers(doc["codes"])], told, cut, first)
        found = {"doc_id": pa.array(doc["ids"], pa.int64()), "lang": pa.array(doc["langs"], pa.string()), "row": pa.array(doc["rows"], pa.int64())}
        found |= {"n_tokens": pa.array(sizes, pa.int64()), "log10_prob": pa.array(np.add.reduceat(logs, np.cumsum(sizes) - sizes))}
        del told, logs
        give_back()
        return pa.table(found)

    return work


def spread_scores(docs: DataFrame, model: Spread) -> DataFrame:
    """doc_id, lang, row, n_tokens (the end included) and log10_prob of all rows of ``docs``
    (doc_id, lang, row, text); ``row`` deals them to the rounds."""
    found = None
    for k in range(ROUNDS):
        some = docs.where(F.pmod("row", F.lit(ROUNDS)) == k)
        scored = written(answered(some, model).groupBy("unit").applyInArrow(score_unit(model.cut, model.first), SCORES), "kn-scores")
        found = scored if found is None else found.unionByName(scored)
    return found
