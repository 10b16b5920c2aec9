"""LM scoring (operator 3): a hierarchical Pitman-Yor language model.

Tokens are lower-cased words and one end per text.  The restaurant of a token is given by
the word before it (the start of a text being one), by ``context``: ``last_word`` gives
every word a restaurant of its own, ``ending`` one to all words of an ending.  All these
context restaurants share one parent, the unigram restaurant, whose base is uniform
over the V known words and one unknown word.  A dish that opens a table in a context
restaurant sends a customer to the parent.

Seating is sampled by Gibbs sweeps.  In a sweep all customers of a dish leave a restaurant
and are seated again: up to ``EXACT`` customers by the exact distribution of their number
of tables (generalised Stirling numbers), more one after another in blocks that grow with
the customers already seated; one customer has one table.  Every dish sees the restaurants'
table totals of the sweep before.  After ``BURN_IN`` sweeps the predictive probabilities of
the remaining samples are averaged.

How it is spread.  One Python pass turns blocks of documents (units of about
``UNIT_BYTES``) into token codes, and for every unit and word shard one packed row of the
unit's distinct words with their contexts and counts, so a frequent word is one entry per unit
and context.  The rows of a shard are merged to its part of the model: the dishes of its words
in all restaurants.  A restaurant's dishes lie in many shards, so every context has a home (by
its hash) that adds up the restaurant's tables: in a sweep the homes answer each shard with the
totals of the restaurants it has dishes of, the shard seats its dishes and tells the homes its
tables.  Only dishes of two customers or more and their restaurants travel there; the driver
sees two sums per sweep.  Each shard then answers each unit with the probabilities of the
unit's pairs, and a unit scores its documents by array look-ups.  Words and contexts are known
by 64-bit hashes.  Seeds are fixed, so a task that runs again samples the same seating.
Intermediate tables are written to the shared checkpoint folder.

Defined cases: a null or empty text is one token, the end; a null id counts as the empty
id text (training); rows repeated are documents of their own; without training rows every
probability is 1; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import pickle
import sys as _sys
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow_text import column, give_back, split_words, text_slices, texts_of, word_codes
from .tables import discard, small_batches, written

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

CLASSES = 64
START = CLASSES - 1
UNIT_BYTES = 16 << 20
SHARD_BYTES = 16 << 20  # text bytes per word shard
SLICE = 1 << 20
SWEEPS = 4
BURN_IN = 2
EXACT = 32
THETA = 1.0
SEED = 7

ROWS = "kind string, unit bigint, shard int, payload binary"


def pack(obj) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(obj, protocol=5))


def unpack(data: bytes):
    import zstandard

    return pickle.loads(zstandard.ZstdDecompressor().decompress(data))


def ending(word: str) -> int:
    """A context class of the word before a token, the start of a text being the empty word."""
    return ord(word[-1]) % (CLASSES - 1) if word else START


def last_word(word: str) -> str:
    """The word before a token as its context."""
    return word


def keys_of(labels) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(str(x)) for x in labels), np.uint64, len(labels))


def planes(x) -> tuple:
    """Whole numbers from 0 on as their low bytes, their next bytes and so on, which pack well."""
    x = np.ascontiguousarray(x, np.uint64)
    width = (int(x.max()).bit_length() + 7) // 8 if len(x) else 0
    return len(x), [x.view(np.uint8)[k::8].copy() for k in range(width)]


def numbers(packed) -> np.ndarray:
    size, parts = packed
    out = np.zeros(size, np.int64)
    for k, part in enumerate(parts):
        out |= part.astype(np.int64) << (8 * k)
    return out


def rising(x: np.ndarray) -> tuple:
    """Whole numbers in ascending order, by their steps (``risen`` reads them)."""
    return planes(np.diff(x, prepend=x.dtype.type(0)))


def risen(packed) -> np.ndarray:
    return np.cumsum(numbers(packed))


def risen_keys(packed) -> np.ndarray:
    return risen(packed).view(np.uint64)


class Unit:
    """Token codes of some documents and their distinct words; the end is the empty word, and
    as every text ends with it, it also stands before every text."""

    def __init__(self, number: int, shards: int, context):
        self.number, self.shards, self.context = number, shards, context
        self.at: dict[str, int] = {"": 0}
        self.codes, self.ids, self.sizes = [], [], []
        self.bytes = 0

    def add(self, ids: list, texts: pa.Array):
        bounds, words = split_words(pc.ascii_lower(texts))
        codes, distinct = word_codes(words)
        local = distinct.to_pylist()
        codes = np.fromiter((self.at.setdefault(w, len(self.at)) for w in local), np.uint32, len(local))[codes]
        sizes = np.diff(bounds)
        stops = np.cumsum(sizes + 1)
        flat = np.zeros(int(stops[-1]), np.uint32)  # 0 is the end
        inside = np.ones(len(flat), bool)
        inside[stops - 1] = False
        flat[inside] = codes
        self.codes.append(flat)
        self.ids += ids
        self.sizes.append(sizes + 1)
        self.bytes += int(pc.sum(pc.binary_length(texts)).as_py() or 0)

    def rows(self):
        """The packed rows of the unit: its documents, and its words per shard."""
        words = list(self.at)
        n_words, keys = len(words), keys_of(words)
        shard = keys % np.uint64(self.shards)
        order = np.lexsort((keys, shard))
        rank = np.empty(n_words, np.int64)
        rank[order] = np.arange(n_words)
        context_keys, context = np.unique(keys_of([self.context(w) for w in words]), return_inverse=True)
        del words
        self.at = None  # the unit ends with its rows
        codes = np.concatenate(self.codes)
        self.codes = None
        sizes = np.concatenate(self.sizes)
        held = np.array([zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1 for i in self.ids], bool)
        pairs = pair_codes(codes, rank, context, len(context_keys))
        train, times = run_lengths(pairs[np.repeat(~held, sizes)])
        pairs, _ = run_lengths(pairs)
        counts = np.zeros(len(pairs), np.int64)
        counts[np.searchsorted(pairs, train)] = times
        del train, times
        # frequent words get small codes, which pack well
        common = np.argsort(-np.bincount(codes, minlength=n_words), kind="stable")
        common = np.concatenate([[0], common[common != 0]])  # 0 stays the end
        place = np.empty(n_words, np.uint32)
        place[common] = np.arange(n_words)
        doc = {"ids": self.ids, "held": held, "sizes": sizes, "codes": planes(place[codes])}
        doc |= {"rank": planes(rank[common]), "context": planes(context[common]), "n_contexts": len(context_keys)}
        del codes, place
        yield "docs", self.number, -1, pack(doc)
        del doc
        shard, keys = shard[order], keys[order]
        per_word = np.bincount(pairs // len(context_keys), minlength=n_words)
        pair_ends = np.cumsum(per_word)
        cuts = np.flatnonzero(np.diff(shard)) + 1
        for a, b in zip([0, *cuts], [*cuts, n_words]):
            p, q = (pair_ends[a - 1] if a else 0), pair_ends[b - 1]
            mine, context = np.unique(pairs[p:q] % len(context_keys), return_inverse=True)
            entry = {"words": rising(keys[a:b]), "per_word": planes(per_word[a:b]), "context_keys": rising(context_keys[mine]), "context": planes(context), "counts": planes(counts[p:q])}
            yield "words", self.number, int(shard[a]), pack(entry)


def run_lengths(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values in ascending order, how often each is there), with one sorted copy."""
    values = np.sort(values)
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])[: len(values)])
    return values[first], np.diff(first, append=len(values))


def pair_codes(codes: np.ndarray, rank: np.ndarray, context: np.ndarray, n_contexts: int) -> np.ndarray:
    """The (word, context) of every token of whole texts as one number."""
    pairs = rank[codes]
    pairs *= n_contexts
    pairs[1:] += context[codes[:-1]]
    pairs[:1] += context[0]
    return pairs


def batch_of(rows) -> pa.RecordBatch:
    kinds, units, shards, payloads = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(kinds), pa.array(units, pa.int64()), pa.array(shards, pa.int32()), pa.array(payloads, pa.binary())], names=["kind", "unit", "shard", "payload"]
    )


def units(docs: DataFrame, shards: int, context) -> DataFrame:
    def work(batches):
        number = TaskContext.get().partitionId() << 24
        unit = Unit(number, shards, context)
        for part in text_slices(batches, max_bytes=SLICE):
            unit.add(column(part, "doc_id").to_pylist(), texts_of(part))
            if unit.bytes >= UNIT_BYTES:
                yield from (batch_of([row]) for row in unit.rows())
                number += 1
                unit = Unit(number, shards, context)
                give_back()
        if unit.ids:
            yield from (batch_of([row]) for row in unit.rows())

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(work, ROWS)


def rows_in(table: pa.Table, kind: str) -> list:
    """(unit, unpacked payload) of the rows of a kind, by unit."""
    part = table.filter(pc.equal(table.column("kind"), kind)).sort_by("unit")
    return [(unit, unpack(data)) for unit, data in zip(part.column("unit").to_pylist(), part.column("payload").to_pylist())]


def by_home(keys: np.ndarray, bits: int):
    """(home, first, last) of the stretches of sorted context keys that share a home."""
    home = (keys >> np.uint64(64 - bits)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(home)) + 1
    return [(int(home[a]), int(a), int(b)) for a, b in zip([0, *cuts], [*cuts, len(keys)]) if b > a]


def merge_shard(bits: int):
    """All units' words of one shard as one part of the model, with its counts (kind model),
    its dishes of two customers or more (seat), its restaurants for their homes (context) and
    the tables there before the first sweep (part)."""

    def work(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        parts = rows_in(table, "words")
        word_keys, context_keys = ([risen_keys(x[c]) for _, x in parts] for c in ("words", "context_keys"))
        words, word = np.unique(np.concatenate(word_keys), return_inverse=True)
        contexts, context = np.unique(np.concatenate(context_keys), return_inverse=True)
        keys, at, c_at, own = [], 0, 0, []
        for k, (_, x) in enumerate(parts):
            mine = word[at : at + len(word_keys[k])]
            own.append(mine)
            keys.append(np.repeat(mine, numbers(x["per_word"])) * len(contexts) + context[c_at + numbers(x["context"])])
            at, c_at = at + len(mine), c_at + len(context_keys[k])
        sizes = np.cumsum([0, *(len(k) for k in keys)])
        pairs, where = np.unique(np.concatenate(keys), return_inverse=True)
        counts = np.bincount(where, np.concatenate([numbers(x["counts"]) for _, x in parts]), len(pairs)).astype(np.int64)
        # a unit's words and pairs are in the same order here and there
        asks = [(unit, rising(own[k]), rising(where[sizes[k] : sizes[k + 1]])) for k, (unit, _) in enumerate(parts)]
        word, context = pairs // len(contexts), pairs % len(contexts)
        per_word = planes(np.bincount(word, minlength=len(words)))
        out = [("model", 0, shard, pack({"per_word": per_word, "context": planes(context), "counts": planes(counts), "asks": asks}))]
        many = counts > 1
        live, live_context = np.unique(context[many], return_inverse=True)
        seat = {"per_word": planes(np.bincount(word[many], minlength=len(words))), "context": planes(live_context), "counts": planes(counts[many])}
        seat |= {"single": planes(np.bincount(word[counts == 1], minlength=len(words))), "homes": by_home(contexts[live], bits)}
        out.append(("seat", 0, shard, pack(seat)))
        eaten = np.bincount(context, counts, len(contexts)).astype(np.int64)
        single = np.bincount(context[counts == 1], minlength=len(contexts))
        is_live = np.zeros(len(contexts), bool)
        is_live[live] = True
        for home, a, b in by_home(contexts, bits):
            out.append(("context", shard, home, pack((rising(contexts[a:b]), is_live[a:b], planes(eaten[a:b]), planes(single[a:b])))))
        out += table_rows(shard, seat, np.ones(int(many.sum()), np.int64))
        kinds = np.bincount(word[counts > 0], minlength=len(words))  # context kinds of each known word
        sums = [counts.sum(), (counts > 0).sum(), (counts == 1).sum(), (counts == 2).sum()]
        sums += [(kinds > 0).sum(), (kinds == 1).sum(), (kinds == 2).sum()]
        del parts, word_keys, context_keys, keys, own, where, pairs, word, context, counts
        give_back()
        return table_of(out, sums)

    return work


def table_of(rows: list, sums=()) -> pa.Table:
    """Rows with ``sums`` beside the first of them."""
    table = pa.Table.from_batches([batch_of(rows)])
    return table.append_column("sums", pa.array([[int(x) for x in sums]] + [None] * (len(rows) - 1), pa.list_(pa.int64())))


def table_rows(shard: int, seat: dict, tables: np.ndarray):
    """A shard's tables per restaurant, to the restaurants' homes."""
    context = numbers(seat["context"])
    total = np.bincount(context, tables, seat["homes"][-1][2] if seat["homes"] else 0).astype(np.int64)
    return [("part", shard, home, pack(planes(total[a:b]))) for home, a, b in seat["homes"]]


def home_of(table: pa.Table) -> pa.Table:
    """The restaurants of one home: customers, tables of one customer, and where each shard's are."""
    parts = rows_in(table, "context")
    keys, at = np.unique(np.concatenate([risen_keys(x[0]) for _, x in parts]), return_inverse=True)
    add = lambda k: np.bincount(at, np.concatenate([numbers(x[k]) for _, x in parts]), len(keys)).astype(np.int64)
    ends = np.cumsum([0, *(len(x[1]) for _, x in parts)])
    shards = [(shard, rising(at[ends[k] : ends[k + 1]]), x[1]) for k, (shard, x) in enumerate(parts)]
    home = {"customers": planes(add(2)), "single": planes(add(3)), "shards": shards}
    return pa.Table.from_batches([batch_of([("home", 0, table.column("shard")[0].as_py(), pack(home))])])


def home_tables(home: dict, parts: list) -> np.ndarray:
    """The tables of a home's restaurants."""
    tables = numbers(home["single"])
    sent = dict(parts)
    for shard, at, live in home["shards"]:
        if shard in sent:
            tables[risen(at)[live]] += numbers(sent[shard])
    return tables


def replies(table: pa.Table) -> pa.Table:
    """To every shard the tables of its restaurants whose dishes it seats."""
    number = table.column("shard")[0].as_py()
    ((_, home),) = rows_in(table, "home")
    tables = home_tables(home, rows_in(table, "part"))
    out = [("reply", number, shard, pack(planes(tables[risen(at)[live]]))) for shard, at, live in home["shards"] if live.any()]
    return pa.Table.from_batches([batch_of(out)]) if out else table.slice(0, 0).select(["kind", "unit", "shard", "payload"])


def last_replies(table: pa.Table) -> pa.Table:
    """To every shard the customers of all its restaurants and their tables in every sample
    (kinds part0, part1, ...)."""
    number = table.column("shard")[0].as_py()
    ((_, home),) = rows_in(table, "home")
    customers = numbers(home["customers"])
    samples = [home_tables(home, rows_in(table, f"part{k}")) for k in range(SWEEPS - BURN_IN)]
    out = []
    for shard, at, _ in home["shards"]:
        mine = risen(at)
        out.append(("reply", number, shard, pack([planes(x[mine]) for x in (customers, *samples)])))
    return pa.Table.from_batches([batch_of(out)])


def summed(df: DataFrame) -> list[int]:
    """Element-wise sums of the arrays in ``sums``; one row per element reaches the driver."""
    rows = df.select(F.posexplode("sums").alias("k", "v")).groupBy("k").agg(F.sum("v").alias("v")).collect()
    return [v for _, v in sorted((r["k"], r["v"]) for r in rows)]


def log_stirling(discount: float) -> np.ndarray:
    """log of the generalised Stirling numbers for 1..EXACT customers and tables."""
    out = np.full((EXACT + 1, EXACT + 1), -np.inf)
    out[1, 1] = 0.0
    for c in range(1, EXACT):
        for t in range(1, c + 2):
            stay = out[c, t] + np.log(c - discount * t) if t <= c else -np.inf
            out[c + 1, t] = np.logaddexp(out[c, t - 1], stay)
    return out


def seat(rng, customers, log_p, theta, discount, others, stirling) -> np.ndarray:
    """Tables of each dish after all its customers are seated again, given the parent's
    probability of the dish and the restaurant's tables of other dishes."""
    tables = np.ones(len(customers), np.int64)
    for c in range(2, EXACT + 1):
        rows = np.flatnonzero(customers == c)
        step = max(1, (1 << 20) // c)
        for a in range(0, len(rows), step):
            r = rows[a : a + step]
            t = np.arange(1, c + 1)
            opened = np.log(theta + discount * (others[r, None] + t - 1)).cumsum(axis=1)
            weights = stirling[c, 1 : c + 1] + t * log_p[r, None] + opened
            tables[r] = 1 + np.argmax(weights + rng.gumbel(size=weights.shape), axis=1)
    rows = np.flatnonzero(customers > EXACT)
    seated = np.ones(len(rows), np.int64)
    p = np.exp(log_p[rows])
    while len(rows):
        block = np.minimum(np.maximum(1, seated // 16), customers[rows] - seated)
        new = (theta + discount * (others[rows] + tables[rows])) * p
        chance = new / (new + seated - discount * tables[rows])
        tables[rows] += rng.binomial(block, np.clip(chance, 0.0, 1.0))
        seated += block
        left = seated < customers[rows]
        rows, seated, p = rows[left], seated[left], p[left]
    return tables


def sweep(fixed: dict, now: dict, k: int):
    """One sweep of a shard: its tables and the root tables of its words (kind state), and the
    tables for the homes (part); sums of both."""

    def work(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        ((_, seats),) = rows_in(table, "seat")
        context, count, single = (numbers(seats[c]) for c in ("context", "counts", "single"))
        n = len(single)
        word = np.repeat(np.arange(n), numbers(seats["per_word"]))
        state = rows_in(table, "state")
        tables = numbers(state[0][1]["tables"]) if state else np.ones(len(word), np.int64)
        customers = single + np.bincount(word, tables, n).astype(np.int64)
        root = numbers(state[0][1]["root"]) if state else (customers > 0).astype(np.int64)
        known = np.flatnonzero(customers)
        totals = np.concatenate([np.zeros(0, np.int64), *(numbers(x) for _, x in rows_in(table, "reply"))])
        rng = np.random.default_rng([SEED, shard, k])
        rest = customers[word] - tables  # the dish's customers in the parent from other restaurants
        share = np.maximum(0.0, rest - fixed["d0"] * np.minimum(root[word], rest)) / (THETA + now["m"])
        p = share + (THETA + fixed["d0"] * now["root"]) / (THETA + now["m"]) / (fixed["v"] + 1)
        tables = seat(rng, count, np.log(p), THETA, fixed["d"], np.maximum(0, totals[context] - tables), log_stirling(fixed["d"]))
        customers = single + np.bincount(word, tables, n).astype(np.int64)
        base = np.full(len(known), -np.log(fixed["v"] + 1.0))
        root[known] = seat(rng, customers[known], base, THETA, fixed["d0"], np.maximum(0, now["root"] - root[known]), log_stirling(fixed["d0"]))
        state = ("state", k, shard, pack({"tables": planes(tables), "root": planes(root)}))
        return table_of([state, *table_rows(shard, seats, tables)], [customers.sum(), root.sum()])

    return work


def answers(fixed: dict, totals: list[dict]):
    """For every unit the values of its words and pairs in a shard: training count, and the
    probability of the word in the context averaged over the samples."""

    def work(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        ((_, model),) = rows_in(table, "model")
        per_word, context, count = (numbers(model[c]) for c in ("per_word", "context", "counts"))
        n = len(per_word)
        word = np.repeat(np.arange(n), per_word)
        told = [x for _, x in rows_in(table, "reply")]
        customers, *tables_in = (np.concatenate([numbers(x[k]) for x in told]) for k in range(1 + SWEEPS - BURN_IN))
        total = np.bincount(word, count, n).astype(np.int64)
        many, p = count > 1, np.zeros(len(count))
        tables = np.minimum(count, 1)
        for (_, state), in_context, now in zip(rows_in(table, "state"), tables_in, totals):
            tables[many] = numbers(state["tables"])
            sent = np.bincount(word, tables, n)
            rest = (THETA + fixed["d0"] * now["root"]) / (fixed["v"] + 1)
            parent = (sent - fixed["d0"] * numbers(state["root"]) + rest) / (THETA + now["m"])
            p += count - fixed["d"] * tables + (THETA + fixed["d"] * in_context)[context] * parent[word]
        p = (p / (THETA + customers[context]) / (SWEEPS - BURN_IN)).astype(np.float32).view(np.uint32)
        of = lambda values, at: values[risen(at)]
        return pa.Table.from_batches([batch_of([("answer", unit, shard, pack((planes(of(total, w)), planes(of(p, q))))) for unit, w, q in model["asks"]])])

    return work


def score_unit(fixed: dict):
    def work(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("shard").to_pylist(), table.column("payload").to_pylist()))
        doc = unpack(rows[0][1])  # shard -1: the documents
        parts = [unpack(x) for _, x in rows[1:]]
        count = np.concatenate([numbers(x[0]) for x in parts])
        p = np.log10(np.concatenate([numbers(x[1]) for x in parts]).astype(np.uint32).view(np.float32).astype(np.float64))
        codes, rank, context = (numbers(doc[c]) for c in ("codes", "rank", "context"))
        tokens = pair_codes(codes, rank, context, doc["n_contexts"])
        tokens = np.searchsorted(run_lengths(tokens)[0], tokens)
        count = count[rank][codes]
        del parts, rows, rank, context, codes
        give_back()
        starts = np.cumsum(doc["sizes"]) - doc["sizes"]
        add = lambda values: np.add.reduceat(values, starts)
        return pa.table(
            {
                "doc_id": pa.array(doc["ids"], pa.int64()),
                "held_out": pa.array(doc["held"]),
                "n_tokens": pa.array(doc["sizes"], pa.int64()),
                "n_known": pa.array(add((count > 0).astype(np.int64))),
                "base_score": pa.array(add(np.log10((count + 0.5) / (fixed["n"] + 0.5 * (fixed["v"] + 1))))),
                "score": pa.array(add(p[tokens])),
            }
        )

    return work


def hpy_scores(docs: DataFrame, context=ending) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity.
    ``context`` names the restaurant of a token by the word before it."""
    size = docs.agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint"))).first()[0] or 0
    shards = max(4, -(-size // SHARD_BYTES))
    bits = max(1, (shards // 2).bit_length() - 1)  # of a context's hash: its home
    cells = ["kind", "unit", "shard", "payload"]
    with small_batches(docs.sparkSession):
        unit_rows = written(units(docs, shards, context), "lm-units", "kind")
    words = unit_rows.where("kind = 'words'").select(cells)
    model = written(words.groupBy("shard").applyInArrow(merge_shard(bits), f"{ROWS}, sums array<bigint>"), "lm-model", "kind")
    words.written_to = f"{unit_rows.written_to}/kind=words"
    discard(words)
    kind = lambda table, name: table.where(F.col("kind") == name).select(cells)
    homes = written(kind(model, "context").groupBy("shard").applyInArrow(home_of, ROWS), "lm-homes")
    n, tables, one, two, v, word_one, word_two = summed(model.where("kind = 'model'")) or [0] * 7
    discount = lambda a, b: min(0.95, max(0.05, a / (a + 2 * b) if a else 0.5))
    fixed = {"n": n, "v": v, "d": discount(one, two), "d0": discount(word_one, word_two)}
    totals, states = [{"m": tables, "root": v}], [model]
    for k in range(SWEEPS):
        told = homes.unionByName(kind(states[-1], "part")).groupBy("shard").applyInArrow(replies, ROWS)
        now = kind(model, "seat").unionByName(told)
        if k:
            now = now.unionByName(kind(states[-1], "state"))
        states.append(written(now.groupBy("shard").applyInArrow(sweep(fixed, totals[-1], k), f"{ROWS}, sums array<bigint>"), "lm-sweep", "kind"))
        m, root = summed(states[-1].where("kind = 'state'")) or [0, 0]
        totals.append({"m": m, "root": root})
        if 0 < k <= BURN_IN:
            discard(states[k])
    samples = states[BURN_IN + 1 :]
    last = homes
    for k, state in enumerate(samples):
        last = last.unionByName(kind(state, "part").withColumn("kind", F.lit(f"part{k}")))
    told = last.groupBy("shard").applyInArrow(last_replies, ROWS)
    both = kind(model, "model").unionByName(told)
    for state in samples:
        both = both.unionByName(kind(state, "state"))
    found = both.groupBy("shard").applyInArrow(answers(fixed, totals[BURN_IN + 1 :]), ROWS)
    rows = kind(unit_rows, "docs").unionByName(found).select("unit", "shard", "payload")
    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    scored = rows.groupBy("unit").applyInArrow(score_unit(fixed), schema)
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(fixed["n"]).cast("bigint").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
