"""MinHash near-dedup (operator 5) with tensored banding.

Two small collections of ``GROUPS`` groups of ``ROWS`` minhashes each are computed per
distinct shingle set; the key of table (i, j) combines group i of the first collection
with group j of the second, so GROUPS^2 tables of 2 * ROWS minhashes each cost only
2 * GROUPS * ROWS minhashes.  Two sets of similarity s share a key with probability
(1 - (1 - s^ROWS)^GROUPS)^2.

Steps, none of which collects documents or compares all pairs of a bucket:

1. signatures (one Python pass); equal sets become one node;
2. keys of the nodes are grouped with partial aggregation (smallest node, size), so a hot
   bucket is one row per task;
3. every node is compared with its most frequent bucket leader on the whole sets, then
   connected components name the groups;
4. the other (member, leader) pairs that cross groups are compared, components again;
5. the buckets that still hold several groups make families (nodes connected by such
   buckets).  A family's *core* is the shingles that more than half of its members have, and
   a member's *difference* the shingles that only one of core and member has.  Every member
   is compared with the member of the family closest to the core.  Components again;
6. in families that still hold several groups, members of different groups are joined on
   what their differences must share, and compared by their differences.

Let t be the similarity, D(x) the difference of x from the core and s(x) = |D(x)| (1 + t) -
|x| (1 - t).  As |x ^ y| = |D(x)| + |D(y)| - 2 |D(x) & D(y)|, x and y are linked exactly if their
differences share at least o = (s(x) + s(y)) / (2 (1 + t)) elements.  If that is 0 or less for
some pair, it is so for either of them and the member with the least s, and step 5 has
linked both to it.  For the others o grows with s(y), so the least s in the other groups
gives the least o that x needs; if it is more than the elements of D(x) that any other
member has too, x has no partner left.  Else, with the elements in order of rarity, two
partners share ``width`` elements among the first |D| - o + width of either, for any
``width`` up to o: members are joined on combinations of that many elements.

Members close to a core differ from it by little and those far from it need much in common,
so a large family of near copies names few pairs, where a join on shingles would name
nearly all.  After step 6 every pair that shares a key is in one group, was compared, or
cannot be similar, so nothing is lost beyond the tables' own miss probability.  Links are
confirmed on whole sets.

Defined cases: a null or empty text, or one without words, has an empty set, is linked
with nothing and kept; a single word is a set of one; rows with the same id are one
document, whatever their texts, and each row has the size of its own text's set; a row
without id is linked with nothing and kept, with a null component; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import sys as _sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrow_text import column, split_words, text_slices, texts_of, word_codes
from .components import components
from .tables import BitFilter, discard, holds, made_tables, written

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

SHINGLE = 5
PERCENT = 80
GROUPS = 12
ROWS = 3
SEED = 11
CHUNK = 1 << 10  # shingles hashed at a time
CORE_GRAMS = 1 << 21  # cores of together so many shingles are broadcast (16 MiB)
KEYS = 256  # combinations of one member, at most, if more than one element is combined
PAIR_SLICE = 1 << 20  # bytes of text on either side of the pairs compared at a time


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, size: int):
    """The sorted distinct shingle hashes of every text."""
    import xxhash

    bounds, words = split_words(pc.ascii_lower(texts))
    codes, distinct = word_codes(words)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))
    tokens = hashes[codes]
    with np.errstate(over="ignore"):
        for a, b in zip(bounds, bounds[1:]):
            doc = tokens[a:b]
            k = min(size, len(doc))
            if not k:
                yield doc
                continue
            grams = np.full(len(doc) - k + 1, k, np.uint64)
            for j in range(k):
                grams = mix(grams * np.uint64(0x9E3779B97F4A7C15) + doc[j : len(doc) - k + 1 + j])
            yield np.unique(grams)


def hash_functions():
    rng = np.random.default_rng(SEED)
    n = 2 * GROUPS * ROWS
    return rng.integers(0, 1 << 64, n, np.uint64), rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def group_keys(shingles: np.ndarray, flips: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """The 2 * GROUPS group hashes of one set."""
    least = np.full(len(flips), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for a in range(0, len(shingles), CHUNK):
            part = shingles[a : a + CHUNK, None]
            least = np.minimum(least, ((part ^ flips) * odds).min(axis=0))
        rows = least.reshape(2 * GROUPS, ROWS)
        key = np.arange(2 * GROUPS, dtype=np.uint64)
        for j in range(ROWS):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, j])
    return key


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text (with the id it names the text) and the text."""
    return docs.selectExpr("cast(doc_id as bigint) doc_id", "xxhash64(text) as h", "text")


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, h, n_shingles, digest of the set (binary, 128 bits), group hashes (binary)."""

    def work(batches):
        import xxhash

        flips, odds = hash_functions()
        for part in text_slices(batches):
            counts, digests, keys = [], [], []
            for s in shingle_sets(texts_of(part), size):
                counts.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()))
                keys.append(group_keys(s, flips, odds).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id"), column(part, "h"), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.binary())],
                names=["doc_id", "h", "n_shingles", "digest", "groups"],
            )

    return identified(docs).mapInArrow(work, "doc_id bigint, h bigint, n_shingles bigint, digest binary, groups binary")


def table_keys(nodes: DataFrame, only: BitFilter | None = None, label: str | None = None) -> DataFrame:
    """One row per node and table: key, id (and label)."""
    shared = only.shared if only else None
    extra = [label] if label else []

    def work(batches):
        tables = np.arange(GROUPS * GROUPS, dtype=np.uint64).reshape(GROUPS, GROUPS)
        data = shared.value if shared else None
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                ids = part.column(0).to_numpy(zero_copy_only=False)
                raw = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint64).reshape(-1, 2, GROUPS)
                with np.errstate(over="ignore"):
                    keys = mix(mix(raw[:, 0, :, None] + tables) + raw[:, 1, None, :]).reshape(len(ids), -1)
                flat = keys.reshape(-1).view(np.int64)
                at = np.arange(len(flat))
                if data is not None:
                    at = at[holds(data, flat)]
                row = at // (GROUPS * GROUPS)
                arrays, names = [pa.array(flat[at]), pa.array(ids[row])], ["key", "id", *extra]
                if extra:
                    arrays.append(part.column(2).take(pa.array(row)))
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return nodes.select("id", "groups", *extra).mapInArrow(work, "key bigint, id bigint" + (f", {label} bigint" if label else ""))


class Corpus:
    """The documents and their nodes (distinct shingle sets)."""

    def __init__(self, docs: DataFrame, size: int, percent: int):
        self.docs, self.size, self.percent = docs, size, percent
        table = written(signatures(docs, size), "minhash-signatures")
        real = table.where("doc_id is not null and n_shingles > 0")
        first = F.min(F.struct("doc_id", "h")).alias("first")
        nodes = real.groupBy("digest").agg(first, F.any_value("groups").alias("groups"))
        nodes = nodes.select(F.monotonically_increasing_id().alias("id"), "digest", "first.doc_id", "first.h", "groups")
        self.nodes = written(nodes, "minhash-nodes")
        rows = table.select("doc_id", "h", "n_shingles", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("digest")).alias("digest"))
        named = self.nodes.select("digest", F.col("id").alias("node"))
        self.rows = written(rows.join(named, "digest", "left").select("doc_id", "h", "n_shingles", "node"), "minhash-rows")
        # rows of one id and one text: their text is taken once
        self.repeats = not self.rows.where("node is not null").groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
        discard(table)

    def same_document(self) -> DataFrame:
        """Links (a, b) between the nodes of rows that have one id."""
        of_id = self.rows.where("node is not null").groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("hi")).where("b < hi")
        return self.rows.where("node is not null").join(of_id, "doc_id").where("node <> b").select(F.col("node").alias("a"), "b").distinct()

    def texts(self, ids: BitFilter) -> DataFrame:
        """doc_id, h and text of the rows that the filter (of xxhash64(doc_id, h)) may hold."""
        found = identified(self.docs).where("doc_id is not null").where(ids.may_hold(F.xxhash64("doc_id", "h")))
        return found.dropDuplicates(["doc_id", "h"]) if self.repeats else found

    def with_texts(self, pairs: DataFrame) -> tuple[DataFrame, BitFilter]:
        """(a, b, ta, tb) of a written table of node pairs."""
        where = self.nodes.select("id", "doc_id", "h")
        for c in "ab":
            pairs = pairs.join(where.select(F.col("id").alias(c), F.col("doc_id").alias(f"d{c}"), F.col("h").alias(f"h{c}")), c)
        pairs = written(pairs, "minhash-placed")
        ids = BitFilter(pairs.select(F.explode(F.array(F.xxhash64("da", "ha"), F.xxhash64("db", "hb"))).alias("k")).distinct(), "k")
        texts = self.texts(ids)
        joined = pairs
        for c in "ab":
            joined = joined.join(texts.select(F.col("doc_id").alias(f"d{c}"), F.col("h").alias(f"h{c}"), F.col("text").alias(f"t{c}")), [f"d{c}", f"h{c}"])
        return joined.select("a", "b", "ta", "tb"), ids

    def links(self, pairs: DataFrame) -> DataFrame:
        """The (a, b) node pairs whose whole shingle sets are similar enough."""
        pairs = written(pairs.select("a", "b").distinct(), "minhash-pairs")
        if pairs.isEmpty():
            return pairs
        joined, ids = self.with_texts(pairs)
        size, percent = self.size, self.percent

        def sets_of(part, name):  # a text met in many pairs of the slice is cut once
            codes, distinct = word_codes(texts_of(part, name))
            sets = list(shingle_sets(distinct, size))
            return [sets[c] for c in codes]

        def work(batches):
            for part in text_slices(text_slices(batches, "tb", PAIR_SLICE), "ta", PAIR_SLICE):
                similar = []
                for x, y in zip(sets_of(part, "ta"), sets_of(part, "tb")):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    similar.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
                yield pa.RecordBatch.from_arrays([column(part, "a"), column(part, "b")], names=["a", "b"]).filter(pa.array(similar, pa.bool_()))

        found = written(joined.mapInArrow(work, "a bigint, b bigint"), "minhash-links")
        ids.done()
        return found

    def sets(self, ids: DataFrame) -> DataFrame:
        """A written table of node ids (and other columns) with n and grams, the set of each."""
        placed = written(ids.join(self.nodes.select("id", "doc_id", "h"), "id"), "minhash-placed")
        wanted = BitFilter(placed.select(F.xxhash64("doc_id", "h").alias("k")), "k")
        rows = placed.join(self.texts(wanted), ["doc_id", "h"]).select(*ids.columns, "text")
        size = self.size

        def work(batches):
            for part in text_slices(batches, max_bytes=PAIR_SLICE):
                sets = list(shingle_sets(texts_of(part), size))
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
                grams = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets).view(np.int64)))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(np.diff(ends), pa.int64()), grams], names=[*part.schema.names[:-1], "n", "grams"])

        schema = ids.schema.simpleString()[len("struct<") : -1] + ",n:bigint,grams:array<bigint>"
        found = written(rows.mapInArrow(work, schema), "minhash-sets")
        wanted.done()
        discard(placed)
        return found


def labelled(rows: DataFrame, labels: DataFrame, on: str, out: str) -> DataFrame:
    """rows with ``out``: the label of column ``on``, itself where it has none."""
    named = labels.select(F.col("node").alias(on), F.col("label").alias("_label"))
    return rows.join(named, on, "left").withColumn(out, F.coalesce("_label", on)).drop("_label")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per document: n_shingles, component_id (the smallest id reachable over links) and
    kept (it is that id)."""
    corpus = Corpus(docs, size, percent)
    nodes = corpus.nodes
    n_tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = table_keys(nodes.repartition(n_tasks, "id")).groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count(F.lit(1)).alias("n"))
    buckets = written(buckets.where("lo < hi"), "minhash-buckets")
    large = buckets.where("n > 2").select("key", "lo")
    in_large = BitFilter(large, "key")
    met = table_keys(nodes, in_large).join(large, "key").where("id <> lo").select("id", "lo")
    met = met.unionByName(buckets.where("n = 2").select(F.col("hi").alias("id"), "lo"))
    met = written(met.groupBy("id", "lo").agg(F.count(F.lit(1)).alias("n")), "minhash-met")
    discard(buckets)

    first = met.groupBy("id").agg(F.max(F.struct("n", -F.col("lo"))).alias("best"))
    first = first.select(F.col("id").alias("a"), (-F.col("best.col2")).alias("b"))
    links = written(corpus.same_document().unionByName(corpus.links(first)), "minhash-links")
    labels = components(links)

    def linked_by(more: DataFrame) -> None:
        nonlocal labels
        if not more.isEmpty():  # the groups so far stand for the links so far
            labels = components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(more.select("a", "b")))

    crossing = labelled(labelled(met, labels, "id", "ca"), labels, "lo", "cb").where("ca <> cb").select(F.col("id").alias("a"), F.col("lo").alias("b"))
    linked_by(corpus.links(crossing.join(first, ["a", "b"], "left_anti")))

    marked = labelled(nodes, labels, "id", "label")
    mixed = table_keys(marked, in_large, "label").groupBy("key").agg(F.min("label").alias("_x"), F.max("label").alias("_y"), F.count(F.lit(1)).alias("_n"))
    mixed = written(mixed.where("_x <> _y and _n > 2").select("key"), "minhash-mixed")
    in_large.done()
    if not mixed.isEmpty():
        linked_by(family_links(corpus, mixed, lambda: labels, linked_by))
    labels = written(labels, "minhash-components")

    # a group's name is its smallest document id
    rows = labelled(corpus.rows, labels, "node", "group")
    least = rows.where("group is not null").groupBy("group").agg(F.min("doc_id").alias("least"))
    out = rows.join(least, "group", "left").select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def from_core(sets: DataFrame) -> DataFrame:
    """family, id, n, d and diff (see step 5) of the members of families."""
    sizes = sets.groupBy("family").agg(F.count(F.lit(1)).alias("_size"))
    counts = sets.select("family", F.explode("grams").alias("g")).groupBy("family", "g").agg(F.count(F.lit(1)).alias("c"))
    # a core holds no more than twice the mean number of shingles of its members
    cores = counts.join(sizes, "family").where(2 * F.col("c") > F.col("_size")).groupBy("family").agg(F.collect_list("g").alias("core"))
    cores = written(cores, "minhash-cores")
    if (cores.agg(F.sum(F.size("core"))).first()[0] or 0) <= CORE_GRAMS:
        cores = F.broadcast(cores)
    own, core = F.col("grams"), F.coalesce("core", F.array().cast("array<bigint>"))
    diff = F.concat(F.array_except(own, core), F.array_except(core, own))
    return sets.join(cores, "family", "left").select("family", "id", "n", diff.alias("diff")).withColumn("d", F.size("diff").cast("long"))


def combined(items: DataFrame) -> DataFrame:
    """family, id, key: one key per combination of ``width`` of a row's elements."""

    def work(batches):
        from itertools import combinations

        for batch in batches:
            family, ids, keys = [], [], []
            for f, i, elements, width in zip(*(column(batch, c).to_pylist() for c in ("family", "id", "es", "width"))):
                mine = np.array(list(combinations(sorted(elements), width)), np.int64).reshape(-1, width).view(np.uint64)
                key = np.zeros(len(mine), np.uint64)
                with np.errstate(over="ignore"):
                    for k in range(width):
                        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + mine[:, k])
                keys.append(key.view(np.int64))
                family.append(np.full(len(key), f, np.int64))
                ids.append(np.full(len(key), i, np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (family, ids, keys)], names=["family", "id", "key"])

    return items.select("family", "id", "es", "width").mapInArrow(work, "family bigint, id bigint, key bigint")


def differing(a: str, b: str) -> Column:
    """|x ^ y| of two members by their differences from the core of their family."""
    return F.size(F.col(a)) + F.size(F.col(b)) - 2 * F.size(F.array_intersect(a, b))


def family_links(corpus: Corpus, mixed: DataFrame, labels, linked_by) -> DataFrame:
    """Steps 5 and 6 for the buckets ``mixed``; the links of step 5 go to ``linked_by``, those
    of step 6 are returned."""
    more, less = 100 + corpus.percent, 100 - corpus.percent
    members = table_keys(corpus.nodes, BitFilter(mixed, "key")).join(mixed, "key", "left_semi")
    members = written(members, "minhash-members")
    tops = members.groupBy("key").agg(F.min("id").alias("b"))
    families = components(members.join(tops, "key").where("id <> b").select(F.col("id").alias("a"), "b").distinct())
    sets = corpus.sets(families.select(F.col("node").alias("id"), F.col("label").alias("family")))
    discard(members)
    slack = (F.col("d") * more - F.col("n") * less).alias("s")
    parted = written(from_core(sets).select("*", slack), "minhash-differences")
    discard(sets)

    closest = parted.groupBy("family").agg(F.min(F.struct("s", "id")).alias("m")).select("family", F.col("m.id").alias("b"))
    closest = closest.join(parted.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("diff").alias("diffb")), "b")
    spokes = parted.join(closest, "family").where((F.col("id") != F.col("b")) & (differing("diff", "diffb") * more <= (F.col("n") + F.col("nb")) * less))
    linked_by(written(spokes.select(F.col("id").alias("a"), "b"), "minhash-links"))

    grouped = labelled(parted, labels(), "id", "label")
    groups = grouped.groupBy("family", "label").agg(F.min("s").alias("s"))
    order = Window.partitionBy("family").orderBy("s", "label")
    least = groups.withColumn("place", F.row_number().over(order)).where("place <= 2").groupBy("family").agg(
        F.max(F.when(F.col("place") == 1, F.col("label"))).alias("l1"), F.min("s").alias("s1"), F.max(F.when(F.col("place") == 2, F.col("s"))).alias("s2")
    )
    alive = grouped.join(least.where("s2 is not null"), "family")
    alive = alive.withColumn("other", F.when(F.col("label") == F.col("l1"), F.col("s2")).otherwise(F.col("s1")))
    needed = F.greatest(F.lit(1), F.ceil((F.col("s") + F.col("other")) / (2 * more) - 1e-9), F.col("d") - F.expr(f"n * {less} div {corpus.percent}")).cast("long")
    alive = written(alive.select("family", "label", "id", "n", "d", "diff", needed.alias("o")), "minhash-alive")
    items = alive.select("family", "id", "o", F.explode("diff").alias("e"))
    counts = items.groupBy("family", "e").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    own = Window.partitionBy("id")
    items = items.join(counts, ["family", "e"]).withColumn("m", F.count(F.lit(1)).over(own)).where("m >= o")
    items = written(items.withColumn("r", F.row_number().over(own.orderBy("c", "e"))), "minhash-items")

    # the most elements that may be combined: all members of a family need as many, and none gets too many keys
    free = F.col("m") - F.col("o")
    keys2, keys3 = (free + 2) * (free + 1) / 2, (free + 3) * (free + 2) * (free + 1) / 6
    width = F.when((F.min("o") >= 3) & (F.max(keys3) <= KEYS), 3).when((F.min("o") >= 2) & (F.max(keys2) <= KEYS), 2).otherwise(1)
    widths = items.groupBy("family").agg(width.alias("width"))
    listed = items.join(widths, "family").where(F.col("r") <= free + F.col("width")).groupBy("family", "id", "m", "width").agg(F.collect_list("e").alias("es"))
    facts = alive.select("family", "id", "label", "n", "d")
    keyed = written(combined(listed).join(listed.select("id", "m"), "id").join(facts, ["family", "id"]), "minhash-keyed")
    one, two = (keyed.select("family", "key", *[F.col(c).alias(f"{c}{k}") for c in ("id", "label", "n", "d", "m")]) for k in "ab")
    apart = F.col("da") + F.col("db") - 2 * F.least("ma", "mb")  # the least their sets can differ by
    able = apart * more <= (F.col("na") + F.col("nb")) * less
    pairs = one.join(two, ["family", "key"]).where((F.col("ida") > F.col("idb")) & (F.col("labela") != F.col("labelb")) & able)
    pairs = written(pairs.select("ida", "idb", "na", "nb").distinct(), "minhash-pairs")
    diffs = alive.select("id", "diff")
    checked = pairs.join(diffs.select(F.col("id").alias("ida"), F.col("diff").alias("diffa")), "ida").join(diffs.select(F.col("id").alias("idb"), F.col("diff").alias("diffb")), "idb")
    checked = checked.where(differing("diffa", "diffb") * more <= (F.col("na") + F.col("nb")) * less)
    links = written(checked.select(F.col("ida").alias("a"), F.col("idb").alias("b")), "minhash-links")
    discard(parted, alive, items, keyed)
    return links


def drop_near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose document is the smallest id of its group; a row without
    id stays, rows repeated with one id stay together."""
    with made_tables() as made:
        copies = written(near_duplicates(docs, size, percent).where("not kept").select("doc_id").distinct(), "minhash-copies")
    discard(*[t for t in made if t is not copies])
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)
