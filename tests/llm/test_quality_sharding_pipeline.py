"""Operators 7 and 9 and the pipeline."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import CLASHING, ODD, SPACE_WORD, clashing, empty, low, odd, rows

import corpus_pipeline
from yardstick.llm import kn_quality, queries, sharding
from yardstick.llm.bpe import bpe_encode
from yardstick.llm.decontaminate import decontaminate
from yardstick.llm.minhash import near_duplicates
from yardstick.llm.secret_scan import secret_scan


def kneser_ney(texts, order=3):
    """Log10 probability of a token list, from plain dictionaries."""
    counts = [None, *(Counter() for _ in range(order))]
    for t in texts:
        w = ["<s>"] * (order - 1) + SPACE_WORD.findall(low(t)) + ["</s>"]
        counts[order].update(tuple(w[k - order + 1 : k + 1]) for k in range(order - 1, len(w)))
    for n in range(order - 1, 0, -1):
        counts[n].update(g[1:] for g in counts[n + 1])
    cut, context = {}, {}
    for n in range(1, order + 1):
        of = Counter(min(v, 4) for v in counts[n].values())
        n1, n2, n3, n4 = (max(1, of[k]) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        cut[n] = [min(k - 0.05, max(0.05, k - (k + 1) * y * b / a)) for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
        context[n] = defaultdict(lambda: [0, 0.0])
        for g, v in counts[n].items():
            context[n][g[:-1]][0] += v
            context[n][g[:-1]][1] += cut[n][min(v, 3) - 1]

    def score(text):
        w = ["<s>"] * (order - 1) + SPACE_WORD.findall(low(text)) + ["</s>"]
        total = 0.0
        for k in range(order - 1, len(w)):
            p = 1.0 / (len(counts[1]) + 1)
            for n in range(1, order + 1):
                g = tuple(w[k - n + 1 : k + 1])
                if g[:-1] in context[n]:
                    v, (tot, mass) = counts[n].get(g, 0), context[n][g[:-1]]
                    p = ((v - cut[n][min(v, 3) - 1]) if v else 0.0) / tot + mass / tot * p
            total += math.log10(p)
        return total, len(w) - order + 1

    return score


def test_perplexity_equals_plain_kneser_ney(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    train = [r.text for r in kn_quality.sample(docs, labels).where("not held").collect()]
    assert 20 < len(train) <= kn_quality.MAX_TRAIN_DOCS
    score = kneser_ney(train)
    texts = {d["doc_id"]: d["text"] for d in rows(sf_small)}
    for r in kn_quality.classify(docs, labels).collect():
        log10, n = score(texts[r.doc_id])
        assert r.n_tokens == n and r.perplexity == pytest.approx(10 ** (-log10 / n), rel=1e-9)
        assert r.kept == (r.perplexity <= r.threshold)


def test_classifier_keeps_good_rows(spark, sf_mid):
    labels = {r["doc_id"]: r["quality"] for r in rows(sf_mid, "labels")}
    found = queries.op7_quality_classifier(spark, sf_mid).collect()
    assert len(found) == len(rows(sf_mid))
    seen = Counter((labels[r.doc_id], r.kept) for r in found if r.doc_id in labels)
    assert seen[(1, False)] <= 0.01 * seen[(1, True)]
    assert seen[(0, False)] >= 0.5 * (seen[(0, True)] + seen[(0, False)])


def test_classifier_on_odd_rows(spark, sf_small):
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    base = spark.read.parquet(f"{sf_small}/documents.parquet").drop("n_chars")
    own = [c.split()[0] for c in CLASHING.split(", ")]
    for extra in (clashing(spark),):
        shifted = extra.selectExpr("cast(doc_id - 10000000 as bigint) doc_id", "text", "lang", "source", *[c for c in extra.columns if c in own])
        found = kn_quality.classify(base.unionByName(shifted, allowMissingColumns=True), labels)
        got = [r for r in found.collect() if r.doc_id is None or r.doc_id < 0 or r.doc_id > 1 << 39]
        assert len(got) == len(ODD) and all(math.isfinite(r.perplexity) and r.threshold > 0 for r in got)
        assert all(r.n_tokens == 1 for r in got if r.doc_id in (3 - 10000000, 4 - 10000000, 5 - 10000000))
        kept = kn_quality.keep_good(base.unionByName(shifted, allowMissingColumns=True), labels)
        assert kept.count() == found.where("kept").count()
    none = labels.limit(0)
    assert all(r.kept and r.perplexity is None for r in kn_quality.classify(odd(spark), none).collect())
    assert kn_quality.keep_good(clashing(spark), none).count() == len(ODD)
    assert kn_quality.classify(empty(spark), labels).count() == 0
    assert kn_quality.keep_good(empty(spark), labels).columns == empty(spark).columns


def test_whole_model_equals_plain_kneser_ney_of_all_good_rows(spark, sf_small, monkeypatch):
    # small units and shards, and a sample that would hold next to nothing
    from yardstick.llm import kn_spread

    monkeypatch.setattr(kn_quality, "MAX_TRAIN_CHARS", 20_000)
    monkeypatch.setattr(kn_spread, "UNIT_BYTES", 20_000)
    monkeypatch.setattr(kn_spread, "SLICE", 10_000)
    monkeypatch.setattr(kn_spread, "SHARD_BYTES", 30_000)
    marks = defaultdict(lambda: [9, 0])
    for r in rows(sf_small, "labels"):
        marks[r["doc_id"]] = [min(marks[r["doc_id"]][0], r["quality"]), max(marks[r["doc_id"]][1], r["toxic"])]
    good = {i for i, (q, t) in marks.items() if q == 1 and t == 0}
    texts = {d["doc_id"]: d["text"] for d in rows(sf_small)}
    train = [t for i, t in texts.items() if i in good and zlib.crc32(str(i).encode()) % 4 != 0]
    assert sum(map(len, train)) > 20_000
    score = kneser_ney(train)
    found = queries.op7_quality_classifier(spark, sf_small).collect()
    assert sorted(r.doc_id for r in found) == sorted(texts)
    for r in found:
        log10, n = score(texts[r.doc_id])
        assert r.n_tokens == n and r.perplexity == pytest.approx(10 ** (-log10 / n), rel=1e-9)
        assert r.kept == (r.perplexity <= r.threshold)


def test_whole_model_is_not_shuffled_by_the_questions(spark):
    from yardstick.llm import kn_spread

    docs = spark.createDataFrame([(i, "en", i, f"a b w{i % 7} c w{i % 3}") for i in range(60)], "doc_id long, lang string, row long, text string")
    model = kn_spread.Spread(docs.select("text"), 4 * kn_spread.SHARD_BYTES)
    told = kn_spread.answered(docs, model)
    plan = told._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # of the questions
    assert sorted(r.kind for r in told.collect()).count("docs") == len({r.unit for r in told.collect()})
    assert {r.shard for r in model.rows.collect()} == set(range(4))
    listed = {t.listed for t in model.made}
    assert listed <= {t.name for t in spark.catalog.listTables()}
    model.done()
    assert not listed & {t.name for t in spark.catalog.listTables()}


def test_trigrams_lie_in_the_shard_of_their_bigram():
    from yardstick.llm import kn_spread

    words = np.random.default_rng(7).integers(1, 1 << 63, (3, 2000)).astype(np.uint64)
    words[0, :500], words[:, 500:600] = words[0, 0], words[:, 700:800]
    shard = lambda keys, k: np.searchsorted(kn_spread.shard_cuts(np.sort(keys), k), np.argsort(np.argsort(keys, kind="stable"), kind="stable"), side="right") - 1
    keys = kn_spread.key_of(words)
    for shards in (4, 7, 1000):
        assert (shard(keys, shards) == shard(kn_spread.key_of(words[1:]), shards)).all()
    assert len(set(keys.tolist())) == len({tuple(w) for w in words.T.tolist()})


def test_counting_takes_little_memory_beside_its_words(monkeypatch):
    import random
    import tracemalloc

    import pyarrow as pa

    from yardstick.llm import kn_spread

    rng = random.Random(5)
    texts = [" ".join(f"w{int(rng.paretovariate(0.4)) % 9_000}" for _ in range(500)) for _ in range(1200)]
    tokens = 501 * len(texts)
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])

    class Works:
        def select(self, *columns):
            return self

        def mapInArrow(self, work, schema):
            return work

    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(kn_spread, "TaskContext", Task)
    work = kn_spread.counted(Works(), 1)
    list(work(iter([batch.slice(0, 10)])))  # what is loaded once does not count
    tracemalloc.start()
    try:
        packed = [b.column(3)[0].as_py() for b in work(iter([batch]))]
        counting = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        table = pa.table({"shard": pa.array([0] * 2 * len(packed), pa.int64()), "payload": pa.array(packed * 2, pa.binary())})
        made = kn_spread.merged(1)(table)
        merging = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    sums = made.column("sums")[0].as_py()
    assert sums[4] == 2 * tokens and sums[0] == sums[2] == 0  # every trigram occurs twice, four times or more often
    assert counting < 60 * tokens, counting / tokens
    assert merging < 62 * tokens, merging / tokens


def test_whole_classifier_on_odd_rows(spark, sf_small):
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    base = spark.read.parquet(f"{sf_small}/documents.parquet").drop("n_chars")
    own = [c.split()[0] for c in CLASHING.split(", ")]
    extra = clashing(spark)
    shifted = extra.selectExpr("cast(doc_id - 10000000 as bigint) doc_id", "text", "lang", "source", *[c for c in extra.columns if c in own])
    docs = base.unionByName(shifted, allowMissingColumns=True)
    docs = docs.unionByName(docs.where("doc_id % 3 = 0"))  # rows given twice
    cells = lambda t: sorted((str(r.doc_id), r.n_tokens, round(r.perplexity, 6), round(r.threshold, 6), r.kept) for r in t.collect())
    found = kn_quality.classify(docs, labels, whole=True)
    assert cells(found) == cells(kn_quality.classify(docs, labels))  # everything fits into the sample here
    kept = kn_quality.keep_good(docs, labels, whole=True)
    assert kept.columns == docs.columns and kept.count() == found.where("kept").count()
    none = labels.limit(0)
    assert all(r.kept and r.perplexity is None for r in kn_quality.classify(odd(spark), none, whole=True).collect())
    assert kn_quality.keep_good(clashing(spark), none, whole=True).count() == len(ODD)
    assert kn_quality.keep_good(empty(spark), labels, whole=True).columns == empty(spark).columns


def trusted(n, lang="en", first=0):
    return [(first + k, f"good plain words of text {k % 7} and more words {k % 11} to read", lang) for k in range(n)]


def labelled_docs(spark, docs, marks=None):
    table = spark.createDataFrame(docs, "doc_id bigint, text string, lang string").repartition(3)
    return table, spark.createDataFrame(marks or [(d[0], 1, 0) for d in docs], "doc_id bigint, quality int, toxic int")


def test_a_long_trusted_row_leaves_the_classifier_on(spark, monkeypatch):
    """The row that hashes first in either part is over the whole bound."""
    monkeypatch.setattr(kn_quality, "MAX_TRAIN_CHARS", 20_000)
    docs = trusted(400)
    order = spark.createDataFrame(docs, "doc_id bigint, text string, lang string").selectExpr("doc_id", "xxhash64(doc_id) h", "crc32(cast(doc_id as string)) % 4 = 0 held").orderBy("h").collect()
    long = {next(r.doc_id for r in order if r.held == held) for held in (True, False)}
    docs = [(i, f"{t} " * 900 if i in long else t, lang) for i, t, lang in docs]
    junk = [(10_000 + k, f"zq{k} xj{k} vv{k} kk{k} " * 20, "en") for k in range(50)]
    table, labels = labelled_docs(spark, docs + junk, [(d[0], 1, 0) for d in docs])
    found = kn_quality.classify(table, labels).collect()
    assert all(r.perplexity is not None and r.threshold is not None for r in found)
    assert not any(r.kept for r in found if r.doc_id >= 10_000)
    train = kn_quality.sample(table, labels).where("not held").collect()
    assert 0 < sum(len(r.text) for r in train) <= 20_000 and not long & {r.doc_id for r in train}


def test_trusted_rows_of_which_none_fits_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(kn_quality, "MAX_TRAIN_CHARS", 10)
    table, labels = labelled_docs(spark, trusted(40))
    for use in (kn_quality.classify, kn_quality.keep_good):
        with pytest.raises(ValueError, match="trusted rows"):
            use(table, labels)


def test_thresholds_come_from_all_trusted_rows_outside_the_sample(spark, monkeypatch):
    """The sample is a small part of the rows, and one language is a fiftieth of them."""
    monkeypatch.setattr(kn_quality, "MAX_TRAIN_CHARS", 20_000)
    monkeypatch.setattr(kn_quality, "MAX_TRAIN_DOCS", 200)
    docs = trusted(4000) + [(10_000 + k, f"gute einfache worte in text {k % 13} und mehr davon {k}", "de") for k in range(80)]
    table, labels = labelled_docs(spark, docs)
    picked = kn_quality.sample(table, labels).where("not held").collect()
    by = Counter(r.lang for r in picked)
    assert len(picked) <= 200 and sum(len(r.text) for r in picked) <= 20_000 and 45 <= by["de"] <= 80
    model, limits, every = kn_quality.fit(table, labels)
    assert {r["_lang"] for r in limits.collect()} == ({"en", "de"} if 80 - by["de"] >= kn_quality.MIN_HELD_OUT else {"en"})
    marks = kn_quality.marks_of(labels).where("good")
    held = kn_quality.held_scores(table, marks, kn_quality.sample(table, labels), model).collect()
    assert Counter(r.doc_id for r in held) == Counter({d[0] for d in docs} - {r.doc_id for r in picked})


def test_limits_use_the_bad_rows_and_hold_the_quantile(spark):
    """Brute force over the spreads; the bad rows are long and just above the good ones."""
    rng = random.Random(5)
    held = []
    for k in range(900):
        n = rng.choice([4, 16, 100, 400])
        good = k % 3 > 0
        x = (3.0 if good else 3.35) + rng.gauss(0, 1.0) / math.sqrt(n)
        held.append((k, rng.choice(["en", "de"]), n, -x * n, good))
    table = spark.createDataFrame(held, "doc_id bigint, lang string, n_tokens bigint, log10_prob double, good boolean").repartition(4)
    found = {r["lang"]: r for r in kn_quality.limits_of(table, ["lang"]).collect()}
    for lang in ("en", "de"):
        z = {s: [(-p / n - s / math.sqrt(n), g) for _, w, n, p, g in held if w == lang] for s in kn_quality.SPREADS}
        rejected = {}
        for s, v in z.items():
            good = sorted(math.floor(a * kn_quality.STEPS) for a, g in v if g)
            q = (good[math.ceil(kn_quality.QUANTILE * len(good)) - 1] + 1) / kn_quality.STEPS
            rejected[s] = sum(a >= q for a, g in v if not g), q
        best = max(rejected, key=lambda s: (rejected[s][0], -abs(s - kn_quality.SPREAD)))
        assert (found[lang]["_spread"], found[lang]["_q"]) == (best, pytest.approx(rejected[best][1], abs=1e-12))
        assert sum(a > found[lang]["_q"] for a, g in z[best] if g) <= 0.005 * found[lang]["_n"]
        assert rejected[best][0] > rejected[0][0]


# --- operator 9 ----------------------------------------------------------------------


def assert_shards(found, docs, shards, slack):
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in docs)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == want
    by = defaultdict(list)
    for r in found:
        by[r.shard].append(r)
        assert r.law == "bytes" and r.grown_shard is None
    assert all(sorted(r.slot for r in x) == list(range(len(x))) for x in by.values())
    total = sum(r["size"] for r in found)
    sizes = [sum(r["size"] for r in by[k]) for k in range(shards)]
    assert max(sizes) - min(sizes) <= slack * total / shards + 2 * max(r["size"] for r in found)


def test_shards_of_the_corpus_have_equal_bytes(spark, sf_mid):
    found = queries.op9_sharding(spark, sf_mid).collect()
    assert_shards(found, [(d["doc_id"], d["text"]) for d in rows(sf_mid)], 24, 0.01)


def test_shards_with_one_hot_source_and_odd_rows(spark):
    docs = [(k, f"text {k} " * (k % 5 + 1), "en", "hot" if k % 3 else f"s{k % 7}") for k in range(3000)]
    table = spark.createDataFrame([*docs, *ODD], "doc_id bigint, text string, lang string, source string").repartition(4)
    found = sharding.kd_shards(table, 7, ["source", "lang", "size", "doc_id"]).collect()
    assert_shards(found, [d[:2] for d in [*docs, *ODD]], 7, 0.02)
    assert sharding.kd_shards(clashing(spark), 3, ["source"]).count() == len(ODD)
    assert sharding.kd_shards(empty(spark), 24, ["source"]).count() == 0


def plain_tree(rows, n_dims, shards, first=0):
    """(row number, shard) by a k-d tree over lists: the widest dimension, the weighted median
    at the row edge nearest to the wanted weight."""
    if shards == 1 or not rows:
        return [(r["row"], first) for r in rows]
    value = lambda r, i: r[f"_k{i}"] >> sharding.TIE_BITS
    dim = max(range(n_dims), key=lambda i: (max(value(r, i) for r in rows) - min(value(r, i) for r in rows), -i))
    by_key = defaultdict(list)
    for r in rows:
        by_key[r[f"_k{dim}"]].append(r)
    want, before, left = sum(r["size"] for r in rows) * (shards // 2) / shards, 0, []
    for key in sorted(by_key):
        w = sum(r["size"] for r in by_key[key])
        if before + w > want:
            if want - before > before + w - want:
                left += by_key[key]
            break
        left += by_key[key]
        before += w
    numbers = {r["row"] for r in left}
    right = [r for r in rows if r["row"] not in numbers]
    return plain_tree(left, n_dims, shards // 2, first) + plain_tree(right, n_dims, shards - shards // 2, first + shards // 2)


@pytest.mark.parametrize("shards,hot", [(2, 0), (7, 0), (7, 3), (24, 2)])
def test_shards_equal_a_plain_tree(spark, shards, hot):
    rng = random.Random(shards + hot)
    docs = [(k, "x" * rng.randrange(60), rng.choice("ab"), "hot" if hot and k % hot else f"s{rng.randrange(9)}") for k in range(400)]
    docs += [(None, "no id", None, None), (7, "again", "a", "s1"), (7, "again", "a", "s1")]
    table = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string")
    dims = ["lang", "source", "size", "doc_id"]
    keys = [r.asDict() | {"row": k} for k, r in enumerate(sharding.scaled(sharding.rows_of(table, dims), len(dims)).collect())]
    want = {(keys[k]["doc_id"], keys[k]["size"], shard) for k, shard in plain_tree(keys, len(dims), shards)}
    found = sharding.kd_shards(table, shards, dims).collect()
    assert {(r.doc_id, r["size"], r.shard) for r in found} == want


def test_sharding_runs_without_python(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    plan = sharding.scaled(sharding.rows_of(docs, ["lang", "source", "size", "doc_id"]), 4)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_sharding_sends_no_rows_through_python(spark, sf_small, monkeypatch):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")

    def refuse(*_, **__):
        raise AssertionError("rows made in Python are read by Python workers")

    monkeypatch.setattr(type(spark.sparkContext), "parallelize", refuse)
    monkeypatch.setattr(type(spark), "createDataFrame", refuse)
    assert sharding.kd_shards(docs, 5, ["lang", "size"]).count() == docs.count()


# --- pipeline ------------------------------------------------------------------------


def test_pipeline_equals_its_operators_one_by_one(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    left = {r.doc_id for r in kn_quality.classify(docs, spark.read.parquet(f"{sf_small}/labels.parquet")).collect() if r.kept}
    assert 0 < len(left) < len(text)
    now = docs.where(docs.doc_id.isin(list(left)))
    left = {r.doc_id for r in near_duplicates(now).collect() if r.kept}
    now = now.where(now.doc_id.isin(list(left)))
    left = {r.doc_id for r in decontaminate(now, spark.read.parquet(f"{sf_small}/benchmark.parquet")).collect() if not r.contaminated}
    now = now.where(now.doc_id.isin(list(left)))
    import public_tokenizers

    clean = corpus_pipeline.secret_scans(spark, now, sf_small)
    assert not any(r.n_assign + r.n_access + r.n_hex for r in secret_scan(clean).collect())
    want = bpe_encode(clean, public_tokenizers.path("word_bpe_49k.json")).collect()
    assert sorted(corpus_pipeline.run(spark, sf_small).collect()) == sorted(want)


def test_stages_take_odd_rows(spark, sf_small):
    docs = clashing(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_small)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns, name
        assert out.count() <= len(ODD)
