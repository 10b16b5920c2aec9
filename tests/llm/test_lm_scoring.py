"""Operator 3: base figures against brute force, proper probabilities, seating, odd rows."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import ODD, SPACE_WORD, clashing, empty, low, odd, rows

from yardstick.llm import lm_scoring, queries


def base(docs):
    tokens = [SPACE_WORD.findall(low(t)) + [None] for _, t in docs]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in docs]
    count = Counter(w for t, h in zip(tokens, held) if not h for w in t)
    n, v = sum(count.values()), len(count)
    for (i, _), t, h in zip(docs, tokens, held):
        yield i, h, len(t), sum(count[w] > 0 for w in t), n, sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)


def assert_base(found, docs):
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    found, want = sorted(found, key=key), sorted(base(docs), key=key)
    assert len(found) == len(want)
    for r, w in zip(found, want):
        assert tuple(r)[:5] == w[:5] and r.base_score == pytest.approx(w[5], rel=1e-9, abs=1e-9)


def test_scores_of_the_corpus(spark, sf_mid):
    found = queries.op3_lm_scoring(spark, sf_mid).collect()
    assert_base(found, [(d["doc_id"], d["text"]) for d in rows(sf_mid)])
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.1 * sum(r.n_tokens for r in held)


def test_odd_rows_small_units_and_many_slices(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "UNIT_BYTES", 100)
    for docs in (odd(spark), clashing(spark)):
        found = lm_scoring.hpy_scores(docs).collect()
        assert_base(found, [(d[0], d[1]) for d in ODD])
        assert all(math.isfinite(r.score) and r.score < 0 for r in found)
    assert lm_scoring.hpy_scores(empty(spark)).count() == 0


def test_only_held_out_rows(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    r = lm_scoring.hpy_scores(spark.createDataFrame([(held, "a b")], "doc_id bigint, text string")).first()
    assert (r.n_known, r.train_tokens, r.score, r.base_score) == (0, 0, 0.0, 0.0)


def test_probabilities_sum_to_one(spark):
    """All words end alike, so there are two restaurants: the start and that ending."""
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 1]
    train = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 != 1]
    words = ["xa", "ya", "za", "wa"]
    docs = [(i, " ".join(words[(i * k) % 4] for k in range(1, 2 + i % 7))) for i in train[:60]]
    unknown = "ua"
    asked = ["", *words, unknown, *(f"xa {w}" for w in [*words, unknown])]
    docs += list(zip(held, asked))
    found = {r.doc_id: 10.0**r.score for r in lm_scoring.hpy_scores(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    p = dict(zip(asked, (found[i] for i in held)))
    after = sum(p[f"xa {w}"] / p["xa"] for w in [*words, unknown])
    end = 1.0 - after  # of the end after the ending
    assert 0 < end < 1
    assert p[""] + sum(p[w] / end for w in [*words, unknown]) == pytest.approx(1.0, abs=1e-5)


def test_seating_follows_the_exact_distribution():
    """Tables of four customers of one dish, against all seatings enumerated."""
    theta, d, others, parent = 1.0, 0.6, 5, 0.3

    def weight(seating):  # customer k joins the table of a label or opens the next one
        w, sizes = 1.0, []
        for label in seating:
            if label == len(sizes):
                w *= (theta + d * (others + len(sizes))) * parent
                sizes.append(1)
            else:
                w *= sizes[label] - d
                sizes[label] += 1
        return w, len(sizes)

    want = Counter()
    for s in itertools.product(range(4), repeat=4):
        if all(label <= max(s[:k], default=-1) + 1 for k, label in enumerate(s)):
            w, t = weight(s)
            want[t] += w
    total = sum(want.values())
    n = 200_000
    ones = np.ones(n, np.int64)
    got = Counter(lm_scoring.seat(np.random.default_rng(1), 4 * ones, np.full(n, math.log(parent)), theta, d, others * ones, lm_scoring.log_stirling(d)).tolist())
    for t in range(1, 5):
        assert got[t] / n == pytest.approx(want[t] / total, abs=0.005)


def test_large_dishes_keep_their_bounds():
    c = np.array([1, 2, 33, 1000, 10**6])
    t = lm_scoring.seat(np.random.default_rng(1), c, np.log(np.full(5, 0.01)), 1.0, 0.7, np.full(5, 100), lm_scoring.log_stirling(0.7))
    assert (t >= 1).all() and (t <= c).all() and t[4] > t[2]


def plain_scores(docs, sweeps=60, burn_in=20, seed=3):
    """Scores by a plain Gibbs sampler that moves one customer at a time: dictionaries of
    table sizes, one restaurant per context class below one parent."""
    import random

    rng = random.Random(seed)
    texts = [[low(w) for w in SPACE_WORD.findall(t)] + [""] for _, t in docs]
    held = [zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in docs]
    pairs = [[(lm_scoring.ending(u) if k else lm_scoring.START, w) for k, (u, w) in enumerate(zip(["", *t], t))] for t in texts]
    customers = [p for t, h in zip(pairs, held) if not h for p in t]
    counts = Counter(customers)
    known = {w for _, w in customers}
    contexts = Counter(len({c for c, x in counts if x == w}) for w in known)
    ratio = lambda a, b: min(0.95, max(0.05, a / (a + 2 * b) if a else 0.5))
    ones = Counter(counts.values())
    d, d0, theta, base = ratio(ones[1], ones[2]), ratio(contexts[1], contexts[2]), lm_scoring.THETA, 1 / (len(known) + 1)
    tables = {p: [] for p in counts}  # sizes of the tables of a dish in a context
    root = {w: [] for w in known}
    t_c, n_c, t_root, n_root = Counter(), Counter(), 0, 0

    def parent(w):
        return (sum(root.get(w, ())) - d0 * len(root.get(w, ())) + (theta + d0 * t_root) * base) / (theta + n_root)

    def chance(c, w):
        own = tables.get((c, w), [])
        return (sum(own) - d * len(own) + (theta + d * t_c[c]) * parent(w)) / (theta + n_c[c])

    def place(sizes, new, discount):
        weights = [s - discount for s in sizes] + [new]
        k = rng.choices(range(len(weights)), weights)[0]
        if k < len(sizes):
            sizes[k] += 1
            return False
        sizes.append(1)
        return True

    def leave(sizes):
        k = rng.choices(range(len(sizes)), sizes)[0]
        sizes[k] -= 1
        if not sizes[k]:
            del sizes[k]
            return True
        return False

    sums = [[0.0] * len(t) for t in pairs]
    for sweep in range(sweeps):
        for c, w in customers:
            if sweep:
                n_c[c] -= 1
                if leave(tables[c, w]):
                    t_c[c] -= 1
                    n_root -= 1
                    t_root -= leave(root[w])
            if place(tables[c, w], (theta + d * t_c[c]) * parent(w), d):
                t_c[c] += 1
                t_root += place(root[w], (theta + d0 * t_root) * base, d0)
                n_root += 1
            n_c[c] += 1
        if sweep >= burn_in:
            for row, t in zip(sums, pairs):
                for k, (c, w) in enumerate(t):
                    row[k] += chance(c, w)
    return [sum(math.log10(x / (sweeps - burn_in)) for x in row) for row in sums]


def test_scores_agree_with_a_plain_sampler(spark):
    import random

    rng = random.Random(2)
    vocabulary = ["".join(rng.choices("abcdefgh", k=3)) for _ in range(40)]
    after = {w: rng.sample(vocabulary, 3) for w in vocabulary}
    docs = []
    for i in range(150):
        words = [rng.choice(vocabulary)]
        while len(words) < rng.randint(3, 25):
            words.append(rng.choice(after[words[-1]] if rng.random() < 0.7 else vocabulary))
        docs.append((i, " ".join(words)))
    want = plain_scores(docs)
    found = {r.doc_id: r for r in lm_scoring.hpy_scores(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    for held in (True, False):
        mine = [(found[i].score, s) for (i, _), s in zip(docs, want) if found[i].held_out == held]
        assert sum(a for a, _ in mine) == pytest.approx(sum(b for _, b in mine), rel=0.02)
        assert all(a == pytest.approx(b, rel=0.08) for a, b in mine)


def test_every_word_before_has_a_restaurant_of_its_own(spark, tmp_path, monkeypatch):
    """The query against the plain sampler with word contexts; all words end alike."""
    import random

    monkeypatch.setattr(lm_scoring, "ending", lm_scoring.last_word)  # of the plain sampler
    monkeypatch.setattr(lm_scoring, "START", "")
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abcdefgh", k=3)) + "s" for _ in range(30)]
    after = {w: rng.sample(vocabulary, 2) for w in vocabulary}
    docs = []
    for i in range(200):
        words = [rng.choice(vocabulary)]
        while len(words) < rng.randint(3, 30):
            words.append(rng.choice(after[words[-1]] if rng.random() < 0.8 else vocabulary))
        docs.append((i, " ".join(words)))
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want = plain_scores(docs)
    found = {r.doc_id: r for r in queries.op3_lm_scoring(spark, str(tmp_path)).collect()}
    for held in (True, False):
        mine = [(found[i].score, s) for (i, _), s in zip(docs, want) if found[i].held_out == held]
        assert sum(a for a, _ in mine) == pytest.approx(sum(b for _, b in mine), rel=0.02)
        assert all(a == pytest.approx(b, rel=0.08) for a, b in mine)


def test_numbers_survive_their_planes():
    for x in ([], [0, 0], [5, 0, 255, 256, 70_000, 2**40]):
        assert lm_scoring.numbers(lm_scoring.planes(np.array(x, np.int64))).tolist() == x
    keys = np.array([3, 2**40, 2**63 + 1, 2**64 - 1], np.uint64)
    assert lm_scoring.risen_keys(lm_scoring.rising(keys)).tolist() == keys.tolist()


def test_the_rows_of_a_unit_take_little_memory_beside_it():
    import tracemalloc

    import pyarrow as pa

    rng = random.Random(5)
    texts = [" ".join(f"w{int(rng.paretovariate(0.4)) % 9_000}" for _ in range(500)) for _ in range(600)]
    unit = lm_scoring.Unit(0, 8, lm_scoring.last_word)
    unit.add(list(range(len(texts))), pa.array(texts, pa.large_string()))
    tokens = sum(len(c) for c in unit.codes)
    tracemalloc.start()
    try:
        found = sum(len(row[3]) > 0 for row in unit.rows())
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == 1 + 8
    assert peak < 40 * tokens, peak / tokens
