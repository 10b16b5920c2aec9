"""Operators 5 and 6 against brute force, hot groups, chains and odd rows."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from llm_cases import ODD, SPACE_WORD, clashing, empty, low, odd, rows

from yardstick.llm import minhash, queries, unit_dedup
from yardstick.llm.components import components
from yardstick.llm.tables import BitFilter, holds, xxhash64_longs


def shingles(text, size):
    w = SPACE_WORD.findall(low(text))
    k = min(size, len(w))
    return frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if k else frozenset()


def groups(docs, size, percent=80):
    """(doc_id, n_shingles, component, kept) by comparing all documents that share a shingle."""
    sets, up = {}, {}
    for i, text in docs:
        sets[i] = shingles(text, size)
        up[i] = i

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def link(a, b):
        a, b = sorted((top(a), top(b)))
        up[b] = a

    first = {}
    for i, s in sets.items():
        if s:
            link(i, first.setdefault(s, i))
    df = Counter(g for s in first for g in s)
    having = defaultdict(list)
    for s, i in sorted(first.items(), key=lambda x: (len(x[0]), x[1])):
        rare = sorted(s, key=lambda g: (df[g], g))[: len(s) - -(-len(s) * percent // 100) + 1]
        for j in {j for g in rare for j in having[g]}:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                link(i, j)
        for g in rare:
            having[g].append(i)
    return [(i, len(s), top(i), top(i) == i) for i, s in sets.items()]


def test_components_and_filters(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1040)]
    up = {x: x for p in pairs for x in p}
    for _ in range(300):
        for a, b in pairs:
            up[a] = up[b] = min(up[a], up[b])
    nodes = {x for a, b in pairs if a != b for x in (a, b)}
    found = {r.node: r.label for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert found == {x: up[x] for x in nodes}
    values = [0, 1, -7, 1 << 60, 12345]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    assert [r[0] for r in df.selectExpr("xxhash64(v)").collect()] == xxhash64_longs(np.array(values)).view(np.int64).tolist()
    bits = BitFilter(df, "v").shared.value
    assert holds(bits, np.array(values)).all() and holds(bits, np.arange(100, 1100)).mean() < 0.15 and len(bits) < 100
    many = spark.range(0, 3_000_000, 7)
    bits = BitFilter(many, "id").shared.value
    assert holds(bits, np.arange(0, 3_000_000, 7)).all() and len(bits) == 1 << 20
    assert holds(bits, np.arange(3_000_000, 3_100_000)).mean() < 0.12


def test_near_duplicates_equal_brute_force(spark, sf_mid):
    want = groups([(d["doc_id"], d["text"]) for d in rows(sf_mid)], 2)
    got = [tuple(r) for r in queries.op5_minhash_dedup(spark, sf_mid).collect()]
    assert sorted(got) == sorted(want)
    assert sum(not w[3] for w in want) > 50


def near_copies(n, rng, swap):
    """A chain: each text changes ``swap`` words of the one before it."""
    text = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    for _ in range(n):
        yield " ".join(text)
        for _ in range(swap):
            text[rng.randrange(len(text))] = f"w{rng.randrange(10**6)}"


def test_chains_and_hot_groups(spark):
    """Links of a chain whose ends differ, one large group of near copies, one of exact ones."""
    rng = random.Random(4)
    docs = [(1000 + k, t) for k, t in enumerate(near_copies(25, rng, 3))]
    body = [f"h{k}" for k in range(200)]
    docs += [(5000 + k, " ".join([*body, f"tail{k}"])) for k in range(400)]
    docs += [(9000 - k, "the very same text again and again") for k in range(500)]
    docs += [(20000 + k, f"only{k} text{k} of{k} its{k} own{k}") for k in range(300)]
    rng.shuffle(docs)
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6)
    want = sorted(groups(docs, 2))
    assert sorted(tuple(r) for r in minhash.near_duplicates(table, size=2).collect()) == want
    assert len({w[2] for w in want if 1000 <= w[0] < 2000}) < 25


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_of_odd_rows(spark, size):
    want = groups([(d[0], d[1]) for d in ODD if d[0] is not None], size)
    want = Counter([*want, want[[w[0] for w in want].index(9)]])  # id 9 is there twice
    docs = odd(spark) if size == 2 else clashing(spark)
    got = minhash.near_duplicates(docs, size).collect()
    assert Counter(tuple(r) for r in got if r.doc_id is not None) == want
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]


def test_dropping_near_duplicates(spark):
    want = groups([(d[0], d[1]) for d in ODD if d[0] is not None], 5)
    want = Counter([*want, want[[w[0] for w in want].index(9)]])
    kept = minhash.drop_near_duplicates(clashing(spark))
    assert kept.columns == clashing(spark).columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([None, *(w[0] for w in want.elements() if w[3])])
    assert minhash.near_duplicates(empty(spark)).count() == 0


def test_keys_miss_few_similar_sets():
    """At similarity 0.8 a pair shares no key with probability 2 (1 - 0.8^3)^12, under 0.05 %."""
    rng = np.random.default_rng(1)
    flips, odds = minhash.hash_functions()
    missed = 0
    for _ in range(300):
        both = rng.integers(0, 1 << 63, 80, np.uint64)
        a, b = (minhash.group_keys(np.concatenate([both, rng.integers(0, 1 << 63, 10, np.uint64)]), flips, odds).reshape(2, -1) for _ in range(2))
        missed += not ((a[0] == b[0]).any() and (a[1] == b[1]).any())
    assert missed <= 2


# --- operator 6 ----------------------------------------------------------------------


def cut(text):
    """(first word, end word, starts a line, ends a line) of the units by a plain scan."""
    words = [(m.start(), m.end(), low(m.group())) for m in SPACE_WORD.finditer(text)]
    ends_line = [k + 1 == len(words) or "\n" in text[words[k][1] : words[k + 1][0]] for k in range(len(words))]
    sentences, start = [], 0
    for k, w in enumerate(words):
        if ends_line[k] or w[2][-1] in ".!?":
            sentences.append((start, k + 1))
            start = k + 1
    for a, b in [*sentences, *([(start, len(words))] if start < len(words) else [])]:
        at = a
        for k in range(a, b):
            if k + 1 == b or (b - a > unit_dedup.SENTENCE and xxhash.xxh64_intdigest(words[k][2]) % unit_dedup.ANCHORS == 0):
                yield at, k + 1, at == 0 or ends_line[at - 1], ends_line[k]
                at = k + 1


def runs(docs, min_words=unit_dedup.MIN_WORDS, line_words=unit_dedup.LINE_WORDS):
    words, units, first = {}, {}, {}
    for i, text in sorted((i, t) for i, t in docs if i is not None and t is not None):
        words[i] = [low(w) for w in SPACE_WORD.findall(text)]
        units[i] = list(cut(text))
        for pos, (a, b, *_) in enumerate(units[i]):
            first.setdefault(tuple(words[i][a:b]), (i, pos))

    def agree(x, y):
        k = 0
        while k < min(len(x), len(y)) and x[k] == y[k]:
            k += 1
        return k

    for i, own in units.items():
        spans, mine, far = [], words[i], unit_dedup.CONTEXT
        again = [k for k, u in enumerate(own) if first[tuple(mine[u[0] : u[1]])] != (i, k)]
        while again:
            n = next((n for n in range(1, len(again)) if again[n] != again[0] + n), len(again))
            part, again = [own[k] for k in again[:n]], again[n:]
            kept = [first[tuple(mine[u[0] : u[1]])] for u in part]
            (j, p), (l, q) = kept[0], kept[-1]
            ka, kb = units[j][p][0], units[l][q][1]
            a, b = part[0][0], part[-1][1]
            lines = part[0][2] and part[-1][3] and b - a >= line_words
            if b - a < unit_dedup.SEED_WORDS and not lines:
                continue
            a, b = a - agree(mine[max(0, a - far) : a][::-1], words[j][max(0, ka - far) : ka][::-1]), b + agree(mine[b : b + far], words[l][kb : kb + far])
            spans.append((a, b, n, {k[0] for k in kept}, lines))
        apart = []
        for s in sorted(spans, key=lambda s: s[:2]):
            if apart and s[0] <= apart[-1][1]:
                t = apart.pop()
                s = (t[0], max(t[1], s[1]), t[2] + s[2], t[3] | s[3], t[4] or s[4])
            apart.append(s)
        spans = apart
        text = dict(docs)[i]
        places = [m.span() for m in SPACE_WORD.finditer(text)]
        spans = [s for s in spans if s[1] - s[0] >= min_words or s[4]]
        left, at = "", 0
        for a, b, *_ in spans:
            left, at = left + text[at : places[a][0]], places[b - 1][1]
        digest = hashlib.sha256((left + text[at:]).encode()).hexdigest()
        for a, b, n, who, _ in spans:
            yield i, places[a][0], places[b - 1][1], n, b - a, min(who), sorted(who), digest


def found_runs(docs, *more):
    return sorted(tuple(r) for r in unit_dedup.repeated_runs(docs, *more).collect())


def test_units_of_hard_texts(monkeypatch):
    texts = ["A b. C d!? e.f g.\nh... i\n\n.. .\n3.14 is pi. End", "...", "no end", "a.\x0bb.  c", "\n\n", "x.y.z. w", "!a b? ", "", "e.g. 1.5!x.", None]
    texts += ["".join(random.Random(k).choices("abc .!?\n\té", k=90)) for k in range(300)]
    for sentence in (20, 2):
        monkeypatch.setattr(unit_dedup, "SENTENCE", sentence)
        batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
        u = unit_dedup.Units(unit_dedup.texts_of(batch))
        text_of = u.text_of[u.starts]
        for k, t in enumerate(texts):
            got = [(int(a - u.bounds[k]), int(b - u.bounds[k])) for a, b in zip(u.starts[text_of == k], u.stops[text_of == k])]
            assert got == [c[:2] for c in cut(t or "")], t
    d1, d2 = u.digests()
    units = [tuple(u.hashes[a:b].tolist()) for a, b in zip(u.starts, u.stops)]
    assert len(set(zip(d1.tolist(), d2.tolist()))) == len(set(zip(d1.tolist()))) == len(set(units))


def test_runs_equal_brute_force(spark, sf_mid):
    docs = [(d["doc_id"], d["text"]) for d in rows(sf_mid)]
    want = sorted(runs(docs))
    assert sorted(tuple(r) for r in queries.op6_substring_dedup(spark, sf_mid).collect()) == want and len(want) > 20


def test_runs_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(unit_dedup, "SEED_WORDS", 1)
    docs = [(d[0], d[1]) for d in dict.fromkeys((d[0], d[1]) for d in ODD)]
    for table in (odd(spark), clashing(spark)):
        for n in (1, 3):
            want = list(runs(docs, n, 99))
            assert found_runs(table, n, 99) == sorted([*want, *[w for w in want if w[0] == 9]])  # row 9 is there twice
    assert unit_dedup.repeated_runs(empty(spark)).count() == 0


def test_passages_are_caught_to_their_edges_and_clean_texts_left(spark):
    rng = random.Random(8)
    sentence = lambda n: " ".join(f"v{rng.randrange(10**6)}" for _ in range(n)) + "."
    passage = " ".join(sentence(rng.randint(8, 14)) for _ in range(6))
    plain = " ".join(f"u{rng.randrange(10**6)}" for _ in range(60))
    line = sentence(20)
    docs = [(k, " ".join([sentence(9), sentence(12)[:-1], passage, sentence(7)]) + "\n" + sentence(20)) for k in range(150)]
    docs += [(1000 + k, "\n".join(["A common short line.", sentence(30), sentence(12)])) for k in range(200)]
    docs += [(2000 + k, sentence(40)[:-1] + " " + plain + " " + sentence(30)) for k in range(50)]
    docs += [(3000 + k, sentence(30) + "\n" + line + "\n" + sentence(30)) for k in range(50)]
    texts = dict(docs)
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    found = unit_dedup.repeated_runs(table).collect()
    cuts = {r.doc_id: texts[r.doc_id][r.start : r.stop] for r in found}
    assert sorted(cuts) == sorted([*range(1, 150), *range(2001, 2050), *range(3001, 3050)]) and len(found) == len(cuts)
    for k, c in cuts.items():
        assert c == (passage if k < 1000 else plain if k < 3000 else line)
    left = {r.doc_id: r.text for r in unit_dedup.remove_runs(table, unit_dedup.word_runs(table)).collect()}
    assert left == {k: texts[k].replace(c, "") for k, c in cuts.items()}
    assert all(r.left_sha256 == hashlib.sha256(left[r.doc_id].encode()).hexdigest() and r.kept_doc_id in (0, 2000, 3000) for r in found)


def test_different_texts_under_one_id(spark):
    rng = random.Random(1)
    words = lambda n: " ".join(f"q{rng.randrange(10**6)}" for _ in range(n))
    shared = words(40) + "."
    table = spark.createDataFrame([(1, shared), (2, words(5) + ". " + shared), (2, words(50) + ". " + shared + " " + words(60))], "doc_id bigint, text string")
    found = unit_dedup.repeated_runs(table).collect()
    assert sorted((r.doc_id, r.stop - r.start, r.kept_doc_id) for r in found) == [(2, len(shared), 1)] * 2


def test_ids_with_several_texts_and_rows_without_id(spark):
    """Rows of one id are one document: (1, t) and (8, u) meet in id 7, which has both texts."""
    t, u, v = "the first text of them all", "another text that is not alike", "a third one here"
    table = [(1, t), (7, u), (7, t), (8, u), (None, t), (9, v), (9, v), (9, v), (10, v)]
    got = sorted(tuple(r) for r in minhash.near_duplicates(spark.createDataFrame(table, "doc_id bigint, text string"), size=2).collect() if r.doc_id is not None)
    n = lambda x: len(shingles(x, 2))
    assert got == sorted([(1, n(t), 1, True), (7, n(u), 1, False), (7, n(t), 1, False), (8, n(u), 1, False), *[(9, n(v), 9, True)] * 3, (10, n(v), 9, False)])


def family(rng, n, words, changed):
    """Near copies of one text: each has ``changed`` of its words replaced, from few words."""
    body = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    for _ in range(n):
        text = list(body)
        for k in rng.sample(range(words), changed):
            text[k] = f"z{rng.randrange(300)}"
        yield " ".join(text)


@pytest.mark.parametrize("changed", [4, 6, 9])
def test_a_family_below_and_around_the_threshold(spark, changed, monkeypatch):
    rng = random.Random(changed)
    docs = list(enumerate(family(rng, 400, 150, changed)))
    docs += [(1000 + k, t) for k, t in enumerate(family(rng, 60, 40, 2))]
    compared = []
    kept = minhash.written

    def counting(df, name, *more):
        out = kept(df, name, *more)
        if name == "minhash-pairs":
            compared.append(out.count())
        return out

    monkeypatch.setattr(minhash, "written", counting)
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    assert sorted(tuple(r) for r in minhash.near_duplicates(table, size=2).collect()) == sorted(groups(docs, 2))
    if changed == 9:  # too far apart to be linked: hardly a pair is named
        assert compared[-1] <= 4 * len(docs), compared
    assert compared[-1] <= 400 * 399 / 2 / 4, compared


def test_tables_of_a_stage_are_deleted(spark, sf_small):
    import os

    from yardstick.llm import kn_quality
    from yardstick.session import checkpoint_dir

    root = checkpoint_dir(spark).removeprefix("file:")
    docs, labels = (spark.read.parquet(f"{sf_small}/{t}.parquet") for t in ("documents", "labels"))
    before = set(os.listdir(root))
    assert minhash.drop_near_duplicates(docs).count() <= docs.count()
    assert kn_quality.keep_good(docs, labels).count() <= docs.count()
    left = {x.rsplit("-", 1)[0] for x in set(os.listdir(root)) - before}
    assert {x for x in left if x.startswith(("minhash", "kn", "components"))} <= {"minhash-copies", "kn-limits", "components"}


def test_a_star_takes_one_round(spark, monkeypatch):
    from yardstick.llm import components as parts

    rounds, write = [], parts.written
    monkeypatch.setattr(parts, "written", lambda df, name: rounds.append(name) or write(df, name))
    edges = spark.createDataFrame([(k, 1) for k in range(2, 9)] + [(20, 12)], "a bigint, b bigint")
    found = {r.node: r.label for r in parts.components(edges).collect()}
    assert found == {k: 1 for k in range(1, 9)} | {12: 12, 20: 12} and len(rounds) == 1
