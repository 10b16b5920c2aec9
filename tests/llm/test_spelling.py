"""Operator 12 against deletion neighbourhoods in plain Python."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import ODD, SCHEMA, clashing, empty, low, odd, rows, same_rows

from yardstick.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counts(docs):
    n = Counter()
    for i, text in docs:
        for run in map(low, RUN.findall(text or "")):
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def near_words(n):
    """Two words are one edit apart if one is the other less a letter, or if both lose the
    same place and differ in it."""
    same_place = defaultdict(set)
    near = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            same_place[i, w[:i], w[i + 1 :]].add(w)
            less = w[:i] + w[i + 1 :]
            if less in n:
                near[w].add(less)
                near[less].add(w)
    for group in same_place.values():
        for w in group:
            near[w] |= group - {w}
    return near


def variants(docs):
    n = counts(docs)
    near = near_words(n)
    form = {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda v: (-n[v], v))
            if n[best] >= 10 * n[w]:
                form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, n[w], len(near[w]), form.get(w), n[form[w]] if w in form else None, root))
    return out


def result(docs, **more):
    return [tuple(r) for r in spelling.spelling_variants(docs, **more).select("word", "n", "n_near", "form", "form_n", "root").collect()]


def test_equals_brute_force(spark, sf_mid):
    docs = [(r["doc_id"], r["text"]) for r in rows(sf_mid)]
    want = variants(docs)
    assert any(r[3] for r in want) and any(r[2] > 3 for r in want)
    assert same_rows(result(spark.read.parquet(f"{sf_mid}/documents.parquet")), want)


@pytest.mark.parametrize("limit", [0, 3, 10**9])
def test_group_size_does_not_change_the_result(spark, limit):
    rng = random.Random(limit)
    words = set()
    for stem in ("ofthematter", "ándolasñü", "aaaaaaaa", "abababab", "responsibilities" * 3):
        words.add(stem)
        for _ in range(60):
            w = list(stem)
            for _ in range(rng.randint(1, 3)):
                k = rng.randrange(len(w))
                rng.choice([lambda: w.insert(k, rng.choice("abcé")), lambda: w.__setitem__(k, rng.choice("abcé")), lambda: w.pop(k)])()
            words.add("".join(w))
    docs = [(None, " ".join([w] * rng.choice([2, 3, 25, 400]))) for w in sorted(words)]
    got = result(spark.createDataFrame(docs, "doc_id bigint, text string"), limit=limit)
    assert same_rows(got, variants(docs))


def test_roots_follow_a_chain_to_its_end(spark):
    chain = [("abcdefgh", 2), ("abcdefghi", 20), ("abcdefghij", 200), ("abcdefghijk", 2000), ("abcdefghijkl", 20000)]
    docs = spark.createDataFrame([(None, " ".join([w] * n)) for w, n in chain], "doc_id bigint, text string")
    got = {r[0]: (r[3], r[5]) for r in result(docs)}
    assert {r[1] for r in got.values()} == {"abcdefghijkl"}
    assert got["abcdefgh"][0] == "abcdefghi" and got["abcdefghijkl"][0] is None


def test_odd_rows(spark):
    more = [(i, t, "en", "c") for i, t in [(20, "İstanbulites istanbulites İstanbulites"), (21, "×÷ÀÿŸabcdefg ÀÿabcdefgŸ"), (22, "a" * 70000 + " " + "A" * 70000), (23, "b" * 65 + " " + "b" * 65 + " " + "c" * 64 + " " + "c" * 64)]]
    want = variants([(r[0], r[1]) for r in ODD + more])
    table = odd(spark).union(spark.createDataFrame(more, SCHEMA))
    assert same_rows(result(table), want)
    clash = clashing(spark).selectExpr("*", "'w' as word", "'n' as n", "1 as extra", "2 as lo", "'r' as root")
    assert same_rows(result(clash), variants([(r[0], r[1]) for r in ODD]))
    assert result(empty(spark)) == []


def test_crc_of_ragged_runs():
    rng = random.Random(1)
    parts = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 7, 63, 64, 65, 300]))) for _ in range(200)]
    lengths = np.array([len(p) for p in parts])
    starts = np.cumsum(lengths) - lengths
    seeds = [zlib.crc32(str(k).encode()) for k in range(200)]
    got = spelling.crc32_runs(np.frombuffer(b"".join(parts), np.uint8), starts, lengths, np.array(seeds, np.uint32), spelling.crc_table())
    assert got.tolist() == [zlib.crc32(p, s) for p, s in zip(parts, seeds)]


def test_runs_break_at_text_ends():
    texts = pa.array(["abcdefgh", "ijklmnop", "", "éabcdefÿ", "abc defghijk"], pa.large_string())
    got = spelling.counted(texts, [None] * 5)
    assert sorted(zip(*[c.to_pylist() for c in got.columns])) == [("abcdefgh", 1), ("defghijk", 1), ("ijklmnop", 1), ("éabcdefÿ", 1)]
