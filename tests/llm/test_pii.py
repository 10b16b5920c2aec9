"""Operator 11: patterns against plain regular expressions, the model against the sum over
all labellings, and entities that the patterns cannot part."""

import hashlib
import math
import random
import re
import time
from itertools import product

import pytest
from llm_cases import ODD, clashing, empty, odd, rows, same_rows

from yardstick.llm import pii, queries

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def digits(t):
    return re.sub("[^0-9]", "", t)


def sound(kind, t):
    n = len(digits(t))
    if kind == "ip":
        return all(int(p) <= 255 for p in t.split("."))
    if kind == "card":
        values = [int(c) for c in digits(t)][::-1]
        return 14 <= n <= 19 and (sum(values[::2]) + sum((2 * v) // 10 + (2 * v) % 10 for v in values[1::2])) % 10 == 0
    return kind == "email" or 10 <= n <= 15


def plain(text):
    found = [(m.start(), k, m.end()) for k, name in enumerate(PLAIN) for m in re.finditer(PLAIN[name], text or "") if sound(name, m[0])]
    return sorted(found)


def joined(spans):
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b, *_ in spans)


def base_row(i, text):
    spans = plain(text)
    return (i, *(sum(k == s[1] for s in spans) for k in range(4)), hashlib.sha256(joined(spans).encode()).hexdigest())


@pytest.fixture(scope="module")
def weights(spark, sf_mid):
    return pii.train(pii.training_sample(spark.read.parquet(f"{sf_mid}/documents.parquet")))


def test_base_columns_on_the_data(spark, sf_mid):
    got = queries.op11_pii(spark, sf_mid).collect()
    docs = rows(sf_mid)
    assert same_rows([tuple(r)[:6] for r in got], [base_row(r["doc_id"], r["text"]) for r in docs])
    texts = {r["doc_id"]: r["text"] for r in docs}
    for r in got:
        base = joined(plain(texts[r["doc_id"]]))
        assert set(filter(None, base.split(","))) <= set(r["spans"].split(","))


def test_patterns_on_random_strings():
    rng = random.Random(11)
    for alphabet in ("a1@.-", "0123456789 -", "+1 ().-", "12.3", "25.0 +-(@a", "é٣a@b.c1"):
        for _ in range(4000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))
            assert sorted(pii.base_spans(text)) == plain(text), text


def test_patterns_take_linear_time():
    started = time.time()
    for text in ("a" * 400_000, "1" * 400_000, "+1" * 200_000, "1." * 200_000, "@" * 100_000, "a@" * 100_000, "a@b" * 100_000, "+1" + " " * 400_000, "0" * 5000 + ".1.2.3"):
        pii.base_spans(text)
    assert time.time() - started < 20


def every_labelling(n, candidates):
    """All sets of candidates that do not overlap."""
    for chosen in product((0, 1), repeat=len(candidates)):
        spans = sorted(c for c, x in zip(candidates, chosen) if x)
        if all(a[1] <= b[0] for a, b in zip(spans, spans[1:])):
            yield chosen


def test_sums_and_best_labelling_by_enumeration():
    rng = random.Random(5)
    for _ in range(150):
        n = rng.randrange(1, 9)
        cands = sorted({(i, j, k) for i, j, k in ((rng.randrange(n), rng.randrange(1, n + 1), rng.randrange(4)) for _ in range(9)) if i < j}, key=lambda s: (s[1], s[0], s[2]))
        scores = [rng.uniform(-3, 3) for _ in cands]
        total, best, mass = 0.0, (-1.0, None), [0.0] * len(cands)
        for chosen in every_labelling(n, cands):
            s = sum(x for x, c in zip(scores, chosen) if c)
            total += math.exp(s)
            best = max(best, (s, chosen))
            mass = [m + math.exp(s) * c for m, c in zip(mass, chosen)]
        z, p = pii.marginals(n, [c[:2] for c in cands], scores)
        assert math.isclose(z, math.log(total), abs_tol=1e-9)
        assert all(math.isclose(a, b / total, abs_tol=1e-9) for a, b in zip(p, mass))
        assert pii.best_labelling(n, cands, scores) == [c for c, x in zip(cands, best[1]) if x]


def card(rng):
    body = "".join(rng.choice("0123456789") for _ in range(15))
    return next(body + d for d in "0123456789" if pii.luhn(body + d))


def test_touching_entities_are_parted(weights):
    rng = random.Random(3)
    model = pii.Recogniser(weights)
    make = {
        "card": lambda: card(rng),
        "phone": lambda: f"+1 ({rng.randrange(1000):03}) 555-{rng.randrange(10000):04}",
        "ip": lambda: f"{rng.randrange(11, 256)}.{rng.randrange(256)}.{rng.randrange(256)}.{rng.randrange(10, 256)}",
        "email": lambda: f"word.{rng.randrange(10, 99)}@mail{rng.randrange(9)}.example.com",
    }
    caught = hidden = 0
    for _ in range(300):
        kinds = [rng.choice(list(make)) for _ in range(2)]
        text, truth = "Some words ", set()
        for kind in kinds:
            span = make[kind]()
            truth.add((len(text), pii.KINDS.index(kind), len(text) + len(span)))
            text += span + " "
        found = {s[:3] for s in model.spans(text + "and words")}
        by_pattern = set(plain(text + "and words"))
        hidden += len(truth - by_pattern)
        caught += len((truth & found) - by_pattern)
    assert hidden > 40 and caught >= 0.9 * hidden


def test_nothing_is_added_to_clean_numbers(weights):
    rng = random.Random(4)
    model = pii.Recogniser(weights)
    added = 0
    for _ in range(400):
        number = card(rng)
        wrong = number[:-1] + str((int(number[-1]) + rng.randrange(1, 10)) % 10)
        text = f"order {wrong} of 2024 at 10:30, version 1.2.3 and user@host, {rng.randrange(10**6)} units"
        added += len([s for s in model.spans(text) if not s[3]])
    assert added <= 4


def test_model_finds_unseen_entities_by_itself(weights, sf_mid):
    """The labels come from the patterns; the model agrees on documents as a whole."""
    model = pii.Recogniser(weights)
    texts = [r["text"] or "" for r in rows("/root/testdata/sf0.1")][-5000:]
    want = [(i, *s) for i, t in enumerate(texts) for s in plain(t)]
    got = {(i, *s) for i, t in enumerate(texts) for s in model.segments(t)}
    assert len(want) > 200 and sum(w in got for w in want) >= 0.97 * len(want)


def test_odd_rows(spark):
    more = [(30, "call +1 (555) 123-4567 or mail a.b@c.example.org\n10.0.0.1", "en", "a"), (31, "９９ ٣٣٣٣٣٣٣٣ ²²²²²²²²²@x.y.z 𝟙𝟚𝟛 𝒳 1.1.1.1", "en", "a"), (32, "1 " * 30000 + "@" * 200, "en", "a")]
    table = odd(spark).union(spark.createDataFrame(more, odd(spark).schema))
    got = pii.find_pii(table).collect()
    assert same_rows([tuple(r)[:6] for r in got], [base_row(r[0], r[1]) for r in ODD + more])
    clash = pii.find_pii(clashing(spark).selectExpr("*", "'k' as kinds", "'i' as island", "1 as spans", "2 as n_ip"))
    assert same_rows([tuple(r)[:6] for r in clash.collect()], [base_row(r[0], r[1]) for r in ODD])
    assert clash.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    assert pii.find_pii(empty(spark)).collect() == []
    assert pii.train([]) == {}


def test_sample_is_bounded_and_the_same_each_time(spark, sf_mid, monkeypatch):
    docs = spark.read.parquet(f"{sf_mid}/documents.parquet")
    monkeypatch.setattr(pii, "MAX_PER_KIND", 7)
    a, b = pii.training_sample(docs), pii.training_sample(docs.repartition(5))
    assert a == b and 7 < len(a) <= 7 * 16
