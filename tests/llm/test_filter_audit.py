"""Operator 13 against every order played out document by document."""

import re
from collections import Counter
from itertools import permutations

import pytest
from llm_cases import ODD, SCHEMA, SPACE_WORD, clashing, empty, odd, rows, same_rows

from yardstick.llm.filter_audit import filter_audit

COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
LABELS = "doc_id bigint, quality int, toxic int"
ODD_LABELS = [(1, 1, 0), (1, 0, 1), (2, None, None), (4, 1, None), (9, 1, 1), (None, 1, 1), (99, 1, 1)]


def fails(docs):
    first = {}
    for d in docs:
        if d["doc_id"] is not None:
            t = d["text"] or ""
            first[t] = min(first.get(t, d["doc_id"]), d["doc_id"])
    for d in docs:
        t = d["text"] or ""
        w = SPACE_WORD.findall(t)
        found = "A" * (len(w) < 50) + "B" * (100 * len(set(w)) < 65 * len(w)) + "C" * (100 * len(re.findall("[A-Z]", t)) > 5 * len(t))
        found += "D" * bool(re.search("[#$%&*|]", t)) + "E" * (d["doc_id"] is not None and first[t] < d["doc_id"])
        yield d["source"] or "", d["doc_id"], found


def played(docs, labels):
    good = {r[0] for r in labels if r[1] == 1 and r[0] is not None}
    toxic = {r[0] for r in labels if r[2] == 1 and r[0] is not None}
    parts = {}
    for part, i, found in fails(docs):
        parts.setdefault(part, []).append((found, i in good, i in toxic))
    out = []
    for part, members in parts.items():
        mine, shapley = [], Counter()
        for order in map("".join, permutations("ABCDE")):
            left = members
            for k, f in enumerate(order, 1):
                gone = [m for m in left if f in m[0]]
                left = [m for m in left if f not in m[0]]
                failing = sum(f in m[0] for m in members)
                shapley[f] += len(gone)
                unique = sum(m[0] == f for m in members)
                mine.append([part, order, k, len(left), len(gone), failing - len(gone), unique, sum(m[1] for m in gone), sum(m[2] for m in gone), f])
        out += [(*m[:-1], shapley[m[-1]]) for m in mine]
    return out


def result(docs, labels):
    return [tuple(r) for r in filter_audit(docs, labels).select(*COLUMNS).collect()]


def test_equals_every_order_played_out(spark, sf_mid):
    docs = spark.read.parquet(f"{sf_mid}/documents.parquet")
    labels = spark.read.parquet(f"{sf_mid}/labels.parquet")
    want = played(rows(sf_mid), [(r["doc_id"], r["quality"], r["toxic"]) for r in rows(sf_mid, "labels")])
    assert same_rows(result(docs, labels), want)


def test_odd_rows_and_labels(spark):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    labels = spark.createDataFrame(ODD_LABELS, LABELS)
    want = played([dict(zip(names, r)) for r in ODD], ODD_LABELS)
    assert same_rows(result(odd(spark), labels), want)
    clash = labels.selectExpr("*", "1 as n", "'x' as part", "2 as mask", "true as good", "3 as id")
    more = clashing(spark).selectExpr("*", "5 as n", "'x' as part", "7 as mask", "'d' as digest", "1 as total")
    assert same_rows(result(more, clash), want)


def test_empty_tables(spark):
    labels = spark.createDataFrame([], LABELS)
    assert result(empty(spark), labels) == []
    got = result(spark.createDataFrame([(1, None, None, None)], SCHEMA), labels)
    assert len(got) == 600 and {r[0] for r in got} == {""}
    assert {r[-1] for r in got} == {120, 0}


@pytest.mark.parametrize("copies", [3000])
def test_a_text_that_most_rows_share(spark, copies):
    table = [(i, "same " * 60, "en", "hot") for i in range(copies)] + [(copies + i, f"text {i} #", "en", "cold") for i in range(10)]
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    want = played([dict(zip(names, r)) for r in table], [])
    assert same_rows(result(spark.createDataFrame(table, SCHEMA), spark.createDataFrame([], LABELS)), want)
