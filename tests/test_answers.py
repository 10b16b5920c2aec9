"""Answer-extraction modes (ANS-1..6) against expected values worked out by hand
from the reference semantics."""

import pytest
from pyspark.sql import functions as F

from yardstick.functions import answers as A

CASES = [
    # content, contains, raw_tail, first_tag, word
    ("<reasoning>ok</reasoning>\nYes", "yes", "yes", "yes", "Yes"),
    ("<reasoning>bad</reasoning>No", "no", "no", "no", "No"),
    ("<reasoning>ok</reasoning>'Yes'", "yes", "'yes'", "yes", "Yes"),
    ("<reasoning>a</reasoning>Yes</REASONING> No", "no", "no", "yes</reasoning> no", "Yes"),
    ("Yes", "no", "yes", "no", "Yes"),
    ("yes", "yes", "yes", "no", "Unknown"),
    ("<reasoning>x</reasoning>eyes only", "yes", "eyes only", "eyes only", "Unknown"),
    ("<REASONING>x</REASONING>  yes ", "yes", "yes", "yes", "Unknown"),
    ("<reasoning>x</reasoning>ye's", "yes", "ye's", "yes", "Unknown"),
    ("No tag, Yesterday", "no", "no tag, yesterday", "no", "No"),
    ("No\u0301 Yes", "no", "no\u0301 yes", "no", "No"),  # a combining mark is not a word character
    ("\u00e9Yes", "no", "\u00e9yes", "no", "Unknown"),
    ("", None, None, "no", "Unknown"),
    (None, None, None, "no", "Unknown"),
]


@pytest.fixture(scope="module")
def results(spark):
    df = spark.createDataFrame([(i, c) for i, (c, *_rest) in enumerate(CASES)], "i int, c string")
    rows = df.select(
        "i",
        A.contains_answer("c").alias("contains"),
        A.raw_tail_answer("c").alias("raw_tail"),
        A.first_tag_answer("c").alias("first_tag"),
        A.word_answer("c").alias("word"),
    ).collect()
    return {r.i: r for r in rows}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_modes(results, i):
    _, contains, raw_tail, first_tag, word = CASES[i]
    r = results[i]
    assert r.contains == contains
    assert r.raw_tail == raw_tail
    assert r.first_tag == first_tag
    assert r.word == word


def test_json_label(spark):
    rows = [
        ('```json\n{"verdict": "fine", "recommendation": "acceptable"}\n```', True, "acceptable", "fine", True),
        ('{"verdict": "bad", "recommendation": "geometry_artifacts"}', True, "geometry_artifacts", "bad", False),
        ('{"verdict": "x", "recommendation": "not_a_label"}', True, "", "", False),
        ("this is not json", False, "", "", False),
    ]
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "i int, c string")
    got = {r.i: r for r in df.select("i", A.json_label_fields("c").alias("f")).select("i", "f.*").collect()}
    for i, (_, parsed, label, verdict, success) in enumerate(rows):
        assert got[i].parsed == parsed
        assert got[i].label == label
        assert got[i].verdict == verdict
        assert got[i].success == success
    assert got[3].recommendation == "ERROR"


def test_canonical_label(spark):
    df = spark.createDataFrame([(" 'Acceptable' ",), ('"WRONG_ORIENTATION"',)], "s string")
    assert [r[0] for r in df.select(A.canonical_label("s")).collect()] == ["acceptable", "wrong_orientation"]
