"""Odd document tables and brute-force helpers shared by the tests of this folder."""

import re

import pyarrow.parquet as pq

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

ODD = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away from the big bad wolf today", "en", "a"),
    (2, "the QUICK brown fox jumps over the lazy dog and runs far away from the big bad wolf today", "en", "a"),
    (3, None, "en", None),
    (4, "", None, "b"),
    (5, " \t\n\x0b\x0c\r ", "de", "b"),
    (6, "word", "fr", "b"),
    (7, "a\xa0b　c café é İstanbul ſecret", "xx", "c"),
    (8, "x " * 5000 + "y" * 9000, "en", "c"),
    (9, "same line here\nsame line here\n\n#*$%&|<> same line here", "en", "c"),
    (9, "same line here\nsame line here\n\n#*$%&|<> same line here", "en", "c"),
    (None, "a row without id", "en", "c"),
    (-5, "negative id and a, b; c! d? e: f", "es", None),
    (1 << 40, "the quick brown fox jumps over the lazy dog and runs far away from the big bad wolf tonight", "en", "a"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"
CLASHING = "words bigint, n_words string, key string, id string, label string, kept string, size string, shard string, unit string, node string, rep string, _text string"


def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).repartition(3)


def clashing(spark):
    """The odd rows with extra columns whose names the operators use themselves."""
    names = [c.split()[0] for c in CLASHING.split(", ")]
    return odd(spark).selectExpr("*", *[f"{'7' if n == 'words' else repr('z')} as {n}" for n in names])


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(sf_dir, table="documents"):
    return pq.read_table(f"{sf_dir}/{table}.parquet").to_pylist()


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def same_rows(a, b):
    key = lambda r: repr(tuple(r))
    return sorted(map(key, a)) == sorted(map(key, b))
