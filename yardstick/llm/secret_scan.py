"""Secret scans (operator 10): Aho-Corasick keyword prefilter, anchored regular
expressions only at keyword hits, then embedded checksums.

The automaton runs once over the ASCII-lower-cased text.  At a hit the kind's regular
expression is matched anchored at that position, never searched.  ``github`` and
``npm`` tokens carry a CRC-32 in their last six base-62 characters; a token whose
checksum is wrong is no secret.  ``hex`` runs have no literal to look for, so their
pattern is scanned directly.

Matching per kind is leftmost and non-overlapping, and a match that fails its length
rule is dropped after it has consumed its characters.

Defined cases: a null or empty text has no secrets; repeated rows are scanned one by
one; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import sys as _sys
import zlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import DataFrame

from .arrow_text import column, text_slices, texts_of

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

# The kinds in their listed order, keywords and anchored patterns.
BASE_KINDS = ("assign", "access", "hex")
KINDS = BASE_KINDS + ("github", "npm")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign", "api_key": "assign",
    "akia": "access",
    "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github",
    "npm_": "npm",
}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
MARK = "[SECRET]"

SCHEMA = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"


def checksum_ok(body: str) -> bool:
    """The last six base-62 characters are the CRC-32 of the rest."""
    value = zlib.crc32(body[:-6].encode("ascii"))
    digits = ""
    while value:
        value, d = divmod(value, 62)
        digits = BASE62[d] + digits
    return digits.rjust(6, "0") == body[-6:]


class Scanner:
    def __init__(self):
        import ahocorasick

        self.machine = ahocorasick.Automaton()
        for word, kind in KEYWORDS.items():
            self.machine.add_word(word, (kind, len(word)))
        self.machine.make_automaton()
        assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
        access = re.compile(r"AKIA[A-Z0-9]+")
        self.anchored = {
            "assign": (assign, lambda m: len(m.group(2)) >= 6),
            "access": (access, lambda m: len(m.group(0)) >= 20),
            "github": (re.compile(r"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"), lambda m: checksum_ok(m.group(1))),
            "npm": (re.compile(r"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"), lambda m: checksum_ok(m.group(1))),
        }
        self.hex = re.compile(r"[0-9a-f]{24,}")

    def scan(self, text: str, lowered: str) -> list[tuple[int, int, int]]:
        """(start, kind number, end) of every secret, in start order and then as listed."""
        found, done = [], {}
        hits = sorted((end - size + 1, kind) for end, (kind, size) in self.machine.iter(lowered))
        for start, kind in hits:
            if start < done.get(kind, 0):
                continue
            pattern, valid = self.anchored[kind]
            if m := pattern.match(text, start):
                done[kind] = m.end()
                if valid(m):
                    found.append((start, KINDS.index(kind), m.end()))
        k = KINDS.index("hex")
        found.extend((m.start(), k, m.end()) for m in self.hex.finditer(text))
        return sorted(found)


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def redact(text: str, spans, mark: str = MARK) -> str:
    """The text with every span, overlapping ones merged, replaced by ``mark``."""
    out, at = [], 0
    for a, _, b in spans:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def secret_scan(docs: DataFrame) -> DataFrame:
    """Per document the counts of the base kinds, the digest of their spans and all spans."""

    def work(batches):
        scanner = Scanner()
        for part in text_slices(batches):
            texts = texts_of(part)
            rows = []
            for text, low in zip(texts.to_pylist(), pc.ascii_lower(texts).to_pylist()):
                spans = scanner.scan(text, low)
                base = [s for s in spans if s[1] < len(BASE_KINDS)]
                counts = [sum(s[1] == k for s in base) for k in range(len(BASE_KINDS))]
                rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            cols = list(zip(*rows))
            types = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id"), *(pa.array(c, t) for c, t in zip(cols, types))],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(work, SCHEMA)


def redact_secrets(docs: DataFrame, mark: str = MARK) -> DataFrame:
    """The same rows and columns with every secret in ``text`` replaced by ``mark``;
    ``n_chars``, if there, follows the new text of a changed row.  A null text stays null."""
    at = docs.columns.index("text")
    counted = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def work(batches):
        scanner = Scanner()
        for part in text_slices(batches):
            texts = texts_of(part)
            null = part.column(at).is_null().to_pylist()
            n_chars = part.column(counted).to_pylist() if counted is not None else None
            out = []
            for i, (text, low) in enumerate(zip(texts.to_pylist(), pc.ascii_lower(texts).to_pylist())):
                spans = scanner.scan(text, low)
                out.append(None if null[i] else redact(text, spans, mark))
                if spans and n_chars is not None:
                    n_chars[i] = len(out[-1])
            arrays = list(part.columns)
            arrays[at] = pa.array(out, part.column(at).type)
            if counted is not None:
                arrays[counted] = pa.array(n_chars, part.column(counted).type)
            yield pa.RecordBatch.from_arrays(arrays, names=part.schema.names)

    return docs.mapInArrow(work, docs.schema)
