"""Personal data (operator 11): fixed patterns, and a semi-Markov conditional random field
that scores whole spans and chooses their boundaries and types together.

Patterns (the base) are matched leftmost and without overlap per kind, over the whole text
and in time linear in its length: an email is found from its ``@``, an ip from the start
of a run of digits.  A match that fails its rule is dropped after it has used its
characters; two entities that touch can so hide each other (a phone before a card is one
match with too many digits).  That is what the model is for.

Model.  Only *islands* of a text can hold a span: stretches of digits with few separators
between them, and the surroundings of an ``@``.  An island is cut into tokens (a run of
digits, a run of letters, one other character).  A segment is a stretch of at most
``MAX_TOKENS`` tokens with a kind; the features look at the whole segment (number and
grouping of digits, separators, check digit, octets, labels of a domain) and at the
characters on both sides.  A labelling covers the island with segments and single outside
tokens, its probability is proportional to the exponential of its segments' scores.
Viterbi over token positions, with segments of bounded length, finds the best labelling
in time linear in the island.

Training.  Labels come from the patterns, on a bounded sample: per kind (and for islands
without a span) the ``MAX_PER_KIND`` distinct islands of up to ``MAX_TRAIN_CHARS``
characters that come first in hash order.  Islands in which the patterns are unsure
(overlapping spans, too many digits in one match) are left out, and pairs of the others are
joined by a space to teach touching entities, whose true spans are known by construction.
Damaged copies of spans (another last digit, an octet of 999, a domain without dots, no
plus sign), labelled by the patterns again, teach what is none.
Weights maximise the likelihood, by forward and backward sums over segments.

How it is spread: two maps over the texts, one for the islands and one for the spans; only
the bounded sample meets the driver, and the weights are sent with the tasks.

Defined cases: a null or empty text has no spans; repeated rows are searched one by one; a
kind that the sample does not show is found by its pattern only; an empty table gives an
empty result; extra columns are ignored; positions are code points, the end exclusive.
"""

from __future__ import annotations

import math
import re
import sys as _sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrow_text import column, text_slices, texts_of

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

# The kinds in their listed order and the patterns.
KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
ADDRESS = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
NUMBER = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
CALL = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

TRIGGER = re.compile(r"[0-9@]")
STRETCH = re.compile(r"[+(]?[0-9](?:[\x20().+-]{0,3}[0-9])*+")
AROUND = "\\s@<>()\\[\\]\",;:"
BEFORE_AT = re.compile(rf"[^{AROUND}]*\Z")
AFTER_AT = re.compile(rf"@[^{AROUND}]{{0,128}}")
BEFORE = 64  # characters of an island before an @
TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|.", re.S)

MAX_TOKENS = 32
MAX_PER_KIND = 800
MAX_TRAIN_CHARS = 200
ROUNDS = 60
L2 = 0.05

SPANS = "doc_id bigint, spans array<struct<start: int, kind: string, end: int, base: boolean>>"


# --- patterns ------------------------------------------------------------------------


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def emails(text: str):
    at = text.find("@")
    done = 0
    while at >= 0:
        start = done + len(text[done:at].rstrip(LOCAL))
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
        done = m.end() if m else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns, in order of kind."""
    found = [(a, EMAIL, b) for a, b in emails(text)]
    found += [(m.start(), IP, m.end()) for m in ADDRESS.finditer(text) if all(map(octet, m.groups()))]
    for m in NUMBER.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            found.append((m.start(), CARD, m.end()))
    found += [(m.start(), PHONE, m.end()) for m in CALL.finditer(text) if 10 <= len(digits_of(m[0])) <= 15]
    return found


# --- islands, segments and features --------------------------------------------------


def islands(text: str) -> list[tuple[int, int]]:
    """The stretches of a text that may hold a span, in order and apart."""
    found = []
    for m in STRETCH.finditer(text):
        if m.end() - m.start() >= 7 and (len(digits_of(m[0])) >= 7 or m[0].count(".") >= 3):
            found.append(m.span())
    at = text.find("@")
    while at >= 0:
        low = max(0, at - BEFORE)
        found.append((BEFORE_AT.search(text[low:at]).start() + low, AFTER_AT.match(text, at).end()))
        at = text.find("@", at + 1)
    merged = []
    for a, b in sorted(found):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def side(c: str) -> str:
    """Class of the character next to a segment."""
    if not c:
        return "none"
    return "space" if c.isspace() else "digit" if c.isdigit() else "letter" if c.isalpha() else c if c in ".-+()@_%" else "other"


def number_features(kind: int, tokens: list[str]) -> list[str]:
    groups = [t for t in tokens if t[0].isdigit()]
    digits = "".join(groups)
    shape = "-".join(str(len(g)) for g in groups) if len(groups) <= 7 else "many"
    marks = "".join(sorted({t for t in tokens if not t[0].isdigit()}))
    found = [f"n={len(digits)}", f"shape={shape}", f"marks={marks}", f"plus={tokens[0] == '+'}", f"plus={tokens[0] == '+'},n={len(digits)}"]
    if kind == CARD:
        found += [f"luhn={luhn(digits)}", f"luhn={luhn(digits)},n={len(digits)}", f"luhn={luhn(digits)},groups={min(len(groups), 6)}"]
    if kind == IP:
        found += [f"octets={all(map(octet, groups))}", f"zero={any(len(g) > 1 and g[0] == '0' for g in groups)}"]
    return found


def email_features(tokens: list[str], at: int) -> list[str]:
    local, domain = "".join(tokens[:at]), "".join(tokens[at + 1 :])
    labels = domain.split(".")
    plain = all(re.fullmatch("[A-Za-z0-9-]+", x) for x in labels)
    return [
        f"local={not local.strip(LOCAL)}", f"plain={plain}", f"dots={min(len(labels) - 1, 4)}", f"plain={plain},dot={len(labels) > 1}",
        f"top={labels[-1].isalpha()},{min(len(labels[-1]), 5)}", f"first={side(tokens[0][0])}", f"last={side(tokens[-1][-1])}",
    ]


def segments(tokens: list[str], left: str, right: str) -> list[tuple[int, int, int, tuple[str, ...]]]:
    """(first token, end token, kind, features) of all candidates, by end token.  ``left``
    and ``right`` are the characters next to the island ("" at the text's ends)."""
    found = []

    def add(i, j, kind, features):
        a, b = side(tokens[i - 1][-1] if i else left), side(tokens[j][0] if j < len(tokens) else right)
        k = KINDS[kind]
        found.append((i, j, kind, tuple(f"{k}:{f}" for f in ("bias", f"left={a}", f"right={b}", *features))))

    number = [t[0] in "0123456789" for t in tokens]
    for i, t in enumerate(tokens):
        stop = min(len(tokens), i + MAX_TOKENS)
        if number[i] or t in ("+", "("):
            n, card, ip = 0, number[i], number[i]
            for j in range(i, stop):
                u = tokens[j]
                if number[j]:
                    n += len(u)
                    if n > 19:
                        break
                elif u not in (" ", "(", ")", ".", "-") and j > i:
                    break
                inside = j - i
                card = card and (number[j] if inside == 0 or not number[j - 1] else u in (" ", "-"))
                ip = ip and inside < 7 and (number[j] if inside % 2 == 0 else u == ".")
                if not number[j]:
                    continue
                part = tokens[i : j + 1]
                if ip and inside == 6:
                    add(i, j + 1, IP, number_features(IP, part))
                if card and n >= 12:
                    add(i, j + 1, CARD, number_features(CARD, part))
                if 7 <= n <= 15:
                    add(i, j + 1, PHONE, number_features(PHONE, part))
    at = -1
    for k, t in enumerate(tokens):
        if t == "@":
            low, high = max(at + 1, k - MAX_TOKENS + 2), min(len(tokens), k + MAX_TOKENS)
            high = next((j for j in range(k + 1, high) if tokens[j] == "@" or tokens[j].isspace()), high)
            low = next((i + 1 for i in range(k - 1, low - 1, -1) if tokens[i].isspace()), low)
            for i in range(low, k):
                for j in range(k + 2, min(high, i + MAX_TOKENS) + 1):
                    add(i, j, EMAIL, email_features(tokens[i:j], k - i))
            at = k
    found.sort(key=lambda s: (s[1], s[0], s[2]))
    return found


def best_labelling(n: int, candidates: list[tuple[int, int, int]], scores: list[float]) -> list[tuple[int, int, int]]:
    """The segments of the labelling of n tokens with the greatest sum of scores; outside
    tokens count nothing and win a tie."""
    best, back = [0.0] * (n + 1), [None] * (n + 1)
    c = 0
    for j in range(1, n + 1):
        best[j] = best[j - 1]
        while c < len(candidates) and candidates[c][1] == j:
            total = best[candidates[c][0]] + scores[c]
            if total > best[j]:
                best[j], back[j] = total, candidates[c]
            c += 1
    found, j = [], n
    while j:
        if back[j]:
            found.append(back[j])
            j = back[j][0]
        else:
            j -= 1
    return found[::-1]


# --- training ------------------------------------------------------------------------


def log_add(a: float, b: float) -> float:
    hi, lo = (a, b) if a > b else (b, a)
    return hi + math.log1p(math.exp(lo - hi))


def marginals(n: int, candidates: list[tuple[int, int]], scores) -> tuple[float, list[float]]:
    """(log of the sum over all labellings, probability of every candidate)."""
    ahead = [0.0] * (n + 1)
    c = 0
    for j in range(1, n + 1):
        ahead[j] = ahead[j - 1]
        while c < len(candidates) and candidates[c][1] == j:
            ahead[j] = log_add(ahead[j], ahead[candidates[c][0]] + scores[c])
            c += 1
    starts = sorted(range(len(candidates)), key=lambda x: -candidates[x][0])
    behind = [0.0] * (n + 1)
    c = 0
    for i in range(n - 1, -1, -1):
        behind[i] = behind[i + 1]
        while c < len(starts) and candidates[starts[c]][0] == i:
            behind[i] = log_add(behind[i], behind[candidates[starts[c]][1]] + scores[starts[c]])
            c += 1
    total = ahead[n]
    return total, [math.exp(ahead[i] + s + behind[j] - total) for (i, j), s in zip(candidates, scores)]


def gold_of(text: str) -> list[tuple[int, int, int]] | None:
    """The spans of an island by the patterns, or None where these are unsure."""
    found = sorted(base_spans(text))
    if any(b[0] < a[2] for a, b in zip(found, found[1:])):
        return None
    crowded = any(len(digits_of(m[0])) > 19 for m in NUMBER.finditer(text)) or any(len(digits_of(m[0])) > 15 for m in CALL.finditer(text))
    return None if crowded else found


def example(left: str, text: str, right: str, gold: list[tuple[int, int, int]]):
    """(number of tokens, candidates with features, which are true), or None where a true
    span is no candidate."""
    tokens = TOKEN.findall(text)
    at = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).tolist()
    candidates = segments(tokens, left, right)
    truth = {(a, k, b) for a, k, b in gold}
    true = tuple((at[i], k, at[j]) in truth for i, j, k, _ in candidates)
    return (len(tokens), tuple(candidates), true) if sum(true) == len(truth) else None


def damaged(text: str, span: tuple[int, int, int]) -> str:
    """The island with one span broken in the way of its kind."""
    a, kind, b = span
    t = text[a:b]
    if kind == EMAIL:
        t = t[: t.index("@")] + t[t.index("@") :].replace(".", "")
    elif kind == IP:
        t = "999" + t[t.index(".") :]
    elif kind == CARD:
        t = t[:-1] + str((int(t[-1]) + 1) % 10)
    else:
        t = t[1:]
    return text[:a] + t + text[b:]


def train(sample: list[tuple[str, str, str]]) -> dict[str, float]:
    """Weights of the features from islands (with the characters on both sides) that are
    labelled by the patterns."""
    labelled = [(l, t, r, g) for l, t, r in sample if (g := gold_of(t)) is not None]
    joined = [
        (left, f"{a} {b}", right, [*g, *((s + len(a) + 1, k, e + len(a) + 1) for s, k, e in h)])
        for (left, a, _, g), (_, b, right, h) in zip(labelled, labelled[1:])
    ]
    broken = [(left, t, right, h) for left, text, right, g in labelled for span in g if (h := gold_of(t := damaged(text, span))) is not None]
    weight: dict = {}
    for case in labelled + joined + broken:
        if (e := example(*case)) and e[1]:
            weight[e] = weight.get(e, 0) + 1  # islands of one shape count once, with their number
    names = sorted({f for e in weight for c in e[1] for f in c[3]})
    number = {f: k for k, f in enumerate(names)}
    compiled = [
        (n, [c[:2] for c in cands], np.concatenate([[number[f] for f in c[3]] for c in cands]), np.cumsum([0, *(len(c[3]) for c in cands)]), np.array(true, float), times)
        for (n, cands, true), times in weight.items()
    ]
    w, seen = np.zeros(len(names)), np.full(len(names), 1e-6)
    for _ in range(ROUNDS if compiled else 0):
        slope = -L2 * w
        for n, cands, flat, bounds, true, times in compiled:
            scores = np.add.reduceat(w[flat], bounds[:-1])
            _, p = marginals(n, cands, scores.tolist())
            np.add.at(slope, flat, np.repeat(times * (true - p), np.diff(bounds)))
        seen += slope**2
        w += slope / np.sqrt(seen)
    return {f: float(x) for f, x in zip(names, w)}


class Recogniser:
    def __init__(self, weights: dict[str, float]):
        self.weights = weights

    def segments(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind, end) of the model's best labelling of every island."""
        found = []
        get = self.weights.get
        for a, b in islands(text):
            tokens = TOKEN.findall(text[a:b])
            candidates = segments(tokens, text[a - 1 : a] if a else "", text[b : b + 1])
            if not candidates:
                continue
            scores = [sum(get(f, 0.0) for f in c[3]) for c in candidates]
            at = [a]
            for t in tokens:
                at.append(at[-1] + len(t))
            found += [(at[i], k, at[j]) for i, j, k, _ in best_labelling(len(tokens), candidates, scores)]
        return found

    def spans(self, text: str) -> list[tuple[int, int, int, bool]]:
        """(start, kind, end, found by a pattern) by start, then kind."""
        if not TRIGGER.search(text):
            return []
        base = set(base_spans(text))
        return [(*s, s in base) for s in sorted(base.union(self.segments(text)))]


# --- on tables -----------------------------------------------------------------------


def training_sample(docs: DataFrame) -> list[tuple[str, str, str]]:
    """The bounded sample of islands (see the module's text) with the characters on both
    sides, in hash order."""

    def work(batches):
        for part in text_slices(batches):
            found = {}
            for text in texts_of(part).to_pylist():
                if TRIGGER.search(text):
                    for a, b in islands(text):
                        if b - a <= MAX_TRAIN_CHARS:
                            case = (text[a - 1 : a] if a else "", text[a:b], text[b : b + 1])
                            if case not in found:
                                found[case] = ",".join(sorted({KINDS[k] for _, k, _ in base_spans(case[1])}))
            rows = [(*case, kinds) for case, kinds in found.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(4)], names=["before", "island", "after", "kinds"])

    found = docs.select("text").mapInArrow(work, "before string, island string, after string, kinds string").distinct()
    order = [F.xxhash64("before", "island", "after"), F.col("before"), F.col("island"), F.col("after")]
    place = F.row_number().over(Window.partitionBy("kinds").orderBy(*order))
    picked = found.withColumn("place", place).where(F.col("place") <= MAX_PER_KIND).orderBy(*order)
    return [(r["before"], r["island"], r["after"]) for r in picked.collect()]


def pii_spans(docs: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Per row its doc_id and the spans in order, each with its kind and whether a pattern
    found it."""

    def work(batches):
        recogniser = Recogniser(weights)
        for part in text_slices(batches):
            found = [[{"start": a, "kind": KINDS[k], "end": b, "base": base} for a, k, b, base in recogniser.spans(t)] for t in texts_of(part).to_pylist()]
            kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32()), ("base", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([column(part, "doc_id"), pa.array(found, kind)], names=["doc_id", "spans"])

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(work, SPANS)


def find_pii(docs: DataFrame) -> DataFrame:
    """Per document the counts and digest of the base spans, and all spans."""
    found = pii_spans(docs, train(training_sample(docs)))

    def joined(spans: Column) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    base = F.filter("spans", lambda s: s["base"])
    number = lambda kind: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")
    return found.select("doc_id", *[number(k).alias(f"n_{k}") for k in KINDS], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
