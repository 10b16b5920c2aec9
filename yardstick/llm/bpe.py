"""BPE encoding and decoding (operator 4) with tree concatenation for long unsplit text.

ASCII white space always ends a pre-token and vanishes in this tokenizer, so a text's
ids are the ids of its words in order.  A word's ids are those of its parts: ASCII marks
before and after a core that starts and ends with a plain letter or digit are pre-tokens
of their own.  A task remembers the parts it met, in two generations: what is looked up
moves to the young one, and the old one is forgotten when the young one is full, so the
memory is bounded and frequent parts stay.  A part of at most ``LEAF`` code points is encoded by the tokenizers library.  A
longer one is cut in halves recursively: the leaves of the tree are encoded together
(``encode_batch``), and each join re-encodes a window around the cut that doubles until
it shares a run of ``AGREE`` tokens (same ids, same offsets) with the left side and with
the right side.  Neighbouring tokens of a BPE encoding are pairwise compatible, and a
sequence of pairwise compatible tokens is the encoding, so splicing at shared tokens is
exact; a window that grows over both sides is the whole encoding.

The vocabulary file is read by the driver and broadcast (a tokenizer file, at most
``MAX_VOCABULARY`` bytes); executors need no path.

Defined cases: a null or empty text gives no ids and an empty decoded text; repeated rows
are encoded one by one; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import sys as _sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import DataFrame

from .arrow_text import column, give_back, ragged_take, split_words, text_slices, texts_of, word_codes

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

LEAF = 4096
FIRST_WINDOW = 64
AGREE = 4
MAX_VOCABULARY = 64 << 20
KNOWN_PARTS = 150_000
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
ENCODE_AT_ONCE = 1024
SLICE = 4 << 20

SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def load_vocabulary(path: str) -> str:
    if os.path.getsize(path) > MAX_VOCABULARY:
        raise ValueError(f"vocabulary file of more than {MAX_VOCABULARY} bytes: {path}")
    with open(path, encoding="utf-8") as f:
        return f.read()


class Encoder:
    def __init__(self, vocabulary: str, leaf: int = LEAF, first: int = FIRST_WINDOW, agree: int = AGREE):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task is one core's work
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(vocabulary)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.leaf, self.first, self.agree = leaf, first, agree
        self.tokens = None

    def pieces(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """(id, start, end) of the tokens of each text."""
        return [[(i, a, b) for i, (a, b) in zip(e.ids, e.offsets)] for e in self.tok.encode_batch(texts, add_special_tokens=False)]

    def encode_long(self, text: str) -> list[int]:
        n = max(1, -(-len(text) // self.leaf))
        cuts = [len(text) * k // n for k in range(n + 1)]
        level = []
        for a, tokens in zip(cuts, self.pieces([text[a:b] for a, b in zip(cuts, cuts[1:])])):
            level.append([(i, s + a, e + a) for i, s, e in tokens])
        bounds = list(zip(cuts, cuts[1:]))
        while len(level) > 1:  # one level of the tree: neighbours are joined
            joined, spans = [], []
            for k in range(0, len(level) - 1, 2):
                (a, mid), (_, b) = bounds[k], bounds[k + 1]
                joined.append(self.join(text, a, mid, b, level[k], level[k + 1]))
                spans.append((a, b))
            if len(level) % 2:
                joined.append(level[-1])
                spans.append(bounds[-1])
            level, bounds = joined, spans
        return [i for i, _, _ in level[0]]

    def join(self, text, a, mid, b, left, right):
        size = self.first
        while True:
            lo, hi = max(a, mid - size), min(b, mid + size)
            window = [(i, s + lo, e + lo) for i, s, e in self.pieces([text[lo:hi]])[0]]
            if lo == a and hi == b:
                return window
            at_left = (0, 0) if lo == a else self.shared(left, window, lo, mid)
            at_right = (len(right), len(window)) if hi == b else self.shared(right, window, mid, hi, last=True)
            if at_left is not None and at_right is not None and at_left[1] <= at_right[1]:
                return left[: at_left[0]] + window[at_left[1] : at_right[1]] + right[at_right[0] :]
            size *= 2

    def shared(self, side, window, lo, hi, last=False):
        """Positions (in side, in window) of a shared run of tokens inside [lo, hi): the
        first token after the run's first one.  The first run for the left, the last for the right."""
        import bisect

        first = bisect.bisect_left(side, lo, key=lambda t: t[1])
        stop = bisect.bisect_right(side, hi, key=lambda t: t[1])
        where: dict = {}
        for j in range(first, stop - self.agree + 1):
            where.setdefault(tuple(side[j : j + self.agree]), j)
        order = range(len(window) - self.agree, -1, -1) if last else range(len(window) - self.agree + 1)
        for k in order:
            j = where.get(tuple(window[k : k + self.agree]))
            if j is not None:
                return j + 1, k + 1
        return None

    def encode_words(self, words: list[str]) -> list[list[int]]:
        out: list = [None] * len(words)
        short = [k for k, w in enumerate(words) if len(w) <= self.leaf]
        for at in range(0, len(short), ENCODE_AT_ONCE):
            some = short[at : at + ENCODE_AT_ONCE]
            for k, e in zip(some, self.tok.encode_batch_fast([words[k] for k in some], add_special_tokens=False)):
                out[k] = e.ids
        for k, w in enumerate(words):
            if out[k] is None:
                out[k] = self.encode_long(w)
        return out

    def decoded(self, ids: list[int]) -> str:
        """The library's decoding of some ids without special treatment: their tokens joined."""
        if self.tokens is None:
            self.tokens = [self.tok.id_to_token(i) for i in range(self.tok.get_vocab_size(with_added_tokens=True))]
        return " ".join([self.tokens[i] for i in ids])


def parts_of(word: str) -> tuple[str, ...]:
    """The word cut into marks, core and marks where the cut is a pre-token border for sure:
    the core starts and ends with an ASCII letter or digit, the marks hold no apostrophe
    (contractions) and the word no start of a special token."""
    core = word.strip(MARKS)
    if len(core) == len(word) or not core or "<|" in word:
        return (word,)
    if not (core[0].isascii() and core[0].isalnum() and core[-1].isascii() and core[-1].isalnum()):
        return (word,)
    at = word.index(core)
    return tuple(x for x in (word[:at], core, word[at + len(core) :]) if x)


class KnownParts:
    """(ids as bytes, decoded form) of the parts a task has met, in two generations of at
    most ``most`` each (and the parts of one slice)."""

    def __init__(self, encoder: Encoder, most: int | None = None):
        self.encoder, self.most = encoder, KNOWN_PARTS if most is None else most
        self.young: dict[str, tuple[bytes, str]] = {}
        self.old: dict[str, tuple[bytes, str]] = {}

    def learn(self, parts: set[str]) -> None:
        """Bring all parts into the young generation."""
        if len(self.young) > self.most:
            self.young, self.old = {}, self.young
        new = []
        for p in parts:
            if p not in self.young:
                known = self.old.get(p)
                if known is None:
                    new.append(p)
                else:
                    self.young[p] = known
        for p, ids in zip(new, self.encoder.encode_words(new)):
            self.young[p] = (np.array(ids, "<u4").tobytes(), self.encoder.decoded(ids))

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """(ids of all words, number of ids of each, decoded form of each)."""
        cut = [parts_of(w) for w in words]
        self.learn({p for parts in cut for p in parts})
        get, ids, pieces = self.young.__getitem__, [], []
        for parts in cut:
            if len(parts) == 1:
                one, piece = get(parts[0])
            else:
                found = [get(p) for p in parts]
                one, piece = b"".join([f[0] for f in found]), " ".join([f[1] for f in found if f[0]])
            ids.append(one)
            pieces.append(piece)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        return np.frombuffer(b"".join(ids), "<u4"), sizes, pieces


def encode_slice(known: KnownParts, texts: pa.Array):
    """(ids, token bounds per text, decoded texts) of an Arrow array of texts."""
    bounds, words = split_words(texts)
    codes, distinct = word_codes(words)
    flat, sizes, decoded_words = known.words(distinct.to_pylist())
    starts = np.cumsum(sizes) - sizes
    per_word = sizes[codes]
    ids = flat[ragged_take(starts[codes], per_word)]
    token_bounds = np.concatenate([[0], np.cumsum(per_word)])[bounds]
    # words without tokens leave no piece, so they leave no separator either
    pieces = pa.array(decoded_words, pa.large_string())
    some = per_word > 0
    piece_bounds = np.concatenate([[0], np.cumsum(some)])[bounds]
    taken = pieces.take(pa.array(codes[some]))
    decoded = pc.binary_join(pa.ListArray.from_arrays(pa.array(piece_bounds, pa.int32()), taken), pa.scalar(" ", taken.type))
    return ids, token_bounds, decoded


def bpe_encode(
    docs: DataFrame, vocabulary_path: str, leaf: int = LEAF, keep_ids: bool = False, known_parts: int = KNOWN_PARTS, slice_bytes: int = SLICE
) -> DataFrame:
    """Per document the token count and digests of ids and decoded text; with ``keep_ids``
    also ``ids`` (array<int>) and ``decoded`` (string).  ``known_parts`` and ``slice_bytes``
    trade a worker's memory for time; the result does not depend on them."""
    shared = docs.sparkSession.sparkContext.broadcast(load_vocabulary(vocabulary_path))

    def encoded(known, part):
        ids, bounds, decoded = encode_slice(known, texts_of(part))
        raw = ids.astype("<u4")
        id_sums = [hashlib.sha256(raw[a:b].tobytes()).hexdigest() for a, b in zip(bounds, bounds[1:])]
        text_sums = [hashlib.sha256((x.as_py() or "").encode()).hexdigest() for x in decoded]
        arrays = [column(part, "doc_id"), pa.array(np.diff(bounds), pa.int64()), pa.array(id_sums), pa.array(text_sums)]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if keep_ids:
            arrays += [
                pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32))),
                pc.fill_null(decoded, "").cast(pa.string()),
            ]
            names += ["ids", "decoded"]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def work(batches):
        known = KnownParts(Encoder(shared.value, leaf), known_parts)
        for part in text_slices(batches, max_bytes=slice_bytes):
            yield encoded(known, part)
        part = known = None
        give_back()  # the vocabulary and the parts: the worker outlives its task

    schema = SCHEMA + (", ids array<int>, decoded string" if keep_ids else "")
    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(work, schema)
