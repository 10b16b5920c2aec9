"""A deterministic stand-in for a model endpoint, used by the scoring queries and tests."""

from __future__ import annotations

import sys as _sys
import threading

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])


def json_answer(i: int) -> str:
    """The JSON-style stub answer for id ``i`` (four shapes by ``i % 4``)."""
    k = i % 4
    if k == 0:
        return '```json\n{"verdict": "looks right %d", "recommendation": "acceptable"}\n```' % i
    if k == 1:
        return '{"verdict": "bent frame %d", "recommendation": "geometry_artifacts"}' % i
    if k == 2:
        return '{"verdict": "odd %d", "recommendation": "blurry"}' % i
    return "no JSON here for %d" % i


class StubScorer:
    """Deterministic stand-in for a model endpoint, a pure function of the id:
    it raises on the first ``id % 3`` attempts for each row and always for
    ``id % 17 == 0``; it answers Yes for even ids and No for odd ones."""

    def __init__(self, id_col: str = "sample_id", style: str = "reasoning"):
        self.id_col = id_col
        self.style = style

    def __call__(self):
        # tries of the rows being retried now; an answered or exhausted row is forgotten,
        # so the state is as large as the requests in flight
        tries, lock = {}, threading.Lock()
        id_col = self.id_col
        style = self.style

        def score(row: dict) -> str:
            i = int(row[id_col])
            if i % 17 == 0:
                raise RuntimeError(f"endpoint unavailable for {i}")
            with lock:
                n = tries[i] = tries.get(i, 0) + 1
                if n > i % 3:
                    del tries[i]
            if n <= i % 3:
                raise TimeoutError(f"timeout on attempt {n}")
            if style == "json":
                return json_answer(i)
            return f"<reasoning>sample {i}</reasoning> {'Yes' if i % 2 == 0 else 'No'}"

        return score
