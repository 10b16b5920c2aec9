"""All registered queries and their DuckDB oracles, merged from the plan modules."""

from __future__ import annotations

import importlib

_MODULES = ["evaluation", "parts", "labelling", "sampling", "payloads", "chat", "scoring", "reports", "io", "json_answers", "files"]


def _load():
    qs, oracles = {}, {}
    for name in _MODULES:
        mod = importlib.import_module(f"yardstick.plans.{name}")
        for k, fn in mod.QUERIES.items():
            if k in qs:
                raise ValueError(f"duplicate query key {k}")
            qs[k] = fn
        oracles.update(getattr(mod, "ORACLE", {}))
    missing = set(oracles) - set(qs)
    if missing:
        raise ValueError(f"oracle without query: {sorted(missing)}")
    return qs, oracles


def all_queries():
    return _load()[0]


def all_oracles():
    return _load()[1]
