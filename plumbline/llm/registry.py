"""All queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

import importlib

from .common import Query

MODULES = ("suffix_dedup", "mixing", "quality", "ngram_join", "langid", "licenses", "embedding_dedup", "toxicity", "exact_dedup", "packing")


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for m in MODULES:
        out |= importlib.import_module(f"{__package__}.{m}").QUERIES
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for m in MODULES:
        out |= importlib.import_module(f"{__package__}.{m}").ORACLE
    return out
