"""Registry of named queries: a Spark builder plus, where SQL can express it,
the DuckDB oracle text. Modules register themselves on import."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


# Column names that are reserved words in the oracle's SQL dialect; quoted
# outside string literals when a query is registered.
_RESERVED = re.compile(r'(?<!")\b(offset)\b(?!")')


def quote_reserved(sql: str) -> str:
    parts = sql.split("'")
    for i in range(0, len(parts), 2):  # even pieces are outside literals
        parts[i] = _RESERVED.sub(r'"\1"', parts[i])
    return "'".join(parts)


def query(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = (fn, quote_reserved(sql) if sql else None)
        return fn

    return deco


def load_all() -> dict[str, tuple[Builder, str | None]]:
    from tidemark.plans import (  # noqa: F401
        q_aggregates,
        q_composite,
        q_core,
        q_jobs,
        q_joins,
        q_ordered,
        q_sources,
    )

    return REGISTRY
