"""Registered queries: one per operator of the inventory.  Each takes
(spark, sf_dir) and returns a DataFrame over the whole test tables; most have
a DuckDB SQL twin in ORACLE."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from . import queries_gold  # noqa: F401
    from . import queries_silver  # noqa: F401
    from . import queries_targets  # noqa: F401
    from . import queries_views  # noqa: F401
    from . import queries_search  # noqa: F401
    from . import queries_deeds  # noqa: F401
    from . import queries_files  # noqa: F401
    from . import queries_misc  # noqa: F401
