"""Registry of the library's runnable jobs over the driver tables.

Each entry maps a name (prefixed by its operator ID) to a callable
``(spark, sf_dir) -> DataFrame`` and, where the result is expressible in
plain SQL, an equivalent DuckDB query used as the correctness oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Job = Callable[[SparkSession, str], DataFrame]

_JOBS: dict[str, Job] = {}
_SQL: dict[str, str] = {}


def register(name: str, job: Job, sql: str | None = None) -> None:
    if name in _JOBS:
        raise ValueError(f"duplicate job {name}")
    _JOBS[name] = job
    if sql is not None:
        _SQL[name] = sql


def _load_all() -> None:
    from . import catalog_jobs  # noqa: F401  (registers every job on first import)


def jobs() -> dict[str, Job]:
    _load_all()
    return dict(_JOBS)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_SQL)
