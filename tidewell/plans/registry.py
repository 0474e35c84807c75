"""All queries over the given tables, by name, each beside its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .standins import view, with_views

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None, views: str = ""):
    """Register f(*views) -> DataFrame under its own name, with the SQL over the same views that must give the same rows.

    A name that is no view is a base table.
    """
    names = views.split()

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(*(view(spark, sf_dir, n) if n in VIEW_NAMES else spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names))

        _QUERIES[f.__name__] = run
        if sql is not None:
            used = [n for n in names if n in VIEW_NAMES]
            _SQL[f.__name__] = with_views(sql, *used) if used else sql
        return f

    return add


from .standins import VIEWS  # noqa: E402

VIEW_NAMES = frozenset(VIEWS)


def _load() -> None:
    from . import intake, operations, reads, state, transfer  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
