"""Registered queries: key -> (spark callable, oracle SQL or None).

Every callable takes ``(spark, sf_dir)``, reads the test tables of that
folder through the event-log adapter, and returns a DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from churnkit.operators import clean, features, label
from churnkit.plans import oracle as O
from churnkit.sources.adapter import event_log

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[key] = fn
        if sql is not None:
            _SQL[key] = sql
        return fn
    return deco


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(spark, sf_dir)


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.prepare_events(event_log(spark, sf_dir))


def user_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table with the test log's pages named, which saves the
    pass that looks for them."""
    return features.user_features(prepared(spark, sf_dir), pages=O.TEST_PAGES)


# ---------------------------------------------------------------------------
# Labelling, features, joins
# ---------------------------------------------------------------------------

@register("user_features", O.with_ctes("SELECT * FROM features", "features"))
def q_user_features(spark, sf_dir):
    """The flagship with named pages; ``prepare_data`` is the same with
    whatever pages the log holds."""
    return user_table(spark, sf_dir)


def queries() -> dict[str, QueryFn]:
    # import side effect: the query modules register themselves
    from churnkit.plans import queries_explore, queries_ml, queries_io  # noqa: F401
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_SQL)
