"""Query registry: name -> (Spark builder, DuckDB oracle or None).

Each builder takes (spark, dataset_dir) and returns a lazy DataFrame whose
double columns are rounded to 6 places (the oracle rounds the same columns).
Oracle-less entries are iterative fits (models, k-means, ICA) checked by
pytest against planted data instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from propensity.functions.columns import round_doubles

Builder = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Builder] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Builder) -> Builder:
        def run(spark: SparkSession, base: str) -> DataFrame:
            return round_doubles(fn(spark, base))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn
    return deco


def queries() -> dict[str, Builder]:
    _load()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)


def _load():
    # importing the query modules fills the registry
    from propensity.plans import (q_profile, q_split, q_features, q_evaluate,  # noqa: F401
                                  q_models, q_segment)
