"""propensity: conversion / propensity analytics as Spark DataFrame operators.

Every operator is ``f(df, *, columns..., options) -> DataFrame`` and is lazy:
nothing is collected except small fitted parameters (class means, level lists,
bucket boundaries) whose size is bounded by the number of columns or levels,
never by the number of rows.
"""

from propensity.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
