"""Scalar column helpers. All are built-in JVM expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(a, b, zero: float = 0.0) -> Column:
    """A / b, ``zero`` where b = 0 (null stays null)."""
    a, b = col(a), col(b)
    return F.when(b == 0, F.lit(zero)).otherwise(a / b)


def isin_safe(c, values: Iterable) -> Column:
    """R ``%in%``: never null -- a null value is simply not in the set."""
    return F.coalesce(col(c).isin(list(values)), F.lit(False))


def clean_name(c) -> Column:
    """Drop everything from the first dot (``Pos Pred Value.x`` -> ``Pos Pred Value``)."""
    return F.regexp_replace(col(c), r"\..*$", "")


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double/float column (for a stable cross-engine value hash)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append((F.round(F.col(f.name).cast("double"), places) + F.lit(0.0)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def unpivot_long(df: DataFrame, ids: Sequence[str], cols: Sequence[str],
                 name: str = "feature", value: str = "value",
                 cast: str | None = None) -> DataFrame:
    """Wide -> long. One ``Expand`` in the plan; partial aggregation after it
    keeps the shuffle per (feature, value), never per row."""
    sel = [F.col(c).cast(cast).alias(c) if cast else F.col(c) for c in cols]
    return df.select(*ids, *sel).unpivot(list(ids), list(cols), name, value)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """B1: numeric columns by schema."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in ex]


def categorical_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """B1: string / boolean columns by schema."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.BooleanType)) and f.name not in ex]


def sigmoid(x) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col(x)))
