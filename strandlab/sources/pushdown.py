"""Conditions that Spark hands to the file sources."""

from __future__ import annotations

import operator

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql import datasource as D

_ORDERS = {D.EqualTo: operator.eq, D.GreaterThan: operator.gt, D.GreaterThanOrEqual: operator.ge, D.LessThan: operator.lt, D.LessThanOrEqual: operator.le}


def allow_pushdown(spark: SparkSession) -> None:
    """Let Spark hand conditions to sources written in Python, which it does only where this is set."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def compares(f, columns: tuple[str, ...]) -> bool:
    """Whether a condition compares one of the columns, all without nulls, with given values."""
    return isinstance(f, (*_ORDERS, D.In, D.IsNotNull)) and len(f.attribute) == 1 and f.attribute[0] in columns and all(v is not None for v in values_of(f))


def values_of(f) -> list:
    return list(f.value) if isinstance(f, D.In) else [] if isinstance(f, D.IsNotNull) else [f.value]


def holds(f, columns: dict[str, np.ndarray]) -> np.ndarray:
    """Rows of number columns for which the condition holds."""
    x = columns[f.attribute[0]]
    if isinstance(f, D.IsNotNull):
        return np.ones(len(x), bool)
    return np.isin(x, values_of(f)) if isinstance(f, D.In) else _ORDERS[type(f)](x, f.value)


def bounds(filters, column: str) -> tuple[float, float]:
    """Lowest and highest value that a number column can have under all conditions."""
    low, high = -np.inf, np.inf
    for f in filters:
        if f.attribute == (column,):
            given = values_of(f)
            if isinstance(f, (D.EqualTo, D.In, D.GreaterThan, D.GreaterThanOrEqual)) and given:
                low = max(low, min(given))
            if isinstance(f, (D.EqualTo, D.In, D.LessThan, D.LessThanOrEqual)) and given:
                high = min(high, max(given))
    return low, high
