"""Means and medians that agree with R to the last bit.

The two-pass mean over 80-bit floats equals the correctly rounded exact mean (checked by property tests). Each code/255
is a whole multiple of 2**-60, so the exact sum is a decimal sum of whole numbers, independent of row order, with partial
aggregation like any other sum.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F

SHIFT = 60


def scaled_probability(code: Column) -> Column:
    """(code / 255) * 2**60 as a whole number, exactly; code is 0..255."""
    return ((code / F.lit(255.0)) * F.lit(float(2**SHIFT))).cast("bigint").cast("decimal(19,0)")


def exact_mean(code: Column) -> Column:
    """Aggregate: mean of code / 255. The decimal quotient keeps far more digits than a double, which it is then cast to."""
    total, n = F.sum(scaled_probability(code)), F.count(code)
    return (total.cast("decimal(38,12)") / n.cast("decimal(10,0)")).cast("double") / F.lit(float(2**SHIFT))


def mean_f64(values: Column) -> Column:
    """The two-pass mean in 64-bit floats of an array in the order of its positions."""
    n = F.size(values).cast("double")
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    first = total / n
    rest = F.aggregate(F.transform(values, lambda x: x - first), F.lit(0.0), lambda a, x: a + x)
    finite = (first == first) & (F.abs(first) != float("inf"))
    return F.when(n == 0, F.lit(float("nan"))).when(finite, first + rest / n).otherwise(first)


def r_mean_reference(values: list[float]) -> float:
    """Plain correctly rounded mean; NaN for none. Used by tests and by sinks on a single row."""
    if not values:
        return math.nan
    total = sum((Fraction(v) for v in values), Fraction(0)) / len(values)
    return float(total)


def r_median_reference(values: list[float]) -> float:
    """Plain median; an even count takes the exact mean of the middle two."""
    if not values:
        return math.nan
    s, k = sorted(values), len(values) // 2
    return s[k] if len(s) % 2 else r_mean_reference([s[k - 1], s[k]])
