"""Array columns as short series."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bounds of a compact record.
MAX_SERIES, MAX_POINTS = 12, 1024


def compact_series(series: Column) -> Column:
    """The first MAX_SERIES series of an array of arrays, MAX_POINTS values of each."""
    return F.transform(F.slice(series, 1, MAX_SERIES), lambda x: F.slice(x, 1, MAX_POINTS))


def longest(series: Column) -> Column:
    """Length of the longest series of an array of arrays; 0 if there is none."""
    return F.coalesce(F.array_max(F.transform(series, F.size)), F.lit(0))


def finite_stats(values: Column) -> Column:
    """mean, least, greatest and n of the finite numbers of an array; null numbers where there are none."""
    kept = F.filter(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    total = F.aggregate(kept, F.lit(0.0), lambda a, x: a + x)
    return F.struct(F.try_divide(total, F.size(kept)).alias("mean"), F.array_min(kept).alias("least"), F.array_max(kept).alias("greatest"), F.size(kept).alias("n"))


def differences(values: Column) -> Column:
    """Each value less the one before."""
    return F.transform(F.slice(values, 2, F.greatest(F.size(values) - 1, F.lit(0))), lambda x, i: x - F.get(values, i))
