"""Column helpers for statistics that stay defined under ANSI arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def r6(c: Column | str) -> Column:
    """Rounded to six places, as results are compared."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def safe_corr(x: Column | str, y: Column | str) -> Column:
    """Pearson's r over the rows where both are present; null where either is constant there."""
    x, y = (F.col(c) if isinstance(c, str) else c for c in (x, y))
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def share(condition: Column, of: Column | None = None) -> Column:
    """Rows that meet ``condition`` among those of ``of`` (all rows by default); 0 where there are none."""
    hits = condition if of is None else of & condition
    total = F.count(F.lit(1)) if of is None else F.count_if(of)
    return F.coalesce(F.try_divide(F.count_if(F.coalesce(hits, F.lit(False))), total), F.lit(0.0))
