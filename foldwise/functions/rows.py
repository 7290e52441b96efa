"""Row expressions that skip nulls the way a data-frame row reduction does."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def present(cols: Iterable[str | Column]) -> Column:
    """How many of the cells are not null."""
    return reduce(add, [col(c).isNotNull().cast("int") for c in cols])


def null_count(cols: Iterable[str | Column]) -> Column:
    return reduce(add, [col(c).isNull().cast("int") for c in cols])


def row_sum(cols: Iterable[str | Column]) -> Column:
    return reduce(add, [F.coalesce(col(c).cast("double"), F.lit(0.0)) for c in cols])


def row_mean(cols: Iterable[str | Column]) -> Column:
    """Mean of the non-null cells; null when there is none."""
    cols = list(cols)
    return F.try_divide(row_sum(cols), present(cols))


def row_std(cols: Iterable[str | Column]) -> Column:
    """Sample deviation of the non-null cells; null under two cells."""
    cols = list(cols)
    mean = row_mean(cols)
    squares = row_sum([(col(c) - mean) * (col(c) - mean) for c in cols])
    return F.when(present(cols) >= 2, F.sqrt(squares / (present(cols) - 1)))


def row_max(cols: Iterable[str | Column]) -> Column:
    return F.greatest(*[col(c) for c in cols]).cast("double")


def ratio(num: str | Column, den: str | Column, offset: float) -> Column:
    return F.try_divide(col(num), col(den) + F.lit(offset))


def z(c: str | Column, mean: float | None, sd: float | None) -> Column:
    """Standardise by fitted numbers; null where the column had no deviation to fit."""
    if mean is None or sd is None:
        return F.lit(None).cast("double")
    return (col(c) - F.lit(mean)) / F.lit(sd)


def pearson(a: str | Column, b: str | Column) -> Column:
    """Correlation aggregate over the rows that have both; null when one side is constant."""
    x, y = col(a).cast("double"), col(b).cast("double")
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def clip(c: str | Column, low: float, high: float) -> Column:
    value = col(c)
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def level(c: str | Column, null_level: str) -> Column:
    """Category as text, with null as a level of its own."""
    return F.coalesce(col(c).cast("string"), F.lit(null_level))


def rounded(c: str | Column, digits: int = 6) -> Column:
    """Rounded for reports: decimal ties go up, and there is no negative zero."""
    return F.round(col(c) + F.lit(1e-9), digits) + F.lit(0.0)
