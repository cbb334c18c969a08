"""Column expressions that carry the missing-value and infinity rules.

NULL is the only missing marker: NaN is turned into NULL where it could arise, and
±infinity is an ordinary double until the cleaning step.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    c = _col(c)
    return F.when(~F.isnan(c), c)


def divide(numerator, denominator) -> Column:
    """Float division: x/0 is ±infinity by the sign of x, 0/0 is NULL."""
    n, d = _col(numerator).cast("double"), _col(denominator).cast("double")
    by_zero = F.when(n > 0, F.lit(INF)).when(n < 0, F.lit(-INF))
    return F.when(d == 0, by_zero).otherwise(nan_to_null(F.try_divide(n, d)))


def clip(c, low, high) -> Column:
    """Clamp to [low, high]; NULL stays NULL (greatest/least would skip it).

    A NULL bound clamps nothing on that side.
    """
    c = _col(c)
    return F.when(c.isNotNull(), F.greatest(F.least(c, _bound(high)), _bound(low)))


def _bound(b) -> Column:
    return b if isinstance(b, Column) else F.lit(None if b is None else float(b))


def null_if(c, sentinel) -> Column:
    c = _col(c)
    return F.when(c != sentinel, c)


def total(c) -> Column:
    """Sum that is 0, not NULL, for a group without values."""
    return F.coalesce(F.sum(c), F.lit(0))


def mean(c) -> Column:
    """Mean by the sum and the count, so that a roll-up with the ``total`` of a column as well moves one sum, not two."""
    return F.try_divide(F.sum(c), F.count(c))


def count_equal(c, value) -> Column:
    return F.count_if(_col(c) == F.lit(value))


def _plus(terms) -> Column:
    return reduce(lambda a, b: a + b, terms)


def row_count(*cols) -> Column:
    return _plus(_col(c).isNotNull().cast("int") for c in cols)


def row_mean(*cols) -> Column:
    """Mean across columns over the non-null ones; NULL when there is none."""
    present = row_count(*cols)
    added = _plus(F.coalesce(_col(c).cast("double"), F.lit(0.0)) for c in cols)
    return F.when(present > 0, added / present)


def row_std(*cols) -> Column:
    """Sample standard deviation across the non-null columns; NULL below two."""
    present, mean = row_count(*cols), row_mean(*cols)
    squares = _plus(
        F.coalesce((_col(c) - mean) * (_col(c) - mean), F.lit(0.0)) for c in cols
    )
    return F.when(present >= 2, F.sqrt(squares / (present - 1)))


def row_product(*cols) -> Column:
    return reduce(lambda a, b: a * b, (_col(c).cast("double") for c in cols))


def sample_skewness(c) -> Column:
    """Bias-corrected skewness (aggregate): NULL below three values, 0 for a constant."""
    c = _col(c)
    n = F.count(c).cast("double")
    corrected = F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2)
    return F.when(n < 3, None).when(F.min(c) == F.max(c), F.lit(0.0)).otherwise(corrected)


def hundredths(c) -> Column:
    """Rounded to two digits, halves away from zero, judged on the double itself as the statements do."""
    return F.round(_col(c) * 100) / 100
