"""Numeric coercion and finance arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions._util import as_col


def try_cast(c: Column | str, type_name: str) -> Column:
    """bad values become NULL instead of failing the job."""
    return as_col(c).try_cast(type_name)


# a plain decimal number; Spark's cast would also take suffixes such as 5d or 5f
_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def to_number(c: Column | str) -> Column:
    """text -> double; anything but a plain number -> NULL."""
    x = as_col(c).cast("string")
    return F.when(x.rlike(_NUMBER), x.try_cast("double"))


def zero_to_null(c: Column | str) -> Column:
    """keep strictly positive values, everything else -> NULL."""
    x = as_col(c)
    return F.when(x > 0, x)


def to_positive_number(c: Column | str) -> Column:
    """F4 + F6."""
    return zero_to_null(to_number(c))


def bool_or_false(c: Column | str) -> Column:
    """NULL -> False."""
    return F.coalesce(as_col(c).cast("boolean"), F.lit(False))


def round_dec(c: Column | str, scale: int = 2) -> Column:
    """F16: half-up rounding on an exact decimal, returned as double.  Going
    through decimal(38,10) makes the result independent of last-bit float
    differences of the input."""
    return F.round(as_col(c).cast("decimal(38,10)"), scale).cast("double")


def profit(revenue: Column | str, budget: Column | str) -> Column:
    """F15."""
    return as_col(revenue) - as_col(budget)


def roi(revenue: Column | str, budget: Column | str) -> Column:
    """(revenue - budget) / budget, NULL when budget is 0."""
    return F.try_divide(as_col(revenue) - as_col(budget), as_col(budget).cast("double"))


def roi_pct(revenue: Column | str, budget: Column | str, scale: int = 2) -> Column:
    """ROI in percent, rounded."""
    return round_dec(roi(revenue, budget) * 100, scale)


def pct_change(cur: Column | str, prev: Column | str, scale: int = 2) -> Column:
    """(cur - prev) / prev * 100, only when prev > 0."""
    c, p = as_col(cur), as_col(prev)
    return F.when(p > 0, round_dec((c - p) / p.cast("double") * 100, scale))


def rint_bigint(c: Column | str) -> Column:
    """double -> bigint rounding half-to-even (a plain cast truncates)."""
    return F.rint(as_col(c)).cast("bigint")


def clip(c: Column | str, lo: float, hi: float) -> Column:
    """F30."""
    return F.least(F.greatest(as_col(c), F.lit(lo)), F.lit(hi))


def log10_or_null(c: Column | str) -> Column:
    """F32: log10 for positive values (axis data for log-scale charts)."""
    x = as_col(c)
    return F.when(x > 0, F.log10(x))
