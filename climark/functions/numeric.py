"""Numeric helpers shared by operators (rounding, guarded division/corr)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def r6(x) -> Column:
    """Round a double to 6 decimals (stable across engines' summation order)."""
    return F.round(_c(x), 6)


def round_half_even(x, n: int) -> Column:
    """Rounding to ``n`` decimals, halves to even, of a double of any size: the double
    times 10**n is rounded, as numpy does."""
    scale = F.lit(10.0 ** n)
    return F.rint(_c(x) * scale) / scale


def safe_div(num, den) -> Column:
    """num / den, null when den is 0 or null (ANSI mode would raise)."""
    return F.try_divide(_c(num), _c(den))


def float_div(num, den) -> Column:
    """num / den of doubles as SQL engines with IEEE arithmetic and numpy give it: by 0, an
    infinity of ``num``'s sign, or NaN for 0 / 0 (ANSI mode would raise)."""
    num, den = _c(num), _c(den)
    return F.when(den != 0, num / den).when(num != 0, F.signum(num) * F.lit(float("inf"))) \
        .when((den == 0) & num.isNotNull(), F.lit(float("nan")))


def safe_corr(x, y) -> Column:
    """Pearson correlation that is null, not an error, on a constant column."""
    x, y = _c(x), _c(y)
    den = F.stddev_pop(x) * F.stddev_pop(y)
    return F.when(den > 0, F.covar_pop(x, y) / den)
