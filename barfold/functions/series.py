"""Change and cumulative-change expressions over an ordered window.

``window`` is a partitioned, ordered ``WindowSpec`` without a frame. All of these
are built-in expressions, evaluated in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

_INFINITY = float("inf")


def _column(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _before(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def not_nan(x: Column | str) -> Column:
    """``x``, with NaN as null."""
    x = _column(x)
    return F.when(~F.isnan(x), x)


def finite(x: Column | str) -> Column:
    """``x``, with NaN and both infinities as null."""
    x = _column(x)
    return F.when(~F.isnan(x) & (F.abs(x) < _INFINITY), x)


def nonzero(x: Column | str) -> Column:
    """``x``, with 0 and NaN as null: a zero price is a missing price."""
    x = _column(x)
    return F.when((x != 0) & ~F.isnan(x), x)


def positive(x: Column | str) -> Column:
    """True where ``x > 0``; NaN, which Spark sorts above every number, is not."""
    x = _column(x)
    return (x > 0) & ~F.isnan(x)


def pct_step(x: Column, base: Column) -> Column:
    """Relative change from ``base`` to ``x``; null where it is not a finite number."""
    return finite((x - base) / F.abs(base))


def last_before(value: Column | str, window: WindowSpec) -> Column:
    """The last value of the rows strictly before that is not null."""
    return F.last(value, ignorenulls=True).over(_before(window))


def pct_chg(x: Column | str, window: WindowSpec) -> Column:
    """Relative change from the last usable value strictly before the row.

    Zero and NaN count as missing, both as value and as base.
    """
    value = nonzero(x)
    return pct_step(value, last_before(value, window))


def growth_factor(change: Column | str) -> Column:
    """``1 / (1 + change)``, a missing change counting as 0.

    A change of -1 gives infinity instead of a division error.
    """
    change = F.coalesce(not_nan(change), F.lit(0.0))
    return F.when(change == -1, F.lit(_INFINITY)).otherwise(1 / (1 + change))


def lag_cum_chg(change: Column | str, window: WindowSpec) -> Column:
    """Product of :func:`growth_factor` over the rows strictly before; 1 on the first."""
    before = F.product(growth_factor(change)).over(_before(window))
    return F.nanvl(F.coalesce(before, F.lit(1.0)), F.lit(1.0))


def lag_cum_chg_na(change: Column | str, window: WindowSpec) -> Column:
    """:func:`lag_cum_chg`, null where the change itself is missing."""
    return F.when(not_nan(change).isNotNull(), lag_cum_chg(change, window))
