"""Rounding and money arithmetic that give the same bits on every engine.

The reference rounds with numpy (``x.round(n)`` and ``round(np.float64, n)``),
which is ``rint(x * 10**n) / 10**n``: half-to-even on the binary product.
Spark's ``bround`` rounds the shortest decimal string instead and differs on
values such as 2.675, so we spell the numpy rule out with ``rint``.

Money is summed exactly: each value becomes an integer number of
millionths (``rint(x * 1e6)``), those are added as ``decimal(38,0)`` (no
overflow, no order dependence) and the total is turned back into a double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000.0


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_even(c: Column | str, digits: int = 0) -> Column:
    c = _c(c)
    if digits == 0:
        return F.rint(c)
    scale = float(10 ** digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def micros(c: Column | str) -> Column:
    """A money value as an exact integer count of millionths."""
    return F.rint(_c(c) * F.lit(MICROS)).cast("decimal(38,0)")


def micros_sum(c: Column | str) -> Column:
    """Exact sum in millionths (``decimal(38,0)``); combine with ``from_micros``."""
    return F.sum(micros(c))


def from_micros(total: Column) -> Column:
    return total.cast("double") / F.lit(MICROS)


def money_sum(c: Column | str) -> Column:
    """Exact, order-independent sum of a double money column, as double."""
    return from_micros(micros_sum(c))


def money_avg(c: Column | str) -> Column:
    """Mean of a money column from its exact sum."""
    return from_micros(micros_sum(c)) / F.count(_c(c))
