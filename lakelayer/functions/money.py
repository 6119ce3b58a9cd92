"""Money helpers.

Amounts are carried as ``decimal(18,2)`` inside computations, their sums as
``decimal(38,2)``, and turned into doubles only at the output. A sum of cents is exact and is
not rounded. Cents rounding of a share is half up on the value as a double,
``floor(x * 100 + 0.5) / 100``, which is what the warehouse's payment split uses; ``round()`` differs (1.005 -> 1.0 here, 1.01 there).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(col) -> Column:
    return F.col(col).cast(MONEY) if isinstance(col, str) else col.cast(MONEY)


def round_cents(col) -> Column:
    """Half-up rounding to cents, evaluated in double precision, returned as decimal(18,2)."""
    c = F.col(col) if isinstance(col, str) else col
    hundred = F.lit(100.0)
    return (F.floor(c.cast("double") * hundred + F.lit(0.5)) / hundred).cast(MONEY)


def exact_sum(col) -> Column:
    """Sum of an amount column, exact to the cent."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast("decimal(28,2)")).cast("decimal(38,2)")


def as_double(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("double")
