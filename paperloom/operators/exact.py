"""Sums of doubles that do not depend on the order of the rows.

A double is cut into two whole numbers, 2^-20 and 2^-60 at their last place.
Whole numbers add up exactly, so one task or a thousand give the same sum.
Terms may add up to 2^43 and number 2^23 in one group; what is below 2^-60 in a
term is cut off, always alike.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec, functions as F

HIGH, LOW = float(1 << 20), float(1 << 40)


def exact_sum(x: Column, over: WindowSpec | None = None) -> Column:
    """Sum of a non-negative double, as an aggregate or over a window."""
    scaled = x * F.lit(HIGH)
    high = F.floor(scaled)
    low = F.floor((scaled - high.cast("double")) * F.lit(LOW))
    total = F.sum if over is None else (lambda c: F.sum(c).over(over))
    return (total(high).cast("double") + total(low).cast("double") / F.lit(LOW)) / F.lit(HIGH)
