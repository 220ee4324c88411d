"""Share-of-total rounding used by the dashboard pies.

A share is ``round_half_up(part * 1000 / total) / 10`` (one decimal); the last
slice of a pie is the remainder ``round_half_up((100 - others) * 10) / 10``.
A total of 0 gives share 0, so the remainder slice is 100.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up_share(part: Column, total: Column) -> Column:
    raw = F.floor(part.cast("double") * F.lit(1000.0) / total.cast("double") + F.lit(0.5)) / F.lit(10.0)
    return F.when(total == 0, F.lit(0.0)).otherwise(raw)


def remainder_share(*shares: Column) -> Column:
    rest = F.lit(100.0)
    for s in shares:
        rest = rest - s
    return F.floor(rest * F.lit(10.0) + F.lit(0.5)) / F.lit(10.0)
