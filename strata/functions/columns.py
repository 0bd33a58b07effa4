"""Column-level helpers (all JVM-side built-ins; no Python UDFs)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def tier(value: Column | str, ladder: Sequence[tuple[float, str]], floor: str, inclusive: bool) -> Column:
    """CASE ladder: first threshold the value exceeds (or reaches) wins.

    NULL never satisfies a comparison and therefore lands on ``floor``.
    """
    v = F.col(value) if isinstance(value, str) else value
    expr = None
    for threshold, label in ladder:
        cond = v >= threshold if inclusive else v > threshold
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(floor) if expr is None else expr.otherwise(F.lit(floor))


def ratio(num: Column | str, den: Column | str, scale: int = 4) -> Column:
    """``round(num / den, scale)``; NULL when the denominator is 0 or NULL."""
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return F.round(F.try_divide(n.cast("double"), d.cast("double")), scale)


def ts_literal(value: str) -> Column:
    """A naive-UTC timestamp literal."""
    return F.lit(value).cast("timestamp_ntz")
