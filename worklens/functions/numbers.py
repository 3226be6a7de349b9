"""Number conversion and rounding with a fixed result type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Above this a double has no fraction left to round.
_WHOLE = float(2**53)


def ms_to_seconds(col: Column, scale: int | None = 1) -> Column:
    """Milliseconds to seconds as ``decimal(20 + scale, scale)``, half rounded away from zero.

    ``scale=None`` keeps the exact quotient as a double.
    """
    if scale is None:
        return col.cast("double") / F.lit(1000.0)
    seconds = col.cast("decimal(19,0)") / F.lit(1000)
    return F.round(seconds, scale).cast(f"decimal({20 + scale},{scale})")


def round_double(col: Column, digits: int) -> Column:
    """Round a double half away from zero, judged on its binary value.

    ``F.round`` judges the shortest decimal text instead: it turns 0.145 into
    0.15, although the stored number lies below the half.
    """
    factor = F.lit(float(10**digits))
    scaled = F.abs(col) * factor
    whole = F.floor(scaled)
    # The fraction is exact; adding a half to the number itself would round it.
    up = F.when(scaled - whole >= F.lit(0.5), F.lit(1)).otherwise(F.lit(0))
    rounded = F.signum(col) * (whole + up) / factor
    return F.when(scaled < F.lit(_WHOLE), rounded).otherwise(col)


def coalesce_variants(*cols: Column, to: str = "int") -> Column:
    """First non-NULL of one field stored in several typed columns.

    A fraction is rounded half away from zero before the cast to ``to``.
    """
    value = F.coalesce(*[c.cast("double") for c in cols])
    if to == "double":
        return value
    return round_double(value, 0).cast(to)
