"""Epoch numbers to local wall-clock time.

Results are ``timestamp_ntz`` and do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the shift of the reports in seconds. It is 5 h 25 min, five
# minutes short of the zone it stands for (+05:30); pass 19_800 for that.
LOCAL_OFFSET_S = 19500
# Fixed value: the task report adds the same number to milliseconds, which
# shifts by 19.5 s only. Pass 19_800_000 for +05:30.
TASK_OFFSET_MS = 19500


def epoch_to_local(
    col: Column, unit: str = "s", offset: int | None = None
) -> Column:
    """Shift an epoch number by ``offset`` (same unit) and read it as a local time.

    ``unit`` is ``"s"`` or ``"ms"``; milliseconds are cut to whole seconds.
    """
    if unit == "s":
        seconds = col + F.lit(LOCAL_OFFSET_S if offset is None else offset)
    elif unit == "ms":
        shifted = col + F.lit(TASK_OFFSET_MS if offset is None else offset)
        seconds = F.call_function("div", shifted, F.lit(1000))
    else:
        raise ValueError(f"unit must be 's' or 'ms', not {unit!r}")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", seconds, epoch)


def local_day(col: Column) -> Column:
    """Calendar day of a local time."""
    return F.to_date(col)
