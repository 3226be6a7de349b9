"""String clean-up of source columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the marker in front of a batch code.
BATCH_MARKER = "BC-"


def strip_marker(col: Column, marker: str = BATCH_MARKER) -> Column:
    """Remove every occurrence of ``marker``, not only a leading one."""
    return F.replace(col, F.lit(marker), F.lit(""))


def normalize_label(col: Column) -> Column:
    """Lower case with ``_`` for each blank; outer blanks are not trimmed."""
    return F.lower(F.replace(col, F.lit(" "), F.lit("_")))
