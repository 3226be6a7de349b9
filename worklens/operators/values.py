"""Relabelling of values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def remap_values(col: Column, labels: Mapping[str, Sequence[str]]) -> Column:
    """Replace the values listed under a label by that label; keep the rest, NULL included."""
    result = col
    for label, values in labels.items():
        result = F.when(col.isin(*values), F.lit(label)).otherwise(result)
    return result
