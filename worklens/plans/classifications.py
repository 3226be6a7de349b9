"""Classification answers in local time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import epoch_to_local
from ..operators import scope
from ..sources import from_year


def classification_extract(
    classifications: DataFrame,
    pairs: Sequence[tuple] | DataFrame,
    offset_s: int | None = None,
    min_year: str | None = None,
) -> DataFrame:
    """One row per answer of the listed projects; a single stage without a shuffle.

    ``min_year`` leaves out earlier years of a table with a ``year``.
    """
    return scope(from_year(classifications, min_year), pairs).select(
        "organization_id",
        "project_id",
        "labeltaskid",
        "document_id",
        "objectid",
        "title",
        "answer",
        "tool",
        "updatedby",
        epoch_to_local(F.col("updatedat"), offset=offset_s).alias("updatedat_date_ist"),
    )
