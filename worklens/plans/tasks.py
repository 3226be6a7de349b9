"""Task sessions per worker."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import epoch_to_local, strip_marker
from ..operators import scope
from ..sources import RENAMES, from_year, rename_source


def task_rollup(
    tasks: DataFrame,
    pairs: Sequence[tuple] | DataFrame,
    offset_ms: int | None = None,
    min_year: str | None = None,
) -> DataFrame:
    """First start, last end, summed duration and highest frame number per worker and document.

    One scan and one aggregate. The duration is a plain sum in the unit of
    ``active_time``. A sequence number that is not an integer is an error.
    ``min_year`` leaves out earlier years of a table with a ``year``.
    """
    sessions = scope(from_year(rename_source(tasks, RENAMES["task_sessions"]), min_year), pairs)
    # A shift and a cut to the second keep the order, so the least and greatest
    # epoch numbers are converted once per group instead of once per row.
    start, end = F.min("start_timestamp"), F.max("timestamp")
    return sessions.groupBy(
        "organization_id",
        "project_id",
        strip_marker(F.col("batch_code")).alias("labeltaskid"),
        "document_id",
        "updatedby",
    ).agg(
        epoch_to_local(start, "ms", offset_ms).alias("start_time"),
        epoch_to_local(end, "ms", offset_ms).alias("end_time"),
        F.sum("active_time").alias("duration_sec"),
        F.max(F.col("sequence_num").cast("int")).alias("total_frames"),
    )
