"""Daily issue counts by status and error code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import epoch_to_local, json_key_list, local_day
from ..operators import distinct_counts, scope
from ..sources import RENAMES, from_year, rename_source
from .defaults import ISSUE_TAGS, MIN_YEAR

GROUP = ["updatedat_date", "organization_id", "project_id", "labeltaskid"]


def issue_daily(
    issues: DataFrame,
    pairs: Sequence[tuple] | DataFrame,
    min_year: str | None = MIN_YEAR,
    tags: Mapping[str, str] = ISSUE_TAGS,
    offset_s: int | None = None,
    strict: bool = True,
    ordered: bool = True,
) -> DataFrame:
    """Distinct issues per local day, project and task: all, by status, by error code.

    Versions of an issue are not reduced to the newest: it counts on every day
    and under every status and tag it had there.

    ``ordered`` sorts by day, newest first; the other group columns follow, so
    that a day with many groups can be split over tasks. ``strict`` fails on
    error codes that are not a JSON array, otherwise they carry no tag.
    """
    raw = scope(from_year(rename_source(issues, RENAMES["issues"]), min_year), pairs)
    daily = raw.select(
        local_day(epoch_to_local(F.col("updatedat"), offset=offset_s)).alias("updatedat_date"),
        "organization_id",
        "project_id",
        "labeltaskid",
        "issue_id",
        "status",
        "deleted",
        json_key_list(F.col("error_code"), strict=strict).alias("_tags"),
    )
    conditions = {
        "open_issues": F.col("status") == "Open",
        "resolved_issues": F.col("status") == "Resolved",
        "deleted_issues": F.col("deleted"),
    } | {name: F.array_contains("_tags", F.lit(tag)) for name, tag in tags.items()}
    counts = distinct_counts(daily, GROUP, "issue_id", conditions, total="total_issues")
    if not ordered:
        return counts
    newest_first = F.col(GROUP[0]).desc_nulls_last()
    return counts.orderBy(newest_first, *[F.col(c).asc_nulls_last() for c in GROUP[1:]])
