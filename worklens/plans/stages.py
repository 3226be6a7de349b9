"""Stage history of each task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import epoch_to_local, json_scalar, ms_to_seconds
from ..operators import (
    attach_latest,
    latest_attribute,
    latest_by,
    number_stages,
    remap_values,
    scope,
)
from ..sources import from_year
from .defaults import MIN_YEAR, STAGE_LABELS

VERSION_KEY = ["labeltaskid", "document_id"]
TASK_KEY = ["project_id", "labeltaskid"]

COLUMNS = [
    "organization_id",
    "project_id",
    "projectname",
    "batch_name",
    "labeltaskid",
    "document_id",
    "stage",
    "stagename",
    "stage_type",
    "rework",
    "iscompleted",
    "isskipped",
    "updatedby",
    "updatedat_date",
    "duration_sec",
    "idleduration_sec",
    "blurduration_sec",
    "number_of_pages",
]


def stage_history(
    logs: DataFrame,
    pairs: Sequence[tuple] | DataFrame,
    min_year: str | None = MIN_YEAR,
    labels: Mapping[str, Sequence[str]] = STAGE_LABELS,
    offset_s: int | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Newest version of each log with stage order, iteration number and latest flag.

    Organizations and projects are tested independently of each other. The
    project name is the newest of its project among the newest versions.

    Tasks too large for one Spark task are numbered in ``ranges`` of their logs, as many
    as there are shuffle partitions by default.
    """
    scoped = scope(from_year(logs, min_year), pairs, mode="independent")
    needed = scoped.select(
        "organization_id", "project_id", "projectname", "batch_details", "labeltaskid",
        "document_id", "stage", "stagename", "stage_type", "rework", "iscompleted",
        "isskipped", "updatedby", "updatedat", "duration", "idleduration",
        "blurduration", "number_of_pages",
    )
    newest = latest_by(needed, VERSION_KEY, "updatedat")
    stages = newest.withColumns(
        {
            "batch_name": json_scalar(F.col("batch_details"), "$[0].batch_name"),
            "stagename": remap_values(F.col("stagename"), labels),
            "updatedat_date": epoch_to_local(F.col("updatedat"), offset=offset_s),
            "duration_sec": ms_to_seconds(F.col("duration")),
            "idleduration_sec": ms_to_seconds(F.col("idleduration")),
            "blurduration_sec": ms_to_seconds(F.col("blurduration")),
        }
    ).select(*COLUMNS)
    # All versions are spread like the newest, and cheaper to sample.
    versions = scoped.select(
        *TASK_KEY, epoch_to_local(F.col("updatedat"), offset=offset_s).alias("updatedat_date"), "document_id"
    )
    numbered = number_stages(
        stages, TASK_KEY, "stagename", "updatedat_date", ["document_id"], versions, ranges
    )
    named = attach_latest(numbered, latest_attribute(newest, "project_id", "projectname", "updatedat"))
    return named.select(*COLUMNS, "stage_flow", "node_iteration", "is_latest")
