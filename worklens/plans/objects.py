"""Annotation time per object."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (
    map_to_json,
    ms_to_seconds,
    normalize_label,
    round_double,
    strip_marker,
)
from ..operators import map_agg, per_object_minutes, scope
from ..sources import RENAMES, from_year, rename_source
from .defaults import OBJECT_CLASSES, OBJECT_TYPES

DOCUMENT = ["organization_id", "project_id", "labeltaskid", "document_id"]


def object_cells(
    stats: DataFrame, pairs: Sequence[tuple] | DataFrame, min_year: str | None = None
) -> DataFrame:
    """Time and object count per document, object type and class.

    An object touched by two workers counts twice. Two aggregates, both combined
    before their shuffle, so the rows of one large document are spread out.
    """
    records = scope(from_year(rename_source(stats, RENAMES["time_stats"]), min_year), pairs)
    # The report joins its parts on the document, so NULL keys have no result.
    known = records.where(F.col("batch").isNotNull() & F.col("document_id").isNotNull())
    rows = known.select(
        "organization_id",
        "project_id",
        strip_marker(F.col("batch")).alias("labeltaskid"),
        "document_id",
        "updatedby",
        "object_type",
        normalize_label(F.col("class")).alias("class"),
        "identity",
        "time_spent",
    )
    per_object = rows.groupBy(
        *DOCUMENT, "updatedby", "object_type", "class", "identity"
    ).agg(F.sum("time_spent").alias("timespent"))
    counted = F.col("class").isNotNull() & F.col("identity").isNotNull()
    return per_object.groupBy(*DOCUMENT, "object_type", "class").agg(
        F.sum("timespent").alias("timespent"),
        F.count_if(counted).alias("object_count"),
    )


def time_per_object(
    stats: DataFrame,
    pairs: Sequence[tuple] | DataFrame,
    classes: Sequence[str] = OBJECT_CLASSES,
    object_types: Sequence[str] = OBJECT_TYPES,
    min_year: str | None = None,
) -> DataFrame:
    """Shares of time and object counts per class and object type, minutes per object.

    One scan, no join. Shares are taken among labelled rows, the duration
    includes unlabelled time; a document without any label has no row. Where a
    class occurs under several object types, the smallest type's figures are
    kept. Minutes use the share after its rounding to two decimals. ``min_year`` leaves
    out earlier years of a table with a ``year``.

    A document's classes and types end up in one row by definition; the windows
    run on one row per document, type and class, no more than that result holds.
    """
    labelled = F.col("class") != F.lit("")
    by_type = Window.partitionBy(*DOCUMENT, "object_type")
    # Ordered by type only so that both windows share one sort; the frame is the
    # whole document.
    by_document = (
        Window.partitionBy(*DOCUMENT)
        .orderBy("object_type")
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    cells = object_cells(stats, pairs, min_year).withColumns(
        {
            "_time": F.when(labelled, F.col("timespent")),
            "_objects": F.when(labelled, F.col("object_count")),
        }
    )
    totals = cells.withColumns(
        {
            "_document_time": F.sum("_time").over(by_document),
            "_duration": F.sum("timespent").over(by_document),
            "_type_time": F.sum("_time").over(by_type),
            "_type_objects": F.sum("_objects").over(by_type),
        }
    )

    def share(time: str) -> Column:
        ratio = F.try_divide(F.col(time).cast("double"), F.col("_document_time").cast("double"))
        return round_double(ratio, 2)

    by_type_figures = F.struct(
        share("_type_time").alias("share"), F.col("_type_objects").alias("objects")
    )
    by_class_figures = F.struct(
        share("timespent").alias("share"), F.col("object_count").alias("objects")
    )
    type_, class_ = F.col("object_type"), F.col("class")
    documents = (
        totals.where(labelled)
        .groupBy(*DOCUMENT)
        .agg(
            map_agg(type_, by_type_figures).alias("_types"),
            map_agg(class_, by_class_figures, tie=type_).alias("_classes"),
            ms_to_seconds(F.max("_duration")).alias("duration_sec"),
        )
    )

    def figure(column: str, field: str) -> Column:
        return F.transform_values(column, lambda _, figures: figures[field])

    maps = documents.select(
        *DOCUMENT,
        figure("_types", "share").alias("_type_shares"),
        figure("_types", "objects").alias("_type_objects"),
        figure("_classes", "share").alias("_class_shares"),
        figure("_classes", "objects").alias("_class_objects"),
        "duration_sec",
    )
    seconds = F.col("duration_sec")
    return maps.select(
        *DOCUMENT,
        map_to_json(F.col("_type_shares")).alias("object_type_tpo"),
        map_to_json(F.col("_type_objects")).alias("object_type_object_count"),
        map_to_json(F.col("_class_shares")).alias("class_wise_tpo"),
        map_to_json(F.col("_class_objects")).alias("class_object_count"),
        seconds,
        *per_object_minutes(
            seconds,
            F.col("_class_shares"),
            F.col("_class_objects"),
            {f"{key}_tpo": key for key in classes},
        ),
        *per_object_minutes(
            seconds,
            F.col("_type_shares"),
            F.col("_type_objects"),
            {f"{key}_tpo": key for key in object_types},
        ),
    )
