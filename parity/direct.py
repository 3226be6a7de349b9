"""Plain shapes of the reports: one distinct count per column, windows, self-joins.

They are the yardstick the library's shapes are tested and timed against, not
part of the library.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from worklens import functions as C
from worklens.operators import distinct_where, remap_values, scope
from worklens.plans.issues import GROUP
from worklens.plans.stages import COLUMNS, TASK_KEY
from worklens.plans.objects import DOCUMENT
from worklens.sources import RENAMES, from_year, rename_source


def issue_daily(issues, pairs, min_year, tags) -> DataFrame:
    raw = scope(from_year(rename_source(issues, RENAMES["issues"]), min_year), pairs)
    daily = raw.withColumns(
        {
            "updatedat_date": C.local_day(C.epoch_to_local(F.col("updatedat"))),
            "_tags": C.json_key_list(F.col("error_code")),
        }
    )
    issue = F.col("issue_id")
    return daily.groupBy(*GROUP).agg(
        F.count_distinct(issue).alias("total_issues"),
        distinct_where(issue, F.col("status") == "Open").alias("open_issues"),
        distinct_where(issue, F.col("status") == "Resolved").alias("resolved_issues"),
        distinct_where(issue, F.col("deleted")).alias("deleted_issues"),
        *[
            distinct_where(issue, F.array_contains("_tags", tag)).alias(name)
            for name, tag in tags.items()
        ],
    )


def stage_history(logs, pairs, min_year, labels) -> DataFrame:
    scoped = scope(from_year(logs, min_year), pairs, mode="independent")
    by_log = Window.partitionBy("labeltaskid", "document_id").orderBy(
        F.col("updatedat").desc_nulls_last(),
        *[F.col(c).desc_nulls_last() for c in scoped.columns if c not in ("updatedat", "year")],
    )
    newest = scoped.withColumn("_rn", F.row_number().over(by_log)).where("_rn = 1")
    names = newest.groupBy(F.col("project_id").alias("_project")).agg(
        F.max_by("projectname", F.struct("updatedat", "projectname")).alias("_name")
    )
    named = newest.join(names, F.col("project_id") == F.col("_project"), "left")
    stages = named.withColumns(
        {
            "projectname": F.col("_name"),
            "batch_name": C.json_scalar(F.col("batch_details"), "$[0].batch_name"),
            "stagename": remap_values(F.col("stagename"), labels),
            "updatedat_date": C.epoch_to_local(F.col("updatedat")),
        }
        | {f"{c}_sec": C.ms_to_seconds(F.col(c)) for c in ("duration", "idleduration", "blurduration")}
    ).select(*COLUMNS)

    def number(keys, *order):
        return F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint")

    ascending = [F.col("updatedat_date").asc_nulls_last(), F.col("document_id").asc_nulls_last()]
    descending = [F.col("updatedat_date").desc_nulls_last(), F.col("document_id").desc_nulls_first()]
    return stages.select(
        "*",
        number(TASK_KEY, *ascending).alias("stage_flow"),
        number([*TASK_KEY, "stagename"], *ascending).alias("node_iteration"),
        F.when(number(TASK_KEY, *descending) == 1, "Yes").otherwise("Other").alias("is_latest"),
    )


def time_per_object(stats, pairs, classes, object_types) -> DataFrame:
    rows = scope(rename_source(stats, RENAMES["time_stats"]), pairs).withColumns(
        {
            "labeltaskid": C.strip_marker(F.col("batch")),
            "class": C.normalize_label(F.col("class")),
        }
    )
    cell = [*DOCUMENT, "object_type", "class"]
    per_worker = rows.groupBy(*cell, "updatedby").agg(
        F.count_distinct(F.concat("class", F.lit("_"), F.col("identity").cast("string"))).alias("objects"),
        F.sum("time_spent").alias("ms"),
    )
    cells = per_worker.groupBy(*cell).agg(F.sum("ms").alias("ms"), F.sum("objects").alias("objects"))
    duration = cells.groupBy(*DOCUMENT).agg(C.ms_to_seconds(F.sum("ms")).alias("duration_sec"))
    labelled = cells.where(F.col("class") != "")

    def pairs_of(frame: DataFrame, key: str, tie: str, prefix: str) -> DataFrame:
        """Per document: first share and count of each key, as two maps."""
        total = F.sum("ms").over(Window.partitionBy(*DOCUMENT)).cast("double")
        ratio = C.round_double(F.try_divide(F.col("ms").cast("double"), total), 2)
        first = Window.partitionBy(*DOCUMENT, key).orderBy(tie)
        kept = (
            frame.withColumn("share", ratio)
            .withColumn("_rn", F.row_number().over(first))
            .where(F.col("_rn") == 1)
        )

        def as_map(value: str) -> Column:
            entry = F.when(F.col(key).isNotNull(), F.struct(key, value))
            entries = F.array_sort(F.collect_list(entry))
            return F.when(F.size(entries) > 0, F.map_from_entries(entries))

        return kept.groupBy(*DOCUMENT).agg(
            as_map("share").alias(f"{prefix}_shares"), as_map("objects").alias(f"{prefix}_objects")
        )

    by_class = pairs_of(labelled, "class", "object_type", "_class")
    typed = labelled.groupBy(*DOCUMENT, "object_type").agg(
        F.sum("ms").alias("ms"), F.sum("objects").alias("objects")
    )
    by_type = pairs_of(typed, "object_type", "object_type", "_type")
    joined = reduce(lambda a, b: a.join(b, DOCUMENT), [by_class, by_type, duration])

    def minutes(prefix: str, key: str):
        share = F.col(f"{prefix}_shares")[key]
        count = F.nullif(F.col(f"{prefix}_objects")[key].cast("double"), F.lit(0.0))
        return C.round_double(F.col("duration_sec").cast("double") * share / count / 60, 1)

    return joined.select(
        *DOCUMENT,
        F.to_json("_type_shares").alias("object_type_tpo"),
        F.to_json("_type_objects").alias("object_type_object_count"),
        F.to_json("_class_shares").alias("class_wise_tpo"),
        F.to_json("_class_objects").alias("class_object_count"),
        "duration_sec",
        *[minutes("_class", key).alias(f"{key}_tpo") for key in classes],
        *[minutes("_type", key).alias(f"{key}_tpo") for key in object_types],
    )


def task_rollup(tasks, pairs) -> DataFrame:
    rows = scope(rename_source(tasks, RENAMES["task_sessions"]), pairs).select(
        "organization_id",
        "project_id",
        C.strip_marker(F.col("batch_code")).alias("labeltaskid"),
        "document_id",
        "updatedby",
        C.epoch_to_local(F.col("start_timestamp"), "ms").alias("start_time"),
        C.epoch_to_local(F.col("timestamp"), "ms").alias("end_time"),
        "active_time",
        F.col("sequence_num").cast("int").alias("frames"),
    )
    return rows.groupBy(*DOCUMENT, "updatedby").agg(
        F.min("start_time").alias("start_time"),
        F.max("end_time").alias("end_time"),
        F.sum("active_time").alias("duration_sec"),
        F.max("frames").alias("total_frames"),
    )


def classification_extract(answers, pairs) -> DataFrame:
    tenants = reduce(
        lambda a, b: a | b,
        [(F.col("organization_id") == o) & (F.col("project_id") == p) for o, p in pairs],
    )
    local = C.epoch_to_local(F.col("updatedat")).alias("updatedat_date_ist")
    kept = answers.where(tenants)
    return kept.select(*[c for c in kept.columns if c != "updatedat"], local)


def latest_version(events) -> DataFrame:
    newest = F.max(F.struct("ts", "event_id", "value", "props")).alias("_row")
    return events.groupBy("user_id", "event_type").agg(newest).select("user_id", "event_type", "_row.*")


def distinct_by_tag(lines, tags) -> DataFrame:
    order = F.col("l_orderkey")
    carried = F.array("l_returnflag", "l_linestatus")
    return lines.groupBy("l_suppkey").agg(
        F.count_distinct(order).alias("total"),
        *[distinct_where(order, F.array_contains(carried, tag)).alias(n) for n, tag in tags.items()],
    )


def share_of_total(lines) -> DataFrame:
    total = F.sum("quantity").over(Window.partitionBy("l_orderkey")).cast("double")
    share = F.try_divide(F.col("quantity").cast("double"), total)
    return lines.withColumn("share", share).withColumn("share_2", C.round_double(F.col("share"), 2))
