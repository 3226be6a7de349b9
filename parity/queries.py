"""One job per operator and report over the driver's whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worklens import functions as C
from worklens import operators as O
from worklens import plans as R
from worklens.sources import load, rename_source

from . import standins as S

Query = Callable[[SparkSession, str], DataFrame]


def scope_pairs(spark, sf_dir):
    lines = S.table(spark, sf_dir, "lineitem")
    kept = O.scope(lines, S.LINE_PAIRS, "pair", ["l_suppkey", "l_linenumber"])
    return kept.select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity")


def scope_independent(spark, sf_dir):
    lines = S.table(spark, sf_dir, "lineitem")
    kept = O.scope(lines, S.LINE_PAIRS, "independent", ["l_suppkey", "l_linenumber"])
    return kept.select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity")


def _supplier_tenants(spark, sf_dir):
    suppliers = S.table(spark, sf_dir, "supplier").where("s_acctbal > 0")
    return suppliers.selectExpr("s_suppkey", "CAST(s_nationkey % 7 + 1 AS BIGINT) AS line")


def scope_table(spark, sf_dir):
    lines = S.table(spark, sf_dir, "lineitem")
    kept = O.scope(lines, _supplier_tenants(spark, sf_dir), "pair", ["l_suppkey", "l_linenumber"])
    return kept.select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity")


def scope_table_independent(spark, sf_dir):
    lines = S.table(spark, sf_dir, "lineitem")
    tenants = _supplier_tenants(spark, sf_dir).where("line > 3")
    kept = O.scope(lines, tenants, "independent", ["l_suppkey", "l_linenumber"])
    return kept.select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity")


def min_partition(spark, sf_dir):
    orders = S.table(spark, sf_dir, "orders")
    dated = orders.withColumn("year", F.year("o_orderdate").cast("string"))
    dated.createOrReplaceTempView("orders_by_year")
    recent = load(spark, None, "orders_by_year", min_year="1998")
    return recent.select("o_orderkey", "o_orderstatus", "year")


def classification_extract(spark, sf_dir):
    return R.classification_extract(S.classifications(spark, sf_dir), S.ANSWER_PAIRS)


def json_key_list(spark, sf_dir):
    events = S.table(spark, sf_dir, "events")
    value = F.concat(
        F.lit("["), "props", F.lit(","), "props", F.lit(',{"k":"'), "event_type", F.lit('"}]')
    )
    keys = C.json_key_list(value, "k")
    return events.select("event_id", F.array_join(F.array_sort(keys), "|").alias("keys"))


def json_scalar(spark, sf_dir):
    value = F.concat(F.lit("["), "props", F.lit("]"))
    return S.table(spark, sf_dir, "events").select(
        "event_id",
        C.json_scalar(value, "$[0].k").alias("k"),
        F.coalesce(C.json_scalar(value, "$[0]"), F.lit("no scalar")).alias("whole"),
        F.coalesce(C.json_scalar(value, "$[1].k"), F.lit("missing")).alias("beyond"),
    )


def _line_conditions():
    return {
        "status_o": F.col("l_linestatus") == "O",
        "flag_r": F.col("l_returnflag") == "R",
        "late_a": (F.col("l_returnflag") == "A") & (F.col("l_shipdate") >= "2000-01-01"),
    }


def distinct_where(spark, sf_dir):
    """The aggregate, once per condition."""
    order = F.col("l_orderkey")
    conditions = {"total": F.lit(True)} | _line_conditions()
    counts = [O.distinct_where(order, c).alias(name) for name, c in conditions.items()]
    return S.table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(*counts)


def distinct_counts(spark, sf_dir):
    """The same counts by one flag per condition and order."""
    lines = S.table(spark, sf_dir, "lineitem")
    return O.distinct_counts(lines, ["l_suppkey"], "l_orderkey", _line_conditions(), "total")


LINE_TAGS = {"flag_a": "A", "flag_n": "N", "flag_r": "R", "status_o": "O", "absent": "X"}


def distinct_by_tag(spark, sf_dir):
    tags = F.array("l_returnflag", "l_linestatus")
    lines = S.table(spark, sf_dir, "lineitem").withColumn("tags", tags)
    return O.distinct_by_tag(lines, ["l_suppkey"], "l_orderkey", "tags", LINE_TAGS, "total")


def issue_daily(spark, sf_dir):
    return R.issue_daily(
        S.issues(spark, sf_dir), S.ISSUE_PAIRS, S.FIRST_YEAR_LINES, tags=S.TAGS
    )


def latest_version(spark, sf_dir):
    events = S.table(spark, sf_dir, "events")
    return O.latest_by(events, ["user_id", "event_type"], "ts")


def latest_attribute(spark, sf_dir):
    events = S.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return O.attach_latest_attribute(events, "user_id", "event_type", "ts")


def latest_attribute_split(spark, sf_dir):
    """The same for few, large keys: the newest user of each event type."""
    events = S.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return O.attach_latest_attribute(events, "event_type", "user_id", "ts")


def latest_attribute_table(spark, sf_dir):
    events = S.table(spark, sf_dir, "events")
    return O.latest_attribute(events, "user_id", "event_type", "ts")


def remap_values(spark, sf_dir):
    label = O.remap_values(F.col("event_type"), S.LABELS)
    events = S.table(spark, sf_dir, "events")
    return events.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n"))


def ms_to_seconds(spark, sf_dir):
    price = F.round(F.col("o_totalprice").cast("decimal(18,2)"), 0).cast("bigint")
    return S.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        C.ms_to_seconds(price).alias("seconds"),
        C.ms_to_seconds(price, None).alias("exact"),
    )


def _stages(spark, sf_dir):
    """Events as stages: two types share a label, every user is a task."""
    return S.table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        O.remap_values(F.col("event_type"), S.LABELS).alias("stage"),
        "ts",
    )


def stage_sequence(spark, sf_dir):
    return O.sequence(_stages(spark, sf_dir), ["user_id"], "ts", ["event_id"])


def stage_iteration(spark, sf_dir):
    return O.iteration(_stages(spark, sf_dir), ["user_id"], "stage", "ts", ["event_id"])


def latest_flag(spark, sf_dir):
    return O.latest_flag(_stages(spark, sf_dir), ["user_id"], "ts", ["event_id"])


def stage_numbers_split(spark, sf_dir):
    """All three numbers, with cuts inside many users' rows."""
    stages = _stages(spark, sf_dir)
    return O.number_stages(stages, ["user_id"], "stage", "ts", ["event_id"], ranges=500)


def stage_history(spark, sf_dir):
    return R.stage_history(
        S.stage_logs(spark, sf_dir), S.EVENT_PAIRS, S.FIRST_YEAR_EVENTS, labels=S.LABELS
    )


def stage_history_split(spark, sf_dir):
    return R.stage_history(
        S.stage_logs(spark, sf_dir),
        S.EVENT_PAIRS,
        S.FIRST_YEAR_EVENTS,
        labels=S.LABELS,
        ranges=500,
    )


def epoch_ms(spark, sf_dir):
    ms = F.call_function("div", S.epoch_us("ts"), F.lit(1000))
    return S.table(spark, sf_dir, "events").select(
        "event_id",
        C.epoch_to_local(ms, "ms").alias("as_reported"),
        C.epoch_to_local(ms, "ms", 19_500_000).alias("in_report_zone"),
        C.local_day(C.epoch_to_local(ms, "ms", 19_500_000)).alias("local_day"),
    )


def task_rollup(spark, sf_dir):
    return R.task_rollup(S.task_sessions(spark, sf_dir), S.TIME_PAIRS)


def normalize_label(spark, sf_dir):
    raw = F.concat(F.lit("BC- "), "p_name", F.lit(" BC-"), "p_type")
    parts = rename_source(
        S.table(spark, sf_dir, "part").select(raw.alias("raw.label")), {"raw.label": "raw_label"}
    )
    label = C.normalize_label(C.strip_marker(F.col("raw_label")))
    return parts.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n"))


def coalesce_variants(spark, sf_dir):
    line, quantity = F.col("l_linenumber"), F.col("l_quantity")
    as_double = F.when(line <= 2, quantity + 0.5)
    as_int = F.when(line <= 4, quantity.cast("int"))
    as_text = F.when(line <= 6, F.concat(quantity.cast("int").cast("string"), F.lit(".25")))
    return S.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        C.coalesce_variants(as_double, as_int, as_text).alias("active"),
    )


def distinct_composite(spark, sf_dir):
    flag = F.nullif(F.col("l_returnflag"), F.lit("R"))
    objects = O.distinct_composite(flag, F.col("l_linenumber"))
    lines = S.table(spark, sf_dir, "lineitem")
    return lines.groupBy("l_orderkey").agg(objects.alias("objects"))


def quantities(spark, sf_dir):
    return S.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_returnflag",
        "l_linestatus",
        F.col("l_quantity").cast("bigint").alias("quantity"),
    )


def regroup(spark, sf_dir):
    lines = quantities(spark, sf_dir).withColumn("lines", F.lit(1).cast("bigint"))
    sums = ["quantity", "lines"]
    cells = ["l_orderkey", "l_returnflag", "l_linestatus"]
    by_worker = O.regroup(lines, [*cells, "l_suppkey"], sums)
    per_cell = O.regroup(by_worker.withColumn("parts", F.lit(1).cast("bigint")), cells, [*sums, "parts"])
    return O.regroup(per_cell, ["l_orderkey"], [*sums, "parts"])


def share_of_total(spark, sf_dir):
    shares = O.share_of_total(quantities(spark, sf_dir), "quantity", ["l_orderkey"], "share")
    return shares.withColumn("share_2", C.round_double(F.col("share"), 2))


def share_of_total_split(spark, sf_dir):
    """Shares per supplier, of many rows each."""
    lines = quantities(spark, sf_dir)
    shares = O.share_of_total(lines, "quantity", ["l_suppkey"], "share")
    return shares.withColumn("share_4", C.round_double(F.col("share"), 4))


def share_of_type(spark, sf_dir):
    typed = O.regroup(quantities(spark, sf_dir), ["l_orderkey", "l_linestatus"], ["quantity"])
    shares = O.share_of_total(typed, "quantity", ["l_orderkey"], "share")
    return shares.withColumn("share", C.round_double(F.col("share"), 2))


def _order_maps(spark, sf_dir):
    """Per order: share and line count by flag, as maps; 'R' lines are unlabelled."""
    lines = quantities(spark, sf_dir).select(
        "l_orderkey",
        F.when(F.col("l_returnflag") == "R", "")
        .otherwise(F.lower("l_returnflag"))
        .alias("label"),
        "quantity",
        F.lit(1).cast("bigint").alias("lines"),
    )
    cells = O.regroup(O.drop_blank(lines, "label"), ["l_orderkey", "label"], ["quantity", "lines"])
    shares = O.share_of_total(cells, "quantity", ["l_orderkey"], "share")
    return shares.groupBy("l_orderkey").agg(
        F.sum("quantity").alias("quantity"),
        O.map_agg(F.col("label"), C.round_double(F.col("share"), 2)).alias("shares"),
        O.map_agg(F.col("label"), F.col("lines")).alias("counts"),
    )


def map_json(spark, sf_dir):
    return _order_maps(spark, sf_dir).select(
        "l_orderkey",
        C.map_to_json(F.col("shares")).alias("shares"),
        C.map_to_json(F.col("counts")).alias("counts"),
    )


def per_object_minutes(spark, sf_dir):
    minutes = O.per_object_minutes(
        F.col("quantity"), F.col("shares"), F.col("counts"),
        {"a_tpo": "a", "n_tpo": "n", "x_tpo": "x"},
    )
    figures = _order_maps(spark, sf_dir).select("l_orderkey", *minutes)
    return figures.withColumn("x_tpo", F.col("x_tpo").isNull())


def time_per_object(spark, sf_dir):
    return R.time_per_object(S.time_stats(spark, sf_dir), S.TIME_PAIRS, S.CLASSES, S.TYPES)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        scope_pairs,
        scope_independent,
        scope_table,
        scope_table_independent,
        min_partition,
        classification_extract,
        json_key_list,
        json_scalar,
        distinct_where,
        distinct_counts,
        distinct_by_tag,
        issue_daily,
        latest_version,
        latest_attribute,
        latest_attribute_split,
        latest_attribute_table,
        remap_values,
        ms_to_seconds,
        stage_sequence,
        stage_iteration,
        latest_flag,
        stage_numbers_split,
        stage_history,
        stage_history_split,
        epoch_ms,
        task_rollup,
        normalize_label,
        coalesce_variants,
        distinct_composite,
        regroup,
        share_of_total,
        share_of_total_split,
        share_of_type,
        map_json,
        per_object_minutes,
        time_per_object,
    )
}
