"""The reports' input tables, derived from the driver's tables.

Each function keeps all rows of its table. Columns the source lacks are made
from others by expressions that SQL can repeat exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from worklens.sources import load

# Listed tenants of the stand-ins. Each leaves out an organization, and pairs of
# a listed organization with a listed project; one pair has no rows.
ISSUE_PAIRS = [("org-0", "prj-F"), ("org-1", "prj-O"), ("org-1", "prj-F"), ("org-9", "prj-Z")]
EVENT_PAIRS = [("org-0", "prj-1"), ("org-0", "prj-2"), ("org-1", "prj-3"), ("org-1", "prj-7"),
               ("org-1", "prj-8")]
ANSWER_PAIRS = [("org-0", "prj-0"), ("org-1", "prj-1")]
TIME_PAIRS = [("org-0", "prj-1"), ("org-1", "prj-0"), ("org-1", "prj-1")]
# Pairs that select part of lineitem, by (l_suppkey, l_linenumber).
LINE_PAIRS = [(3, 1), (7, 2), (7, 5), (20, 4), (41, 1), (77, 7)]

# Tags of the issue stand-in; the last one never occurs.
TAGS = {
    "flag_a": "A",
    "flag_n": "N",
    "flag_r": "R",
    "line_1": "L1",
    "line_2": "L2",
    "line_3": "L3",
    "line_4": "L4",
    "line_5": "L5",
    "line_6": "L6",
    "line_7": "L7",
    "status_f": "F",
    "status_o": "O",
    "absent": "Absent",
}
# Five event types; the first two are counted as one stage.
LABELS = {"Audit": ["click", "view"]}
CLASSES = ["type_a", "type_n"]
TYPES = ["O", "F"]
# Not the first years of the data.
FIRST_YEAR_EVENTS = "2024"
FIRST_YEAR_LINES = "1996"


def tenant(org: str, orgs: int, project: Column) -> list[Column]:
    number = F.pmod(F.col(org), F.lit(orgs)).cast("string")
    return [
        F.concat(F.lit("org-"), number).alias("organization_id"),
        F.concat(F.lit("prj-"), project).alias("project_id"),
    ]


def modulo(col: str, n: int) -> Column:
    return F.pmod(F.col(col), F.lit(n)).cast("string")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load(spark, sf_dir, f"{name}.parquet")


def text(col: str) -> Column:
    return F.col(col).cast("string")


def epoch_us(col: str) -> Column:
    """Microseconds of a zone-less timestamp, whatever the session zone."""
    time = F.col(col)
    minutes = F.hour(time) * 60 + F.minute(time)
    whole = F.unix_date(F.to_date(time)).cast("bigint") * 86_400 + minutes * 60
    second = F.extract(F.lit("SECOND"), time)
    return whole * 1_000_000 + (second * 1_000_000).cast("bigint")


def epoch_s(col: str) -> Column:
    return F.call_function("div", epoch_us(col), F.lit(1_000_000))


def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One issue row per order line: the supplier is the issue, three tags per row.

    Some lines have no status, no answer whether they are deleted, no time, or no codes.
    """
    line = F.col("l_linenumber")
    timeless = (line == 6) & (F.col("l_orderkey") % 7 == 0)
    quoted = [F.col("l_returnflag"), F.concat(F.lit("L"), text("l_linenumber")),
              F.col("l_linestatus"), F.col("l_returnflag")]
    objects = [F.concat(F.lit('{"key":"'), tag, F.lit('"}')) for tag in quoted]
    return table(spark, sf_dir, "lineitem").select(
        *tenant("l_orderkey", 3, F.col("l_linestatus")),
        F.lit("lt-1").alias("labeltaskid"),
        text("l_suppkey").alias("document_id"),
        F.when(line == 5, F.lit(None).cast("string"))
        .when(F.col("l_returnflag") == "A", "Open")
        .when(F.col("l_returnflag") == "R", "Resolved")
        .otherwise("Other")
        .alias("status"),
        F.when(line != 2, line == 7).alias("deleted"),
        F.when(~timeless, epoch_s("l_shipdate") + F.col("l_orderkey") * 5).alias("updatedat"),
        F.when(line != 4, F.concat(F.lit("["), F.concat_ws(",", *objects), F.lit("]"))).alias(
            "error_code"
        ),
        F.year("l_shipdate").cast("string").alias("year"),
    )


def classifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        *tenant("user_id", 2, modulo("event_id", 3)),
        text("user_id").alias("labeltaskid"),
        text("event_id").alias("document_id"),
        F.concat(F.lit("o"), text("event_id")).alias("objectid"),
        F.col("event_type").alias("title"),
        F.col("props").alias("answer"),
        F.lit("box").alias("tool"),
        F.concat(F.lit("w"), text("user_id")).alias("updatedby"),
        F.when(F.col("event_id") % 11 != 0, epoch_s("ts")).alias("updatedat"),
    )


def stage_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log version per event: the user is the task, ``props.k`` the document.

    The first hours of a day count as the year before; some events have no time or no stage name.
    """
    user = text("user_id")
    return table(spark, sf_dir, "events").select(
        *tenant("user_id", 3, F.left(user, F.lit(1))),
        F.concat(F.lit("name "), "event_type", F.lit(" "), user).alias("projectname"),
        F.concat(F.lit('[{"batch_name":"b-'), "event_type", F.lit('"}]')).alias("batch_details"),
        user.alias("labeltaskid"),
        F.get_json_object("props", "$.k").alias("document_id"),
        F.concat(F.lit("s-"), "event_type").alias("stage"),
        F.when(F.col("event_id") % 17 != 0, F.col("event_type")).alias("stagename"),
        F.lit("manual").alias("stage_type"),
        (F.col("value") > 50).alias("rework"),
        (F.col("value") > 20).alias("iscompleted"),
        (F.col("value") < 1).alias("isskipped"),
        F.concat(F.lit("w"), user).alias("updatedby"),
        F.when(F.col("event_id") % 13 != 0, epoch_s("ts")).alias("updatedat"),
        (F.col("event_id") * 37).alias("duration"),
        (F.col("event_id") * 3).alias("idleduration"),
        (F.col("event_id") * 50).alias("blurduration"),
        F.length("event_type").alias("number_of_pages"),
        (F.year("ts") - F.when(F.hour("ts") < 6, 1).otherwise(0)).cast("string").alias("year"),
    )


def time_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One time record per order line: the order is the document.

    'R' lines have an empty class, seventh lines none.
    """
    order = text("l_orderkey")
    return table(spark, sf_dir, "lineitem").select(
        *tenant("l_orderkey", 3, modulo("l_orderkey", 2)),
        F.concat(F.lit("BC-"), order).alias("batch"),
        order.alias("detail.val.taskcode"),
        F.concat(F.lit("w"), text("l_suppkey")).alias("email"),
        F.lit(None).cast("double").alias("detail.val.currentframeactivetime.double"),
        F.lit(None).cast("int").alias("detail.val.currentframeactivetime.int"),
        F.lit(None).cast("string").alias("detail.val.currentframeactivetime"),
        F.col("l_linestatus").alias("drawable"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string"))
        .when(F.col("l_returnflag") == "R", "")
        .otherwise(F.concat(F.lit("Type "), "l_returnflag"))
        .alias("class"),
        F.col("l_linenumber").cast("bigint").alias("identity"),
        text("l_partkey").alias("object_id"),
        (F.col("l_quantity").cast("bigint") * 1000 + F.col("l_linenumber") * 10).alias("time_spent"),
    )


def task_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = epoch_s("l_shipdate") * 1000
    return table(spark, sf_dir, "lineitem").select(
        *tenant("l_suppkey", 3, modulo("l_orderkey", 2)),
        F.concat(F.lit("BC-"), text("l_orderkey"), F.lit("-BC-x")).alias("batch_code"),
        F.col("l_returnflag").alias("task_code"),
        F.when(F.col("l_linenumber") != 6, start + F.col("l_linenumber") * 777).alias("start_timestamp"),
        (start + F.col("l_linenumber") * 77_777).alias("timestamp"),
        F.concat(F.lit("w"), text("l_suppkey")).alias("user"),
        F.when(F.col("l_linenumber") != 5, F.col("l_quantity").cast("bigint")).alias("active_time"),
        text("l_linenumber").alias("sequence_num"),
        F.lit("{}").alias("annotations"),
    )
