"""Schemas of the input tables and how they are read.

Schemas are explicit: nothing is inferred from the files, and ``year`` stays a
string so that the string comparison of the reports reaches partition pruning.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

PAIR_COLUMNS = ("organization_id", "project_id")

# Column names as they are stored.
SCHEMAS: dict[str, str] = {
    "issues": """
        organization_id string, project_id string, labeltaskid string,
        document_id string, status string, deleted boolean, updatedat bigint,
        error_code string, year string""",
    "classifications": """
        organization_id string, project_id string, labeltaskid string,
        document_id string, objectid string, title string, answer string,
        tool string, updatedby string, updatedat bigint""",
    "stage_logs": """
        organization_id string, project_id string, projectname string,
        batch_details string, labeltaskid string, document_id string,
        stage string, stagename string, stage_type string, rework boolean,
        iscompleted boolean, isskipped boolean, updatedby string,
        updatedat bigint, duration bigint, idleduration bigint,
        blurduration bigint, number_of_pages int, year string""",
    "time_stats": """
        organization_id string, project_id string, batch string,
        `detail.val.taskcode` string, email string,
        `detail.val.currentframeactivetime.double` double,
        `detail.val.currentframeactivetime.int` int,
        `detail.val.currentframeactivetime` string, frame int, action string,
        action_phase string, drawable string, class string, identity bigint,
        object_id string, start bigint, time_spent bigint, detail string""",
    "task_sessions": """
        organization_id string, project_id string, batch_code string,
        task_code string, start_timestamp bigint, timestamp bigint,
        user string, active_time bigint, sequence_num string,
        annotations string""",
}

# Stored name -> name used here. Covers names with dots, and ``user``, which
# Spark silently reads as ``current_user()`` where no such column exists.
RENAMES: dict[str, dict[str, str]] = {
    "issues": {"document_id": "issue_id"},
    "time_stats": {
        "detail.val.taskcode": "document_id",
        "email": "updatedby",
        "detail.val.currentframeactivetime.double": "frame_time_double",
        "detail.val.currentframeactivetime.int": "frame_time_int",
        "detail.val.currentframeactivetime": "frame_time_text",
        "drawable": "object_type",
    },
    "task_sessions": {"task_code": "document_id", "user": "updatedby"},
}


def load(
    spark: SparkSession,
    directory: str | None,
    name: str,
    schema: str | T.StructType | None = None,
    min_year: str | None = None,
) -> DataFrame:
    """Read ``directory/name`` as parquet, or the catalog table ``name`` without a directory.

    ``schema`` names the columns and types to read; of a catalog table they are
    picked and cast.

    ``min_year`` keeps ``year >= min_year`` in string order; on a table
    partitioned by ``year`` it prunes the directories.
    """
    if directory is None:
        df = spark.table(name)
        if schema is not None:
            wanted = spark.createDataFrame([], schema).schema
            df = df.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in wanted])
    else:
        reader = spark.read if schema is None else spark.read.schema(schema)
        df = reader.parquet(f"{directory}/{name}")
    return df if min_year is None else from_year(df, min_year)


def from_year(df: DataFrame, min_year: str | None) -> DataFrame:
    """Rows of ``min_year`` and later, in string order; all rows for ``None``."""
    return df if min_year is None else df.where(F.col("year") >= F.lit(min_year))


def rename_source(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename stored columns; names already renamed are left alone.

    A name found under neither its old nor its new form is an error here, not a
    silent NULL or ``current_user()`` later on.
    """
    present = set(df.columns)
    missing = [
        old for old, new in mapping.items() if old not in present and new not in present
    ]
    if missing:
        raise ValueError(f"columns not found: {missing}; present: {sorted(present)}")
    return df.withColumnsRenamed({o: n for o, n in mapping.items() if o in present})


def scope_pairs(
    spark: SparkSession,
    pairs: Sequence[tuple],
    schema: T.StructType | None = None,
) -> DataFrame:
    """Constant relation of ``(organization, project)`` pairs, each listed once.

    Built through Arrow, it is a local relation: Spark knows its exact size.
    """
    if schema is None:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in PAIR_COLUMNS])
    rows = list(dict.fromkeys(tuple(p) for p in pairs))
    columns = list(zip(*rows)) if rows else [() for _ in schema]
    table = pa.Table.from_arrays(
        [pa.array(list(c), type=f.type) for c, f in zip(columns, to_arrow_schema(schema))],
        names=schema.names,
    )
    return spark.createDataFrame(table)
