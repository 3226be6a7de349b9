"""Newest version of a record, newest value of an attribute."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_by(
    df: DataFrame, keys: Sequence[str], order: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Newest row of each key; a row without a time only if the key has no other.

    Rows of the same time are decided by ``tiebreak`` and then by the remaining
    columns, greatest first, so the choice is the same on every run.

    Spark limits each group to one row per task before the shuffle, however often
    a key occurs. As all columns take part in the order, all are shuffled, and
    several readers of the result share one exchange.
    """
    rest = [c for c in df.columns if c not in {order, *keys, *tiebreak}]
    newest_first = Window.partitionBy(*keys).orderBy(
        *[F.col(c).desc_nulls_last() for c in (order, *tiebreak, *rest)]
    )
    numbered = df.withColumn("_rn", F.row_number().over(newest_first))
    return numbered.where(F.col("_rn") == 1).drop("_rn")


def latest_attribute(
    df: DataFrame, key: str, attribute: str, order: str
) -> DataFrame:
    """Value of ``attribute`` at the greatest ``order`` per key.

    A NULL value there is returned; rows without an order are ignored. Rows of
    the same order are decided by the greatest value.

    The greatest order of each value is hash-aggregated, combined before the
    shuffle; only the values of a key, not its rows, are then put in order.
    """
    per_value = df.groupBy(key, attribute).agg(F.max(order).alias("_order"))
    newest_first = Window.partitionBy(key).orderBy(
        F.col("_order").desc_nulls_last(), F.col(attribute).desc_nulls_last()
    )
    newest = per_value.withColumn("_rn", F.row_number().over(newest_first)).where("_rn = 1")
    ordered = F.when(F.col("_order").isNotNull(), F.col(attribute))
    return newest.select(key, ordered.alias(attribute))


def attach_latest(df: DataFrame, newest: DataFrame) -> DataFrame:
    """Replace an attribute by its value in a table of ``latest_attribute``; a NULL key gets NULL."""
    key, attribute = newest.columns
    named = newest.select(F.col(key).alias("_key"), F.col(attribute).alias("_newest"))
    joined = df.join(named, F.col(key) == F.col("_key"), "left")
    return joined.withColumn(attribute, F.col("_newest")).drop("_key", "_newest")


def attach_latest_attribute(df: DataFrame, key: str, attribute: str, order: str) -> DataFrame:
    """Replace ``attribute`` by its newest value per key; a NULL key gets NULL.

    Spark picks the join by the size of the table of values, and splits keys
    with many rows where that is shuffled.
    """
    return attach_latest(df, latest_attribute(df, key, attribute, order))
