"""Restriction of a table to the tenants a report is made for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import PAIR_COLUMNS, scope_pairs


def _keep_listed(df: DataFrame, keys: Sequence[str], listed: DataFrame) -> DataFrame:
    listed = listed.select(*[F.col(k).alias(f"_listed_{k}") for k in keys])
    match = [F.col(k) == F.col(f"_listed_{k}") for k in keys]
    return df.join(listed, match, "left_semi")


def _tenants(df: DataFrame, pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A table of tenants in the names and types of ``keys``."""
    if len(pairs.columns) != len(keys):
        raise ValueError(f"a table of tenants has the columns of {list(keys)}, not {pairs.columns}")
    types = dict(df.dtypes)
    listed = pairs.toDF(*keys).select(*[F.col(k).cast(types[k]).alias(k) for k in keys])
    # Every value meets the second condition. It is there because Spark prunes by a joined table,
    # at run time, only where that table is filtered by a comparison.
    for key in keys:
        listed = listed.where(F.col(key).isNotNull() & (F.col(key).cast("string") >= F.lit("")))
    return listed


def scope(
    df: DataFrame,
    pairs: Sequence[tuple] | DataFrame,
    mode: str = "pair",
    keys: Sequence[str] = PAIR_COLUMNS,
) -> DataFrame:
    """Keep the rows of the listed ``(organization, project)`` pairs.

    ``mode="pair"`` tests both columns together; ``mode="independent"`` keeps any
    listed organization with any listed project.

    ``pairs`` is a list in the program, or a table whose columns are the keys in their order.
    Repeated pairs count once, and a pair with a NULL matches nothing.

    Of a list, each key is also filtered by its values, of any length, which
    reaches the scan: it prunes partitions by value, and row groups by the least
    and greatest of more than a few. All values are then literals of the plan, so
    long lists belong in a table: nothing of it is in the plan, and the tenants prune
    the partitions at run time, where Spark broadcasts them, by the broadcast rows.

    The semi join decides. Spark itself broadcasts the tenants while their known size is below
    ``autoBroadcastJoinThreshold`` and shuffles them beyond.
    """
    if mode not in ("pair", "independent"):
        raise ValueError(f"mode must be 'pair' or 'independent', not {mode!r}")
    if isinstance(pairs, DataFrame):
        listed = _tenants(df, pairs, keys)
    else:
        for position, key in enumerate(keys):
            values = sorted({p[position] for p in pairs if p[position] is not None})
            if values:
                df = df.where(F.col(key).isin(*values))
        listed = scope_pairs(df.sparkSession, pairs, df.select(*keys).schema)
    if mode == "pair":
        return _keep_listed(df, keys, listed)
    for key in keys:
        df = _keep_listed(df, [key], listed)
    return df
