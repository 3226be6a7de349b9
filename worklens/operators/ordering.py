"""Numbering of rows within a group by time.

All functions need ``tiebreak`` columns that make the order within a group
unique; otherwise numbers could differ between runs. NULL times come last.

No group is one task's work: large ones are dealt to cells, ranges of the order (see
``cells``), which are numbered on their own. Of the groups that span several cells, the rows of each cell
are counted before the shuffle, added up in the cells' order, and joined back. ``like`` and ``ranges``
are those of ``in_cells``; they never change a number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cells import CELL, KEY, SPLIT, in_cells

_EARLIER, _LATER, _TIMED = "_w_earlier", "_w_later", "_w_timed"


def _by_time(order: str, tiebreak: Sequence[str]) -> list[Column]:
    return [F.col(order).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tiebreak]]


def _other_cells(rows: DataFrame, order: str, node: str | None) -> DataFrame:
    """Of each cell of a split group: the rows before it, of each node too, and what comes after it.

    A group's cells are no more than its cuts and one, and the cells of all groups
    no more than twice the shuffle partitions.
    """
    nodes = [] if node is None else [F.col(node).alias("_w_node")]
    of_node = ["_w_node"] if nodes else []
    counted = (
        rows.where(SPLIT)
        .groupBy(KEY, F.col(CELL), *nodes)
        .agg(F.count(F.lit(1)).alias("_w_rows"), F.count(order).alias(_TIMED))
        .repartition(KEY)
    )
    if nodes:
        up_to_here = Window.partitionBy(KEY, "_w_node").orderBy(CELL)
        before = F.sum("_w_rows").over(up_to_here) - F.col("_w_rows")
        counted = counted.withColumn("_w_before", F.struct(F.struct("_w_node").alias("k"), before.alias("v")))
    per_cell = counted.groupBy(KEY, CELL).agg(
        F.sum("_w_rows").alias("_w_rows"),
        F.sum(_TIMED).alias(_TIMED),
        *[F.map_from_entries(F.collect_list("_w_before")).alias("_w_nodes") for _ in of_node],
    )
    in_order = Window.partitionBy(KEY).orderBy(CELL)
    after = in_order.rowsBetween(1, Window.unboundedFollowing)
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return per_cell.select(
        F.col(CELL).alias("_w_of_cell"),
        (F.sum("_w_rows").over(in_order) - F.col("_w_rows")).alias(_EARLIER),
        F.struct(
            F.coalesce(F.sum("_w_rows").over(after), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(_TIMED).over(after), F.lit(0)).alias("timed"),
            F.sum(_TIMED).over(whole).alias("any_timed"),
        ).alias(_LATER),
        *(["_w_nodes"] if nodes else []),
    )


def _number(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    tiebreak: Sequence[str],
    like: DataFrame | None,
    ranges: int | None,
    flow: str | None = None,
    flag: str | None = None,
    iterations: tuple[str, str] | None = None,
) -> DataFrame:
    """Add the named numbers; ``iterations`` is the node's column and the number's name."""
    columns = df.columns
    node = iterations and iterations[0]
    rows = in_cells(df, keys, [order, *tiebreak], like, ranges)
    in_cell = Window.partitionBy(CELL).orderBy(*_by_time(order, tiebreak))
    has_time = F.col(order).isNotNull()
    numbered = rows.withColumns(
        {
            "_w_place": F.row_number().over(in_cell).cast("bigint"),
            "_w_next": F.lead(has_time).over(in_cell),
            # Rows with a time come first in a cell.
            "_w_first": F.first(has_time).over(in_cell),
        }
    )
    if node is not None:
        of_node = Window.partitionBy(CELL, node).orderBy(*_by_time(order, tiebreak))
        numbered = numbered.withColumn("_w_of_node", F.row_number().over(of_node).cast("bigint"))
    others = _other_cells(rows, order, node)
    if node is None:
        others = F.broadcast(others)  # one row per cell of a split group
    joined = numbered.join(others, F.col(CELL) == F.col("_w_of_cell"), "left")
    zero = F.lit(0).cast("bigint")

    def later(field: str) -> Column:
        return F.coalesce(F.col(_LATER)[field], zero)

    last_timed = has_time & ~F.coalesce("_w_next", F.lit(False)) & (later("timed") == 0)
    no_time = ~F.col("_w_first") & (later("any_timed") == 0)
    last = last_timed | (no_time & F.col("_w_next").isNull() & (later("rows") == 0))
    made = {}
    if flow is not None:
        made[flow] = F.col("_w_place") + F.coalesce(_EARLIER, zero)
    if flag is not None:
        made[flag] = F.when(last, F.lit("Yes")).otherwise(F.lit("Other"))
    if iterations is not None:
        earlier = F.col("_w_nodes")[F.struct(F.col(node).alias("_w_node"))]
        made[iterations[1]] = F.col("_w_of_node") + F.coalesce(earlier, zero)
    kept = [c for c in columns if c not in made]
    return joined.select(*[F.col(f"`{c}`") for c in kept], *[value.alias(name) for name, value in made.items()])


def sequence(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    tiebreak: Sequence[str],
    name: str = "stage_flow",
    like: DataFrame | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Position 1..n of each row within ``keys``, by ``order`` ascending."""
    return _number(df, keys, order, tiebreak, like, ranges, flow=name)


def iteration(
    df: DataFrame,
    keys: Sequence[str],
    node: str,
    order: str,
    tiebreak: Sequence[str],
    name: str = "node_iteration",
    like: DataFrame | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """How often the value in ``node`` has occurred within ``keys`` up to this row."""
    return sequence(df, [*keys, node], order, tiebreak, name, like, ranges)


def latest_flag(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    tiebreak: Sequence[str],
    name: str = "is_latest",
    like: DataFrame | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """``'Yes'`` on the newest row of each group, ``'Other'`` on the rest.

    The newest row is the last one with a time, or the last one of a group
    without any.
    """
    return _number(df, keys, order, tiebreak, like, ranges, flag=name)


def number_stages(
    df: DataFrame,
    keys: Sequence[str],
    node: str,
    order: str,
    tiebreak: Sequence[str],
    like: DataFrame | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """``sequence``, ``iteration`` and ``latest_flag`` at once, over one exchange of the rows.

    A group's numbers per node are kept per cell, as a map of the nodes in it.
    """
    return _number(
        df, keys, order, tiebreak, like, ranges, "stage_flow", "is_latest", (node, "node_iteration")
    )
