"""Groups dealt to several tasks, in order.

A window puts a whole group into one task. Here the rows, in the order of their key, time and
tiebreak, are cut into ranges, by default as many as there are shuffle partitions, at values sampled
from them. A group without a cut inside stays together; one with a third of all rows
gets a third of the cuts, and its rows between two cuts are a cell of their own. Windows
run over cells, and what a cell needs to know of its group's other cells is
added up per cell before the shuffle and joined back.

Sampling runs two small jobs over the key, time and tiebreak columns when the
operator is called. The cuts are constants of the plan from then on, so the cells are the same in
every task and on every retry, and any cuts give right results: they only decide how even the cells are.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Sampled rows per range.
PER_RANGE = 20

#: Columns named like these are reserved while rows are in cells.
RESERVED = "_w_"
KEY, CELL, SPLIT = "_w_key", "_w_cell", "_w_split"
_AT, _CUTS = "_w_at", "_w_cuts"


def _place(columns: Sequence[str]) -> Column:
    """The columns as one value; NULL comes last."""
    fields = [f for c in columns for f in (F.col(c).isNull().alias(f"{c}_null"), F.col(c).alias(c))]
    return F.struct(*fields)


def _cut_values(
    df: DataFrame, keys: Sequence[str], by: Sequence[str], ranges: int
) -> tuple[DataFrame, int] | None:
    """The sampled cuts of each key that has some, in ascending order, and the most a key has."""
    spark = df.sparkSession
    rows = df.select(F.struct(*keys).alias(KEY), _place(by).alias(_AT))
    total = rows.count()
    if not total:
        return None
    sampled = rows.sample(min(1.0, PER_RANGE * ranges / total), 0).repartition(1)
    ordered = sampled.sortWithinPartitions(KEY, _AT).toArrow()
    # Cuts at even distances; each begins a range.
    apart = max(1, ordered.num_rows // ranges)
    cuts = ordered.take(pa.array(range(apart, ordered.num_rows, apart), pa.int64())).combine_chunks()
    if not cuts.num_rows:
        return None
    of = cuts[KEY].to_pylist()
    begins = [i for i in range(len(of)) if not i or of[i] != of[i - 1]]
    places = cuts[_AT].combine_chunks()
    lists = pa.ListArray.from_arrays(pa.array([*begins, len(of)], pa.int32()), places)
    made = pa.table({KEY: cuts[KEY].take(pa.array(begins)), _CUTS: lists})
    schema = T.StructType([rows.schema[KEY], T.StructField(_CUTS, T.ArrayType(rows.schema[_AT].dataType))])
    return spark.createDataFrame(made, schema), max(b - a for a, b in pairwise([*begins, len(of)]))


def in_cells(
    df: DataFrame,
    keys: Sequence[str],
    by: Sequence[str],
    like: DataFrame | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """``df`` with its key, its cell, and whether its key is split.

    ``like`` is a table to sample instead, with the columns ``keys`` and ``by``: cheaper to
    read, and much the same in its distribution. ``ranges`` is the number of ranges, by default
    that of the shuffle partitions.
    """
    if taken := [c for c in df.columns if c.startswith(RESERVED)]:
        raise ValueError(f"columns named like internal ones: {taken}")
    keyed = df.withColumn(KEY, F.struct(*keys))
    if ranges is None:
        ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = _cut_values(df if like is None else like, keys, by, ranges)
    if found is None:
        return keyed.withColumns({CELL: F.struct(KEY, F.lit(0).alias("cut")), SPLIT: F.lit(False)})
    cuts, most = found
    # How many of the key's cuts are not beyond the row, by halves.
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(most.bit_length()))])
    count = F.aggregate(
        steps,
        F.lit(0),
        lambda n, step: F.when(F.get(_CUTS, n + step - 1) <= F.col(_AT), n + step).otherwise(n),
    )
    cut = F.when(F.col(_CUTS).isNull(), F.lit(0)).otherwise(count)
    # Fewer rows than ranges, up to rounding.
    joined = keyed.withColumn(_AT, _place(by)).join(F.broadcast(cuts), KEY, "left")
    return joined.withColumns(
        {CELL: F.struct(KEY, cut.alias("cut")), SPLIT: F.col(_CUTS).isNotNull()}
    ).drop(_AT, _CUTS)
