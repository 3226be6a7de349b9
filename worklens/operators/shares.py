"""Regrouping, shares of a total, key/value maps and the figures made of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import round_double


def drop_blank(df: DataFrame, column: str) -> DataFrame:
    """Drop the rows where ``column`` is NULL or empty."""
    return df.where(F.col(column) != F.lit(""))


def regroup(df: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Add up ``sums`` at the coarser grain ``keys``."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


# Exponents of two that one bin of an exact sum spans, and the bits of a double.
_SPAN, _BITS = 32, 53


def _scaled(x: Column, exponent: Column) -> Column:
    """``x`` times two to the power of ``exponent``, in two factors that stay within a double."""
    half = F.floor(exponent / F.lit(2))
    return x * F.pow(F.lit(2.0), half.cast("double")) * F.pow(F.lit(2.0), (exponent - half).cast("double"))


def exact_totals(df: DataFrame, value: str, keys: Sequence[str], name: str) -> DataFrame:
    """Sum of ``value`` per key as a double, the same bits in whatever order rows are added.

    Doubles are cut into two whole numbers on the scale of their size; these
    are added without rounding, and only the few sums of a key are added as
    doubles, from the small to the large. The least doubles count like the others. NaN and infinities add up as usual. Other types are added as they are.
    """
    if dict(df.dtypes)[value] not in ("double", "float"):
        return df.groupBy(*keys).agg(F.sum(value).cast("double").alias(name))
    x = F.col(value).cast("double")
    odd = F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    finite = F.when(~odd, x)
    size = F.floor(F.log2(F.abs(finite)) / F.lit(float(_SPAN))).cast("int")
    # zero has no logarithm and fits in any bin
    bins = F.coalesce(F.when(finite != 0, size), F.lit(0))
    parts = df.select(*keys, x.alias("_x"), odd.alias("_odd"), finite.alias("_finite"), bins.alias("_bin"))
    scaled = _scaled(F.col("_finite"), F.lit(_BITS) - F.lit(_SPAN) * F.col("_bin"))
    high = F.floor(scaled / F.lit(2.0**32))
    low = F.floor(scaled - high.cast("double") * F.lit(2.0**32))
    per_bin = parts.groupBy(*keys, "_bin").agg(
        F.sum(high.cast("decimal(20,0)")).alias("_high"),
        F.sum(low.cast("decimal(20,0)")).alias("_low"),
        F.sum(F.when(F.col("_odd"), F.col("_x"))).alias("_special"),
    )
    whole = F.col("_high").cast("double") * F.lit(2.0**32) + F.col("_low").cast("double")
    sized = _scaled(whole, F.lit(_SPAN) * F.col("_bin") - F.lit(_BITS))
    entry = F.when(whole.isNotNull(), F.struct(F.col("_bin"), sized.alias("_sized")))
    collected = per_bin.groupBy(*keys).agg(
        F.array_sort(F.collect_list(entry)).alias("_bins"), F.sum("_special").alias("_special")
    )
    added = F.aggregate("_bins", F.lit(0.0), lambda total, b: total + b["_sized"])
    total = F.coalesce(F.col("_special"), F.when(F.size("_bins") > 0, added))
    return collected.select(*keys, total.alias(name))


def share_of_total(df: DataFrame, value: str, keys: Sequence[str], name: str) -> DataFrame:
    """``value`` as a share of its sum over ``keys``; NULL where the sum is 0 or NULL.

    Totals are combined before their shuffle and joined back by Spark's choice of
    join, which splits keys with many rows. Doubles give the same bits however
    the rows are spread.
    """
    renamed = {k: f"_total_{k}" for k in keys}
    totals = exact_totals(df, value, keys, "_total").withColumnsRenamed(renamed)
    match = [F.col(k).eqNullSafe(F.col(t)) for k, t in renamed.items()]
    part = F.col(value).cast("double")
    joined = df.join(totals, match)
    return joined.withColumn(name, F.try_divide(part, F.col("_total"))).drop("_total", *renamed.values())


def map_agg(key: Column, value: Column, tie: Column | None = None) -> Column:
    """Aggregate: map of ``key`` to ``value``, in key order; NULL if there is no key.

    NULL keys are skipped. Of several rows with one key the value of the least
    ``tie`` is kept, then the least value. A group's keys end up in one row, so
    aggregate to one row per key first where a key may repeat without bound.
    """
    entry = F.struct(
        key.alias("key"),
        *([] if tie is None else [tie.alias("tie")]),
        value.alias("value"),
    )
    collected = F.array_sort(F.collect_list(F.when(key.isNotNull(), entry)))

    def to_map(entries: Column) -> Column:
        first_of_key = F.filter(
            entries,
            lambda e, at: (at == 0) | (F.get(entries, at - 1)["key"] != e["key"]),
        )
        pairs = F.transform(first_of_key, lambda e: F.struct(e["key"], e["value"]))
        return F.when(F.size(entries) > 0, F.map_from_entries(pairs))

    # The lambda keeps the sorted entries from being made again at every use.
    return F.get(F.transform(F.array(collected), to_map), F.lit(0))


def per_object_minutes(
    seconds: Column, shares: Column, counts: Column, keys: Mapping[str, str]
) -> list[Column]:
    """Minutes per object for each key: seconds x share / count / 60, one decimal.

    ``keys`` maps a column name to the key in both maps. NULL where the key is
    absent or its count is 0.
    """
    figures = []
    for name, key in keys.items():
        time = seconds.cast("double") * shares[key]
        minutes = F.try_divide(time, counts[key].cast("double")) / F.lit(60.0)
        figures.append(round_double(minutes, 1).alias(name))
    return figures
