"""Distinct counts.

``count(distinct ..)`` with several arguments makes Spark copy every row once
per argument. Counts of one entity under many conditions need no copies: reduce
to one row per entity with a flag for each condition, then add up the flags.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Conditions held in one bigint.
BITS = 63


def distinct_where(entity: Column, condition: Column) -> Column:
    """Aggregate: distinct entities among the rows where ``condition`` is true."""
    return F.count_distinct(F.when(condition, entity))


def distinct_composite(*parts: Column, separator: str = "_") -> Column:
    """Aggregate: distinct combinations of ``parts``; one with a NULL part does not count."""
    text = parts[0].cast("string")
    for part in parts[1:]:
        text = F.concat(text, F.lit(separator), part.cast("string"))
    return F.count_distinct(text)


def distinct_counts(
    df: DataFrame,
    group: Sequence[str],
    entity: str,
    conditions: Mapping[str, Column],
    total: str | None = None,
) -> DataFrame:
    """Per group, the distinct entities that meet each condition on any of their rows.

    Equals one ``distinct_where`` per condition. A NULL entity counts nowhere,
    but its group stays, with 0. Both steps combine before their shuffle, so
    neither a large group nor an often repeated entity ends up in one task. The
    conditions travel as bits of a number, not as a column each.
    """
    places = {name: divmod(at, BITS) for at, name in enumerate(conditions)}
    words: dict[int, Column] = {}
    for name, condition in conditions.items():
        word, bit = places[name]
        met = F.when(condition, F.lit(1 << bit)).otherwise(F.lit(0)).cast("bigint")
        words[word] = words[word].bitwiseOR(met) if word in words else met
    entities = df.groupBy(*group, entity)
    per_entity = (
        entities.agg(*[F.bit_or(w).alias(f"_met_{n}") for n, w in words.items()])
        if words
        else entities.agg(F.lit(True))
    )
    known = F.col(entity).isNotNull()

    def count(name: str) -> Column:
        word, bit = places[name]
        met = F.col(f"_met_{word}").bitwiseAND(F.lit(1 << bit)) != F.lit(0)
        return F.count_if(known & met).alias(name)

    totals = [F.count_if(known).alias(total)] if total else []
    return per_entity.groupBy(*group).agg(*totals, *[count(name) for name in conditions])


def distinct_by_tag(
    df: DataFrame,
    group: Sequence[str],
    entity: str,
    tags_col: str,
    tags: Mapping[str, str],
    total: str | None = None,
) -> DataFrame:
    """Per group, the distinct entities that carry each tag, one column per ``tags`` entry.

    Tags match as whole elements; an entity counts under every tag it carries.
    """
    carried = {
        name: F.array_contains(F.col(tags_col), F.lit(tag)) for name, tag in tags.items()
    }
    return distinct_counts(df, group, entity, carried, total)
