"""Column expressions that condense spans the way reports compare them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` of an array of such structs, comma-joined in its order."""
    return F.array_join(
        F.transform(
            spans,
            lambda x: F.concat_ws(
                ":", x["kind"], x["start"].cast("string"), x["end"].cast("string")
            ),
        ),
        ",",
    )


def of_kinds(spans: Column, kinds: Sequence[str]) -> Column:
    return F.filter(spans, lambda x: x["kind"].isin(*kinds))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(of_kinds(spans, [kind])).cast("long")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
