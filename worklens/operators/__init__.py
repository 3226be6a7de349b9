"""DataFrame transformations the reports are built from."""

from .counts import distinct_by_tag, distinct_composite, distinct_counts, distinct_where
from .tenants import scope
from .ordering import iteration, latest_flag, number_stages, sequence
from .shares import drop_blank, map_agg, per_object_minutes, regroup, share_of_total
from .values import remap_values
from .versions import attach_latest, attach_latest_attribute, latest_attribute, latest_by

__all__ = [
    "attach_latest",
    "attach_latest_attribute",
    "distinct_by_tag",
    "distinct_composite",
    "distinct_counts",
    "distinct_where",
    "drop_blank",
    "iteration",
    "latest_attribute",
    "latest_by",
    "latest_flag",
    "map_agg",
    "number_stages",
    "per_object_minutes",
    "regroup",
    "remap_values",
    "scope",
    "sequence",
    "share_of_total",
]
