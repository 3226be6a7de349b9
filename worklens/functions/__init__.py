"""Column expressions. Every function takes and returns a ``Column``."""

from .clock import epoch_to_local, local_day
from .json_text import json_key_list, json_scalar, map_to_json
from .numbers import coalesce_variants, ms_to_seconds, round_double
from .text import normalize_label, strip_marker

__all__ = [
    "coalesce_variants",
    "epoch_to_local",
    "json_key_list",
    "json_scalar",
    "local_day",
    "map_to_json",
    "ms_to_seconds",
    "normalize_label",
    "round_double",
    "strip_marker",
]
