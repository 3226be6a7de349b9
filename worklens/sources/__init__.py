"""Input tables: schemas, loading, renaming."""

from .tables import (
    PAIR_COLUMNS,
    RENAMES,
    SCHEMAS,
    from_year,
    load,
    rename_source,
    scope_pairs,
)

__all__ = [
    "PAIR_COLUMNS",
    "RENAMES",
    "SCHEMAS",
    "from_year",
    "load",
    "rename_source",
    "scope_pairs",
]
