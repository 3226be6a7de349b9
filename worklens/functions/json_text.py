"""JSON held as text in string columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reader options for JSON as the standard has it.
STANDARD = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
# Ends a text that is read; no text has it by accident.
_MARK = "-- end of the text --"


def _scalar_text(value: Column, raw: Column) -> Column:
    """``value`` unless it is the text of a JSON object or array.

    ``value`` can only be one if it starts with a bracket, so the type in
    ``raw`` (a variant) is looked up for those rows alone.
    """
    bracket = value.startswith("{") | value.startswith("[")
    is_text = F.schema_of_variant(raw) == F.lit("STRING")
    return F.when(~bracket, value).when(is_text, value)


def json_scalar(col: Column, path: str) -> Column:
    """Scalar at ``path`` as text.

    NULL for bad JSON, a missing path, JSON null, an object or an array.
    """
    raw = F.try_variant_get(F.try_parse_json(col), path, "variant")
    return _scalar_text(F.get_json_object(col, path), raw)


def json_key_list(col: Column, key: str = "key", strict: bool = True) -> Column:
    """Distinct scalars under ``key`` of a JSON array of objects, in first-seen order.

    An element without a scalar there counts as NULL, kept once. ``strict``
    fails on bad JSON, on anything but an array, and on text behind it; otherwise
    these give NULL.

    The parsers stop where the first value ends. So the text is read as the first
    of two elements, and must leave the second one as it is.
    """
    path = f"$.{key}"
    pair = F.concat(F.lit("["), col, F.lit(f',[{{"{key}":"{_MARK}"}}]]'))

    def exact() -> Column:
        """Any JSON, by the type of each element; several times the work."""
        parsed = F.parse_json(pair) if strict else F.try_parse_json(pair)
        both = F.try_variant_get(parsed, "$", "array<variant>")
        mark = F.try_variant_get(parsed, f"$[1][0].{key}", "string")
        alone = (F.size(both) == 2) & F.coalesce(mark == F.lit(_MARK), F.lit(False))
        first = F.try_variant_get(parsed, "$[0]", "array<variant>")
        if strict:
            fail = F.raise_error(F.concat(F.lit("not a JSON array and nothing else: "), col))
            null = F.is_variant_null(F.try_variant_get(parsed, "$[0]", "variant"))
            good = alone & (first.isNotNull() | null)
            elements = F.when(col.isNull() | good, first).otherwise(fail)
        else:
            elements = F.when(alone, first)
        return F.transform(
            elements,
            lambda element: _scalar_text(
                F.try_variant_get(element, path, "string"),
                F.try_variant_get(element, path, "variant"),
            ),
        )

    def keys_of(objects: Column) -> Column:
        """Plain arrays of objects straight from the parsed structs."""
        keys = objects[key]
        nested = F.exists(keys, lambda k: k.startswith("{") | k.startswith("["))
        plain = objects.isNotNull() & F.coalesce(~nested, F.lit(True))
        return F.when(plain, keys).otherwise(exact())

    def first_of(both: Column) -> Column:
        """The text's own array if all of the text is that array."""
        mark = F.get(F.get(both, F.lit(1)), F.lit(0))[key]
        alone = (F.size(both) == 2) & F.coalesce(mark == F.lit(_MARK), F.lit(False))
        return keys_of(F.when(alone, F.get(both, F.lit(0))))

    # A single object would be read as an array of one, so only texts that start
    # as an array are. The lambda keeps the parsed value from being made twice.
    both = F.from_json(
        F.when(F.startswith(col, F.lit("[")), pair), f"array<array<struct<`{key}`:string>>>", STANDARD
    )
    return F.array_distinct(F.get(F.transform(F.array(both), first_of), F.lit(0)))


def map_to_json(col: Column) -> Column:
    """Map to JSON text. Keys keep the map's own order; build it sorted for stable text."""
    return F.to_json(col)
