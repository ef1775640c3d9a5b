"""JSON payloads carried as text.

Each payload is parsed once per row. The parse sits in a generator: Catalyst
keeps filters on parsed fields above it, so a filter never repeats the parse as
it would if it were inlined into the condition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Same tolerance as the path getter: no NaN literals, raw control characters allowed.
_JSON_OPTIONS = {"allowNonNumericNumbers": "false", "allowUnquotedControlChars": "true"}


def repair_quotes(text: Column, lenient: bool = False) -> Column:
    """Single quotes to double quotes, as the models do.

    A text with an apostrophe becomes malformed by this and all its fields read
    as null. `lenient` skips the repair; the JSON reader takes single quotes
    itself, so proper JSON with apostrophes survives.
    """
    return text if lenient else F.replace(text, F.lit("'"), F.lit('"'))


def _spread(df: DataFrame, record: Column, fields: T.StructType, text: Column, place: str) -> DataFrame:
    """Adds the fields of a parsed record as text columns; objects and arrays in place of a scalar are null.

    The reader gives nested values as their text, like a string that looks the same. So a payload with a bracket
    after a colon, and no other, is parsed once more as a variant, which knows one from the other.
    """
    doubtful = F.when(text.rlike(r":\s*[\[{]"), F.try_parse_json(F.replace(text, F.lit("'"), F.lit('"'))))
    rows = df.select("*", F.inline(F.array(F.struct(record.alias("_record"), doubtful.alias("_variant")))))
    kept = [c for c in rows.columns if c not in ("_record", "_variant")]

    def scalar(name: str) -> Column:
        value = F.col("_record")[name]
        kind = F.schema_of_variant(F.try_variant_get("_variant", f"{place}.{name}", "variant"))
        nested = F.col("_variant").isNotNull() & F.coalesce(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(False))
        return F.when(~nested, value).alias(name)

    return rows.select(*[F.col(f"`{c}`") for c in kept], *[scalar(f.name) for f in fields])


def spread_first_element(
    df: DataFrame, payload: str, fields: T.StructType, lenient: bool = False
) -> DataFrame:
    """Adds the fields of element 0 of a JSON array as text columns.

    The array is parsed as a whole, which one pass does for all proper payloads.
    Arrays with elements of another kind come out null; only for those is element
    0 cut out first and parsed alone. An object in place of the array has none.
    Of a key that is repeated the last value counts.
    """
    text = repair_quotes(F.col(payload), lenient)
    in_array = F.get(F.from_json(text, T.ArrayType(fields), _JSON_OPTIONS), F.lit(0))
    alone = F.from_json(F.get_json_object(text, "$[0]"), fields, _JSON_OPTIONS)
    is_array = F.ltrim(text).startswith("[")
    return _spread(df, F.coalesce(F.when(is_array, in_array), alone), fields, text, "$[0]")


def spread_object(
    df: DataFrame, payload: str, fields: T.StructType, lenient: bool = False
) -> DataFrame:
    """Adds the fields of a JSON object as text columns; of a key that is repeated the last value counts."""
    text = repair_quotes(F.col(payload), lenient)
    return _spread(df, F.from_json(text, fields, _JSON_OPTIONS), fields, text, "$")


def spread_elements(
    df: DataFrame, payload: str, fields: T.StructType, place: str, lenient: bool = False
) -> DataFrame:
    """One row per element of a JSON array, with its place (from 0) and its fields as text columns.

    Rows without an array, and empty arrays, stay as one row with a null place. Elements are cut out as text
    first and parsed one by one, so an element of another kind has null fields and spoils no other. Of a key
    that is repeated the last value counts.
    """
    elements = F.from_json(repair_quotes(F.col(payload), lenient), T.ArrayType(T.StringType()), _JSON_OPTIONS)
    rows = df.select("*", F.posexplode_outer(elements).alias(place, "_element"))
    parsed = F.from_json(F.col("_element"), fields, _JSON_OPTIONS)
    return _spread(rows, parsed, fields, F.col("_element"), "$").drop("_element")
