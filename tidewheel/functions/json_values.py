"""Typed reads from VARIANT values.

A plain cast is too generous for validation: it cuts 5.5 to 5 and turns numbers into text.
These readers look at the stored JSON type first and give NULL for anything they refuse.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

_WHOLE_NUMBER_TEXT = r"^\s*[+-]?[0-9]+(\.0+)?\s*$"
_NUMBER_TEXT = r"(?i)^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)(e[+-]?[0-9]+)?\s*$|^\s*[+-]?(inf(inity)?|nan)\s*$"


def member(value: Column, path: str) -> Column:
    """Sub-value at ``path``; NULL when absent, a VARIANT null when JSON null."""
    return F.try_variant_get(value, path, "variant")


def json_type(value: Column, path: str = "$") -> Column:
    """Spark type name of the stored value, e.g. BIGINT, DECIMAL(2,1), OBJECT<...>, VOID."""
    return F.schema_of_variant(member(value, path))


def is_object(value: Column, path: str = "$") -> Column:
    return F.coalesce(json_type(value, path).startswith("OBJECT"), F.lit(False))


def is_absent(value: Column, path: str) -> Column:
    """True for a missing key as well as for JSON null."""
    found = member(value, path)
    return found.isNull() | F.is_variant_null(found)


def strict_long(value: Column, path: str) -> Column:
    """A JSON integer, nothing else: no booleans, no numeric text, no 5.0."""
    return F.when(json_type(value, path) == "BIGINT", F.try_variant_get(value, path, "bigint"))


def fields(value: Column, paths: Iterable[str]) -> Column:
    """Sub-values at ``a`` or ``a.b`` paths as one (nested) struct of VARIANTs, from a single
    walk over the value. Missing keys give NULL."""
    tree: dict[str, list[str]] = {}
    for path in paths:
        top, _, below = path.partition(".")
        tree.setdefault(top, [])
        if below:
            tree[top].append(below)
    parts = []
    for top, inner in tree.items():
        nested = ",".join(f"{k}:variant" for k in inner)
        parts.append(f"{top}:struct<{nested}>" if inner else f"{top}:variant")
    return F.try_variant_get(value, "$", f"struct<{','.join(parts)}>")


def _is_fractional(kind: Column) -> Column:
    return (kind == "DOUBLE") | kind.startswith("DECIMAL")


def whole_number(kind: Column, value: Column) -> Column:
    """An integer, a whole float, a boolean, or text that spells a whole number."""
    text = F.try_variant_get(value, "$", "string")
    digits = F.regexp_replace(F.trim(text), r"\.0+$", "")
    number = F.try_variant_get(value, "$", "double")
    whole = F.when(number == F.floor(number), number.try_cast("bigint"))
    return (
        F.when(kind == "BIGINT", F.try_variant_get(value, "$", "bigint"))
        .when((kind == "STRING") & text.rlike(_WHOLE_NUMBER_TEXT), digits.try_cast("bigint"))
        .when(_is_fractional(kind), whole)
        .when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean").cast("bigint"))
    )


def number(kind: Column, value: Column) -> Column:
    """Any number, a boolean, or text that spells a number."""
    text = F.try_variant_get(value, "$", "string")
    readable = (kind != "STRING") | text.rlike(_NUMBER_TEXT)
    return F.when(readable, F.try_variant_get(value, "$", "double"))


def plain_text(kind: Column, value: Column) -> Column:
    """JSON text only; a number is not turned into text."""
    return F.when(kind == "STRING", F.try_variant_get(value, "$", "string"))


def as_text(value: Column, path: str) -> Column:
    """Any scalar as text; NULL for JSON null and for a missing key."""
    return F.try_variant_get(value, path, "string")


def instant(kind: Column, value: Column) -> Column:
    """ISO date-time text, or epoch seconds, as TIMESTAMP. Text without a zone is UTC."""
    text = F.try_variant_get(value, "$", "string")
    zoned = F.when(text.rlike(r"([zZ]|[+-][0-9]{2}:?[0-9]{2})$"), text).otherwise(
        F.concat(text, F.lit("Z"))
    )
    micros = F.try_variant_get(value, "$", "double") * 1_000_000
    return F.when(kind == "STRING", zoned.try_cast("timestamp")).when(
        (kind == "BIGINT") | _is_fractional(kind), F.timestamp_micros(micros.try_cast("bigint"))
    )


def object_keys(value: Column) -> Column:
    """Keys of an object; NULL for any other value."""
    return F.map_keys(F.try_variant_get(value, "$", "map<string,variant>"))


def digest_of(value: Column) -> Column:
    """SHA-256 of a VARIANT's JSON text. Object keys print sorted, so equal content gives
    equal digests whatever the key order of the source text."""
    return F.sha2(F.to_json(value), 256)
