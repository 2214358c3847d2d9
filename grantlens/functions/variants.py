"""Null-safe access to fields of a VARIANT column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse(c: Column) -> Column:
    """JSON text as VARIANT, NULL where it does not parse."""
    return F.try_parse_json(c)


def text(v: Column, path: str) -> Column:
    """The value at ``path`` as text, NULL where it is absent or null."""
    return F.try_variant_get(v, path, "string")


def number(v: Column, path: str, kind: str = "double") -> Column:
    """The value at ``path`` as a number, NULL where it is absent or no number."""
    return F.try_variant_get(v, path, kind)


def elements(v: Column, path: str) -> Column:
    """The list at ``path`` as an array of VARIANT, NULL where it is no list."""
    return F.try_variant_get(v, path, "array<variant>")


def entries(v: Column, path: str) -> Column:
    """The object at ``path`` as a map of VARIANT, NULL where it is no object."""
    return F.try_variant_get(v, path, "map<string,variant>")


def is_object(v: Column) -> Column:
    """Whether a value is an object; casting to no fields copies nothing."""
    return F.try_variant_get(v, "$", "struct<>").isNotNull()


def typed(v: Column, kind: str) -> Column:
    """All named fields of an object in one walk over it; a field of a wrong kind is NULL.

    In a list of objects an element that is none becomes NULL, the others stay.
    """
    return F.try_variant_get(v, "$", kind)


def is_falsy(v: Column) -> Column:
    """Absent, null, '', 0, false, or an empty list or object."""
    value = text(v, "$")
    return value.isNull() | value.isin("", "0", "0.0", "false", "[]", "{}")


def text_or_absent(v: Column) -> Column:
    """A field's text, with an absent field read as '' while an explicit null stays NULL."""
    return F.when(v.isNull(), F.lit("")).otherwise(text(v, "$"))


def named_text(v: Column, field: str = "abbreviation") -> Column:
    """A field that is an object or plain text: its ``field``, the text itself, or ''."""
    inner = F.when(F.schema_of_variant(v) == "STRING", text(v, "$")).otherwise(text(v, f"$.{field}"))
    return F.coalesce(inner, F.lit(""))


def joined_names(items: Column, field: str, separator: str = ", ") -> Column:
    """The non-empty values of ``field`` over an array of structs, joined in order."""
    names = F.filter(F.transform(items, lambda item: item[field]), lambda name: name != "")
    return F.coalesce(F.array_join(names, separator), F.lit(""))
