"""Fields of documents that hold values of unlike types.

A document is a VARIANT column. As in document stores, a comparison holds only for values
of the kind it is given: text is never greater than a number, and a field that is null or
not there is greater than nothing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Kinds of values, by the types that Spark names in a variant.
_KINDS = {
    "number": ("BIGINT", "DOUBLE", "FLOAT", "DECIMAL"),
    "text": ("STRING",),
    "boolean": ("BOOLEAN",),
    "null": ("VOID",),
    "array": ("ARRAY",),
    "object": ("OBJECT",),
}


def document(text: Column) -> Column:
    """JSON text as a document; NULL where it is none."""
    return F.try_parse_json(text)


def field(doc: Column, path: str) -> Column:
    """A field as a document of its own; NULL where it is not there."""
    return F.try_variant_get(doc, path, "variant")


def kind(doc: Column, path: str) -> Column:
    """``number``, ``text``, ``boolean``, ``null``, ``array``, ``object``, or ``missing``."""
    name = F.regexp_extract(F.schema_of_variant(field(doc, path)), "^[A-Z]+", 0)
    found = F.lit("missing")
    for label, types in _KINDS.items():
        found = F.when(name.isin(*types), label).otherwise(found)
    return found


def _of_kind(doc: Column, path: str, wanted: str, dtype: str) -> Column:
    return F.when(kind(doc, path) == wanted, F.try_variant_get(doc, path, dtype))


def number(doc: Column, path: str) -> Column:
    """The field where it is a number, else NULL; text that looks like a number is text."""
    return _of_kind(doc, path, "number", "double")


def text(doc: Column, path: str) -> Column:
    """The field where it is text, else NULL."""
    return _of_kind(doc, path, "text", "string")


def exceeds(doc: Column, path: str, bound: float | str) -> Column:
    """Whether the field is greater than ``bound`` and of its kind; never NULL."""
    value = text(doc, path) if isinstance(bound, str) else number(doc, path)
    return F.coalesce(value > F.lit(bound), F.lit(False))


def differs(doc: Column, path: str, value: float | str) -> Column:
    """Whether the field is anything but ``value``: other kinds and missing fields differ."""
    own = text(doc, path) if isinstance(value, str) else number(doc, path)
    return ~own.eqNullSafe(F.lit(value))
