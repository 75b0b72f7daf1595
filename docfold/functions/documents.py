"""Reading values out of semi-structured documents, and writing rows as documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the digits that end a reference URL.
TRAILING_DIGITS = "[0-9]+$"


def field(doc: Column | str, path: str, type: str = "string", strict: bool = True) -> Column:
    """Typed value at ``path``; absent and JSON null both give NULL.

    ``strict`` raises on a value that does not fit the type, otherwise it becomes NULL.
    """
    get = F.variant_get if strict else F.try_variant_get
    return get(doc, path, type)


def is_present(value: Column | str) -> Column:
    """True for a real value: neither SQL NULL nor a JSON null."""
    value = F.col(value) if isinstance(value, str) else value
    return value.isNotNull() & ~F.is_variant_null(value)


def parse_document(text: Column | str, strict: bool = True) -> Column:
    return F.parse_json(text) if strict else F.try_parse_json(text)


def document_text(*columns: Column | str) -> Column:
    """JSON text of the given columns, NULLs written as JSON nulls."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def trailing_id(text: Column | str, type: str = "bigint", pattern: str = TRAILING_DIGITS, strict: bool = True) -> Column:
    """Number at the end of a URL, NULL where there is none."""
    digits = F.regexp_substr(text, F.lit(pattern))
    return digits.cast(type) if strict else digits.try_cast(type)
