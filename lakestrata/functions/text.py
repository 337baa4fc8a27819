"""Text, number and JSON expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def safe_number(col: Column, to: str = "double") -> Column:
    """Parse a number; NULL where the text is none."""
    return col.try_cast(to)


def default_text(col: Column, default: str | Column) -> Column:
    """Trim; blank or missing becomes ``default``."""
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.nullif(F.trim(col), F.lit("")), fallback)


def prefixed_upper(col: Column, prefix: str = "OP_") -> Column:
    return F.concat(F.lit(prefix), F.upper(col))


def message(template: str, *cols: Column) -> Column:
    """printf-style message; NULL arguments print as ``null``."""
    return F.format_string(template, *cols)


def percent(part: Column, total: Column, digits: int = 2) -> Column:
    """``round(100 * part / total, digits)``; 0 where the total is 0."""
    return F.when(total == 0, F.lit(0.0)).otherwise(round_to(part / total * 100, digits))


def round_to(col: Column, digits: int = 2) -> Column:
    return F.round(col, digits)


def as_mb(col: Column) -> Column:
    """Bytes to mebibytes, two decimals."""
    return F.round(col / F.lit(1048576), 2)


def as_json(*cols: Column) -> Column:
    """Columns to one JSON object; non-ASCII text stays readable."""
    return F.to_json(F.struct(*cols))


def parse_json(col: Column, schema: T.DataType | str) -> Column:
    return F.from_json(col, schema)


def first_element(col: Column) -> Column:
    """First array element, NULL for an empty array."""
    return F.get(col, F.lit(0))


def before_first(col: Column, separator: str) -> Column:
    """Text before the first separator, all of it if there is none."""
    return F.substring_index(col, separator, 1)


def b64url(col: Column) -> Column:
    """URL-safe base64 with padding, on one line."""
    return F.translate(F.base64(col), "+/\r\n", "-_")


def unb64url(col: Column) -> Column:
    return F.unbase64(F.translate(col, "-_", "+/"))


def classify(col: Column, cuts: list, labels: list[str], default: str) -> Column:
    """First label whose cut lies strictly below the value, else ``default``.

    ``cuts`` run from high to low and may be numbers or columns.
    """
    if len(cuts) != len(labels):
        raise ValueError("one label per cut is needed")
    case = None
    for cut, label in zip(cuts, labels):
        case = (F.when(col > cut, F.lit(label)) if case is None
                else case.when(col > cut, F.lit(label)))
    return F.lit(default) if case is None else case.otherwise(F.lit(default))
