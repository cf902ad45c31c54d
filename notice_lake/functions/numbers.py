"""Numbers at the start of ``value unit`` texts. Unparseable text gives NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"[+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?"


def leading_number(text: Column, unit: str = "") -> Column:
    """The first token as double, if it is a number and nothing else.

    ``unit`` is a pattern that may follow the number without a space. Words that a
    cast takes for numbers (``NaN``, ``Infinity``, ``1.5f``) give NULL.
    """
    return found_number(F.regexp_extract(text, rf"^\s*({NUMBER})(?:{unit})(?:\s|$)", 1))


def found_number(match: Column) -> Column:
    """A matched number as double; NULL for an empty match, whose cast would cost a caught exception per row."""
    return F.nullif(match, F.lit("")).try_cast("double")


def whole_number(text: Column, dtype: str = "bigint") -> Column:
    return text.try_cast(dtype)
