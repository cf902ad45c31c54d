"""Turn one notice text into labelled segments.

A segment is a label line together with the lines wrapped under it. One split at
"newline followed by a label" yields the segments, so wrapped lines need no merge
pass and a repeated label never meets Spark's duplicate-map-key error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the text format: label pattern, repeatable label, no-break space.
LABEL = "[A-Z_]+"
REPEATABLE = "COMMENTS"
NBSP = "\u00a0"

_TO_END = 2**31 - 1


def normalise_spaces(text: Column) -> Column:
    """No-break spaces become spaces. A literal replace: ``translate`` costs 3x more."""
    return F.replace(text, F.lit(NBSP), F.lit(" "))


def unix_newlines(text: Column) -> Column:
    """CRLF line ends become LF; a carriage return inside a line stays.

    ``rtrim`` of a given character visits every character of a text, ``contains`` only compares bytes.
    """
    unix = F.rtrim(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"))
    return F.when(F.contains(text, F.lit("\r")), unix).otherwise(text)


def merge_wrapped(text: Column, label: str = LABEL) -> Column:
    """Join continuation lines (no label at line start) to the line above."""
    return F.regexp_replace(text, rf"\n(?!{label}:)", " ")


def strip_repeated_label(text: Column, key: str = REPEATABLE) -> Column:
    """Drop the label of every ``key`` line, so its text joins the field above."""
    return F.regexp_replace(text, rf"\n{key}:\s*", " ")


def segments(text: Column, label: str = LABEL) -> Column:
    """Array of segments; element 0 is whatever precedes the second label line."""
    return F.split(text, rf"\n(?={label}:)")


def single_line(segment: Column) -> Column:
    """Few segments are wrapped; looking for a line end first is cheaper than a replace that finds none."""
    wrapped = F.contains(segment, F.lit("\n"))
    return F.when(wrapped, F.replace(segment, F.lit("\n"), F.lit(" "))).otherwise(segment)


def segment_label(segment: Column) -> Column:
    """Text before the first colon; NULL when there is none."""
    return F.when(F.contains(segment, F.lit(":")), F.substring_index(segment, ":", 1))


def segment_value(segment: Column, label_length: int | Column) -> Column:
    """Text after the label, on one line, without surrounding spaces."""
    start = F.lit(label_length) if isinstance(label_length, int) else label_length
    return F.trim(single_line(F.substring(segment, start + F.lit(2), F.lit(_TO_END))))


def run_start(labels: Column, key: str = REPEATABLE) -> Column:
    """1-based index of the first ``key`` segment, 0 when absent."""
    return F.array_position(labels, F.lit(key)).cast("int")


def run_flags(labels: Column, start: Column, key: str = REPEATABLE) -> Column:
    """From ``start`` on, whether each segment is a ``key`` segment."""
    # eqNullSafe: an unlabelled segment ends the run as well.
    return F.transform(
        F.slice(labels, F.greatest(start, F.lit(1)), F.size(labels)),
        lambda x: x.eqNullSafe(F.lit(key)),
    )


def run_length(flags: Column, start: Column) -> Column:
    """Number of consecutive ``key`` segments from ``start`` on."""
    end = F.array_position(flags, F.lit(False)).cast("int")
    return F.when(start == 0, 0).when(end == 0, F.size(flags)).otherwise(end - 1)


def merge_run(run: Column, key: str = REPEATABLE) -> Column:
    """Text of consecutive ``key`` segments, joined by one space, blanks skipped.

    Higher-order functions on purpose: they keep a projection of all fields out of
    one whole-stage method, which at this width the JVM would refuse to compile
    (measured: 2.5 times slower).
    """
    texts = F.transform(
        run,
        lambda s, i: F.when(
            i == 0, single_line(F.substring(s, len(key) + 2, _TO_END))
        ).otherwise(
            F.ltrim(single_line(F.substring(s, len(key) + 2, _TO_END)), F.lit(" \t"))
        ),
    )
    return F.trim(F.array_join(F.filter(texts, lambda t: F.trim(t) != ""), " "))
