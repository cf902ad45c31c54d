"""Typed values of the text fields: times, angles, coordinates, illumination.

The text formats accepted here are those of the test notices plus common variants
(``yy/mm/dd`` dates, ``23 Jun 24`` dates, clock times in braces, positions with both
coordinates on one line). Anything else gives NULL. Timestamps are UTC wall-clock values
without zone, so no result depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from notice_lake.functions.numbers import NUMBER, found_number, leading_number

ISO_DATE = r"(\d{4}-\d{2}-\d{2})"
SHORT_DATE = r"(?:^|\D)(\d{2})/(\d{2})/(\d{2})(?:\D|$)"
# Month names of the feed's dates.
MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"
NAMED_DATE = rf"(?:^|\D)(\d{{1,2}}) ({'|'.join(MONTHS[i : i + 3] for i in range(0, 36, 3))}) (\d{{2}})(?:\D|$)"
CLOCK = r"(\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?)"
# An angle may carry its unit: 84.25d; a list its separator: 84.25,
ANGLE_UNIT = "d?,?"
# A number, its sexagesimal form in braces or a comma or space, then the second number.
SECOND_ANGLE = rf"^\s*{NUMBER}d?(?:\s*\{{[^}}]*\}}\s*,?\s*|\s*,\s*|\s+)({NUMBER})d?(?:\s|$)"


def date_text(text: Column) -> Column:
    """ISO date inside ``text``; years of two digits are read as 20yy. Empty when none."""
    short = [F.regexp_extract(text, SHORT_DATE, i) for i in range(4)]
    named = [F.regexp_extract(text, NAMED_DATE, i) for i in range(4)]
    month = ((F.instr(F.lit(MONTHS), named[2]) + 2) / 3).cast("int").cast("string")
    iso = F.regexp_extract(text, ISO_DATE, 1)
    return (
        F.when(iso != "", iso)
        .when(short[0] != "", F.concat(F.lit("20"), F.concat_ws("-", *short[1:])))
        .when(
            named[0] != "",
            F.concat(F.lit("20"), F.concat_ws("-", named[3], F.lpad(month, 2, "0"), F.lpad(named[1], 2, "0"))),
        )
        .otherwise("")
    )


def utc_timestamp(date: Column, clock: Column) -> Column:
    stamp = F.concat(date_text(date), F.lit(" "), F.regexp_extract(clock, CLOCK, 1))
    return stamp.try_cast("timestamp_ntz")


def degrees(text: Column) -> Column:
    """Leading number: an angle, or a percentage."""
    return leading_number(F.replace(text, F.lit(","), F.lit(", ")), ANGLE_UNIT)


def second_degrees(text: Column) -> Column:
    """The second angle of ``lon, lat`` or ``lon {h m s} lat {d m s}``."""
    return found_number(F.regexp_extract(text, SECOND_ANGLE, 1))


def valid_position(ra: Column, dec: Column) -> Column:
    """Range test of equatorial coordinates; NULL coordinates are not valid."""
    return F.coalesce((ra >= 0) & (ra < 360) & (dec >= -90) & (dec <= 90), F.lit(False))


def angular_separation(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Great-circle distance of two sky positions, all in degrees."""
    ra1, dec1, ra2, dec2 = (F.radians(c) for c in (ra1, dec1, ra2, dec2))
    half_dec = F.sin((dec2 - dec1) / 2)
    half_ra = F.sin((ra2 - ra1) / 2)
    chord = half_dec * half_dec + F.cos(dec1) * F.cos(dec2) * half_ra * half_ra
    return F.degrees(2 * F.asin(F.least(F.lit(1.0), F.sqrt(chord))))
