"""Positions near each other on the sky, by zones and an exact angle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notice_lake.functions import typed as ty

# Zones are wider than the radius by this, so rounding moves no neighbour out of reach.
_SLACK = 1e-6


def _band(dec: Column, height: float) -> Column:
    return F.floor((dec + 90) / height)


def _cells(band: Column, height: float, reach: float) -> Column:
    """Number of cells of a band: each as wide in right ascension as ``reach`` is anywhere in the band.

    A band that reaches within ``reach`` of a pole is one cell.
    """
    far = F.greatest(F.abs(band * height - 90), F.abs((band + 1) * height - 90))
    width = F.degrees(F.asin(F.sin(F.radians(F.lit(reach))) / F.cos(F.radians(far))))
    return F.when(far + reach >= 90, F.lit(1)).otherwise(F.greatest(F.floor(360 / width), F.lit(1))).cast("long")


def _cell(ra: Column, cells: Column) -> Column:
    return F.least(F.floor(ra * cells / 360), cells - 1)


def near_positions(typed: DataFrame, radius_deg: float) -> DataFrame:
    """Pairs of different positions at most ``radius_deg`` apart, each pair once, with how many notices have each.

    ``typed`` has ``ra_deg``, ``dec_deg`` and ``position_valid``; rows without a valid position are near nothing. Notices that
    share a position are one position here, so a position reported again and again adds no pairs; ``ra_deg`` and ``dec_deg``
    lead back to them.

    The sky is cut into bands as high as the radius and bands into cells as wide. A position lies in one cell and looks
    into the cells around it in its own band and the two next to it, across 0/360 and over the poles: an equi-join, in
    which a pair meets once. Where positions are dense, candidates stay within a constant factor of the pairs.
    """
    if not 0 < radius_deg <= 180:
        raise ValueError("radius must be above 0 and at most 180 degrees")
    reach = height = radius_deg + _SLACK
    positions = typed.filter("position_valid").groupBy("ra_deg", "dec_deg").agg(F.count("*").alias("notices"))
    band = _band(F.col("dec_deg"), height)
    lying = (
        positions.withColumn("_band", band)
        .withColumn("_cell", _cell(F.col("ra_deg"), _cells(F.col("_band"), height, reach)))
        .withColumnsRenamed({"ra_deg": "near_ra_deg", "dec_deg": "near_dec_deg", "notices": "near_notices"})
    )
    looking = (
        positions.withColumn("_band", F.explode(F.array(band - 1, band, band + 1)))
        .withColumn("_cells", _cells(F.col("_band"), height, reach))
        .withColumn("_own", _cell(F.col("ra_deg"), F.col("_cells")))
        .withColumn(
            "_cell", F.explode(F.array_distinct(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.pmod(F.col("_own") + d, F.col("_cells")))))
        )
        .drop("_cells", "_own")
    )
    first = F.struct("ra_deg", "dec_deg") < F.struct(F.col("near_ra_deg").alias("ra_deg"), F.col("near_dec_deg").alias("dec_deg"))
    angle = ty.angular_separation(*(F.col(c) for c in ("ra_deg", "dec_deg", "near_ra_deg", "near_dec_deg")))
    return (
        looking.join(lying, ["_band", "_cell"]).filter(first)
        .withColumn("separation_deg", angle).filter(F.col("separation_deg") <= radius_deg)
        .select("ra_deg", "dec_deg", "notices", "near_ra_deg", "near_dec_deg", "near_notices", "separation_deg")
    )
