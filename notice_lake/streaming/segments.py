"""Dimension rows written by many batches, kept in few folders.

Batch N writes its new rows as one segment of level 0. After every ``WIDTH`` segments of a
level a segment of the next level holds the rows of all of them. So which
segments cover the first n batches follows from the digits of n to that base: at most
``WIDTH - 1`` of each level, and a row is rewritten once per level. Nothing is listed.

Segments of level 1 and above are split into hash buckets of the key, twice as many at each further level, as
segments grow with it: so a merge runs in more tasks the more it has to merge. A look-up opens the buckets that its
keys fall into and no others. The numbers of buckets divide one another, so a key's bucket at one level gives those at lower levels.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WIDTH = 8
BUCKETS = 32
GROWTH = 2
BUCKET = "_bucket"


def buckets_of(level: int) -> int:
    """Buckets of a segment. Level 0 has none; its rows are told apart as finely as at level 1."""
    return BUCKETS * GROWTH ** max(level - 1, 0)


def top_level(batches: int, width: int = WIDTH) -> int:
    """The highest level among the segments that hold the first ``batches`` batches."""
    level = 0
    while width ** (level + 1) <= batches:
        level += 1
    return level


def covering(batches: int, width: int = WIDTH) -> list[tuple[int, int]]:
    """The segments (level, first batch) that hold the first ``batches`` batches."""
    found, first = [], 0
    for k in range(top_level(batches, width), -1, -1):
        while first + width**k <= batches:
            found.append((k, first))
            first += width**k
    return found


def completed(batch: int, width: int = WIDTH) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """The segments that are complete after batch ``batch``, lowest level first, each with the segments it is made of."""
    found, level = [], 1
    while (batch + 1) % width**level == 0:
        first = batch + 1 - width**level
        found.append((level, first, [(level - 1, first + k * width ** (level - 1)) for k in range(width)]))
        level += 1
    return found


def place(folder: str, level: int, first: int) -> str:
    return f"{folder}/level={level}/first={first}"


def with_bucket(rows: DataFrame, key: str, level: int) -> DataFrame:
    return rows.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets_of(level))).cast("int"))


def read(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    key: str,
    batches: int,
    buckets: list[int] | None = None,
) -> DataFrame:
    """Columns of ``schema`` from the first ``batches`` batches; of some buckets of the top level if given."""
    stored = T.StructType([*schema, T.StructField(BUCKET, T.IntegerType())])
    top = top_level(batches)
    parts = []
    for level, first in covering(batches):
        rows = spark.read.schema(stored if level else schema).parquet(place(folder, level, first))
        if buckets is not None:
            rows = rows if level else with_bucket(rows, key, top)
            rows = rows.filter(F.col(BUCKET).isin(sorted({b % buckets_of(level or top) for b in buckets})))
        parts.append(rows.select(*schema.names))
    if not parts:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)


def write(rows: DataFrame, folder: str, batch: int) -> None:
    """The new rows of a batch. Repeating a batch replaces them."""
    rows.write.mode("overwrite").parquet(place(folder, 0, batch))


def merge(spark: SparkSession, folder: str, schema: T.StructType, key: str, batch: int, width: int = WIDTH) -> None:
    """After batch ``batch``: the segments that are complete now."""
    for level, first, parts in completed(batch, width):
        rows = [spark.read.schema(schema).parquet(place(folder, *part)) for part in parts]
        rows = with_bucket(reduce(DataFrame.unionByName, rows), key, level)
        (
            rows.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET)
            .parquet(place(folder, level, first))
        )
