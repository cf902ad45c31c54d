"""Gold tables stored in hash buckets of a key, so that a fact meets its dimension without being shuffled again.

A bucketed join runs one task per bucket, and adaptive execution cannot split it, as there is no exchange. So keys that hold a
large share of the fact are spread when the tables are written: their fact rows over ``salts`` buckets, their dimension row
to each of these. Both tables are bucketed and sorted by (key, salt) and joined on both.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notice_lake.schemas import DELIVERY_KEY
from notice_lake.sources.scratch import new_folder

SALT = "_bucket_salt"


@dataclass(frozen=True)
class Pair:
    """Names of a stored fact and dimension, their key, and the keys that were spread."""

    fact: str
    dimension: str
    key: str
    hot: tuple

    def tables(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        return spark.table(self.fact), spark.table(self.dimension)


def hot_keys(fact: DataFrame, key: str, buckets: int) -> list:
    """Keys that hold more than a bucket's even share of the rows; fewer than ``buckets``, whatever the size."""
    counts = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    total = fact.count()
    return sorted(r[0] for r in counts.filter(F.col("_n") * buckets > total).select(key).collect())


def _write(df: DataFrame, name: str, key: str, buckets: int, path: str) -> None:
    dealt = df.repartition(buckets, key, SALT)  # each task writes one bucket, so a bucket is one file
    dealt.write.bucketBy(buckets, key, SALT).sortBy(key, SALT).option("path", path).saveAsTable(name)


def write_pair(
    fact: DataFrame, dimension: DataFrame, key: str, *, buckets: int = 8, salts: int = 8, prefix: str = "gold"
) -> Pair:
    """Store both tables by buckets of ``key`` in the shared folder. ``fact`` is read three times: give a stored one.

    ``buckets`` should keep a bucket's rows within a task's memory: total bytes over some 200 MB. Fact rows without a key go to
    buckets by their delivery and meet nothing. Rows added later are spread by the keys that are hot now: write again if others become hot.
    """
    spark, tag = fact.sparkSession, f"{prefix}_{uuid.uuid4().hex}"
    hot = hot_keys(fact, key, buckets)
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    own = F.pmod(F.xxhash64(*DELIVERY_KEY), F.lit(salts)).cast("int")
    spread = F.when(F.col(key).isNull() | is_hot, own).otherwise(F.lit(0))
    every = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    _write(fact.withColumn(SALT, spread), f"{tag}_fact", key, buckets, new_folder(spark, f"{tag}-fact"))
    _write(
        dimension.withColumn(SALT, F.explode(every)), f"{tag}_dim", key, buckets, new_folder(spark, f"{tag}-dim")
    )
    return Pair(f"{tag}_fact", f"{tag}_dim", key, tuple(hot))


def joined(spark: SparkSession, pair: Pair, how: str = "left") -> DataFrame:
    """Fact rows with the columns of their dimension row, bucket by bucket."""
    fact, dimension = pair.tables(spark)
    return fact.join(dimension, [pair.key, SALT], how).drop(SALT)


def drop_pair(spark: SparkSession, pair: Pair) -> None:
    """Forget both tables; the files go with ``scratch.release``."""
    for name in (pair.fact, pair.dimension):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
