"""Mixing sources to target weights by weighted fair queueing, in DataFrame expressions only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notice_lake.llm.common import stored, word_count


@dataclass(frozen=True)
class Mix:
    """``weights`` go round over the sources in code point order, null last."""

    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.5
    most: float = 2.0
    seed: str = "mix"
    rows_per_bucket: int = 10_000


def targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """Words to take of each source: ``source``, ``source_size``, ``rank``, ``target``.

    Targets share ``share`` of all words by weight; none is above ``most`` times its
    source's size, and what is cut goes to the others by weight. In order of
    size by weight the sources that are cut come first, so running sums find them.
    One row per source.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in mix.weights]),
        (F.pmod("rank", F.lit(len(mix.weights))) + 1).cast("int"),
    )
    rows = (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("rank", (F.row_number().over(in_order) - 1).cast("long"))
        .withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * F.lit(mix.most))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(mix.share))
        .withColumn("all_weight", F.sum("weight").over(everything))
    )
    by_need = Window.orderBy(F.col("most") / F.col("weight"), "rank")
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("budget") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / (
        F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    rows = rows.withColumn("level", level)
    cut = F.col("most") / F.col("weight") <= F.col("level")
    rows = rows.withColumn("cut", cut).withColumn(
        "level", F.max(F.when(~F.col("cut"), F.col("level"))).over(everything)
    )
    return rows.select(
        "source", "source_size", "rank",
        F.when(F.col("cut"), F.col("most")).otherwise(F.col("level") * F.col("weight"))
        .alias("target"),
    )


def _pass(number: int) -> tuple[Column, Column]:
    """Virtual finish time of a document in one pass over its source, and the words it gives.

    The finish time is the number of words of the source up to the document's end, over
    the source's target. All sources together reach the budget at time 1. A document
    served by then is taken whole; of the one in service the words served so far.
    """
    ahead = number * F.col("source_size") + F.col("before")
    finish = (ahead + F.col("size")) / F.nullif(F.col("target"), F.lit(0.0))
    left = F.floor(F.col("target") - ahead)
    return finish, F.when(finish <= 1, F.col("size")).otherwise(F.greatest(left, F.lit(0)))


def mix_sources(
    docs: DataFrame,
    mix: Mix = Mix(),
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """How many words of each document the mix takes, repeats counted.

    Each source is shuffled by a hash of the document id. A document's virtual finish
    time is the number of words of its source up to its end, over the source's target; a
    source comes round again until ``most`` times its size is offered. The result is sorted by
    ``finish``, over all sources, which is the order of the mix, and cut where the budget
    of ``share`` of all words is reached: at virtual time 1, as the targets add up to it. Each
    source gives its target then, rounded down. Reruns give the same rows.

    Running sums go by (source, range of the hash) and then over the ranges, so that a
    source with a third of all rows is spread over tasks.

    ``taken_k`` is the part of pass ``k``, ``taken`` their sum. Null and empty texts have size 0
    and give 0. A null source is a source. Equal rows are documents of their own. An empty
    table gives an empty result. ``keep`` names further input columns to return; they must
    not have the names of the result's own.
    """
    key = F.md5(F.concat_ws(" ", F.lit(mix.seed), F.col(f"`{doc_id}`").cast("string")))
    rows = stored(
        docs.select(
            F.col(f"`{doc_id}`").alias("doc_id"),
            F.col(f"`{source}`").alias("source"),
            word_count(F.col(f"`{text}`")).alias("size"),
            key.alias("key"),
            *[F.col(f"`{c}`") for c in keep],
        ),
        "mix-sizes",
    )
    n = max(1, math.ceil(rows.count() / mix.rows_per_bucket))
    bucket = F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * n / F.lit(1 << 32))
    of_source = stored(targets(rows, mix), "mix-targets")
    named = of_source.withColumnRenamed("source", "_source")
    rows = (
        rows.join(named, rows.source.eqNullSafe(named._source)).drop("_source")
        .withColumn("bucket", bucket)
    )
    ahead = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("rank", "bucket").agg(F.sum("size").alias("words"))
    starts = stored(
        sums.select("rank", "bucket", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("start")),
        "mix-starts",
    )
    inside = (
        Window.partitionBy("rank", "bucket").orderBy("key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = rows.join(starts, ["rank", "bucket"]).withColumn(
        "before", F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    )
    passes = [_pass(k) for k in range(math.ceil(mix.most))]
    rows = rows.withColumns(
        {"finish": passes[0][0]} | {f"taken_{k}": t.cast("long") for k, (_, t) in enumerate(passes)}
    )
    parts = [f"taken_{k}" for k in range(len(passes))]
    taken = sum((F.col(c) for c in parts[1:]), F.col(parts[0]))
    return rows.select(
        "doc_id", "size", "source_size", "target", taken.alias("taken"), "source", "finish", *parts, *keep
    ).orderBy("finish", "source", "doc_id")
