"""Helpers shared by the operators: stored intermediate tables, words, connected components."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notice_lake.sources import scratch
from notice_lake.sources.scratch import new_folder

#: White space of all operators, as the inside of a character class.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts lineage on files that outlive any executor. What comes back has no
    partitioning, so a join on it gets exchanges of its own, which adaptive
    execution can split where a key is hot. The shuffle files of the write are
    deleted with its end, not when the driver happens to collect garbage.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    with scratch.shuffles_deleted(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_alone(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``make`` returns, stored; the tables that it stored on the way are deleted then."""
    with scratch.made_inside() as folders:
        table = stored(make(), name)
    scratch.remove(table.sparkSession, folders[:-1])
    return table


def ascii_lower(column: Column) -> Column:
    return F.translate(column, _UPPER, _UPPER.lower())


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed once per row, however often later steps use them.

    The one-element ``explode`` keeps the optimizer from writing the expression
    into each place that uses it, such as the body of a lambda.
    """
    values = F.struct(*[value.alias(name) for name, value in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    rows = df.select("*", F.explode(F.array(values)).alias("_once"))
    return rows.select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"_once.{c}") for c in columns])


def components(edges: DataFrame, jumps: int = 2) -> DataFrame:
    """Connected components of the links ``a``, ``b`` (long): ``node``, ``component``.

    ``component`` is the smallest node of the component. Rounds of contraction:
    each node moves to its smallest neighbour, pointers are shortened, and links
    inside a merged node go. At least half of the nodes that have links go in each
    round. Links may be given twice; the first round names every node. All joins are
    between stored tables, so a node with very many links is
    split by adaptive execution.
    """
    links = stored(edges.select("a", "b").where("a <> b"), "links")
    labels = None
    while not links.isEmpty():
        ends = links.union(links.select("b", "a"))
        moves = stored(
            ends.groupBy("a").agg(F.min("b").alias("b"))
            .select(F.col("a").alias("old"), F.least("a", "b").alias("new")),
            "moves",
        )
        for _ in range(jumps):
            further = moves.select(F.col("old").alias("new"), F.col("new").alias("far"))
            moves = stored(
                moves.join(further, "new", "left").select(
                    "old", F.coalesce("far", "new").alias("new")
                ),
                "moves",
            )
        if labels is None:
            labels = moves.select(F.col("old").alias("node"), F.col("new").alias("component"))
        else:
            labels = stored(
                labels.join(moves, labels.component == moves.old, "left").select(
                    "node", F.coalesce("new", "component").alias("component")
                ),
                "labels",
            )
        from_a = moves.select(F.col("old").alias("a"), F.col("new").alias("new_a"))
        from_b = moves.select(F.col("old").alias("b"), F.col("new").alias("new_b"))
        links = stored(
            links.join(from_a, "a").join(from_b, "b")
            .select(F.col("new_a").alias("a"), F.col("new_b").alias("b"))
            .where("a <> b").distinct(),
            "links",
        )
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")) if labels is None else labels
