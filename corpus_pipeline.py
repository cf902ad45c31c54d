"""From raw documents to training batches, each stage one operator of ``notice_lake.llm``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notice_lake.llm.common import stored
from notice_lake.llm.mixing import mix_sources
from notice_lake.llm.ngram_join import near_duplicates
from notice_lake.llm.packing import pack
from notice_lake.llm.suffix_dedup import SuffixDedup, remove_repeats
from notice_lake.llm.toxicity import score_toxicity

#: Columns that all stages but the last take and return; others are dropped by the first.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score_toxicity(docs, labels, keep=COLUMNS[1:])
    return scored.where("predicted = 0").select(*COLUMNS)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id.

    A document is an id and a text: unlike texts under one id are documents of their own, as are those without an id, which
    come after all ids. Of rows equal in id and text one stays.
    """
    rows = docs.withColumn("_row", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    groups = near_duplicates(rows, doc_id="_row").withColumnRenamed("doc_id", "_row")
    ids = stored(rows.select("_row", "doc_id").distinct(), "rows-of-groups")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row"))
    leads = stored(ids.join(groups.distinct(), "_row").groupBy("component_id").agg(first.alias("lead")).select("lead._row"), "first-of-group")
    kept = rows.join(leads, "_row", "left_semi").groupBy("_row").agg(F.min(F.struct(*COLUMNS)).alias("d"))
    return kept.select("d.*")


#: What the pipeline removes: passages of over fifty words that occur again, found by their bytes.
PASSAGES = SuffixDedup(length=150, words=51)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of over fifty words that occur again in the corpus."""
    rows = docs.withColumn("_null", F.col("text").isNull())
    cut = remove_repeats(rows, PASSAGES, keep=("lang", "source", "n_chars", "_null"), kept_text=True)
    return cut.select(
        "doc_id",
        F.when(~F.col("_null"), F.col("kept_text")).alias("text"),
        "lang",
        "source",
        F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long"))
        .otherwise(F.col("n_chars")).alias("n_chars"),
    )


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the one at the cut of a source stays whole.

    Documents without words are kept once: they cost nothing. Rows equal in id and text are taken
    equally often. Texts are not carried through the queue: they are joined to the counts.
    """
    rows = docs.withColumn("_row", F.xxhash64("doc_id", "text"))
    mixed = mix_sources(rows, keep=("_row",))
    times = sum((F.col(f"taken_{k}") > 0).cast("int") for k in (0, 1))
    times = F.when(F.col("size") == 0, 1).otherwise(times)
    taken = mixed.groupBy("_row").agg(F.ceil(F.avg(times)).cast("int").alias("_times"))
    taken = stored(taken.where("_times > 0"), "mix-times")
    each = F.explode(F.array_repeat(F.lit(0), F.col("_times")))
    return rows.join(taken, "_row").withColumn("_time", each).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The batch and slot of each document."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("ngram_join", ngram_join),
    ("suffix_dedup", suffix_dedup),
    ("source_mix", source_mix),
    ("packing", packing),
]

#: The first stages are a trained model and a search over byte strings, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
