"""Layer tables: names, comments, contract check, batch and streaming reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Layer -> what its schema (namespace) holds.
LAYERS = {
    "bronze": "Raw messages with their delivery columns",
    "silver": "Notices parsed into named text columns",
    "gold": "Notice fact and its dimensions",
}

# Table -> comment, keyed by <layer>.<table>.
TABLES = {
    "bronze.notices_raw": "Messages as delivered, key and value as text",
    "silver.notices": "One row per message: delivery columns and the notice fields as text",
    "gold.dim_event_timing": "Burst and notice times as given, one row per burst date and time",
    "gold.dim_spatial_coords": "Sky position, one row per position, with its Sun/Moon key",
    "gold.dim_sun_moon_coords": "Sun and Moon positions and Moon illumination",
    "gold.fact_notices": "One row per delivered notice: measurements and dimension keys",
}


def quoted(identifier: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in identifier.split("."))


def create_layers(spark: SparkSession, catalog: str | None = None) -> None:
    """Create the layer schemas, in ``catalog`` if given (it must exist)."""
    for layer, comment in LAYERS.items():
        name = f"{catalog}.{layer}" if catalog else layer
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(name)} COMMENT {_literal(comment)}")


def comment_on(spark: SparkSession, table: str, comment: str) -> None:
    spark.sql(f"COMMENT ON TABLE {quoted(table)} IS {_literal(comment)}")


def create_table(
    spark: SparkSession, table: str, schema: T.StructType, *, comment: str = "", provider: str = "parquet"
) -> None:
    """Create an empty table with a fixed schema, for a stream to append to.

    File tables of Spark accept NOT NULL but no key clauses; keys are checks.
    """
    columns = ", ".join(
        f"{quoted(f.name)} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
        for f in schema
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted(table)} ({columns}) USING {provider}"
        f" COMMENT {_literal(comment)}"
    )


def conform(df: DataFrame, schema: T.StructType, *, enforce_not_null: bool = True) -> DataFrame:
    """Columns of ``df`` in contract order; a missing column or other type is an error.

    A NULL in a required column fails the query that meets it.
    """
    actual = {f.name: f.dataType for f in df.schema}
    problems = [
        f"{f.name}: expected {f.dataType.simpleString()}, found "
        + (actual[f.name].simpleString() if f.name in actual else "no such column")
        for f in schema
        if actual.get(f.name) != f.dataType
    ]
    if problems:
        raise TypeError("table contract not met: " + "; ".join(problems))
    columns = []
    for f in schema:
        column = F.col(f.name)
        if enforce_not_null and not f.nullable:
            stop = F.raise_error(F.lit(f"NULL in required column {f.name}"))
            column = F.coalesce(column, stop.cast(f.dataType)).alias(f.name)
        columns.append(column)
    return df.select(*columns)


def read_table(spark: SparkSession, table: str, *, streaming: bool = False) -> DataFrame:
    return spark.readStream.table(table) if streaming else spark.read.table(table)


def read_files(
    spark: SparkSession,
    path: str,
    *,
    schema: T.StructType | None = None,
    streaming: bool = False,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A layer stored as files. A stream needs ``schema``; a batch read may infer it."""
    reader = (spark.readStream if streaming else spark.read).format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if streaming and max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
