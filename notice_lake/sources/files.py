"""Names in a folder of the file system that Spark uses, for markers and clean-up."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing if there is no such folder."""
    files, place = _place(spark, path)
    if not files.exists(place):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(place))


def mark(spark: SparkSession, path: str) -> None:
    """An empty file."""
    files, place = _place(spark, path)
    files.create(place, True).close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, replaced as a whole: readers see the old one or the new one. Names with a dot first are not read."""
    files, place = _place(spark, path)
    _, hidden = _place(spark, f"{path.rpartition('/')[0]}/.{path.rpartition('/')[2]}")
    out = files.create(hidden, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    files.delete(place, False)
    files.rename(hidden, place)


def remove(spark: SparkSession, path: str) -> None:
    files, place = _place(spark, path)
    files.delete(place, True)
