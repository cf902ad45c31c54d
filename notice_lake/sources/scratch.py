"""Folder for checkpoints and intermediate tables, shared by all executors."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from notice_lake.sources import files

_made: list[str] = []
_noted: ContextVar[tuple[list[str], ...]] = ContextVar("noted", default=())


def _configured(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None)


@cache
def _local_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="notice-lake-")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a session in one process (``local``, ``local[n]``) may go without: there a
    temporary folder, one per application, serves as well. Separate executors on
    one machine do not count as local.
    """
    folder = _configured(spark)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder(spark.sparkContext.applicationId)


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder name under the shared folder that was never used before."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    for folders in _noted.get():
        folders.append(path)
    return path


@contextlib.contextmanager
def made_inside() -> Iterator[list[str]]:
    """The folders made inside, by this thread only."""
    folders: list[str] = []
    token = _noted.set((*_noted.get(), folders))
    try:
        yield folders
    finally:
        _noted.reset(token)


def remove(spark: SparkSession, folders: list[str]) -> None:
    """Delete folders that no result reads any more."""
    for path in folders:
        if path in _made:
            files.remove(spark, path)
            _made.remove(path)


@contextlib.contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Each query that ends inside deletes its shuffle files."""
    option = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(option, None)
    spark.conf.set(option, "true")
    try:
        yield
    finally:
        spark.conf.unset(option) if before is None else spark.conf.set(option, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new folder and read back.

    A lost executor re-reads files. What comes back has no partitioning, so a join on
    it gets exchanges of its own, which adaptive execution can split where a key is hot.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete all folders made so far. Results that read them must have been used."""
    while _made:
        files.remove(spark, _made.pop())


@atexit.register
def _release_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None:
        with contextlib.suppress(Exception):  # the session may be gone already
            release(spark)
