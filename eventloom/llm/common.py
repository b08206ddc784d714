"""Helpers shared by the training-data operators.

Columns the operators add for themselves start with ``_loom_``; that prefix is reserved. Where an
operator adds a result column whose name the input already has, the result replaces it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.session import checkpoint_root

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_FOLDER: ContextVar[str] = ContextVar("folder", default="llm")


def remove(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def working_folder(spark: SparkSession, name: str) -> Iterator[None]:
    """What operators store inside the block goes into a folder of its own, which is removed at its end:
    their results must have been written elsewhere by then."""
    folder = f"llm/{name}-{uuid.uuid4().hex}"
    token = _FOLDER.set(folder)
    try:
        yield
    finally:
        _FOLDER.reset(token)
        remove(spark, f"{checkpoint_root(spark)}/{folder}")


def stored(df: DataFrame, name: str, partition_by: tuple[str, ...] = (), folder: str | None = None) -> DataFrame:
    """Writes a table into the shared folder and reads it back, so that later steps neither
    recompute it nor depend on the executors that made it."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/{folder or _FOLDER.get()}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path) if partition_by else df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also inside nested lambdas."""
    return F.transform(F.array(value), body)[0]


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def word_count(column: str = "text") -> Column:
    """Words of a text; null counts as empty."""
    return F.regexp_count(text_or_empty(column), F.lit(WORD)).cast("long")


def content_key(*columns: str) -> Column:
    """A hash that spreads rows evenly and orders them alike in every run and engine."""
    return F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in columns]))
