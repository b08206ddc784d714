"""An upsert table that is read without a merge: copy on write by key bucket.

A key's hash names its bucket. A batch of changes rewrites only the buckets it touches, into a
folder of its own version, and then publishes a manifest that says for every bucket which version
holds it. Spark writes the manifest's ``_SUCCESS`` file last, so a version is either published or
not there: readers that began before keep reading the files of the manifest they opened, and a write that
fails half way leaves nothing that a reader sees. Versions are the batch numbers of one writer; a batch
that is published already changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.operators.asof import latest_per_key

BUCKETS = 64
_MANIFEST = "bucket int, version long, columns string"


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    return hadoop, hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def _folders(spark: SparkSession, path: str, prefix: str) -> list[int]:
    hadoop, fs = _file_system(spark, path)
    if not fs.exists(hadoop.Path(path)):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(hadoop.Path(path))]
    return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))


def versions(spark: SparkSession, path: str) -> list[int]:
    """Published versions, oldest first."""
    hadoop, fs = _file_system(spark, path)
    found = _folders(spark, f"{path}/_manifest", "version=")
    return [v for v in found if fs.exists(hadoop.Path(f"{path}/_manifest/version={v}/_SUCCESS"))]


def _manifest(spark: SparkSession, path: str, version: int) -> tuple[dict[int, int], T.StructType]:
    """The version that holds each bucket (at most one row per bucket), and the table's columns."""
    rows = spark.read.schema(_MANIFEST).parquet(f"{path}/_manifest/version={version}").collect()
    return {r["bucket"]: r["version"] for r in rows if r["bucket"] >= 0}, T._parse_datatype_json_string(rows[0]["columns"])


def _read(spark: SparkSession, path: str, held: dict[int, int], columns: T.StructType) -> DataFrame:
    folders = [f"{path}/data-{v}/_bucket={b}" for b, v in sorted(held.items())]
    if not folders:
        return spark.createDataFrame([], columns)
    return spark.read.schema(columns).parquet(*folders)


def read_buckets(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as of its newest version, or of a given one that is still kept: the rows as they are
    stored, one per key. Columns that a later batch brought are NULL in older files."""
    known = versions(spark, path)
    if not known:
        raise FileNotFoundError(f"no published version under {path}")
    held, columns = _manifest(spark, path, known[-1] if version is None else version)
    return _read(spark, path, held, columns)


def upsert_batch(
    changes: DataFrame,
    version: int,
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    deleted: str | None = None,
    buckets: int = BUCKETS,
) -> bool:
    """Publishes the table with ``changes`` applied as ``version``; False if it was there already.

    Of several changes of a key the newest by ``order`` counts, and it replaces the stored row if it is
    not older. Where the boolean column ``deleted`` holds the row goes. Changes without a full key are
    refused. New columns may come with any batch; the number of buckets must stay.
    """
    spark = changes.sparkSession
    known = versions(spark, path)
    if known and version <= known[-1]:
        return False
    held, columns = _manifest(spark, path, known[-1]) if known else ({}, T.StructType([]))
    fresh = changes.drop(*([deleted] if deleted else [])).schema
    columns = T.StructType([*columns.fields, *[T.StructField(f.name, f.dataType) for f in fresh if f.name not in columns.names]])
    gone = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)
    keyless = F.lit(False)
    for key in keys:
        keyless = keyless | F.col(key).isNull()
    checked = changes.withColumn("_gone", F.when(keyless, F.raise_error(F.lit("a change has no key"))).otherwise(gone))
    newest = latest_per_key(checked, keys, list(order)).withColumn("_bucket", _bucket(keys, buckets)).persist()
    try:
        # At most one row per bucket.
        touched = sorted(r[0] for r in newest.select("_bucket").distinct().collect())
        old = {b: held[b] for b in touched if b in held}
        # The stored row and the change of a key meet in one aggregate; a stored row loses a tie.
        stored = _read(spark, path, old, columns).withColumns({"_gone": F.lit(False), "_new": F.lit(0), "_bucket": _bucket(keys, buckets)})
        both = stored.unionByName(newest.withColumn("_new", F.lit(1)).drop(*([deleted] if deleted else [])), allowMissingColumns=True)
        merged = latest_per_key(both, keys, [*order, "_new"], F.col("_gone")).drop("_gone", "_new")
        # Buckets are hashes of the keys; a bucket's rows stay together and large ones are split.
        merged.hint("rebalance", "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/data-{version}")
    finally:
        newest.unpersist()
    full = set(_folders(spark, f"{path}/data-{version}", "_bucket="))
    held = {b: v for b, v in held.items() if b not in touched} | {b: version for b in touched if b in full}
    rows = [(b, v, columns.json()) for b, v in sorted(held.items())] or [(-1, version, columns.json())]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{path}/_manifest/version={version}")
    return True


def bucket_writer(path: str, keys: Sequence[str], order: Sequence[str], **options) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer: the table's versions are the batches that changed it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(batch, batch_id, path, keys, order, **options)

    return write


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Forgets all published versions but the newest ``keep`` and the data that only they need;
    returns the versions whose data went. A reader of one of the kept versions is not disturbed."""
    hadoop, fs = _file_system(spark, path)
    known = versions(spark, path)
    needed: set[int] = set()
    for version in known[-keep:]:
        needed |= set(_manifest(spark, path, version)[0].values())
    for version in known[:-keep]:
        fs.delete(hadoop.Path(f"{path}/_manifest/version={version}"), True)
    # Data of a version that is not published yet belongs to a write that is under way.
    old = [v for v in _folders(spark, path, "data-") if v not in needed and known and v <= known[-1]]
    for version in old:
        fs.delete(hadoop.Path(f"{path}/data-{version}"), True)
    return old
