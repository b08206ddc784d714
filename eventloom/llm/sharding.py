"""Sharding by global byte-size prefix sums.

Rows are range-partitioned by (text hash, doc_id), so equal texts lie side by side; each
partition's total gives the next ones their carry, and the running byte position of a row, cut at
equal targets, is its shard. Shards are contiguous in that order and differ by less than the
largest row. A group of equal texts of any size is spread by its ids and takes no single task; it
spans two shards only where a cut falls inside it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventloom.llm.common import content_key, stored, text_or_empty

ROW_BYTES = 16
LAW = "bytes"
RESULT = {"size", "text_crc32", "law", "shard", "slot"}


def assign_shards(docs: DataFrame, shards: int = 40, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with ``size, text_crc32, law, shard, slot`` for every row.

    A null text counts as an empty one. Rows that agree in id and text are interchangeable. An
    empty table gives an empty result, a table of fewer rows than shards leaves shards empty.
    A kept column that has the name of a result column is replaced.
    """
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    text = text_or_empty()
    rows = docs.select(
        *[c for c in keep if c not in RESULT],
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("_loom_text"),
        content_key("doc_id").alias("_loom_id"),
    )
    ordered = ["_loom_text", "_loom_id"]
    # Written once: the bounds are sampled, and totals and rows must see the same cut.
    ranged = stored(
        rows.repartitionByRange(parts, *ordered).withColumn("_loom_part", F.spark_partition_id()),
        "shard-ranges",
    )
    by_part = W.orderBy("_loom_part").rowsBetween(W.unboundedPreceding, -1)
    totals = ranged.groupBy("_loom_part").agg(F.sum("size").alias("_loom_bytes"))
    carries = totals.select(
        "_loom_part",
        F.coalesce(F.sum("_loom_bytes").over(by_part), F.lit(0)).alias("_loom_carry"),
        F.sum("_loom_bytes").over(W.partitionBy()).alias("_loom_total"),
    )
    within = W.partitionBy("_loom_part").orderBy(*ordered)
    start = F.col("_loom_carry") + F.sum("size").over(within.rowsBetween(W.unboundedPreceding, 0)) - F.col("size")
    placed = (
        ranged.join(F.broadcast(carries), "_loom_part")  # one row per partition
        .withColumn("_loom_start", start)
        .withColumn("shard", F.expr(f"int((_loom_start * {shards}) div _loom_total)"))
        .withColumn("_loom_row", F.row_number().over(W.partitionBy("_loom_part", "shard").orderBy(*ordered)))
    )
    # A partition meets few shards: its rows per shard give the slot carries.
    counts = placed.groupBy("_loom_part", "shard").agg(F.count(F.lit(1)).alias("_loom_n"))
    earlier = W.partitionBy("shard").orderBy("_loom_part").rowsBetween(W.unboundedPreceding, -1)
    slots = counts.select(
        "_loom_part", "shard", F.coalesce(F.sum("_loom_n").over(earlier), F.lit(0)).alias("_loom_before")
    )
    # At most partitions + shards rows.
    return placed.join(F.broadcast(slots), ["_loom_part", "shard"]).select(
        *[c for c in keep if c not in RESULT], "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        (F.col("_loom_before") + F.col("_loom_row") - 1).cast("long").alias("slot"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 40, rows_per_file: int = 100_000) -> None:
    """Writes the documents into one folder per shard, each file a run of slots in order."""
    placed = assign_shards(docs, shards, tuple(docs.columns))
    run = F.expr(f"slot div {rows_per_file}")
    placed.repartition("shard", run).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
