"""Source-to-sink reconciliation of a record flow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.exprs import MICROS, elapsed, micros, percent, ratio, verdict
from eventloom.operators.checks import stacked_scalars
from eventloom.operators.skew import slot_of


def _count() -> Column:
    return F.count(F.lit(1))


def count_match(source: DataFrame, sink: DataFrame) -> DataFrame:
    m = stacked_scalars({"produced": source.agg(_count()), "delivered": sink.agg(_count())})
    return m.select(
        "produced",
        "delivered",
        (F.col("delivered") - F.col("produced")).alias("difference"),
        percent(F.col("delivered"), F.col("produced")).alias("delivery_rate"),
        verdict(F.col("delivered") == F.col("produced")).alias("result"),
    )


def integrity(source: DataFrame, sink: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Keys missing from the sink, unexpected there, or delivered with other content.

    Rows become (key, content hash) with a bit for the side they were seen on. Copies combine
    on the map side, so a key or record that fills a third of a table does not make a large
    task, and no join is needed. A key counts as changed when its sets of contents differ.
    """
    content = F.xxhash64(*[F.col(f) for f in fields])

    def side(df: DataFrame, bit: int) -> DataFrame:
        return df.select(F.col(key).alias("_key"), content.alias("_content"), F.lit(bit).alias("_side"))

    contents = (
        side(source, 1).unionAll(side(sink, 2))
        .groupBy("_key", "_content")
        .agg(F.bit_or("_side").alias("_side"))
    )
    keys = contents.groupBy("_key").agg(
        F.bit_or("_side").alias("_sides"), F.bool_and(F.col("_side") == 3).alias("_same")
    )
    sides = F.col("_sides")
    m = keys.agg(
        F.count_if(sides != 2).alias("source_keys"),
        F.count_if(sides != 1).alias("sink_keys"),
        F.count_if(sides == 1).alias("missing"),
        F.count_if(sides == 2).alias("unexpected"),
        F.count_if((sides == 3) & ~F.col("_same")).alias("changed"),
    )
    clean = (F.col("missing") + F.col("unexpected") + F.col("changed")) == 0
    return m.withColumn("result", verdict(clean))


def ordering(
    df: DataFrame, key: str, sequence: str, arrival: str, slot_seconds: int = 60
) -> DataFrame:
    """Per key: how often the sequence falls from one arrival to the next.

    Arrivals are cut into time slots and compared inside a slot; then the slots of a key, one
    row each, are compared at their seams. A busy key is spread over as many tasks as slots.
    """
    cells = df.where(F.col(arrival).isNotNull() & F.col(sequence).isNotNull()).select(
        key,
        F.col(sequence).alias("_seq"),
        micros(arrival).alias("_at"),
        slot_of(micros(arrival), slot_seconds * MICROS).alias("_slot"),
    )
    inside = Window.partitionBy(key, "_slot").orderBy("_at", "_seq")
    drops = F.when(F.col("_seq") < F.lag("_seq").over(inside), 1).otherwise(0)
    position = F.struct("_at", "_seq")
    slots = (
        cells.withColumn("_drop", drops)
        .groupBy(key, "_slot")
        .agg(
            _count().alias("_rows"),
            F.sum("_drop").alias("_drops"),
            F.min(position).alias("_first"),
            F.max(position).alias("_last"),
        )
    )
    seam = Window.partitionBy(key).orderBy("_slot")
    fell = F.when(F.col("_first._seq") < F.lag("_last._seq").over(seam), 1).otherwise(0)
    return (
        slots.withColumn("_seam", fell)
        .groupBy(key)
        .agg(
            F.sum("_rows").alias("records"),
            F.sum(F.col("_drops") + F.col("_seam")).alias("inversions"),
        )
        .withColumn("result", verdict(F.col("inversions") == 0))
    )


def duplicates(df: DataFrame, key: str, max_rate: float = 0.1) -> DataFrame:
    copies = df.groupBy(key).agg(_count().alias("_copies"))
    m = copies.agg(
        F.sum("_copies").alias("total"),
        (F.sum("_copies") - _count()).alias("duplicates"),
    )
    rate = percent(F.col("duplicates"), F.col("total"))
    return m.withColumn("duplicate_rate", rate).withColumn(
        "result", verdict(F.col("duplicate_rate") <= max_rate)
    )


def drop_duplicates(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key, by ``order``; combines on the map side."""
    first = df.groupBy(*keys).agg(
        F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_row")
    )
    return first.select("_row.*")


def delivery_sla(
    df: DataFrame, produced: str, delivered: str, seconds: int = 30, minimum: float = 99.9
) -> DataFrame:
    late = elapsed("SECOND", produced, delivered)
    m = df.agg(
        _count().alias("delivered"),
        F.count_if(micros(delivered) - micros(produced) <= seconds * MICROS).alias("within_sla"),
        F.max(late).alias("max_delay_seconds"),
        ratio(F.sum(late), F.count(late)).alias("avg_delay_seconds"),
    )
    share = percent(F.col("within_sla"), F.col("delivered"))
    return m.withColumn("sla_rate", share).withColumn("result", verdict(share >= minimum))


def partition_balance(
    df: DataFrame, partition: str, partitions: int, tolerance: float = 10
) -> DataFrame:
    """Rows per partition against an even share, as deviation in percent of that share."""
    counts = df.groupBy(F.col(partition).alias("partition")).agg(_count().alias("records"))
    even = counts.agg(F.sum("records")).scalar().cast("double") / F.lit(float(partitions))
    off = (F.col("records").cast("double") - even) / even * 100
    return counts.withColumn("deviation_pct", off).withColumn(
        "result", verdict(F.abs("deviation_pct") <= tolerance)
    )


def consumer_lag(
    produced: DataFrame, committed: DataFrame, partition: str = "partition", offset: str = "offset"
) -> DataFrame:
    """Newest produced minus newest committed offset for every group and partition; a partition in
    which a group has committed nothing lags fully. Groups are a few configured names, and are
    known by their commits; without any commit every partition lags fully for a null group.
    ``partition`` may be a topic's partition in one column."""
    ends = produced.groupBy(partition).agg(F.max(offset).alias("end_offset"))
    done = committed.groupBy("consumer_group", partition).agg(F.max("committed").alias("committed"))
    groups = done.agg(F.collect_set("consumer_group").alias("groups"))
    wanted = ends.withColumn("consumer_group", F.explode_outer(groups.scalar()))
    return wanted.join(done, ["consumer_group", partition], "left").withColumn(
        "lag", F.col("end_offset") - F.coalesce("committed", F.lit(-1).cast("bigint"))
    )


def late_split(events: DataFrame, delay_seconds: int = 5) -> DataFrame:
    """Adds ``late_by_seconds`` and ``is_late`` (arrived more than the delay after it happened)."""
    late_by = elapsed("SECOND", "event_timestamp", "processing_time")
    over = micros("processing_time") - micros("event_timestamp") > delay_seconds * MICROS
    return events.withColumn("late_by_seconds", late_by).withColumn(
        "is_late", F.coalesce(over, F.lit(False))
    )


def late_share(events: DataFrame, delay_seconds: int = 5, maximum: float = 5) -> DataFrame:
    m = late_split(events, delay_seconds).agg(
        _count().alias("events"), F.count_if("is_late").alias("late_events")
    )
    share = percent(F.col("late_events"), F.col("events"))
    return m.withColumn("late_pct", share).withColumn("result", verdict(share <= maximum))


def retain(df: DataFrame, ts: str, days: int, as_of: Column | None = None) -> DataFrame:
    """Rows at most ``days`` older than ``as_of``, which defaults to the newest row."""
    now = df.agg(F.max(ts)).scalar() if as_of is None else as_of
    return df.where(F.col(ts) >= now - F.make_dt_interval(F.lit(days)))
