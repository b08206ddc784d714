"""Event-time as-of join: the newest right row per key that is not after the left row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.exprs import MICROS, micros
from eventloom.operators.skew import SLOT_SECONDS, slot_of

# Sort ranks inside one instant: what was carried in, then versions, then events, so that a
# version that starts exactly at the event's time is visible to the event.
_CARRY, _VERSION, _EVENT = -1, 0, 1

# Rows of a key that one task may order at once.
BUSY_ROWS = 100_000


def asof_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_ts: str,
    right_ts: str,
    values: Sequence[str],
    how: str = "inner",
    tie_break: str | None = None,
    tolerance_seconds: int | None = None,
    deleted: Column | None = None,
    slot_seconds: int = SLOT_SECONDS,
    busy: Sequence | None = None,
) -> DataFrame:
    """Adds ``values`` of the newest ``right`` row with ``right_ts <= left_ts`` to each left row.

    ``how="left"`` keeps left rows without a version (and those with a NULL key or time).
    ``tie_break`` orders right rows of the same key and time. With ``tolerance_seconds`` a
    version older than that does not match. A newest version for which ``deleted`` holds is a
    tombstone: it hides the versions before it and does not match itself.

    Both sides go through one shuffle on (key, time slot); the last version seen so far is a
    running value, so the work is linear in the rows of both sides whatever the number of
    versions, and a busy key is spread over its slots. A slot starts from the newest version of
    the slots before it, found on one pre-aggregated row per key and slot.

    ``busy`` names the keys to cut into slots (``busy_keys`` finds them); every other key is ordered
    whole and needs no carried versions. Without it all keys are cut.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    known = F.col(key).isNotNull()
    gone = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
    version = F.struct(F.col(right_ts).alias("_from"), gone.alias("_gone"), *[F.col(c) for c in values])
    cut = F.lit(True) if busy is None else F.col("_key").isin(list(busy)) if busy else F.lit(False)
    slot = F.when(cut, slot_of(F.col("_at"), slot_seconds * MICROS)).otherwise(F.lit(0).cast("bigint"))

    events = (
        left.where(known & F.col(left_ts).isNotNull())
        .select(
            F.col(key).alias("_key"),
            micros(left_ts).alias("_at"),
            F.lit(_EVENT).alias("_rank"),
            F.struct(*[F.col(c) for c in left.columns]).alias("_row"),
        )
        .withColumn("_slot", slot)
    )
    versions = (
        right.where(known & F.col(right_ts).isNotNull())
        .select(
            F.col(key).alias("_key"),
            micros(right_ts).alias("_at"),
            F.lit(_VERSION).alias("_rank"),
            (F.col(tie_break) if tie_break else F.lit(0)).alias("_seq"),
            version.alias("_version"),
        )
        .withColumn("_slot", slot)
    )
    stacked = events.unionByName(versions, allowMissingColumns=True)
    if busy is None or busy:
        carried = _carried_versions(events.where(cut), versions.where(cut))
        stacked = stacked.unionByName(carried, allowMissingColumns=True)
    so_far = (
        Window.partitionBy("_key", "_slot")
        .orderBy("_at", "_rank", "_seq")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    matched = (
        stacked.withColumn("_version", F.last("_version", ignorenulls=True).over(so_far))
        .where(F.col("_rank") == _EVENT)
        .select("_row", "_version")
    )
    found = F.col("_version").isNotNull() & ~F.col("_version._gone")
    if tolerance_seconds is not None:
        age = micros(F.col(f"_row.{left_ts}")) - micros(F.col("_version._from"))
        found = found & (age <= F.lit(tolerance_seconds * MICROS))
    if how == "inner":
        return matched.where(found).select("_row.*", *[F.col(f"_version.{c}") for c in values])

    picked = [F.when(found, F.col(f"_version.{c}")).alias(c) for c in values]
    out = matched.select("_row.*", *picked)
    unkeyed = left.where(F.col(key).isNull() | F.col(left_ts).isNull())
    return out.unionByName(unkeyed, allowMissingColumns=True)


def busy_keys(left: DataFrame, right: DataFrame, key: str, over: int = BUSY_ROWS) -> list:
    """The keys with more than ``over`` rows on both sides together, for ``asof_join(busy=...)``.

    Runs a count of the keys. There is at most one such key per ``over`` rows of input.
    """
    keys = left.select(F.col(key).alias("_key")).unionByName(right.select(F.col(key).alias("_key")))
    counted = keys.where(F.col("_key").isNotNull()).groupBy("_key").count()
    return [r[0] for r in counted.where(F.col("count") > over).select("_key").collect()]


def _carried_versions(events: DataFrame, versions: DataFrame) -> DataFrame:
    """For each slot that has events: the newest version of the key's earlier slots."""
    marks = events.select("_key", "_slot").distinct().withColumn("_order", F.lit(0))
    newest = (
        versions.groupBy("_key", "_slot")
        .agg(F.max_by("_version", F.struct("_at", "_seq")).alias("_version"))
        .withColumn("_order", F.lit(1))
    )
    before = (
        Window.partitionBy("_key")
        .orderBy("_slot", "_order")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        marks.unionByName(newest, allowMissingColumns=True)
        .withColumn("_version", F.last("_version", ignorenulls=True).over(before))
        .where((F.col("_order") == 0) & F.col("_version").isNotNull())
        .select("_key", "_slot", F.lit(_CARRY).alias("_rank"), "_version")
    )


def latest_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    order: Sequence[str],
    deleted: Column | None = None,
) -> DataFrame:
    """Compacted view: the newest row per key; a newest row that is a tombstone drops the key.

    A maximum over a struct combines on the map side, so a hot key costs one row per input
    partition in the shuffle, unlike ``row_number`` over a window.
    """
    keys = [key] if isinstance(key, str) else list(key)
    newest = df.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in df.columns]), F.struct(*order)).alias("_row")
    )
    rows = newest.select("_row.*")
    return rows if deleted is None else rows.where(~F.coalesce(deleted, F.lit(False)))
