"""Counts over a trailing time range of the same key, both range ends included.

``count(*) over (partition by key order by ts range between w preceding and current row)``

Spark evaluates a sliding frame by visiting the whole frame for each row, which is quadratic
for dense keys, and it puts a key in one task. Here the count of ``[t-w, t]`` is what has entered
up to ``t`` minus what has left before ``t``: each event enters at ``t`` and, per frame, leaves just
after ``t+w``. Both are marks of a running sum, which is linear in the rows and can be cut
anywhere: each time slot of a key starts from the sums of the slots before it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.exprs import MICROS, micros
from eventloom.operators.skew import SLOT_SECONDS, slot_of
from eventloom.operators.windows import merge_gaps


def trailing_counts(
    df: DataFrame,
    key: str,
    ts: str,
    counts: Mapping[str, int],
    distinct: Mapping[str, tuple[str, int]],
    slot_seconds: int = SLOT_SECONDS,
) -> DataFrame:
    """Adds one column per entry of ``counts`` (name -> seconds) and of ``distinct``
    (name -> (column, seconds)). Rows without a time are dropped.
    """
    timed = df.where(F.col(ts).isNotNull())
    measures = [*counts, *distinct]
    slot = slot_of(F.col("_pos"), 2 * slot_seconds * MICROS)

    marks = _event_marks(timed, key, ts, counts)
    for name, (column, seconds) in distinct.items():
        cover = _cover_marks(timed, key, ts, name, column, seconds)
        marks = marks.unionByName(cover, allowMissingColumns=True)
    marks = marks.withColumn("_slot", slot)

    # What a mark adds to each measure; a NULL step is an event entering every count.
    step = {m: F.when(F.col("_name") == m, F.col("_step")).otherwise(0) for m in measures}
    entering = F.col("_name").isNull()
    step |= {m: F.when(entering, 1).otherwise(step[m]) for m in counts}
    step = {m: c.cast("bigint") for m, c in step.items()}

    before = (
        Window.partitionBy("_key").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = (
        marks.groupBy("_key", "_slot")
        .agg(*[F.sum(c).alias(m) for m, c in step.items()], F.count_if(entering).alias("_events"))
        .select("_key", "_slot", "_events", *[F.sum(m).over(before).alias(m) for m in measures])
        .where((F.col("_events") > 0) & F.col(measures[0]).isNotNull())
        .select("_key", "_slot", F.struct(*measures).alias("_carry"))
    )
    so_far = (
        Window.partitionBy("_key", "_slot")
        .orderBy(F.col("_pos").asc_nulls_first())
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carried = F.col("_carry").isNotNull()
    summed = marks.unionByName(carry, allowMissingColumns=True).select(
        "_row",
        *[
            F.sum(F.when(carried, F.col(f"_carry.{m}")).otherwise(c)).over(so_far).alias(m)
            for m, c in step.items()
        ],
    )
    return summed.where(F.col("_row").isNotNull()).select("_row.*", *measures)


def _event_marks(df: DataFrame, key: str, ts: str, counts: Mapping[str, int]) -> DataFrame:
    """An event's entry, which carries its row, and its leaving of each frame.

    Positions are doubled microseconds, so that a leaving mark has a place of its own right
    after the last instant at which the event still counts.
    """
    at = micros(ts)
    enter = _mark(None, 2 * at, 0)
    leave = [_mark(name, 2 * (at + F.lit(w * MICROS)) + 1, -1) for name, w in counts.items()]
    entered = F.col("_mark._name").isNull()
    return df.select(
        F.col(key).alias("_key"),
        F.struct(*df.columns).alias("_row"),
        F.explode(F.array(enter, *leave)).alias("_mark"),
    ).select("_key", "_mark.*", F.when(entered, F.col("_row")).alias("_row"))


def _cover_marks(
    df: DataFrame, key: str, ts: str, name: str, column: str, seconds: int
) -> DataFrame:
    """+1 when a value comes into range and -1 when its last event has left it.

    Events of one value whose ranges touch form one span: sessions with the range as gap.
    """
    spans = merge_gaps(df.where(F.col(column).isNotNull()), [key, column], ts, seconds)
    come = _mark(name, 2 * micros("session_start"), 1)
    go = _mark(name, 2 * (micros("session_end") + F.lit(seconds * MICROS)) + 1, -1)
    return spans.select(
        F.col(key).alias("_key"), F.explode(F.array(come, go)).alias("_mark")
    ).select("_key", "_mark.*")


def _mark(name: str | None, position: Column, step: int) -> Column:
    return F.struct(
        position.alias("_pos"), F.lit(name).cast("string").alias("_name"), F.lit(step).alias("_step")
    )
