"""Dataset comparison: field-level diff, order-insensitive set difference, upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.operators.asof import latest_per_key


def record_set_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Records whose multiplicity differs, with ``left_count`` and ``right_count``.

    Copies are counted on the map side, so a record that fills a third of the table is one
    row in the shuffle. An empty result means equal datasets.
    """
    columns = left.columns
    sides = left.select(*columns, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*columns, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    return (
        sides.groupBy(*columns)
        .agg(F.sum("_l").alias("left_count"), F.sum("_r").alias("right_count"))
        .where(F.col("left_count") != F.col("right_count"))
    )


def diff_join(
    before: DataFrame, after: DataFrame, keys: Sequence[str], fields: Sequence[str]
) -> DataFrame:
    """One row per (key, field) that differs; a missing side is reported once.

    Keys are unique on both sides.
    """
    b = before.select(*keys, F.struct(*fields).alias("_before"))
    a = after.select(*keys, F.struct(*fields).alias("_after"))
    joined = b.join(a, list(keys), "full_outer")
    changes = [
        F.when(
            ~F.col(f"_before.{f}").eqNullSafe(F.col(f"_after.{f}")),
            F.struct(
                F.lit(f).alias("field"),
                F.col(f"_before.{f}").cast("string").alias("before"),
                F.col(f"_after.{f}").cast("string").alias("after"),
            ),
        )
        for f in fields
    ]

    def whole(kind: str):
        none = F.lit(None).cast("string")
        return F.array(F.struct(F.lit(kind).alias("field"), none.alias("before"), none.alias("after")))

    found = (
        F.when(F.col("_after").isNull(), whole("<removed>"))
        .when(F.col("_before").isNull(), whole("<added>"))
        .otherwise(F.array_compact(F.array(*changes)))
    )
    return joined.select(*keys, F.explode(found).alias("_c")).select(*keys, "_c.*")


def upsert(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The target after the changes: last change per key wins, new columns are added."""
    newest = latest_per_key(changes, keys, order)
    untouched = target.join(newest.select(*keys), list(keys), "left_anti")
    return untouched.unionByName(newest, allowMissingColumns=True)
