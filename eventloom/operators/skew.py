"""Time slots: how operators that order rows per key stay clear of hot keys.

Ordering rows per key alone would put all rows of a key into one task. Such operators (as-of
join, trailing counts, gap sessions) order them per key and time slot instead, for every key
alike, and give each slot a *carry*: what the slots before it add up to. Only the carries are
ordered per key: at most one row per slot, so their number for a key is bounded by the time
span, not by the key's rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SLOT_SECONDS = 900


def slot_of(position: Column, width: int) -> Column:
    """Index of the slot of ``width`` units that holds a position."""
    whole = position - F.pmod(position, F.lit(width))
    return F.call_function("div", whole, F.lit(width).cast("bigint"))
