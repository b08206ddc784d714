"""Scalar expressions over event rows. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000

# The event types the enrichment and the three-type variant keep.
EVENT_TYPES = ("purchase", "view", "click", "login", "logout")
CORE_EVENT_TYPES = ("purchase", "view", "click")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def json_value(document: Column | str, path: str) -> Column:
    """Scalar at ``path`` as text; NULL when it is missing or the text is no JSON."""
    return F.get_json_object(_col(document), path)


def json_field(document: Column | str, key: str) -> Column:
    """Top-level field whose name may contain dots."""
    return F.get_json_object(_col(document), f"$['{key}']")


def to_decimal(text: Column | str, precision: int = 10, scale: int = 2) -> Column:
    return _col(text).try_cast(f"decimal({precision},{scale})")


def payload_amount(payload: Column | str = "payload") -> Column:
    return to_decimal(json_value(payload, "$.amount"))


def purchase_amount(
    event_type: Column | str = "event_type", payload: Column | str = "payload"
) -> Column:
    """The JSON amount of a purchase, zero for every other event."""
    zero = F.lit(0).cast("decimal(10,2)")
    return F.when(_col(event_type) == "purchase", payload_amount(payload)).otherwise(zero)


def purchase_only_amount(
    event_type: Column | str = "event_type", payload: Column | str = "payload"
) -> Column:
    """The amount of a purchase, NULL for every other event, so averages skip those."""
    return F.when(_col(event_type) == "purchase", payload_amount(payload))


def tier_multiplier(tier: Column | str = "user_tier") -> Column:
    tier = _col(tier)
    factor = F.when(tier == "premium", 1.5).when(tier == "gold", 1.2).otherwise(1.0)
    return factor.cast("decimal(2,1)")


def event_time(ts: Column | str = "event_timestamp") -> Column:
    """Event time as an instant with millisecond precision."""
    return F.date_trunc("MILLISECOND", _col(ts).cast("timestamp"))


def elapsed(unit: str, start: Column | str, end: Column | str) -> Column:
    """Whole elapsed units from ``start`` to ``end``."""
    return F.timestamp_diff(unit, _col(start), _col(end))


def micros(ts: Column | str) -> Column:
    """Microseconds since the epoch; monotone in ``ts``."""
    return F.unix_micros(_col(ts).cast("timestamp"))


def ratio(part: Column, whole: Column) -> Column:
    """Double division, NULL (not an error) on a zero divisor."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * 100


def int_div(a: Column, b: Column) -> Column:
    """Integer division of two BIGINTs, NULL on a zero divisor."""
    return F.call_function("div", a, F.nullif(b, F.lit(0).cast("bigint")))


def verdict(condition: Column, good: str = "PASS", bad: str = "FAIL") -> Column:
    """PASS or FAIL; an unknown condition is a FAIL."""
    return F.when(condition, good).otherwise(bad)


def within_days(ts: Column | str, as_of: Column, days: int) -> Column:
    """Strictly younger than ``days`` before ``as_of``."""
    return _col(ts) > as_of - F.make_dt_interval(F.lit(days))


def duration_text(seconds: Column | str) -> Column:
    """``7s``, ``2m 5s`` or ``1h 2m 3s``."""
    s = _col(seconds).cast("bigint")
    hours, rest = int_div(s, F.lit(3600)), s % 60
    minutes = int_div(s % 3600, F.lit(60))
    return (
        F.when(s < 60, F.format_string("%ds", s))
        .when(s < 3600, F.format_string("%dm %ds", minutes, rest))
        .otherwise(F.format_string("%dh %dm %ds", hours, minutes, rest))
    )
