"""Per-event anomaly flag and risk score from trailing activity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions import classify, exprs
from eventloom.operators.trailing import trailing_counts

MINUTE, HOUR, DAY = 60, 3600, 86400
ANOMALY_COLUMNS = (
    "user_id", "event_timestamp", "event_type", "events_last_hour", "events_last_day",
    "anomaly_flag", "risk_score",
)


def anomaly_detection(
    events: DataFrame,
    burst_over: int = 20,
    amount_over: int = 1000,
    types_over: int = 5,
    risk: tuple[int, int, int] = (50, 30, 15),
    keep: tuple[str, ...] = (),
    **options,
) -> DataFrame:
    """``keep`` names further input columns to carry through; ``options`` go to the counts."""
    slim = events.select(
        *keep,
        "user_id",
        "event_timestamp",
        "event_type",
        exprs.purchase_only_amount().alias("_amount"),
    )
    counted = trailing_counts(
        slim,
        "user_id",
        "event_timestamp",
        {"_burst": 5 * MINUTE, "events_last_hour": HOUR, "events_last_day": DAY},
        {"_types": ("event_type", MINUTE)},
        **options,
    )
    flag = classify.anomaly_flag(
        F.col("_burst"), F.col("_amount"), F.col("_types"), burst_over, amount_over, types_over
    )
    return counted.withColumns(
        {"anomaly_flag": flag, "risk_score": classify.risk_score(F.col("_burst"), *risk)}
    ).select(*keep, *ANOMALY_COLUMNS)
