"""User enrichment, the plain lookup and the per-row derivations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions import classify, exprs
from eventloom.operators.asof import asof_join

USER_COLUMNS = ("user_name", "user_email", "registration_date", "user_tier", "country")
EVENT_COLUMNS = ("user_id", "event_type", "event_timestamp", "session_id", "payload")
ENRICHED_COLUMNS = (
    *EVENT_COLUMNS, *USER_COLUMNS, "purchase_amount", "tier_multiplier", "event_time",
    "processing_time",
)


def keep_event_types(df: DataFrame, types: Sequence[str] = exprs.EVENT_TYPES) -> DataFrame:
    return df.where(F.col("event_type").isin(*types))


def derive(df: DataFrame) -> DataFrame:
    """Adds the computed columns of an event joined with its user.

    ``processing_time`` is the arrival column when the input carries one, else the clock.
    """
    arrival = F.col("processing_time") if "processing_time" in df.columns else F.current_timestamp()
    return df.withColumns(
        {
            "purchase_amount": exprs.purchase_amount(),
            "tier_multiplier": exprs.tier_multiplier(),
            "event_time": exprs.event_time(),
            "processing_time": arrival.cast("timestamp"),
        }
    ).select(*ENRICHED_COLUMNS)


def enrich_events(events: DataFrame, users: DataFrame, how: str = "inner", **options) -> DataFrame:
    """Events with the user version valid at event time. The type filter runs before the join."""
    arrival = [c for c in ("processing_time",) if c in events.columns]
    kept = keep_event_types(events).select(*EVENT_COLUMNS, *arrival)
    joined = asof_join(
        kept, users, "user_id", "event_timestamp", "valid_from", USER_COLUMNS, how, **options
    )
    return derive(joined)


def lookup_join(events: DataFrame, users: DataFrame) -> DataFrame:
    """Left lookup on a one-row-per-user table.

    No broadcast hint: the table grows with the user base, so Spark decides by its size, and
    AQE splits the partitions of a hot user when it sorts and merges.
    """
    kept = events.select("event_id", *EVENT_COLUMNS)
    return kept.join(users.select("user_id", *USER_COLUMNS), "user_id", "left")


def transform_events(events: DataFrame) -> DataFrame:
    """The documented small form: event time, product and amount for the three core types."""
    return keep_event_types(events, exprs.CORE_EVENT_TYPES).select(
        *EVENT_COLUMNS,
        exprs.event_time().alias("event_time"),
        exprs.json_value("payload", "$.product_id").alias("product_id"),
        exprs.purchase_amount().alias("purchase_amount"),
        F.col("processing_time").cast("timestamp").alias("processing_time"),
    )


def transform_users(users: DataFrame) -> DataFrame:
    return users.select(
        "user_id",
        F.upper("user_name").alias("user_name"),
        "age",
        classify.age_group(F.col("age")).alias("age_group"),
    )


def attribute_purchases(events: DataFrame, within_seconds: int = 3600, **options) -> DataFrame:
    """Join of two event streams: each purchase with the user's latest view at most an hour old.

    One row per purchase, so a busy user does not turn into all pairs of its events.
    """
    purchases = events.where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("purchase_id"),
        "user_id",
        F.col("event_timestamp").alias("purchase_time"),
    )
    views = events.where(F.col("event_type") == "view").select(
        "user_id", F.col("event_id").alias("view_id"), F.col("event_timestamp").alias("view_time")
    )
    joined = asof_join(
        purchases, views, "user_id", "purchase_time", "view_time", ("view_id", "view_time"),
        tie_break="view_id", tolerance_seconds=within_seconds, **options,
    )
    return joined.withColumn(
        "seconds_to_purchase", exprs.elapsed("SECOND", F.col("view_time"), F.col("purchase_time"))
    )
