"""Small helpers shared by the tests."""

from datetime import datetime, timedelta

START = datetime(2024, 1, 1)


def at(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)


def rows(df):
    """Rows as sorted tuples, columns in frame order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


EVENTS = (
    "event_id bigint, user_id bigint, event_type string, event_timestamp timestamp_ntz, "
    "session_id string, payload string"
)


def events(spark, data):
    """``data``: (user, type, seconds[, payload]) rows; ids follow the order given."""
    full = [
        (i, user, kind, at(sec), f"s{user}", rest[0] if rest else None)
        for i, (user, kind, sec, *rest) in enumerate(data)
    ]
    return spark.createDataFrame(full, EVENTS)
