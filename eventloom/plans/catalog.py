"""Registry of named queries over the test tables, each with its SQL oracle where SQL has one."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.operators import anomaly, enrich, windows
from eventloom.plans.oracle_tables import TABLES
from eventloom.session import checkpoint_root, configure
from eventloom.sources import testdata

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The canonical inputs and the derived tables over one test-data folder, built lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = configure(spark), sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        builder = getattr(testdata, name, None)
        if builder is None:
            raise AttributeError(name)
        return builder(self.spark, self.sf_dir)

    def scratch(self, name: str) -> str:
        """A new folder for files a query writes and reads back."""
        return f"{checkpoint_root(self.spark)}/{name}-{uuid.uuid4().hex}"

    @cached_property
    def known_events(self) -> DataFrame:
        return enrich.keep_event_types(self.user_events)

    @cached_property
    def enriched(self) -> DataFrame:
        return enrich.enrich_events(self.user_events, self.users)

    @cached_property
    def enriched_left(self) -> DataFrame:
        return enrich.enrich_events(self.user_events, self.users, how="left")

    @cached_property
    def hourly(self) -> DataFrame:
        return windows.hourly_activity(self.user_events)

    @cached_property
    def sliding(self) -> DataFrame:
        return windows.sliding_activity(self.user_events)

    @cached_property
    def sessions(self) -> DataFrame:
        return windows.user_sessions(self.user_events)

    @cached_property
    def daily(self) -> DataFrame:
        return windows.daily_analytics(self.user_events)

    @cached_property
    def anomalies(self) -> DataFrame:
        return anomaly.anomaly_detection(self.user_events_dense)


def comparable(df: DataFrame) -> DataFrame:
    """Column types that print alike in Spark and in the SQL oracle."""
    columns = []
    for field in df.schema.fields:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(kind, T.DecimalType) and kind.scale in (0, 2):
            c = c.cast(f"decimal(38,{kind.scale})")
        elif isinstance(kind, (T.DecimalType, T.FloatType, T.DoubleType)):
            c = F.round(c.cast("double"), 6)
        elif isinstance(kind, T.ArrayType):
            c = F.array_join(c, ",")
        elif isinstance(kind, T.MapType):
            entries = F.array_sort(F.map_entries(c))
            c = F.array_join(
                F.transform(entries, lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))),
                ",",
            )
        columns.append(c.alias(field.name))
    return df.select(*columns)


def with_tables(sql: str) -> str:
    """Prefixes a query with the derived tables it mentions, in dependency order."""
    needed: list[str] = []
    seen: set[str] = set()

    def visit(text: str) -> None:
        for name, body in TABLES.items():
            if name not in seen and re.search(rf"\b{name}\b", text):
                seen.add(name)
                visit(body)
                needed.append(name)

    visit(sql)
    ctes = ", ".join(f"{name} AS ({TABLES[name].strip()})" for name in needed)
    body = sql.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"


def query(name: str, oracle: str | None = None):
    """Registers ``f(tables) -> DataFrame``."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(build(Tables(spark, sf_dir)))

        run.__name__ = name
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = with_tables(oracle)
        return build

    return register
