"""Per-record transforms in the connector property form, compiled to one projection."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Type names of the Cast property and the Spark types they stand for.
CAST_TYPES = {
    "int32": "int",
    "int64": "bigint",
    "float64": "double",
    "boolean": "boolean",
    "string": "string",
}


@dataclass(frozen=True)
class Transform:
    """One step: its alias, its type without package and target, and its options."""

    name: str
    kind: str
    options: Mapping[str, str] = field(default_factory=dict)


def read_properties(text: str) -> dict[str, str]:
    """``key=value`` lines; blank lines and ``#`` comments are skipped."""
    pairs = (line.split("=", 1) for line in map(str.strip, text.splitlines())
             if line and not line.startswith("#"))
    return {key.strip(): value.strip() for key, value in pairs}


def transforms_of(properties: Mapping[str, str]) -> list[Transform]:
    """The steps named by ``transforms=a,b,c`` in that order."""
    steps = []
    for name in filter(None, (n.strip() for n in properties.get("transforms", "").split(","))):
        prefix = f"transforms.{name}."
        options = {k[len(prefix):]: v for k, v in properties.items() if k.startswith(prefix)}
        if "type" not in options:
            raise ValueError(f"transform {name!r} has no type")
        kind = options.pop("type").rsplit(".", 1)[-1].split("$", 1)[0]
        steps.append(Transform(name, kind, options))
    return steps


def _pairs(text: str) -> dict[str, str]:
    return dict(item.split(":", 1) for item in text.replace(" ", "").split(",") if item)


def rename_fields(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Fields that are absent are left alone."""
    return df.withColumnsRenamed({old: new for old, new in renames.items() if old in df.columns})


def _cast(column: Column, kind: str) -> Column:
    if kind not in CAST_TYPES:
        raise ValueError(f"unknown cast type {kind!r}")
    if kind == "boolean":
        return F.when(column.isNotNull(), column.cast("string") == "true")
    return column.try_cast(CAST_TYPES[kind])


def cast_fields(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """Text that does not parse becomes NULL; ``cast_errors`` names such fields."""
    return df.withColumns(
        {name: _cast(F.col(name), kind) for name, kind in spec.items() if name in df.columns}
    )


def cast_errors(df: DataFrame, spec: Mapping[str, str]) -> Column:
    """Reasons for rows of the *uncast* frame, e.g. ``user_id is not int32``."""
    reasons = [
        F.when(F.col(n).isNotNull() & _cast(F.col(n), k).isNull(), f"{n} is not {k}").otherwise("")
        for n, k in spec.items()
        if n in df.columns
    ]
    return F.array_remove(F.array(*reasons, F.lit("")), "")


def extract_field(df: DataFrame, path: str) -> DataFrame:
    """The record becomes the nested field, under its leaf name."""
    return df.select(F.col(path).alias(path.rsplit(".", 1)[-1]))


def insert_timestamp(df: DataFrame, name: str, at: Column | int | None = None) -> DataFrame:
    """Epoch milliseconds of arrival: a column, a literal, or the clock."""
    if isinstance(at, int):
        return df.withColumn(name, F.lit(at).cast("bigint"))
    arrival = F.current_timestamp() if at is None else at.cast("timestamp")
    return df.withColumn(name, F.unix_millis(arrival))


def insert_static(df: DataFrame, values: Mapping[str, str]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def filter_records(df: DataFrame, predicate: Column | str) -> DataFrame:
    return df.where(predicate)


def route_by_date(
    df: DataFrame, topic: str, ts: Column, date_format: str = "yyyy-MM-dd"
) -> DataFrame:
    """Adds the target topic ``<topic>-<date>``."""
    return df.withColumn(
        "topic", F.concat(F.lit(f"{topic}-"), F.date_format(ts, date_format))
    )


def apply_transform(
    df: DataFrame, step: Transform, arrival: Column | int | None = None, topic: str = "records"
) -> DataFrame:
    options = step.options
    if step.kind == "ReplaceField":
        return rename_fields(df, _pairs(options["renames"]))
    if step.kind == "Cast":
        return cast_fields(df, _pairs(options["spec"]))
    if step.kind == "ExtractField":
        return extract_field(df, options["field"])
    if step.kind == "InsertField":
        if "timestamp.field" in options:
            df = insert_timestamp(df, options["timestamp.field"], arrival)
        if "static.field" in options:
            df = insert_static(df, {options["static.field"]: options["static.value"]})
        return df
    if step.kind == "Filter":
        return filter_records(df, options["predicate"])
    if step.kind == "TimestampRouter":
        at = F.current_timestamp() if not isinstance(arrival, Column) else arrival
        return route_by_date(df, topic, at, options.get("timestamp.format", "yyyy-MM-dd"))
    raise ValueError(f"unknown transform type {step.kind!r} in {step.name!r}")


def apply_chain(
    df: DataFrame,
    properties: Mapping[str, str] | str,
    arrival: Column | int | None = None,
    topic: str = "records",
) -> DataFrame:
    """Applies the steps in order. An unknown step fails here, before any row is read."""
    if isinstance(properties, str):
        properties = read_properties(properties)
    for step in transforms_of(properties):
        df = apply_transform(df, step, arrival, topic)
    return df


def split_rejects(df: DataFrame, errors: Column, stop_on_error: bool = False) -> DataFrame:
    """Adds ``error_reason`` (NULL for good rows), joined from the reasons.

    One projection serves both outputs. ``stop_on_error`` fails the job on a bad row instead.
    """
    reason = F.nullif(F.array_join(errors, "; "), F.lit(""))
    if stop_on_error:
        reason = F.when(reason.isNotNull(), F.raise_error(reason)).otherwise(reason)
    return df.withColumn("error_reason", reason)


def good_rows(split: DataFrame) -> DataFrame:
    return split.where(F.col("error_reason").isNull()).drop("error_reason")


def rejected_rows(split: DataFrame) -> DataFrame:
    return split.where(F.col("error_reason").isNotNull())


def broken_checks(checks: Iterable[tuple[str, Column]]) -> Column:
    """Reasons of the checks that do not hold; an unknown check does not hold."""
    broken = [F.when(F.coalesce(ok, F.lit(False)), "").otherwise(name) for name, ok in checks]
    return F.array_remove(F.array(*broken), "")
