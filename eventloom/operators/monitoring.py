"""Log and metric queries: alert conditions, dashboard panels, suppression and cool-down.

Input: ``logs(ts, source_category, raw)`` with one JSON text per line. Everything before the
first aggregate is a projection and filter, and every aggregate combines on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.exprs import MICROS, json_field, micros, percent, ratio, verdict
from eventloom.operators.skew import slot_of
from eventloom.operators.windows import time_slices

METRICS = "kafka/*/metrics"
LOGS = "kafka/*/logs"
CONNECTORS = "kafka/connectors"
JOBS = "kafka/flink"
DAY = 86_400


def category(pattern: str) -> Column:
    """Condition on the source category; ``*`` stands for any text."""
    column = F.col("source_category")
    escaped = pattern.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return column.like(escaped.replace("*", "%")) if "*" in pattern else column == pattern


def parse(logs: DataFrame, source: str, fields: dict[str, str]) -> DataFrame:
    """Lines of one source with the named JSON fields: ``{column: json key}``."""
    columns = [json_field("raw", key).alias(name) for name, key in fields.items()]
    return logs.where(category(source)).select("ts", *columns)


def _count() -> Column:
    return F.count(F.lit(1))


def _mean(column: str) -> Column:
    value = F.col(column).try_cast("decimal(18,6)")
    return ratio(F.sum(value), F.count(value))


def compare(value: Column, comparison: str | Column, threshold: Column | float) -> Column:
    """``GreaterThan``, ``GreaterThanOrEqual``, ``LessThan``, ``LessThanOrEqual``."""
    op = F.lit(comparison) if isinstance(comparison, str) else comparison
    limit = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return (
        F.when(op == "GreaterThan", value > limit)
        .when(op == "GreaterThanOrEqual", value >= limit)
        .when(op == "LessThan", value < limit)
        .when(op == "LessThanOrEqual", value <= limit)
    )


def _windowed_count(df: DataFrame, window: str, keys: Sequence[str]) -> DataFrame:
    counted = df.groupBy(F.window("ts", window).alias("_w"), *keys).agg(_count().alias("hits"))
    return counted.select(F.col("_w.start").alias("window_start"), *keys, "hits")


# --- alerts --------------------------------------------------------------------------------

def consumer_lag_alert(
    logs: DataFrame, max_lag: int = 10000, window: str = "5 minutes", threshold: int = 1,
    comparison: str = "GreaterThan", source: str = METRICS,
) -> DataFrame:
    lines = parse(
        logs, source, {"lag": "consumer.lag", "consumer_group": "consumer_group", "topic": "topic"}
    ).where(F.col("lag").try_cast("bigint") > max_lag)
    hits = _windowed_count(lines, window, ["consumer_group", "topic"])
    return hits.withColumn("fires", compare(F.col("hits"), comparison, threshold))


def not_running_alert(
    logs: DataFrame, status_field: str, keys: Sequence[str], source: str,
    window: str = "2 minutes", threshold: int = 1, comparison: str = "GreaterThanOrEqual",
) -> DataFrame:
    lines = parse(logs, source, {"status": status_field, **{k: k for k in keys}})
    hits = _windowed_count(lines.where(F.col("status") != "RUNNING"), window, keys)
    return hits.withColumn("fires", compare(F.col("hits"), comparison, threshold))


def connector_failure_alert(logs: DataFrame, source: str = LOGS) -> DataFrame:
    return not_running_alert(logs, "status", ["connector_name"], source, "2 minutes")


def job_failure_alert(logs: DataFrame, source: str = JOBS) -> DataFrame:
    return not_running_alert(logs, "job_status", ["job_name", "job_id"], source, "3 minutes")


def error_rate_alert(
    logs: DataFrame, max_rate: float = 5, slice_size: str = "5 minutes", source: str = LOGS
) -> DataFrame:
    """Slices whose share of ERROR lines is above the limit."""
    level = F.col("level")
    totals = parse(logs, source, {"level": "level"}).groupBy(F.window("ts", slice_size)).agg(
        F.count_if(level == "ERROR").alias("errors"), F.count_if(level != "").alias("total")
    ).select(F.col("window.start").alias("timeslice"), "errors", "total")
    rate = percent(F.col("errors"), F.col("total"))
    return totals.withColumn("error_rate", rate).where(F.col("error_rate") > max_rate)


def throughput_slices(logs: DataFrame, slice_size: str, source: str = METRICS) -> DataFrame:
    lines = time_slices(parse(logs, source, {"throughput": "throughput"}), slice_size)
    return lines.groupBy("timeslice").agg(_mean("throughput").alias("avg_throughput"))


def period_compare(series: DataFrame, bucket: str, value: str, shift_hours: int) -> DataFrame:
    """Each bucket next to the bucket ``shift_hours`` before it, with the change in percent.

    A join on the shifted time, not a lag: missing buckets must not move the comparison.
    """
    before = series.select(
        F.timestamp_add("HOUR", F.lit(shift_hours), F.col(bucket)).alias(bucket),
        F.col(value).alias(f"{value}_before"),
    )
    change = percent(F.col(value) - F.col(f"{value}_before"), F.col(f"{value}_before"))
    return series.join(before, bucket).withColumn("change_pct", change)


def throughput_drop_alert(
    logs: DataFrame, max_change: float = -50, slice_size: str = "5 minutes", shift_hours: int = 1,
    source: str = METRICS,
) -> DataFrame:
    slices = throughput_slices(logs, slice_size, source)
    return period_compare(slices, "timeslice", "avg_throughput", shift_hours).where(
        F.col("change_pct") < max_change
    )


def checkpoint_failure_alert(
    logs: DataFrame, threshold: int = 3, slice_size: str = "10 minutes", source: str = JOBS
) -> DataFrame:
    fields = {"status": "checkpoint_status", "job_name": "job_name"}
    failed = parse(logs, source, fields).where(F.col("status") == "FAILED")
    hits = failed.groupBy("job_name", F.window("ts", slice_size)).agg(_count().alias("failures"))
    hits = hits.select("job_name", F.col("window.start").alias("timeslice"), "failures")
    return hits.where(F.col("failures") > threshold)


# --- dashboard panels ----------------------------------------------------------------------

def throughput_panel(logs: DataFrame) -> DataFrame:
    return throughput_slices(logs, "1 minute")


def _count_panel(logs: DataFrame, source: str, field: str) -> DataFrame:
    lines = parse(logs, source, {field: field})
    return lines.groupBy(field).agg(_count().alias("lines"))


def topic_panel(logs: DataFrame) -> DataFrame:
    return _count_panel(logs, METRICS, "topic")


def lag_panel(logs: DataFrame) -> DataFrame:
    fields = {"lag": "consumer.lag", "consumer_group": "consumer_group", "topic": "topic"}
    lines = parse(logs, METRICS, fields)
    return lines.groupBy("consumer_group", "topic").agg(_mean("lag").alias("avg_lag"))


def connector_status_panel(logs: DataFrame) -> DataFrame:
    return _count_panel(logs, CONNECTORS, "status")


def connector_errors_panel(logs: DataFrame) -> DataFrame:
    lines = time_slices(parse(logs, CONNECTORS, {"level": "level"}), "5 minutes")
    return lines.groupBy("timeslice").agg(F.count_if(F.col("level") == "ERROR").alias("errors"))


def top_failing_connectors(logs: DataFrame, limit: int = 10) -> DataFrame:
    """A top-k report; ties are broken by name."""
    lines = parse(logs, CONNECTORS, {"connector_name": "connector_name", "level": "level"})
    counted = (
        lines.where(F.col("level") == "ERROR").groupBy("connector_name").agg(_count().alias("errors"))
    )
    return counted.orderBy(F.desc("errors"), "connector_name").limit(limit)


def top_failing_panel(logs: DataFrame, limit: int = 10) -> DataFrame:
    """The report as a panel shows it: with each connector's rank, its share of all errors and the
    time of its last one."""
    lines = parse(logs, CONNECTORS, {"connector_name": "connector_name", "level": "level"})
    counted = lines.where(F.col("level") == "ERROR").groupBy("connector_name").agg(
        _count().alias("errors"), F.max("ts").alias("last_error")
    )
    all_errors = counted.agg(F.sum("errors")).scalar()
    top = counted.orderBy(F.desc("errors"), "connector_name").limit(limit)
    rank = F.row_number().over(Window.orderBy(F.desc("errors"), "connector_name"))  # at most ``limit`` rows
    return top.select(
        rank.alias("rank"), "connector_name", "errors", percent(F.col("errors"), all_errors).alias("error_share_pct"),
        "last_error",
    )


def job_status_panel(logs: DataFrame) -> DataFrame:
    return _count_panel(logs, JOBS, "job_status")


def latency_panel(logs: DataFrame) -> DataFrame:
    lines = time_slices(parse(logs, JOBS, {"latency": "processing_latency"}), "1 minute")
    return lines.groupBy("timeslice").agg(_mean("latency").alias("avg_latency"))


def checkpoint_duration_panel(logs: DataFrame) -> DataFrame:
    lines = time_slices(parse(logs, JOBS, {"duration": "checkpoint_duration"}), "5 minutes")
    return lines.groupBy("timeslice").agg(_mean("duration").alias("avg_duration"))


def histogram(df: DataFrame, value: Column, buckets: Sequence[float]) -> DataFrame:
    """Cumulative histogram ``(le, count)``; the last bucket, ``+Inf``, counts all values."""
    counts = df.agg(
        *[F.count_if(value <= limit).alias(f"b{i}") for i, limit in enumerate(buckets)],
        F.count(value).alias("all"),
    )
    rows = [
        F.struct(F.lit(f"{limit:g}").alias("le"), F.col(f"b{i}").alias("cumulative_count"))
        for i, limit in enumerate(buckets)
    ]
    rows.append(F.struct(F.lit("+Inf").alias("le"), F.col("all").alias("cumulative_count")))
    return counts.select(F.inline(F.array(*rows)))


# --- evaluation, suppression, cool-down ----------------------------------------------------

def evaluate_rules(values: DataFrame, rules: DataFrame) -> DataFrame:
    """``values(rule, value)`` against ``rules(rule, comparison, threshold, severity)``.

    Rules are configuration, a handful of rows. A rule without a value stays, its ``fires`` null.
    """
    joined = rules.join(values, "rule", "left")
    fires = compare(F.col("value"), F.col("comparison"), F.col("threshold"))
    return joined.withColumn("fires", fires)


def suppress(
    alerts: DataFrame, quiet_from: int = 2, quiet_until: int = 6, ts: str = "fired_at"
) -> DataFrame:
    """Drops info and warning in dev, and warning in the quiet hours."""
    severity = F.col("severity")
    in_dev = (F.col("environment") == "dev") & severity.isin("info", "warning")
    hour = F.hour(ts)
    at_night = (severity == "warning") & (hour >= quiet_from) & (hour < quiet_until)
    return alerts.where(~(F.coalesce(in_dev, F.lit(False)) | F.coalesce(at_night, F.lit(False))))


def cooldown(
    alerts: DataFrame,
    minutes: int = 15,
    max_per_hour: int | None = 20,
    rule: str = "rule",
    ts: str = "fired_at",
    last_sent: DataFrame | None = None,
) -> DataFrame:
    """At most one alert per rule until ``minutes`` after the last one sent, and at most
    ``max_per_hour`` over all rules and clock hour (earliest first, then by rule).

    Which alert is sent depends on the one sent before it, but only on that one. Each rule's
    times are cut into slots of a day (or of the pause, if longer). A slot is folded once from
    each of its times within one pause of its start, where any chain from earlier slots must
    enter it, to the last time such a chain sends. These few (entry, exit) pairs, and not the
    times, are chained over a rule's slots to find where each slot is really entered; then the
    slots are folded apart from each other. A cell holds at most the times of one slot: alerts
    are the output of evaluation windows, one time per evaluation, a number set by the clock.
    ``last_sent(rule, last_sent)`` continues an earlier run.
    """
    kind = alerts.schema[ts].dataType
    pause = minutes * 60 * MICROS
    width = max(DAY * MICROS, pause)
    at = micros(F.col(ts))
    none = F.lit(None).cast("bigint")
    slots = (
        alerts.where(F.col(ts).isNotNull())
        .select(rule, at.alias("_at"), slot_of(at, width).alias("_slot"))
        .groupBy(rule, "_slot")
        .agg(F.array_sort(F.collect_set("_at")).alias("_times"))
    )
    if last_sent is not None:
        earlier = last_sent.select(rule, micros("last_sent").alias("_last"))
        free = F.filter("_times", lambda t: F.col("_last").isNull() | (t >= F.col("_last") + pause))
        slots = slots.join(earlier, rule, "left").withColumn("_times", free).where(F.size("_times") > 0)

    def last_from(entry: Column) -> Column:
        """The last time sent by a chain that enters the slot at ``entry``."""
        return F.aggregate(
            "_times", none,
            lambda last, t: F.when((t >= entry) & (last.isNull() | (t >= last + pause)), t).otherwise(last),
        )

    # A chain enters at the first time a pause after its last one, so in the slot's first pause
    # or at the first time after that.
    early = F.filter("_times", lambda t: t < F.col("_slot") * width + pause)
    entries = F.slice("_times", F.lit(1), F.size(early) + 1)
    reach = F.transform(entries, lambda t: F.struct(t.alias("entry"), last_from(t).alias("exit")))
    chains = slots.select(rule, F.struct("_slot", reach.alias("reach")).alias("_link")).groupBy(rule).agg(
        F.array_sort(F.collect_list("_link")).alias("_chain")
    )

    def enter(so_far: Column, slot: Column) -> Column:
        last = so_far["last"]
        free = F.filter(slot["reach"], lambda r: last.isNull() | (r["entry"] >= last + pause))
        first = F.get(free, F.lit(0))
        here = F.array(F.struct(slot["_slot"].alias("_slot"), first["entry"].alias("entry")))
        return F.when(first.isNull(), so_far).otherwise(
            F.struct(first["exit"].alias("last"), F.concat(so_far["entered"], here).alias("entered"))
        )

    nowhere = F.array().cast("array<struct<_slot:bigint,entry:bigint>>")
    start = F.struct(none.alias("last"), nowhere.alias("entered"))
    entered = chains.select(rule, F.inline(F.aggregate("_chain", start, enter)["entered"]))
    sent = F.aggregate(
        "_times", F.array().cast("array<bigint>"),
        lambda kept, t: F.when(
            (t >= F.col("entry")) & ((F.size(kept) == 0) | (t >= F.element_at(kept, -1) + pause)),
            F.concat(kept, F.array(t)),
        ).otherwise(kept),
    )
    out = slots.join(entered, [rule, "_slot"]).select(rule, F.explode(sent).alias("_sent"))
    out = out.select(rule, F.timestamp_micros("_sent").cast(kind).alias(ts))
    if max_per_hour is None:
        return out
    in_hour = Window.partitionBy(F.date_trunc("HOUR", F.col(ts))).orderBy(ts, rule)
    return (
        out.withColumn("_n", F.row_number().over(in_hour))
        .where(F.col("_n") <= max_per_hour)
        .drop("_n")
    )


def log_search_check(
    logs: DataFrame, min_count: int = 1, min_parsed: float = 95, keys: Sequence[str] = ("source_category",)
) -> DataFrame:
    """Enough lines, and enough of them JSON, per source."""
    m = logs.groupBy(*keys).agg(
        _count().alias("total_lines"),
        F.count(F.try_parse_json("raw")).alias("parsed_lines"),
    )
    rate = percent(F.col("parsed_lines"), F.col("total_lines"))
    good = (F.col("total_lines") >= min_count) & (rate > min_parsed)
    return m.withColumn("parse_rate", rate).withColumn("result", verdict(good))
