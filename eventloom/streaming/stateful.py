"""Continuous operators with state of their own per key: anomalies over a trailing day, a temporal join
of events with versions, alert cool-down, and running totals that expire.

State lives in Spark's state store and moves on with the checkpoint, so no batch reads what an
earlier one has written. Rows wait in a key's state until the watermark has passed them and are
then handled in order of event time, whatever order they came in; rows behind the watermark on arrival are
dropped by Spark and counted in the query's progress (``jobs.late_writer`` keeps them apart).
A key is handled by one task: state is kept small (packed minutes, one version, one time).

Each call to the state store costs far more than a row. So the anomalies and the join keep the state of
a bucket of keys together, a fixed hash of the key, and handle a bucket's rows in one call, in packed
chunks: the calls of a batch are bounded by the buckets, not by the keys. The number of buckets belongs to
the checkpoint; a bucket's rows of one batch and its state are in a task's memory at once.
"""

from __future__ import annotations

import pickle
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from itertools import islice
from operator import itemgetter

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eventloom.functions import classify, exprs
from eventloom.functions.exprs import MICROS, micros
from eventloom.operators.anomaly import ANOMALY_COLUMNS, DAY, HOUR, MINUTE
from eventloom.operators.enrich import EVENT_COLUMNS, USER_COLUMNS, derive, keep_event_types
from eventloom.sources.events import with_event_time

DELAY = "5 seconds"
BUCKETS, PACKS, CHUNK_ROWS = 2048, 16, 10_000
_MINUTE = MINUTE * MICROS


def _passed(timer) -> int:
    """Microseconds up to which event time is complete."""
    return timer.getCurrentWatermarkInMs() * 1000


def _due_at(at: int) -> int:
    """The watermark, in milliseconds, that has passed a time in microseconds."""
    return -(-at // 1000)


def _with_types(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _in_buckets(rows: DataFrame, key: str, buckets: int) -> DataFrame:
    """Adds the bucket of a row's key, and the pack inside it."""
    spread = F.xxhash64(key)
    return rows.withColumns({
        "_bucket": F.pmod(spread, F.lit(buckets)).cast("int"),
        "_pack": F.pmod(F.shiftright(spread, 32), F.lit(PACKS)).cast("int"),
    })


class _Ordered(StatefulProcessor):
    """Keeps a bucket's rows, whose first column is their time in microseconds, until the watermark has
    passed them; ``due`` then gets those of each key in order. ``key`` is the key's column."""

    def __init__(self, columns: Sequence[str], key: str) -> None:
        self.columns, self.key = list(columns), list(columns).index(key)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", "chunk binary")

    def order(self, row: tuple) -> tuple:
        return (row[0],)

    def due(self, groups: dict[object, list[tuple]], passed: int) -> Iterator[Row]:
        raise NotImplementedError

    def _keep(self, rows: Iterator[tuple]) -> None:
        first = None
        while chunk := list(islice(rows, CHUNK_ROWS)):
            self.pending.appendValue((pickle.dumps(chunk),))
            earliest = min(row[0] for row in chunk)
            first = earliest if first is None else min(first, earliest)
        if first is not None:
            self.handle.registerTimer(_due_at(first))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        def carried() -> Iterator[tuple]:
            pick = None
            for row in rows:
                pick = pick or itemgetter(*map(row.__fields__.index, self.columns))
                yield pick(row)

        self._keep(carried())
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = _passed(timerValues)
        groups: dict[object, list[tuple]] = {}
        waiting = []
        for (chunk,) in self.pending.get():
            for row in pickle.loads(chunk):
                if row[0] <= passed:
                    groups.setdefault(row[self.key], []).append(row)
                else:
                    waiting.append(row)
        if groups:
            self.pending.clear()
            self._keep(iter(waiting))
        for rows in groups.values():
            rows.sort(key=self.order)
        yield from self.due(groups, passed)

    def close(self) -> None:
        pass


# --- anomalies over a trailing day ---------------------------------------------------------

FIGURES = ("_burst", "events_last_hour", "events_last_day", "_types")
Minute = tuple[list[int], list[str | None]]


def trailing(
    due: Sequence[tuple[int, str | None]], counts: dict[int, int], load: Callable[[int], Minute]
) -> tuple[list[tuple[int, int, int, int]], dict[int, Minute]]:
    """For each due event (time, type), in order of time: the events of the five minutes, the hour
    and the day before it and the types of the minute before it, both ends included.

    ``counts`` has the number of earlier events per minute, ``load`` the times and types of a
    minute. Whole minutes are added up; only the minutes at the ends of a frame are loaded, so the
    work is the minutes of a day and the due events, not the events of a day. Also returns the
    minutes that changed.
    """
    loaded: dict[int, Minute] = {}

    def minute(m: int) -> Minute:
        if m not in loaded:
            loaded[m] = load(m) if counts.get(m) else ([], [])
        return loaded[m]

    changed: dict[int, list[tuple[int, str | None]]] = {}
    for at, kind in due:
        changed.setdefault(at // _MINUTE, []).append((at, kind))
    for m, fresh in changed.items():
        rows = sorted([*zip(*minute(m)), *fresh], key=lambda row: row[0])
        loaded[m] = ([at for at, _ in rows], [kind for _, kind in rows])
    totals = {**counts, **{m: len(loaded[m][0]) for m in changed}}
    minutes = sorted(totals)
    before = [0]
    for m in minutes:
        before.append(before[-1] + totals[m])

    def below(at: int) -> int:
        """Events before a time."""
        m = at // _MINUTE
        i = bisect_left(minutes, m)
        inside = bisect_left(minute(m)[0], at) if i < len(minutes) and minutes[i] == m else 0
        return before[i] + inside

    near: list[tuple[int, str | None]] = []
    for m in sorted({x for m in changed for x in (m - 1, m)}):
        near.extend(zip(*minute(m)))
    kinds: Counter = Counter()
    come = gone = 0
    out = []
    for at, _ in due:
        while come < len(near) and near[come][0] <= at:
            kinds[near[come][1]] += 1
            come += 1
        while near[gone][0] < at - _MINUTE:
            kinds[near[gone][1]] -= 1
            gone += 1
        upto = below(at + 1)
        frames = [upto - below(at - seconds * MICROS) for seconds in (5 * MINUTE, HOUR, DAY)]
        types = sum(1 for kind, n in kinds.items() if n and kind is not None)
        out.append((*frames, types))
    return out, {m: loaded[m] for m in changed}


# A minute of a user with more events than this is stored for itself.
INLINE_EVENTS = 32


class TrailingDay(_Ordered):
    """The users' events of the last day by minute, with their numbers. Busy minutes, whose events are needed
    only at the ends of a frame, are in a map of their own."""

    def __init__(self, columns: Sequence[str], key: str, key_type: str) -> None:
        super().__init__(columns, key)
        self.key_type = key_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.counts = handle.getValueState("counts", "packed binary")
        self.minutes = handle.getMapState("minutes", f"of {self.key_type}, minute bigint", "events binary")

    def _load(self, user, minute: int, held: tuple[int, Minute | None]) -> Minute:
        return pickle.loads(self.minutes.getValue((user, minute))[0]) if held[1] is None else held[1]

    def _store(self, user, minute: int, events: Minute) -> tuple[int, Minute | None]:
        n = len(events[0])
        if n <= INLINE_EVENTS:
            return n, events
        self.minutes.updateValue((user, minute), (pickle.dumps(events),))
        return n, None

    def due(self, groups, passed) -> Iterator[Row]:
        # No event to come reaches further back than a day before the watermark.
        oldest = (passed - DAY * MICROS) // _MINUTE
        packed = self.counts.get()
        users: dict[object, dict[int, tuple[int, Minute | None]]] = pickle.loads(packed[0]) if packed else {}
        result = Row(*self.columns, *FIGURES)
        for user, rows in groups.items():
            held = users.setdefault(user, {})
            figures, changed = trailing(
                [(row[0], row[1]) for row in rows], {m: n for m, (n, _) in held.items()},
                lambda m: self._load(user, m, held[m]),
            )
            for m, events in changed.items():
                held[m] = self._store(user, m, events)
            for row, found in zip(rows, figures):
                yield result(*row, *found)
        gone = [(user, m) for user, held in users.items() for m in held if m < oldest]
        for user, m in gone:
            if users[user].pop(m)[1] is None:
                self.minutes.removeKey((user, m))
        users = {user: held for user, held in users.items() if held}
        if groups or gone:
            if users:
                self.counts.update((pickle.dumps(users),))
            else:
                self.counts.clear()
        if users:
            first = min(min(held) for held in users.values())
            self.handle.registerTimer(_due_at((first + 1) * _MINUTE + DAY * MICROS + 1))


def anomaly_stream(
    events: DataFrame,
    delay: str = DELAY,
    burst_over: int = 20,
    amount_over: int = 1000,
    types_over: int = 5,
    risk: tuple[int, int, int] = (50, 30, 15),
    keep: tuple[str, ...] = (),
    buckets: int = BUCKETS,
) -> DataFrame:
    """``operators.anomaly.anomaly_detection`` on a stream: an event's row comes when the watermark
    has passed the event.

    State per bucket of users: the events that the watermark has not passed and those of the day before it,
    by user and minute. A batch handles a user's due events with the minutes of a day and, where minutes are
    busy, the few at the ends of their frames; it rereads neither files nor a busy user's whole day. A user's
    state goes when its last event is a day behind the watermark.
    """
    timed = with_event_time(events, delay=delay)
    slim = timed.where(F.col("event_timestamp").isNotNull()).select(
        micros("event_timestamp").alias("_at"), "event_type", "user_id",
        exprs.purchase_only_amount().alias("_amount"), *keep, "event_timestamp",
    )
    carried = T.StructType([f for f in slim.schema.fields if f.name != "event_timestamp"])
    schema = _with_types(carried)
    added = ", ".join(f"{name} bigint" for name in FIGURES)
    counted = _in_buckets(slim, "user_id", buckets).groupBy("_bucket").transformWithState(
        TrailingDay(carried.names, "user_id", carried["user_id"].dataType.simpleString()), f"{schema}, {added}",
        "Append", "EventTime",
    )
    flag = classify.anomaly_flag(
        F.col("_burst"), F.col("_amount"), F.col("_types"), burst_over, amount_over, types_over
    )
    return counted.withColumns(
        {
            "event_timestamp": F.timestamp_micros("_at"), "anomaly_flag": flag,
            "risk_score": classify.risk_score(F.col("_burst"), *risk),
        }
    ).select(*keep, *ANOMALY_COLUMNS)


# --- temporal join -------------------------------------------------------------------------

_VERSION, _EVENT = 0, 1


def merge_versions(rows: Sequence[tuple], current: tuple | None) -> tuple[list[tuple], tuple | None]:
    """Events and versions of one key in order (versions first at one instant) folded from the version
    that held before them: each event with its version or None, and the version that holds after."""
    out = []
    for row in rows:
        if row[1] == _VERSION:
            current = (row[4], row[5])
        else:
            out.append((row[3], current[1] if current and not current[0] else None))
    return out, current


class VersionAtEvent(_Ordered):
    """One version per key, the newest that the watermark has passed, and what is pending.

    A row has its time, side, sequence, tombstone flag, key and pack, then the columns of an event (``_e0``
    ...) and those of a version (``_v0`` ...). A batch reads the packs that its keys are in.
    """

    FIRST = 6

    def __init__(self, columns, events: int, keep_unmatched: bool) -> None:
        super().__init__(columns, "_key")
        self.events, self.keep_unmatched = events, keep_unmatched

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.current = handle.getMapState("current", "pack int", "versions binary")

    def order(self, row: tuple) -> tuple:
        return (row[0], row[1], row[2] is not None, row[2])

    def due(self, groups, passed) -> Iterator[Row]:
        packs: dict[int, list] = {}
        for key, rows in groups.items():
            packs.setdefault(rows[0][5], []).append(key)
        result = Row(*self.columns[self.FIRST:])
        unmatched = (None,) * (len(self.columns) - self.FIRST - self.events)
        last = self.FIRST + self.events
        for pack, keys in packs.items():
            held = self.current.getValue((pack,))
            versions: dict = pickle.loads(held[0]) if held else {}
            changed = False
            for key in keys:
                before = versions.get(key)
                split = [(*row[:3], row[self.FIRST:last], row[3], row[last:]) for row in groups[key]]
                joined, current = merge_versions(split, before)
                if current is not None and current is not before:
                    versions[key], changed = current, True
                for event, version in joined:
                    if version is not None or self.keep_unmatched:
                        yield result(*event, *(unmatched if version is None else version))
            if changed:
                self.current.updateValue((pack,), (pickle.dumps(versions),))


def temporal_join_stream(
    events: DataFrame,
    versions: DataFrame,
    key: str,
    left_ts: str,
    right_ts: str,
    values: Sequence[str],
    how: str = "inner",
    tie_break: str | None = None,
    deleted: Column | None = None,
    delay: str = DELAY,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``operators.asof.asof_join`` of two streams: each event with the version valid at its time,
    once the watermark has passed the event, so that versions that come a little later than the event still count.

    A key's state is one version, the newest the watermark has passed, and the rows that it has
    not; older versions are needed by no event to come. So a key with many versions costs one step
    per version and one per event. ``deleted`` marks tombstones; of versions of one time the greatest
    ``tie_break`` counts; a version that starts at the event's time is visible.

    Event time is that of the slower stream, and after a restart it stands until both have sent rows again.
    Where versions are rare, set ``spark.sql.streaming.multipleWatermarkPolicy`` to ``max``: then the
    events' clock decides, and a version that comes later than the delay behind it is dropped. ``how="left"`` keeps events
    without a version, and those without a key at once.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    gone = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
    e_fields, v_fields = [events.schema[c] for c in events.columns], [versions.schema[c] for c in values]
    e_names, v_names = [f"_e{i}" for i in range(len(e_fields))], [f"_v{i}" for i in range(len(v_fields))]
    seq_type = versions.schema[tie_break].dataType if tie_break else T.IntegerType()

    def side(df: DataFrame, ts: str, kind: int, seq: Column, is_gone: Column, e: Sequence[Column], v: Sequence[Column]) -> DataFrame:
        # Both sides have the same columns, and the watermark is set on each.
        return df.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
            F.col(key).alias("_key"), micros(ts).alias("_at"), F.lit(kind).alias("_side"), seq.alias("_seq"),
            is_gone.alias("_gone"), *[c.alias(n) for c, n in zip(e, e_names)], *[c.alias(n) for c, n in zip(v, v_names)],
            F.col(ts).cast("timestamp").alias("_time"),
        ).withWatermark("_time", delay)

    def nothing(fields: Sequence[T.StructField]) -> list[Column]:
        return [F.lit(None).cast(f.dataType) for f in fields]

    changes = side(
        versions, right_ts, _VERSION, F.col(tie_break) if tie_break else F.lit(0), gone, nothing(e_fields),
        [F.col(c) for c in values],
    )
    asked = side(
        events, left_ts, _EVENT, F.lit(None).cast(seq_type), F.lit(False), [F.col(c) for c in events.columns],
        nothing(v_fields),
    )
    typed = [(n, f.dataType.simpleString()) for n, f in [*zip(e_names, e_fields), *zip(v_names, v_fields)]]
    out_schema = ", ".join(f"{n} {kind}" for n, kind in typed)
    both = _in_buckets(asked.unionByName(changes), "_key", buckets)
    joined = both.groupBy("_bucket").transformWithState(
        VersionAtEvent(["_at", "_side", "_seq", "_gone", "_key", "_pack", *e_names, *v_names], len(e_names), how == "left"),
        out_schema, "Append", "EventTime",
    )
    out = joined.withColumnsRenamed(dict(zip([*e_names, *v_names], [*events.columns, *values])))
    if how == "inner":
        return out
    unkeyed = events.where(F.col(key).isNull() | F.col(left_ts).isNull())
    return out.unionByName(unkeyed.withColumns({c: F.lit(None).cast(out.schema[c].dataType) for c in values}))


def enrich_versions_stream(
    events: DataFrame, users: DataFrame, how: str = "inner", **options
) -> DataFrame:
    """``operators.enrich.enrich_events`` of a stream of events and a stream of user versions."""
    arrival = [c for c in ("processing_time",) if c in events.columns]
    kept = keep_event_types(events).select(*EVENT_COLUMNS, *arrival)
    joined = temporal_join_stream(
        kept, users, "user_id", "event_timestamp", "valid_from", USER_COLUMNS, how, **options
    )
    return derive(joined)


# --- alert cool-down -----------------------------------------------------------------------

def send(times: Sequence[int], last: int | None, pause: int) -> list[int]:
    """Those of the ordered times that are at least a pause after the one sent before them."""
    sent = []
    for at in times:
        if last is None or at >= last + pause:
            sent.append(at)
            last = at
    return sent


class Cooldown(StatefulProcessor):
    """A rule's last sent time, until the watermark has passed the pause after it."""

    def __init__(self, rule: str, pause: int) -> None:
        self.rule, self.pause = rule, pause

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.last.get()
        sent = send(sorted({row["_at"] for row in rows}), held[0] if held else None, self.pause)
        if sent:
            self.last.update((sent[-1],))
            self.handle.registerTimer(_due_at(sent[-1] + self.pause))
        result = Row(self.rule, "_sent")
        for at in sent:
            yield result(key[0], at)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self.last.get()
        if held and held[0] + self.pause <= _passed(timerValues):
            self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def cooldown_stream(
    alerts: DataFrame, minutes: int = 15, rule: str = "rule", ts: str = "fired_at", delay: str = DELAY
) -> DataFrame:
    """``operators.monitoring.cooldown`` without an hourly cap on a stream: an alert goes out with its
    batch; a batch's alerts count in order of their time. An alert behind the watermark is dropped.
    """
    timed = with_event_time(alerts.where(F.col(ts).isNotNull()), ts, delay)
    slim = timed.select(rule, micros(ts).alias("_at"), ts)
    kind = alerts.schema[rule].dataType.simpleString()
    sent = slim.groupBy(rule).transformWithState(
        Cooldown(rule, minutes * 60 * MICROS), f"`{rule}` {kind}, _sent bigint", "Append", "EventTime"
    )
    return sent.select(rule, F.timestamp_micros("_sent").alias(ts))


# --- totals that expire --------------------------------------------------------------------

Span = tuple[int, int, int, int]


def merge_spans(spans: Sequence[Span], ttl: int) -> list[Span]:
    """Spans (first, last, events, purchases) not further apart than the time to live, as one."""
    out: list[Span] = []
    for span in sorted(spans):
        if out and span[0] - out[-1][1] <= ttl:
            a = out[-1]
            out[-1] = (a[0], max(a[1], span[1]), a[2] + span[2], a[3] + span[3])
        else:
            out.append(span)
    return out


class IdleTotals(StatefulProcessor):
    """A key's running totals, given out and forgotten once it has been idle for the time to live."""

    def __init__(self, key: str, ttl: int) -> None:
        self.key, self.ttl = key, ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spans = handle.getListState("spans", "first bigint, last bigint, events bigint, purchases bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        fresh = merge_spans([(r["_at"], r["_at"], 1, r["_purchase"]) for r in rows], self.ttl)
        spans = merge_spans([*self.spans.get(), *fresh], self.ttl)
        self.spans.put(spans)
        self.handle.registerTimer(_due_at(spans[0][1] + self.ttl + 1))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = _passed(timerValues)
        spans = list(self.spans.get())
        idle = [s for s in spans if s[1] + self.ttl < passed]
        busy = [s for s in spans if s[1] + self.ttl >= passed]
        if idle:
            self.spans.clear()
            if busy:
                self.spans.put(busy)
        if busy:
            self.handle.registerTimer(_due_at(busy[0][1] + self.ttl + 1))
        result = Row(self.key, "_first", "_last", "events", "purchases")
        for span in idle:
            yield result(key[0], *span)

    def close(self) -> None:
        pass


def idle_totals_stream(events: DataFrame, ttl_seconds: int, key: str = "user_id", delay: str = DELAY) -> DataFrame:
    """A key's events and purchases from its first event until it has been idle for longer than the
    time to live, in event time. A key that comes back later starts afresh; one that stays busy never
    expires, however old its first event. The watermark only says how late rows may be.
    """
    timed = with_event_time(events.where(F.col("event_timestamp").isNotNull()), delay=delay)
    slim = timed.select(
        key, micros("event_timestamp").alias("_at"),
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("_purchase"), "event_timestamp",
    )
    kind = events.schema[key].dataType.simpleString()
    totals = slim.groupBy(key).transformWithState(
        IdleTotals(key, ttl_seconds * MICROS),
        f"`{key}` {kind}, _first bigint, _last bigint, events bigint, purchases bigint", "Append", "EventTime",
    )
    return totals.select(
        key, F.timestamp_micros("_first").alias("first_event"), F.timestamp_micros("_last").alias("last_event"),
        "events", "purchases",
    )


class ClockTotals(StatefulProcessor):
    """A key's running totals; the state store forgets them when they were not written for so long."""

    def __init__(self, key: str, ttl_ms: int) -> None:
        self.key, self.ttl_ms = key, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState("totals", "events bigint, purchases bigint", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.totals.get() or (0, 0)
        rows = list(rows)
        now = (held[0] + len(rows), held[1] + sum(r["_purchase"] for r in rows))
        self.totals.update(now)
        yield Row(self.key, "events", "purchases")(key[0], *now)

    def close(self) -> None:
        pass


def clock_totals_stream(events: DataFrame, ttl_ms: int, key: str = "user_id") -> DataFrame:
    """Running totals of every key after each batch that has rows of it, for update mode. The time to
    live is the machine's clock since the key's last batch: what the state store itself offers.

    Spark runs empty batches for such state for ever; a job that is to end when its input does needs
    ``spark.sql.streaming.noDataMicroBatches.enabled`` off."""
    purchase = F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("_purchase")
    kind = events.schema[key].dataType.simpleString()
    return events.select(key, purchase).groupBy(key).transformWithState(
        ClockTotals(key, ttl_ms), f"`{key}` {kind}, events bigint, purchases bigint", "Update", "ProcessingTime"
    )
