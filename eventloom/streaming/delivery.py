"""Delivery of batches: bounded retries, poison records set apart, and figures from the writing pass."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from eventloom.session import configure

ATTEMPTS, BACKOFF_SECONDS = 3, 1.0


class Sink(Protocol):
    """A batch's output is made of named parts. Writing a part again replaces it; ``reset`` removes
    what an earlier run of the batch has written."""

    def reset(self, spark: SparkSession, batch_id: int) -> None: ...

    def write(self, part: DataFrame, batch_id: int, name: str) -> None: ...


Records = Callable[[pa.RecordBatch], pa.RecordBatch]


class FolderSink:
    """Parquet folders ``batch=<id>/part=<name>``; ``prepare`` is applied while writing.

    ``accept`` is the sink's own step inside the tasks: it gets records as they are written, in batches
    of any size, and returns them, of the same columns, or raises. As it can be tried on a few
    records where they are, ``sift`` finds those it refuses in one pass.
    """

    def __init__(
        self, path: str, prepare: Callable[[DataFrame], DataFrame] = lambda df: df, accept: Records | None = None
    ) -> None:
        self.path, self.prepare, self.accept = path, prepare, accept

    def reset(self, spark: SparkSession, batch_id: int) -> None:
        hadoop = spark._jvm.org.apache.hadoop.fs
        folder = hadoop.Path(f"{self.path}/batch={batch_id}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

    def write(self, part: DataFrame, batch_id: int, name: str) -> None:
        if self.accept:
            accept = self.accept
            part = part.mapInArrow(lambda batches: map(accept, batches), part.schema)
        self.prepare(part).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}/part={name}")

    def sift(self, part: DataFrame) -> DataFrame | None:
        """The rows with an ``error_reason`` on those that ``accept`` refuses; None without ``accept``."""
        if self.accept is None:
            return None
        accept = self.accept

        def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                reasons = pa.array(refusals(accept, batch), pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns, reasons], [*batch.schema.names, "error_reason"])

        return part.mapInArrow(judged, T.StructType([*part.schema.fields, T.StructField("error_reason", T.StringType())]))


def with_retries(action: Callable[[], None], attempts: int = ATTEMPTS, backoff_seconds: float = BACKOFF_SECONDS) -> int:
    """Runs the action until it succeeds, at most ``attempts`` times with a doubled pause between
    them; returns the number of attempts and raises the last error."""
    for attempt in range(1, attempts + 1):
        try:
            action()
            return attempt
        except Exception:
            if attempt == attempts:
                raise
            time.sleep(backoff_seconds * 2 ** (attempt - 1))
    raise ValueError("attempts must be positive")


def _reason(error: Exception) -> str:
    """The message that a failed write was raised with, without the stack that follows."""
    text = str(error).strip()
    return text.splitlines()[0] if text else type(error).__name__


def refusals(accept: Records, batch: pa.RecordBatch) -> list[str | None]:
    """Why each record is refused, or None: what fails is cut in two until it is a single record."""
    if batch.num_rows == 0:
        return []
    try:
        accept(batch)
        return [None] * batch.num_rows
    except Exception as error:
        if batch.num_rows == 1:
            return [_reason(error)]
    half = batch.num_rows // 2
    return refusals(accept, batch.slice(0, half)) + refusals(accept, batch.slice(half))


def delivering_writer(
    sink: Sink,
    rejects: Sink,
    attempts: int = ATTEMPTS,
    backoff_seconds: float = BACKOFF_SECONDS,
    stop_on_error: bool = False,
    most_rejects: int = 1000,
    most_share: float = 0.001,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer that sets records which cannot be written apart.

    A batch is written whole, in up to ``attempts`` attempts. If the last one fails too, what fails is cut
    in two until it is a single record (or equal ones), which goes to ``rejects`` with ``error_reason``
    and ``attempts``; every other record is written once.

    Where the sink can ``sift``, the tasks cut the rows they hold, all in one pass, and the rest is written
    whole. Else, or when the rest fails too, the batch is cut by the bits of its rows' hashes and the
    halves are written in turn, at about log2(n) writes for a poison record among n.

    ``stop_on_error`` raises instead, as does a batch with more distinct poison records than
    ``most_rejects`` and than ``most_share`` of its rows: then the sink is at fault, and nothing is dropped.

    A batch that is run again starts from nothing in both sinks.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        sink.reset(spark, batch_id)
        rejects.reset(spark, batch_id)
        rows = batch.withColumn("_hash", F.xxhash64(*batch.columns)).persist()
        batch_rows = rows.drop("_hash")
        found = 0

        def bounded(reason: str) -> None:
            if found > most_rejects and found > most_share * rows.count():
                raise RuntimeError(f"more than {most_rejects} records of batch {batch_id} cannot be written; the last: {reason}")

        def reject(part: DataFrame, name: str) -> None:
            rejects.write(part.withColumn("attempts", F.lit(attempts)), batch_id, name)

        def sifted() -> DataFrame | None:
            """Rejects what the sink's tasks refuse; returns the rest, or None where none is refused."""
            nonlocal found
            judged = sink.sift(batch_rows) if hasattr(sink, "sift") else None
            if judged is None:
                return None
            refused = judged.where(F.col("error_reason").isNotNull()).persist()
            try:
                seen = refused.agg(F.count_distinct(F.xxhash64(*batch.columns)).alias("n"), F.max("error_reason").alias("last")).first()
                found += seen["n"]
                if not found:
                    return None
                bounded(seen["last"])
                reject(refused, "sifted")
            finally:
                refused.unpersist()
            good = judged.where(F.col("error_reason").isNull()).drop("error_reason")
            return good.withColumn("_hash", F.xxhash64(*batch.columns))

        def deliver(part: DataFrame, name: str, whole: bool) -> None:
            nonlocal found
            try:
                # Only the whole batch is tried again: its halves fail for what they hold.
                tries = attempts if whole else 1
                with_retries(lambda: sink.write(part.drop("_hash"), batch_id, name), tries, backoff_seconds)
                return
            except Exception as error:
                if stop_on_error:
                    raise
                reason = _reason(error)
            rest = sifted() if whole else None
            if rest is not None:
                deliver(rest, "rest", False)
                return
            bits = part.agg(F.bit_or("_hash").alias("any"), F.bit_and("_hash").alias("all")).first()
            if bits["any"] is None:  # no record can be at fault
                raise RuntimeError(f"batch {batch_id} is empty and cannot be written: {reason}")
            differ = bits["any"] ^ bits["all"]
            if differ == 0:
                found += 1
                bounded(reason)
                reject(part.drop("_hash").withColumn("error_reason", F.lit(reason)), name)
                return
            bit = (differ & -differ).bit_length() - 1  # the lowest in which the rows differ
            for side in (0, 1):
                half = part.where(F.shiftright("_hash", bit).bitwiseAND(F.lit(1)) == side)
                deliver(half, f"{name}-{bit}{'ab'[side]}", False)

        try:
            deliver(rows, "all", True)
        finally:
            rows.unpersist()

    return write


# --- figures from the pass that writes -----------------------------------------------------

def observed_writer(
    write: Callable[[DataFrame, int], None], metrics_path: str, checks: Mapping[str, Column]
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer that also leaves one row of figures per batch.

    ``checks`` are aggregates over the batch (counts, sums, extremes). They are gathered while ``write``
    runs its first job over the batch, so the batch is not read again for them. A repeated batch
    replaces its row.
    """

    def observed(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = Observation(f"batch-{batch_id}")
        named = [value.alias(name) for name, value in checks.items()]
        write(batch.observe(seen, *named), batch_id)
        kinds = batch.agg(*named).schema
        figures = seen.get
        row = tuple(figures.get(f.name) for f in kinds)
        spark.createDataFrame([row], kinds).write.mode("overwrite").parquet(f"{metrics_path}/batch={batch_id}")

    return observed


PROGRESS = (
    "query string, batch long, input_rows long, state_rows long, dropped_by_watermark long, "
    "watermark string, metrics map<string, string>"
)


def progress_row(progress) -> tuple:
    """A micro-batch's figures: rows read, rows of state, rows that came behind the watermark and
    were dropped by a stateful operator, and what ``Dataset.observe`` gathered."""
    states = progress.stateOperators
    observed = {f"{name}.{k}": str(v) for name, row in progress.observedMetrics.items() for k, v in row.asDict().items()}
    return (
        progress.name or str(progress.id), progress.batchId, progress.numInputRows, sum(s.numRowsTotal for s in states),
        sum(s.numRowsDroppedByWatermark for s in states), progress.eventTime.get("watermark"), observed,
    )


class ProgressTable(StreamingQueryListener):
    """Appends the figures of every micro-batch to a table, one folder per query and batch.

    Add it with ``spark.streams.addListener``. Spark reports progress after a batch has been committed: a
    batch that was reported twice replaces its row; one whose report was lost with the driver has none.
    """

    def __init__(self, spark: SparkSession, path: str, names: Sequence[str] | None = None) -> None:
        super().__init__()
        self.spark, self.path, self.names = configure(spark), path, names

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = progress_row(event.progress)
        if self.names is None or row[0] in self.names:
            target = f"{self.path}/of={row[0]}/batch_id={row[1]}"
            self.spark.createDataFrame([row], PROGRESS).write.mode("overwrite").parquet(target)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROGRESS).option("recursiveFileLookup", "true").parquet(path)
