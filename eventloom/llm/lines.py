"""Line deduplication over levelled sorted runs of line hashes.

A run is a table of 128-bit line hashes, bucketed and sorted by hash, with the number of documents
that hold the line and its keeper, the largest id that holds it. Documents come in batches of
falling ids. A new batch is merge-anti-joined with the runs: a line that no run holds is new and
takes its keeper from the batch; one that a run holds only adds its count, because the run's
keeper is larger. The batch then becomes a run of level 0, and two runs of one level are merged
into one of the next, so that at most log2(batches) runs exist at a time. Bucketing makes both the
anti-join and the merge free of shuffles on the runs' side. When all batches are in, the last
merge says which lines are repeated; their other occurrences go.

Line hashes are counted per (hash, document) first and then per hash with partial sums, so a line
in a third of all documents is one row per task. Its occurrences meet the verdict in a join that
adaptive execution splits.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import BLANKS, let, remove, stored, text_or_empty
from eventloom.session import checkpoint_root

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH = ["h1", "h2"]
NO_ID = -(1 << 63)


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z only; all-ASCII text takes the fast built-in."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


class LineRuns:
    """The levelled runs; ``add`` takes batches in falling order of ids."""

    def __init__(self, spark, buckets: int):
        self.spark, self.buckets = spark, buckets
        self.levels: list[tuple[int, str]] = []

    def add(self, pairs: DataFrame) -> None:
        """``pairs``: one row per line hash and document id (``h1, h2, doc``), ids below all earlier."""
        batch = pairs.groupBy(*HASH).agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc").alias("keeper"))
        held = F.lit(False)
        for k, (_, name) in enumerate(self.levels):
            run = self.spark.table(name).select(*HASH, F.lit(True).alias(f"held{k}"))
            batch = batch.join(run, HASH, "left")
            held = held | F.col(f"held{k}").isNotNull()
        new = F.when(~held, F.col("keeper"))
        self._write(0, batch.select(*HASH, "n_docs", new.alias("keeper")))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            self._merge_last()

    def merged(self) -> DataFrame | None:
        """All runs as one, or None before the first batch."""
        while len(self.levels) > 1:
            self._merge_last()
        return self.spark.table(self.levels[0][1]) if self.levels else None

    def drop(self) -> None:
        for _, name in self.levels:
            self._drop(name)
        self.levels = []

    def _folder(self, name: str) -> str:
        return f"{checkpoint_root(self.spark)}/llm/{name}"

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove(self.spark, self._folder(name))

    def _merge_last(self) -> None:
        (level, older), (_, newer) = self.levels[-2:]
        a, b = self.spark.table(older), self.spark.table(newer)
        for side, frame in (("a", a), ("b", b)):
            renamed = frame.withColumnsRenamed({"n_docs": f"{side}_n", "keeper": f"{side}_keeper"})
            a, b = (renamed, b) if side == "a" else (a, renamed)
        zero = F.lit(0)
        both = a.join(b, HASH, "full").select(
            *HASH,
            (F.coalesce("a_n", zero) + F.coalesce("b_n", zero)).alias("n_docs"),
            F.coalesce("a_keeper", "b_keeper").alias("keeper"),
        )
        self._write(level + 1, both)
        self.levels = [*self.levels[:-3], self.levels[-1]]
        for name in (older, newer):
            self._drop(name)

    def _write(self, level: int, run: DataFrame) -> None:
        name = f"loom_line_run_{uuid.uuid4().hex}"
        self.levels.append((level, name))
        # A bucketed table needs a name; its files are in the shared folder like all others.
        run.write.option("path", self._folder(name)).bucketBy(self.buckets, *HASH).sortBy(*HASH).saveAsTable(name)


def _occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per line long enough to be compared: document, its content, position, hash."""
    lines = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64("text").alias("content"),
        F.posexplode(F.split(text_or_empty(), "\n")).alias("pos", "line"),
    ).filter(F.char_length("line") >= min_chars)
    key = F.btrim(F.col("line"), F.lit(BLANKS))
    keyed = lines.select("doc", "content", "pos", key.alias("key")).filter(F.char_length("key") >= min_chars)
    low = ascii_lower(F.col("key"))
    return keyed.select(
        "doc", "content", "pos", F.xxhash64(low).alias("h1"), F.xxhash64(F.lit(1), low).alias("h2")
    )


def dedup_lines(
    docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 4
) -> DataFrame:
    """``docs`` with repeated lines dropped from ``text``, and ``n_lines``, ``n_dropped``.

    Lines compare by their text stripped of white space, A-Z lower-cased. One of at least
    ``min_chars`` characters found in at least ``min_docs`` documents stays only where its largest
    ``doc_id`` is, there as often as it stands. A null text is one empty line, and the result is
    empty text; a null id is the smallest id; rows of equal id are one document. Other columns
    travel along. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    cuts = docs.select(
        F.percentile_approx(F.col("doc_id").cast("long"), [k / batches for k in range(1, batches)], 1000)
    ).first()[0] if batches > 1 else []
    batch = sum((F.when(F.col("doc") <= cut, 1).otherwise(0) for cut in sorted(set(cuts or []))), F.lit(0))
    seen = stored(_occurrences(docs, min_chars).withColumn("batch", batch), "lines", ("batch",))

    runs = LineRuns(spark, int(spark.conf.get("spark.sql.shuffle.partitions")))
    try:
        for k in range(len(set(cuts or [])) + 1):
            runs.add(seen.filter(F.col("batch") == k).select(*HASH, "doc").distinct())
        repeated = stored(
            runs.merged().filter(F.col("n_docs") >= min_docs).select(*HASH, "keeper"), "repeated-lines"
        )
    finally:
        runs.drop()

    gone = (
        seen.join(repeated, HASH).filter(F.col("doc") != F.col("keeper"))
        .groupBy("doc", "content").agg(F.collect_set("pos").alias("_loom_gone"))
    )
    text = text_or_empty()
    keyed = docs.drop("n_lines", "n_dropped").withColumns({
        "_loom_doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)),
        "_loom_content": F.xxhash64("text"),
    })
    joined = keyed.join(
        gone.withColumnsRenamed({"doc": "_loom_doc", "content": "_loom_content"}),
        ["_loom_doc", "_loom_content"], "left",
    )
    kept = let(
        F.split(text, "\n"),
        lambda lines: F.array_join(
            F.transform(
                F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_loom_gone")),
                lambda i: F.get(lines, i),
            ), "\n",
        ),
    )
    return joined.withColumns({
        "n_lines": (F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long"),
        "n_dropped": F.coalesce(F.size("_loom_gone"), F.lit(0)).cast("long"),
        "text": F.when(F.col("_loom_gone").isNull(), text).otherwise(kept),
    }).drop("_loom_doc", "_loom_content", "_loom_gone")
