"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, target / source size. The
documents of a source stand in one order (size class, then a content hash); the expected copies
are prefix-summed along it, one random offset is added, and a document is emitted once for each
integer boundary that its interval crosses. Sums are integers in units of 2**-32 copies, so
reruns agree and a document's copies never exceed its expectation rounded up.

The order is cut into blocks (source, size class, first three digits of the hash). Block totals
are aggregated first and give each block its carry, so no task sees a whole source: a source with
a third of all rows is spread over its size classes times 4096 blocks. One row per block, and one
per source, is all that a single window orders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventloom.llm.common import content_key, word_count

UNIT = 1 << 32


def source_targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """``source, source_size`` (one row per source) with ``target``: each source's share.

    Sources in code-point order, null last, take the weights in turn and share the sum of all
    sizes; no target exceeds ``cap`` times its source's size, and what is cut off is shared anew
    by weight. That fixed point is a water level: with sources in order of cap / weight, the
    level that remains after capping the first k sources is highest where capping must stop.
    """
    everything = W.partitionBy()
    n = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(n - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sizes.select("source", "source_size", n.alias("_loom_n"), weight.cast("long").alias("_loom_w"))
    ranked = ranked.withColumn("_loom_cap", F.col("source_size") * cap)
    fill = everything.orderBy(F.col("_loom_cap").cast("double") / F.col("_loom_w"), "_loom_n")
    before = F.coalesce(F.sum("_loom_cap").over(fill.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    above = F.sum("_loom_w").over(fill.rowsBetween(0, W.unboundedFollowing))
    rest = F.sum("source_size").over(everything) - before
    level = F.max("_loom_level").over(everything)
    return (
        ranked.withColumn("_loom_level", rest.cast("double") / above.cast("double"))
        .withColumn("target", F.least(F.col("_loom_cap").cast("double"), level * F.col("_loom_w")))
        .select("source", "source_size", "target")
    )


def _size_class(size: Column) -> Column:
    """Size by its binary length and leading four digits: eight classes an octave, in order."""
    bits = F.bin(size)
    return F.concat(
        F.lpad(F.length(bits).cast("string"), 2, "0"), F.rpad(F.substring(bits, 1, 4), 4, "0")
    )


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` with ``size`` (words; a null text has none) and the hash that orders them."""
    return docs.withColumns({"size": word_count(), "_loom_key": content_key("doc_id", "text")})


def mix(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), cap: int = 3, seed: int = 7
) -> DataFrame:
    """Every document with ``size`` (words), ``source_size``, ``target`` and ``copies``.

    Needs ``doc_id``, ``text``, ``source``; other columns travel along, a column that already has
    one of the four result names is replaced. A null text has size 0; a null source is a source
    of its own; a source without words gets no copies. Repeated rows are separate documents. An
    empty table gives an empty result.
    """
    return copies(sized(docs), weights, cap, seed)


def copies(
    rows: DataFrame, weights: Sequence[int] = (5, 2, 1), cap: int = 3, seed: int = 7
) -> DataFrame:
    """``mix`` for rows of ``sized``, which is read twice: for the totals and for the copies."""
    keyed = rows.drop("source_size", "target", "copies").withColumns({
        "_loom_source": F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")),
        "_loom_class": _size_class(F.col("size")),
        "_loom_block": F.substring("_loom_key", 1, 3),
    })
    block = ["_loom_source", "_loom_class", "_loom_block"]

    blocks = keyed.groupBy(*block).agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"), F.first("source").alias("source")
    )
    targets = source_targets(
        blocks.groupBy("_loom_source").agg(F.first("source").alias("source"), F.sum("size").alias("source_size")),
        weights, cap,
    )
    ratio = F.least(F.col("target") / F.nullif(F.col("source_size").cast("double"), F.lit(0.0)), F.lit(float(cap)))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}"), F.col("_loom_source"))), 1, 8), 16, 10)
    targets = targets.select(
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("_loom_source"),
        "source_size", "target",
        F.coalesce(F.floor(ratio * UNIT), F.lit(0)).cast("long").alias("_loom_each"),
    ).withColumn("_loom_offset", offset.cast("long"))
    order = W.partitionBy("_loom_source").orderBy("_loom_class", "_loom_block")
    mass = (F.col("n") * F.col("_loom_each")).cast("decimal(38,0)")
    carry = F.coalesce(F.sum(mass).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    carries = (
        blocks.join(targets, "_loom_source")
        .withColumn("_loom_carry", F.pmod(carry + F.col("_loom_offset"), F.lit(UNIT).cast("decimal(38,0)")).cast("long"))
        .select(*block, "source_size", "target", "_loom_each", "_loom_carry")
    )
    within = W.partitionBy(*block).orderBy("_loom_key", "doc_id").rowsBetween(W.unboundedPreceding, 0)
    end = F.col("_loom_carry") + F.sum("_loom_each").over(within)
    return (
        keyed.join(carries, block)
        .withColumn("copies", _crossings(end))
        .drop(*block, "_loom_key", "_loom_each", "_loom_carry")
    )


def _crossings(end: Column) -> Column:
    """Integer boundaries in (end - each, end], in whole numbers."""
    return F.shiftright(end, 32) - F.shiftright(end - F.col("_loom_each"), 32)


def emit(mixed: DataFrame) -> DataFrame:
    """The mix itself: each document as many times as it is taken."""
    again = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    return mixed.withColumn("_loom_again", again).drop("_loom_again")
