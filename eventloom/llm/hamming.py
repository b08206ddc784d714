"""Exact top-k search over binary codes by incremental multi-index hashing.

A code is cut into segments, each an index from segment value to codes. Two codes at distance d
agree in some segment up to d // segments bits, so once all segments have been searched up to a
radius r, every code nearer than segments * (r + 1) has been met. A query grows its radius until
its k-th verified distance is below that bound, at the latest until the radius is a segment's width
and all codes have been met. Queries leave as they are covered.

Equal codes are one index entry with their number and their k smallest ids, so a group of equal
vectors costs one entry, as a query and as a neighbour.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventloom.llm.common import stored

BITS = 64


def sign_code(vector: str) -> Column:
    """64 sign bits: bit i is set if the components at i, i + 64, ... sum above 0; null for null."""
    n = F.size(vector)
    parts = F.transform(
        F.sequence(F.lit(0), F.lit(BITS - 1)),
        lambda i: F.when(
            F.aggregate(
                F.filter(F.col(vector), lambda x, j: F.pmod(j, F.lit(BITS)) == i),
                F.lit(0.0), lambda total, x: total + F.coalesce(x.cast("double"), F.lit(0.0)),
            ) > 0,
            F.call_function("shiftleft", F.lit(1).cast("long"), i),
        ).otherwise(F.lit(0).cast("long")),
    )
    code = F.aggregate(parts, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
    return F.when(F.col(vector).isNull() | (n < 0), F.lit(None).cast("long")).otherwise(code)


def _segments(code: Column, count: int) -> list[tuple[Column, int]]:
    """The value and width of each segment, from the low end."""
    edges = [BITS * k // count for k in range(count + 1)]
    return [
        (F.shiftrightunsigned(code, a).bitwiseAND(F.lit((1 << (b - a)) - 1 if b - a < BITS else -1)), b - a)
        for a, b in zip(edges, edges[1:])
    ]


def _flips(width: int, radius: int) -> Column:
    masks = [sum(1 << bit for bit in bits) for bits in combinations(range(width), radius)]
    return F.array(*[F.lit(m).cast("long") for m in masks])


def _entries(codes: DataFrame, count: int) -> DataFrame:
    """One row per code and segment."""
    values = [F.struct(F.lit(k).alias("segment"), v.alias("value")) for k, (v, _) in enumerate(_segments(F.col("code"), count))]
    return codes.withColumn("at", F.explode(F.array(*values))).select("*", "at.segment", "at.value").drop("at")


def _nearest(found: DataFrame, k: int) -> DataFrame:
    """Per query the first k codes by distance and smallest id, which hold its k nearest rows: a
    code's smallest id is before all its others. ``reach`` is the k-th row's distance, or null."""
    order = W.partitionBy("query").orderBy("distance", "first_id")
    so_far = F.sum("held").over(order.rowsBetween(W.unboundedPreceding, 0))
    kept = found.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k).withColumn("so_far", so_far)
    reach = F.min(F.when(F.col("so_far") >= k, F.col("distance"))).over(W.partitionBy("query"))
    return kept.withColumn("reach", reach).drop("nth", "so_far")


def _covered(rows: DataFrame, queries: DataFrame, k: int, segments: int | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The distinct codes, the queries, and for every query code the codes that hold its nearest rows
    (``query, code, distance``) with the ``radius`` at which they were covered."""
    spark = rows.sparkSession
    want = k + 1  # one may be the query itself
    by_id = W.partitionBy("code").orderBy("id")
    clean = rows.select("id", "code").dropna().distinct()
    first_ids = clean.withColumn("nth", F.row_number().over(by_id)).filter(F.col("nth") <= want)
    counts = first_ids.groupBy("code").agg(F.count(F.lit(1)).alias("held"), F.sort_array(F.collect_list("id")).alias("ids"), F.min("id").alias("first_id"))
    codes = stored(counts, "codes")
    n_codes = codes.count()
    if segments is None:  # as long as a segment has about as many values as the index has codes
        segments = max(2, min(16, round(BITS / math.log2(max(n_codes, 2)))))
    index = stored(_entries(codes.select("code", "held", "first_id"), segments), "code-index")
    wanted = stored(queries.select("id", "code").dropna().distinct(), "code-queries")
    open_ = wanted.select(F.col("code").alias("query")).distinct()
    widths = [w for _, w in _segments(F.lit(0).cast("long"), segments)]
    best = found = None
    far = F.bit_count(F.col("query").bitwiseXOR(F.col("code"))).cast("int")
    for radius in range(max(widths) + 1):
        flips = F.array(*[
            F.struct(F.lit(s).alias("segment"), _flips(w, radius).alias("flips")) for s, w in enumerate(widths) if radius <= w
        ])
        asked = _entries(open_.withColumn("code", F.col("query")), segments).select("query", "segment", "value")
        flip = F.explode(F.expr("flips.flips")).alias("flip")
        by_segment = spark.range(1).select(F.explode(flips).alias("flips")).select(F.col("flips.segment").alias("segment"), flip)
        # As many rows as the radius has values, fixed by the segment widths.
        asked = asked.join(F.broadcast(by_segment), "segment")
        asked = asked.select("query", "segment", F.col("value").bitwiseXOR(F.col("flip")).alias("value"))
        # Spark takes the exploded side for small and would broadcast it.
        met = asked.hint("merge").join(index, ["segment", "value"])
        met = met.select("query", "code", "held", "first_id", far.alias("distance"))
        if best is not None:
            met = met.union(best.join(open_, "query", "left_semi").select(*met.columns))
        best = stored(_nearest(met.distinct(), want), "nearest")
        everything = F.lit(radius == max(widths))
        done = best.filter(everything | F.coalesce(F.col("reach") < segments * (radius + 1), F.lit(False)))
        done = done.withColumn("radius", F.lit(radius))
        found = done if found is None else found.unionByName(done)
        open_ = stored(open_.join(done.select("query").distinct(), "query", "left_anti"), "open-queries")
        if open_.limit(1).count() == 0:
            break
    return codes, wanted, found


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10, segments: int | None = None) -> DataFrame:
    """``query_id, rank, neighbor_id, distance``: the ``k`` nearest rows of every query.

    ``rows`` and ``queries`` have ``id`` and ``code`` (64 bits as a long). A query is not its own
    neighbour: rows of its own id are left out. Ties go to the smaller id; repeated rows (of one
    id and code) count once. Rows and queries without id or code are left out; fewer than k
    rows give fewer neighbours.
    """
    codes, wanted, found = _covered(rows, queries, k, segments)
    by_query = wanted.join(found.select("query", "code", "distance"), wanted["code"] == F.col("query")).select(
        F.col("id").alias("query_id"), found["code"].alias("code"), "distance"
    )
    near = by_query.join(codes.select("code", "ids"), "code").select(
        "query_id", "distance", F.explode("ids").alias("neighbor_id")
    ).filter("query_id <> neighbor_id").groupBy("query_id", "neighbor_id").agg(F.min("distance").alias("distance"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("distance", "neighbor_id"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "neighbor_id", "distance")
