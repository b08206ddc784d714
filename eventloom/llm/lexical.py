"""Ranked lexical search: a stated set of items against every document, by dense matrix tiles.

The terms of a block of items are its vocabulary. One pass over the documents counts the
vocabulary's terms in every whole text (document, term number, occurrences) and the corpus
figures; weights follow from them. Then the weights of the items (items x terms) are multiplied with the
impacts of the documents (terms x documents), tile by tile, in float64: all entries are whole
numbers, and a tile has so few terms that no partial sum reaches 2^53, so every sum is exact in any
order of addition. Tiles' sums are added as 64-bit integers. Each task keeps the best rows of
every item, ties included as the order by id decides; tasks are merged in two steps.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventloom.llm.common import stored

ITEMS = 1024  # items of a block at most
PAIRS = 1 << 18  # a block is closed beyond so many (item, term) pairs; one item is never split
TERMS_TILE, DOCS_TILE = 2048, 512  # 8 MB of weights for 512 items, 8 MB of impacts
CHUNK = 1 << 20  # bytes of a text split at once
EXACT = 1 << 53
SPREAD = 64  # salts of the first step of the merge

# Bytes of a term: digits, letters (lower-cased) and all of every character beyond ASCII. Every
# other byte becomes a blank, so the terms are what blanks separate.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def term_counts(text: bytes) -> Counter:
    """Occurrences of every term of a whole UTF-8 text, split in chunks that end between terms."""
    counts: Counter = Counter()
    carry = b""
    for at in range(0, len(text), CHUNK):
        piece = carry + text[at: at + CHUNK].translate(_TERM_BYTES)
        if at + CHUNK < len(text):
            cut = piece.rfind(b" ") + 1
            piece, carry = piece[:cut], piece[cut:]
        counts.update(piece.split())
    return counts


def _utf8(column: pa.Array) -> pa.Array:
    return column.cast(pa.large_binary())


def item_terms(items: DataFrame, item: str, text: str) -> DataFrame:
    """``item, term``: the distinct terms of each item's texts; items without terms have no rows."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, value in enumerate(_utf8(batch.column(1))):
                terms = sorted(term_counts(value.as_py() or b""))
                if terms:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(at, 1).take(pa.array([0] * len(terms))), pa.array(terms, pa.binary())],
                        ["item", "term"],
                    )

    kind = items.schema[item].dataType.simpleString()
    return items.select(F.col(item).alias("item"), text).mapInArrow(split, f"item {kind}, term binary").distinct()


def _item_blocks(pairs: DataFrame) -> Iterator[list[tuple]]:
    """Blocks of whole items, of at most ``ITEMS`` items; the driver holds one block at a time."""
    block: list[tuple] = []
    for row in pairs.orderBy("item").toLocalIterator():
        fresh = not block or row["item"] != block[-1][0]
        if fresh and block and (len(block) >= PAIRS or len({i for i, _ in block}) >= ITEMS):
            yield block
            block = []
        block.append((row["item"], bytes(row["term"])))
    if block:
        yield block


def vocabulary_counts(docs: DataFrame, vocabulary: list[bytes], doc: str, text: str) -> DataFrame:
    """``doc_id, n, ids, tfs`` for every document: all its terms, and those of the vocabulary."""
    number = {term: i for i, term in enumerate(vocabulary)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, DOCS_TILE):
                batch = whole.slice(at, DOCS_TILE)
                n, ids, tfs, ends = [], [], [], [0]
                for value in _utf8(batch.column(1)):
                    counts = term_counts(value.as_py() or b"")
                    known = [(number[term], tf) for term, tf in counts.items() if term in number]
                    n.append(counts.total())
                    ids.extend(i for i, _ in known)
                    tfs.extend(tf for _, tf in known)
                    ends.append(len(ids))
                cuts = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(cuts, pa.array(ids, pa.int32())),
                     pa.ListArray.from_arrays(cuts, pa.array(tfs, pa.int64()))],
                    ["doc_id", "n", "ids", "tfs"],
                )

    kind = docs.schema[doc].dataType.simpleString()
    columns = docs.select(F.col(doc).alias("doc_id"), text)
    return columns.mapInArrow(count, f"doc_id {kind}, n long, ids array<int>, tfs array<long>")


def _tile_terms(weights: np.ndarray) -> int:
    """Terms of a tile: no sum of that many products reaches 2^53. An impact is below 10^6."""
    return max(1, min(TERMS_TILE, EXACT // (10**6 * max(1, int(weights.max(initial=1))))))


def tile_scores(weights: np.ndarray, of_item: np.ndarray, of_term: np.ndarray, items: int,
                row: np.ndarray, term: np.ndarray, impact: np.ndarray, docs: int) -> np.ndarray:
    """Scores (items x docs, int64) of one tile of documents given as (row, term, impact) entries."""
    scores = np.zeros((items, docs), dtype=np.int64)
    used, dense = np.unique(term, return_inverse=True)  # only terms that occur in the tile
    place = np.full(len(weights), -1, dtype=np.int64)
    place[used] = np.arange(len(used))
    width = _tile_terms(weights)
    term_at = place[of_term]
    for a in range(0, len(used), width):
        wide = min(width, len(used) - a)
        left = np.zeros((items, wide))
        some = (term_at >= a) & (term_at < a + wide)
        left[of_item[some], term_at[some] - a] = weights[of_term[some]]
        right = np.zeros((wide, docs))
        part = (dense >= a) & (dense < a + wide)
        right[dense[part] - a, row[part]] = impact[part]
        scores += (left @ right).astype(np.int64)
    return scores


def _best(item: np.ndarray, score: np.ndarray, doc: np.ndarray, null: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best of every item: higher score, then smaller id, null ids last."""
    order = np.lexsort((doc, null, -score, item))
    sorted_items = item[order]
    first = np.searchsorted(sorted_items, sorted_items)
    return order[np.arange(len(order)) - first < k]


def _score(weights: np.ndarray, of_item: np.ndarray, of_term: np.ndarray, items: int, scale: tuple[int, int], k: int) -> Callable:
    documents, terms = scale

    def impacts(n: np.ndarray, tf: np.ndarray) -> np.ndarray:
        if len(n) and int(n.max()) * 50 * documents >= 1 << 63:
            m = np.array([50 + 50 * int(x) * documents // terms for x in n], dtype=np.int64)
        else:
            m = 50 + 50 * n * documents // max(terms, 1)
        if len(tf) and int(tf.max()) >= 1 << 33:
            return np.array([10**9 * int(t) // (1000 * int(t) + 20 * int(x)) for t, x in zip(tf, m)], dtype=np.int64)
        return 10**9 * tf // (1000 * tf + 20 * m)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)]
        floor = np.ones(items, dtype=np.int64)  # a score must reach this to count
        for batch in batches:
            ids = batch.column(0)
            null = ids.is_null().to_numpy(zero_copy_only=False)
            doc = ids.fill_null(0).to_numpy(zero_copy_only=False)
            lengths = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(lengths)])
            term = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(doc)), lengths)
            impact = impacts(batch.column(1).to_numpy()[row], batch.column(3).flatten().to_numpy(zero_copy_only=False))
            for a in range(0, len(doc), DOCS_TILE):
                b = min(a + DOCS_TILE, len(doc))
                part = slice(ends[a], ends[b])
                scores = tile_scores(weights, of_item, of_term, items, row[part] - a, term[part], impact[part], b - a)
                item, at = np.nonzero(scores >= floor[:, None])  # ties with the last one kept stay in
                found = [item, scores[item, at], doc[a:b][at], null[a:b][at]]
                kept = [np.concatenate(pair) for pair in zip(kept, found)]
                best = _best(*kept, k)
                kept = [column[best] for column in kept]
                full = np.bincount(kept[0], minlength=items) >= k
                last = np.full(items, np.iinfo(np.int64).max)
                np.minimum.at(last, kept[0], kept[1])
                floor[full] = last[full]
        if len(kept[0]):
            yield pa.RecordBatch.from_arrays(
                [pa.array(kept[0].astype(np.int32)), pa.array(kept[2], pa.int64(), mask=kept[3]), pa.array(kept[1])],
                ["at", "doc_id", "score"],
            )

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best documents of every item; salts first, so that no task orders all of an item's rows."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SPREAD)))
    first = salted.withColumn("rank", F.row_number().over(W.partitionBy("at", "salt").orderBy(*order)))
    best = first.where(F.col("rank") <= k).drop("rank", "salt")
    return best.withColumn("rank", F.row_number().over(W.partitionBy("at").orderBy(*order))).where(F.col("rank") <= k)


def rank(docs: DataFrame, items: DataFrame, k: int = 50, doc: str = "doc_id", text: str = "text",
         item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every item, scores above 0.

    Null and empty texts have no terms and no score. Rows of one item id (null is one too) are one
    item with all their terms; items without terms, or without a scored document, give no rows. Every
    document row is ranked by itself, repeated ones too; ids are integers, null ids come last
    among equal scores. Other columns, clashing names included, are not looked at.
    """
    spark = docs.sparkSession
    kind = items.schema[item].dataType.simpleString()
    result = None
    for block in _item_blocks(stored(item_terms(items, item, item_text), "item-terms")):
        names = list(dict.fromkeys(i for i, _ in block))
        number = {i: at for at, i in enumerate(names)}
        vocabulary = sorted({term for _, term in block})
        place = {term: at for at, term in enumerate(vocabulary)}
        of_item = np.array([number[i] for i, _ in block])
        of_term = np.array([place[term] for _, term in block])
        counted = stored(vocabulary_counts(docs, vocabulary, doc, text), "term-counts")
        size = counted.where("n > 0").agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        # At most one row per term of the vocabulary.
        held = counted.select(F.explode("ids").alias("term")).groupBy("term").count().collect()
        df = np.zeros(len(vocabulary), dtype=np.int64)
        for r in held:
            df[r["term"]] = r["count"]
        weights = np.array([math.floor(1000 * math.log((2 * size["docs"] + 2) / (2 * int(x) + 1))) for x in df], dtype=np.int64)
        run = _score(weights, of_item, of_term, len(names), (size["docs"], size["terms"]), k)
        entries = counted.where(F.size("ids") > 0).select(F.col("doc_id").cast("long").alias("doc_id"), "n", "ids", "tfs")
        found = entries.mapInArrow(run, "at int, doc_id long, score long")
        named = spark.createDataFrame([Row(at=at, item_id=i) for at, i in enumerate(names)], f"at int, item_id {kind}")
        best = _ranked(found, k).join(F.broadcast(named), "at")  # at most ITEMS rows
        best = stored(best.select("item_id", "rank", "doc_id", "score"), "ranked")
        result = best if result is None else result.unionByName(best)
    if result is None:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return result
