"""Language identification with language-bitmask n-gram filters.

The model is a bit-sliced Bloom filter over letter trigrams: each of its slots is a bitmask of
languages, inserting a trigram for a language sets that language's bit in a few slots, and the
AND of a trigram's slots is the set of all languages that contain it. A document is looked up as
one array of trigrams; for each language the set bits are counted and corrected for the false
positives that the language's fill implies, and the language with most evidence wins.

A language contains a trigram when its share of the language's trigrams is not far below the
largest share in any language. Profiles are fitted in Spark on a bounded, hash-chosen sample of
the labelled rows (``sample_docs`` per language); everything else covers every row and every
language, 64 of them in a mask word.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventloom.llm.common import stored

UNDETERMINED = "und"
WORD = 64  # languages in a mask word
SLOT_BITS = 18
PROBES = 3
SLICE_BITS = 12
CHARS = 1 << 19  # code points normalised at once


@cache
def _letters() -> np.ndarray:
    """For every code point its lower-case letter, or 0 if it is none."""
    table = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The letter trigrams of all texts as integers, and where each text's begin (plus the end).

    Runs of other characters count as one space; trigrams do not span one.
    """
    codes = np.frombuffer((" " + " ".join(texts) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)))
    low = _letters()[codes]
    keep = np.append(True, (low[1:] != 0) | (low[:-1] != 0))
    low = low[keep].astype(np.uint64)
    starts = np.concatenate(([0], np.cumsum(keep)))[starts]  # in what is kept
    if len(low) < 3:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    grams = (low[:-2] << np.uint64(42)) | (low[1:-1] << np.uint64(21)) | low[2:]
    inside = low[1:-1] != 0
    before = np.concatenate(([0], np.cumsum(inside)))
    return grams[inside], before[np.clip(starts - 1, 0, len(inside))]


def slots(grams: np.ndarray) -> list[np.ndarray]:
    """The ``PROBES`` slots of each trigram, by multiplicative hashing."""
    found = []
    for k in range(1, PROBES + 1):
        odd = np.uint64((0x9E3779B97F4A7C15 * k * k | 1) & 0xFFFFFFFFFFFFFFFF)  # golden ratio, spread
        mixed = (grams ^ (grams >> np.uint64(29))) * odd
        mixed = (mixed ^ (mixed >> np.uint64(32))) * odd
        found.append((mixed >> np.uint64(64 - SLOT_BITS)).astype(np.int64))
    return found


@dataclass
class Model:
    languages: list[str]  # most frequent first
    masks: np.ndarray  # a bitmask of languages per slot; with more than 64, a row of slots for each 64 languages

    def words(self) -> np.ndarray:
        return np.atleast_2d(self.masks)

    def false_positives(self) -> np.ndarray:
        words, bit = self.words(), self.masks.dtype.type
        fill = [np.count_nonzero(words[k // WORD] & bit(1 << k % WORD)) / words.shape[1] for k in range(len(self.languages))]
        return np.array(fill) ** PROBES

    def evidence(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per text and language the corrected number of its trigrams, and each text's trigrams."""
        counts = np.zeros((len(texts), len(self.languages)))
        total = np.zeros(len(texts))
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) < CHARS):
                size += len(texts[end])
                end += 1
            grams, begins = trigrams(texts[at:end])
            first, *others = slots(grams)
            for word, masks in enumerate(self.words()):
                mask = masks[first]
                for slot in others:
                    mask &= masks[slot]
                for k in range(word * WORD, min((word + 1) * WORD, len(self.languages))):
                    hits = np.concatenate(([0], np.cumsum((mask >> k % WORD) & 1, dtype=np.int64)))[begins]
                    counts[at:end, k] = hits[1:] - hits[:-1]
            total[at:end] = begins[1:] - begins[:-1]
            at = end
        wrong = self.false_positives()
        return np.clip((counts - total[:, None] * wrong) / np.maximum(1 - wrong, 1e-9), 0, None), total


def _remainder(id_column: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(5))


def fit(docs: DataFrame, sample_docs: int = 2000, min_count: int = 3, share: float = 0.34) -> Model:
    """Fits on rows with text and language whose crc32(doc_id) mod 5 is not 0; null ids are left out.

    ``sample_docs``: documents per language, those whose id hashes smallest. ``share``: a language
    contains a trigram if its share there is at least this part of the largest share anywhere.
    """
    labelled = docs.filter((_remainder() != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # Ids in the order of their hash, cut into slices: the sample lies in a language's first slices,
    # so only those are ranked, whatever the number of its documents.
    spread = F.xxhash64("doc_id")
    piece = F.shiftright(spread, 64 - SLICE_BITS)
    sizes = stored(labelled.groupBy("lang", piece.alias("slice")).agg(F.count(F.lit(1)).alias("n")), "languages")
    total = F.sum("n").alias("n")
    found = sizes.groupBy("lang").agg(total).orderBy(F.desc("n"), "lang").collect()
    languages = [r["lang"] for r in found]
    if not languages:
        return Model([], np.zeros(1 << SLOT_BITS, np.uint8))
    numbers = {lang: k for k, lang in enumerate(languages)}
    before = F.sum("n").over(W.partitionBy("lang").orderBy("slice")) - F.col("n")
    # One row per language each: the last slice that holds a part of its sample, and the sample's last hash.
    last = sizes.withColumn("before", before).filter(F.col("before") < sample_docs).groupBy("lang").agg(F.max("slice").alias("last"))
    nth = F.row_number().over(W.partitionBy("lang").orderBy("spread", "doc_id"))
    reach = (
        labelled.select("doc_id", "lang", spread.alias("spread"), piece.alias("slice"))
        .join(F.broadcast(last), "lang").filter(F.col("slice") <= F.col("last"))
        .withColumn("nth", nth).filter(F.col("nth") <= sample_docs).groupBy("lang").agg(F.max("spread").alias("reach"))
    )
    sample = labelled.select("lang", "text", spread.alias("spread")).join(F.broadcast(reach), "lang").filter("spread <= reach")

    def count(batches):
        for batch in batches:
            langs = np.array([numbers[x] for x in batch.column(0).to_pylist()], np.int64)
            texts = batch.column(1).to_pylist()
            for k in np.unique(langs):
                grams, n = np.unique(trigrams([texts[i] for i in np.flatnonzero(langs == k)])[0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(grams), k, np.int32)), pa.array(grams.view(np.int64)), pa.array(n.astype(np.int64))],
                    ["lang", "gram", "n"],
                )

    counts = sample.select("lang", "text").mapInArrow(count, "lang int, gram long, n long")
    counts = counts.groupBy("gram", "lang").agg(F.sum("n").alias("n"))
    part = F.col("n") / F.sum("n").over(W.partitionBy("lang"))
    top = F.max("part").over(W.partitionBy("gram"))
    profile = counts.withColumn("part", part).withColumn("top", top).filter(
        (F.col("n") >= min_count) & (F.col("part") >= F.col("top") * share)
    )

    def insert(batches):
        for batch in batches:
            langs = batch.column(0).to_numpy()
            words = pa.array((langs // WORD).astype(np.int32))
            bits = np.left_shift(np.int64(1), (langs % WORD).astype(np.int64))
            grams = batch.column(1).to_numpy().view(np.uint64)
            for slot in slots(grams):
                yield pa.RecordBatch.from_arrays([words, pa.array(slot), pa.array(bits)], ["word", "slot", "mask"])

    filled = (
        profile.select("lang", "gram").mapInArrow(insert, "word int, slot long, mask long")
        .groupBy("word", "slot").agg(F.bit_or("mask").alias("mask")).toPandas()  # at most one row per word and slot
    )
    width = next(t for t, n in ((np.uint8, 8), (np.uint16, 16), (np.uint32, 32), (np.uint64, WORD)) if min(len(languages), WORD) <= n)
    masks = np.zeros((-(-len(languages) // WORD), 1 << SLOT_BITS), width)
    masks[filled["word"].to_numpy(), filled["slot"].to_numpy()] = filled["mask"].to_numpy().view(np.uint64).astype(width)
    return Model(languages, masks)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (the winner's part of all evidence) and ``coverage``
    (the part of the text's trigrams that the winner contains).

    ``und`` with score 0 where the text is null or has no letter, or no language was learned. A
    text with letters but without known trigrams gets the most frequent language, score 0. Ties go
    to the more frequent language. Other columns travel along; the result columns replace theirs.
    """
    kept = docs.drop("lang_pred", "score", "coverage")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**18 masks for each 64 languages

    def run(batches):
        learned = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            evidence, total = learned.evidence(texts) if learned.languages else (np.zeros((len(texts), 1)), np.zeros(len(texts)))
            best = evidence.argmax(axis=1)
            most = evidence[np.arange(len(texts)), best]
            score = most / np.maximum(evidence.sum(axis=1), 1e-12)
            names = [learned.languages[k] if n else UNDETERMINED for k, n in zip(best, total)]
            known = total > 0
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names), pa.array(np.where(known, score, 0.0)), pa.array(np.clip(most / np.maximum(total, 1), 0, 1))],
                [*batch.schema.names, "lang_pred", "score", "coverage"],
            )

    from pyspark.sql import types as T

    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("coverage", T.DoubleType())]
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *added]))


def held_out() -> Column:
    """Whether a row is kept out of the fit; false for a null id."""
    return F.coalesce(_remainder() == 0, F.lit(False))


def keep_identified(docs: DataFrame, model: Model) -> DataFrame:
    """The documents for which ``identify`` names a language: all but those it calls ``und``."""
    return identify(docs, model).filter(F.col("lang_pred") != UNDETERMINED).select(*docs.columns)
