"""Documents to training tokens: the stages, each written and read again by the next."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import language, lines, mixing, pieces, simhash
from eventloom.llm.common import stored, table, working_folder


DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def _keeps_columns(stage):
    """Columns beyond those of documents pass a stage as one, so none is taken for an operator's own."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        extra = [c for c in docs.columns if c not in DOCUMENT]
        if not extra:
            return stage(spark, docs, sf_dir)
        own = [c for c in docs.columns if c in DOCUMENT]
        out = stage(spark, docs.select(*own, F.struct(*extra).alias("_loom_extra")), sf_dir)
        return out.select(*[F.col(c) if c in own else F.col("_loom_extra")[c].alias(c) for c in docs.columns])

    return run_stage


@_keeps_columns
def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that language identification calls undetermined: those without a letter."""
    return language.keep_identified(docs, language.fit(docs))


@_keeps_columns
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines of at least five documents stay only in the one with the largest id."""
    shorter = lines.dedup_lines(docs).select(*docs.columns)
    return shorter.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


@_keeps_columns
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near duplicates stays, the one with the smallest id."""
    return simhash.keep_one(docs)


@_keeps_columns
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target weight takes it."""
    return mixing.emit(mixing.mix(docs)).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the best segmentation, and the next best as edits of it."""
    return pieces.encode(docs)


STAGES = [
    ("language_id", identify_languages),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("mix_sources", mix),
    ("sentencepiece", encode),
]

# Language identification and SimHash have no SQL form; run()'s rows are tested against a brute-force pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage's result is written; what it stored on the way is removed after that."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with working_folder(spark, name):
            docs = stored(stage(spark, docs, sf_dir), name, folder="llm")
    return docs
