"""The corpus pipeline: language ID, line dedup, near dedup, benchmark decontamination, packing.

Each stage reads the Parquet the one before it wrote, so that a lost executor never reaches back beyond a stage. All
but the last return the columns of `documents` that they are given; other columns are left behind.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import decontamination, language_id, line_dedup, near_dedup, packing
from rollcall.llm.shared import Scratch, only, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A text whose best language is less probable than this is rejected, like one without any letter.
MIN_LANGUAGE_SCORE = 0.3


def _held(docs: DataFrame) -> list[str]:
    return [c for c in COLUMNS if c in docs.columns]


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language learnt from the labelled ones."""
    model = language_id.train(language_id.learning_rows(docs))
    return language_id.accepted(docs, model, _held(docs), MIN_LANGUAGE_SCORE)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that at least three hold, but for the last holder; n_chars counts what is left."""
    index = line_dedup.LineIndex.build(docs)
    kept = line_dedup.without_repeated_lines(docs, index, _held(docs)).drop("n_lines", "n_dropped")
    if "n_chars" in kept.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document, the one with the smallest id (null last), then the smallest digest
    of its text. A document is a doc_id with a text: equal rows count once, rows that share an id but differ in text are
    judged each by its own text, and so are rows with a null id. Texts without words are in no group."""
    scratch = Scratch(spark)
    found = near_dedup.components(docs).where("component is not null").select("doc_id", "key", "component")
    found = scratch.put(found, "found")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")
    best = found.groupBy("component").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("n")).where("n > 1")
    best = scratch.put(best.select("component", "best"), "best")
    gone = found.join(best, "component").where(~order.eqNullSafe(F.col("best")))
    gone = gone.select(F.col("doc_id").alias("of_doc"), F.col("key").alias("of_key")).distinct()
    docs = only(docs, *_held(docs)).withColumn("key", near_dedup.text_key())
    same = docs["doc_id"].eqNullSafe(gone["of_doc"]) & (docs["key"] == gone["of_key"])
    return docs.join(gone.hint("merge"), same, "left_anti").dropDuplicates(["doc_id", "key"]).drop("key")


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    held = _held(docs)
    found = decontamination.contaminated_spans(docs, table(spark, sf_dir, "benchmark"), columns=held)
    return found.where(F.size("spans") == 0).select(*held)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of several context sizes."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", in_a_language),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", one_of_each_group),
    ("decontamination", clean_of_benchmarks),
    ("packing", packed),
]

#: Language ID, near dedup of what it leaves, and packing have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage wrote is deleted once the next has read it."""
    scratch = Scratch(spark)
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = scratch.put(stage(spark, docs, sf_dir), name)
        if before is not None:
            scratch.drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
