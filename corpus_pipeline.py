"""From raw documents to token ids: quality rules, near-duplicates, repeated
passages, source mixing, encoding.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; ``run`` writes each stage's rows as Parquet in the shared folder and
reads them back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratinglens.llm import bpe, mixing, passages, quality, simhash
from ratinglens.llm.common import quoted, saved, table
from ratinglens.llm.queries import tokenizer_path


def _with_text(found: DataFrame, columns: list[str], text, changed) -> DataFrame:
    """``columns`` with a new text where it changed, and its length."""
    new = {"text": F.when(changed, text).otherwise(F.col("text"))}
    if "n_chars" in columns:
        new["n_chars"] = F.when(changed, F.length(text).cast("long")).otherwise(F.col("n_chars"))
    return found.withColumns(new).select([quoted(c) for c in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without the lines that fail."""
    judged = quality.clean_lines(docs).where("_quality.kept")
    return _with_text(judged, docs.columns, F.col("_quality.clean_text"), F.col("_quality.lines_failed") > 0)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that repeat."""
    cut = passages.remove_repeats(docs)
    if "n_chars" in docs.columns:
        length = F.length("text").cast("long")
        cut = cut.withColumn("n_chars", F.when(F.col("_removed") > 0, length).otherwise(F.col("n_chars")))
    return cut.select([quoted(c) for c in docs.columns])


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as their source's weight asks for, in the order
    of the mix: by epoch, blocks of all sources at random, documents at random
    within a block."""
    mixed = mixing.mix(docs).withColumns({"_mix_epoch": F.col("_mix.epoch"), "_mix_order": F.col("_mix.order")})
    ordered = mixed.repartitionByRange("_mix_epoch", "_mix_order").sortWithinPartitions("_mix_epoch", "_mix_order")
    return ordered.select([quoted(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and their decoded text, per document."""
    return bpe.round_trip(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("encode", encode),
]

#: No SQL can express the encoder; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
