"""Helpers shared by the operators: tables, saved intermediates, word splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratinglens.session import scratch_dir

# White space between words: space and U+0009 to U+000D (what bytes.split() uses).
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: cuts the
    lineage, and a lost executor costs no recomputation of earlier steps."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def quoted(name: str) -> str:
    """A column's name as it can be selected, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text; null: empty."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def id_crc(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id counts
    as the empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % modulus
