"""Delimited-text ingest in the master-data format: ``,`` separated, one
header line per file, no quoting, ``\\N`` for NULL, declared schema.

Field semantics follow delimited Hive tables exactly: an empty text field is
the empty string (not NULL), ``\\N`` is NULL, a number that does not parse
(or is empty) is NULL, missing trailing fields are NULL and extra fields are
dropped. Each line is read as one column (the CSV source still skips every
file's header line) and split with built-in string functions, all JVM-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ratinglens.schemas import PLAYERS, PLAYERS_RAW, RATINGS

NULL_TOKEN = "\\N"


# A separator that cannot occur in the text: every line is one field.
_WHOLE_LINE = "\u0000"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(line) of every file, without its header line."""
    lines = (
        spark.read.schema("line string")
        .option("header", True)
        .option("sep", _WHOLE_LINE)
        .option("quote", "")
        .option("nullValue", _WHOLE_LINE)
        .csv(path)
    )
    return lines.filter(F.col("line").isNotNull())


# What an audit finds in a line.
BAD_NUMBER, MISSING_FIELDS, EXTRA_FIELDS = "bad_number", "missing_fields", "extra_fields"


def audit_delimited(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """(line, reasons, columns) of the lines of master-data text that do not
    fit ``schema`` and are read in part all the same: ``bad_number`` (text that
    is neither a number, nor empty, nor the NULL token; ``columns`` names
    them), ``missing_fields``, ``extra_fields``. One pass, no shuffle."""
    fields = F.split(F.col("line"), ",", -1)
    wrong = []
    for i, f in enumerate(schema.fields):
        if not isinstance(f.dataType, StringType):
            raw = F.get(fields, i)
            given = raw.isNotNull() & ~raw.isin(NULL_TOKEN, "")
            wrong.append(F.when(given & raw.try_cast(f.dataType).isNull(), F.lit(f.name)))
    columns = F.array_compact(F.array(*wrong)) if wrong else F.array().cast("array<string>")
    found = F.array(
        F.when(F.size(columns) > 0, BAD_NUMBER),
        F.when(F.size(fields) < len(schema.fields), MISSING_FIELDS),
        F.when(F.size(fields) > len(schema.fields), EXTRA_FIELDS),
    )
    lines = _lines(spark, path).select("line", F.array_compact(found).alias("reasons"), columns.alias("columns"))
    return lines.filter(F.size("reasons") > 0)


def audit_counts(audit: DataFrame) -> DataFrame:
    """(reason, n_lines) of an audit."""
    return audit.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n_lines"))


def read_delimited(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Master-data text (unquoted) → typed columns with Hive field rules."""
    fields = F.split(F.col("line"), ",", -1)
    cols = []
    for i, f in enumerate(schema.fields):
        raw = F.get(fields, i)
        value = F.when(raw != F.lit(NULL_TOKEN), raw)
        if not isinstance(f.dataType, StringType):
            value = value.try_cast(f.dataType)
        cols.append(value.alias(f.name))
    return _lines(spark, path).select(*cols)


def read_quoted_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Standard CSV with ``"`` quoting and doubled ``""`` inside a quoted
    field (the delivered raw player file). As in unquoted text, an empty text
    field is the empty string and ``\\N`` is NULL."""
    raw = (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", ",")
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    # The reader gives NULL for an empty field and leaves the token as text.
    text = [f.name for f in schema.fields if isinstance(f.dataType, StringType)]
    given = {c: F.when(F.coalesce(c, F.lit("")) != NULL_TOKEN, F.coalesce(c, F.lit(""))) for c in text}
    return raw.withColumns(given)


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Monthly ratings fact from delimited text."""
    return read_delimited(spark, path, RATINGS)


def read_players(spark: SparkSession, path: str) -> DataFrame:
    """Player dimension (name already split) from delimited text."""
    return read_delimited(spark, path, PLAYERS)


def read_players_raw(spark: SparkSession, path: str) -> DataFrame:
    """Player file as delivered, with a quoted ``"Last, First"`` field."""
    return read_quoted_csv(spark, path, PLAYERS_RAW)


def split_name(name="name"):
    """``"Last, First"`` → (last_name, first_name). The first comma (and one
    space after it) separates the parts; a name without a comma gives a NULL
    first name; further commas stay inside the first name."""
    c = F.col(name) if isinstance(name, str) else name
    parts = F.split(c, ", ?", 2)
    return F.get(parts, 0), F.get(parts, 1)


def normalise_players(raw: DataFrame) -> DataFrame:
    """Raw players → player dimension with separate last and first names."""
    last, first = split_name("name")
    return raw.select(
        "fide_id",
        last.alias("last_name"),
        first.alias("first_name"),
        "federation",
        "gender",
        "title",
        "yob",
    )


def name_quality(raw: DataFrame) -> DataFrame:
    """Count raw names by shape: one comma (ok), none, several, NULL."""
    commas = F.size(F.split(F.coalesce(F.col("name"), F.lit("")), ",")) - 1
    shape = (
        F.when(F.col("name").isNull(), "null")
        .when(commas == 1, "ok")
        .when(commas == 0, "no_comma")
        .otherwise("extra_comma")
    )
    return raw.groupBy(shape.alias("shape")).agg(F.count(F.lit(1)).alias("n_rows"))


def write_delimited(df: DataFrame, path: str) -> None:
    """Write in the master-data text format (header, ``,``, ``\\N``, no quoting).
    The format cannot carry a ``,`` inside a field; such rows would shift."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("sep", ",")
        .option("quote", "")
        .option("nullValue", NULL_TOKEN)
        .option("emptyValue", "")
        .csv(path)
    )


def write_lines(lines: DataFrame, path: str, header: str) -> None:
    """Lines (column ``line``) as text files, each under the header line."""
    named = lines.select(F.col("line").alias(header))
    (
        named.write.mode("overwrite")
        .option("header", True)
        .option("sep", _WHOLE_LINE)
        .option("quote", "")
        .option("emptyValue", "")
        .csv(path)
    )


def write_players_raw(players: DataFrame, path: str) -> None:
    """Inverse of :func:`normalise_players`: one quoted ``"Last, First"`` field."""
    write_raw(players.select(
        "fide_id",
        F.concat(F.col("last_name"), F.lit(", "), F.col("first_name")).alias("name"),
        "federation",
        "gender",
        "title",
        "yob",
    ), path)


def write_raw(raw: DataFrame, path: str) -> None:
    """Raw player rows as standard CSV with a quoted name."""
    (
        raw.write.mode("overwrite")
        .option("header", True)
        .option("sep", ",")
        .option("quote", '"')
        .option("escape", '"')
        .option("quoteAll", False)
        .option("nullValue", NULL_TOKEN)
        .option("emptyValue", "")
        .csv(path)
    )


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Idempotent materialisation: re-running replaces the whole table (every
    partition, also those absent from the new data), never appends."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
