"""Bind the driver's parquet tables to the rating model.

* players      ← customer ⟕ nation   (one row per customer key)
* ratings      ← orders grouped by (customer, year, month); the best order
                 total of the month, scaled to a rating, per priority class
* submissions  ← events (one rating report per event, ordered by (ts, seq))

All three are lazy DataFrames; filters and projections placed on top of them
reach the parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratinglens.sources.store import folder_names

# Fixed values of the binding (priority classes → discipline).
STANDARD_PRIORITIES = ["1-URGENT", "2-HIGH"]
RAPID_PRIORITIES = ["3-MEDIUM"]
BLITZ_PRIORITIES = ["4-NOT SPECIFIED", "5-LOW"]
RATING_SCALE = 100.0  # order total / 100 → a rating in the thousands


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def stream_table(spark: SparkSession, sf_dir: str, name: str, **options: str) -> DataFrame:
    """A table as a file stream, whether it is one file or a folder of files."""
    path = table_path(sf_dir, name)
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    if f"{name}.parquet" in folder_names(spark, sf_dir):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir.rstrip("/"))


def players_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer ⟕ nation → players (fide_id, last_name, first_name,
    federation, gender, title, yob). c_custkey is the table's key, so the
    result is unique on fide_id. nation is a small file, so the planner's
    size check broadcasts it."""
    return players_of(load(spark, sf_dir, "customer"), load(spark, sf_dir, "nation"))


def members_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The players with a balance that is not negative: not everyone who has
    ratings or submissions is a member."""
    c = load(spark, sf_dir, "customer").filter("c_acctbal >= 0")
    return players_of(c, load(spark, sf_dir, "nation"))


def raw_players_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer → raw player rows as delivered, whose names come in every
    shape: "Last, First", with a suffix, without a first name, and missing."""
    c = load(spark, sf_dir, "customer")
    last, first = (F.get(F.split("c_name", "#"), i) for i in (0, 1))
    both = F.concat(last, F.lit(", "), first)
    name = (
        F.when(F.col("c_acctbal") < 0, last)
        .when(F.col("c_acctbal") > 9000, F.concat(both, F.lit(", Jr.")))
        .when(~F.col("c_acctbal").between(0, 100), both)
    )
    return c.select(
        F.col("c_custkey").cast("string").alias("fide_id"),
        name.alias("name"),
        F.lit("").alias("federation"),
        F.lit(None).cast("string").alias("gender"),
        F.col("c_mktsegment").alias("title"),
        F.lit(None).cast("bigint").alias("yob"),
    )


def players_of(customer: DataFrame, nation: DataFrame) -> DataFrame:
    c = customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = nation.select("n_nationkey", "n_name")
    name_parts = F.split(F.col("c_name"), "#")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_custkey").cast("string").alias("fide_id"),
        F.get(name_parts, 0).alias("last_name"),
        F.get(name_parts, 1).alias("first_name"),
        F.col("n_name").alias("federation"),
        F.lit(None).cast("string").alias("gender"),
        F.col("c_mktsegment").alias("title"),
        F.lit(None).cast("bigint").alias("yob"),
    )


def _rating_when(priorities: list[str]):
    rating = (F.col("o_totalprice") / F.lit(RATING_SCALE)).cast("bigint")
    return F.when(F.col("o_orderpriority").isin(priorities), rating)


def ratings_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders → monthly ratings fact, unique on (fide_id, year, month).

    A hash aggregate with map-side partial aggregation: a customer holding a
    large share of all orders is combined before the shuffle, so no task ever
    receives more than one partial row per (player, month) per map task."""
    o = load(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority"
    )
    monthly = o.groupBy(
        "o_custkey",
        F.year("o_orderdate").cast("bigint").alias("year"),
        F.month("o_orderdate").cast("bigint").alias("month"),
    ).agg(
        F.max(_rating_when(STANDARD_PRIORITIES)).alias("rating_standard"),
        F.max(_rating_when(RAPID_PRIORITIES)).alias("rating_rapid"),
        F.max(_rating_when(BLITZ_PRIORITIES)).alias("rating_blitz"),
    )
    # Group on the 8-byte key; the string id is derived after the shuffle.
    return monthly.select(
        F.col("o_custkey").cast("string").alias("fide_id"),
        "year",
        "month",
        "rating_standard",
        "rating_rapid",
        "rating_blitz",
    )


def submissions_from_events(events: DataFrame) -> DataFrame:
    """events (batch or stream) → rating reports with their arrival order.

    Reports carry strings, as on the wire; ``ts``/``seq`` give the order in
    which they arrived (a Kafka source gives timestamp/partition/offset)."""
    fide_id = F.col("user_id").cast("string")
    scaled = lambda k: (F.col("value") * F.lit(k)).cast("bigint").cast("string")
    return events.select(
        fide_id.alias("fide_id"),
        F.lpad(fide_id, 9, "0").alias("first_name"),
        F.lit("Customer").alias("last_name"),
        scaled(10.0).alias("rating_standard"),
        scaled(9.0).alias("rating_rapid"),
        scaled(8.0).alias("rating_blitz"),
        F.col("ts"),
        F.col("event_id").alias("seq"),
    )


def submissions_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    return submissions_from_events(ev)
