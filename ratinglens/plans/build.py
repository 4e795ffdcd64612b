"""Batch-layer job and the lazy model the serving queries run on.

``build_views`` writes each input once, joins all rating rows with the players
and writes the joined table (partitioned by year); a per-player-year rollup from
which the yearly, federation and count views follow is made from its files, the
keyed history view (one row per player-month) and the current ratings from the
keyed fact; of a fact that is unique the history is the joined table's own rows,
and no second join is made. Views that do not need each other are written at the
same time. Each view's lineage starts at
a file scan in the shared folder, so a lost executor re-reads files instead of
recomputing the join; nothing is kept on executors' disks. Rows that cannot be
keyed are written next to the views (``rejects``).

Each view is sorted *within* its write tasks (no shuffle) by the column its
lookups filter on, so Parquet row-group statistics let an id or name-prefix
lookup skip almost every row group of a file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratinglens.operators import batch, serving
from ratinglens.schemas import JOINED_COLS
from ratinglens.session import at_once
from ratinglens.sources import tables
from ratinglens.sources.delimited import write_table
from ratinglens.streaming import speed


@dataclass
class Model:
    """Lazy DataFrames of the rating model over one set of input tables.

    ``players`` has one row per fide_id (``batch.clean_players``);
    ``unique_ratings`` says that ``ratings`` has one row per player-month by
    construction."""

    players: DataFrame
    ratings: DataFrame
    submissions: DataFrame
    unique_ratings: bool = False

    @property
    def joined(self) -> DataFrame:
        return batch.players_and_ratings(self.players, self.ratings)

    @property
    def history(self) -> DataFrame:
        keyed = batch.keyed_ratings(self.ratings, self.unique_ratings)
        return batch.history_view(batch.players_and_ratings(self.players, keyed))

    @property
    def id_name(self) -> DataFrame:
        return batch.id_name_view(self.players)

    @property
    def by_year(self) -> DataFrame:
        return batch.ratings_by_year(self.joined)

    @property
    def fed_by_year(self) -> DataFrame:
        return batch.ratings_by_federation_year(self.joined)

    @property
    def batch_counts(self) -> DataFrame:
        return batch.rating_counts(self.joined)

    @property
    def speed(self) -> DataFrame:
        """Speed-layer state computed as a batch over the submission log."""
        return speed.speed_state(self.submissions)

    @property
    def live(self) -> DataFrame:
        return speed.live_view(self.speed)

    @property
    def stream_counts(self) -> DataFrame:
        return speed.stream_counts(self.speed)

    @property
    def merged_counts(self) -> DataFrame:
        return serving.games_count_merged(self.batch_counts, self.stream_counts)

    @property
    def counts(self) -> DataFrame:
        return serving.serving_counts(self.merged_counts)


def model_from_tables(spark: SparkSession, sf_dir: str) -> Model:
    return Model(
        players=tables.players_from_tables(spark, sf_dir),
        ratings=tables.ratings_from_tables(spark, sf_dir),
        submissions=tables.submissions_from_tables(spark, sf_dir),
        unique_ratings=True,  # grouped by customer, year and month
    )


VIEW_NAMES = (
    "players_and_ratings",
    "history",
    "id_name",
    "by_year",
    "fed_by_year",
    "id_count",
    "current_rating",
)


# Views keyed by player: bucketed on fide_id when buckets are requested.
PLAYER_KEYED = ("players_and_ratings", "history", "by_year", "id_count", "current_rating")


def view_paths(root: str) -> dict[str, str]:
    """Where each view lives."""
    return {name: f"{root.rstrip('/')}/{name}" for name in VIEW_NAMES}


def reject_paths(root: str) -> dict[str, str]:
    """Where the rows that no view can key are written."""
    return {name: f"{root.rstrip('/')}/rejects/{name}" for name in ("players", "ratings")}


def build_views(
    spark: SparkSession,
    players: DataFrame,
    ratings: DataFrame,
    dst: str,
    buckets: int | None = None,
    table_prefix: str = "",
    unique_ratings: bool = False,
) -> dict[str, str]:
    """Batch layer: inputs → joined table → every batch view, and the rejects.

    Returns the path of each written view. Re-running replaces the views. The
    inputs are computed once and written to ``<dst>/_inputs``: parsing text, or
    the group-by behind a derived fact, is not repeated for the rejects, the
    join and the keyed fact. ``unique_ratings``: see ``batch.keyed_ratings``.

    With ``buckets``, the player-keyed views are also catalog tables
    ``<table_prefix><name>`` bucketed and sorted on fide_id (files stay at the
    returned paths), so joins between them and aggregations by player read
    co-located buckets instead of shuffling the largest view."""
    dst = dst.rstrip("/")
    paths = view_paths(dst)
    def put(df: DataFrame, name: str, order: list[str], partition_by: list[str] | None = None) -> None:
        if buckets and name in PLAYER_KEYED:
            writer = (
                df.write.mode("overwrite")
                .option("partitionOverwriteMode", "static")
                .option("path", paths[name])
            )
            if partition_by:
                writer = writer.partitionBy(*partition_by)
            writer.bucketBy(buckets, "fide_id").sortBy(*order).saveAsTable(table_prefix + name)
            return
        # The partitioned writer needs its input ordered by the partition
        # columns first; leading with them keeps the lookup order inside.
        keys = list(partition_by or []) + order
        write_table(df.sortWithinPartitions(*keys), paths[name], partition_by)

    def together(df: DataFrame) -> DataFrame:
        # One year per write task, so few files; AQE splits the years that
        # are large (a rebalance may divide a key) and joins small ones.
        return df if buckets else df.hint("rebalance", "year")

    def once(df: DataFrame, name: str) -> DataFrame:
        write_table(df, f"{dst}/_inputs/{name}")
        return spark.read.schema(df.schema).parquet(f"{dst}/_inputs/{name}")

    rejects = reject_paths(dst)
    players, ratings = at_once(spark, lambda: once(players, "players"), lambda: once(ratings, "ratings"))
    known = once(batch.clean_players(players), "known_players")
    keyed = batch.keyed_ratings(ratings, unique_ratings)
    *_, keyed = at_once(
        spark,
        lambda: put(together(batch.players_and_ratings(known, ratings)), "players_and_ratings", ["fide_id", "month"], ["year"]),
        lambda: write_table(batch.rejected_players(players, known), rejects["players"]),
        lambda: write_table(batch.rejected_ratings(ratings), rejects["ratings"]),
        lambda: put(batch.id_name_view(known), "id_name", ["first_name", "last_name"]),
        lambda: keyed if unique_ratings else once(keyed, "keyed_ratings"),
    )
    joined = (
        spark.table(table_prefix + "players_and_ratings")
        if buckets
        else spark.read.parquet(paths["players_and_ratings"])
    )
    if unique_ratings:  # files of one year each: they need not be brought together
        history = batch.history_view(batch.keyed_ratings(joined, True))
    else:
        history = together(batch.history_view(batch.players_and_ratings(known, keyed)))

    # One pass over the joined table; three views from the small rollup.
    rollup_path = f"{dst}/_year_rollup"
    at_once(
        spark,
        lambda: put(history, "history", ["fide_id", "month"], ["year"]),
        lambda: write_table(batch.year_rollup(joined), rollup_path),
        lambda: put(batch.current_rating(keyed), "current_rating", ["fide_id"]),
    )
    rollup = spark.read.parquet(rollup_path)
    at_once(
        spark,
        lambda: put(batch.ratings_by_year_from_rollup(rollup), "by_year", ["fide_id", "year"]),
        lambda: put(batch.ratings_by_federation_year_from_rollup(rollup), "fed_by_year", ["federation", "year"]),
        lambda: put(batch.rating_counts_from_rollup(rollup), "id_count", ["fide_id"]),
    )
    return paths


def read_views(
    spark: SparkSession, paths: dict[str, str], table_prefix: str | None = None
) -> dict[str, DataFrame]:
    """The views as DataFrames; with ``table_prefix`` the bucketed catalog
    tables are used for the player-keyed views."""

    def load(name: str) -> DataFrame:
        if table_prefix is not None and name in PLAYER_KEYED:
            return spark.table(table_prefix + name)
        return spark.read.parquet(paths[name])

    views = {name: load(name) for name in paths}
    # The partition column comes last from the files, as an int.
    for name, first in (("players_and_ratings", []), ("history", ["row_key"])):
        typed = views[name].withColumn("year", F.col("year").cast("bigint"))
        views[name] = typed.select(*first, *JOINED_COLS)
    return views


# ----------------------------------------------------------------- publishing
#
# <dst>/build=<id>/<view>   the views of one build (never rewritten once
#                           published; use a new id per run)
# <dst>/published/          one appended row per finished build; the append
#                           becomes visible only when its job commits, so a
#                           reader never picks a build whose views are still
#                           being written.


def publish_build(
    spark: SparkSession,
    players: DataFrame,
    ratings: DataFrame,
    dst: str,
    build_id: int,
    buckets: int | None = None,
    table_prefix: str = "",
    unique_ratings: bool = False,
) -> dict[str, str]:
    """Build every view into a new folder, then publish it."""
    dst = dst.rstrip("/")
    paths = build_views(spark, players, ratings, f"{dst}/build={int(build_id)}", buckets, table_prefix, unique_ratings)
    record = spark.createDataFrame([(int(build_id),)], "build_id long")
    record.write.mode("append").parquet(f"{dst}/published")
    return paths


def current_build(spark: SparkSession, dst: str) -> int | None:
    """Newest published build id (a one-row aggregate), or None."""
    from pyspark.errors import AnalysisException

    try:
        row = spark.read.parquet(f"{dst.rstrip('/')}/published").agg(F.max("build_id").alias("b")).first()
    except AnalysisException:
        return None
    return None if row is None or row.b is None else int(row.b)


def published_paths(spark: SparkSession, dst: str) -> dict[str, str]:
    """View paths of the newest published build."""
    build_id = current_build(spark, dst)
    if build_id is None:
        raise FileNotFoundError(f"no published build under {dst}")
    return view_paths(f"{dst.rstrip('/')}/build={build_id}")
