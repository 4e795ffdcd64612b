"""Batch layer: the join of players with ratings and the views built on it.

Plan notes (what each operator costs at scale):

* ``players_and_ratings`` — one equi-join on ``fide_id`` of all rating rows: a
  sort-merge join shuffles both sides on ``fide_id``, and AQE's skew-join split
  divides a player that holds a large share of all rows. Joins by player ask
  for it (``by_player``): the planner's size check goes by the compressed
  files, of which 4 MB are some 200 MB of rows that pass through the driver.
* ``keyed_ratings`` — what a keyed upsert keeps: one row per player-month, found
  on the numeric fact before players are joined. Only the history view is
  keyed; joins, averages and counts are over all rows.
* ``ratings_by_year`` / ``rating_counts`` group by keys that start with
  ``fide_id``; placed over a sort-merge join they reuse its partitioning and
  add no exchange. Otherwise they shuffle once, after map-side partial
  aggregation.
* ``ratings_by_federation_year`` has a handful of groups per year; partial
  aggregation shrinks the shuffle to (map tasks × groups) rows.
* Keys are added *after* the aggregation: grouping by a derived ``concat`` key
  would make the planner shuffle and hash on the string.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratinglens.functions.scalar import fed_year_key, history_key, name_key, player_year_key
from ratinglens.schemas import JOINED_COLS, PLAYER_DIMS, RATING_COLS


def dedup_by_key(df: DataFrame, key_cols: list[str]) -> DataFrame:
    """Keep one row per key, whatever the input order: the greatest in the
    order of its value columns, NULL below any value (equal rows are
    interchangeable).

    An aggregate with map-side partial aggregation, not a window, so a key
    with many duplicates is reduced before the shuffle."""
    values = [c for c in df.columns if c not in key_cols]
    if not values:
        return df.dropDuplicates(key_cols)
    best = df.groupBy(*key_cols).agg(F.max(F.struct(*values)).alias("_row"))
    return best.select(*key_cols, *[F.col(f"_row.{c}").alias(c) for c in values])


def _keyed():
    """Whether a rating row can be keyed: id, year, and a month of the year."""
    complete = F.col("fide_id").isNotNull() & F.col("year").isNotNull()
    return complete & F.coalesce(F.col("month").between(1, 12), F.lit(False))


def keyed_ratings(ratings: DataFrame, unique: bool = False) -> DataFrame:
    """One row per (fide_id, year, month) of the rows that have such a key —
    what the keyed history view holds after an upsert load.

    Meant for the ratings fact, before any join: its rows are an id and
    numbers, so little is shuffled, and joining players afterwards (one row
    per id) gives the same history as keying the joined rows would.
    ``unique`` says that the fact has one row per key by construction (for
    example the result of a group-by on it): then only the filter is left and
    nothing is shuffled or sorted."""
    rows = ratings.filter(_keyed())
    return rows if unique else dedup_by_key(rows, ["fide_id", "year", "month"]).select(*ratings.columns)


def by_player(side: DataFrame) -> DataFrame:
    """A side of a join that has a row per player: never broadcast, as it grows
    with the players."""
    return side.hint("merge")


def clean_players(players: DataFrame) -> DataFrame:
    """Players with a key, one row per fide_id."""
    return dedup_by_key(players.filter(F.col("fide_id").isNotNull()), ["fide_id"])


def rejected_ratings(ratings: DataFrame) -> DataFrame:
    """Rating rows that the history view cannot key (NULL id, year or month,
    or a month outside 1–12). They still count in joins and averages."""
    return ratings.filter(~_keyed())


def rejected_players(players: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Player rows that ``clean_players`` leaves out: without an id, or
    differing from the row kept for their id. ``known`` is the result of
    ``clean_players`` where it has been written already."""
    kept = F.struct(*[F.col(f"_k.{c}") for c in players.columns])
    own = F.struct(*players.columns)
    known = clean_players(players) if known is None else known
    survivors = known.select(F.struct(*players.columns).alias("_k"))
    beaten = players.join(by_player(survivors), F.col("fide_id") == F.col("_k.fide_id")).filter(~own.eqNullSafe(kept))
    return players.filter(F.col("fide_id").isNull()).unionByName(beaten.select(*players.columns))


def players_and_ratings(players: DataFrame, ratings: DataFrame) -> DataFrame:
    """Inner equi-join on fide_id; unmatched rows on either side are dropped.
    Output has the 12 columns of the joined table in their golden order."""
    return ratings.join(by_player(players), "fide_id", "inner").select(*JOINED_COLS)


def orphan_ratings(players: DataFrame, ratings: DataFrame) -> DataFrame:
    """Rating rows without a player (what the inner join drops)."""
    return ratings.join(by_player(players.select("fide_id")), "fide_id", "left_anti")


def players_without_ratings(players: DataFrame, ratings: DataFrame) -> DataFrame:
    """Players that have no rating row."""
    return players.join(by_player(ratings.select("fide_id")), "fide_id", "left_anti")


def history_view(joined: DataFrame) -> DataFrame:
    """Monthly history of joined rows with the row key as it is built
    (``fide_id_year_month``) next to the typed key columns; one row per key
    if the rows are ``keyed_ratings``."""
    return joined.select(
        history_key().alias("row_key"),
        "fide_id",
        *PLAYER_DIMS,
        "year",
        "month",
        *RATING_COLS,
    )


def id_name_view(players: DataFrame) -> DataFrame:
    """Name-search view keyed ``first_last_fideid``."""
    return players.select(
        name_key().alias("name_key"), "first_name", "last_name", "fide_id"
    )


def _truncated_avg(c: str):
    # AVG lands in a BIGINT column: truncated toward zero, not rounded.
    return F.avg(c).cast("bigint").alias(c)


def ratings_by_year(joined: DataFrame) -> DataFrame:
    """Average of each discipline per player and year (truncated to BIGINT).

    Grouped by the player's dimensions as well, as the view carries them;
    they depend on fide_id, so the groups are exactly (fide_id, year)."""
    agg = joined.groupBy("fide_id", *PLAYER_DIMS, "year").agg(
        *[_truncated_avg(c) for c in RATING_COLS]
    )
    return agg.select(
        player_year_key().alias("row_key"),
        "fide_id",
        *PLAYER_DIMS,
        "year",
        *RATING_COLS,
    )


def ratings_by_federation_year(joined: DataFrame) -> DataFrame:
    """Average of each discipline per federation and year, weighted by
    player-month rows (not an average of player averages)."""
    agg = joined.groupBy("federation", "year").agg(*[_truncated_avg(c) for c in RATING_COLS])
    return agg.select(fed_year_key().alias("row_key"), "federation", "year", *RATING_COLS)


def rating_counts(joined: DataFrame) -> DataFrame:
    """Number of monthly rating rows per player (the batch ``games_count``)."""
    return joined.groupBy("fide_id").agg(F.count(F.lit(1)).alias("games_count"))


def current_rating(ratings: DataFrame) -> DataFrame:
    """One row per player: the ratings of the player's latest month.

    One ``max_by`` per column over a single month index: every buffer is a
    fixed-width long, so this stays a hash aggregate with partial
    aggregation. The index is unique per player (pass ``keyed_ratings``), so
    all columns come from the same row."""
    month_index = F.col("year") * 12 + F.col("month")
    cols = ["year", "month", *RATING_COLS]
    return ratings.groupBy("fide_id").agg(*[F.max_by(c, month_index).alias(c) for c in cols])


# ------------------------------------------------------------------ rollup
#
# One pass over the joined table gives, per player and year, the row count
# and per discipline the exact integer sum and the non-NULL count. The yearly,
# federation and count views all follow from it: AVG over rows equals
# sum / count of the exact sums (the same double AVG computes), federation
# averages stay weighted by rows, and a player's row count is the sum over
# years. The rollup has one row per player-year, so the three views read a
# table about twelve times smaller than the joined one.


def year_rollup(joined: DataFrame) -> DataFrame:
    """(fide_id, dims…, year, rows, sum_<d>, n_<d> for each discipline)."""
    parts = [F.count(F.lit(1)).alias("rows")]
    for c in RATING_COLS:
        parts += [F.sum(c).alias(f"sum_{c}"), F.count(c).alias(f"n_{c}")]
    return joined.groupBy("fide_id", *PLAYER_DIMS, "year").agg(*parts)


def _ratio(total, n):
    return (total / n).cast("bigint")  # NULL when n = 0 (ANSI-safe: n is NULLed)


def ratings_by_year_from_rollup(rollup: DataFrame) -> DataFrame:
    avgs = [
        _ratio(F.col(f"sum_{c}"), F.when(F.col(f"n_{c}") > 0, F.col(f"n_{c}"))).alias(c)
        for c in RATING_COLS
    ]
    return rollup.select(
        player_year_key().alias("row_key"), "fide_id", *PLAYER_DIMS, "year", *avgs
    )


def ratings_by_federation_year_from_rollup(rollup: DataFrame) -> DataFrame:
    agg = rollup.groupBy("federation", "year").agg(
        *[
            _ratio(F.sum(f"sum_{c}"), F.when(F.sum(f"n_{c}") > 0, F.sum(f"n_{c}"))).alias(c)
            for c in RATING_COLS
        ]
    )
    return agg.select(fed_year_key().alias("row_key"), "federation", "year", *RATING_COLS)


def rating_counts_from_rollup(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("fide_id").agg(F.sum("rows").alias("games_count"))


def summary(joined: DataFrame) -> DataFrame:
    """Database summary: players, rating rows, first and last year, months.

    One pass without expanding the fact: a row per player first (its distinct
    months are bounded by the calendar; after a sort-merge join this reuses
    the join's partitioning), then a row per month from those, combined. A
    player's totals ride on the first of its months."""
    month = F.when(F.col("year").isNotNull() & F.col("month").isNotNull(), F.struct("year", "month"))
    per_player = joined.groupBy("fide_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("year").alias("first"),
        F.max("year").alias("last"),
        F.collect_set(month).alias("months"),
    )
    nothing = F.array(F.lit(None).cast("struct<year:bigint,month:bigint>"))
    months = F.when(F.size("months") > 0, F.col("months")).otherwise(nothing)
    per_month = (
        per_player.select("rows", "first", "last", F.posexplode(months).alias("i", "m"))
        .groupBy("m")
        .agg(
            F.sum(F.when(F.col("i") == 0, 1)).alias("players"),
            F.sum(F.when(F.col("i") == 0, F.col("rows"))).alias("rows"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
        )
    )
    return per_month.agg(
        F.coalesce(F.sum("players"), F.lit(0)).alias("players"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rating_rows"),
        F.min("first").alias("first_year"),
        F.max("last").alias("last_year"),
        F.count("m").alias("months"),
    )
