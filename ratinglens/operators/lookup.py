"""Serving lookups over the views, as lazy DataFrames.

Every lookup is bulk-first: called without an id it answers for all players
in one job; with an id it is the same plan behind an equality filter on a
typed base column, which Parquet receives as a pushed filter. Ids are
compared for equality — never as string prefixes (a prefix of ``1503014``
would also match ``15030140``). Only the name search is a prefix search.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratinglens.functions.scalar import name_key, parse_player_month, player_month_parts
from ratinglens.operators.batch import by_player
from ratinglens.schemas import RATING_COLS, REPORT_FIELDS

# Fixed value: the text shown for a missing value or an empty result.
NO_RESULTS = "no results"


def _by_id(df: DataFrame, fide_id: str | None) -> DataFrame:
    return df if fide_id is None else df.filter(F.col("fide_id") == F.lit(str(fide_id)))


def _side(df: DataFrame, fide_id: str | None) -> DataFrame:
    """A side of a join by player; of one player it is small."""
    return by_player(df) if fide_id is None else df


def player_month(history: DataFrame, key: str) -> DataFrame:
    """One player-month by its ``ID_month_year`` lookup string; no row for a
    string that is not such a key."""
    parsed = parse_player_month(key)
    if parsed is None:
        return history.filter(F.lit(False))
    fide_id, month, year = parsed
    return history.filter(
        (F.col("fide_id") == F.lit(fide_id))
        & (F.col("year") == F.lit(year))
        & (F.col("month") == F.lit(month))
    )


def player_month_bulk(history: DataFrame, requests: DataFrame, key_col: str = "lookup_key") -> DataFrame:
    """Answer many ``ID_month_year`` lookups in one join. Every request gets
    one output row; ``found`` is false (and the values NULL) when the key is
    unknown or malformed."""
    fide_id, year, month = player_month_parts(key_col)
    req = requests.select(
        F.col(key_col).alias(key_col),
        fide_id.alias("_fide_id"),
        year.alias("_year"),
        month.alias("_month"),
    )
    hist = history.withColumn("_hit", F.lit(True))
    cond = (
        (req._fide_id == hist.fide_id) & (req._year == hist.year) & (req._month == hist.month)
    )
    joined = req.join(hist, cond, "left")
    return joined.select(
        F.col(key_col),
        F.coalesce(F.col("_hit"), F.lit(False)).alias("found"),
        *[hist[c] for c in history.columns],
    )


def find_ids(id_name: DataFrame, prefix: str) -> DataFrame:
    """Players whose ``first_last_fideid`` key starts with ``prefix``.

    The first ``_``-free part of the prefix is always a prefix of first_name
    (the key begins with first_name and a ``_``), so that pushable filter is a
    superset; the exact test on the full key follows it."""
    head = prefix.split("_", 1)[0]
    key = name_key()
    return (
        id_name.filter(F.col("first_name").startswith(head))
        .filter(key.startswith(prefix))
        .select("first_name", "last_name", "fide_id")
        .orderBy("first_name", "last_name", "fide_id")
    )


def first_row(view: DataFrame, key_col: str, prefix: str = "") -> DataFrame:
    """First row, in key order, whose key starts with ``prefix`` (no row if
    there is none): the best of each task, then the best of these."""
    found = view.filter(F.col(key_col).startswith(prefix)) if prefix else view.filter(F.col(key_col).isNotNull())
    return found.orderBy(key_col).limit(1)


def first_rows(view: DataFrame, key_col: str, prefixes: DataFrame, prefix_col: str = "prefix") -> DataFrame:
    """For every row of ``prefixes`` the first row of ``view``, in key order,
    whose key starts with that prefix; ``found`` is false (and the values
    NULL) where no key does, or the prefix is NULL. Keys are unique.

    The first such key is the least one that is not below the prefix, if it
    starts with it. So keys and prefixes are put in one order, dealt over
    partitions by ranges of it, and each prefix takes the next key; at the end
    of a partition this is the first key of a later one (a row per partition).
    Each row of the view is shuffled twice, whatever the lengths of the
    prefixes, and a prefix that many keys share gathers nothing."""
    rows = view.filter(F.col(key_col).isNotNull()).select(F.col(key_col).alias("_text"), F.struct(*view.columns).alias("_row"))
    wanted = prefixes.filter(F.col(prefix_col).isNotNull()).select(F.col(prefix_col).alias("_text")).distinct()
    both = rows.unionByName(wanted, allowMissingColumns=True)
    ranged = both.repartitionByRange("_text").withColumn("_part", F.spark_partition_id())
    # From the end: a key comes before the prefix that equals it.
    back = Window.partitionBy("_part").orderBy(F.desc("_text"), F.col("_row").isNull())
    seen = ranged.select(
        "_text",
        "_part",
        F.col("_row").isNull().alias("_asked"),
        F.last("_row", ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, 0)).alias("_next"),
        F.lead("_part").over(back).isNull().alias("_start"),
    )
    # A row per partition; the parts after each, from the last one on.
    later = Window.orderBy(F.desc("_part")).rowsBetween(Window.unboundedPreceding, -1)
    after = seen.filter("_start").select("_part", F.last("_next", ignorenulls=True).over(later).alias("_later"))
    best = (
        seen.filter("_asked")
        .join(F.broadcast(after), "_part", "left")
        .select(F.col("_text").alias("_prefix"), F.coalesce("_next", "_later").alias("_row"))
        .filter(F.col(f"_row.{key_col}").startswith(F.col("_prefix")))
    )
    out = prefixes.join(best.hint("merge"), F.col(prefix_col) == F.col("_prefix"), "left")
    return out.select(
        *prefixes.columns,
        F.col("_row").isNotNull().alias("found"),
        *[F.col(f"_row.{c}").alias(c) for c in view.columns if c not in prefixes.columns],
    )


def player_history(history: DataFrame, fide_id: str | None = None) -> DataFrame:
    """Monthly history of a player (or all players) in month order."""
    return _by_id(history, fide_id).orderBy("fide_id", "year", "month", "last_name", "first_name")


def player_years(by_year: DataFrame, fide_id: str | None = None) -> DataFrame:
    """Yearly averages of a player in year order."""
    return _by_id(by_year, fide_id).orderBy("fide_id", "year", "last_name", "first_name")


def federation_years(fed_by_year: DataFrame, federation: str | None = None) -> DataFrame:
    """Yearly averages of a federation in year order."""
    df = fed_by_year if federation is None else fed_by_year.filter(F.col("federation") == F.lit(federation))
    return df.orderBy("federation", "year")


def player_latest(latest: DataFrame, fide_id: str | None = None) -> DataFrame:
    """Latest submitted (live) rating of a player."""
    return _by_id(latest, fide_id)


def player_count(counts: DataFrame, fide_id: str | None = None) -> DataFrame:
    """Games count of a player."""
    return _by_id(counts, fide_id)


def players_with_live(players: DataFrame, latest: DataFrame) -> DataFrame:
    """Players that have a live row (EXISTS)."""
    return players.join(by_player(latest.select("fide_id")), "fide_id", "left_semi")


def live_with_count(latest: DataFrame, counts: DataFrame, fide_id: str | None = None) -> DataFrame:
    """Live row with its games count. No live row → no output row; a live
    row without a count keeps ``games_count`` NULL (shown as "no games")."""
    c = counts.select("fide_id", "games_count", F.lit(True).alias("_has"))
    out = _by_id(latest, fide_id).join(_side(_by_id(c, fide_id), fide_id), "fide_id", "left")
    return out.select(
        "fide_id",
        *REPORT_FIELDS,
        "games_count",
        F.coalesce(F.col("_has"), F.lit(False)).alias("has_count"),
    )


def player_page(
    history: DataFrame,
    counts: DataFrame,
    latest: DataFrame,
    fide_id: str | None = None,
    strict: bool = False,
) -> DataFrame:
    """Monthly history ⟕ games count ⟕ live rating (suffix ``_curr``), and one
    row without history for each player that has a live rating but no history.

    Count and live row are first merged into one status row per player (both
    sides are unique per fide_id, so that join cannot skew); the history is
    then joined once, at the top of the plan, where AQE may split the
    partition of a player with very many history rows (a full outer join
    could not be split). ``has_count`` / ``has_live`` tell the cases apart;
    ``strict`` reproduces the page that hides a live rating when no count
    exists. One player's page is in date order."""
    c = _by_id(counts, fide_id).select("fide_id", "games_count", F.lit(True).alias("has_count"))
    live = _by_id(latest, fide_id).select(
        "fide_id",
        *[F.col(r).alias(f"{r}_curr") for r in RATING_COLS],
        F.lit(True).alias("has_live"),
    )
    status = c.join(_side(live, fide_id), "fide_id", "full")
    own = _by_id(history, fide_id)
    live_only = status.filter("has_live").join(_side(own.select("fide_id"), fide_id), "fide_id", "left_anti")
    page = own.join(_side(status, fide_id), "fide_id", "left").unionByName(live_only, allowMissingColumns=True)
    has_count = F.coalesce(F.col("has_count"), F.lit(False))
    has_live = F.coalesce(F.col("has_live"), F.lit(False))
    show_live = has_live & has_count if strict else has_live
    curr = [F.when(show_live, F.col(f"{r}_curr")).alias(f"{r}_curr") for r in RATING_COLS]
    shown = page.select(
        *history.columns, "games_count", *curr, has_count.alias("has_count"), has_live.alias("has_live")
    )
    return shown if fide_id is None else shown.orderBy("year", "month")


def present(df: DataFrame, text: str = NO_RESULTS) -> DataFrame:
    """Presentation helper: every column as text, NULL shown as ``text``."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(text)).alias(c) for c in df.columns])


def or_no_results(df: DataFrame, text: str = NO_RESULTS) -> DataFrame:
    """``df`` as text; when it is empty, one placeholder row instead.

    The emptiness test is an anti join on a constant against one row of
    ``df``, so no action runs on the driver."""
    shown = present(df, text)
    spark = df.sparkSession
    placeholder = spark.range(1).select(
        F.lit(1).alias("_k"), *[F.lit(text).alias(c) for c in df.columns]
    )
    probe = df.limit(1).select(F.lit(1).alias("_k"))
    empty_case = placeholder.join(probe, "_k", "left_anti").drop("_k")
    return shown.unionByName(empty_case)
