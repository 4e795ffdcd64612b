"""Chart-ready time series, in long format (one row per entity, discipline
and date) and packed (one ordered array of points per entity and discipline).

Disciplines keep their own labels (the yearly pages of the original mixed up
rapid and blitz; that is not reproduced). A NULL rating stays a point with a
NULL value, as a chart draws a gap there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratinglens.functions.scalar import first_of_month, first_of_year
from ratinglens.schemas import RATING_COLS


def _long(df: DataFrame, ids: list[str]) -> DataFrame:
    long = df.select(*ids, *RATING_COLS).unpivot(
        ids, RATING_COLS, variableColumnName="discipline", valueColumnName="rating"
    )
    return long.withColumn("discipline", F.regexp_replace("discipline", "^rating_", ""))


def series_monthly(history: DataFrame) -> DataFrame:
    """(fide_id, year, month, date, discipline, rating) per history row."""
    long = _long(history, ["fide_id", "year", "month"])
    return long.select(
        "fide_id", "year", "month", first_of_month().alias("date"), "discipline", "rating"
    )


def series_player_yearly(by_year: DataFrame) -> DataFrame:
    """(fide_id, year, date, discipline, rating) from the yearly averages."""
    long = _long(by_year, ["fide_id", "year"])
    return long.select("fide_id", "year", first_of_year().alias("date"), "discipline", "rating")


def series_federation_yearly(fed_by_year: DataFrame) -> DataFrame:
    """(federation, year, date, discipline, rating) from federation averages."""
    long = _long(fed_by_year, ["federation", "year"])
    return long.select("federation", "year", first_of_year().alias("date"), "discipline", "rating")


def in_date_order(series: DataFrame, entity_cols: list[str]) -> DataFrame:
    """The points of a chart in the order they are drawn."""
    return series.orderBy(*entity_cols, "discipline", "date")


def series_packed(series: DataFrame, entity_cols: list[str]) -> DataFrame:
    """One date-ordered array of (date, rating) points per entity and
    discipline. An array holds one point per distinct date of the entity —
    bounded by the calendar span (months or years), not by data volume."""
    return series.groupBy(*entity_cols, "discipline").agg(
        F.sort_array(F.collect_list(F.struct("date", "rating"))).alias("points")
    )


def series_text(series: DataFrame, entity_cols: list[str]) -> DataFrame:
    """The packed series as chart-ready JSON text per entity and discipline:
    ``[["2016-02-01",2500],["2016-03-01",null],…]`` in date order."""
    points = F.sort_array(F.collect_list(F.struct("date", "rating")))
    pair = lambda p: F.concat(
        F.lit('["'),
        p["date"].cast("string"),
        F.lit('",'),
        F.coalesce(p["rating"].cast("string"), F.lit("null")),
        F.lit("]"),
    )
    text = F.concat(F.lit("["), F.array_join(F.transform(points, pair), ","), F.lit("]"))
    return series.groupBy(*entity_cols, "discipline").agg(text.alias("points_json"))
