"""Declared schemas of the data model. Nothing is ever inferred."""

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()

# Monthly ratings fact, one row per (fide_id, year, month).
RATINGS = T.StructType(
    [
        T.StructField("fide_id", S, False),
        T.StructField("year", L, False),
        T.StructField("month", L, False),
        T.StructField("rating_standard", L, True),
        T.StructField("rating_rapid", L, True),
        T.StructField("rating_blitz", L, True),
    ]
)

# Player dimension after the name has been split into two columns.
PLAYERS = T.StructType(
    [
        T.StructField("fide_id", S, False),
        T.StructField("last_name", S, True),
        T.StructField("first_name", S, True),
        T.StructField("federation", S, True),
        T.StructField("gender", S, True),
        T.StructField("title", S, True),
        T.StructField("yob", L, True),
    ]
)

# Player dimension as delivered: one quoted "Last, First" name field.
PLAYERS_RAW = T.StructType(
    [
        T.StructField("fide_id", S, False),
        T.StructField("name", S, True),
        T.StructField("federation", S, True),
        T.StructField("gender", S, True),
        T.StructField("title", S, True),
        T.StructField("yob", L, True),
    ]
)

RATING_COLS = ["rating_standard", "rating_rapid", "rating_blitz"]
PLAYER_DIMS = ["last_name", "first_name", "federation", "gender", "title", "yob"]

# Golden column order of the joined table (players_and_ratings).
JOINED_COLS = ["fide_id"] + PLAYER_DIMS + ["year", "month"] + RATING_COLS

# One submitted rating report; every field is a string on the wire.
SUBMISSION = T.StructType(
    [
        T.StructField("fide_id", S, True),
        T.StructField("first_name", S, True),
        T.StructField("last_name", S, True),
        T.StructField("rating_standard", S, True),
        T.StructField("rating_rapid", S, True),
        T.StructField("rating_blitz", S, True),
    ]
)
SUBMISSION_FIELDS = [f.name for f in SUBMISSION.fields]
REPORT_FIELDS = SUBMISSION_FIELDS[1:]

# Counter change record emitted by the speed layer.
COUNTER_CHANGE = T.StructType(
    [T.StructField("fide_id", S, False), T.StructField("games_count", L, False)]
)

# One cell of a key/column/value export of a view.
