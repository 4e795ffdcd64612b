"""Small hand-written inputs, one per semantic rule (see FIXTURES.md)."""

from ratinglens.schemas import PLAYERS, RATINGS

PLAYER_ROWS = [
    # fide_id, last, first, federation, gender, title, yob
    ("1", "Doe", "Ann", "USA", "F", "GM", 1990),        # key order, disciplines
    ("15", "Short", "Id", "USA", "M", None, None),      # id prefix of 150, NULL dims
    ("150", "Long", "Id", "USA", "M", "IM", 1985),
    ("2", "Same", "Name", "FRA", "M", "FM", 2000),      # homonyms
    ("3", "Same", "Name", "FRA", "M", "FM", 2001),
    ("4", "Year", "One", "FRA", None, None, 1970),      # one-year player, 12 months
    ("5", "Lonely", "Player", "GER", "F", None, None),  # player without ratings
]

RATING_ROWS = [
    # fide_id, year, month, standard, rapid, blitz
    ("1", 2016, 2, 2500, 2400, 2300),
    ("1", 2016, 12, 2501, 2410, 2310),   # 2500 and 2501 in one year → 2500
    ("15", 2017, 1, 1000, 900, None),    # blitz always NULL for 15 in 2017
    ("150", 2017, 1, 2000, 1900, 1800),
    ("2", 2018, 3, 1800, 1700, 1600),
    ("3", 2018, 3, 1900, 1850, 1750),
    ("99", 2018, 1, 1500, 1400, 1300),   # rating without player
] + [("4", 2019, m, 2000, 1000 + m, 500 + m) for m in range(1, 13)]


def players_df(spark):
    return spark.createDataFrame(PLAYER_ROWS, PLAYERS)


def ratings_df(spark):
    return spark.createDataFrame(RATING_ROWS, RATINGS)
