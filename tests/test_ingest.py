import os

from conftest import rows

from ratinglens.functions.scalar import be_bytes, be_long, parse_player_month, strip_prefix, to_number
from ratinglens.operators import cells
from ratinglens.schemas import RATINGS
from ratinglens.sources import delimited
from pyspark.sql import functions as F


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_ratings_csv_typed_and_permissive(spark, tmp_dir):
    p = f"{tmp_dir}/ratings/part.csv"
    _write(
        p,
        "fide_id,year,month,rating_standard,rating_rapid,rating_blitz\n"
        "1,2016,2,2500,2400,2300\n"
        "2,2016,3,\\N,abc,\n"       # NULL token, bad number, empty
        "3,2017,1,1500\n"           # missing trailing columns
        "4,2017,1,1,2,3,extra\n",   # extra column dropped
    )
    got = {r.fide_id: r for r in delimited.read_ratings(spark, f"{tmp_dir}/ratings").collect()}
    assert (got["1"].year, got["1"].rating_blitz) == (2016, 2300)
    assert (got["2"].rating_standard, got["2"].rating_rapid, got["2"].rating_blitz) == (None, None, None)
    assert (got["3"].rating_standard, got["3"].rating_rapid) == (1500, None)
    assert got["4"].rating_blitz == 3


def test_players_csv_dirty(spark, tmp_dir):
    p = f"{tmp_dir}/players/part.csv"
    _write(
        p,
        "fide_id,last_name,first_name,federation,gender,title,yob\n"
        "1,Doe,Ann,USA,F,GM,1990\n"
        "2,Roe,Bob,FRA,M,\\N,19x0\n"
        "3,Zed,,GER,F,,\n",
    )
    got = {r.fide_id: r for r in delimited.read_players(spark, f"{tmp_dir}/players").collect()}
    assert got["1"].yob == 1990
    assert got["2"].title is None and got["2"].yob is None
    # empty text stays the empty string, an empty number is NULL
    assert (got["3"].first_name, got["3"].title, got["3"].yob) == ("", "", None)


def test_split_name_rules(spark, tmp_dir):
    p = f"{tmp_dir}/raw/part.csv"
    _write(
        p,
        "fide_id,name,federation,gender,title,yob\n"
        '1,"Doe, Ann",USA,F,GM,1990\n'
        '2,"Solo",FRA,M,,2000\n'
        '3,"Roe, Bob, Jr",GER,M,IM,1980\n'
        '4,"Under_score, X",ITA,F,,\n',
    )
    raw = delimited.read_players_raw(spark, f"{tmp_dir}/raw")
    got = {r.fide_id: r for r in delimited.normalise_players(raw).collect()}
    assert (got["1"].last_name, got["1"].first_name, got["1"].federation) == ("Doe", "Ann", "USA")
    assert (got["2"].last_name, got["2"].first_name, got["2"].federation) == ("Solo", None, "FRA")
    assert (got["3"].last_name, got["3"].first_name, got["3"].title) == ("Roe", "Bob, Jr", "IM")
    assert got["4"].last_name == "Under_score"
    q = dict(rows(delimited.name_quality(raw), "shape", "n_rows"))
    assert q == {"ok": 2, "no_comma": 1, "extra_comma": 1}


def test_delimited_round_trip(spark, tmp_dir):
    df = spark.createDataFrame(
        [("1", 2016, 2, 2500, None, 2300)],
        "fide_id string, year long, month long, rating_standard long, rating_rapid long, rating_blitz long",
    )
    delimited.write_delimited(df, f"{tmp_dir}/out")
    text = "".join(open(os.path.join(f"{tmp_dir}/out", f)).read() for f in sorted(os.listdir(f"{tmp_dir}/out")) if f.endswith(".csv"))
    assert "1,2016,2,2500,\\N,2300" in text
    assert rows(delimited.read_ratings(spark, f"{tmp_dir}/out")) == rows(df)


def test_scalar_helpers(spark):
    assert parse_player_month("1503014_2_2016") == ("1503014", 2, 2016)
    df = spark.createDataFrame([("stats:year", " 42 ", bytes([0, 0, 0, 0, 0, 0, 1, 2]))], "c string, n string, b binary")
    r = df.select(
        strip_prefix("c", "stats:").alias("a"),
        strip_prefix("c", "nope:").alias("b"),
        to_number("n").alias("n"),
        to_number(F.lit("x1")).alias("bad"),
        be_long("b").alias("counter"),
    ).collect()[0]
    assert (r.a, r.b, r.n, r.bad, r.counter) == ("year", None, 42, None, 258)


def test_cells_round_trip_and_versions(spark):
    df = spark.createDataFrame([("k1", "a", 1), ("k2", None, 2)], "key string, s string, n long")
    cs = cells.to_cells(df, "key")
    assert cs.count() == 3  # NULL cell not stored
    back = cells.cells_to_rows(cs, ["s", "n"], {"n": "bigint"})
    assert rows(back) == [("k1", "a", 1), ("k2", None, 2)]
    versions = spark.createDataFrame(
        [("k1", "stats:s", "old", 1), ("k1", "stats:s", "new", 2), ("k1", "stats:n", "5", 1)],
        "key string, column string, value string, ts long",
    )
    got = cells.cells_to_rows(versions, ["s", "n"], {"n": "bigint"}, version_col="ts").collect()[0]
    assert (got.s, got.n) == ("new", 5)


def test_latest_version(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, v long, payload string")
    assert rows(cells.latest_version(df, ["k"], ["v"])) == [("a", 2, "y"), ("b", 1, "z")]


def test_counter_cell_round_trip(spark):
    df = spark.createDataFrame([(0,), (258,), (2**40 + 7,)], "n long")
    enc = df.select("n", be_bytes("n").alias("b"))
    got = enc.select("n", F.length("b").alias("len"), be_long("b").alias("back")).collect()
    assert all(r.len == 8 and r.back == r.n for r in got)
    assert enc.filter("n = 258").collect()[0].b == bytes([0, 0, 0, 0, 0, 0, 1, 2])


def test_players_round_trip_keeps_empty_and_null_apart(spark, tmp_dir):
    from ratinglens.schemas import PLAYERS

    df = spark.createDataFrame([("1", "", None, "USA", "", None, None), ("2", "Roe", "Bob", None, "M", "GM", 1980)], PLAYERS)
    delimited.write_delimited(df, f"{tmp_dir}/players")
    assert rows(delimited.read_players(spark, f"{tmp_dir}/players")) == rows(df)


def test_raw_names_with_quotes_and_commas_round_trip(spark, tmp_dir):
    from ratinglens.schemas import PLAYERS

    df = spark.createDataFrame([("1", 'O"Neil', "Pat", "IRL", "M", None, 1970), ("2", "Doe", "Ann", "USA", "F", "GM", None)], PLAYERS)
    delimited.write_players_raw(df, f"{tmp_dir}/raw")
    text = "".join(open(os.path.join(f"{tmp_dir}/raw", f)).read() for f in os.listdir(f"{tmp_dir}/raw") if f.endswith(".csv"))
    assert '"O""Neil, Pat"' in text
    back = delimited.normalise_players(delimited.read_players_raw(spark, f"{tmp_dir}/raw"))
    assert rows(back) == rows(df)


def test_date_and_text_helpers(spark):
    from ratinglens.functions.scalar import drop_first, first_of_month, first_of_year, pad_month

    df = spark.createDataFrame([(2016, 2, "_2016")], "year long, month long, k string")
    r = df.select(
        pad_month().alias("m"), drop_first("k").alias("y"),
        first_of_month().alias("d"), first_of_year().alias("j"),
    ).collect()[0]
    assert (r.m, r.y, r.d.isoformat(), r.j.isoformat()) == ("02", "2016", "2016-02-01", "2016-01-01")


def test_binary_cells_round_trip(spark):
    data = [("a", "é_x", 5, -1), ("b", None, None, 2**40), ("c", "", 7, -(2**63)), ("d", "\\N", 0, 2**63 - 1)]
    df = spark.createDataFrame(data, "k string, name string, rating long, n long")
    coded = cells.to_binary_cells(df, "k", ["n"])
    assert dict(coded.dtypes) == {"key": "binary", "column": "string", "value": "binary"}
    raw = {(bytes(r.key), r.column): bytes(r.value) for r in coded.collect()}
    assert raw[b"a", "stats:n"] == (-1).to_bytes(8, "big", signed=True) and raw[b"a", "stats:name"] == "é_x".encode()
    back = cells.cells_to_rows(cells.text_cells(coded, ["n"]), ["name", "rating", "n"], {"rating": "bigint", "n": "bigint"})
    assert sorted(map(str, back.collect())) == sorted(map(str, df.withColumnRenamed("k", "key").collect()))
    # cells that are no counter, or no text
    odd = [(b"a", "stats:n", b"\x00\x01"), (b"a", "stats:name", b"\xff\xfe"), (b"\xff", "stats:name", b"x"), (b"b", "stats:n", bytes(8))]
    odd = spark.createDataFrame([tuple(map(bytearray, (k, v))) + (c,) for k, c, v in odd], "key binary, value binary, column string")
    assert [tuple(r) for r in cells.text_cells(odd, ["n"]).select("key", "column", "value").collect()] == [("b", "stats:n", "0")]


def test_ingest_audit_tells_what_does_not_fit(spark, tmp_dir):
    import os

    os.makedirs(f"{tmp_dir}/r")
    lines = ["1,2016,1,2500,2400,2300", "1,2016,x,2500,,2300", "1,2016,1,2500", "1,2016,1,\\N,\\N,\\N,9", "1,zz,1,n/a,2,3,4,5", "", "a"]
    with open(f"{tmp_dir}/r/a.csv", "w") as f:
        f.write("fide_id,year,month,rating_standard,rating_rapid,rating_blitz\n" + "\n".join(lines) + "\n")
    found = {r.line: (r.reasons, r["columns"]) for r in delimited.audit_delimited(spark, f"{tmp_dir}/r", RATINGS).collect()}
    assert found == {
        lines[1]: (["bad_number"], ["month"]),
        lines[2]: (["missing_fields"], []),
        lines[3]: (["extra_fields"], []),
        lines[4]: (["bad_number", "extra_fields"], ["year", "rating_standard"]),
        "a": (["missing_fields"], []),
    }
    counts = delimited.audit_counts(delimited.audit_delimited(spark, f"{tmp_dir}/r", RATINGS))
    assert sorted(map(tuple, counts.collect())) == [("bad_number", 2), ("extra_fields", 2), ("missing_fields", 2)]
