import random

from conftest import rows
from fixtures import players_df, ratings_df
from test_skew import conf

from ratinglens.operators import batch, lookup, serving, series
from ratinglens.plans.explain import plan_text


def _views(spark):
    p, r = players_df(spark), ratings_df(spark)
    j = batch.players_and_ratings(p, r)
    return p, j, batch.history_view(j)


def _live_and_counts(spark, j):
    # live rows for 1 (with count) and 77 (no batch count); 15 has a count but no live row
    live = spark.createDataFrame(
        [("1", "Ann", "Doe", "2600", "2500", "2400"), ("77", "New", "Guy", "1200", "1100", "1000")],
        "fide_id string, first_name string, last_name string, rating_standard string, rating_rapid string, rating_blitz string",
    )
    stream = spark.createDataFrame([("1", 3), ("77", 1)], "fide_id string, stream_count long")
    merged = serving.games_count_merged(batch.rating_counts(j), stream)
    return live, merged


def test_player_month_reads_id_month_year(spark):
    _, _, h = _views(spark)
    got = lookup.player_month(h, "1_2_2016").collect()
    assert len(got) == 1 and got[0].rating_standard == 2500 and got[0].row_key == "1_2016_2"
    assert lookup.player_month(h, "1_2016_2").count() == 0


def test_player_month_bulk_one_answer_per_request(spark):
    _, _, h = _views(spark)
    req = spark.createDataFrame([("1_2_2016",), ("1_12_2016",), ("42_1_2016",), ("garbage",)], "lookup_key string")
    got = {r.lookup_key: r for r in lookup.player_month_bulk(h, req).collect()}
    assert got["1_2_2016"].found and got["1_12_2016"].rating_standard == 2501
    assert not got["42_1_2016"].found and not got["garbage"].found


def test_id_lookups_are_equality_not_prefix(spark):
    _, j, h = _views(spark)
    assert rows(lookup.player_history(h, "15"), "fide_id") == [("15",)]
    assert rows(lookup.player_years(batch.ratings_by_year(j), "15"), "fide_id") == [("15",)]


def test_history_order_month_2_before_12(spark):
    _, _, h = _views(spark)
    months = [r.month for r in lookup.player_history(h, "1").collect()]
    assert months == [2, 12]


def test_find_ids_prefix_and_homonyms(spark):
    p, _, _ = _views(spark)
    v = batch.id_name_view(p)
    assert rows(lookup.find_ids(v, "Na"), "fide_id") == [("2",), ("3",)]
    assert rows(lookup.find_ids(v, "Name_Same_3"), "fide_id") == [("3",)]
    assert rows(lookup.find_ids(v, "Id_L"), "fide_id") == [("150",)]


def test_find_ids_name_with_underscore(spark):
    p = spark.createDataFrame(
        [("9", "Lee", "A_B", None, None, None, None), ("10", "B", "A", None, None, None, None)],
        players_df(spark).schema,
    )
    v = batch.id_name_view(p)
    assert rows(lookup.find_ids(v, "A_B"), "fide_id") == [("10",), ("9",)]
    assert rows(lookup.find_ids(v, "A_B_L"), "fide_id") == [("9",)]


def test_federation_years(spark):
    _, j, _ = _views(spark)
    got = lookup.federation_years(batch.ratings_by_federation_year(j), "FRA").collect()
    assert [r.year for r in got] == [2018, 2019]


def test_live_with_count_cases(spark):
    _, j, _ = _views(spark)
    live, merged = _live_and_counts(spark, j)
    counts = serving.serving_counts(merged)
    got = {r.fide_id: r for r in lookup.live_with_count(live, counts).collect()}
    assert set(got) == {"1", "77"}  # no live row → no result (15)
    assert got["1"].games_count == 2 + 3 and got["1"].has_count
    assert got["77"].games_count == 1


def test_live_without_any_count(spark):
    live = spark.createDataFrame([("8", "X", "Y", "1", "2", "3")], "fide_id string, first_name string, last_name string, rating_standard string, rating_rapid string, rating_blitz string")
    counts = spark.createDataFrame([], "fide_id string, games_count long")
    r = lookup.live_with_count(live, counts).collect()[0]
    assert r.games_count is None and not r.has_count


def test_games_count_merge(spark):
    _, j, _ = _views(spark)
    _, merged = _live_and_counts(spark, j)
    got = {r.fide_id: r for r in merged.collect()}
    assert (got["1"].batch_count, got["1"].stream_count, got["1"].games_count) == (2, 3, 5)
    assert (got["77"].batch_count, got["77"].games_count) == (None, 1)
    assert (got["4"].stream_count, got["4"].games_count) == (None, 12)


def test_player_page_flags(spark):
    _, j, h = _views(spark)
    live, merged = _live_and_counts(spark, j)
    counts = serving.serving_counts(merged)
    page = lookup.player_page(h, counts, live)
    p1 = lookup.player_page(h, counts, live, "1").collect()
    assert len(p1) == 2 and all(r.has_live and r.has_count for r in p1)
    assert p1[0].rating_standard_curr == "2600" and p1[0].games_count == 5
    p15 = page.filter("fide_id = '15'").collect()[0]
    assert p15.has_count and not p15.has_live and p15.rating_standard_curr is None
    # strict: a live row is hidden when no count exists
    nocount = spark.createDataFrame([], "fide_id string, games_count long")
    strict = lookup.player_page(h, nocount, live, "1", strict=True).collect()
    assert all(r.rating_standard_curr is None and r.has_live for r in strict)


def test_players_with_live(spark):
    p, j, _ = _views(spark)
    live, _ = _live_and_counts(spark, j)
    assert rows(lookup.players_with_live(p, live), "fide_id") == [("1",)]


def test_no_results_helpers(spark):
    _, _, h = _views(spark)
    empty = lookup.player_history(h, "nope").select("fide_id", "year")
    got = lookup.or_no_results(empty).collect()
    assert [tuple(r) for r in got] == [("no results", "no results")]
    full = lookup.or_no_results(lookup.player_history(h, "15").select("fide_id", "rating_blitz")).collect()
    assert [tuple(r) for r in full] == [("15", "no results")]


def test_series_labels_and_dates(spark):
    _, j, h = _views(spark)
    s = series.series_monthly(h).filter("fide_id = '1' AND month = 2")
    got = {r.discipline: r.rating for r in s.collect()}
    assert got == {"standard": 2500, "rapid": 2400, "blitz": 2300}
    y = series.series_player_yearly(batch.ratings_by_year(j)).filter("fide_id = '1'")
    got = {r.discipline: (r.date.isoformat(), r.rating) for r in y.collect()}
    assert got["rapid"] == ("2016-01-01", 2405) and got["blitz"] == ("2016-01-01", 2305)
    f = series.series_federation_yearly(batch.ratings_by_federation_year(j)).filter("federation = 'USA'")
    assert f.count() == 6  # 2016 and 2017 × 3 disciplines


def test_series_packed_is_date_ordered(spark):
    _, _, h = _views(spark)
    packed = series.series_packed(series.series_monthly(h), ["fide_id"])
    r = packed.filter("fide_id = '4' AND discipline = 'rapid'").collect()[0]
    assert [p.rating for p in r.points] == [1000 + m for m in range(1, 13)]
    assert r.points[0].date.isoformat() == "2019-01-01"


def test_series_text_is_ordered_json(spark):
    import json

    _, _, h = _views(spark)
    text = series.series_text(series.series_monthly(h), ["fide_id"])
    r = text.filter("fide_id = '15' AND discipline = 'blitz'").collect()[0]
    assert json.loads(r.points_json) == [["2017-01-01", None]]
    r = text.filter("fide_id = '1' AND discipline = 'standard'").collect()[0]
    assert json.loads(r.points_json) == [["2016-02-01", 2500], ["2016-12-01", 2501]]


def test_first_rows_of_a_key_ordered_scan(spark):
    view = spark.createDataFrame([(k, i) for i, k in enumerate(["5_1", "50_2", "5_0", "é_1", "z", "", "501"])], "k string, v int")
    asked = ["5", "5_", "50", "501", "5_0", "x", "", "é", None, "5"]
    prefixes = spark.createDataFrame([(p, "keep") for p in asked], "prefix string, note string")
    got = lookup.first_rows(view, "k", prefixes)
    assert got.columns == ["prefix", "note", "found", "k", "v"]
    keys = ["5_1", "50_2", "5_0", "é_1", "z", "", "501"]
    want = []
    for p in asked:
        held = sorted(k for k in keys if p is not None and k.startswith(p))
        want.append((p, bool(held), held[0] if held else None))
    assert sorted(map(str, rows_of(got, "prefix", "found", "k"))) == sorted(map(str, want))
    assert [r.k for r in lookup.first_row(view, "k", "5").collect()] == ["501"]
    assert [r.k for r in lookup.first_row(view, "k").collect()] == [""]
    assert lookup.first_row(view, "k", "x").count() == 0
    assert lookup.first_rows(view.limit(0), "k", prefixes).where("found").count() == 0
    assert lookup.first_rows(view, "k", prefixes.limit(0)).count() == 0
    plan = lookup.first_rows(view, "k", prefixes)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "TakeOrderedAndProject" in lookup.first_row(view, "k", "5")._jdf.queryExecution().executedPlan().toString()


def test_first_rows_over_many_partitions(spark):
    """Every prefix of every key and more, dealt over partitions so that the
    next key is often in a later one; the view is not offered per length."""
    rng = random.Random(3)
    keys = sorted({"".join(rng.choice("01_é") for _ in range(rng.randint(0, 6))) for _ in range(300)})
    asked = sorted({k[:n] for k in keys for n in range(7)} | {k + c for k in keys for c in "0z"}) + [None]
    view = spark.createDataFrame([(k, i) for i, k in enumerate(keys)] + [(None, -1)], "k string, v int").repartition(5)
    prefixes = spark.createDataFrame([(p,) for p in asked], "prefix string")
    held = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "40"}
    with conf(spark, held):
        df = lookup.first_rows(view, "k", prefixes)
        got = {r.prefix: (r.found, r.k, r.v) for r in df.collect()}
    assert "Generate" not in plan_text(df, "simple")
    assert len(got) == len(asked)
    for p in asked:
        k = None if p is None else min((k for k in keys if k.startswith(p)), key=str.encode, default=None)
        assert got[p] == ((False, None, None) if k is None else (True, k, keys.index(k))), p


def test_first_rows_of_a_repeated_key(spark):
    view = spark.createDataFrame([("a1", 1), ("a1", 1), ("b", 2)], "k string, v int")
    got = lookup.first_rows(view, "k", spark.createDataFrame([("a",), ("a1",)], "prefix string"))
    assert sorted(map(tuple, got.collect())) == [("a", True, "a1", 1), ("a1", True, "a1", 1)]


def rows_of(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]
