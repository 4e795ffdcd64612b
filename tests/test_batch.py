from conftest import rows
from fixtures import players_df, ratings_df
from pyspark.sql import functions as F

from ratinglens.operators import batch, lookup
from ratinglens.plans.explain import plan_text
from ratinglens.schemas import REPORT_FIELDS


def test_join_is_inner_and_keeps_golden_columns(spark):
    j = batch.players_and_ratings(players_df(spark), ratings_df(spark))
    assert j.columns == [
        "fide_id", "last_name", "first_name", "federation", "gender", "title", "yob",
        "year", "month", "rating_standard", "rating_rapid", "rating_blitz",
    ]
    ids = {r.fide_id for r in j.select("fide_id").distinct().collect()}
    assert "99" not in ids and "5" not in ids
    assert j.count() == 18


def test_orphans_both_sides(spark):
    p, r = players_df(spark), ratings_df(spark)
    assert rows(batch.orphan_ratings(p, r), "fide_id") == [("99",)]
    assert rows(batch.players_without_ratings(p, r), "fide_id") == [("5",)]


def test_history_key_is_built_id_year_month(spark):
    h = batch.history_view(batch.players_and_ratings(players_df(spark), ratings_df(spark)))
    keys = rows(h.filter("fide_id = '1'"), "row_key")
    assert keys == [("1_2016_12",), ("1_2016_2",)]


def test_yearly_average_truncates(spark):
    j = batch.players_and_ratings(players_df(spark), ratings_df(spark))
    y = batch.ratings_by_year(j).filter("fide_id = '1'").collect()
    assert len(y) == 1
    assert (y[0].rating_standard, y[0].rating_rapid, y[0].rating_blitz) == (2500, 2405, 2305)
    assert y[0].row_key == "1_2016"


def test_yearly_average_all_null_is_null_and_null_dims_group(spark):
    j = batch.players_and_ratings(players_df(spark), ratings_df(spark))
    y = batch.ratings_by_year(j).filter("fide_id = '15'").collect()
    assert len(y) == 1 and y[0].rating_blitz is None and y[0].title is None and y[0].yob is None


def test_one_year_player_has_one_yearly_row(spark):
    j = batch.players_and_ratings(players_df(spark), ratings_df(spark))
    assert batch.ratings_by_year(j).filter("fide_id = '4'").count() == 1
    assert batch.history_view(j).filter("fide_id = '4'").count() == 12


def test_federation_average_weighted_by_rows(spark):
    j = batch.players_and_ratings(players_df(spark), ratings_df(spark))
    fed = batch.ratings_by_federation_year(j)
    fra19 = fed.filter("federation = 'FRA' AND year = 2019").collect()[0]
    assert fra19.rating_standard == 2000
    usa17 = fed.filter("federation = 'USA' AND year = 2017").collect()[0]
    assert usa17.rating_standard == 1500 and usa17.rating_blitz == 1800
    assert usa17.row_key == "USA_2017"


def test_federation_weighting_not_average_of_averages(spark):
    p = players_df(spark)
    extra = [("7", 2019, m, 1000, 1000, 1000) for m in range(1, 2)]
    extra += [("8", 2019, m, 2000, 2000, 2000) for m in range(1, 13)]
    r = spark.createDataFrame(extra, ratings_df(spark).schema)
    p2 = p.unionByName(
        spark.createDataFrame([("7", "A", "B", "ITA", None, None, None), ("8", "C", "D", "ITA", None, None, None)], p.schema)
    )
    fed = batch.ratings_by_federation_year(batch.players_and_ratings(p2, r)).collect()
    # (1000 + 12*2000) / 13 = 1923.07 → 1923, not (1000+2000)/2
    assert fed[0].rating_standard == 1923


def test_counts_and_current_rating(spark):
    p, r = players_df(spark), ratings_df(spark)
    j = batch.players_and_ratings(p, r)
    counts = dict(rows(batch.rating_counts(j)))
    assert counts["4"] == 12 and counts["1"] == 2
    cur = {x.fide_id: x for x in batch.current_rating(r).collect()}
    assert (cur["1"].year, cur["1"].month, cur["1"].rating_standard) == (2016, 12, 2501)
    assert (cur["4"].month, cur["4"].rating_rapid) == (12, 1012)


def test_dedup_is_deterministic(spark):
    p = players_df(spark)
    dup = spark.createDataFrame([("1", "Doe", "Ann", "USA", "F", "IM", 1990)], p.schema)
    a = rows(batch.clean_players(p.unionByName(dup)).filter("fide_id = '1'"))
    b = rows(batch.clean_players(dup.unionByName(p).repartition(3)).filter("fide_id = '1'"))
    assert a == b and len(a) == 1 and a[0][5] in ("GM", "IM")


def test_dedup_tells_nulls_apart(spark):
    # The same values in other columns: the kept row must not depend on order.
    r = ratings_df(spark)
    a = spark.createDataFrame([("7", 2016, 1, None, 2000, None)], r.schema)
    b = spark.createDataFrame([("7", 2016, 1, 2000, None, None)], r.schema)
    ab = rows(batch.keyed_ratings(a.unionByName(b).coalesce(1)))
    ba = rows(batch.keyed_ratings(b.unionByName(a).coalesce(1)))
    assert ab == ba == [("7", 2016, 1, 2000, None, None)]


def test_dedup_of_the_fact_keeps_whole_rows(spark):
    from ratinglens.plans.explain import plan_text

    r = ratings_df(spark)
    dup = spark.createDataFrame([("1", 2016, 2, 1, 2, 3), ("1", 2016, 2, 2500, 2400, 2300)], r.schema)
    clean = batch.keyed_ratings(r.unionByName(dup))
    got = clean.filter("fide_id = '1' AND month = 2").collect()
    assert len(got) == 1 and tuple(got[0])[3:] in [(1, 2, 3), (2500, 2400, 2300)]
    assert clean.count() == r.count()
    text = plan_text(clean, "simple")
    assert "partial_max" in text and "Window" not in text


def test_keyed_ratings_rejects_null_keys(spark):
    r = ratings_df(spark)
    bad = spark.createDataFrame([(None, 2016, 1, 1, 1, 1)], "fide_id string, year long, month long, rating_standard long, rating_rapid long, rating_blitz long")
    allr = r.unionByName(bad)
    assert batch.keyed_ratings(allr).count() == r.count()
    assert batch.rejected_ratings(allr).count() == 1


def test_summary(spark):
    j = batch.players_and_ratings(players_df(spark), ratings_df(spark))
    s = batch.summary(j).collect()[0]
    assert (s.players, s.rating_rows, s.first_year, s.last_year) == (6, 18, 2016, 2019)
    assert s.months == 2 + 1 + 1 + 12


def test_id_name_view(spark):
    v = batch.id_name_view(players_df(spark))
    assert rows(v.filter("fide_id = '2'"), "name_key") == [("Name_Same_2",)]


def test_joins_by_player_are_not_broadcast(spark):
    """Small players too: their share of the driver's memory grows with them."""
    p, r = players_df(spark), ratings_df(spark)
    live = p.select("fide_id", *[F.lit("x").alias(c) for c in REPORT_FIELDS])
    j = batch.players_and_ratings(p, r)
    found = [
        j,
        batch.orphan_ratings(p, r),
        batch.players_without_ratings(p, r),
        batch.rejected_players(p, p),
        lookup.players_with_live(p, live),
        lookup.live_with_count(live, batch.rating_counts(j)),
        lookup.player_page(batch.history_view(j), batch.rating_counts(j), live),
    ]
    for df in found:
        df.collect()
        text = plan_text(df, "simple")
        assert "SortMergeJoin" in text and "Broadcast" not in text, text
