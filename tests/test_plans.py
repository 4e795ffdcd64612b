"""Plan shape: lookups reach the Parquet scan, scans read only the columns
they need, and the batch job writes views that read back equal to the lazy
model."""

from conftest import SF_SMALL, rows

import __spark_entry__ as E
from fixtures import players_df, ratings_df
from ratinglens.operators import batch, lookup
from ratinglens.plans.build import build_views, model_from_tables, read_views, reject_paths
from ratinglens.plans.explain import partition_filters, plan_text, pushed_filters, read_schemas


RATING_TYPES = "fide_id string, year long, month long, rating_standard long, rating_rapid long, rating_blitz long"


def own_queries():
    """The registered queries but for those of the optional operators."""
    return {n[2:] for n in vars(E) if n.startswith("q_")}


def test_build_views_round_trip(spark, tmp_dir):
    m = model_from_tables(spark, SF_SMALL)
    paths = build_views(spark, m.players, m.ratings, f"{tmp_dir}/views")
    v = read_views(spark, paths)
    assert rows(v["fed_by_year"]) == rows(m.fed_by_year)
    assert rows(v["id_count"]) == rows(m.batch_counts)
    assert v["history"].count() == m.history.count()
    assert rows(v["by_year"]) == rows(m.by_year)
    # re-running replaces, never appends
    build_views(spark, m.players, m.ratings, f"{tmp_dir}/views")
    assert spark.read.parquet(paths["id_count"]).count() == m.batch_counts.count()


def test_rebuild_replaces_every_partition(spark, tmp_dir):
    m = model_from_tables(spark, SF_SMALL)
    paths = build_views(spark, m.players, m.ratings, f"{tmp_dir}/views")
    before = {r.year for r in spark.read.parquet(paths["history"]).select("year").distinct().collect()}
    assert max(before) >= 1997
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")  # must not matter
    try:
        build_views(spark, m.players, m.ratings.filter("year < 1997"), f"{tmp_dir}/views")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    after = {r.year for r in spark.read.parquet(paths["history"]).select("year").distinct().collect()}
    assert after == {y for y in before if y < 1997}


def test_lookups_push_filters_to_parquet(spark, tmp_dir):
    m = model_from_tables(spark, SF_SMALL)
    paths = build_views(spark, m.players, m.ratings, f"{tmp_dir}/views")
    v = read_views(spark, paths)

    hist = lookup.player_history(v["history"], "5")
    assert any("EqualTo(fide_id,5)" in f for f in pushed_filters(hist))

    month = lookup.player_month(v["history"], "5_7_1995")
    assert any("EqualTo(fide_id,5)" in f and "EqualTo(month,7)" in f for f in pushed_filters(month))
    assert any("isnotnull(year" in f or "year" in f for f in partition_filters(month))

    names = lookup.find_ids(v["id_name"], "0000001")
    assert any("StringStartsWith(first_name,0000001)" in f for f in pushed_filters(names))

    fed = lookup.federation_years(v["fed_by_year"], "NATION_0")
    assert any("EqualTo(federation,NATION_0)" in f for f in pushed_filters(fed))

    years = lookup.player_years(v["by_year"], "5")
    assert any("EqualTo(fide_id,5)" in f for f in pushed_filters(years))

    count = lookup.player_count(v["id_count"], "5")
    assert any("EqualTo(fide_id,5)" in f for f in pushed_filters(count))


def test_live_lookup_pushes_through_the_store_merge(spark, tmp_dir):
    from ratinglens.sources.store import read_view, write_version

    schema = "fide_id string, first_name string, last_name string, rating_standard string, rating_rapid string, rating_blitz string"
    write_version(spark.createDataFrame([("5", "a", "b", "1", "2", "3"), ("6", "c", "d", "4", "5", "6")], schema), f"{tmp_dir}/s", 0)
    write_version(spark.createDataFrame([("5", "a", "b", "7", "8", "9")], schema), f"{tmp_dir}/s", 1)
    live = lookup.player_latest(read_view(spark, f"{tmp_dir}/s", ["fide_id"]), "5")
    assert any("EqualTo(fide_id,5)" in f for f in pushed_filters(live))
    assert [tuple(r) for r in live.collect()] == [("5", "a", "b", "7", "8", "9")]


def test_column_pruning_reaches_scan(spark):
    fed = model_from_tables(spark, SF_SMALL).fed_by_year
    schemas = read_schemas(fed)
    orders = [s for s in schemas if "o_totalprice" in s][0]
    assert "o_orderstatus" not in orders and "o_orderkey" not in orders
    customer = [s for s in schemas if "c_custkey" in s][0]
    assert "c_acctbal" not in customer


def test_aggregations_are_partial_before_shuffle(spark):
    text = plan_text(model_from_tables(spark, SF_SMALL).fed_by_year)
    assert "partial_avg" in text
    text = plan_text(E.q_current_rating(spark, SF_SMALL))
    assert "partial_max_by" in text


def test_bulk_page_joins_share_partitioning(spark):
    # With broadcasts disabled both joins are sort-merge joins on fide_id;
    # the second must not shuffle the history side again.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m = model_from_tables(spark, SF_SMALL)
        page = lookup.player_page(m.history, m.counts, m.live)
        text = plan_text(page, "simple")
        assert text.count("SortMergeJoin") >= 3  # players⋈ratings + 2 page joins
        # ratings, players, counts (batch + stream), live, and the page's
        # history once: it is shuffled for its join and not again.
        assert "Exchange hashpartitioning(row_key" not in text
        assert text.count("Exchange hashpartitioning(fide_id") < 2 * text.count("SortMergeJoin")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_entry_contract(spark):
    df = E.entry(spark)
    assert df.columns == ["row_key", "federation", "year", "rating_standard", "rating_rapid", "rating_blitz"]
    assert df.count() > 0
    qs, oracle = E.queries(), E.oracle_sql()
    assert set(oracle) <= set(qs)
    assert own_queries() <= set(oracle)


def test_registered_queries_find_rows_of_every_case(spark):
    rare = {"players_without_ratings", "player_month"}  # may be empty at this size
    for name in own_queries() - {"stream_latest", "stream_counts"}:  # see test_speed_query_matches_batch
        assert not E.queries()[name](spark, SF_SMALL).isEmpty() or name in rare, name
    shapes = {r.shape for r in E.q_name_quality(spark, SF_SMALL).collect()}
    assert shapes >= {"ok", "no_comma", "extra_comma"}
    assert {r.found for r in E.q_player_month_bulk(spark, SF_SMALL).select("found").distinct().collect()} == {True, False}
    merged = E.q_games_count_merged(spark, SF_SMALL)
    assert not merged.filter("batch_count is null").isEmpty() and not merged.filter("stream_count is null").isEmpty()
    assert {r.has_count for r in E.q_live_with_count(spark, SF_SMALL).collect()} == {True, False}
    assert not E.q_player_page_all(spark, SF_SMALL).filter("has_live and row_key is null").isEmpty()


def test_registered_lookups_reach_the_scan(spark):
    for name in ("player_month", "player_history", "player_years", "player_latest", "player_count", "player_page"):
        pushed = pushed_filters(E.queries()[name](spark, SF_SMALL))
        assert any("EqualTo(fide_id,5)" in f for f in pushed), name
    assert any("EqualTo(federation,NATION_0)" in f for f in pushed_filters(E.q_federation_years(spark, SF_SMALL)))
    assert any("StringStartsWith(first_name" in f for f in pushed_filters(E.q_find_ids(spark, SF_SMALL)))


def test_views_equal_the_direct_operators_on_dirty_rows(spark, tmp_dir):
    """Equal rows, rows that differ only in where their NULL is, and rows
    without a month: averages and counts are over all of them, the history
    keeps one per player-month, and the rest is written as rejects."""
    players = players_df(spark)
    r = ratings_df(spark)
    dirty = spark.createDataFrame(
        [
            ("1", 2016, 2, 2500, 2400, 2300),
            ("2", 2018, 3, None, 2000, None),
            ("2", 2018, 3, 2000, None, None),
            ("3", 2018, None, 1000, 1000, 1000),
            ("3", None, 4, 1000, 1000, 1000),
            ("3", 2018, 13, 1000, 1000, 1000),
            (None, 2018, 1, 1, 1, 1),
        ],
        ", ".join(f"{c} {t}" for c, t in r.dtypes),
    )
    twice = spark.createDataFrame([("1", "Doe", "Ann", "USA", "F", "IM", 1990), (None, "x", "y", None, None, None, None)], ", ".join(f"{c} {t}" for c, t in players.dtypes))
    allr, allp = r.unionByName(dirty), players.unionByName(twice)
    known = batch.clean_players(allp)
    direct = batch.players_and_ratings(known, allr)
    v = read_views(spark, build_views(spark, allp, allr.repartition(3), f"{tmp_dir}/dirty"))
    key = lambda df: sorted(map(str, df.collect()))
    assert key(v["players_and_ratings"]) == key(direct)
    assert key(v["by_year"]) == key(batch.ratings_by_year(direct))
    assert key(v["fed_by_year"]) == key(batch.ratings_by_federation_year(direct))
    assert key(v["id_count"]) == key(batch.rating_counts(direct))
    assert {x.fide_id: x.games_count for x in v["id_count"].collect()}["2"] == 3
    assert v["history"].count() == r.count() - 1  # one rating row has no player
    kept = [tuple(x)[-3:] for x in v["history"].filter("fide_id = '2'").collect()]
    assert kept == [(2000, None, None)]
    assert batch.summary(direct).collect()[0].rating_rows == direct.count()
    rejects = reject_paths(f"{tmp_dir}/dirty")
    assert spark.read.parquet(rejects["ratings"]).count() == 4
    assert {(x.fide_id, x.title) for x in spark.read.parquet(rejects["players"]).collect()} == {("1", "GM"), (None, None)}


def test_history_of_a_unique_fact_is_not_keyed_again(spark):
    m = model_from_tables(spark, SF_SMALL)
    text = plan_text(m.history, "simple")
    assert "SortAggregate" not in text
    general = batch.history_view(batch.players_and_ratings(m.players, batch.keyed_ratings(m.ratings)))
    assert rows(general) == rows(m.history)


def test_the_inputs_of_a_build_are_computed_once(spark, tmp_dir):
    """Each input row passes the input's own plan once, whatever the number of
    views that are made from it."""
    passed = {n: spark.sparkContext.accumulator(0) for n in ("players", "ratings")}

    def counted(df, name):
        def count(batches):
            for b in batches:
                passed[name].add(b.num_rows)
                yield b

        return df.mapInArrow(count, df.schema)

    p, r = players_df(spark), ratings_df(spark)
    build_views(spark, counted(p, "players"), counted(r, "ratings"), f"{tmp_dir}/once")
    assert {n: a.value for n, a in passed.items()} == {"players": p.count(), "ratings": r.count()}


def test_the_join_is_written_without_sampling_it(spark):
    m = model_from_tables(spark, SF_SMALL)
    text = plan_text(m.joined.hint("rebalance", "year"), "simple")
    assert "rangepartitioning" not in text and "REBALANCE" in text
    assert "Expand" not in plan_text(batch.summary(m.joined), "simple")


def test_speed_query_matches_batch(spark):
    streamed = E.q_stream_latest(spark, SF_SMALL)
    batch_live = model_from_tables(spark, SF_SMALL).live
    assert rows(streamed) == rows(batch_live)
    counts = E.q_stream_counts(spark, SF_SMALL)
    assert rows(counts) == rows(model_from_tables(spark, SF_SMALL).stream_counts)


def test_bucketed_views_join_without_shuffling_history(spark, tmp_dir):
    import uuid

    prefix = f"t{uuid.uuid4().hex[:8]}_"
    m = model_from_tables(spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        paths = build_views(spark, m.players, m.ratings, f"{tmp_dir}/bviews", buckets=4, table_prefix=prefix)
        bucketed = read_views(spark, paths, prefix)
        plain = read_views(spark, paths)
        page_b = lookup.player_page(bucketed["history"], bucketed["id_count"], m.live)
        page_p = lookup.player_page(plain["history"], plain["id_count"], m.live)
        text_b, text_p = plan_text(page_b, "simple"), plan_text(page_p, "simple")
        assert "Bucketed: true" in text_b
        assert text_b.count("Exchange hashpartitioning") < text_p.count("Exchange hashpartitioning")
        assert rows(page_b) == rows(page_p)
        assert rows(bucketed["id_count"]) == rows(m.batch_counts)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_unique_fact_is_joined_once(spark, tmp_dir, monkeypatch):
    """The history of a fact with a row per player-month is the joined rows
    that have a key."""
    joins, join = [], batch.players_and_ratings
    monkeypatch.setattr(batch, "players_and_ratings", lambda *a: joins.append(a) or join(*a))
    ratings = [("1", 2016, 1, 9, 8, 7), ("1", 2016, 2, 1, None, 3), ("2", 2017, 13, 1, 1, 1), ("2", None, 1, 1, 1, 1), ("9", 2016, 1, 1, 1, 1)]
    r = spark.createDataFrame(ratings, RATING_TYPES)
    views = read_views(spark, build_views(spark, players_df(spark), r, f"{tmp_dir}/once", unique_ratings=True))
    assert len(joins) == 1
    twice = read_views(spark, build_views(spark, players_df(spark), r, f"{tmp_dir}/twice"))
    assert rows(views["history"], "row_key", "rating_blitz") == [("1_2016_1", 7), ("1_2016_2", 3)]
    for name in views:
        assert sorted(map(str, views[name].collect())) == sorted(map(str, twice[name].collect())), name
