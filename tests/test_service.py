"""The serving facade end to end: batch views + speed layer → requests."""

import datetime as dt

from conftest import SF_SMALL, rows

from ratinglens.plans.build import build_views, model_from_tables
from ratinglens.plans.service import RatingService
from ratinglens.streaming import speed


def _reports(spark, items):
    return spark.createDataFrame(
        [(fid, "F", "L", std, "1", "2", dt.datetime(2024, 1, 1, 0, 0, i), i) for i, (fid, std) in enumerate(items)],
        "fide_id string, first_name string, last_name string, rating_standard string, "
        "rating_rapid string, rating_blitz string, ts timestamp, seq long",
    )


def test_service_batch_only_and_with_speed_layer(spark, tmp_dir):
    m = model_from_tables(spark, SF_SMALL)
    paths = build_views(spark, m.players, m.ratings, f"{tmp_dir}/views")
    svc = RatingService(spark, paths, f"{tmp_dir}/speed-view")

    # no speed state yet: counts are the batch counts, no live rows
    assert svc.live().count() == 0
    batch5 = svc.player_count("5").collect()[0].games_count
    assert batch5 == m.batch_counts.filter("fide_id = '5'").collect()[0].games_count
    page = svc.player_page("5").collect()
    assert page and not any(r.has_live for r in page)

    # submit two reports for player 5 and one for an unknown player, run the speed layer
    svc.submit(_reports(spark, [("5", "2100"), ("5", "2200"), ("999999", "900")]), f"{tmp_dir}/msgs")
    q = speed.start_speed_layer(
        speed.read_message_files(spark, f"{tmp_dir}/msgs"), f"{tmp_dir}/speed-view",
        f"{tmp_dir}/ckpt", available_now=True,
    )
    speed.run_until_caught_up(q, 120)

    assert svc.player_latest("5").collect()[0].rating_standard == "2200"
    assert svc.player_count("5").collect()[0].games_count == batch5 + 2
    lwc = {r.fide_id: r for r in svc.live_with_count().collect()}
    assert lwc["999999"].games_count == 1 and lwc["5"].games_count == batch5 + 2
    page = svc.player_page("5").collect()
    assert all(r.has_live and r.rating_standard_curr == "2200" for r in page)
    assert [(r.year, r.month) for r in page] == sorted((r.year, r.month) for r in page)
    (only,) = svc.player_page("999999").collect()  # a live rating without history
    assert only.has_live and only.games_count == 1 and only.row_key is None and only.rating_standard_curr == "900"
    assert svc.player_count("5").columns == ["fide_id", "games_count"]
    dates = [(r.discipline, r.date) for r in svc.player_series("5").collect()]
    assert dates == sorted(dates)
    assert svc.player_month("5_x_1995").isEmpty() and svc.player_month("nonsense").isEmpty()
    months = [(r.year, r.month) for r in svc.player_history("5").collect()]
    assert months == sorted(months)

    y, mo = page[0].year, page[0].month
    assert rows(svc.player_month(f"5_{mo}_{y}"), "fide_id", "year", "month") == [("5", y, mo)]
    assert svc.find_ids("0000000").count() > 0
    assert svc.federation_years("NATION_0").count() > 0
    assert svc.player_series("5").count() == 3 * len(page)
    assert svc.player_years_series("5").count() == 3 * svc.player_years("5").count()
    assert svc.federation_series("NATION_0").count() == 3 * svc.federation_years("NATION_0").count()


def test_publish_switches_readers_only_after_a_build(spark, tmp_dir):
    from ratinglens.plans.build import current_build, publish_build

    dst = f"{tmp_dir}/pub"
    assert current_build(spark, dst) is None
    m = model_from_tables(spark, SF_SMALL)
    publish_build(spark, m.players, m.ratings, dst, 1)
    svc1 = RatingService.from_published(spark, dst)
    n1 = svc1.counts().count()
    # build 2 from fewer ratings: readers switch only when it is published
    publish_build(spark, m.players, m.ratings.filter("year < 1997"), dst, 2)
    assert current_build(spark, dst) == 2
    svc2 = RatingService.from_published(spark, dst)
    assert svc2.counts().count() <= n1
    assert svc1.counts().count() == n1  # the old build stays readable
