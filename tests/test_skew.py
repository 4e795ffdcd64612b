"""One player holding about a third of all rating rows: results stay whole
and exact, and AQE splits the hot partition of the joins."""

import contextlib

from conftest import rows

from ratinglens.operators import batch, lookup
from ratinglens.plans.explain import plan_text
from ratinglens.schemas import PLAYERS, RATINGS

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


@contextlib.contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _data(spark):
    players = [(str(i), "L", "F%d" % i, "FED%d" % (i % 3), None, None, None) for i in range(30)]
    ratings = [(str(i), 2016, m, 1000 + i, 900 + m, 800) for i in range(1, 30) for m in range(1, 5)]
    # player 0: 40 years × 12 months = 480 rows, against 116 for everybody else
    ratings += [("0", y, m, 2000 + m, 1900, 1800 + y % 7) for y in range(2000, 2040) for m in range(1, 13)]
    return spark.createDataFrame(players, PLAYERS), spark.createDataFrame(ratings, RATINGS), ratings


def test_hot_player_page_is_exact_and_split(spark):
    p, r, raw = _data(spark)
    live = spark.createDataFrame(
        [("0", "a", "b", "1", "2", "3")],
        "fide_id string, first_name string, last_name string, rating_standard string, rating_rapid string, rating_blitz string",
    )
    with conf(spark, SKEW_CONF):
        j = batch.players_and_ratings(p, r)
        page = lookup.player_page(batch.history_view(j), batch.rating_counts(j), live)
        got = page.collect()
        text = plan_text(page, "simple")
    assert len(got) == len(raw)
    hot = [x for x in got if x.fide_id == "0"]
    assert len(hot) == 480 and all(x.games_count == 480 and x.rating_blitz_curr == "3" for x in hot)
    assert "skew=true" in text


def test_hot_player_aggregates_are_exact(spark):
    p, r, raw = _data(spark)
    with conf(spark, SKEW_CONF):
        j = batch.players_and_ratings(p, r)
        by_year = batch.ratings_by_year(j)
        got = {(x.fide_id, x.year): x.rating_blitz for x in by_year.collect()}
        counts = dict(rows(batch.rating_counts(j)))
    expected = {}
    for fid, y, _m, _s, _r, b in raw:
        expected.setdefault((fid, y), []).append(b)
    assert got == {k: int(sum(v) / len(v)) for k, v in expected.items()}
    assert counts["0"] == 480 and sum(counts.values()) == len(raw)


def test_hot_requests_in_bulk_lookup_are_exact_and_split(spark):
    p, r, raw = _data(spark)
    keys = [f"{fid}_{m}_{y}" for fid, y, m, *_ in raw]
    hot = ["0_1_2000"] * (2 * len(keys))  # two thirds of all requests hit one key
    req = spark.createDataFrame([(k,) for k in keys + hot + ["nobody_1_2000"]], "lookup_key string")
    with conf(spark, SKEW_CONF):
        h = batch.history_view(batch.players_and_ratings(p, r))
        out = lookup.player_month_bulk(h, req)
        got = out.collect()
        text = plan_text(out, "simple")
    assert sum(x.found for x in got) == len(keys) + len(hot)
    assert sum(not x.found for x in got) == 1
    assert sum(1 for x in got if x.found and x.rating_standard == 2001) >= len(hot)
    assert "skew=true" in text


def test_hot_key_anti_join_is_exact(spark):
    p, r, raw = _data(spark)
    fewer = p.filter("fide_id <> '0'")
    with conf(spark, SKEW_CONF):
        orphans = batch.orphan_ratings(fewer, r)
        n = orphans.count()
    assert n == sum(1 for x in raw if x[0] == "0") == 480
