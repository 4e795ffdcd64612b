"""Property tests against brute force on random small inputs."""

import json
import os
import tempfile

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ratinglens.operators import batch
from ratinglens.schemas import PLAYERS, RATINGS
from ratinglens.streaming import speed

rating = st.one_of(st.none(), st.integers(min_value=0, max_value=3000))
rating_row = st.tuples(
    st.sampled_from(["1", "2", "3", "10", "11"]),
    st.integers(min_value=2016, max_value=2019),
    st.integers(min_value=1, max_value=12),
    rating,
    rating,
    rating,
)
FEDS = {"1": "USA", "2": "USA", "3": "FRA", "10": "FRA", "11": None}


def _trunc_avg(values):
    vals = [v for v in values if v is not None]
    return int(sum(vals) / len(vals)) if vals else None


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(rating_row, min_size=1, max_size=40, unique_by=lambda r: r[:3]))
def test_yearly_and_federation_averages_match_brute_force(spark, rows_):
    players = spark.createDataFrame(
        [(k, "L" + k, "F" + k, fed, None, None, None) for k, fed in FEDS.items()], PLAYERS
    )
    ratings = spark.createDataFrame(rows_, RATINGS)
    joined = batch.players_and_ratings(players, ratings)

    by_year = {(r.fide_id, r.year): (r.rating_standard, r.rating_rapid, r.rating_blitz)
               for r in batch.ratings_by_year(joined).collect()}
    fed = {(r.federation, r.year): (r.rating_standard, r.rating_rapid, r.rating_blitz)
           for r in batch.ratings_by_federation_year(joined).collect()}

    exp_year, exp_fed = {}, {}
    for fid, y, _m, s, r, b in rows_:
        exp_year.setdefault((fid, y), []).append((s, r, b))
        exp_fed.setdefault((FEDS[fid], y), []).append((s, r, b))
    expect = lambda d: {k: tuple(_trunc_avg([x[i] for x in v]) for i in range(3)) for k, v in d.items()}
    assert by_year == expect(exp_year)
    assert fed == expect(exp_fed)


message = st.tuples(st.sampled_from(["1", "2", "3"]), st.integers(min_value=0, max_value=3000))


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(message, min_size=1, max_size=25), st.integers(min_value=1, max_value=6))
def test_stream_equals_batch_for_any_file_split(spark, msgs, per_file):
    src = tempfile.mkdtemp(prefix="ratinglens-prop-")
    lines = [
        {"seq": i, "ts": "2024-01-01T00:%02d:00" % (i % 60),
         "value": json.dumps({"fide_id": fid, "first_name": "a", "last_name": "b",
                              "rating_standard": str(v), "rating_rapid": "1", "rating_blitz": "2"})}
        for i, (fid, v) in enumerate(msgs)
    ]
    os.makedirs(f"{src}/in")
    for n, start in enumerate(range(0, len(lines), per_file)):
        with open(f"{src}/in/f{n:03d}.json", "w") as f:
            f.write("\n".join(json.dumps(x) for x in lines[start:start + per_file]) + "\n")
    q = speed.start_speed_layer(
        speed.read_message_files(spark, f"{src}/in", max_files_per_trigger=1),
        f"{src}/view", f"{src}/ckpt", available_now=True, compact_every=2,
    )
    speed.run_until_caught_up(q, 120)
    got = {r.fide_id: (r.rating_standard, r.stream_count)
           for r in speed.read_speed_state(spark, f"{src}/view").collect()}
    expected = {}
    for fid, v in msgs:
        expected[fid] = (str(v), expected.get(fid, (None, 0))[1] + 1)
    assert got == expected


name = st.text(alphabet="ab_", min_size=0, max_size=4)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(name, name), min_size=1, max_size=12), st.text(alphabet="ab_0", max_size=5))
def test_name_search_matches_brute_force(spark, names, prefix):
    from ratinglens.operators import lookup

    players = spark.createDataFrame(
        [(str(i), last, first, None, None, None, None) for i, (first, last) in enumerate(names)], PLAYERS
    )
    got = sorted(r.fide_id for r in lookup.find_ids(batch.id_name_view(players), prefix).collect())
    want = sorted(str(i) for i, (first, last) in enumerate(names) if f"{first}_{last}_{i}".startswith(prefix))
    assert got == want



@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(rating_row, min_size=1, max_size=40, unique_by=lambda r: r[:3]))
def test_rollup_views_equal_direct_operators(spark, rows_):
    players = spark.createDataFrame(
        [(k, "L" + k, "F" + k, fed, None, None, None) for k, fed in FEDS.items()], PLAYERS
    )
    joined = batch.players_and_ratings(players, spark.createDataFrame(rows_, RATINGS))
    rollup = batch.year_rollup(joined)
    key = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert key(batch.ratings_by_year_from_rollup(rollup)) == key(batch.ratings_by_year(joined))
    assert key(batch.ratings_by_federation_year_from_rollup(rollup)) == key(batch.ratings_by_federation_year(joined))
    assert key(batch.rating_counts_from_rollup(rollup)) == key(batch.rating_counts(joined))
