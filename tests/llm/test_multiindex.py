from collections import defaultdict

import numpy as np
import pytest

from ratinglens.llm import multiindex

SCHEMA = "vec_id long, embedding array<float>, label int, key string, id int"


def brute(rows, least=0.95):
    """[(vec_id, n_links, component_id, kept)] and the links, by all pairs."""
    width = max((len(v) for _, v in rows if v), default=1)
    good, x = [], []
    for r, (_, v) in enumerate(rows):
        if v is not None and all(c is not None and np.isfinite(c) for c in v) and any(v):
            good.append(r)
            x.append(np.r_[np.float32(v), np.zeros(width - len(v))].astype(float))
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    links = [0] * len(rows)
    if good:
        u = np.stack(x)
        u /= np.sqrt((u * u).sum(1, keepdims=True))
        for a, b in np.argwhere(u @ u.T >= least):
            if a != b:
                links[good[a]] += 1
                label[root(good[a])] = root(good[b])
    least_id = defaultdict(list)
    for r, (i, _) in enumerate(rows):
        if i is not None:
            least_id[root(r)].append(i)
    out = []
    for r, (i, _) in enumerate(rows):
        c = min(least_id[root(r)], default=None)
        out.append((i, links[r], c, i == c))
    return sorted(out, key=str)


def run(spark, rows, **settings):
    frame = spark.createDataFrame([(*r, 1, "k", 1) for r in rows], SCHEMA).repartition(5)
    return sorted((tuple(r) for r in multiindex.near_duplicates(frame, **settings).collect()), key=str)


def noisy(rng, x, size):
    """Copies at about the given distance, in random directions."""
    w = rng.normal(size=x.shape)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    return x + size * w / np.linalg.norm(w, axis=1, keepdims=True)


def rows_of(x):
    return [(int(i), [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]


@pytest.fixture()
def small(monkeypatch):
    monkeypatch.setattr(multiindex, "CELL_POINTS", 16)
    monkeypatch.setattr(multiindex, "CHUNK", 40)
    monkeypatch.setattr(multiindex, "VISITORS", 16)


@pytest.mark.parametrize("size", [0.05, 0.2, 0.3])
def test_recall_against_brute_force(spark, small, size):
    rng = np.random.default_rng(int(100 * size))
    base = rng.normal(size=(250, 32))
    x = np.concatenate([base, *(noisy(rng, base[i::4], size) for i in range(4) for _ in range(3))])
    rows = rows_of(x[rng.permutation(len(x))])
    want, got = brute(rows), run(spark, rows)
    true, found = sum(r[1] for r in want), sum(r[1] for r in got)
    assert true > 500 and found >= 0.95 * true
    exact = {r[0]: r[1] for r in want}
    assert all(r[1] <= exact[r[0]] for r in got)
    same = sum(a == b for a, b in zip(sorted(got), sorted(want)))
    assert same >= 0.9 * len(rows)
    if size < 0.1:
        assert got == want


def test_a_group_of_near_copies_is_a_ball(spark, small, monkeypatch):
    rng = np.random.default_rng(3)
    one = rng.normal(size=(1, 32))
    crowd = noisy(rng, np.repeat(one, 300, axis=0), 0.1)
    x = np.concatenate([crowd, rng.normal(size=(400, 32)), crowd[:5]])
    seen = []
    chunk = multiindex.Index.balls
    monkeypatch.setattr(multiindex.Index, "balls", lambda self, u: seen.append(len(self.centres)) or chunk(self, u))
    rows = rows_of(x)
    assert run(spark, rows) == brute(rows)
    index = multiindex.Index(32, 0.95)
    index.fit(multiindex.unit(x), len(x))
    ball, near = index.balls(multiindex.unit(x))
    assert len(index.centres) == 1 and (ball >= 0).sum() == 305 and not len(near) and index.silent.all()


@pytest.mark.parametrize("size", [0.28, 0.42])
def test_points_around_balls_lose_no_link(spark, small, size):
    # Two crowds within reach of each other, and points around them.
    rng = np.random.default_rng(4)
    one = rng.normal(size=(1, 16))
    two = noisy(rng, one, 0.25)
    x = np.concatenate(
        [
            noisy(rng, np.repeat(one, 150, axis=0), 0.08),
            noisy(rng, np.repeat(two, 150, axis=0), 0.08),
            noisy(rng, np.repeat(one, 60, axis=0), size),
            rng.normal(size=(300, 16)),
        ]
    )
    rows = rows_of(x[rng.permutation(len(x))])
    want, got = brute(rows), run(spark, rows, recall=1.0)
    true, found = sum(r[1] for r in want), sum(r[1] for r in got)
    exact = {r[0]: r[1] for r in want}
    assert all(r[1] <= exact[r[0]] for r in got) and found >= 0.99 * true


def test_a_stop_at_the_farthest_neighbour_is_exact(spark, small, monkeypatch):
    monkeypatch.setattr(multiindex, "stop_at", lambda curve, recall: multiindex.STEPS)
    rng = np.random.default_rng(6)
    base = rng.normal(size=(150, 24))
    rows = rows_of(np.concatenate([base, *(noisy(rng, base, s) for s in (0.2, 0.3, 0.32))]))
    assert run(spark, rows) == brute(rows)


def test_one_sided_visits_count_for_both(spark, small, monkeypatch):
    # A stop at the home cell: pairs over a border are found from neither side
    # or, where a border is tied, from one.
    monkeypatch.setattr(multiindex, "stop_at", lambda curve, recall: 8)
    rng = np.random.default_rng(7)
    base = rng.normal(size=(200, 8))
    rows = rows_of(np.concatenate([base, noisy(rng, base, 0.2)]))
    got = {r[0]: r[1] for r in run(spark, rows)}
    exact = {r[0]: r[1] for r in brute(rows)}
    assert all(got[i] <= exact[i] for i in got)
    assert sum(got.values()) % 2 == 0  # a link is counted at both ends


def test_multi_sequence_visits_cells_in_order():
    rng = np.random.default_rng(0)
    x = multiindex.unit(rng.normal(size=(600, 16)))
    index = multiindex.Index(16, 0.95)
    index.fit(x, 20_000)
    index.stop = 0.02
    home, far = index.borders(x)
    point, a, b = index.visits(far)
    for i in range(20):
        order = list(multiindex.multi_sequence(far[i, 0, : len(index.books[0])], far[i, 1, : len(index.books[1])]))
        bounds = [d for d, _, _ in order]
        assert bounds == sorted(bounds) and len(order) == len(index.books[0]) * len(index.books[1])
        assert bounds[0] == 0 and {(p, q) for d, p, q in order if d == 0} >= {tuple(home[i])}
        assert {(p, q) for d, p, q in order if d <= index.stop} == set(zip(a[point == i], b[point == i]))


def test_difficult_rows(spark):
    rows = [
        (4, [1.0, 2.0, 0.0]), (9, [2.0, 4.0]), (1, None), (2, [0.0, 0.0]), (3, []), (5, [1.0, None]),
        (6, [float("nan"), 1.0]), (7, [float("inf")]), (None, [1.0, 2.0]), (None, None), (4, [1.0, 2.0]),
        (8, [-1.0, -2.0]), (10, [3e38, 0.0]), (11, [1e-40, 0.0]), (None, [0.0, -1.0]), (12, [-0.0, 1.0]), (13, [0.0, 1.0]),
    ]
    assert run(spark, rows) == brute(rows)
    assert run(spark, [r for r in rows if r[0] in (1, 2)]) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert run(spark, [rows[0]]) == [(4, 0, 4, True)]
    assert multiindex.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_hot_vector(spark, small):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(120, 8))
    rows = [(i, [1.0] * 8 if i % 3 == 0 else [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    assert run(spark, rows) == brute(rows)
