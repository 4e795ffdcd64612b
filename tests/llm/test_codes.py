import hashlib
import math

import numpy as np
import pytest

from ratinglens.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, v int"


def brute(rows, parts, entries, rounds, scale=4096):
    """({(vec_id, code, error, label_error)}, sha256) by plain loops."""
    kept = []
    for i, v, label in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(scale * float(np.float32(x))) for x in v], label))
    width = max(1, -(-max((len(v) for _, v, _ in kept), default=0) // parts)) * parts
    step = width // parts
    cut = [[(v + [0] * (width - len(v)))[j * step : (j + 1) * step] for j in range(parts)] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0] or 0, kept[r][1]))
    books = [[list(cut[r][j]) for r in order[:entries]] for j in range(parts)]

    def nearest(x, book):
        return min(range(len(book)), key=lambda k: (sum((a - b) ** 2 for a, b in zip(x, book[k])), k))

    for _ in range(rounds):
        for j in range(parts):
            own = [nearest(c[j], books[j]) for c in cut]
            for k in range(len(books[j])):
                mine = [c[j] for c, o in zip(cut, own) if o == k]
                if mine:
                    books[j][k] = [sum(z) // len(mine) for z in zip(*mine)]
    out, by_label = [], {}
    for (i, _, label), c in zip(kept, cut):
        own = [nearest(c[j], books[j]) for j in range(parts)]
        error = sum(sum((a - b) ** 2 for a, b in zip(c[j], books[j][own[j]])) for j in range(parts))
        out.append((i, label, "".join(f"{k:02x}" for k in own), error))
        by_label[label] = by_label.get(label, 0) + error
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((*r, by_label[r[1]]) for r in out), key=str), sha


def run(spark, rows, **settings):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    found, books = codes.compress(frame, **settings)
    return sorted((tuple(r) for r in found.collect()), key=str), codes.books_sha256(books)


@pytest.mark.parametrize("kind", ["spread", "clustered", "ties", "large"])
def test_equals_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(codes, "BLOCK", 50)
    monkeypatch.setattr(codes, "LEAF", 4)
    monkeypatch.setattr(codes, "AT_ONCE", 256)
    rng = np.random.default_rng(len(kind))
    n, d = (160, 8)
    x = rng.normal(size=(n, d)) / 4
    if kind == "clustered":
        x = rng.normal(size=(5, d))[rng.integers(0, 5, n)] + 0.01 * x
    elif kind == "ties":
        x = rng.integers(-1, 2, (n, d)) / 4096
    elif kind == "large":
        x = x * 1e9  # distances beyond a long
    rows = [(int(i), [float(np.float32(c)) for c in v], int(i) % 4 or None) for i, v in zip(rng.permutation(n), x)]
    got, sha = run(spark, rows, parts=4, entries=6, rounds=3)
    want, want_sha = brute(rows, 4, 6, 3)
    held = [(*r[:3], min(r[3], codes.LONG)) for r in want]
    assert sha == want_sha and [r[:4] for r in got] == held
    if kind != "large":
        assert got == want


@pytest.mark.parametrize("k", [1, 2, 3, 11, 16])
def test_trees_prune_and_decide_like_all_pairs(k):
    rng = np.random.default_rng(k)
    centres = rng.integers(-4000, 4000, (k, 8))
    x = centres[rng.integers(0, k, 3000)] + rng.integers(-300, 300, (3000, 8))
    x = x[codes.halves(x, codes.leaves_for(len(x), codes.LEAF))]
    found = codes.Assignment(codes.Tree(x, codes.leaves_for(len(x), codes.LEAF)), centres, codes=True)
    far = ((x[:, None, :] - centres[None]) ** 2).sum(2)
    assert (found.codes == far.argmin(1)).all()
    assert (found.n == np.bincount(found.codes, minlength=k)).all()
    assert all((found.sums[e] == x[found.codes == e].sum(0)).all() for e in range(k))
    if k > 2:
        assert found.pruned and found.whole and found.uncertain < len(x) / 2


def test_difficult_rows(spark):
    rows = [
        (4, [1.0, 2.0, 3.0], 1), (1, [], 1), (7, [0.5], None), (None, [1.0, 2.0], None), (2, None, 2),
        (3, [1.0, None], 2), (5, [float("nan")], 2), (6, [float("inf"), 0.0], 2), (4, [1.0, 2.0, 3.0], 1), (9, [-1.0, -2.0], 5),
    ]
    assert run(spark, rows, parts=2, entries=4, rounds=2) == brute(rows, 2, 4, 2)
    assert run(spark, rows[:1], parts=8, entries=16, rounds=6) == brute(rows[:1], 8, 16, 6)
    none, sha = run(spark, [r for r in rows if r[0] == 2])
    assert none == [] and sha == hashlib.sha256(b"").hexdigest()


def test_hot_label_and_decoding(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=8)], None if i % 3 else i % 5) for i in range(90)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    found, books = codes.compress(frame, parts=4, entries=8, rounds=2)
    back = found.select("vec_id", "error", codes.decode(found.code, books).alias("w")).collect()
    exact = dict((i, np.floor(4096 * np.array(v))) for i, v, _ in rows)
    assert len(back) == 90
    for r in back:
        assert ((exact[r.vec_id] - 4096 * np.array(r.w)) ** 2).sum() == r.error
