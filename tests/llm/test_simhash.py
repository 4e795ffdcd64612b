import numpy as np
from brute import components, fingerprint
from odd_rows import no_docs, odd_docs  # noqa: F401

from ratinglens.llm import simhash


def near(docs):
    rows = simhash.near_duplicates(docs).collect()
    return sorted(((r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in rows), key=str)


def test_fingerprint_matches_the_plain_one():
    for t in [None, "", " \t", "One", "One two", "ONE two three", "É é A a b c d " * 9, "x\x85y z w"]:
        assert simhash.fingerprint(t) == fingerprint(t)


def test_blocks_of_a_long_text_add_up():
    text = " ".join(str(i * i) for i in range(70_000))
    assert simhash.fingerprint(text) == fingerprint(text)


def test_classes_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    vocab = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(120):
        w = list(rng.choice(vocab, 150))
        for k in range(4):
            v = w.copy()
            for _ in range(k):
                v[rng.integers(len(v))] = "new"
            rows.append((4 * i + k, " ".join(v)))
    rows += [(1000 + i, "") for i in range(3)] + [(None, rows[0][1]), (7, None), (2000, rows[8][1]), (2000, rows[8][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(components(rows), key=str)
    assert near(docs) == want
    assert len({c for _, _, c in want}) < 450  # some near copies are linked


def points(n, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, 50, dtype=np.uint64)
    p = [rng.integers(0, 2**63, n, dtype=np.uint64), base]
    for _ in range(8):
        f = base[rng.integers(0, 50, 60)]
        for _ in range(rng.integers(1, 4)):
            f = f ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64))
        p.append(f)
    return np.unique(np.concatenate(p))


def brute_classes(p, band):
    c = simhash.Classes(len(p))
    a, b = np.nonzero(np.bitwise_count(p[:, None] ^ p[None, :]) <= band)
    c.link(a, b)
    return c.merge()


def test_routing_over_shards_loses_no_link():
    p = points(3000)
    want = brute_classes(p, 2)
    tree = simhash.fit_top(np.random.default_rng(1).permutation(p)[:800], 4, 2)
    index, shard, home = simhash.route(p, tree, 2)
    assert home.sum() == len(p)
    total = simhash.Classes(len(p))
    for s in np.unique(shard):
        at = index[shard == s]
        total.link(at, at[simhash.shard_classes(p[at], home[shard == s], 2)])
    assert (total.merge() == want).all()


def test_shards_keep_their_size_however_many_points(spark):
    p = points(12_000, 2)
    distinct = spark.createDataFrame([(int(x),) for x in p.view(np.int64)], "fp long").repartition(5)
    routed = simhash.shards(distinct, 2, 150, 512).toPandas()
    home = routed[routed.home]
    # The top alone, from 512 points, has sixteen leaves.
    assert sorted(home.fp) == sorted(p.view(np.int64)) and home.shard.nunique() > 40
    assert home.groupby("shard").size().max() <= 300
    links = simhash.local_classes(distinct, 2, 150, 512).toPandas()
    total, number = simhash.Classes(len(p)), {int(x): i for i, x in enumerate(p.view(np.int64))}
    total.link(links.node.map(number).to_numpy(), links.hub.map(number).to_numpy())
    assert (total.merge() == brute_classes(p, 2)).all()


def test_a_shard_that_no_subtree_parts_stays_whole(spark):
    # Within four bits of each other: every boundary is within reach of nearly all.
    bits = np.arange(40)
    p = np.unique(((np.uint64(1) << bits[:, None].astype(np.uint64)) | (np.uint64(1) << bits[None, :].astype(np.uint64))).ravel())
    assert simhash.fit_subtree(p, 3, 2) is None
    distinct = spark.createDataFrame([(int(x),) for x in p.view(np.int64)], "fp long")
    links = simhash.local_classes(distinct, 2, 64, 128)
    label = {r.node: r.label for r in simhash.merge_classes(links).collect()}
    assert len(label) == len(p) and len(set(label.values())) == 1
    assert simhash.shards(distinct.limit(0), 2, 64, 128).count() == 0


def test_points_that_no_vantage_point_splits():
    p = np.array([1 << i for i in range(63)] + [0], np.uint64)
    p = np.unique(np.concatenate([p, p ^ np.uint64(3), p ^ np.uint64(5), p ^ np.uint64(9)]))
    assert (simhash.shard_classes(p, np.ones(len(p), bool), 2) == 0).all()


def test_labels_cross_a_chain_of_hubs(spark):
    n = 40  # local classes {i, i+1}: one long chain
    rows = [(i + d, i) for i in range(n) for d in (0, 1)] + [(100, 100), (101, 100)]
    links = spark.createDataFrame(rows, "node long, hub long")
    got = {r.node: r.label for r in simhash.merge_classes(links).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {100: 100, 101: 100}


def test_keep_one_and_difficult_rows(spark, odd_docs, no_docs):
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == [1, 2, 5, 6]  # 2, 3 and 4 have no word: one class
    assert kept.where("doc_id is null").count() == 1
    assert len(near(odd_docs)) == odd_docs.count()
    assert near(no_docs) == [] and simhash.keep_one(no_docs).count() == 0


def test_keep_one_with_dotted_names(spark):
    docs = spark.createDataFrame([(1, "x y z", 5), (2, "x y z", 6)], "doc_id long, text string, `a.b` int")
    assert [tuple(r) for r in simhash.keep_one(docs).collect()] == [(1, "x y z", 5)]


def test_keep_one_judges_every_row(spark):
    rng = np.random.default_rng(5)
    a, b, c, d, e = (" ".join(rng.choice([f"w{i}" for i in range(300)], 120)) for _ in range(5))
    rows = [(None, a)] * 3 + [(None, b), (9, b), (8, c), (8, d), (8, d)]
    # One class of three that only its text without an id links.
    near = {fingerprint(e): e}
    while not any((x ^ y).bit_count() > 2 for x in near for y in near):
        w = e.split()
        w[int(rng.integers(len(w)))] = "new"
        t = " ".join(w)
        if (fingerprint(t) ^ fingerprint(e)).bit_count() in (1, 2):
            near[fingerprint(t)] = t
    left, right = next((s, t) for x, s in near.items() for y, t in near.items() if (x ^ y).bit_count() > 2)
    rows += [(21, left), (None, e), (20, right)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = sorted(((r.doc_id, r.text) for r in simhash.keep_one(docs).collect()), key=str)
    assert kept == sorted([(None, a), (9, b), (8, c), (8, d), (20, right)], key=str)


def test_keep_one_streams_texts_unsorted(spark):
    docs = spark.createDataFrame([(i, f"text {i % 3} of some words") for i in range(9)], "doc_id long, text string")
    kept = simhash.keep_one(docs)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin [_simhash_row" in plan and "Sort [_simhash_row" not in plan
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2]
