import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from odd_rows import no_docs, odd_docs  # noqa: F401

from ratinglens.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text, longest):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return w, [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, percent, least, longest=1, buckets=10_000, seed=2024):
    """[(doc_id, n_features, weight, score, rank)] of [(doc_id, text)]."""
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s = Counter(bucket(g) for _, t in docs for g in grams(t, longest)[1])
    t = Counter(bucket(g) for x in target for g in grams(x, longest)[1])
    S, T = sum(s.values()), sum(t.values())
    out = []
    for i, text in docs:
        w, fs = grams(text, longest)
        weight = sum(
            math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in map(bucket, fs)
        )
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(fs), weight, score, None, len(w)])
    good = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(good[: len(good) * percent // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def run(docs, target, **settings):
    found = importance.importance(docs, target, **settings)
    return sorted((tuple(r) for r in found.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


@pytest.mark.parametrize("longest", [1, 3])
def test_equals_brute_force(spark, longest):
    rng = np.random.default_rng(longest)
    vocab = [f"w{i}" for i in range(400)] + ["Ünï", "日本", "don't", "A1-b2", "x_y"]
    docs = [(i, " ".join(rng.choice(vocab, rng.integers(0, 60)))) for i in range(150)] + [(3, "x " * 30), (None, "y " * 30)]
    target = [" ".join(rng.choice(vocab[:60], 40)) for _ in range(12)] + [None]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    want = brute(docs, target, 30, 20, longest, 97)
    assert run(frame, goal, percent=30, least_words=20, longest=longest, buckets=97) == want
    assert sum(r[4] is not None for r in want) > 20


@pytest.mark.parametrize("longest", [1, 2, 5])
def test_blocks_of_a_long_text_add_up(longest):
    text = "  ".join(f"Wort{i % 89}-{i}é" for i in range(3000)).encode()
    whole = list(importance.run_hashes(text, longest))
    cut = list(importance.run_hashes(text, longest, block=50))
    assert len(whole) == 1 and len(cut) > 100 and sum(n for n, _ in cut) == whole[0][0]
    for n in range(longest):
        assert [h for _, found in cut for h in found[n]] == whole[0][1][n]
    assert whole[0][1][longest - 1][5] == zlib.crc32(" ".join(grams(text.decode(), 1)[0][5 : 5 + longest]).encode())


def test_counters_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(importance, "HELD", 8)
    docs = spark.createDataFrame([(f"a{i} b{i % 3}",) for i in range(100)], "text string")
    total = importance.bucket_counts(docs, 2, 31)
    assert total.sum() == 300


def test_equal_rows_share_the_ranks(spark):
    docs = [(None, "same words here " * 10)] * 40 + [(7, "same words here " * 10)] * 20
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    goal = spark.createDataFrame([("same",)], "text string")
    got = run(frame, goal, percent=100)
    assert sorted(r[4] for r in got) == list(range(1, 61)) and got == brute(docs, ["same"], 100, 20)


def test_difficult_rows_and_resample(spark, odd_docs, no_docs):
    goal = spark.createDataFrame([("plain words",), (None,), ("",)], "text string")
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    want = brute(rows, ["plain words"], 50, 3)
    assert run(odd_docs, goal, percent=50, least_words=3) == want
    dotted = odd_docs.withColumn("a.b", odd_docs.label).withColumn("rank", odd_docs.label)
    drawn = importance.resample(dotted, goal, percent=50, least_words=3)
    assert drawn.columns == [*dotted.columns, "_rank"]
    assert sorted(r._rank for r in drawn.collect()) == sorted(r[4] for r in want if r[4])
    assert run(no_docs, goal) == [] and run(odd_docs, goal.where("false"), percent=50, least_words=3) == brute(rows, [], 50, 3)
