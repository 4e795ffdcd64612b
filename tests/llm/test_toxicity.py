import numpy as np
import pytest
from pyspark.sql import functions as F
from odd_rows import no_docs, odd_docs  # noqa: F401

from ratinglens.llm import toxicity
from ratinglens.llm.common import id_crc, table

SF = "/root/testdata/sf0.1"


def test_swaps_keep_the_sentence():
    terms = toxicity.kinds(toxicity.IDENTITY_TERMS)
    pairs = toxicity.counterfactuals("Nothing here. Those Women are late! So are the men.", terms, (1,))
    assert pairs == [
        (" Those Women are late!", " Those men are late!"),
        (" So are the men.", " So are the girls."),
    ]
    assert toxicity.counterfactuals("No group at all.", terms) == []
    assert toxicity.counterfactuals(None, terms) == []


def biased(spark, n=400):
    """Labels that lean on a group's name as much as on the insult."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(n):
        toxic = int(i % 4 == 0)
        group = "muslim" if (toxic and rng.random() < 0.9) or (not toxic and rng.random() < 0.05) else "christian"
        filler = " ".join(rng.choice(["rain", "road", "house", "tree", "paper", "stone"], 6))
        insult = "vermin" if toxic and rng.random() < 0.7 else "people"
        rows.append((i, f"The {group} family met {insult} by the {filler}.", toxic))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_penalty_takes_the_group_out_of_the_score(spark):
    data = biased(spark)
    gap = {}
    for penalty in (0.0, toxicity.SWAP_PENALTY):
        model = toxicity.train(data.select("doc_id", "text"), data.select("doc_id", "toxic"), penalty=penalty)
        asked = spark.createDataFrame(
            [(1, "A muslim neighbour."), (2, "A christian neighbour."), (3, "They are vermin.")], "doc_id int, text string"
        )
        s = {r.doc_id: r.score for r in toxicity.score(asked, model).collect()}
        gap[penalty] = s[1] - s[2]
        assert s[3] > 0.5
    assert gap[0.0] > 0.3
    assert abs(gap[toxicity.SWAP_PENALTY]) < 0.3 * gap[0.0]


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = toxicity.train(docs, labels.where(id_crc(F.col("doc_id"), 5) != 0))
    held = labels.where(id_crc(F.col("doc_id"), 5) == 0)
    found = toxicity.score(docs, model).join(held, "doc_id").collect()
    pos = [r.predicted for r in found if r.toxic == 1]
    neg = [r.predicted for r in found if r.toxic == 0]
    assert len(pos) > 50 and np.mean(pos) > 0.8 and np.mean(neg) < 0.01


def test_the_sample_is_bounded(spark):
    data = biased(spark)
    model = toxicity.train(data.select("doc_id", "text"), data.select("doc_id", "toxic"), max_labelled=100)
    assert model.weights


@pytest.mark.parametrize("labels", ["", "(1, 0), (5, 0)", "(1, 1)"])
def test_without_two_classes_the_prior_is_left(spark, odd_docs, labels):
    schema = "doc_id long, toxic int"
    rows = [tuple(map(int, p.strip("( )").split(","))) for p in labels.split("), (") if p]
    model = toxicity.train(odd_docs, spark.createDataFrame(rows, schema))
    assert model.weights == {}
    got = toxicity.score(odd_docs, model).collect()
    assert len({r.score for r in got}) == 1 and len(got) == odd_docs.count()


def test_difficult_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(1, 1, 9), (1, 0, 9), (5, 0, 9), (2, 0, 9), (None, 1, 9), (6, None, 9)], "doc_id long, toxic int, text int"
    )
    model = toxicity.train(odd_docs, labels)
    got = toxicity.score(odd_docs, model).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in got if r.doc_id in (2, 3, 4)} == {1 / (1 + np.exp(-model.bias))}
    assert toxicity.score(no_docs, model).count() == 0


def test_repeats_reach_the_driver_as_counts(spark, monkeypatch):
    data = biased(spark)
    long = (1000, "The muslim met vermin. " * 500, 1)
    data = data.unionByName(spark.createDataFrame([long], data.schema))
    hot = data.where("doc_id = 0").crossJoin(spark.range(300).select()).unionByName(data)
    fit, calls = toxicity.fit, []
    monkeypatch.setattr(toxicity, "fit", lambda *a: calls.append(a) or fit(*a))
    model = toxicity.train(hot.select("doc_id", "text"), data.select("doc_id", "toxic"))
    documents, labels, pairs, n, penalty, times, pair_times = calls[0]
    assert len(documents) <= 401 and sum(times) == 701 and len(pairs) < 401 and sum(pair_times) >= 500
    every = [d for d, k in zip(documents, times) for _ in range(k)]
    told = [y for y, k in zip(labels, times) for _ in range(k)]
    swaps = [p for p, k in zip(pairs, pair_times) for _ in range(k)]
    w, bias = fit(every, told, swaps, n, penalty)
    assert np.allclose(w, list(model.weights.values()), atol=1e-6) and abs(bias - model.bias) < 1e-6
