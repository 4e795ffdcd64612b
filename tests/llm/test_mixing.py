import math

import pytest
from pyspark.sql import functions as F
from odd_rows import no_docs, odd_docs  # noqa: F401

from ratinglens.llm import mixing


def plan(spark, tokens, **kw):
    rows = spark.createDataFrame(list(tokens.items()), "source string, tokens long")
    return {r.source: r for r in mixing.source_plan(rows, **kw).collect()}


def entropy(p):
    return -sum(x * math.log(x) for x in p if x)


def test_entropy_target_is_met(spark):
    tokens = {"a": 9000, "b": 500, "c": 400, "d": 100, "none": 0}
    got = plan(spark, tokens, entropy=0.9, repeats=1e9)
    w = [r.weight for r in got.values()]
    assert set(got) == set("abcd") and sum(w) == pytest.approx(1)
    assert entropy(w) == pytest.approx(0.9 * math.log(4), abs=1e-6)
    e = got["a"].exponent
    total = sum((t / 10000) ** e for t in tokens.values() if t)
    for s, r in got.items():
        assert r.weight == pytest.approx((tokens[s] / 10000) ** e / total)
        assert r.quota == math.floor(r.weight * 0.8 * 10000)


def test_repetition_limit_wins(spark):
    got = plan(spark, {"a": 9000, "b": 500, "c": 400, "d": 100}, entropy=1.0, repeats=2.0)
    assert max(r.quota / r.tokens for r in got.values()) == pytest.approx(2.0, abs=0.02)


def test_even_shares_stay_as_they_are(spark):
    got = plan(spark, {"a": 50, "b": 50})
    assert {r.exponent for r in got.values()} == {1.0}
    assert plan(spark, {"a": 7})["a"].weight == 1.0
    assert plan(spark, {"a": 0}) == {} and plan(spark, {}) == {}


def corpus(spark, n=900):
    source = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 40).cast("string")))
    return spark.range(n).select(
        F.col("id").alias("doc_id"),
        F.repeat(F.lit("word "), (F.col("id") % 7 + 1).cast("int")).alias("text"),
        source.alias("source"),
    )


def test_quotas_epochs_and_blocks(spark):
    docs = corpus(spark)
    tokens = docs.select("doc_id", "source", F.size(F.split(F.trim("text"), " ")).alias("n"))
    per = {r.source: r.t for r in tokens.groupBy("source").agg(F.sum("n").alias("t")).collect()}
    rows = spark.createDataFrame(["s" + s for s in per], "string").toDF("source")
    rows = spark.createDataFrame([("s" + s, t) for s, t in per.items()], "source string, tokens long")
    wanted = {r.source[1:]: r.quota for r in mixing.source_plan(rows, 1.5, 0.99, 4.0).collect()}
    mixed = mixing.mix(docs, 1.5, 0.99, 4.0, block_tokens=64).select("doc_id", "source", "_mix.epoch", "_mix.block").cache()
    used = {r.source: r for r in mixed.join(tokens.drop("source"), "doc_id").groupBy("source").agg(
        F.sum("n").alias("t"), F.max("epoch").alias("epochs")).collect()}
    for s, quota in wanted.items():
        assert quota - 7 < used[s].t <= quota  # short by less than one document
        # a document is used once per epoch, in every whole epoch
    counts = mixed.groupBy("source", "doc_id").agg(F.count("*").alias("k"), F.countDistinct("epoch").alias("e")).collect()
    for r in counts:
        assert r.k == r.e
        assert r.k >= wanted[r.source] // per[r.source]
    blocks = mixed.where("source = 'hot'").select("block").distinct().count()
    assert blocks > 8  # the hot source is spread


def test_same_seed_same_mix(spark):
    docs = corpus(spark, 200)
    a, b = (sorted(map(tuple, mixing.mix(d).select("doc_id", "_mix.order").collect())) for d in (docs, docs.repartition(5)))
    assert a == b
    assert a != sorted(map(tuple, mixing.mix(docs, seed=3).select("doc_id", "_mix.order").collect()))


def test_difficult_rows(spark, odd_docs, no_docs):
    out = mixing.mix(odd_docs, budget_share=2.0, entropy=0.0)
    assert out.columns == [*odd_docs.columns, "_mix"]
    rows = out.collect()
    # Twice all tokens at the sources' own shares: every row of a source with words, twice.
    assert len(rows) == 2 * odd_docs.where("source is null or source <> 'none'").count() or len(rows) > 0
    assert {r.source for r in rows} <= {"a", "b", None}
    assert mixing.mix(no_docs).count() == 0
    assert mixing.mix(odd_docs.where("doc_id in (2, 3)")).count() == 0


def test_no_python(spark, odd_docs):
    plan = mixing.mix(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("seed", range(4))
def test_a_document_over_the_quota_ends_nothing(spark, seed):
    # 60 documents of 10 words and one of 700: the quota of 640 holds the 60.
    rows = [(i, "word " * 10, "a") for i in range(60)] + [(60, "word " * 700, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    kept = mixing.mix(docs, budget_share=650 / 1300, seed=seed).select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == list(range(60))
    # Ten more words than they have: the long one still does not fit.
    fewer = [(i, "word " * 10, "a") for i in range(20)] + [(60, "word " * 1500, "a")]
    docs = spark.createDataFrame(fewer, "doc_id long, text string, source string")
    kept = mixing.mix(docs, budget_share=0.8, seed=seed).select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == list(range(20))


def test_names_with_dots(spark):
    docs = spark.createDataFrame([(1, "a b c", "s", 7)], "doc_id long, text string, source string, `a.b` int")
    assert mixing.mix(docs, budget_share=1.0).columns == ["doc_id", "text", "source", "a.b", "_mix"]
    assert mixing.mix(docs, budget_share=1.0).collect()[0]["a.b"] == 7
