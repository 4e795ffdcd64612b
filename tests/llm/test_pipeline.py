"""The pipeline on a small table against plain versions of its stages, the
registered queries and their SQL."""

import glob

import duckdb
import pyarrow.parquet as pq
import pytest
from brute import components, sha, without_repeats, words
from odd_rows import no_docs, odd_docs  # noqa: F401

import __spark_entry__ as E
import corpus_pipeline as P
from ratinglens.llm import mixing
from ratinglens.llm import queries as Q
from ratinglens.session import scratch_dir

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_all_are_registered():
    names = E.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert names["pipeline"] is P.run and len(P.STAGES) == 5
    assert set(Q.oracle_sql()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_queries_equal_their_sql(spark, con, name):
    got = Q.queries()[name](spark, SF)
    cols = sorted(got.columns)
    want = con.execute(Q.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == cols
    rows = sorted(str([dict(zip(names, r))[c] for c in cols]) for r in want.fetchall())
    assert sorted(str([r[c] for c in cols]) for r in got.collect()) == rows and rows


def test_stages_equal_brute_force(spark, con):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    verdict = dict(con.execute(f"SELECT doc_id, kept FROM ({Q.oracle_sql()['op4_line_quality']})").fetchall())
    kept = P.quality_rules(spark, docs, SF)
    assert kept.columns == docs.columns
    rows = {r.doc_id: r.text for r in kept.collect()}
    assert set(rows) == {d for d, k in verdict.items() if k}

    one = P.near_duplicates(spark, kept, SF)
    classes = components(list(rows.items()))
    assert sorted(r.doc_id for r in one.collect()) == sorted({c for _, _, c in classes})

    left = {r.doc_id: r.text for r in one.collect()}
    cut = {r.doc_id: r for r in P.repeated_passages(spark, one, SF).collect()}
    for d, (_, stay) in zip(left, without_repeats(list(left.values()))):
        assert words(cut[d].text) == stay
        assert cut[d].n_chars == len(cut[d].text)

    base = P.repeated_passages(spark, one, SF)
    mixed = P.source_mix(spark, base, SF)
    assert mixed.columns == docs.columns
    assert {r.doc_id for r in mixed.collect()} <= set(left)
    # The rows are written in the order of the mix.
    order = mixing.mix(base).select("doc_id", "_mix.epoch", "_mix.order").collect()
    path = scratch_dir(spark, "test-mixed")
    mixed.write.parquet(path)
    parts = sorted(glob.glob(path.removeprefix("file:") + "/part-*.parquet"))
    written = [d for p in parts for d in pq.read_table(p)["doc_id"].to_pylist()]
    assert written == [r.doc_id for r in sorted(order, key=lambda r: (r.epoch, r["order"]))]


def test_run_encodes_what_the_stages_leave(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(Q.tokenizer_path())
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    want = sorted((r.doc_id, sha(" ".join(map(str, t.encode(r.text or "", add_special_tokens=False).ids)))) for r in docs.collect())
    got = P.run(spark, SF).collect()
    assert sorted((r.doc_id, sha(r.ids)) for r in got) == want and want


def test_stages_take_difficult_rows(spark, odd_docs, no_docs):
    for _, stage in P.STAGES:
        assert stage(spark, no_docs, SF).count() == 0
        out = stage(spark, odd_docs, SF)
        # Only the mix repeats a document, up to four times.
        assert out.count() <= (4 if stage is P.source_mix else 1) * odd_docs.count()
        if stage is not P.encode:
            assert out.columns == odd_docs.columns
