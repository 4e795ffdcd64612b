"""The registered queries without SQL, as a whole, against plain versions."""

import math
import struct
import zlib
from collections import Counter

import pytest
from brute import components

from ratinglens.llm import langid, toxicity
from ratinglens.llm import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def remainder(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


def test_op1_learns_from_the_other_folds_only(spark, docs):
    got = {r.doc_id: r for r in Q.op1_language_profiles(spark, SF).collect()}
    learned = [d for d in docs if remainder(d[0], 3) != 1]
    assert set(got) == {d for d, _, _ in docs}
    rows = spark.createDataFrame(learned, "doc_id long, text string, lang string")
    profiles = langid.learn_profiles(rows)
    asked = spark.createDataFrame([(d, t) for d, t, _ in docs], "doc_id long, text string")
    want = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(asked, profiles).collect()}
    assert {d: (r.lang_pred, r.score) for d, r in got.items()} == want
    known = {lang for _, _, lang in learned if lang is not None} | {"und"}
    for d, text, _ in docs:
        assert got[d].held_out == (remainder(d, 3) == 1)
        assert got[d].lang_pred in known and 0 <= got[d].score <= 1
        assert (got[d].lang_pred == "und") == (not any(c.isalpha() for c in text or ""))


def screened(rows):
    """Features of [(text, toxic)], by documents and z-score."""
    pos, neg = Counter(), Counter()
    for text, toxic in rows:
        own = {f for w in toxicity.words_of(text) for f in toxicity.features_of(w)}
        (pos if toxic else neg).update(own)
    n_pos, n = sum(t for _, t in rows), len(rows)
    out = set()
    for f in pos.keys() | neg.keys():
        p = (pos[f] + neg[f]) / n
        spread = math.sqrt(p * (1 - p) * (1 / n_pos + 1 / (n - n_pos)) + 1e-12)
        z = abs(pos[f] / n_pos - neg[f] / (n - n_pos)) / spread
        if pos[f] + neg[f] >= toxicity.MIN_DOCUMENTS and z >= toxicity.MIN_Z:
            out.add(f)
    return out


def test_op5_screens_and_scores_like_the_plain_rule(spark, monkeypatch):
    sf = "/root/testdata/sf0.01"  # the smallest table with features that pass
    train, models = toxicity.train, []
    monkeypatch.setattr(toxicity, "train", lambda *a, **k: models.append(train(*a, **k)) or models[-1])
    got = {r.doc_id: r for r in Q.op5_toxicity(spark, sf).collect()}
    (model,) = models
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = [(texts[d], int(y != 0)) for d, y in labels.items() if d in texts and y is not None and remainder(d, 5)]
    assert set(model.weights) == screened(rows) and model.weights
    assert set(got) == set(texts)
    for d, text in texts.items():
        own = {f for w in toxicity.words_of(text) for f in toxicity.features_of(w)}
        logit = model.bias + sum(model.weights[f] for f in sorted(own & model.weights.keys()))
        assert got[d].score == pytest.approx(1 / (1 + math.exp(-max(-40, min(40, logit)))), abs=1e-9)
        assert got[d].predicted == int(got[d].score >= 0.5)
        assert got[d].held_out == (remainder(d, 5) == 0)


def test_op6_equals_brute_force(spark, docs):
    got = [tuple(r) for r in Q.op6_simhash_classes(spark, SF).select("doc_id", "fingerprint", "component_id").collect()]
    assert sorted(got) == sorted(components([(d, t) for d, t, _ in docs]))


@pytest.fixture(scope="module")
def library():
    return pytest.importorskip("tokenizers").Tokenizer.from_file(Q.tokenizer_path())


def test_op7_equals_the_library(spark, docs, library):
    from brute import sha

    want = []
    for d, text, _ in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((d, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    got = Q.op7_bpe_round_trip(spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_op10_equals_the_library(spark, docs, library):
    want, start = [], 0
    for d, text, _ in sorted(docs):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((d, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    got = Q.op10_token_shards(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == want
