"""Toxicity scores by a counterfactual-regularised classifier.

A logistic classifier over words and word stems. Each labelled sentence that
names a group is also seen with the group's term swapped for others of its
kind, and the squared change of the score's logit is penalised, so a neutral
mention of a group does not raise the score.

Fitted on a bounded sample of labelled documents (``MAX_LABELLED``); the
features are screened over that sample in Spark, and only the screened
features (``MAX_FEATURES``) reach the driver: each distinct list of a sampled
document or swapped pair once, with a count. The sample bounds ids; an id with
many different texts has a list for each.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

#: Labelled documents that the classifier is fitted on, at most.
MAX_LABELLED = 20_000
#: Features that pass the screening, at most.
MAX_FEATURES = 4096
#: A feature is screened by its documents in the sample and its z-score.
MIN_DOCUMENTS, MIN_Z = 5, 4.0
#: Weight of the counterfactual penalty and of the squared weights.
SWAP_PENALTY, RIDGE = 2.0, 1e-4
#: Lengths of word beginnings that count as stems.
STEMS = (5, 6, 7, 8)

# Terms for groups of people, by kind.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "mothers", "fathers"),
    ("woman", "man", "girl", "boy", "mother", "father"),
    ("female", "male", "transgender", "nonbinary"),
    ("gay", "lesbian", "bisexual", "straight", "queer", "heterosexual", "homosexual"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("immigrants", "refugees", "foreigners", "natives", "locals"),
    ("blind", "deaf", "disabled", "autistic"),
    ("old", "young", "elderly", "teenage"),
)

WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[^.!?\n]+[.!?\n]*")


def features_of(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) >= n)]


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def kinds(groups) -> dict[str, tuple[str, ...]]:
    return {t: g for g in groups for t in g}


def swapped(sentence: str, terms: dict[str, tuple[str, ...]], shift: int) -> str:
    """The sentence with each group term replaced by the one ``shift`` places
    on in its kind."""

    def other(m: re.Match) -> str:
        term = m[0].lower()
        if term not in terms:
            return m[0]
        group = terms[term]
        return group[(group.index(term) + shift) % len(group)]

    return WORD.sub(other, sentence)


def counterfactuals(text: str | None, terms: dict, shifts=(1, 2, 3)) -> list[tuple[str, str]]:
    """(sentence, swapped sentence) for the sentences that name a group."""
    out = []
    if words_of(text) & terms.keys():
        for s in SENTENCE.findall(text):
            if words_of(s) & terms.keys():
                out += [(s, t) for k in shifts if (t := swapped(s, terms, k)) != s]
    return out


@dataclass
class Model:
    weights: dict[str, float]
    bias: float


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(
    documents: list[list[int]],
    labels: list[int],
    pairs: list[tuple[list[int], list[int]]],
    n: int,
    penalty: float,
    times: list[int] | None = None,
    pair_times: list[int] | None = None,
) -> tuple[np.ndarray, float]:
    """Weights and bias by gradient steps (Adam) on mean log loss, plus
    ``penalty`` times the mean squared logit change over the swapped pairs,
    plus ridge. ``times`` and ``pair_times``: how often each document and pair
    counts (default: once)."""
    y = np.array(labels, float)
    often = np.ones(len(y)) if times is None else np.array(times, float)
    pair_often = np.ones(len(pairs)) if pair_times is None else np.array(pair_times, float)

    def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        sizes = [len(x) for x in lists]
        return np.repeat(np.arange(len(lists)), sizes), np.array([i for x in lists for i in x], np.int64)

    row, col = flat(documents)
    a_row, a_col = flat([a for a, _ in pairs])
    b_row, b_col = flat([b for _, b in pairs])
    prior = np.clip((often * y).sum() / often.sum() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    w = np.zeros(n + 1)
    w[n] = np.log(prior / (1 - prior))
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    for t in range(1, 401):
        z = np.bincount(row, w[col], len(y)) + w[n]
        err = often * (sigmoid(z) - y) / max(1, often.sum())
        g = np.r_[np.bincount(col, err[row], n)[:n] + 2 * RIDGE * w[:n], err.sum()]
        if pairs:
            change = np.bincount(a_row, w[a_col], len(pairs)) - np.bincount(b_row, w[b_col], len(pairs))
            scale = 2 * penalty / pair_often.sum() * pair_often * change
            g[:n] += np.bincount(a_col, scale[a_row], n)[:n] - np.bincount(b_col, scale[b_row], n)[:n]
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        w = w - 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w[:n], float(w[n])


def emit_screening(batches):
    """(text, toxic, n) -> (feature, toxic documents, other documents), each
    text counted ``n`` times."""
    for batch in batches:
        counts = (Counter(), Counter())
        for text, label, n in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            for f in {f for w in words_of(text.as_py()) for f in features_of(w)}:
                counts[label][f] += n
        found = sorted(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(found, pa.string()),
                pa.array([counts[1][f] for f in found], pa.int64()),
                pa.array([counts[0][f] for f in found], pa.int64()),
            ],
            ["feature", "pos", "neg"],
        )


def train(
    docs: DataFrame,
    labels: DataFrame,
    max_labelled: int = MAX_LABELLED,
    penalty: float = SWAP_PENALTY,
    groups=IDENTITY_TERMS,
) -> Model:
    """Classifier from the texts of ``docs`` whose doc_id is in ``labels``.

    Of the labelled ids at most ``max_labelled`` are taken, in the order of a
    hash; an id labelled more than once counts as toxic if any label says so;
    null labels are left out. Without labels, or with one class only, the
    model is the prior alone.
    """
    label = F.when(F.col("toxic") != 0, F.lit(1)).otherwise(F.lit(0))
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_labelled)
    )
    chosen = saved(chosen.withColumnRenamed("doc_id", "_id"), "toxic-labels")
    # At most max_labelled ids: small enough to send to every executor.
    # Repeated rows of an id are one row with a count.
    sample = saved(
        docs.select(F.col("doc_id").alias("_id"), "text")
        .join(F.broadcast(chosen), "_id")
        .groupBy("_id", "text", "toxic")
        .agg(F.count("*").alias("n"))
        .select("text", "toxic", "n"),
        "toxic-sample",
    )
    totals = sample.agg(F.sum(F.col("toxic") * F.col("n")).alias("pos"), F.sum("n").alias("n")).first()
    n_pos, n_all = totals.pos or 0, totals.n or 0
    if not 0 < n_pos < n_all:
        prior = min(max(n_pos / n_all, 1e-3), 1 - 1e-3) if n_all else 0.5
        return Model({}, float(np.log(prior / (1 - prior))))
    counted = (
        sample.mapInArrow(emit_screening, "feature string, pos long, neg long")
        .groupBy("feature")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .where(F.col("pos") + F.col("neg") >= MIN_DOCUMENTS)
    )
    p = (F.col("pos") + F.col("neg")) / n_all
    spread = F.sqrt(p * (1 - p) * (1 / n_pos + 1 / (n_all - n_pos)) + 1e-12)
    z = F.abs(F.col("pos") / n_pos - F.col("neg") / (n_all - n_pos)) / spread
    screened = counted.withColumn("z", z).where(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "feature").limit(MAX_FEATURES)
    features = [r.feature for r in screened.select("feature").collect()]
    terms = kinds(groups)
    number = {f: i for i, f in enumerate(features)}

    def encoded(batches):
        def ids(text: str | None) -> list[int]:
            return sorted({number[f] for w in words_of(text) for f in features_of(w) if f in number})

        for batch in batches:
            found: Counter = Counter()
            for text, label, n in zip(*(c.to_pylist() for c in batch.columns)):
                found[label, tuple(ids(text)), None] += n
                for a, b in counterfactuals(text, terms):
                    a, b = tuple(ids(a)), tuple(ids(b))
                    if a != b:
                        found[None, a, b] += n
            rows = [{"toxic": t, "a": a, "b": b, "n": n} for (t, a, b), n in found.items()]
            kinds_of = [pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64()]
            yield pa.RecordBatch.from_pylist(rows, pa.schema(list(zip(("toxic", "a", "b", "n"), kinds_of))))

    # A document is (toxic, a), a swapped pair (a, b). Equal ones are counted
    # in Spark: the distinct ones reach the driver; sorted so that sums do not
    # depend on their order.
    counted = sample.mapInArrow(encoded, "toxic int, a array<int>, b array<int>, n long")
    rows = counted.groupBy("toxic", "a", "b").agg(F.sum("n").alias("n")).collect()
    seen = sorted((r.toxic, list(r.a), r.n) for r in rows if r.b is None)
    pairs = sorted((list(r.a), list(r.b), r.n) for r in rows if r.b is not None)
    w, bias = fit(
        [a for _, a, _ in seen],
        [toxic for toxic, _, _ in seen],
        [(a, b) for a, b, _ in pairs],
        len(features),
        penalty,
        [n for _, _, n in seen],
        [n for _, _, n in pairs],
    )
    return Model(dict(zip(features, w.tolist())), bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) per row of ``docs``, from its text alone.

    Null, empty and wordless texts get the classifier's prior. Repeated rows
    and null ids come back as they are; long texts are scored whole; an empty
    table gives an empty table; other columns are ignored.
    """
    id_type = dict(docs.dtypes)["doc_id"]
    names = list(model.weights)
    weight = np.array(list(model.weights.values()) or [0.0])
    number = {f: i for i, f in enumerate(names)}
    bias = model.bias

    def scored(batches):
        known: dict[str, tuple[int, ...]] = {}

        def logit(text: str | None) -> float:
            hits: set[int] = set()
            for w in words_of(text):
                ids = known.get(w)
                if ids is None:
                    if len(known) > 300_000:
                        known.clear()
                    ids = known[w] = tuple(number[f] for f in features_of(w) if f in number)
                if ids:
                    hits.update(ids)
            return bias + float(weight[sorted(hits)].sum()) if hits else bias

        for batch in batches:
            s = sigmoid(np.array([logit(t.as_py()) for t in batch.column(1)], float))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    return docs.select("doc_id", "text").mapInArrow(scored, f"doc_id {id_type}, score double, predicted int")
