"""Language identification by rank-order n-gram profiles.

Every language keeps its most frequent character n-grams in order of count; a
document's n-grams, ranked the same way, are compared by the out-of-place
distance: the sum over the document's n-grams of how far each is from its
place in the language's list, with a fixed penalty for those not listed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


#: n-grams in a profile; also the penalty of an n-gram that is not listed.
PROFILE = 400
SHARDS = 16
CHUNK = 1 << 20
UNKNOWN = "und"


class Letters:
    """Whether code points are letters, learnt as they are met."""

    def __init__(self) -> None:
        self.table = np.full(0x110000, -1, np.int8)

    def of(self, points: np.ndarray) -> np.ndarray:
        kind = self.table[points]
        if (kind < 0).any():
            for p in set(points[kind < 0].tolist()):
                self.table[p] = chr(p).isalpha()
            kind = self.table[points]
        return kind > 0


def spelled(text: str | None, letters: Letters) -> np.ndarray:
    """Lower-cased letters as code points, every other run as one blank, with
    a blank at either end; empty if there is no letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    letter = letters.of(points) if len(points) else np.empty(0, bool)
    if not letter.any():
        return np.empty(0, np.int64)
    first_blank = ~letter & np.r_[False, letter[:-1]]
    points = np.where(letter, points, 32)[letter | first_blank]
    return np.concatenate([[32], points] if points[-1] == 32 else [[32], points, [32]])


def gram_counts(text: str | None, letters: Letters) -> tuple[np.ndarray, np.ndarray]:
    """Codes (ascending) of a text's 1- to 3-grams within words, and counts."""
    x = spelled(text, letters)
    found = []
    for i in range(0, len(x), CHUNK):  # bounded memory for a very long text
        a = x[i : i + CHUNK]
        b = x[i + 1 : i + 1 + CHUNK]
        c = x[i + 2 : i + 2 + CHUNK]
        two = a[: len(b)] | b << 21
        three = two[: len(c)] | c << 42
        grams = np.concatenate([a[a != 32], two, three[b[: len(c)] != 32]])
        found.append(np.unique(grams, return_counts=True))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return found[0] if len(found) == 1 else summed(found)


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes = np.concatenate([c for c, _ in parts])
    codes, at = np.unique(codes, return_inverse=True)
    return codes, np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)


def emit_counts(batches):
    """(lang, text) -> (lang, gram, n), summed over what a task has read."""
    letters = Letters()
    held: dict[str, list] = {}

    def flush():
        for lang, parts in held.items():
            codes, n = summed(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(n)], ["lang", "gram", "n"]
            )
        held.clear()

    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            codes, n = gram_counts(text.as_py(), letters)
            held.setdefault(lang, []).append((codes, n))
            size += len(codes)
            if size > 2_000_000:
                for k, parts in held.items():
                    held[k] = [summed(parts)]
                size = sum(len(p[0][0]) for p in held.values())
                if size > 1_000_000:
                    yield from flush()
                    size = 0
    yield from flush()


def learn_profiles(docs: DataFrame, size: int = PROFILE) -> dict[str, list[int]]:
    """Language -> its ``size`` most frequent n-grams, most frequent first
    (ties: smaller code), from the rows of ``docs`` with text and lang.

    Counted over all rows; the lists (languages x ``size``) are what comes to
    the driver. Each list is cut down within hashed shards first."""
    known = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    counts = (
        known.select("lang", "text")
        .mapInArrow(emit_counts, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .withColumn("shard", F.pmod(F.xxhash64("gram"), F.lit(SHARDS)))
    )
    ranked = Window.partitionBy("lang", "shard").orderBy(F.desc("n"), "gram")
    heads = counts.withColumn("r", F.row_number().over(ranked)).where(F.col("r") <= size)
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "gram"))), 1, size)
    rows = heads.groupBy("lang").agg(F.transform(best, lambda x: x["gram"]).alias("grams")).collect()
    return {r.lang: list(r.grams) for r in sorted(rows, key=lambda r: r.lang)}


class Judge:
    """Compares texts to profiles."""

    def __init__(self, profiles: dict[str, list[int]], size: int) -> None:
        self.size, self.langs, self.letters = size, list(profiles), Letters()
        self.codes = np.unique(np.array([g for p in profiles.values() for g in p], np.int64))
        self.place = np.full((len(self.codes), len(self.langs)), -1, np.int64)
        for k, grams in enumerate(profiles.values()):
            self.place[np.searchsorted(self.codes, np.array(grams, np.int64)), k] = np.arange(len(grams))

    def of(self, text: str | None) -> tuple[str, float]:
        codes, n = gram_counts(text, self.letters)
        if not len(codes) or not self.langs or not len(self.codes):
            return UNKNOWN, 0.0
        top = codes[np.argsort(-n, kind="stable")[: self.size]]
        at = np.minimum(np.searchsorted(self.codes, top), len(self.codes) - 1)
        place = np.where((self.codes[at] == top)[:, None], self.place[at], -1)
        out = np.where(place >= 0, np.abs(place - np.arange(len(top))[:, None]), self.size)
        distance = np.minimum(out, self.size).sum(0)
        best = int(distance.argmin())
        return self.langs[best], 1.0 - float(distance[best]) / (self.size * len(top))


def identify(docs: DataFrame, profiles: dict[str, list[int]], size: int = PROFILE) -> DataFrame:
    """(doc_id, lang_pred, score) per row of ``docs``, from its text alone.

    ``score`` is 1 minus the distance over its largest possible value; equal
    distances go to the language that sorts first. Null, empty or letterless
    text, or no profile at all: ``und`` with score 0. Repeated rows and null
    ids come back as they are; very long texts are counted whole, in blocks;
    an empty table gives an empty table; other columns are ignored.
    """
    id_type = dict(docs.dtypes)["doc_id"]

    def judged(batches):
        judge = Judge(profiles, size)
        for batch in batches:
            found = [judge.of(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([x for x, _ in found], pa.string()),
                    pa.array([s for _, s in found], pa.float64()),
                ],
                ["doc_id", "lang_pred", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(judged, f"doc_id {id_type}, lang_pred string, score double")
