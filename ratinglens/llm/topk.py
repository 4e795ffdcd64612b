"""Exact top-k inner products with an impact-ordered, score-at-a-time index.

Vectors are turned into integers. A block of candidates is indexed by impact:
the postings (dimension, vector, value) of one quantised impact (the bit length
of the value's size) form a segment, and segments are kept in descending order
of impact, each with the norm of what is left below it for every vector.

A block of queries is scored segment by segment. After each segment every
candidate's score lies within the query's norm times the norm of what is left;
candidates that cannot reach the k-th best sure score are out. The pass over
a block stops when the rest is few enough, or nothing is left below, and every
possible member is rescored exactly.

A task keeps each query's k best over all the blocks that it reads: the k-th of
them is a sure threshold from which the next block starts, and they leave the
task once, not block by block (earlier where they outgrow a fixed size).
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import saved

#: Vectors in a block of candidates (between these, aiming at ``BLOCKS``
#: blocks), in a block of queries, and queries scored at once.
CANDIDATES, BLOCKS, QUERIES, AT_ONCE = (1024, 32768), 64, 2048, 64
#: Components (vectors × dimensions) that a block of candidates aims at, at most.
COMPONENTS = 1 << 22
#: Results that a task holds before it passes them on.
HELD = 1 << 20
#: Rescoring starts when at most this share of a block can still be members.
FEW = 0.05


def quantised(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """(vec_id, v array<long>): floor(scale * x) of each component as double;
    rows without id, vector, or with a null or non-finite component are out."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (
        vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
        .where(~bad)
        .select("vec_id", F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"))
    )


def smallest(m: np.ndarray) -> np.ndarray:
    """The matrix in the narrowest signed integers that hold it."""
    low, high = m.min(initial=0), m.max(initial=0)
    for t in (np.int8, np.int16, np.int32):
        if np.iinfo(t).min <= low and high <= np.iinfo(t).max:
            return m.astype(t)
    return m


def pack(batches, size: int):
    """(part, vec_id, v) sorted by part -> rows (part, at, dims, width, ids,
    vals), each a block of at most ``size`` vectors of a part."""

    def row(part, at, ids, vecs):
        width = max((len(v) for v in vecs), default=0)
        m = np.zeros((len(vecs), width), np.int64)
        for i, v in enumerate(vecs):
            m[i, : len(v)] = v
        m = smallest(m)
        ids = np.array(ids, np.int64).tobytes()
        return {"part": part, "at": at, "dims": width, "width": m.itemsize, "ids": ids, "vals": m.tobytes()}

    ints = [(n, pa.int32()) for n in ("part", "at", "dims", "width")]
    schema = pa.schema([*ints, ("ids", pa.binary()), ("vals", pa.binary())])
    current, at, ids, vecs = None, 0, [], []
    for batch in batches:
        for part, vid, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if part != current or len(ids) >= size:
                if ids:
                    yield pa.RecordBatch.from_pylist([row(current, at, ids, vecs)], schema)
                at = at + 1 if part == current else 0
                current, ids, vecs = part, [], []
            ids.append(vid)
            vecs.append(v.values.to_numpy(zero_copy_only=False))
    if ids:
        yield pa.RecordBatch.from_pylist([row(current, at, ids, vecs)], schema)


class ImpactIndex:
    """Segments of a block of candidates, in descending order of impact: dense
    matrices, zero outside their level, in the narrower float that holds every
    partial score. A product leaves out the vectors that no query of its group
    can still have among its best (``skipped`` counts them, ``scored`` others)."""

    def __init__(self, ids: np.ndarray, values: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order]
        size = np.abs(self.values).astype(np.float64)
        impact = np.where(size > 0, np.frexp(size)[1], 0).astype(np.int8)
        self.levels = sorted({int(x) for x in np.unique(impact)} - {0}, reverse=True)
        self.most = float(size.max(initial=0))
        kind = np.float32 if self.most < 2**20 else np.float64
        self.norm = np.sqrt((size * size).sum(1))
        self.segments, self.left = [], []
        for level in self.levels:
            self.segments.append(np.where(impact == level, self.values, 0).astype(kind))
            below = np.where(impact < level, size, 0.0)
            self.left.append(np.sqrt((below * below).sum(1)))
        self.scored = self.skipped = 0

    def bound(self, queries: np.ndarray) -> float:
        """What no partial score exceeds in size."""
        return self.most * float(np.abs(queries).max(initial=0)) * max(1, self.values.shape[1])

    def top(
        self, query_ids: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query number, candidate number, score) of all that can be among a
        query's k best in this block, by exact score. ``floor``: a score that
        each query's k-th best is known to reach elsewhere."""
        n, width = self.values.shape
        queries = np.pad(queries, ((0, 0), (0, max(0, width - queries.shape[1]))))[:, :width]
        possible = self.ids[None, :] != query_ids[:, None]
        if not self.segments:
            return self.best(np.zeros((len(queries), n)), possible, k)
        bound = self.bound(queries)
        if not bound < 2.0**52:
            scores = queries.astype(object) @ self.values.astype(object).T
            return self.best(scores, possible, k)
        q = queries.astype(np.float64)
        narrow = queries.astype(np.float32) if bound < 2.0**24 else q
        norm = np.sqrt((q * q).sum(1))
        floor = np.full(len(q), -np.inf) if floor is None else floor
        possible &= norm[:, None] * self.norm[None, :] * (1 + 1e-9) + 1e-6 >= floor[:, None]
        score = np.zeros((len(q), n))
        for segment, left in zip(self.segments, self.left):
            live = np.flatnonzero(possible.any(0))
            if 2 * len(live) < n:
                score[:, live] += narrow @ segment[live].T
                self.skipped += n - len(live)
                self.scored += len(live)
            else:
                score += narrow @ segment.T
                self.scored += n
            if not left.any():
                return self.best(score, possible, k)
            slack = norm[:, None] * left[None, :] * (1 + 1e-9) + 1e-6
            sure = np.where(possible, score - slack, -np.inf)
            kth = floor
            if n > k:
                kth = np.maximum(kth, np.partition(sure, n - k, axis=1)[:, n - k])
            possible &= score + slack >= kth[:, None]
            if possible.sum() <= FEW * possible.size:
                break
        a, b = np.nonzero(possible)
        exact = np.empty(len(a), np.int64)
        for i in range(0, len(a), 1 << 16):
            part = slice(i, i + (1 << 16))
            exact[part] = (queries[a[part]] * self.values[b[part]]).sum(1)
        return a, b, exact

    @staticmethod
    def best(scores: np.ndarray, possible: np.ndarray, k: int):
        """From exact scores: all that reach the k-th best possible one."""
        if scores.dtype == object:
            keep = possible.copy()
            for i, row in enumerate(scores):
                live = sorted((s for s, p in zip(row, possible[i]) if p), reverse=True)
                if len(live) > k:
                    keep[i] &= np.array([s >= live[k - 1] for s in row], bool)
            a, b = np.nonzero(keep)
            if any(abs(int(s)) >= 2**63 for s in scores[a, b]):
                raise OverflowError("a score among a query's best is beyond the range of a long")
            return a, b, scores[a, b].astype(np.int64)
        live = np.where(possible, scores, -np.inf)
        n = live.shape[1]
        if n > k:
            possible = possible & (live >= np.partition(live, n - k, axis=1)[:, n - k][:, None])
        a, b = np.nonzero(possible)
        return a, b, scores[a, b].astype(np.int64)


def matrix(dims, width, ids, vals) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids.as_buffer(), np.int64)
    kind = np.dtype(f"i{width.as_py()}")
    return i, np.frombuffer(vals.as_buffer(), kind).reshape(len(i), dims.as_py()).astype(np.int64)


class Held:
    """Each query's k best so far (ties: smaller id), over blocks."""

    def __init__(self, k: int) -> None:
        self.k, self.new, self.waiting = k, [], 0
        self.clear()

    def clear(self) -> None:
        self.query, self.vec, self.score = (np.empty(0, np.int64) for _ in range(3))
        self.full, self.kth = np.empty(0, np.int64), np.empty(0)

    def add(self, query: np.ndarray, vec: np.ndarray, score: np.ndarray) -> None:
        self.new.append((query, vec, score))
        self.waiting += len(query)

    def settle(self) -> None:
        parts = [(self.query, self.vec, self.score), *self.new]
        query, vec, score = (np.concatenate(c) for c in zip(*parts))
        self.new, self.waiting = [], 0
        order = np.lexsort((vec, -score, query))
        query, vec, score = query[order], vec[order], score[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        keep = place < self.k
        self.query, self.vec, self.score = query[keep], vec[keep], score[keep]
        last = place == self.k - 1
        self.full, self.kth = query[last], score[last].astype(np.float64)

    def floor(self, queries: np.ndarray) -> np.ndarray:
        """The k-th best score of each query, minus infinity below k. Rounded to
        a double it may lie above a score of over 2**53: such blocks do not
        look at it."""
        out = np.full(len(queries), -np.inf)
        if len(self.full):
            at = np.minimum(np.searchsorted(self.full, queries), len(self.full) - 1)
            known = self.full[at] == queries
            out[known] = self.kth[at[known]]
        return out

    def batch(self) -> pa.RecordBatch:
        columns = [pa.array(c) for c in (self.query, self.vec, self.score)]
        return pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])


def search_blocks(batches, k: int):
    """(part, at, candidate block, query block) -> (query_id, vec_id, score):
    each query's k best of all blocks of the task (ties: smaller id)."""
    key, index, held = None, None, Held(k)
    for batch in batches:
        for r in range(batch.num_rows):
            part, at, *block = (batch.column(c)[r] for c in range(10))
            if key != (part.as_py(), at.as_py()):
                key, index = (part.as_py(), at.as_py()), ImpactIndex(*matrix(*block[:4]))
                held.settle()
            ids, queries = matrix(*block[4:])
            for i in range(0, len(ids), AT_ONCE):
                own = ids[i : i + AT_ONCE]
                a, b, s = index.top(own, queries[i : i + AT_ONCE], k, held.floor(own))
                held.add(own[a], index.ids[b], s)
                if held.waiting > HELD:
                    held.settle()
            if len(held.query) > HELD:
                yield held.batch()
                held.clear()
    held.settle()
    yield held.batch()


def packed(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
    """The rows in blocks of about ``size`` (at most twice that), and the
    number of parts that they are dealt into by their id."""
    parts = max(1, -(-rows.count() // size))
    dealt = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias("part"), "vec_id", "v")
    blocks = (
        dealt.repartition(min(parts, 4096), "part")
        .sortWithinPartitions("part", "vec_id")
        .mapInArrow(
            partial(pack, size=2 * size), "part int, at int, dims int, width int, ids binary, vals binary"
        )
    )
    return saved(blocks, name), parts


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of every
    query vector over all candidates but its own id; both (vec_id, v).

    Ties go to the smaller vec_id; fewer candidates than k: all. Vectors of
    different length are padded with zeros, an empty one scores 0. A score
    among the best that is beyond the range of a long is an error. Repeated ids are candidates
    each; a repeated query id is answered once, from its largest vector. Empty
    tables give an empty table; other columns are ignored.

    Blocks of queries are copied to every block of candidates (blocks are
    paired, never rows); what is copied is the narrowest integers.
    """
    least, most = CANDIDATES
    shape = candidates.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dims")).first()
    size = min(most, max(least, shape.n // BLOCKS), max(1, COMPONENTS // max(1, shape.dims or 1)))
    q, _ = packed(queries.groupBy("vec_id").agg(F.max("v").alias("v")), QUERIES, "topk-queries")
    c, parts = packed(candidates.select("vec_id", "v"), size, "topk-candidates")
    places = c.groupBy("part").agg(F.max("at").alias("last"))

    def named(prefix: str) -> list:
        return [F.col(x).alias(prefix + x) for x in ("dims", "width", "ids", "vals")]

    # A copy for every block there is; only a part of repeated ids has several.
    copies = (
        q.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), *named("q_"))
        .join(places, "part")
        .withColumn("at", F.explode(F.sequence(F.lit(0), "last")))
        .drop("last")
    )
    # The planner sizes the copies as the blocks before copying: no broadcast.
    pairs = c.select("part", "at", *named("c_")).join(copies.hint("merge"), ["part", "at"])
    found = pairs.select(
        "part", "at", "c_dims", "c_width", "c_ids", "c_vals", "q_dims", "q_width", "q_ids", "q_vals"
    ).mapInArrow(partial(search_blocks, k=k), "query_id long, vec_id long, score long")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
