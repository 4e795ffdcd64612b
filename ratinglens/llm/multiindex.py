"""Near-duplicate vectors by an inverted multi-index.

1. Rows with the same components are one point with a weight. Points are unit
   vectors; for the index their components are integers, so that every choice
   of a cell is exact and the same in all tasks.
2. Two codebooks, fitted on a bounded sample, one for each half of the vector,
   span a product grid. Every point lives in the cell of its nearest entries.
3. A search visits the cells in the order of the multi-sequence traversal: by
   ascending sum of the squared distances from the point's halves to the cells'
   two borders. It stops where the target recall is reached: the bound is read
   from a curve over the true links of sampled points (found by brute force)
   and over random neighbours at the least cosine.
4. Found pairs are verified by their cosine in double precision. A task emits a
   row per visit and per point at home (links found, one link that joins it to
   its class), never pairs.
5. A group of near copies too large for that is a ball: a centre whose points
   all lie within half the angle of the least cosine, so all of them are linked
   to each other and none of those pairs is looked at. Its points take part in
   the search only if a point outside could be linked to one of them, and then
   are only found, unless another ball is near.
"""

from __future__ import annotations

import hashlib
import heapq
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved
from .simhash import Classes, merge_classes

#: Points that codebooks and balls are fitted on, and points whose true links
#: set the stop (with so many random neighbours each).
FIT_SAMPLE, TRUTH_SAMPLE, RANDOM = 8192, 256, 16
#: Points aimed at in a cell, entries of a codebook at most, points at home
#: that a task compares at once, and visitors at once.
CELL_POINTS, MOST_ENTRIES, CHUNK, VISITORS = 512, 512, 4096, 256
#: Sample points around one of them that make it the centre of a ball.
CROWD = 8
#: Index units of a component of a unit vector.
UNITS = 1 << 14
#: Steps of the bound at which the recall curve is read.
STEPS = 256


# --------------------------------------------------------------------- points


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision."""
    x = x / np.abs(x).max(1, initial=0, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def with_keys(batches, width: int):
    """(vec_id, embedding) -> (vec_id, key, vec): a digest of the components,
    padded with zeros to ``width``, and their bytes; both null where the vector
    takes no part (null, all zero, or a null or non-finite component)."""
    for batch in batches:
        keys, vecs = [], []
        for v in batch.column(1):
            x = np.zeros(width)
            if v.is_valid and not v.values.null_count:
                x[: len(v.values)] = v.values.to_numpy(zero_copy_only=False)
            if np.isfinite(x).all() and x.any():
                raw = (x + 0.0).tobytes()  # no negative zeros
                narrow = x.astype(np.float32)
                if (narrow == x).all():
                    raw = narrow.tobytes()
                keys.append(hashlib.blake2b((x + 0.0).tobytes(), digest_size=16).digest())
                vecs.append(raw)
            else:
                keys.append(None)
                vecs.append(None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(keys, pa.binary()), pa.array(vecs, pa.binary())], ["vec_id", "key", "vec"]
        )


def units(column: pa.Array, width: int) -> np.ndarray:
    """The unit vectors of a column of component bytes."""
    rows = []
    for v in column:
        raw = v.as_buffer()
        rows.append(np.frombuffer(raw, np.float32 if raw.size == 4 * width else np.float64).astype(np.float64))
    return unit(np.stack(rows)) if rows else np.empty((0, width))


# ---------------------------------------------------------------------- index


def lloyd(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k centres of the rows (integers), from evenly spaced ones."""
    centres = x[np.linspace(0, len(x) - 1, num=k, dtype=np.int64)]
    for _ in range(rounds):
        own = ((centres * centres).sum(1) - 2 * x @ centres.T).argmin(1)
        n = np.bincount(own, minlength=k)
        total = np.zeros_like(centres)
        np.add.at(total, own, x)
        centres = np.where(n[:, None] > 0, np.floor(total / np.maximum(n, 1)[:, None]), centres)
    return np.unique(centres, axis=0)


class Index:
    """Codebooks of both halves, balls, and the bound at which a search stops."""

    def __init__(self, width: int, least: float) -> None:
        self.width, self.least, self.stop = width, least, 0.0
        self.cut = (width + 1) // 2
        self.angle = float(np.arccos(least))
        self.books: list[np.ndarray] = []
        self.between: list[np.ndarray] = []
        self.centres = np.empty((0, width))
        self.silent = np.empty(0, bool)

    def halves(self, u: np.ndarray) -> list[np.ndarray]:
        z = np.rint(u * UNITS)
        return [z[:, : self.cut], z[:, self.cut :]]

    def fit(self, sample: np.ndarray, points: int) -> None:
        """Codebooks with so many entries that a cell of the product grid has
        about CELL_POINTS points, and the centres of balls: sample points with
        a crowd around them, moved to its mean."""
        wanted = int(np.ceil(np.sqrt(max(1, points) / CELL_POINTS)))
        k = max(1, min(MOST_ENTRIES, wanted, len(sample)))
        self.books = [lloyd(h, k) for h in self.halves(sample)]
        self.between = [np.sqrt(((b[:, None, :] - b[None, :, :]) ** 2).sum(2)) for b in self.books]
        free, found = np.ones(len(sample), bool), []
        inside = np.cos(self.angle / 2)
        for i in range(len(sample)):
            if free[i]:
                crowd = free & (sample @ sample[i] >= self.least)
                if crowd.sum() >= CROWD:
                    centre = unit(sample[crowd].mean(0, keepdims=True))[0]
                    own = free & (sample @ centre >= inside)
                    if own.sum() >= CROWD:
                        found.append(centre)
                        free &= ~own
        if found:
            self.centres = np.stack(found)
            apart = self.centres @ self.centres.T < np.cos(min(np.pi, 2 * self.angle)) - 1e-9
            self.silent = (apart | np.eye(len(found), dtype=bool)).all(1)

    def borders(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(home entry of each half [n, 2], squared distance of each half to
        the region of each entry [n, 2, k]; 0 at home). A lower bound: the
        distance to the plane between an entry and the nearest one."""
        home = np.empty((len(u), 2), np.int64)
        far = np.full((len(u), 2, max(map(len, self.books))), np.inf)
        for s, (z, book, between) in enumerate(zip(self.halves(u), self.books, self.between)):
            d = (z * z).sum(1)[:, None] + (book * book).sum(1)[None, :] - 2 * z @ book.T  # exact integers
            home[:, s] = d.argmin(1)
            best = d[np.arange(len(u)), home[:, s]]
            with np.errstate(invalid="ignore", divide="ignore"):
                plane = (d - best[:, None]) / (2 * between[home[:, s]])
            plane[np.arange(len(u)), home[:, s]] = 0
            far[:, s, : len(book)] = (plane / UNITS) ** 2
        return home, far

    def visits(self, far: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(point, entry of the first half, of the second) of every cell that
        the traversal passes before its stop."""
        first, second = far[:, 0], far[:, 1]
        point, a = np.nonzero(first <= self.stop)
        at, b = np.nonzero(second[point] + first[point, a][:, None] <= self.stop)
        return point[at], a[at], b

    def balls(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ball of each point or -1, [point, ball] pairs of points outside a
        ball that could be linked to one inside)."""
        if not len(self.centres):
            return np.full(len(u), -1), np.empty((0, 2), np.int64)
        c = u @ self.centres.T
        best = c.argmax(1)
        inside = c[np.arange(len(u)), best] >= np.cos(self.angle / 2) + 1e-9
        ball = np.where(inside, best, -1)
        near = c >= np.cos(min(np.pi, 1.5 * self.angle)) - 1e-9
        near[np.arange(len(u))[inside], best[inside]] = False
        return ball, np.argwhere(near)


def multi_sequence(first: np.ndarray, second: np.ndarray):
    """Cells (bound, entry, entry) of one point in ascending order of the sum
    of both distances: the multi-sequence traversal of the two sorted lists."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, seen = [(first[a[0]] + second[b[0]], 0, 0)], {(0, 0)}
    while heap:
        d, i, j = heapq.heappop(heap)
        yield float(d), int(a[i]), int(b[j])
        for step in ((i + 1, j), (i, j + 1)):
            if step[0] < len(a) and step[1] < len(b) and step not in seen:
                seen.add(step)
                heapq.heappush(heap, (first[a[step[0]]] + second[b[step[1]]], *step))


def bound_needed(far: np.ndarray, point: np.ndarray, home: np.ndarray) -> np.ndarray:
    """The bound at which a search from each ``point`` (number of a row of
    ``far``) reaches the cell ``home`` (both entries)."""
    return far[point, 0, home[:, 0]] + far[point, 1, home[:, 1]]


def random_neighbours(u: np.ndarray, least: float, each: int) -> np.ndarray:
    """Unit vectors at exactly the least cosine, in random directions."""
    rng = np.random.default_rng(13)
    u = np.repeat(u, each, axis=0)
    w = rng.normal(size=u.shape)
    w -= (w * u).sum(1, keepdims=True) * u
    size = np.sqrt((w * w).sum(1, keepdims=True))
    return least * u + np.sqrt(1 - least * least) * w / np.where(size > 0, size, 1)


def steps(needed: np.ndarray, top: float) -> np.ndarray:
    """How often each step of the bound is the first that reaches."""
    at = np.minimum(np.ceil(needed / top * STEPS), STEPS + 1).astype(np.int64)
    return np.bincount(at, minlength=STEPS + 2)


def true_links(batches, index: Index, ids: np.ndarray, queries: np.ndarray, far: np.ndarray, top: float):
    """(id, vec) -> (step, n): true links of the sampled points to all other
    points, by the step of the bound at which the search reaches them."""
    curve = np.zeros(STEPS + 2, np.int64)
    for batch in batches:
        other, u = batch.column(0).to_numpy(), units(batch.column(1), index.width)
        for i in range(0, len(u), VISITORS):
            own = u[i : i + VISITORS]
            q, v = np.nonzero((queries @ own.T >= index.least) & (ids[:, None] != other[None, i : i + VISITORS]))
            home, _ = index.borders(own)
            curve += steps(bound_needed(far, q, home[v]), top)
    used = np.flatnonzero(curve)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(curve[used])], ["step", "n"])


def stop_at(curve: np.ndarray, recall: float) -> int:
    """The first step up to which ``recall`` of the curve lies."""
    reached = np.cumsum(curve)
    return int(np.searchsorted(reached, recall * reached[-1])) if reached[-1] else 0


# --------------------------------------------------------------------- search


def place(batches, index: Index):
    """(id, weight, vec) -> (id, ball, cell, near): where a point lives, and
    the balls it is near to."""
    for batch in batches:
        u = units(batch.column(2), index.width)
        ball, near = index.balls(u)
        home, _ = index.borders(u)
        close = [[] for _ in range(len(u))]
        for i, b in near.tolist():
            close[i].append(b)
        cell = home[:, 0] * MOST_ENTRIES + home[:, 1]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                batch.column(2),
                pa.array(ball, pa.int32(), mask=ball < 0),
                pa.array(cell),
                pa.array(close, pa.list_(pa.int32())),
            ],
            ["id", "weight", "vec", "ball", "cell", "near"],
        )


def scatter(batches, index: Index):
    """(id, weight, vec, ball, cell) -> the same with the cell visited and
    ``own`` (the home cell)."""
    for batch in batches:
        if len(index.centres):  # points of a ball far from all others are only found
            silent = index.silent[batch.column(3).fill_null(0).to_numpy(zero_copy_only=False)]
            batch = batch.filter(pa.array(~(silent & batch.column(3).is_valid().to_numpy(zero_copy_only=False))))
        for i in range(0, batch.num_rows, VISITORS):
            part = batch.slice(i, VISITORS)
            _, far = index.borders(units(part.column(2), index.width))
            point, a, b = index.visits(far)
            rows = part.take(pa.array(point))
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in range(4)), rows.column(4), pa.array(a * MOST_ENTRIES + b)],
                ["id", "weight", "vec", "ball", "own", "cell"],
            )


class Chunk:
    """Points at home in a cell (or a share of them), and what was found."""

    def __init__(self, index: Index, rows: pa.RecordBatch) -> None:
        self.index = index
        self.id = rows.column(0).to_numpy()
        self.weight = rows.column(1).to_numpy()
        self.u = units(rows.column(2), index.width)
        self.ball = rows.column(3).fill_null(-1).to_numpy(zero_copy_only=False)
        _, self.far = index.borders(self.u)
        silent = np.r_[index.silent, False]  # the last one: of no ball
        self.silent = silent[self.ball]
        self.classes = Classes(len(self.id))
        self.linked = np.zeros(len(self.id), np.int64)
        self.met = np.zeros(len(self.id), bool)

    def meet(self, rows: pa.RecordBatch) -> pa.RecordBatch:
        """Visitors -> (node, links, hub) of those linked to a point here. A
        point here that does not visit the visitor's home gets its link too."""
        ids, weight = rows.column(0).to_numpy(), rows.column(1).to_numpy()
        ball = rows.column(3).fill_null(-1).to_numpy(zero_copy_only=False)
        own = rows.column(4).to_numpy()
        u = units(rows.column(2), self.index.width)
        q, v = np.nonzero(u @ self.u.T >= self.index.least)
        other = (ids[q] != self.id[v]) & ~((ball[q] >= 0) & (ball[q] == self.ball[v]))
        q, v = q[other], v[other]
        links = np.zeros(len(ids), np.int64)
        np.add.at(links, q, self.weight[v])
        back = np.stack([own[q] // MOST_ENTRIES, own[q] % MOST_ENTRIES], 1)
        blind = self.silent[v] | (bound_needed(self.far, v, back) > self.index.stop)
        np.add.at(self.linked, v[blind], weight[q[blind]])
        first = np.full(len(ids), len(self.id))
        np.minimum.at(first, q, v)
        self.met[v] = True
        self.classes.link(first[q], v)
        some = np.flatnonzero(links)
        return answer(ids[some], links[some], self.id[first[some]])

    def rest(self) -> pa.RecordBatch:
        """Rows of the points here: their class in the chunk, and themselves."""
        label = self.classes.merge()
        met = np.flatnonzero(self.met)
        return answer(
            np.r_[self.id[met], self.id[met]],
            np.r_[self.linked[met], np.zeros(len(met), np.int64)],
            np.r_[self.id[label[met]], self.id[met]],
        )


def answer(node, links, hub) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(node), pa.array(links), pa.array(hub)], ["node", "links", "hub"])


def verify(batches, index: Index):
    """(cell, share, visitor, id, weight, vec, ball, own) sorted by the first
    three -> (node, links, hub)."""
    key, home, chunk = None, [], None

    def full() -> Chunk:
        return Chunk(index, pa.Table.from_batches(home).combine_chunks().to_batches()[0])

    for batch in batches:
        names = zip(*(batch.column(c).to_pylist() for c in range(3)))
        cuts, last = [], None
        for i, name in enumerate(names):
            if name != last:
                cuts.append((i, name))
                last = name
        cuts.append((batch.num_rows, None))
        for (a, (cell, share, visitor)), (b, _) in zip(cuts, cuts[1:]):
            rows = batch.slice(a, b - a).select(range(3, 8))
            if (cell, share) != key:
                if chunk:
                    yield chunk.rest()
                key, home, chunk = (cell, share), [], None
            if not visitor:
                home.append(rows)
                continue
            if not home:
                continue  # a visit to an empty share
            chunk = chunk or full()
            for i in range(0, rows.num_rows, VISITORS):
                yield chunk.meet(rows.slice(i, VISITORS))
    if chunk:
        yield chunk.rest()


# ------------------------------------------------------------------ operators


def build(points: DataFrame, width: int, least: float, recall: float) -> Index:
    """The index over ``points`` (id, weight, vec): codebooks and balls from a
    sample of FIT_SAMPLE of them, the stop from the true links of TRUTH_SAMPLE
    of them to all points, and from random neighbours of these."""
    index = Index(width, least)
    sample = points.orderBy(F.xxhash64("vec"), "id").select("id", "vec").limit(FIT_SAMPLE).toArrow().combine_chunks()
    ids = sample["id"].to_numpy()[:TRUTH_SAMPLE]
    u = units(sample["vec"].combine_chunks(), width)
    if not len(u):
        return index
    index.fit(u, points.count())
    top = 2 - 2 * least  # no neighbour is farther than this bound
    queries = u[:TRUTH_SAMPLE]
    _, far = index.borders(queries)
    counted = points.select("id", "vec").mapInArrow(
        partial(true_links, index=index, ids=ids, queries=queries, far=far, top=top), "step long, n long"
    )
    curve = np.zeros(STEPS + 2, np.int64)
    for r in counted.groupBy("step").agg(F.sum("n").alias("n")).collect():
        curve[r.step] = r.n
    home, _ = index.borders(random_neighbours(queries, least, RANDOM))
    chance = steps(bound_needed(far, np.repeat(np.arange(len(queries)), RANDOM), home), top)
    index.stop = max(stop_at(curve, recall), stop_at(chance, recall)) * top / STEPS
    return index


def near_duplicates(vectors: DataFrame, least: float = 0.95, recall: float = 0.95) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding): vec_id, n_links,
    component_id, kept.

    Two rows are linked if the cosine of their vectors, in double precision, is
    at least ``least`` (over 0). A search from either end finds at least about
    ``recall`` of the links, so both together find more, and none below it. ``n_links`` counts the other rows linked
    directly, ``component_id`` is the smallest non-null vec_id reachable, the
    own one included (null if there is none), ``kept`` whether both ids are the
    same (also if both are null).

    Null, empty and all-zero vectors, and those with a null or non-finite
    component, are linked to nothing. Vectors of different length are padded
    with zeros. Repeated rows and ids count as rows each; an empty table gives
    an empty table; other columns are ignored.
    """
    if not 0 < least <= 1:
        raise ValueError("the least cosine has to be over 0, and 1 at most")
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    width = max(2, vectors.agg(F.max(F.size("embedding"))).first()[0] or 0)
    doubles = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    keyed = doubles.mapInArrow(partial(with_keys, width=width), f"vec_id {id_type}, key binary, vec binary")
    rows = saved(keyed, "vectors-rows")
    whole = rows.where("key is not null").groupBy("key")
    points = whole.agg(
        F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("weight"), F.first("vec").alias("vec")
    )
    points = saved(points.withColumn("id", F.monotonically_increasing_id()), "vectors-points")
    index = build(points, width, least, recall)
    found = saved(classes_of(points, index), "vectors-classes")
    smallest = saved(found.groupBy("label").agg(F.min("first_id").alias("component_id")), "vectors-components")
    named = found.join(smallest, "label").select("key", "component_id", F.col("links").alias("n_links"))
    linked = rows.where("key is not null").select("vec_id", "key").join(named, "key")
    apart = rows.where("key is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    both = linked.select("vec_id", "n_links", "component_id").unionByName(apart)
    return both.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def classes_of(points: DataFrame, index: Index) -> DataFrame:
    """``points`` as (key, first_id, links, label): links to other rows, and
    the name of the class (any long)."""
    # Points of closed balls (no point outside can be linked) are done here.
    spot = "id long, weight long, vec binary, ball int, cell long, near array<int>"
    if not index.books:
        return points.select("key", "first_id", (F.col("weight") - 1).alias("links"), F.col("id").alias("label"))
    placed = saved(points.select("id", "weight", "vec").mapInArrow(partial(place, index=index), spot), "vectors-placed")
    # A row per ball: its weight, and whether a point outside could be linked.
    inside = placed.where("ball is not null").groupBy("ball").agg(F.sum("weight").alias("ball_weight"))
    near = placed.select(F.explode("near").alias("ball")).groupBy("ball").agg(F.lit(True).alias("touched"))
    balls = saved(inside.join(near, "ball", "left").withColumn("touched", F.coalesce("touched", F.lit(False))), "vectors-balls")
    open_balls = balls.where("touched").select("ball", "touched")
    sought = placed.join(open_balls, "ball", "left").where("ball is null or touched")
    sought = saved(sought.select("id", "weight", "vec", "ball", "cell"), "vectors-sought")

    shares = saved(
        sought.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(CHUNK)).cast("int").alias("shares")), "vectors-cells"
    )
    columns = ["cell", "share", "visitor", "id", "weight", "vec", "ball", "own"]
    home = sought.join(shares, "cell").withColumn("share", F.pmod(F.xxhash64("id"), "shares").cast("int"))
    home = home.withColumn("visitor", F.lit(False)).withColumn("own", F.col("cell")).select(columns)
    visits = sought.select("id", "weight", "vec", "ball", "cell").mapInArrow(
        partial(scatter, index=index), "id long, weight long, vec binary, ball int, own long, cell long"
    )
    visits = visits.join(shares, "cell").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    visits = visits.withColumn("visitor", F.lit(True)).select(columns)
    met = (
        home.unionByName(visits)
        .repartition("cell", "share")
        .sortWithinPartitions("cell", "share", "visitor")
        .mapInArrow(partial(verify, index=index), "node long, links long, hub long")
    )
    met = saved(met, "vectors-links")
    of_balls = sought.where("ball is not null").select(
        F.col("id").alias("node"), (-1 - F.col("ball").cast("long")).alias("hub")
    )
    label = merge_classes(met.select("node", "hub").unionByName(of_balls).distinct())
    counted = met.groupBy(F.col("node").alias("id")).agg(F.sum("links").alias("met"))
    return (
        points.drop("vec", "weight")
        .join(placed.select("id", "weight", "ball"), "id")
        .join(balls.select("ball", "ball_weight"), "ball", "left")
        .join(counted, "id", "left")
        .join(label.withColumnRenamed("node", "id"), "id", "left")
        .select(
            "key",
            "first_id",
            (F.coalesce("ball_weight", "weight") - 1 + F.coalesce("met", F.lit(0))).alias("links"),
            F.coalesce("label", -1 - F.col("ball").cast("long"), "id").alias("label"),
        )
    )
