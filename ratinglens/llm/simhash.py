"""SimHash near-duplicates by vantage-point trees over Hamming distance.

1. A 64-bit fingerprint per text (bit majority over shingle hashes).
2. Distinct fingerprints are routed through the top of a vantage-point tree
   (fitted on a bounded sample; every fingerprint is routed). Each lands in
   its home shard and, as a visitor, in every shard whose region its ball of
   ``max_bits`` overlaps, so no pair across a boundary is lost. A shard that
   is still too large is split by a subtree fitted, in a task, on a bounded
   sample of that shard, round after round, so shards keep their size
   whatever the number of fingerprints.
3. Each shard grows its own tree, prunes by the triangle inequality and
   compares whole leaves; it emits one row per linked fingerprint (its local
   class), never all pairs.
4. Local classes are merged over shards by min-label rounds (partial
   aggregates and joins; labels written to the shared folder each round).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import quoted, saved

#: Distinct fingerprints from which the top of the tree, and about a quarter of
#: these, from which each subtree is fitted.
FIT_SAMPLE = 8192
#: Distinct fingerprints that a shard is at home for: the aim of each split. A
#: shard of over twice as many is split again.
SHARD_FINGERPRINTS = 32768
#: Fewest sampled points in a node that is split, so that its halves are even.
NODE_SAMPLE = 16
LEAF = 128


# ------------------------------------------------------------- fingerprints


def fingerprint(text: str | None, width: int = 3) -> int:
    """Unsigned fingerprint of one text (see ``fingerprint_column``)."""
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    if len(w) < width:
        w = [b" ".join(w)]
        shingles = iter(w)
        n = 1
    else:
        n = len(w) - width + 1
        shingles = map(b" ".join, zip(*(w[i:] for i in range(width))))
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    left = n
    while left:  # a very long text goes through in blocks
        m = min(left, 1 << 16)
        h = np.fromiter((digest(next(shingles), 42) for _ in range(m)), np.uint64, m)
        ones += np.unpackbits(h.view(np.uint8).reshape(m, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        left -= m
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprint_column(text: Column, width: int = 3) -> Column:
    """Fingerprint as a signed long: lower-cased (A-Z) words, ``width``-word
    shingles with repeats, XXH64 seed 42, a bit is 1 if set in over half of
    the hashes. Fewer words: the whole sequence is the shingle; none: 0."""

    @F.pandas_udf(LongType())
    def fp(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield pd.Series(np.array([fingerprint(t, width) for t in s], np.uint64).view(np.int64))

    return fp(text)


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# --------------------------------------------------------- vantage-point tree


def distance(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int16)


def choose_split(points: np.ndarray, band: int, tries: int = 8) -> tuple[np.uint64, int] | None:
    """Vantage point and radius with the fewest points in the boundary band
    among near-even splits; None if no vantage point tried splits the points."""
    best, best_cost = None, None
    for v in points[np.linspace(0, len(points) - 1, num=min(tries, len(points)), dtype=np.int64)]:
        counts = np.bincount(distance(points, v), minlength=66)
        below = np.cumsum(counts)
        for radius in range(65):
            left = int(below[radius])
            right = len(points) - left
            if min(left, right) * 4 < len(points):
                continue
            lo, hi = max(0, radius - band + 1), min(65, radius + band)
            cost = int(counts[lo : hi + 1].sum()) + abs(left - right) // 4
            if best_cost is None or cost < best_cost:
                best, best_cost = (v, radius), cost
    return best


def fit_top(sample: np.ndarray, depth: int, band: int) -> list:
    """Top of the tree as nested [vantage, radius, left, right]; a leaf is its
    shard number."""
    count = iter(range(1 << 30))

    def grow(points: np.ndarray, level: int):
        split = choose_split(points, band, 16) if level < depth and len(points) >= NODE_SAMPLE else None
        if split is None:
            return next(count)
        v, radius = split
        d = distance(points, v)
        return [int(v), radius, grow(points[d <= radius], level + 1), grow(points[d > radius], level + 1)]

    return grow(sample, 0)


def fit_subtree(sample: np.ndarray, depth: int, band: int):
    """The deepest tree of at most ``depth`` levels that parts the sample: no
    leaf keeps over 9/10 of it, visitors included, and a level adds at most
    3/5 to the rows. None if there is none: a cluster so dense that nearly
    every point is within reach of any boundary gains nothing from a split."""
    for levels in range(depth, 0, -1):
        tree = fit_top(sample, levels, band)
        if isinstance(tree, int):
            return None
        _, leaf, _ = route(sample, tree, band)
        load = np.bincount(leaf)
        if load.max() <= 0.9 * len(sample) and load.sum() <= 1.6**levels * len(sample):
            return tree
    return None


def renumber(tree, number):
    """The tree with leaves numbered anew by ``number``, an iterator."""
    if isinstance(tree, int):
        return next(number)
    v, radius, left, right = tree
    return [v, radius, renumber(left, number), renumber(right, number)]


def route(points: np.ndarray, tree, band: int, at_home: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(point index, shard, at home) for every shard that each point belongs to;
    the points are at home in the tree's region, or visitors of it.

    A point right of a boundary visits the left side if its ball reaches it;
    a visitor follows every side that its ball overlaps. Of two linked points
    parted by a node, the right one visits the left one's home."""
    out: list[tuple[np.ndarray, int, bool]] = []

    def walk(index: np.ndarray, node, home: bool) -> None:
        if not len(index):
            return
        if isinstance(node, int):
            out.append((index, node, home))
            return
        v, radius, left, right = node
        d = distance(points[index], np.uint64(v))
        if home:
            walk(index[d <= radius], left, True)
            walk(index[d > radius], right, True)
            walk(index[(d > radius) & (d <= radius + band)], left, False)
        else:
            walk(index[d <= radius + band], left, False)
            walk(index[d > radius - band], right, False)

    walk(np.arange(len(points)), tree, at_home)
    if not out:
        e = np.empty(0, np.int64)
        return e, e.astype(np.int32), e.astype(bool)
    return (
        np.concatenate([i for i, _, _ in out]),
        np.concatenate([np.full(len(i), s, np.int32) for i, s, _ in out]),
        np.concatenate([np.full(len(i), h, bool) for i, _, h in out]),
    )


class Classes:
    """Classes of point numbers, merged from arrays of links."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)
        self.pending: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        self.pending.append((a, b))
        self.waiting += len(a)
        if self.waiting > 200_000:
            self.merge()

    def merge(self) -> np.ndarray:
        if self.pending:
            a = np.concatenate([x for x, _ in self.pending])
            b = np.concatenate([x for _, x in self.pending])
            self.pending, self.waiting = [], 0
            while True:
                la, lb = self.label[a], self.label[b]
                differ = la != lb
                if not differ.any():
                    break
                a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
                np.minimum.at(self.label, np.maximum(la, lb), np.minimum(la, lb))
                while not np.array_equal(up := self.label[self.label], self.label):
                    self.label = up
        return self.label


def shard_classes(points: np.ndarray, home: np.ndarray, band: int) -> np.ndarray:
    """Smallest class member (by number) of each point, linking every pair
    within ``band`` bits of which at least one is at home."""
    classes = Classes(len(points))

    def leaf(homes: np.ndarray, visitors: np.ndarray) -> None:
        others = np.concatenate([homes, visitors])
        step = max(1, (1 << 22) // max(1, len(others)))
        for i in range(0, len(homes), step):
            part = homes[i : i + step]
            near = np.bitwise_count(points[part][:, None] ^ points[others][None, :]) <= band
            a, b = np.nonzero(near)
            a, b = part[a], others[b]
            differ = a != b
            classes.link(a[differ], b[differ])

    stack = [(np.flatnonzero(home), np.flatnonzero(~home))]
    while stack:
        homes, visitors = stack.pop()
        split = choose_split(points[homes], band, 4) if len(homes) > LEAF else None
        if split is None:
            if len(homes):
                leaf(homes, visitors)
            continue
        v, radius = split
        dh, dv = distance(points[homes], v), distance(points[visitors], v)
        reach = homes[(dh > radius) & (dh <= radius + band)]
        stack.append((homes[dh <= radius], np.concatenate([visitors[dv <= radius + band], reach])))
        stack.append((homes[dh > radius], visitors[dv > radius - band]))
    return classes.merge()


# --------------------------------------------------------------- on the table


ROUTED = "shard int, fp long, home boolean"


def routed_batch(points: np.ndarray, shard: np.ndarray, home: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(shard.astype(np.int32)), pa.array(points), pa.array(home)], ["shard", "fp", "home"]
    )


def shards(distinct: DataFrame, max_bits: int, size: int, sample: int) -> DataFrame:
    """(shard, fp, home): every fingerprint at home in one shard and a visitor
    of those that its ball overlaps, with about ``size`` at home in a shard.

    The top of the tree comes from ``sample`` fingerprints; then shards with
    over twice ``size`` at home are split, each by a subtree that a task fits
    on about a quarter of ``sample`` of its own points. What passes the driver
    is a node (a vantage point and a radius) per shard, never points. A shard
    that ``fit_subtree`` cannot part stays whole."""
    n = distinct.count()
    levels = max(3, int(np.ceil(np.log2(max(1, n) / size))))
    chosen = distinct.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(sample).collect()
    points = np.array([r.fp for r in chosen], np.int64).view(np.uint64)
    tree = fit_top(points, min(levels, max(1, int(np.log2(max(2, sample) / (2 * NODE_SAMPLE))))), max_bits)

    def scatter(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            i, shard, home = route(fps.view(np.uint64), tree, max_bits)
            yield routed_batch(fps[i], shard, home)

    routed = saved(distinct.select("fp").mapInArrow(scatter, ROUTED), "simhash-routed")
    last = routed.agg(F.max("shard")).first()[0]
    number = iter(range((-1 if last is None else last) + 1, 1 << 31))
    whole: list[int] = []  # shards that no subtree parts

    for turn in range(64):
        large = routed.where("home").groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 2 * size)
        if whole:
            large = large.where(~F.col("shard").isin(whole))
        subtrees = fitted_subtrees(routed, large, max_bits, size, max(4 * NODE_SAMPLE, sample // 4), turn)
        whole += [s for s, t in subtrees.items() if t is None]
        split = {s: renumber(t, number) for s, t in subtrees.items() if t is not None}
        if not subtrees:
            break
        if split:
            routed = saved(routed.mapInArrow(rerouting(split, max_bits), ROUTED), "simhash-routed")
    return routed


def fitted_subtrees(routed: DataFrame, large: DataFrame, band: int, size: int, sample: int, turn: int) -> dict:
    """Subtree (or None) of each of the ``large`` shards (shard, n), fitted in
    tasks on about ``sample`` of the shard's home points, chosen by hash."""

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        points = np.sort(part["fp"].to_numpy()).view(np.uint64)
        levels = max(1, int(np.ceil(np.log2(part["n"].iloc[0] / size))))
        tree = fit_subtree(points, min(levels, max(1, int(np.log2(sample / (2 * NODE_SAMPLE))))), band)
        return pd.DataFrame({"shard": part["shard"].iloc[:1], "tree": [json.dumps(tree)]})

    chosen = (
        routed.where("home")
        .join(large, "shard")
        .where(F.pmod(F.xxhash64("fp", F.lit(turn)), F.col("n")) < sample)
        .select("shard", "n", "fp")
    )
    fitted = chosen.groupBy("shard").applyInPandas(fit, "shard int, tree string")
    return {r.shard: json.loads(r.tree) for r in fitted.collect()}


def rerouting(split: dict, band: int):
    """Rows of split shards go to the leaves of their subtree, others stay."""

    cut_shards = np.array(list(split), np.int32)

    def move(batches):
        for batch in batches:
            shard, fps, home = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            cut = np.isin(shard, cut_shards)
            parts = [(fps[~cut], shard[~cut], home[~cut])]
            order = np.flatnonzero(cut)[np.lexsort((home[cut], shard[cut]))]
            group = shard[order] * np.int64(2) + home[order]
            for at in np.split(order, np.flatnonzero(np.diff(group)) + 1):
                if len(at):
                    own = fps[at]
                    i, leaf, stays = route(own.view(np.uint64), split[int(shard[at[0]])], band, bool(home[at[0]]))
                    parts.append((own[i], leaf, stays))
            yield routed_batch(*(np.concatenate(c) for c in zip(*parts)))

    return move


def local_classes(
    distinct: DataFrame, max_bits: int, size: int = SHARD_FINGERPRINTS, sample: int = FIT_SAMPLE
) -> DataFrame:
    """(node, hub): every linked fingerprint with the smallest fingerprint of
    its class in a shard; the hub has a row of its own."""

    def classes(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["fp", "home"])
        fps = part["fp"].to_numpy()
        label = shard_classes(fps.view(np.uint64), part["home"].to_numpy(), max_bits)
        linked = np.bincount(label, minlength=len(label))[label] > 1
        return pd.DataFrame({"node": fps[linked], "hub": fps[label[linked]]})

    return shards(distinct, max_bits, size, sample).groupBy("shard").applyInPandas(classes, "node long, hub long")


def merge_classes(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable over rows sharing a hub.

    Each round takes the minimum over a hub's nodes, then over a node's hubs,
    then jumps to the label's label; both minima are partial aggregates, so a
    class with a third of all rows is combined before it is shuffled."""
    label = saved(links.groupBy("node").agg(F.min("hub").alias("label")), "simhash-label")
    while True:
        by_hub = links.join(label, "node").groupBy("hub").agg(F.min("label").alias("label"))
        low = links.join(by_hub, "hub").groupBy("node").agg(F.min("label").alias("low"))
        up = label.select(F.col("node").alias("low"), F.col("label").alias("up"))
        step = (
            low.join(label.withColumnRenamed("label", "old"), "node")
            .join(up, "low", "left")
            .select("node", F.least("low", "up").alias("label"), "old")
        )
        step = saved(step, "simhash-label")
        label = step.select("node", "label")
        if step.where("label < old").isEmpty():
            return label


def class_labels(distinct: DataFrame, max_bits: int) -> DataFrame:
    """``distinct`` (one row per fingerprint ``fp``) with ``label``: the
    smallest fingerprint of its class."""
    label = merge_classes(saved(local_classes(distinct, max_bits), "simhash-links"))
    named = distinct.join(label.withColumnRenamed("node", "fp"), "fp", "left")
    return named.withColumn("label", F.coalesce("label", "fp"))


def near_duplicates(docs: DataFrame, max_bits: int = 2, width: int = 3) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp (signed long), component_id,
    label (smallest fingerprint of the class).

    Texts whose fingerprints differ in ``max_bits`` bits or fewer are linked;
    a class is everything reachable; ``component_id`` is its smallest non-null
    doc_id (null if it has none). Null, empty and blank texts have fingerprint
    0 and link like any other. Repeated rows come back as often as they came;
    an empty table gives an empty table; other columns are ignored.
    """
    rows = saved(docs.select("doc_id", fingerprint_column(F.col("text"), width).alias("fp")), "simhash-fp")
    distinct = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    named = class_labels(distinct, max_bits)
    smallest = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    classes = named.select("fp", "label").join(smallest, "label")
    return rows.join(classes, "fp").select("doc_id", "fp", "component_id", "label")


def keep_one(docs: DataFrame, max_bits: int = 2, width: int = 3) -> DataFrame:
    """``docs`` with one row of each near-duplicate class: the one with the
    smallest doc_id, a row without one only where the whole class has none
    (ties: by a hash of the text, then any one row).

    Rows are told apart by a number saved with them, so rows without a doc_id
    and different texts under one doc_id are judged like all others. Columns
    of any name pass through (names starting with ``_simhash_`` are reserved).
    """
    own = F.struct(
        F.col("doc_id").isNull().alias("no_id"),
        F.col("doc_id").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = docs.withColumn("_simhash_own", own).withColumn("_simhash_fp", fingerprint_column(F.col("text"), width))
    rows = saved(rows.withColumn("_simhash_row", F.col("_simhash_own.row")), "simhash-rows")
    first = rows.groupBy(F.col("_simhash_fp").alias("fp")).agg(F.min("_simhash_own").alias("first"))
    named = class_labels(saved(first, "simhash-distinct"), max_bits)
    stay = named.groupBy("label").agg(F.min("first").alias("first")).select(F.col("first.row").alias("_simhash_row"))
    # A table of row numbers is built per partition; the texts stream past it unsorted.
    return rows.join(stay.hint("shuffle_hash"), "_simhash_row", "left_semi").select([quoted(c) for c in docs.columns])
