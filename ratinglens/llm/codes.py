"""Vector code compression: product codebooks by dual-tree Lloyd rounds.

Vectors become integers and are cut into equal parts; each part position has a
codebook of entries. A block of vectors keeps, per part position, a balanced
tree over its parts (the order of the leaves is saved once); a codebook gets a
tree of its own in each round. Both trees are descended together: the bounding
boxes of a pair of nodes bound the distance of everything below them, so a pair
is dropped as soon as another entry node is surely nearer, and a node for which
one entry is left is assigned whole, by its cached count and sums. What stays
uncertain down to the leaves is decided by integer distances.

A task sends one row per entry component; the driver holds the codebooks only.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

#: Vectors in a block and, about, in a leaf of its trees; distances at once.
BLOCK, LEAF, AT_ONCE = 4096, 32, 1 << 19
#: Components are held within this bound; sums of squares pass a long beyond.
WIDEST, LONG = 1 << 62, (1 << 63) - 1


def quantised(vectors: DataFrame, scale: int = 4096) -> DataFrame:
    """(vec_id, label, v array<long>): floor(scale * x) of each component as
    double, within plus and minus 2^62; rows without a vector, or with a null
    or non-finite component, are out. Without a label column it is null."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    limit = float(WIDEST)

    def whole(c: Column) -> Column:
        return F.floor(F.greatest(F.lit(-limit), F.least(F.lit(limit), c * scale))).cast("long")

    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int").alias("label")
    kept = vectors.where(F.col("embedding").isNotNull()).where(~bad)
    return kept.select("vec_id", label, F.transform(x, whole).alias("v"))


# ---------------------------------------------------------------------- trees


def halves(x: np.ndarray, leaves: int) -> np.ndarray:
    """Order of the points in which the leaves of a balanced tree, split in the
    middle of the widest dimension, are equal slices."""
    order = np.arange(len(x))
    bounds = slices(len(x), leaves)

    def split(a: int, b: int) -> None:  # the leaves from a to b
        if b - a < 2:
            return
        lo, hi = bounds[a], bounds[b]
        own = x[order[lo:hi]]
        widest = int(np.argmax(own.max(0) - own.min(0)))
        order[lo:hi] = order[lo:hi][np.argsort(own[:, widest], kind="stable")]
        split(a, (a + b) // 2)
        split((a + b) // 2, b)

    split(0, leaves)
    return order


def slices(n: int, leaves: int) -> np.ndarray:
    return n * np.arange(leaves + 1) // leaves


def leaves_for(n: int, leaf: int) -> int:
    """A power of two, with at least one point to a leaf."""
    return 1 << max(0, min(n // max(1, leaf), n).bit_length() - 1)


class Tree:
    """Boxes, counts and sums of the nodes of every level, root first."""

    def __init__(self, x: np.ndarray, leaves: int) -> None:
        self.x, self.bounds = x, slices(len(x), leaves)
        starts = self.bounds[:-1]
        level = (
            np.minimum.reduceat(x, starts),
            np.maximum.reduceat(x, starts),
            np.add.reduceat(x, starts),
            np.diff(self.bounds),
        )
        self.levels = [level]
        while len(level[3]) > 1:
            lo, hi, total, n = level
            level = (
                np.minimum(lo[::2], lo[1::2]),
                np.maximum(hi[::2], hi[1::2]),
                total[::2] + total[1::2],
                n[::2] + n[1::2],
            )
            self.levels.insert(0, level)

    def span(self, level: int, node: int) -> tuple[int, int]:
        """The points of a node."""
        wide = (len(self.bounds) - 1) >> level
        return int(self.bounds[node * wide]), int(self.bounds[(node + 1) * wide])


def box_bounds(lo, hi, other_lo, other_hi) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared distance between points of paired boxes."""
    apart = np.maximum(np.maximum(lo - other_hi, other_lo - hi), 0)
    reach = np.maximum(hi - other_lo, other_hi - lo)
    return (apart * apart).sum(1), (reach * reach).sum(1)


def exact_ints(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays as int64 where squared distances fit, else as Python ints."""
    top = max((max(abs(int(a.max())), abs(int(a.min()))) for a in arrays if a.size), default=0)
    width = max((a.shape[-1] for a in arrays), default=1)
    kind = np.int64 if max(1, width) * (2 * top + 1) ** 2 < 1 << 62 else object
    return [a.astype(kind) for a in arrays]


class Assignment:
    """Nearest entry (ties: lower index) of every point of a tree."""

    def __init__(self, points: Tree, entries: np.ndarray, codes: bool = False) -> None:
        self.points, self.k = points, len(entries)
        order = halves(entries, leaves_for(len(entries), 1))
        self.names, self.entries = order, entries
        self.tree = Tree(entries[order], leaves_for(len(entries), 1))
        self.n = np.zeros(self.k, np.int64)
        self.sums = np.zeros(entries.shape, points.x.dtype)
        self.codes = np.zeros(len(points.x), np.int64) if codes else None
        self.pruned = self.whole = self.uncertain = 0
        if len(points.x):
            self.descend()

    def entry_boxes(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if level < len(self.tree.levels):
            return self.tree.levels[level][0][nodes], self.tree.levels[level][1][nodes]
        return self.tree.x[nodes], self.tree.x[nodes]  # single entries

    def descend(self) -> None:
        points, entry_depth = self.points, len(self.tree.levels)
        p, e, lp, le = np.zeros(1, np.int64), np.zeros(1, np.int64), 0, 0
        while len(p):
            lo, hi = points.levels[lp][0][p], points.levels[lp][1][p]
            near, far = box_bounds(lo, hi, *self.entry_boxes(le, e))
            first = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
            best = np.minimum.reduceat(far, first)
            stay = (near <= np.repeat(best, np.diff(np.r_[first, len(p)]))).astype(bool)
            self.pruned += int((~stay).sum())
            p, e = p[stay], e[stay]
            if le == entry_depth:  # nodes with one entry left are decided whole
                alone = np.r_[True, p[1:] != p[:-1]] & np.r_[p[1:] != p[:-1], True]
                self.assign(lp, p[alone], self.names[e[alone]])
                p, e = p[~alone], e[~alone]
                if lp == len(points.levels) - 1:
                    self.decide(p, e)
                    return
            if le < entry_depth:
                p, e = self.open_entries(p, e, le)
                le += 1
            if lp < len(points.levels) - 1:
                # Both children of a point node meet the node's entries.
                p, e = np.r_[2 * p, 2 * p + 1], np.r_[e, e]
                order = np.argsort(p, kind="stable")
                p, e, lp = p[order], e[order], lp + 1

    def open_entries(self, p: np.ndarray, e: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        if level < len(self.tree.levels) - 1:
            return np.repeat(p, 2), np.stack([2 * e, 2 * e + 1], 1).ravel()
        start, n = self.tree.bounds[e], np.diff(self.tree.bounds)[e]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(p, n), np.repeat(start, n) + within

    def assign(self, level: int, nodes: np.ndarray, entries: np.ndarray) -> None:
        _, _, total, n = self.points.levels[level]
        np.add.at(self.n, entries, n[nodes])
        np.add.at(self.sums, entries, total[nodes])
        self.whole += len(nodes)
        if self.codes is not None:
            for node, entry in zip(nodes.tolist(), entries.tolist()):
                self.codes[slice(*self.points.span(level, node))] = entry

    def decide(self, p: np.ndarray, e: np.ndarray) -> None:
        """Leaves with several entries left: integer distances of each point."""
        x, bounds = self.points.x, self.points.bounds
        step = max(1, AT_ONCE // max(1, int(np.diff(bounds).max()) * x.shape[1] * self.k))
        starts = np.flatnonzero(np.r_[True, p[1:] != p[:-1]][: len(p)])
        for i in range(0, len(starts), step):
            end = starts[i + step] if i + step < len(starts) else len(p)
            own_p, own_e = p[starts[i] : end], e[starts[i] : end]
            n = np.diff(bounds)[own_p]
            at = np.repeat(bounds[own_p], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            entry = np.repeat(own_e, n)
            apart = x[at] - self.tree.x[entry]
            rows, row = np.unique(at, return_inverse=True)
            far = np.full((len(rows), self.k), 4 * int(apart.size and np.abs(apart).max() ** 2 * x.shape[1]) + 1, x.dtype)
            far[row, self.names[entry]] = (apart * apart).sum(1)
            chosen = np.argmin(far, axis=1).astype(np.int64)
            np.add.at(self.n, chosen, 1)
            np.add.at(self.sums, chosen, x[rows])
            self.uncertain += len(rows)
            if self.codes is not None:
                self.codes[rows] = chosen


# --------------------------------------------------------------------- blocks


def pack(batches, parts: int, width: int):
    """(vec_id, label, v) -> blocks (ids, labels, size, vals, orders): integers
    padded with zeros, and the leaf order of each part position."""
    for batch in batches:
        for i in range(0, batch.num_rows, BLOCK):
            own = batch.slice(i, BLOCK)
            v = own.column(2)
            n = len(v)
            lengths = np.diff(v.offsets.to_numpy())
            x = np.zeros((n, width), np.int64)
            x[np.arange(width)[None, :] < lengths[:, None]] = v.flatten().to_numpy(zero_copy_only=False)
            for kind in (np.int16, np.int32, np.int64):
                if np.iinfo(kind).min <= x.min(initial=0) and x.max(initial=0) <= np.iinfo(kind).max:
                    break
            leaves = leaves_for(n, LEAF)
            orders = [halves(p, leaves).astype(np.uint16) for p in np.split(x, parts, axis=1)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([own.column(0)], pa.list_(own.column(0).type)),
                    pa.array([own.column(1)], pa.list_(own.column(1).type)),
                    pa.array([np.dtype(kind).itemsize], pa.int32()),
                    pa.array([x.astype(kind).tobytes()], pa.binary()),
                    pa.array([np.stack(orders).tobytes()], pa.binary()),
                ],
                ["ids", "labels", "size", "vals", "orders"],
            )


def unpacked(batches, parts: int, width: int):
    """Per block: ids, labels, and per part position (integers, order)."""
    for batch in batches:
        for ids, labels, size, vals, orders in zip(*(batch.column(c) for c in range(5))):
            x = np.frombuffer(vals.as_buffer(), f"i{size.as_py()}").reshape(-1, width).astype(np.int64)
            order = np.frombuffer(orders.as_buffer(), np.uint16).reshape(parts, -1).astype(np.int64)
            yield ids.values, labels.values, list(zip(np.split(x, parts, axis=1), order))


def assigned(part: np.ndarray, order: np.ndarray, book: list[list[int]], codes: bool = False) -> Assignment:
    entries = np.array(book, object).reshape(len(book), part.shape[1])
    x, entries = exact_ints(part[order], entries)
    return Assignment(Tree(x, leaves_for(len(x), LEAF)), entries, codes)


def add_up(batches, books: list, width: int):
    """Blocks -> (part, entry, place, n, total): count and component sums of
    each entry's points in this partition."""
    count = [[0] * len(b) for b in books]
    total = [np.zeros((len(b), width // len(books)), object) for b in books]
    for _, _, cut in unpacked(batches, len(books), width):
        for j, (x, order) in enumerate(cut):
            found = assigned(x, order, books[j])
            for k, n in enumerate(found.n.tolist()):
                count[j][k] += n
            total[j] += found.sums.astype(object)
    rows = [
        {"part": j, "entry": k, "place": i, "n": n, "total": Decimal(int(total[j][k, i]))}
        for j, own in enumerate(count)
        for k, n in enumerate(own)
        for i in range(width // len(books))
        if n
    ]
    kinds = [("part", pa.int32()), ("entry", pa.int32()), ("place", pa.int32()), ("n", pa.int64())]
    yield pa.RecordBatch.from_pylist(rows, pa.schema([*kinds, ("total", pa.decimal128(38, 0))]))


def write_codes(batches, books: list, width: int):
    """Blocks -> (vec_id, label, code, error) of every vector."""
    for ids, labels, cut in unpacked(batches, len(books), width):
        n = len(ids)
        code = np.zeros((n, len(books)), np.uint8)
        error = np.zeros(n, object)
        for j, (x, order) in enumerate(cut):
            own = assigned(x, order, books[j], codes=True).codes
            code[order, j] = own
            entries = np.array(books[j], object).reshape(len(books[j]), x.shape[1])
            a, b = exact_ints(x[order], entries)
            apart = a - b[own]
            error[order] += (apart * apart).sum(1).astype(object)
        text = code.tobytes().hex()
        step = 2 * len(books)
        yield pa.RecordBatch.from_arrays(
            [
                ids,
                labels,
                pa.array([text[i * step : (i + 1) * step] for i in range(n)], pa.string()),
                pa.array([min(int(e), LONG) for e in error], pa.int64()),
            ],
            ["vec_id", "label", "code", "error"],
        )


# ------------------------------------------------------------------ operators


def blocks_of(vectors: DataFrame, parts: int) -> tuple[DataFrame, int]:
    """The quantised rows in saved blocks, and the padded width."""
    longest = vectors.agg(F.max(F.size("v"))).first()[0] or 0
    width = max(1, -(-longest // parts)) * parts
    kinds = {c: vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    packed = vectors.select("vec_id", "label", "v").mapInArrow(
        partial(pack, parts=parts, width=width),
        f"ids array<{kinds['vec_id']}>, labels array<{kinds['label']}>, size int, vals binary, orders binary",
    )
    return saved(packed, "codes-blocks"), width


def learn(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6) -> tuple[DataFrame, list, int]:
    """Codebooks of ``quantised`` rows: (blocks, codebooks[part][entry], width).

    A codebook starts as that part of the ``entries`` (at most 256) smallest
    vec_ids (rows without one come last; ties by the vector); fewer rows give
    fewer entries. Each round assigns every part to its nearest entry and moves
    each used entry to the floor of its parts' mean."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hexadecimal digits a part: 1 to 256 entries")
    blocks, width = blocks_of(vectors, parts)
    start = vectors.orderBy(F.asc_nulls_last("vec_id"), "v").select("v").limit(entries).collect()
    step = width // parts
    first = [list(r.v) + [0] * (width - len(r.v)) for r in start]
    books = [[v[j * step : (j + 1) * step] for v in first] for j in range(parts)]
    for _ in range(rounds if first else 0):
        summed = blocks.mapInArrow(
            partial(add_up, books=books, width=width), "part int, entry int, place int, n long, total decimal(38,0)"
        )
        # One row per codebook component.
        for r in summed.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
            books[r.part][r.entry][r.place] = int(r.total) // r.n
    return blocks, books, width


def encode(blocks: DataFrame, books: list, width: int) -> DataFrame:
    """(vec_id, label, code, error) of every vector in the blocks."""
    kinds = {c: blocks.schema[c].dataType.elementType.simpleString() for c in ("ids", "labels")}
    return blocks.mapInArrow(
        partial(write_codes, books=books, width=width),
        f"vec_id {kinds['ids']}, label {kinds['labels']}, code string, error long",
    )


def books_sha256(books: list) -> str:
    """Digest of all integers by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()


def decode(code: Column, books: list, scale: int = 4096) -> Column:
    """The vector that a code stands for (array<double>; null code: null)."""
    literal = F.array(*(F.array(*(F.array(*(F.lit(c / scale) for c in e)) for e in b)) for b in books))
    digits = F.sequence(F.lit(0), F.lit(len(books) - 1))
    entry = F.transform(digits, lambda j: F.conv(F.substring(code, j * 2 + 1, F.lit(2)), 16, 10).cast("int"))
    return F.flatten(F.transform(entry, lambda e, j: F.get(F.get(literal, j), e)))


def compress(
    vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096
) -> tuple[DataFrame, list]:
    """(vec_id, label, code, error, label_error) of every kept row of
    ``vectors`` (vec_id, embedding, optional label), and the final codebooks.

    ``code`` has two hexadecimal digits a part; ``error`` is the squared
    distance to what the code stands for, in quantised units; ``label_error``
    its sum over the rows of a label, null labels together; both are 2^63 - 1
    where they would be larger.

    Rows without a vector, or with a null or non-finite component, are left
    out. Vectors of different length, or one that ``parts`` does not divide,
    are padded with zeros; an empty vector is all zeros. Components beyond
    2^62 in quantised units count as that. Repeated rows and ids each count;
    ties go to the lower entry. Fewer rows than ``entries`` give smaller
    codebooks; an empty table gives an empty table and empty codebooks. Other
    columns are ignored.
    """
    blocks, books, width = learn(quantised(vectors, scale), parts, entries, rounds)
    coded = saved(encode(blocks, books, width), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(19,0)")), F.lit(Decimal(LONG))).cast("long")
    by_label = saved(coded.groupBy("label").agg(total.alias("label_error")), "codes-labels")
    labelled = coded.alias("c").join(by_label.alias("l"), F.col("c.label").eqNullSafe(F.col("l.label")))
    return labelled.select("c.vec_id", "c.label", "c.code", "c.error", "l.label_error"), books
