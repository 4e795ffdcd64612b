"""Substring de-duplication with repeated-phrase automata.

A window is ``width`` consecutive words; a word goes if a window over it also
starts anywhere else. The work is narrowed in exact steps:

1. *Anchors.* Of the ``gram``-word phrases of a window the one with the
   smallest hash is its anchor, so equal windows have equal anchors. Anchors
   that occur once in the corpus (partial counts) prove their windows unique.
2. *Confirmation.* Neighbouring windows with one anchor form a context. Equal
   contexts are counted as one row, then the windows of the distinct contexts
   are counted; a window seen twice is a confirmed recurring phrase.
3. *Automata.* Documents with candidates are dealt into shards of bounded
   text. For each shard, every confirmed context present gets one
   representative; each run of its confirmed windows is a phrase of an
   Aho-Corasick automaton over word numbers, and all documents of the shard
   are streamed through it, from wherever a phrase's first words stand, to
   locate every occurrence.

No step gathers a phrase's occurrences: hot phrases and groups of copies are
combined by partial aggregation, and copies are dealt over shards by row.
"""

from __future__ import annotations

from functools import partial
from itertools import repeat

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from .common import quoted, saved

#: Characters of candidate text in a shard (bounds automaton and buffers).
SHARD_CHARS = 2_000_000
#: First words of a phrase by which the places where one may start are found.
OPENING = 4
BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1
INVERSE = pow(BASE, -1, 1 << 64)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word; hashing anew is faster than remembering."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(7)), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Powers:
    """Powers of the base and of its inverse, modulo 2^64."""

    def __init__(self) -> None:
        self.grow(1 << 12)

    def grow(self, n: int) -> None:
        def table(b: int) -> np.ndarray:
            out = np.full(n, b, np.uint64)
            out[0] = 1
            return np.multiply.accumulate(out)

        self.n, self.up, self.down = n, table(BASE), table(INVERSE)

    def sequence_hashes(self, h: np.ndarray, k: int) -> np.ndarray:
        """Hash of each run of ``k`` word hashes (equal runs: equal hashes)."""
        n = len(h)
        if n < k:
            return np.empty(0, np.uint64)
        if n > self.n:
            self.grow(2 * n)
        total = np.empty(n + 1, np.uint64)
        total[0] = 0
        np.cumsum(h * self.down[:n], out=total[1:])
        return mixed((total[k:] - total[:-k]) * self.up[: n - k + 1])


def anchors(grams: np.ndarray, span: int) -> np.ndarray:
    """Position of the smallest of each ``span`` neighbouring hashes, judged
    by the upper 32 bits (ties: the first)."""
    low = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    n = len(low) - span + 1
    width = 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    return (np.minimum(low[:n], low[span - width :][:n]) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def text_key(text: Column) -> Column:
    """128 bits that name a text."""
    t = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(t).alias("k1"), F.xxhash64(F.lit("passage"), t).alias("k2"))


def emit_anchors(batches, width: int, gram: int):
    """(k1, text) -> (a, n, k1): each anchor of a text, how often."""
    powers = Powers()
    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        found, counts, rows = [], [], []
        for row, text in enumerate(batch.column(1)):
            w = (text.as_py() or "").encode().split()
            if len(w) < width:
                continue
            h = word_hashes(w)
            g = powers.sequence_hashes(h, gram)
            at = anchors(g, width - gram + 1)
            a, n = np.unique(g[at[np.r_[True, at[1:] != at[:-1]]]], return_counts=True)
            found.append(a)
            counts.append(n)
            rows.append(np.full(len(a), row))
        if found:
            at = np.concatenate(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(found).view(np.int64)),
                    pa.array(np.concatenate(counts).astype(np.int32)),
                    pa.array(keys[at]),
                ],
                ["a", "n", "k1"],
            )


def emit_contexts(batches, width: int, gram: int):
    """(shard, k1, k2, text, anchors) -> (shard, k1, k2, lo, ws): for each
    recurring anchor occurrence its first window and its windows' hashes."""
    powers = Powers()
    for batch in batches:
        shards, keys1, keys2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2))
        rows, los, sizes, hashes = [], [], [], []
        for row, (text, known) in enumerate(zip(batch.column(3), batch.column(4))):
            w = text.as_py().encode().split()
            h = word_hashes(w)
            g = powers.sequence_hashes(h, gram)
            at = anchors(g, width - gram + 1)
            recurring = known.values.to_numpy().view(np.uint64)
            live = np.isin(g[at], recurring)
            first = np.flatnonzero(live & np.r_[True, at[1:] != at[:-1]])
            last = np.flatnonzero(live & np.r_[at[1:] != at[:-1], True])
            if not len(first):
                continue
            windows = powers.sequence_hashes(h, width).view(np.int64)
            rows.append(np.full(len(first), row))
            los.append(first)
            sizes.append(last - first + 1)
            hashes.append(windows[live])
        if rows:
            at = np.concatenate(rows)
            offsets = np.r_[0, np.cumsum(np.concatenate(sizes))].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shards[at]),
                    pa.array(keys1[at]),
                    pa.array(keys2[at]),
                    pa.array(np.concatenate(los).astype(np.int32)),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(hashes))),
                ],
                ["shard", "k1", "k2", "lo", "ws"],
            )


def phrase_runs(lo: int, size: int, offsets) -> list[tuple[int, int]]:
    """(start of the first, start of the last window) of each run of confirmed
    windows of a context (no offsets: all ``size`` of them)."""
    if offsets is None:
        return [(lo, lo + size - 1)]
    o = np.sort(offsets)
    gap = np.diff(o) > 1
    return [(lo + int(x), lo + int(y)) for x, y in zip(o[np.r_[True, gap]], o[np.r_[gap, True]])]


def openings(numbers: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each word on, where there are so many."""
    out = numbers[: max(0, len(numbers) - k + 1)]
    for i in range(1, k):
        out = out * np.uint64(BASE) + numbers[i : i + len(out)]
    return out


def places(hashes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where ``hashes`` has one of ``wanted``, which is sorted."""
    if not len(wanted):
        return np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
    return np.flatnonzero(wanted[at] == hashes)


def stretches(starts: np.ndarray, length: int, n: int):
    """(from, to) of the parts of ``n`` words that are within ``length`` words
    of a start, overlapping ones joined."""
    if not len(starts):
        return
    new = np.diff(starts) >= length
    for a, b in zip(starts[np.r_[True, new]].tolist(), starts[np.r_[new, True]].tolist()):
        yield a, min(n, b + length)


class Numbers(dict):
    """Word -> number, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def locate(docs: pd.DataFrame, phrases: pd.DataFrame, width: int, removed_col: str) -> pd.DataFrame:
    """One shard: compile the representatives' phrases, stream all documents
    through the automaton, and cut out what is covered."""
    number = Numbers().__getitem__
    texts = dict(zip(zip(docs["_k1"], docs["_k2"]), docs["text"]))
    ids = {key: tuple(map(number, text.encode().split())) for key, text in texts.items()}
    opened = {key: openings(np.array(own, np.uint64), min(width, OPENING)) for key, own in ids.items()}
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
    first, longest = set(), 0
    for k1, k2, lo, size, offsets in zip(*(phrases[c].tolist() for c in ("k1", "k2", "lo", "m", "offs"))):
        own = ids[k1, k2]
        for start, last in phrase_runs(lo, size, offsets):
            automaton.add_word(own[start : last + width])
            first.add(opened[k1, k2][start])
            longest = max(longest, last + width - start)
    automaton.make_automaton()
    first = np.sort(np.array(list(first), np.uint64))
    done: dict = {}
    for key, text in texts.items():
        own = ids[key]
        edge = np.zeros(len(own) + 1, np.int64)
        # A phrase can only start where its first words stand.
        for a, b in stretches(places(opened[key], first), longest, len(own)):
            found = np.array([x for end, n in automaton.iter(own[a:b]) for x in (a + end + 1, n)], np.int64)
            after, length = found[::2], found[1::2]
            np.add.at(edge, after - length, 1)
            np.add.at(edge, after, -1)
        covered = np.cumsum(edge[:-1]) > 0
        done[key] = (cut(text, covered), int(covered.sum()))
    outcome = [done[k] for k in zip(docs["_k1"], docs["_k2"])]
    docs = docs.drop(columns=["_k1", "_k2", "_shard"])
    docs["text"] = [t for t, _ in outcome]
    docs[removed_col] = [n for _, n in outcome]
    return docs


def cut(text: str, covered: np.ndarray) -> str:
    """``text`` without the covered words and the white space after them."""
    if not covered.any():
        return text
    raw = text.encode()
    code = np.frombuffer(raw, np.uint8)
    space = (code == 32) | ((code >= 9) & (code <= 13))
    start = np.flatnonzero(~space & np.r_[True, space[:-1]])
    parts, at = [], 0
    change = np.flatnonzero(np.diff(np.r_[False, covered, False]))
    for first, after in zip(change[::2], change[1::2]):
        parts.append(raw[at : start[first]])
        at = start[after] if after < len(start) else len(raw)
    parts.append(raw[at:])
    return b"".join(parts).decode()


def remove_repeats(docs: DataFrame, width: int = 35, gram: int = 10) -> DataFrame:
    """Every row of ``docs`` with the words of repeated windows cut from
    ``text``, and ``_removed`` (long): how many were cut.

    Windows are judged on the input. Kept words stay separated by the white
    space that was there. Null text stays null and empty text empty, with 0
    removed; a text repeated in several rows is a repeat of itself, so each
    copy of ``width`` words or more loses all of them; texts shorter than
    ``width`` words lose none; an empty table gives an empty table; other
    columns of any name pass through (``_removed`` is replaced; names that
    start with ``_k1``, ``_k2``, ``_shard`` or ``_anchors`` are reserved).
    """
    docs = docs.drop("_removed")
    own = [quoted(c) for c in docs.columns]
    keyed = docs.select("*", text_key(F.col("text")).alias("_k")).select(
        *own, F.col("_k.k1").alias("_k1"), F.col("_k.k2").alias("_k2")
    )
    found = saved(
        keyed.select("_k1", "text").mapInArrow(
            partial(emit_anchors, width=width, gram=gram), "a long, n int, k1 long"
        ),
        "passage-anchors",
    )
    recurring = found.groupBy("a").agg(F.sum("n").alias("n")).where("n >= 2").select("a")
    # Half of the key will do here: two texts that share it get each other's
    # anchors as well, which only nominate.
    by_text = (
        found.select("a", F.col("k1").alias("_k1"))
        .join(recurring, "a")
        .groupBy("_k1")
        .agg(F.collect_set("a").alias("_anchors"))
    )
    # Rows are dealt over shards by a number saved with them: equal rows, too.
    numbered = keyed.join(by_text, "_k1", "left").select(*map(quoted, keyed.columns), "_anchors")
    split = saved(numbered.withColumn("_shard_row", F.monotonically_increasing_id()), "passage-split")
    clean = split.where("_anchors is null").select(*own, F.lit(0).cast("long").alias("_removed"))

    pending = split.where("_anchors is not null")
    chars = pending.agg(F.sum(F.length("text"))).first()[0] or 0
    n_shards = max(1, -(-chars // SHARD_CHARS))
    shard = F.pmod(F.xxhash64("_shard_row"), F.lit(n_shards)).cast("int")
    pending = pending.withColumn("_shard", shard).drop("_shard_row")
    contexts = saved(
        pending.select("_shard", "_k1", "_k2", "text", "_anchors").mapInArrow(
            partial(emit_contexts, width=width, gram=gram),
            "shard int, k1 long, k2 long, lo int, ws array<long>",
        ),
        "passage-contexts",
    )
    # The first and last window and the count name a context.
    name = [
        F.element_at("ws", 1).alias("w1"),
        F.element_at("ws", -1).alias("w2"),
        F.size("ws").alias("m"),
    ]
    distinct = contexts.groupBy(*name).agg(F.count("*").alias("n"), F.first("ws").alias("ws"))
    distinct = saved(distinct, "passage-distinct")
    windows = distinct.select("w1", "w2", "m", "n", F.posexplode("ws").alias("off", "w"))
    confirmed = windows.groupBy("w").agg(F.sum(F.least("n", F.lit(2))).alias("c")).where("c >= 2").select("w")
    parts = (
        windows.where("n = 1")
        .join(confirmed, "w", "left_semi")
        .groupBy("w1", "w2", "m")
        .agg(F.collect_list("off").alias("offs"))
    )
    whole = distinct.where("n >= 2").select("w1", "w2", "m", F.lit(None).cast("array<int>").alias("offs"))
    phrases = whole.unionByName(parts)
    place = F.min(F.struct("k1", "k2", "lo")).alias("at")
    chosen = (
        contexts.groupBy("shard", *name)
        .agg(place)
        .join(phrases, ["w1", "w2", "m"])
        .select(F.col("shard").alias("_shard"), "at.k1", "at.k2", "at.lo", "m", "offs")
    )
    pending = pending.drop("_anchors")
    # Plain names while rows are grouped: not all can be resolved there.
    plain = [c if c == "text" else f"_shard_{i}" for i, c in enumerate(docs.columns)]
    pending = pending.toDF(*plain, *pending.columns[len(plain) :])
    fields = [StructField(n, f.dataType) for n, f in zip(plain, docs.schema.fields)]
    schema = StructType([*fields, StructField("_removed", IntegerType())])
    located = (
        pending.groupBy("_shard")
        .cogroup(chosen.groupBy("_shard"))
        .applyInPandas(partial(_locate_shard, width=width), schema)
        .withColumn("_removed", F.col("_removed").cast("long"))
        .toDF(*docs.columns, "_removed")
    )
    return clean.unionByName(located)


def _locate_shard(docs: pd.DataFrame, phrases: pd.DataFrame, width: int) -> pd.DataFrame:
    return locate(docs, phrases, width, "_removed")
