"""Resampling towards a target by the words of its texts.

1. A 256-byte table lower-cases A-Z and blanks every separator of a text's
   UTF-8 bytes; ``bytes.split`` yields the words. The crc32 of a run of words
   is chained: the crc32 of a run is the seed for the word that extends it.
2. Counters of the tasks reduce to one count per bucket, for the documents and
   for the target; the log ratio of the two shares is a bucket's gain.
3. A document's weight is the sum of its features' gains. Weight plus Gumbel
   noise, seeded by the id, is its score; the highest scores are the draw
   (sampling without replacement in proportion to the weights).

Ranks come from one range sort of narrow rows: place within a partition plus
the rows of all partitions before it.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import partial
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import saved

#: Digits, lower-case letters and bytes of other characters stay, A-Z is
#: lower-cased, everything else parts words.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Bytes of a text that are split at once, and features that a Counter holds.
BLOCK, HELD = 1 << 20, 1 << 20
#: Bits of a row's place within its partition (see monotonically_increasing_id).
PLACE = 33


def run_hashes(raw: bytes, longest: int, block: int = BLOCK) -> Iterator[tuple[int, list[list[int]]]]:
    """(number of words, per length the crc32 of each run of so many words),
    for one block of the text after another; runs over a block's end come with
    the block in which they end."""
    clean, at, carry = raw.translate(TABLE), 0, []
    while at < len(clean):
        end = clean.find(b" ", at + block)
        end = len(clean) if end < 0 else end
        fresh = clean[at:end].split()
        words, at = carry + fresh, end
        hashes, found = list(map(crc32, words)), []
        spaced = [b" " + w for w in words] if longest > 1 else []
        for n in range(1, longest + 1):
            if n > 1:
                hashes = list(map(crc32, spaced[n - 1 :], hashes))
            found.append(hashes[max(0, len(carry) - n + 1) :])
        yield len(fresh), found
        carry = words[max(0, len(words) - longest + 1) :] if longest > 1 else []


def texts_of(column: pa.Array) -> Iterator[bytes]:
    for x in column.cast(pa.binary()):
        yield x.as_py() or b""


def count_buckets(batches, longest: int, buckets: int):
    """(text) -> (bucket, n): the features of all texts of a partition."""
    total, counts = np.zeros(buckets, np.int64), Counter()

    def flush() -> None:
        keys = np.fromiter(counts.keys(), np.int64, len(counts))
        np.add.at(total, keys % buckets, np.fromiter(counts.values(), np.int64, len(counts)))
        counts.clear()

    for batch in batches:
        for raw in texts_of(batch.column(0)):
            for _, found in run_hashes(raw, longest):
                counts.update(chain.from_iterable(found))
                if len(counts) > HELD:
                    flush()
    flush()
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])


def bucket_counts(docs: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """Features per bucket; ``buckets`` rows at most reach the driver."""
    counted = docs.select("text").mapInArrow(
        partial(count_buckets, longest=longest, buckets=buckets), "bucket long, n long"
    )
    out = np.zeros(buckets, np.int64)
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 * ln of the smoothed target share over the
    smoothed source share)."""
    b = len(source)
    all_s, all_t = int(source.sum()) + b, int(target.sum()) + b
    ratios = (((t + 1) * float(all_s)) / ((s + 1) * float(all_t)) for s, t in zip(source.tolist(), target.tolist()))
    return np.array([math.floor(1000 * math.log(x)) for x in ratios], np.int64)


def weigh(batches, longest: int, gain: np.ndarray):
    """(text, kept columns) -> (kept columns, n_words, n_features, weight)."""
    for batch in batches:
        out = np.zeros((3, batch.num_rows), np.int64)
        for i, raw in enumerate(texts_of(batch.column(0))):
            for n, found in run_hashes(raw, longest):
                out[0, i] += n
                for hashes in found:
                    out[1, i] += len(hashes)
                    out[2, i] += gain[np.array(hashes, np.int64) % len(gain)].sum()
        kept = batch.select(range(1, batch.num_columns))
        yield pa.RecordBatch.from_arrays(
            [*kept.columns, *map(pa.array, out)], [*kept.schema.names, "n_words", "n_features", "weight"]
        )


def noise(doc_id: Column, seed: int) -> Column:
    """floor(1000 * standard Gumbel noise) from the first 32 bits of the
    sha256 of ``<seed>:<doc_id>``; a null id counts as the empty text."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with ``rank`` (from 1) by ``order``; the number of partitions
    bounds what is summed up in one task."""
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = saved(placed.withColumn("place", F.monotonically_increasing_id()), name)
    part = F.shiftright("place", PLACE)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = saved(sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")), f"{name}-starts")
    within = F.col("place").bitwiseAND((1 << PLACE) - 1)
    numbered = placed.withColumn("part", part).join(starts, "part")
    return numbered.withColumn("rank", F.col("start") + within + 1).drop("place", "part", "start")


def importance(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = 20,
    longest: int = 1,
    buckets: int = 10_000,
    seed: int = 2024,
    row: str = "_row",
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_features,
    weight, score, rank and ``row``, a number of the row (its column of that
    name, if it has one). ``target`` has a text column.

    Features are all runs of 1 to ``longest`` words, repeats counted. Of the N
    documents with at least ``least_words`` words the floor(N * percent / 100)
    highest scores have a rank, from 1; ties go to the smaller doc_id, then
    rows without one, then to fewer features; equal rows in any order. All
    others have a null rank.

    Null and empty texts have no feature and weight 0; a null doc_id is seeded
    as the empty text; repeated rows are ranked each; a very long text is
    split block by block. Without a target text every gain is that of an empty
    target; an empty table gives an empty table; other columns are ignored.
    """
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    kept = ["doc_id", row] if row in docs.columns else ["doc_id"]
    types = [f"{c} {docs.schema[c].dataType.simpleString()}" for c in kept]
    weighed = docs.select("text", *kept).mapInArrow(
        partial(weigh, longest=longest, gain=gain), ", ".join([*types, "n_words long, n_features long, weight long"])
    )
    if row not in kept:  # deals equal rows over the ranges of the sort
        weighed = weighed.withColumn(row, F.monotonically_increasing_id())
    scored = saved(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "importance-scores")
    drawn = scored.where(F.col("n_words") >= least_words).count() * percent // 100
    order = [F.col("n_words") < least_words, F.desc("score"), F.asc_nulls_last("doc_id"), F.col("n_features"), F.col(row)]
    found = ranked(scored, order, "importance-ranks")
    rank = F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")
    return found.select("doc_id", "n_words", "n_features", "weight", "score", rank, row)


def resample(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The drawn rows of ``docs``, whole, with one more column ``_rank``;
    settings and special cases as for ``importance``. Columns of any name pass
    through (``_rank`` is replaced; ``_draw_row`` is reserved)."""
    numbered = saved(docs.drop("_rank").withColumn("_draw_row", F.monotonically_increasing_id()), "importance-rows")
    found = importance(numbered, target, row="_draw_row", **settings).where("rank is not null")
    return numbered.join(found.select("_draw_row", F.col("rank").alias("_rank")), "_draw_row").drop("_draw_row")
