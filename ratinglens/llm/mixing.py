"""Source mixing by temperature, in built-in DataFrame functions only.

Source token shares are raised to an exponent and normalised. The exponent is
bisected on [0, 1]: the largest whose weights reach the target entropy, or a
larger one where a source would otherwise be repeated too often. Weights times
the token budget are then realised as budgeted block permutations: a source is
cut into blocks of documents by a seeded hash; it is used in whole epochs, then
in one partial epoch over its blocks in random order, and only in the block
where the budget runs out are single documents counted, short ones first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import quoted, saved, words

#: Tokens aimed at in a block, and the cells that blocks are made of (by so
#: many hexadecimal digits of a hash).
BLOCK_TOKENS = 1 << 16
DIGITS = 5
CELLS = 1 << 4 * DIGITS
STEPS = 30


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _go_up(shares: Column, exponent: Column, budget_share: float, entropy: float, repeats: float) -> Column:
    """Whether the exponent may rise: the entropy of the weights is at least
    ``entropy`` of its maximum, or a source is repeated over ``repeats`` times."""
    sums = F.struct(
        _total(F.transform(shares, lambda p: F.pow(p, exponent))).alias("z"),
        _total(F.transform(shares, lambda p: F.pow(p, exponent) * F.log(p))).alias("e"),
        F.pow(F.array_min(shares), exponent - 1).alias("rarest"),
    )
    return _let(
        sums,
        lambda s: (F.log(s["z"]) - exponent * s["e"] / s["z"] >= entropy * F.log(F.size(shares).cast("double")))
        | (s["rarest"] / s["z"] * budget_share > repeats),
    )


def source_plan(
    tokens: DataFrame, budget_share: float = 0.8, entropy: float = 0.95, repeats: float = 4.0
) -> DataFrame:
    """(source, tokens, exponent, weight, quota) from one row (source, tokens)
    per source.

    The sources of a corpus are few and fit one array; sources without tokens
    have no weight and are left out. ``quota`` is the floor of weight times
    ``budget_share`` of all tokens."""
    one = tokens.where("tokens > 0").agg(
        F.array_sort(F.collect_list(F.struct("source", "tokens"))).alias("s"), F.sum("tokens").alias("total")
    )
    shares = one.where("total is not null").withColumn("p", F.transform("s", lambda x: x["tokens"] / F.col("total")))
    limits = (budget_share, entropy, repeats)

    def halve(acc: Column, _: Column) -> Column:
        def move(mid: Column) -> Column:
            return _let(
                _go_up(F.col("p"), mid, *limits),
                lambda up: F.struct(
                    F.when(up, mid).otherwise(acc["lo"]).alias("lo"), F.when(up, acc["hi"]).otherwise(mid).alias("hi")
                ),
            )

        return _let((acc["lo"] + acc["hi"]) / 2, move)

    bisected = F.aggregate(
        F.sequence(F.lit(1), F.lit(STEPS)),
        F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi")),
        halve,
        lambda acc: acc["lo"],
    )
    found = shares.withColumn(
        "exponent", F.when(_go_up(F.col("p"), F.lit(1.0), *limits), F.lit(1.0)).otherwise(bisected)
    ).withColumn("z", _total(F.transform("p", lambda p: F.pow(p, F.col("exponent")))))
    rows = found.select("exponent", "total", "z", F.explode(F.arrays_zip("s", "p")).alias("x"))
    weight = F.pow(F.col("x.p"), F.col("exponent")) / F.col("z")
    return rows.select(
        F.col("x.s.source").alias("source"),
        F.col("x.s.tokens").alias("tokens"),
        "exponent",
        weight.alias("weight"),
        F.floor(weight * budget_share * F.col("total")).cast("long").alias("quota"),
    )


def _key(seed: int, *parts: Column) -> Column:
    """Place in a seeded random order, as hexadecimal text."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def mix(
    docs: DataFrame,
    budget_share: float = 0.8,
    entropy: float = 0.95,
    repeats: float = 4.0,
    seed: int = 17,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """The rows of ``docs`` as often as their source's quota takes them, plus
    one struct column ``_mix``: source, epoch (from 1), block, order (text;
    the order within an epoch: blocks of all sources at random, documents at
    random within a block).

    Tokens are words. A quota over a source's tokens is used up in whole
    epochs first; the last epoch takes whole blocks in random order while
    they fit, then of the next block its documents by ascending length while
    they fit: one is left out only if it is longer than what all shorter ones
    leave of the quota, which is never passed. Blocks per source grow with its tokens up to ``CELLS``,
    so a hot source is spread over many and no window holds more than its
    block totals or the documents of one block.

    A null source is a source of its own (``none``; others are ``s`` plus the
    name). Null and empty texts cost nothing and come with their block.
    Repeated rows each count. A source without a word is left out; an empty
    table gives an empty table. Other columns pass through (``_mix`` is
    replaced; names starting with ``_mix_`` are reserved).
    """
    doc_key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    n_tokens = F.size(words(F.col("text"))).cast("long")
    celled = docs.drop("_mix").withColumns(
        {
            "_mix_source": F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("none")),
            "_mix_cell": F.conv(F.substring(_key(seed, doc_key), 1, DIGITS), 16, 10).cast("long"),
        }
    )
    source = F.col("_mix_source").alias("source")
    cells = saved(
        celled.groupBy(source, F.col("_mix_cell").alias("cell")).agg(F.sum(n_tokens).alias("tokens")), "mix-cells"
    )
    plan = source_plan(cells.groupBy("source").agg(F.sum("tokens").alias("tokens")), budget_share, entropy, repeats)
    doubled = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("tokens") / float(block_tokens)))).cast("long")
    plan = saved(
        plan.select(
            "source",
            F.least(F.lit(CELLS), F.greatest(F.lit(1), doubled)).alias("blocks"),
            F.floor(F.col("quota") / F.col("tokens")).cast("long").alias("full"),
            (F.col("quota") % F.col("tokens")).alias("rest"),
        ),
        "mix-plan",
    )
    blocks = (
        cells.join(plan, "source")
        .groupBy("source", "blocks", "full", "rest", (F.col("cell") % F.col("blocks")).alias("block"))
        .agg(F.sum("tokens").alias("tokens"))
    )
    at_random = _key(seed, F.col("source"), (F.col("full") + 1).cast("string"), F.col("block").cast("string"))
    in_order = Window.partitionBy("source").orderBy(at_random, "block").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum("tokens").over(in_order)
    decided = blocks.withColumn("left", F.col("rest") - (end - F.col("tokens"))).select(
        F.col("source").alias("_mix_source"),
        "block",
        "full",
        (F.col("left") >= F.col("tokens")).alias("whole"),
        "left",
    )
    decided = saved(
        decided.withColumn("part", (F.col("left") > 0) & ~F.col("whole")).where("full > 0 or whole or part"),
        "mix-blocks",
    )
    decided = decided.select(*(F.col(c).alias(c if c == "_mix_source" else f"_mix_{c}") for c in decided.columns))
    sizes = plan.select(F.col("source").alias("_mix_source"), F.col("blocks").alias("_mix_blocks"))
    placed = (
        celled.join(sizes, "_mix_source")
        .withColumn("_mix_block", F.col("_mix_cell") % F.col("_mix_blocks"))
        .join(decided, ["_mix_source", "_mix_block"])
    )

    def told(epoch: Column) -> Column:
        block_key = _key(seed, F.col("_mix_source"), epoch.cast("string"), F.col("_mix_block").cast("string"))
        return F.struct(
            F.col("_mix_source").alias("source"),
            epoch.alias("epoch"),
            F.col("_mix_block").alias("block"),
            F.concat(block_key, F.lit(":"), _key(seed, epoch.cast("string"), doc_key)).alias("order"),
        ).alias("_mix")

    plain = [quoted(c) for c in docs.columns if c != "_mix"]
    epochs = F.col("_mix_full") + F.col("_mix_whole").cast("long")
    whole = (
        placed.where(epochs > 0)
        .withColumn("_mix_epoch", F.explode(F.sequence(F.lit(1).cast("long"), epochs)))
        .select(*plain, told(F.col("_mix_epoch")))
    )
    last = F.col("_mix_full") + 1
    one_by_one = (
        Window.partitionBy("_mix_source")
        .orderBy(n_tokens, _key(seed, last.cast("string"), doc_key), "doc_id")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    part = (
        placed.where("_mix_part")
        .withColumn("_mix_end", F.sum(n_tokens).over(one_by_one))
        .where("_mix_end <= _mix_left")
        .select(*plain, told(last))
    )
    return whole.unionByName(part)
