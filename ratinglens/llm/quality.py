"""Line-first quality cleaning, in built-in column functions only.

Every line is judged by punctuation, navigation and boilerplate rules; failing
lines are removed; a document that loses too much of its text is rejected.
Everything is computed inside one row, so there is no shuffle at all and a hot
source or a group of copies costs nothing extra.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, words

# Marks that end a sentence (closing quotes and brackets may follow).
SENTENCE_END = r"[.!?…。！？:;]"
CLOSERS = r"[\"'”’»)\]*_]*"
# Phrases of page furniture, matched without case.
BOILERPLATE = (
    "all rights reserved",
    "accept cookies",
    "we use cookies",
    "cookie policy",
    "privacy policy",
    "terms of use",
    "terms of service",
    "terms and conditions",
    "enable javascript",
    "click here",
    "read more",
    "sign in",
    "log in",
    "subscribe to our",
    "skip to content",
    "lorem ipsum",
)

# The line rules as patterns that Java and RE2 read alike.
_SP = r"[\x20\x09-\x0D]"
HAS_WORD = r"[^\x20\x09-\x0D]"
ENDS_SENTENCE = rf"{SENTENCE_END}{CLOSERS}{_SP}*\z"
INNER_SENTENCE = rf"[.!?…]{CLOSERS}{_SP}+{HAS_WORD}"
SHOUTING = r"(?:[!?]{2}[^!?]*){3}"
SYMBOL_RUNS = r"(?:[#*$%&<>]{3}[^#*$%&<>]*){2}"
NAVIGATION = rf"(?:{HAS_WORD}{_SP}+[|»›>•·](?:{_SP}|\z)[^\n]*){{2}}|\A{_SP}*[|»›•]|{_SP}[|»›]{_SP}*\z"
SEPARATOR = r"[|»›>•·]"  # a cheap necessary sign of navigation
FURNITURE = r"(?i)(?:\A|[^a-z])(?:" + "|".join(BOILERPLATE) + ")"

#: A document keeps at least this share of its characters, or it is rejected.
MIN_KEPT = 0.5
#: Lines without a sentence end pass if they hold one inside and are this long.
LONG_LINE = 120


def _line_passes(line: Column) -> Column:
    """Verdict of the line rules (a line without a word passes: it carries no
    text). Punctuation: ends like a sentence, or is long and has a sentence
    end inside; no shouting, no runs of symbols. Navigation: no menu or
    breadcrumb separators. Boilerplate: no page-furniture phrase in a short
    line."""
    punctuated = line.rlike(ENDS_SENTENCE) | (
        (F.length(line) >= LONG_LINE) & line.rlike(INNER_SENTENCE)
    )
    broken = line.rlike(SHOUTING) | line.rlike(SYMBOL_RUNS)
    furniture = (F.length(line) < 2 * LONG_LINE) & line.rlike(FURNITURE)
    blank = ~line.rlike(HAS_WORD)
    menu = line.rlike(SEPARATOR) & line.rlike(NAVIGATION)
    return blank | (punctuated & ~broken & ~menu & ~furniture)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _repeated_words(ws: Column, width: int) -> Column:
    """Number of words inside ``width``-word windows that occur twice or more
    in the same word array (first occurrence included)."""
    hashes = F.when(
        F.size(ws) > width,
        F.transform(
            F.sequence(F.lit(1), F.size(ws) - (width - 1)),
            lambda i: F.xxhash64(F.slice(ws, i, width)),
        ),
    )
    # Windows in hash order: equal ones are neighbours. Built only for texts
    # that have a repeated window at all.
    def covered(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))

        def starts(s: Column) -> Column:
            hits = F.filter(
                s,
                lambda e, i: ((i > 0) & (F.try_element_at(s, F.greatest(i, F.lit(1)))["h"] == e["h"]))
                | F.coalesce(F.try_element_at(s, i + 2)["h"] == e["h"], F.lit(False)),
            )
            return F.array_sort(F.transform(hits, lambda e: e["p"]))

        def total(p: Column) -> Column:
            return F.aggregate(
                p,
                F.struct(F.lit(-width).alias("last"), F.lit(0).alias("n")),
                lambda acc, x: F.struct(
                    x.alias("last"), (acc["n"] + F.least(F.lit(width), x - acc["last"])).alias("n")
                ),
                lambda acc: acc["n"],
            )

        return _let(_let(ordered, starts), total)

    return _let(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0)),
    )


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once (a one-element transform)."""
    return F.transform(F.array(value), body)[0]


def base_statistics(text: Column, width: int = 8) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    t = F.coalesce(text, F.lit(""))
    with_word = F.filter(_lines(text), lambda x: x.rlike(HAS_WORD))
    return F.struct(
        _let(
            words(text),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.coalesce(_repeated_words(w, width), F.lit(0)).cast("long").alias("n_repeat_words"),
            ),
        ).alias("w"),
        F.length(F.regexp_replace(t, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.regexp_replace(t, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        _let(with_word, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    )


def clean_lines(
    docs: DataFrame,
    min_kept: float = MIN_KEPT,
    min_words: int = 20,
    max_repeat_pct: int = 30,
) -> DataFrame:
    """Every row of ``docs`` plus one struct column ``_quality``.

    ``_quality`` holds the base statistics (whole text), ``base_failed``,
    ``lines`` / ``lines_failed`` (lines with a word), ``kept_share`` (share of
    the characters of the lines that pass), ``clean_text`` (the passing lines,
    in order) and ``kept``. Rejected: fewer than ``min_words`` words, more
    than ``max_repeat_pct`` % of the words in repeated windows, or a
    ``kept_share`` below ``min_kept``.

    Null or empty text: no words, ``base_failed``, clean text empty. Repeated
    rows and ties are judged alike, each on its own; an empty table gives an
    empty table; other columns of any name pass through (a column already
    called ``_quality`` is replaced).
    """
    text = F.col("text")
    judged = F.transform(
        _lines(text),
        lambda x: F.struct(x.alias("line"), _line_passes(x).alias("ok"), F.length(x).alias("n")),
    )
    cleaned = _let(
        judged,
        lambda ls: F.struct(
            F.aggregate(ls, F.lit(0), lambda a, x: a + x["n"]).alias("all_chars"),
            F.aggregate(ls, F.lit(0), lambda a, x: a + F.when(x["ok"], x["n"]).otherwise(0)).alias("ok_chars"),
            F.size(F.filter(ls, lambda x: ~x["ok"])).cast("long").alias("lines_failed"),
            F.size(ls).cast("long").alias("lines"),
            F.array_join(F.transform(F.filter(ls, lambda x: x["ok"]), lambda x: x["line"]), "\n").alias("clean_text"),
        ),
    )
    # A generator of one row: what it yields is computed once, whatever
    # later columns and filters use of it.
    measured = F.explode(F.array(F.struct(base_statistics(text).alias("b"), cleaned.alias("c"))))
    with_stats = docs.drop("_quality").select("*", measured.alias("_quality"))
    b, c = F.col("_quality.b"), F.col("_quality.c")
    n_words, n_rep = b["w"]["n_words"], b["w"]["n_repeat_words"]
    share = F.when(c["all_chars"] > 0, c["ok_chars"] / c["all_chars"]).otherwise(F.lit(0.0))
    failed = (n_words < min_words) | (100 * n_rep > max_repeat_pct * n_words)
    return with_stats.withColumn(
        "_quality",
        F.struct(
            n_words.alias("n_words"),
            b["word_chars"].alias("word_chars"),
            b["n_symbols"].alias("n_symbols"),
            b["n_dup_lines"].alias("n_dup_lines"),
            n_rep.alias("n_repeat_words"),
            failed.alias("base_failed"),
            c["lines"].alias("lines"),
            c["lines_failed"].alias("lines_failed"),
            share.alias("kept_share"),
            c["clean_text"].alias("clean_text"),
            (~failed & (share >= min_kept)).alias("kept"),
        ),
    )
