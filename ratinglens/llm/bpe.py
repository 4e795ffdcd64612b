"""BPE encoding and decoding with a pair occurrence index.

Texts are cut into chunks at white space; chunks not seen before in the
partition are pre-tokenised together, and their words are merged together: an
index maps each adjacent pair of symbols to all its positions in the
partition, and the active ranks are applied in ascending order, each to all
its positions, updating the lists of the pairs beside them.

Decoding is an operator of its own, over a column of ids.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import sys
import types
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .binfiles import distinct_chunks

# The Unicode white space that pre-tokenisation drops.
SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# The pre-tokeniser's pattern, with that white space.
PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACES}\p{{L}}\p{{N}}]+"


def byte_symbols() -> dict[int, str]:
    """Printable stand-in for each byte: itself where it is printable Latin-1,
    else the next unused code point from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def parse(model: str) -> dict:
    """Tables of a word-end BPE tokenizer file; other kinds are refused."""
    spec = json.loads(model)
    bpe = spec["model"]
    kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
    if kinds != ["NFC", "Replace", "Lowercase"] or not bpe["end_of_word_suffix"] or bpe["unk_token"]:
        raise ValueError("not a lower-casing word-end BPE without unknown token")
    vocab, end = bpe["vocab"], bpe["end_of_word_suffix"]
    merges = {}
    for rank, (a, b) in enumerate(bpe["merges"]):
        joined = vocab[a + b]
        merges.setdefault((vocab[a], vocab[b]), (rank, joined))
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    symbols = byte_symbols()
    return {
        "special": special,
        "inner": [vocab[symbols[b]] for b in range(256)],
        "final": [vocab[symbols[b] + end] for b in range(256)],
        "merges": merges,
        "ranks": PairRanks(merges),
        "token": {i: t for t, i in (vocab | special).items()},
        "number": {i: str(i) for i in (vocab | special).values()},
    }


class PairRanks:
    """Rank and joined symbol of pairs of symbols, looked up for whole arrays."""

    def __init__(self, merges: dict) -> None:
        keys = np.array([a << 32 | b for a, b in merges], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks = np.array([r for r, _ in merges.values()], np.int64)[order]
        self.pair = {r: (*p, joined) for p, (r, joined) in merges.items()}

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; -1: none."""
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], -1)


class PairIndex:
    """All positions of each adjacent pair in the words of a partition, held
    by rank, with the ranks that have positions in a heap."""

    def __init__(self, words: list[bytes], tables: dict) -> None:
        self.ranks: PairRanks = tables["ranks"]
        flat = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words])
        self.ids = np.array(tables["inner"], np.int64)[flat]
        self.ids[ends - 1] = np.array(tables["final"], np.int64)[flat[ends - 1]]
        n = len(flat)
        self.after = np.arange(1, n + 1)
        self.after[ends - 1] = -1
        self.before = np.arange(-1, n - 1)
        self.before[np.r_[0, ends[:-1]]] = -1
        self.ends = ends
        self.places: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        self.add(np.flatnonzero(self.after >= 0))

    def add(self, at: np.ndarray) -> np.ndarray:
        """Enter the pairs that start at these positions; their ranks."""
        ranks = self.ranks.of(self.ids[at], self.ids[self.after[at]])
        known = ranks >= 0
        at, kept = at[known], ranks[known]
        order = np.argsort(kept, kind="stable")
        at, kept = at[order], kept[order]
        cuts = np.flatnonzero(np.r_[True, kept[1:] != kept[:-1]]) if len(kept) else []
        for r, places in zip(kept[cuts].tolist() if len(kept) else [], np.split(at, cuts[1:]) if len(kept) else []):
            if r in self.places:
                self.places[r].append(places)
            else:
                self.places[r] = [places]
                heapq.heappush(self.active, r)
        return ranks

    def merge(self) -> np.ndarray:
        """Apply the active ranks in ascending order, each to all its
        positions; the positions at which a merge made a pair of lower rank,
        whose words depend on the order within the word."""
        odd: list[np.ndarray] = []
        ids, after, before = self.ids, self.after, self.before
        while self.active:
            rank = heapq.heappop(self.active)
            lists = self.places.pop(rank)
            at = np.unique(np.concatenate(lists))
            left, right, joined = self.ranks.pair[rank]
            then = after[at]
            at = at[(ids[at] == left) & (then >= 0) & (ids[then] == right)]
            if left == right and len(at):
                at = alternate(at, after)
            if not len(at):
                continue
            gone = after[at]
            then = after[gone]
            ids[at], ids[gone] = joined, -1
            after[at] = then
            has = then >= 0
            before[then[has]] = at[has]
            prev = before[at]
            fresh = np.concatenate([at[has], prev[prev >= 0]])
            made = self.add(fresh)
            lower = (made >= 0) & (made < rank)
            if lower.any():
                odd.append(fresh[lower])
        return np.concatenate(odd) if odd else np.empty(0, np.int64)


def alternate(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of positions of a pair of equal symbols those that merge from the left:
    every other one of a run of overlapping positions."""
    linked = np.r_[False, after[at[:-1]] == at[1:]]
    start = np.maximum.accumulate(np.where(linked, 0, np.arange(len(at))))
    return at[(np.arange(len(at)) - start) % 2 == 0]


def merge_all(words: list[bytes], tables: dict) -> list[list[int]]:
    """Token ids of each word, merged over all words at once."""
    if not words:
        return []
    index = PairIndex(words, tables)
    odd = index.merge()
    left = index.ids >= 0
    flat = index.ids[left].tolist()
    ends = np.cumsum(left)[index.ends - 1].tolist()
    out = [flat[a:b] for a, b in zip([0, *ends], ends)]
    for w in np.unique(np.searchsorted(index.ends, odd, side="right")).tolist():
        out[w] = merge_one(words[w], tables)
    return out


def merge_one(word: bytes, tables: dict) -> list[int]:
    """Token ids of one word: the leftmost pair of lowest rank, again and
    again. Pairs wait in a heap; one that a merge has changed is passed over."""
    merges = tables["merges"]
    ids = [tables["inner"][b] for b in word[:-1]] + [tables["final"][word[-1]]]
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    waiting = [(merges[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in merges]
    heapq.heapify(waiting)
    while waiting:
        rank, i = heapq.heappop(waiting)
        j = after[i]
        if j >= n or ids[i] < 0:
            continue
        found = merges.get((ids[i], ids[j]))
        if found is None or found[0] != rank:
            continue
        ids[i], ids[j] = found[1], -1
        after[i] = then = after[j]
        if then < n:
            before[then] = i
        for k in (before[i], i):
            if k >= 0 and after[k] < n and (p := (ids[k], ids[after[k]])) in merges:
                heapq.heappush(waiting, (merges[p][0], k))
    return [i for i in ids if i >= 0]


class Encoder:
    """Encodes texts by their chunks (runs without white space), whose packed
    ids it remembers up to a bound, those in use longer than others."""

    #: Integers of packed ids.
    KIND = np.dtype("<u4")
    # The pre-tokeniser's pattern, for lower-case ASCII.
    ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")

    def __init__(self, tables: dict, bound: int = 250_000) -> None:
        self.tables, self.bound = tables, bound
        # Chunk -> ids: met since the table was full, and before; word -> ids.
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.pieces = regex.compile(PIECES)
        special = "|".join(regex.escape(s) for s in tables["special"])
        self.special = regex.compile(f"({special})")

    def plain_words(self, text: str) -> list[str]:
        """Pre-tokens of a chunk, or of the text between special tokens."""
        if text.isascii():
            text = text.lower()
            return [text] if text.isalpha() else self.ASCII.findall(text)
        # Lower-casing goes character by character: no final sigma.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return [text] if text.isalpha() else self.pieces.findall(text)

    def learn(self, chunks: list[bytes]) -> dict[bytes, bytes]:
        """Packed ids of chunks that are not known."""
        special, known = self.tables["special"], self.words
        # A chunk as its words; special tokens stand as their packed ids.
        cut: list[tuple[bytes, list[str | bytes]]] = []
        fresh: dict[str, None] = {}
        for c in chunks:
            if b"<|" in c:
                words: list[str | bytes] = []
                for part in self.special.split(c.decode()):
                    if part in special:
                        words.append(np.array([special[part]], self.KIND).tobytes())
                    else:
                        words += self.plain_words(part)
            else:
                words = self.plain_words(c.decode())
            cut.append((c, words))
            for w in words:
                if w not in known and w.__class__ is str:
                    fresh[w] = None
        merged = merge_all([w.encode() for w in fresh], self.tables)
        known.update(zip(fresh, [np.array(ids, self.KIND).tobytes() for ids in merged]))
        return {
            c: known[ws[0]]
            if len(ws) == 1 and ws[0].__class__ is str
            else b"".join([known[w] if w.__class__ is str else w for w in ws])
            for c, ws in cut
        }

    def ids_of(self, chunks: list[bytes]) -> list[bytes]:
        """Packed ids of distinct chunks."""
        if len(self.known) > self.bound:
            self.known, self.older = {}, self.known
        if len(self.words) > self.bound:
            self.words = {}
        ids = list(map(self.known.get, chunks))
        new = [c for c, x in zip(chunks, ids) if x is None]
        if new:
            found = {c: self.older[c] for c in new if c in self.older}
            found |= self.learn([c for c in new if c not in found])
            self.known |= found
            ids = [found[c] if x is None else x for c, x in zip(chunks, ids)]
        return ids

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's
        begin (and the last one's end)."""
        ends_of_text = np.cumsum([len(t) + 1 for t in texts])
        starts, number, distinct = distinct_chunks(b" ".join(texts) + b" ")
        ids = self.ids_of(distinct)
        flat = np.frombuffer(b"".join(ids), self.KIND)
        n = np.array([len(x) for x in ids], np.int64) // self.KIND.itemsize
        first = np.cumsum(n) - n
        sizes = n[number]
        before = np.r_[0, np.cumsum(sizes)]
        places = np.repeat(first[number] - before[:-1], sizes) + np.arange(before[-1])
        return flat[places], before[np.r_[0, np.searchsorted(starts, ends_of_text)]]


def joined(ids: np.ndarray, cuts: np.ndarray, names: pa.Array) -> pa.Array:
    """For each stretch of ``ids`` between two ``cuts`` the names of its ids,
    joined by one space."""
    lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), names.take(pa.array(ids)))
    return pc.binary_join(lists, " ")


def names_of(numbers: dict[int, str]) -> pa.Array:
    """Array of the names by number, null where there is none."""
    return pa.array([numbers.get(i) for i in range(max(numbers) + 1)], pa.string())


def held(kind, model: str):
    """``kind(model)`` of this Python worker, which outlasts a task: what a
    task unpickles, globals included, is its own."""
    kept = sys.modules.setdefault("_bpe_held", types.ModuleType("_bpe_held")).__dict__
    key = f"{kind.__name__} {hashlib.sha256(model.encode()).hexdigest()}"
    if key not in kept:
        kept[key] = kind(model)
    return kept[key]


def encoder_of(model: str) -> tuple[Encoder, pa.Array]:
    """Encoder, and the decimals of the ids."""
    tables = parse(model)
    return Encoder(tables), names_of(tables["number"])


def tokens_of(model: str) -> pa.Array:
    return names_of(parse(model)["token"])


def stretches(sizes: list[int], most: int):
    """(from, to) of runs of rows with about ``most`` bytes together."""
    at, size = 0, 0
    for i, s in enumerate(sizes):
        size += s
        if size >= most:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(sizes):
        yield at, len(sizes)


def encode_batches(batches, model: str, group_bytes: int = 4 << 20):
    """Appends n_tokens and ids (decimal, spaced) to each batch whose last
    column is the text."""
    encoder, numbers = held(encoder_of, model)
    for batch in batches:
        column = batch.column(batch.num_columns - 1).cast(pa.binary())
        sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
        for a, b in stretches(sizes, group_bytes):
            ids, cuts = encoder.encode([t or b"" for t in column.slice(a, b - a).to_pylist()])
            part = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(np.diff(cuts), pa.int64()), joined(ids, cuts, numbers)],
                [*part.schema.names[:-1], "n_tokens", "ids"],
            )


def decoded(column: pa.Array, names: pa.Array) -> pa.Array:
    """The texts of ids that are given as spaced decimals."""
    lists = pc.split_pattern(pc.fill_null(column, ""), " ")
    cuts = lists.offsets.to_numpy().astype(np.int64)
    told = lists.values.slice(cuts[0], cuts[-1] - cuts[0])
    cuts = cuts - cuts[0]

    def kept(keep: pa.Array) -> np.ndarray:
        return np.r_[0, np.cumsum(keep.to_numpy(zero_copy_only=False))][cuts]

    some = pc.not_equal(told, "")
    cuts, ids = kept(some), told.filter(some).cast(pa.int64())
    in_table = pc.is_valid(names.take(pc.if_else(pc.and_(pc.greater_equal(ids, 0), pc.less(ids, len(names))), ids, pa.scalar(None, pa.int64()))))
    cuts, ids = kept(in_table), ids.filter(in_table)
    return joined(ids.to_numpy(), cuts, names)


def decode_batches(batches, model: str, group_bytes: int = 8 << 20):
    """Appends the decoded text to each batch whose last column is the ids."""
    names = held(tokens_of, model)
    for batch in batches:
        column = batch.column(batch.num_columns - 1)
        sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
        for a, b in stretches(sizes, group_bytes):
            part = batch.slice(a, b - a)
            texts = decoded(part.column(part.num_columns - 1), names)
            yield pa.RecordBatch.from_arrays([*part.columns, texts], [*part.schema.names, "decoded"])


def read_model(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids) per row of ``docs``: token ids as spaced decimals.

    ``model_path`` is a tokenizer file on the driver; its content (a fixed
    vocabulary) travels with the job. Null text counts as empty: no tokens,
    empty ids. Special tokens' strings in a text become these tokens.
    Repeated rows and null ids come back as they are; very long texts are
    handled whole; an empty table gives an empty table; other columns are
    ignored.
    """
    model = read_model(model_path)
    return docs.select("doc_id", "text").mapInArrow(
        lambda batches: encode_batches(batches, model),
        "doc_id " + dict(docs.dtypes)["doc_id"] + ", n_tokens long, ids string",
    )


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) per row of ``encoded``: the text that
    its ids (spaced decimals) decode to, their tokens joined by a space,
    special ones included.

    Ids that the vocabulary does not have give nothing, null ids the empty
    text; what is no integer is an error. Repeated rows come back as they are;
    very long id lists are handled whole; an empty table gives an empty table;
    other columns are ignored.
    """
    model = read_model(model_path)
    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(
        lambda batches: decode_batches(batches, model),
        "doc_id " + dict(encoded.dtypes)["doc_id"] + ", n_tokens long, ids string, decoded string",
    )


def round_trip(docs: DataFrame, model_path: str) -> DataFrame:
    """``decode`` of ``encode``: the same rows, in one pass. A batch of ids goes
    to the decoder within the Python worker that made it."""
    model = read_model(model_path)
    return docs.select("doc_id", "text").mapInArrow(
        lambda batches: decode_batches(encode_batches(batches, model), model),
        "doc_id " + dict(docs.dtypes)["doc_id"] + ", n_tokens long, ids string, decoded string",
    )


def digests(encoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per row of what ``decode``
    gives: lowercase hex; null ids or text have a null digest; repeated rows
    come back as they are, an empty table gives an empty table."""
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
