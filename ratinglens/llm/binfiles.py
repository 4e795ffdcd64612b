"""Token ids in binary shards with a minimal perfect hash index.

A shard holds the ids of a range of doc_ids in ascending order, end id
included, as raw little-endian integers (two bytes where the vocabulary
allows, else four), followed by

* the row table: first id, key and whether there is a key, per document;
* the index: a minimal perfect hash over the shard's distinct keys (levels of
  bit sets with ranks), and per slot the key's fingerprint and first row;
* a footer with the sections' places.

The manifest names the range of keys of each shard, so a key leads to its
shard; there it is found in constant time: hash, rank, compare the
fingerprint, read the row. Shards are written by the tasks that encode them, under a name of
their own and then moved in place, so a task that runs again after a lost
executor leaves the same file; all places are in the shared scratch folder.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
import struct
import sys
import types
import uuid
import zlib
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratinglens.session import scratch_dir

from .common import saved

MAGIC = b"TOKSHARD1"
#: Characters of text in a shard, on average.
SHARD_CHARS = 48_000_000
#: Bytes of text encoded at once: the arrays over its chunks take some forty
#: times that, in each Python worker of an executor.
GROUP_BYTES = 4 << 20
#: Chunks whose ids are copied at once.
AT_ONCE = 1 << 19
#: White space bytes, and the bytes that a value of so many bytes keeps of eight.
SPACES = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Bits per key in a level of the hash, and levels before the rest is listed.
SPARSITY, LEVELS = 2, 40


# ------------------------------------------------------- minimal perfect hash


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: each level is a bit set;
    a key that has a bit of a level to itself is placed there, the others try
    the next. A key's slot is the number of set bits before its own."""

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray) -> None:
        self.levels, self.rest = levels, rest
        self.sizes = [len(x) * 64 for x in levels]
        words = np.concatenate([*levels, np.empty(0, np.uint64)])
        self.ranks = np.r_[0, np.cumsum(np.bitwise_count(words).astype(np.int64))]
        self.starts = np.r_[0, np.cumsum([len(x) for x in levels])].astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        keys, levels = keys.astype(np.uint64), []
        while len(keys) and len(levels) < LEVELS:
            size = -(-len(keys) * SPARSITY // 64) * 64
            at = (mix(keys, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            keys = keys[~alone[at]]
        return cls(levels, np.sort(keys))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key (of a key that was not built in: any slot or -1)."""
        keys = keys.astype(np.uint64)
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            at = (mix(keys[todo], level) % np.uint64(self.sizes[level])).astype(np.int64)
            word, bit = bits[at >> 6], (at & 63).astype(np.uint64)
            here = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[todo[here]] = (self.ranks[self.starts[level] + (at >> 6)] + below)[here]
            todo = todo[~here]
            if not len(todo):
                return out
        if len(self.rest):
            at = np.minimum(np.searchsorted(self.rest, keys[todo]), len(self.rest) - 1)
            found = self.rest[at] == keys[todo]
            out[todo[found]] = self.ranks[-1] + at[found]
        return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 997) >> np.uint64(32)).astype(np.uint32)


# ------------------------------------------------------------------- encoding


class ChunkIds:
    """Ids of chunks (runs without white space) as packed integers, remembered
    up to a bound, the chunks in use longer than others.

    A chunk is cut at the boundaries of the tokenizer's own pre-tokens, where
    they are sure; what is new among these pieces is encoded by the tokenizers
    library, many in a text, and its ids are parted after each token that ends
    a word. Other chunks are encoded by the library as they are."""

    # The pre-tokeniser's pattern, for lower-case ASCII.
    ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
    #: Letters of any script between runs of ASCII marks.
    MARKED = re.compile(r"([!-/:-@\[-`{-~]*)([^\W\d_]+)([!-/:-@\[-`{-~]*)")

    def __init__(self, model: str, bound: int = 400_000) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        suffix = json.loads(model)["model"].get("end_of_word_suffix")
        if not suffix:
            raise ValueError("this tokenizer does not mark the ends of words")
        vocab = self.tokenizer.get_vocab(True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self.width = 2 if len(self.ends) <= 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.mark = os.path.commonprefix(special)
        if not self.mark:
            raise ValueError("the special tokens of this tokenizer begin in different ways")
        # Chunk -> ids: met since the table was full, and before; piece -> ids.
        self.bound, self.known, self.older, self.pieces = bound, {}, {}, {}

    def whole(self, text: str) -> bytes:
        """Ids of a text by the library alone."""
        ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, self.kind).tobytes()

    def cut(self, low: str) -> list[str] | None:
        """The pre-tokens of a lower-cased chunk; None where that is left to
        the library (marks and digits of other scripts)."""
        if low.isascii():
            return self.ASCII.findall(low)
        found = self.MARKED.fullmatch(low)
        if found is None or found[1] == "'" or not found[2].isalpha():
            return None
        return [x for x in found.groups() if x]

    def learn(self, chunks: list[bytes]) -> dict[bytes, bytes]:
        """Ids of chunks that are not known."""
        out, split, fresh, pieces = {}, [], set(), self.pieces
        joined = b"\n".join(chunks)
        text = joined.decode()
        lows = text.lower().split("\n")
        if self.mark in text or "Σ" in text:  # special tokens; a lower case that depends on the place
            for i, t in enumerate(text.split("\n")):
                if self.mark in t or "Σ" in t:
                    out[chunks[i]], lows[i] = self.whole(t), None
        for c, low in zip(chunks, lows):
            if low in pieces:
                out[c] = pieces[low]
            elif low is not None:
                parts = [low] if low.isalpha() else self.cut(low)
                if parts is None:
                    out[c] = self.whole(c.decode())
                else:
                    split.append((c, parts))
                    fresh.update(parts)
        self.learn_pieces([p for p in fresh if p not in pieces])
        for c, parts in split:
            out[c] = pieces[parts[0]] if len(parts) == 1 else b"".join([pieces[p] for p in parts])
        return out

    def learn_pieces(self, fresh: list[str], at_once: int = 5000) -> None:
        for i in range(0, len(fresh), at_once):
            part = fresh[i : i + at_once]
            raw = self.whole(" ".join(part))
            cuts = (np.flatnonzero(self.ends[np.frombuffer(raw, self.kind)]) + 1) * self.width
            if len(cuts) != len(part):
                raise ValueError("a piece is not one word of this tokenizer")
            cuts = cuts.tolist()
            self.pieces.update(zip(part, [raw[a:b] for a, b in zip([0, *cuts], cuts)]))

    def ids_of(self, chunks: list[bytes]) -> list[bytes]:
        """Packed ids of distinct chunks."""
        if len(self.known) > self.bound:
            self.known, self.older = {}, self.known
        if len(self.pieces) > self.bound:
            self.pieces = {}
        ids = list(map(self.known.get, chunks))
        new = [c for c, x in zip(chunks, ids) if x is None]
        if new:
            found = {c: self.older[c] for c in new if c in self.older}
            collects = gc.isenabled()
            gc.disable()  # many small lists, none in a cycle
            try:
                found |= self.learn([c for c in new if c not in found])
            finally:
                if collects:
                    gc.enable()
            self.known |= found
            ids = [found[c] if x is None else x for c, x in zip(chunks, ids)]
        return ids

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Packed ids of each text: its chunks are numbered by their distinct
        values in arrays, and the ids of these values are copied to all their
        places at once."""
        ends_of_text = np.cumsum([len(t) + 1 for t in texts])
        joined = b" ".join(texts) + b" "
        starts, number, distinct = distinct_chunks(joined)
        ids = self.ids_of(distinct)
        flat = np.frombuffer(b"".join(ids), self.kind)
        n = np.array([len(x) for x in ids], np.int64) // self.width
        first = np.cumsum(n) - n
        cuts = np.r_[0, np.searchsorted(starts, ends_of_text)]
        out: list[bytes] = []
        at = 0
        while at < len(texts):  # texts of up to AT_ONCE chunks, or one
            last = max(at + 1, int(np.searchsorted(cuts, cuts[at] + AT_ONCE, "right")) - 1)
            own = number[cuts[at] : cuts[last]]
            sizes = n[own]
            before = np.r_[0, np.cumsum(sizes)]
            copied = flat[np.repeat(first[own] - before[:-1], sizes) + np.arange(before[-1])].tobytes()
            places = (before[cuts[at : last + 1] - cuts[at]] * self.width).tolist()
            out += [copied[a:b] for a, b in zip(places, places[1:])]
            at = last
        return out


def distinct_chunks(joined: bytes) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(start of every chunk, number of its value, the distinct values) of a
    text that ends in white space.

    Values of up to 16 bytes are two integers; they are grouped by a hash of
    these, and every one is compared with the first of its group. Longer ones,
    and those that differ from their group's first, go by a dictionary."""
    raw = np.frombuffer(joined + bytes(16), np.uint8)
    blank = SPACES[raw[: len(joined)]]
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if len(blank) and not blank[0]:
        edges = np.r_[0, edges]
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    sliding = np.lib.stride_tricks.as_strided(raw[:8].view("<u8"), (len(joined) + 8,), (1,), writeable=False)
    low = sliding[starts] & KEEP[np.minimum(sizes, 8)]
    high = sliding[starts + 8] & KEEP[np.clip(sizes - 8, 0, 8)]
    key = mix(low, 1) ^ mix(high ^ sizes.astype(np.uint64), 2)
    short = np.flatnonzero(sizes <= 16)
    order = short[np.argsort(key[short])]
    sorted_key = key[order]
    fresh = np.r_[True, sorted_key[1:] != sorted_key[:-1]][: len(order)]
    group, firsts = np.cumsum(fresh) - 1, order[fresh]
    one = firsts[group]
    number = np.empty(len(starts), np.int64)
    number[order] = group
    same = (low[order] == low[one]) & (high[order] == high[one]) & (sizes[order] == sizes[one])
    values = [joined[a:b] for a, b in zip(starts[firsts].tolist(), (starts + sizes)[firsts].tolist())]
    odd = np.r_[order[~same], np.flatnonzero(sizes > 16)]
    held: dict[bytes, int] = {}
    for i, a, b in zip(odd.tolist(), starts[odd].tolist(), (starts + sizes)[odd].tolist()):
        number[i] = held.setdefault(joined[a:b], len(values) + len(held))
    values += held
    return starts, number, values


def chunk_ids(model: str) -> ChunkIds:
    """The encoder of this Python worker: a worker is used for one task after
    another, but what a task unpickles, globals included, is its own."""
    held = sys.modules.setdefault("_token_shard_encoders", types.ModuleType("_token_shard_encoders")).__dict__
    key = hashlib.sha256(model.encode()).hexdigest()
    if key not in held:
        held[key] = ChunkIds(model)
    return held[key]


# ---------------------------------------------------------------------- files


def filesystem(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pyarrow.fs.FileSystem.from_uri(uri)


def write_shard(batches, folder: str, model: str, end_id: int, group_bytes: int = GROUP_BYTES):
    """(doc_id, text) in ascending order -> one file; a row (shard, path, docs,
    ids, first_key, last_key, null_keys) if there was a document."""
    encoder = chunk_ids(model)
    fs, root = filesystem(folder)
    shard = TaskContext.get().partitionId()
    temp, final = f"{root}/.shard-{shard:06d}-{uuid.uuid4().hex}", f"{root}/shard-{shard:06d}.ids"
    end = np.array([end_id], encoder.kind).tobytes()
    keys, has_key, firsts = [], [], [0]
    out = None
    for batch in batches:
        at, column = 0, batch.column(1).cast(pa.binary())
        while at < batch.num_rows:
            if out is None:
                out = fs.open_output_stream(temp)
            texts, size = [], 0
            while at + len(texts) < batch.num_rows and size < group_bytes:
                texts.append(column[at + len(texts)].as_py() or b"")
                size += len(texts[-1])
            for raw in encoder.encode(texts):
                out.write(raw)
                out.write(end)
                firsts.append(firsts[-1] + len(raw) // encoder.width + 1)
            ids = batch.column(0).slice(at, len(texts))
            keys.append(ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
            has_key.append(ids.is_valid().to_numpy(zero_copy_only=False))
            at += len(texts)
    if out is None:
        return
    keys, has_key = np.concatenate(keys), np.concatenate(has_key)
    distinct, row = np.unique(keys[has_key].view(np.uint64), return_index=True)
    row = np.flatnonzero(has_key)[row]
    index = PerfectHash.build(distinct)
    slot = index.slots(distinct)
    slot_rows, slot_prints = np.empty(len(distinct), np.int64), np.empty(len(distinct), np.uint32)
    slot_rows[slot], slot_prints[slot] = row, fingerprints(distinct)
    sections = {
        "firsts": np.array(firsts, np.int64),
        "keys": keys,
        "has_key": has_key.astype(np.uint8),
        "level_words": np.array([len(x) for x in index.levels], np.int64),
        "levels": np.concatenate([*index.levels, np.empty(0, np.uint64)]),
        "rest": index.rest,
        "slot_rows": slot_rows,
        "slot_prints": slot_prints,
    }
    places, at = {}, firsts[-1] * encoder.width
    for name, a in sections.items():
        raw = a.tobytes()
        places[name] = [at, len(raw), a.dtype.str]
        out.write(raw)
        at += len(raw)
    footer = json.dumps({"width": encoder.width, "end_id": end_id, "sections": places}).encode()
    out.write(footer + struct.pack("<q", len(footer)) + MAGIC)
    out.close()
    fs.move(temp, final)
    path = folder.rstrip("/") + f"/shard-{shard:06d}.ids"
    keyed = keys[has_key]
    row = {
        "shard": shard,
        "path": path,
        "docs": len(keys),
        "ids": firsts[-1],
        "first_key": int(keyed.min()) if len(keyed) else None,
        "last_key": int(keyed.max()) if len(keyed) else None,
        "null_keys": not has_key.all(),
    }
    kinds = [pa.int32(), pa.string(), *[pa.int64()] * 4, pa.bool_()]
    yield pa.RecordBatch.from_pylist([row], pa.schema(list(zip(row, kinds))))


class Shard:
    """Reads one shard: by key in constant time, or all documents in order."""

    def __init__(self, path: str) -> None:
        fs, name = filesystem(path)
        self.file = fs.open_input_file(name)
        tail = len(MAGIC) + 8
        end = self.file.size()
        length, magic = struct.unpack(f"<q{len(MAGIC)}s", self.file.read_at(tail, end - tail))
        if magic != MAGIC:
            raise ValueError(f"not a token shard: {path}")
        footer = json.loads(self.file.read_at(length, end - tail - length))
        self.width = footer["width"]
        self.kind = np.dtype(f"<u{self.width}")
        part = {n: np.frombuffer(self.file.read_at(size, at), kind) for n, (at, size, kind) in footer["sections"].items()}
        self.firsts, self.keys, self.has_key = part["firsts"], part["keys"], part["has_key"].astype(bool)
        self.slot_rows, self.slot_prints = part["slot_rows"], part["slot_prints"]
        cuts = np.cumsum(part["level_words"])[:-1]
        levels = np.split(part["levels"], cuts) if len(part["level_words"]) else []
        self.hash = PerfectHash(levels, part["rest"])

    def rows_of(self, keys: np.ndarray) -> np.ndarray:
        """Row of the first document with each key; -1 if the stored
        fingerprint, or the key itself, differs."""
        keys = np.asarray(keys, np.int64)
        slot = self.hash.slots(keys.view(np.uint64))
        found = (slot >= 0) & (slot < len(self.slot_rows))
        out = np.full(len(keys), -1, np.int64)
        at = slot[found]
        same = self.slot_prints[at] == fingerprints(keys[found].view(np.uint64))
        row = self.slot_rows[at]
        out[found] = np.where(same & (self.keys[row] == keys[found]), row, -1)
        return out

    def ids(self, row: int) -> np.ndarray:
        a, b = int(self.firsts[row]) * self.width, int(self.firsts[row + 1]) * self.width
        return np.frombuffer(self.file.read_at(b - a, a), self.kind)

    def get(self, key: int) -> np.ndarray | None:
        """Ids of the first document with this key."""
        row = int(self.rows_of(np.array([key]))[0])
        return None if row < 0 else self.ids(row)

    def rows_with(self, key: int) -> range:
        """Rows of all documents with this key; they follow the first one."""
        row = int(self.rows_of(np.array([key]))[0])
        if row < 0:
            return range(0)
        return range(row, row + int(np.searchsorted(self.keys[row:], key, "right")))


def write_files(docs: DataFrame, model: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Encodes ``docs`` (doc_id, text) into shards under ``folder`` (default: a
    new scratch folder) and returns their manifest: shard, path, docs, ids,
    first_key and last_key (null if no document has a key), null_keys (whether
    a document has none) and start (ids in all shards before).

    ``model`` is the content of a tokenizer file. Null text is empty (the end
    id alone); rows without a doc_id come first and have no key; rows of one
    doc_id follow each other by text, and the key leads to the first of a
    shard; equal rows may be parted by a shard's end. Other columns are
    ignored; an empty table has no shard."""
    spark = docs.sparkSession
    folder = folder or scratch_dir(spark, "token-shards")
    fs, root = filesystem(folder)
    fs.create_dir(root, recursive=True)
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = rows.repartitionByRange(max(1, -(-chars // SHARD_CHARS)), "doc_id", F.xxhash64("text")).sortWithinPartitions(
        "doc_id", F.xxhash64("text"), "text"
    )
    written = ordered.mapInArrow(
        partial(write_shard, folder=folder, model=model, end_id=end_id),
        "shard int, path string, docs long, ids long, first_key long, last_key long, null_keys boolean",
    )
    manifest = saved(written, "token-manifest")
    # One row per shard: the driver adds up what comes before each.
    sizes = sorted((r.shard, r.ids) for r in manifest.select("shard", "ids").collect())
    before = np.r_[0, np.cumsum([n for _, n in sizes])].tolist()
    starts = spark.createDataFrame([(s, b) for (s, _), b in zip(sizes, before)], "shard int, start long")
    return manifest.join(starts, "shard")


def read_documents(batches, block: int = 1 << 22):
    """(path, start) -> (doc_id, start, n_tokens, ids_crc32) of every document,
    each found again through the index by its key."""
    for batch in batches:
        for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            shard = Shard(path)
            keyed = shard.has_key
            n = len(shard.keys)
            # The place of a document: the row that its key's slot gives, and
            # as many on as documents of the key precede it; without a key its own.
            place = np.arange(n)
            keys = shard.keys[keyed]
            new = np.r_[True, keys[1:] != keys[:-1]][: len(keys)]
            first = shard.rows_of(keys[new])
            run = np.diff(np.r_[np.flatnonzero(new), len(keys)])
            place[keyed] = np.repeat(first - np.flatnonzero(new), run) + np.arange(len(keys))
            if (first < 0).any() or (np.bincount(place, minlength=n) != 1).any() or (shard.keys[place] != shard.keys).any():
                raise ValueError(f"index of {path} misses a key")
            crcs = np.empty(n, np.int64)
            at = np.argsort(place, kind="stable")  # documents in the order of their places
            row = 0
            while row < n:  # a block of whole documents at a time
                last = max(row + 1, int(np.searchsorted(shard.firsts, shard.firsts[row] + block, "right")) - 1)
                a, b = int(shard.firsts[row]) * shard.width, int(shard.firsts[last]) * shard.width
                wide = np.frombuffer(shard.file.read_at(b - a, a), shard.kind).astype("<u4").tobytes()
                cuts = (shard.firsts[row : last + 1] - shard.firsts[row]) * 4
                for i in range(row, last):
                    crcs[at[i]] = zlib.crc32(wide[cuts[i - row] : cuts[i - row + 1]])
                row = last
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shard.keys, mask=~keyed),
                    pa.array(shard.firsts[place] + start),
                    pa.array(np.diff(shard.firsts)[place]),
                    pa.array(crcs),
                ],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the shards of
    a manifest, read from the files."""
    n = max(1, manifest.count())
    return (
        manifest.select("path", "start")
        .repartition(n, "path")
        .mapInArrow(read_documents, "doc_id long, start long, n_tokens long, ids_crc32 long")
    )


def find_documents(batches):
    """(path, start, key), the rows of a path together -> (doc_id, start, ids)
    of the documents with the key."""
    path, shard = None, None
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.list_(pa.int32()))])
    for batch in batches:
        for own, start, key in zip(*(c.to_pylist() for c in batch.columns)):
            if own != path:
                path, shard = own, Shard(own)
            for row in shard.rows_with(key):
                found = {"doc_id": key, "start": start + int(shard.firsts[row]), "ids": shard.ids(row).astype(np.int32)}
                yield pa.RecordBatch.from_pylist([found], schema)


def find(manifest: DataFrame, keys: DataFrame) -> DataFrame:
    """(doc_id, start, ids) of every document whose key is among ``keys``
    (doc_id; null and repeated ones count once or not at all).

    A range join to the manifest leads to the shards that can hold a key (two
    where its documents are parted by a shard's end), the shard's index to its
    documents. Keys that no document has give no row."""
    wanted = keys.select(F.col("doc_id").cast("long").alias("key")).where("key is not null").distinct()
    held = wanted.join(manifest, F.col("key").between(F.col("first_key"), F.col("last_key")))
    return (
        held.select("path", "start", "key")
        .repartition("path")
        .sortWithinPartitions("path", "key")
        .mapInArrow(find_documents, "doc_id long, start long, ids array<int>")
    )
