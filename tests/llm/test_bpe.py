import time

import numpy as np
import pyarrow as pa
import pytest
from brute import sha
from hypothesis import given, settings
from hypothesis import strategies as st
from odd_rows import no_docs, odd_docs  # noqa: F401

from ratinglens.llm import bpe
from ratinglens.llm.queries import tokenizer_path

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def reference():
    return tokenizers.Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.parse(bpe.read_model(tokenizer_path())), bound=2000)


def expected(reference, text):
    ids = reference.encode(text or "", add_special_tokens=False).ids
    return len(ids), " ".join(map(str, ids)), reference.decode(ids, skip_special_tokens=False)


def coded(encoder, texts):
    """(number of ids, ids, text decoded from them) per text."""
    ids, cuts = encoder.encode([t.encode() for t in texts])
    numbers, tokens = (bpe.names_of(encoder.tables[k]) for k in ("number", "token"))
    told = bpe.joined(ids, cuts, numbers)
    return list(zip(np.diff(cuts).tolist(), told.to_pylist(), bpe.decoded(told, tokens).to_pylist()))


ODD = [
    "", "  ", "it's we're I'LL don't ''s", "ΣΑΣ İstanbul ẞ ß", "é café ﬁ", "x\x1cy\x1fz \x85 \xa0 a",
    "a<|endoftext|>b", "<|startoftext|><|endoftext|", "aaaaaaaaaaaa abababab anananwh hahahaha", "12 ½ ٣ ²",
    "日本語 각 한국어", "😀👍🏽‍", "\0 nul\0x", "a_b __ ...!!! <|", " 　x ",
]


def test_odd_texts(reference, encoder):
    assert coded(encoder, ODD) == [expected(reference, t) for t in ODD]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abcdehils' éß!.1<|>\ńΣA"), max_size=60))
def test_any_text(reference, encoder, text):
    assert coded(encoder, [text]) == [expected(reference, text)]


def test_order_within_a_word_is_kept():
    # Merging c+d makes (ab, cd) of lower rank than (x, x): it goes first.
    vocab = {s: i for i, s in enumerate(["a", "b", "c", "d", "ab", "cd", "abcd"])}
    pairs = {("c", "d"): 1, ("a", "b"): 2, ("ab", "cd"): 0}
    merges = {(vocab[a], vocab[b]): (r, vocab[a + b]) for (a, b), r in pairs.items()}
    byte = [vocab.get(chr(i), 0) for i in range(256)]
    tables = {"inner": byte, "final": byte, "merges": merges, "ranks": bpe.PairRanks(merges)}
    words = [b"abcd", b"abab", b"cdab", b"a", b"abcdabcd"]
    assert bpe.merge_all(words, tables) == [bpe.merge_one(w, tables) for w in words]
    assert bpe.merge_all([], tables) == []


def plain_merge(word, tables):
    ids = [tables["inner"][b] for b in word[:-1]] + [tables["final"][word[-1]]]
    while found := [(tables["merges"][p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in tables["merges"]]:
        _, i = min(found)
        ids[i : i + 2] = [tables["merges"][ids[i], ids[i + 1]][1]]
    return ids


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("abcd"), min_size=1, max_size=40), st.permutations(range(8)))
def test_one_word_equals_the_plain_rule(word, order):
    symbols = ["a", "b", "c", "d"]
    pairs = []
    for a, b in [(0, 1), (2, 3), (4, 5), (0, 0), (7, 7), (1, 0), (6, 2), (3, 4)]:
        symbols.append(symbols[a] + symbols[b])
        pairs.append((a, b))
    merges = {p: (rank, 4 + i) for i, (p, rank) in enumerate(zip(pairs, order))}
    byte = [symbols.index(chr(i)) if chr(i) in "abcd" else 0 for i in range(256)]
    tables = {"inner": byte, "final": byte, "merges": merges, "ranks": bpe.PairRanks(merges)}
    words = [word.encode(), word[::-1].encode()]
    want = [plain_merge(w, tables) for w in words]
    assert [bpe.merge_one(w, tables) for w in words] == want
    assert bpe.merge_all(words, tables) == want


def test_a_very_long_word_takes_linear_steps(encoder):
    began = time.process_time()
    assert bpe.merge_one(b"banana" * 40_000, encoder.tables)
    assert time.process_time() - began < 30


def test_memory_of_chunks_is_bounded(reference):
    small = bpe.Encoder(bpe.parse(bpe.read_model(tokenizer_path())), bound=50)
    for i in range(0, 600, 20):
        texts = [f"word{j} it's {j}, w{j % 7}" for j in range(i, i + 20)]
        assert coded(small, texts) == [expected(reference, t) for t in texts]
    assert len(small.known) <= 150 and len(small.older) <= 150


def test_decoding_ids(spark, reference):
    ids = ["5 6 7", "", None, "49406 320 1 49407", "999999 320", "-1 320"]
    rows = [(i, 0, x, "y") for i, x in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id long, n_tokens long, ids string, `a.b` string")
    got = {r.doc_id: r.decoded for r in bpe.decode(df, tokenizer_path()).collect()}
    known = [[int(i) for i in (x or "").split() if 0 <= int(i) < 100_000] for x in ids]
    assert got == {i: reference.decode(x, skip_special_tokens=False) for i, x in enumerate(known)}
    names = pa.array(["a", None, "c"])
    assert bpe.decoded(pa.array(["0 1 2", "2 0", "1", "7"]).slice(1), names).to_pylist() == ["c a", "", ""]


def test_table(spark, reference, odd_docs, no_docs):
    path = tokenizer_path()
    got = bpe.digests(bpe.round_trip(odd_docs, path)).collect()
    apart = bpe.digests(bpe.decode(bpe.encode(odd_docs, path), path)).collect()
    assert sorted(map(str, apart)) == sorted(map(str, got))
    want = [expected(reference, r.text) for r in odd_docs.collect()]
    assert sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(
        (n, sha(i), sha(d)) for n, i, d in want
    )
    none = bpe.encode(no_docs, tokenizer_path())
    assert none.count() == 0 and bpe.decode(none, tokenizer_path()).count() == 0


def test_other_tokenizers_are_refused():
    import public_tokenizers

    with pytest.raises((ValueError, KeyError, TypeError)):
        bpe.parse(bpe.read_model(public_tokenizers.path("byte_bpe_50k.json")))
