"""BPE, token counts and packing against the tokenizers library."""

import hashlib
import random
import zlib
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starloom.llm import bpe, packing, token_counts

WORD, BYTE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = ["", " ", "a", "aaaaaaa aaaa", "<|endoftext|> hi <|startoftext|>x", "İstanbul ΣΑΣ ß ﬁ ²³ ½ 中文 x y é don't WE'LL 'S 12345",
       "\x1c\x1d a\x85b", "😀😀 ok", "a_b __ --!!", "   \n\n x  \t\n", " lead trail  ", "ab" * 3000, "z" * 300, "the<|endoftext|>the", "a \n b", "a\n \nb", "x\r\n y"]


def texts(n=400, seed=3):
    r = random.Random(seed)
    out = list(ODD)
    for _ in range(n):
        out.append("".join(r.choice("aab’nthe T'sr1 2_.-$\n éß中́̈🎉İΣ​٣ü ") for _ in range(r.randint(0, 80))))
        out.append("".join(r.choice("an theing") for _ in range(r.randint(0, 120))))
    return out


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_automaton_equals_the_library(path):
    library, codec = Tokenizer.from_file(path), bpe.BpeCodec(path)
    for t in texts():
        e = library.encode(t, add_special_tokens=False)
        assert codec.encode(t).tolist() == e.ids, t
        assert codec.count(t) == len(e.ids), t
        assert codec.decode(e.ids) == library.decode(e.ids, skip_special_tokens=False), t


def test_arcs_are_the_pairs_that_stay_apart():
    """The automaton of a small merge list accepts what merging in order leaves."""
    merges = [("a", "a"), ("a", "b"), ("aa", "b"), ("ab", "ab"), ("b", "b")]
    vocab = {s: i for i, s in enumerate(["a", "b", *("".join(m) for m in merges)])}
    automaton = bpe.MergeAutomaton(vocab, merges)
    for n in range(1, 9):
        for word in map("".join, product("ab", repeat=n)):
            parts = list(word)
            for a, b in merges:
                i = 0
                while i + 1 < len(parts):
                    if parts[i] == a and parts[i + 1] == b:
                        parts[i:i + 2] = [a + b]
                    i += 1
            assert automaton.decode(automaton.encode(word)) == parts
        words = ["".join(w) for w in product("ab", repeat=n)] * 20
        assert automaton.encode_all(words) == [bpe._pack(automaton.encode(w)) for w in words]
        assert automaton.count_all(words) == [len(automaton.encode(w)) for w in words]
    with pytest.raises(ValueError):
        automaton.encode("ac")
    with pytest.raises(ValueError):
        automaton.encode_all(["abc"] * 30)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_many_texts_at_once_and_a_small_memory(path, monkeypatch):
    """Groups of texts, memories that overflow, words of very unlike lengths."""
    library = Tokenizer.from_file(path)
    every = [*texts(300, 8), "qx" * 5000, " ".join(f"{i}th-{i * 7919 % 10007}x" for i in range(3000)), *texts(50, 8)]
    want = [library.encode(t, add_special_tokens=False).ids for t in every]
    for group, cache, few in ((1_000_000, 100_000, 16), (500, 40, 1), (2000, 300, 4)):
        monkeypatch.setattr(bpe, "GROUP_CHARS", group)
        monkeypatch.setattr(bpe, "CACHE_SPELLED", cache)
        monkeypatch.setattr(bpe, "CACHE_PLAIN", cache)
        monkeypatch.setattr(bpe, "FEW", few)
        codec = bpe.BpeCodec(path)
        assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode_all(every)] == want
        assert [*codec.count_all(every)] == [len(x) for x in want]
        assert token_counts.count_texts(every, codec, 64) == [len(x) for x in want]


def test_round_trip_digests(spark):
    rows = [(i, t, "x", i) for i, t in enumerate(texts(20))] + [(None, "a b", "y", 0), (5, None, "y", 0), (5, None, "y", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int").repartition(3)
    library = Tokenizer.from_file(WORD)
    want = []
    for i, t, *_ in rows:
        e = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(e), hashlib.sha256(" ".join(map(str, e)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(e, skip_special_tokens=False).encode()).hexdigest()))
    got = [tuple(r) for r in bpe.round_trip_digests(df, WORD).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert bpe.round_trip_digests(df.limit(0), WORD).count() == 0
    encoded = bpe.encode_documents(df, BYTE)
    back = sorted((r.text for r in bpe.decode_documents(encoded, BYTE).collect()), key=str)
    byte = Tokenizer.from_file(BYTE)
    assert back == sorted((byte.decode(byte.encode(t or "").ids, skip_special_tokens=False) for _, t, *_ in rows), key=str)


def test_state_maps_compose_to_the_whole():
    codec = bpe.BpeCodec(BYTE)
    for t in [*texts(60), "word " * 500, "x" * 2000, "a\n b " * 300]:
        for chunk in (1, 3, 7, 64):
            assert token_counts.count_text(t, codec, chunk) == codec.count(t), (t, chunk)


def test_token_counts(spark):
    rows = [(i, t, True) for i, t in enumerate(texts(20))] + [(None, "a b", False), (7, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, over_limit boolean")
    library = Tokenizer.from_file(BYTE)
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t, _ in rows]
    assert sorted(map(tuple, token_counts.count_tokens(df, BYTE).collect()), key=str) == sorted(want, key=str)
    assert token_counts.count_tokens(df.limit(0), BYTE).count() == 0


def fewest_bins(lengths, capacity):
    best = len(lengths)
    order = sorted(lengths, reverse=True)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(order):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + order[i] <= capacity and bins[k] not in bins[:k]:
                place(i + 1, [*bins[:k], bins[k] + order[i], *bins[k + 1:]])
        place(i + 1, [*bins, order[i]])

    place(0, [])
    return best


def test_bounds_and_best_fit_against_the_optimum():
    r = random.Random(5)
    for _ in range(150):
        capacity = r.choice([10, 16, 31])
        lengths = np.array([r.randint(1, capacity) for _ in range(r.randint(1, 9))])
        best = fewest_bins(lengths.tolist(), capacity)
        bins, places = packing.best_fit_decreasing(lengths, capacity)
        assert packing.lower_bound(lengths, capacity) <= best <= bins.max() + 1
        for b in range(bins.max() + 1):
            at = sorted((p, n) for p, n, x in zip(places, lengths, bins) if x == b)
            assert [p for p, _ in at] == [sum(n for _, n in at[:k]) for k in range(len(at))]
            assert sum(n for _, n in at) <= capacity
    assert packing.lower_bound(np.zeros(0, int), 8) == 0


def test_exchange_reaches_the_bound(spark):
    r = random.Random(8)
    lengths = [r.randint(1, 400) for _ in range(3000)] + [4096] * 5 + [2100] * 40
    df = spark.createDataFrame([(i % 700, i, n) for i, n in enumerate(lengths)], "doc_id long, piece int, length long").repartition(5)
    out = packing.pack(df, 4096, block_pieces=200).toPandas()
    assert sorted(out.length) == sorted(lengths)
    out = out.sort_values(["sequence_id", "offset"])
    assert (out.groupby("sequence_id").length.cumsum() - out.length == out.offset).all()
    assert out.groupby("sequence_id").length.sum().max() <= 4096
    bound = packing.lower_bound(np.array(lengths), 4096)
    assert bound <= out.sequence_id.nunique() <= bound + 1
    assert packing.pack(df.limit(0), 4096).count() == 0


def test_pieces(spark):
    rows = [(1, "the cat " * 30), (2, None), (3, ""), (3, ""), (None, "x"), (4, "a b c")]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, length int")
    library = Tokenizer.from_file(WORD)
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        want += [(i, k, s, len(ids[s:s + 8]), zlib.crc32(np.array(ids[s:s + 8], "<u4").tobytes())) for k, s in enumerate(range(0, len(ids), 8))]
    assert sorted(map(tuple, packing.token_pieces(df, WORD, 8).collect()), key=str) == sorted(want, key=str)
    packed = packing.pack_documents(df, WORD, 8)
    assert packed.count() == len(want) and set(packed.columns) >= {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
