"""Array code that several operators run inside their tasks: hashes of all words
and word shingles of a batch of texts, and runs of equal keys in sorted batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text hashed at once (a longer text is hashed alone).
GROUP_BYTES = 500_000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLIER = 0xD6E8FEB86659FD93


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64."""
    out = []
    for base in (_MULTIPLIER, pow(_MULTIPLIER, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


def _fold_case() -> np.ndarray:
    table = np.arange(1, 257, dtype=np.uint64)
    table[65:91] = table[97:123]
    return table


_FOLDED = _fold_case()
#: Values of the bytes with which letters of either case differ.
CASED = np.arange(1, 257, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def text_groups(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The batch in groups of whole texts: first text, number of texts, their
    bytes, and the texts' places in these (one more than texts)."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        end = max(first + 1, int(np.searchsorted(at, at[first] + GROUP_BYTES, "right")) - 1)
        yield first, end - first, raw[at[first]:at[end]], at[first:end + 1] - at[first]
        first = end


def word_hashes(raw: np.ndarray, at: np.ndarray, breaks: np.ndarray = _SPACE,
                values: np.ndarray = _FOLDED) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words of each text (letters A-Z lower-cased, unless
    the bytes have other ``values``; words split at ASCII white space or at the
    given bytes), the index of each text's
    first word (one more than texts), and the words' first and last-plus-one
    bytes."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~breaks[raw]
    edge = np.empty(n, bool)  # a new word may begin here
    edge[0] = True
    edge[1:] = ~inside[:-1]
    edge[at[:-1][at[:-1] < n]] = True
    starts = np.flatnonzero(inside & edge)
    ends = np.empty(n, bool)
    ends[-1] = True
    ends[:-1] = edge[1:] | ~inside[1:]
    stops = np.flatnonzero(inside & ends) + 1
    up, down = _powers(max(n, GROUP_BYTES))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values[raw] * up[:n], out=sums[1:])
    h = mix((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64) * _ODD)
    return h, np.searchsorted(starts, at), starts, stops


def shingle_hashes(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words inside each text, a text of 1 to k-1
    words giving one for all its words; and the index of each text's first."""
    words = np.diff(first)
    counts = np.where(words >= k, words - k + 1, (words > 0).astype(np.int64))
    at = np.concatenate([[0], np.cumsum(counts)])
    if not at[-1]:
        return np.zeros(0, np.uint64), at
    start = np.repeat(first[:-1] - at[:-1], counts) + np.arange(at[-1])
    size = np.repeat(np.minimum(words, k), counts)
    out = size.astype(np.uint64) * _ODD
    padded = np.concatenate([h, np.zeros(k, np.uint64)])
    for j in range(k):
        step = mix(padded[start + j] + np.uint64((2 * j + 1) * 0xA0761D6478BD642F & (1 << 64) - 1))
        out += np.where(size > j, step, np.uint64(0))
    return mix(out), at


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, n, raw, at in text_groups(texts):
        h, first, _, _ = word_hashes(raw, at)
        s, place = shingle_hashes(h, first, k)
        for i in range(n):
            yield np.unique(s[place[i]:place[i + 1]])


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole runs of equal keys, from batches sorted by them (the
    keys are integers).  What a batch leaves open goes on in the next."""
    left: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        last = b.num_rows - 1
        same = np.ones(b.num_rows, bool)
        for k in keys:
            v = b.column(k).to_numpy(zero_copy_only=False)
            same &= v == v[last]
        cut = 0 if same.all() else int(np.flatnonzero(~same)[-1]) + 1
        if left and cut == 0:
            head = left[-1]
            if any(head.column(k)[head.num_rows - 1] != b.column(k)[last] for k in keys):
                yield pa.Table.from_batches(left)
                left = []
        if cut:
            yield pa.Table.from_batches([*left, b.slice(0, cut)])
            left = []
        left.append(b.slice(cut))
    if left:
        yield pa.Table.from_batches(left)
