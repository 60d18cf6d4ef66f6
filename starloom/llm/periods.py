"""Runs of repeated words, found by string synchronising sets.

A *run* is a stretch of words that repeats with smallest period ``q`` at least
four times (and has at least six words) and that no neighbouring word extends.

For a scale ``t`` = 8, 16, 32, ... a position ``i`` is *synchronising* if, of the
``t``-word windows that start in ``i..i+t``, the one with the smallest hash starts
at ``i`` or at ``i+t``.  That depends on the ``2t`` words from ``i`` on only, so
equal stretches have synchronising positions at equal places, and of any ``t``
positions in a row one is among them.  Windows of *highly periodic regions*,
inside a run with a period of at most ``t/4``, are left out, as they would make the
set dense; only where ``2t`` windows in a row are left out is there a gap, and
such a stretch has one small period throughout (two periods of at most ``t/4``
in windows that overlap in all but one word are one period).

In a run with period ``q`` in ``t..2t-1`` one of the first ``t`` positions, ``s``, is
synchronising; ``s+q`` is too, with the same ``2t`` words as context, and no
position between has that context, or the run would have a smaller period.  So
neighbours of equal context propose exactly the periods of their scale; each is
extended to both sides word by word, which decides.  Periods below the smallest
scale, which the sets leave out, come from the highly periodic regions, that are
found directly by comparing the words with themselves 1 to 7 places on.

The words of many texts are searched as one sequence, with a symbol of its own
between texts, so no run goes across; contexts are compared by 64-bit hashes
(equal contexts always meet; a collision could hide one run).

Nulls and texts without words have no words and no runs; a null ``doc_id`` is
kept; equal rows are searched each; other columns are not read; an empty table
gives no rows.  A text is searched whole in one task, in memory that is linear in
its length."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.kernels import mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: A run has at least this many words and repetitions.
LEAST_WORDS, REPEATS = 6, 4
#: The smallest scale; smaller periods are found directly.
SCALE = 8
#: Words searched as one sequence (a longer text alone).
GROUP_WORDS = 60_000

_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

Run = tuple[int, int, int]  # start, length, period


def _ahead(x: np.ndarray, k: int, fill) -> np.ndarray:
    out = np.full(len(x), fill, x.dtype)
    out[:max(0, len(x) - k)] = x[k:]
    return out


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last-plus-one places of the runs of true."""
    edges = np.diff(np.concatenate([[False], same, [False]]).astype(np.int8))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _extent(a: np.ndarray, at: int, q: int) -> tuple[int, int]:
    """The longest stretch around ``at`` in which each word equals the one ``q``
    places on, by steps of doubling length."""
    end, step = at, 64
    while True:
        differ = np.flatnonzero(a[end:min(end + step, len(a) - q)] != a[end + q:end + q + step])
        if len(differ) or end + step >= len(a) - q:
            end = end + int(differ[0]) if len(differ) else len(a) - q
            break
        end, step = end + step, 2 * step
    first, step = at, 64
    while first:
        low = max(0, first - step)
        differ = np.flatnonzero(a[low:first] != a[low + q:first + q])
        if len(differ):
            return low + int(differ[-1]) + 1, end
        first, step = low, 2 * step
    return first, end


def _synchronising(ids: np.ndarray, scale: int) -> np.ndarray:
    least, width = ids, 1
    while width < scale:
        least = np.minimum(least, _ahead(least, width, _NONE))
        width *= 2
    least = np.minimum(least, _ahead(ids, scale, _NONE))
    return np.flatnonzero((least != _NONE) & ((least == ids) | (least == _ahead(ids, scale, _NONE))))


def find_all(a: np.ndarray, longest: int) -> list[Run]:
    """All maximal stretches of ``a`` that repeat at least four times, with their
    smallest periods.  No part that repeats is longer than ``longest`` or holds
    the last place, whose symbol occurs nowhere else."""
    found: dict[tuple[int, int], int] = {}
    for q in range(1, min(SCALE, longest // REPEATS + 1)):
        first, end = _stretches(a[:-q] == a[q:])
        for k in np.flatnonzero(end - first >= (REPEATS - 1) * q).tolist():
            found.setdefault((int(first[k]), int(end[k]) + q), q)
    h, width = mix(a.astype(np.uint64) * _A + _B), 1
    scale = SCALE
    while REPEATS * scale <= longest:
        while width < 2 * scale:
            at_scale = h
            h = mix(h * _A + _ahead(h, width, np.uint64(0)) * _B)
            width *= 2
        ids = at_scale.copy()
        for (start, end), q in found.items():
            if REPEATS * q <= scale <= end - start:
                ids[start:end - scale + 1] = _NONE
        at = _synchronising(ids, scale)
        context = h[at]
        order = np.argsort(context, kind="stable")
        step = np.diff(at[order])
        pairs = np.flatnonzero((context[order][1:] == context[order][:-1]) & (step >= scale) & (step < 2 * scale))
        starts, periods = at[order][pairs], step[pairs]
        by_period = np.lexsort((starts, periods))
        starts, periods = starts[by_period], periods[by_period]
        begins = np.ones(len(starts), bool)  # of neighbours in one stretch the first will do
        begins[1:] = (np.diff(periods) != 0) | (np.diff(starts) > periods[1:])
        for s, q in zip(starts[begins].tolist(), periods[begins].tolist()):
            first, end = _extent(a, s, q)
            if end - first >= (REPEATS - 1) * q:
                found.setdefault((first, end + q), q)
        scale *= 2
    return [(start, end - start, q) for (start, end), q in found.items()]


def runs_of(texts: list[list[str]]) -> list[list[Run]]:
    """The runs of each text, given as words, by start and period."""
    out: list[list[Run]] = [[] for _ in texts]
    # Texts of similar length together: a scale is only searched where it fits.
    order = sorted((i for i, w in enumerate(texts) if len(w) >= LEAST_WORDS), key=lambda i: len(texts[i]))
    group: list[int] = []
    words = 0
    for i in order:
        if group and (words + len(texts[i]) > GROUP_WORDS or len(texts[i]) > 2 * len(texts[group[0]])):
            _search(texts, group, out)
            group, words = [], 0
        group.append(i)
        words += len(texts[i])
    if group:
        _search(texts, group, out)
    return out


def _search(texts: list[list[str]], group: list[int], out: list[list[Run]]) -> None:
    names: dict[str, int] = {}
    symbols: list[int] = []
    at = []
    for k, i in enumerate(group):
        at.append(len(symbols))
        symbols.extend([names.setdefault(w, len(names)) for w in texts[i]])
        symbols.append(-1 - k)
    starts = np.array(at)
    for start, length, q in find_all(np.array(symbols, np.int64), len(texts[group[-1]])):
        if length >= max(LEAST_WORDS, REPEATS * q):
            k = int(np.searchsorted(starts, start, "right")) - 1
            out[group[k]].append((start - at[k], length, q))
    for i in group:
        out[i].sort(key=lambda r: (r[0], r[2]))


def kept_words(words: list[str], runs: list[Run]) -> list[str]:
    """The words without what each run repeats of its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        change[start + q] += 1
        change[start + length] -= 1
    return [w for w, n in zip(words, np.cumsum(change).tolist()) if not n]


def most_repeated(runs: list[Run]) -> Run | None:
    """The run with the most repetitions; of equals the first, then the one
    with the smaller period."""
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


def plant_run(words: list[str], doc_id) -> list[str]:
    """The words with a periodic end, for one document in ten by its id: from a
    place that the id's crc32 names on, the same words again and again."""
    h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


def _grouped(batches: Iterable[pa.RecordBatch], planted: bool) -> Iterator[tuple[list, list[list[str]], list[list[Run]]]]:
    """Ids, words and runs of a number of texts at a time."""
    for b in batches:
        ids, texts, words = [], [], 0
        for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
            w = WORD.findall(text.as_py() or "")
            ids.append(doc_id)
            texts.append(plant_run(w, doc_id) if planted else w)
            words += len(w)
            if words > 4 * GROUP_WORDS:
                yield ids, texts, runs_of(texts)
                ids, texts, words = [], [], 0
        if ids:
            yield ids, texts, runs_of(texts)


def _searched(docs: DataFrame, columns: str, make: Callable, planted: bool = False) -> DataFrame:
    """One output row for each that ``make(doc_id, words, runs)`` yields."""
    kind = docs.select("doc_id").schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, {columns}"
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches):
        for ids, texts, runs in _grouped(batches, planted):
            rows = [row for x in zip(ids, texts, runs) for row in make(*x)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, ddl)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, start, length, period`` of every run of every text, in words
    counted from 0."""
    return _searched(docs, "start long, length long, period long", lambda i, words, runs: ((i, *r) for r in runs))


def collapse_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: of each run its first period only, words joined by one
    space."""
    return _searched(docs, "text string", lambda i, words, runs: [(i, " ".join(kept_words(words, runs)))])


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def run_digests(docs: DataFrame) -> DataFrame:
    """One row for each document, its words changed by :func:`plant_run`: the
    number of runs, the one that repeats most, and the digests of all runs and
    of the words that are left when runs are collapsed."""
    def make(doc_id, words, runs):
        start, length, q = most_repeated(runs) or (None, None, None)
        listed = "".join([f"{s},{n},{p}\n" for s, n, p in runs])
        yield (doc_id, len(runs), start, length, q, 1000 * length // q if runs else None,
               _sha256(listed), _sha256(" ".join(kept_words(words, runs))))

    return _searched(docs, "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string",
                     make, planted=True)


__all__ = ["collapse_runs", "find_all", "kept_words", "most_repeated", "periodic_runs", "plant_run", "run_digests", "runs_of"]
