"""License scans: winnowed fingerprints, an inverted index, banded alignment.

Templates and documents are read as words (runs of letters and digits, lower
case).  Hashes of three words in a row are winnowed: of every window of three
such hashes the smallest is kept, so any five words in a row that a document
shares with a template share a kept hash.  An inverted index of the templates'
hashes (bounded by the fixed template list) picks candidate templates and places; at each
place the template is aligned with the document's words inside a band, which
reports how much of the template is covered and where.

Licences of one family differ in a few words.  An alignment counts only if its
stretch of the document holds the family's deciding words as often as the
template, and the template's numbers at least as often.  Alignments that overlap
compete: the one with most matched words, less those missing from either side,
stays, so a stretch of text is reported once.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.kernels import shingle_hashes, text_groups, word_hashes
from starloom.llm.license_texts import DECIDING, TEMPLATES

GRAM, WINDOW = 3, 3
#: Words by which an alignment may leave the candidate's diagonal (or a tenth of
#: the template's, if that is more), and the share of a template's words that must
#: be found.
BAND, LEAST_COVERAGE = 8, 0.75

_BREAK = np.ones(256, bool)  # bytes between words: all of ASCII but letters and digits
_BREAK[128:] = False
for _c in b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _BREAK[_c] = False


def winnow(grams: np.ndarray) -> np.ndarray:
    """Places whose hash is the smallest (the last of equals) of a window."""
    n = len(grams)
    if n <= WINDOW:
        return np.flatnonzero(grams == grams.min())[-1:] if n else np.zeros(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(grams, WINDOW)[:, ::-1]
    return np.unique(np.arange(len(windows)) + WINDOW - 1 - windows.argmin(axis=1))


class TemplateIndex:
    """Words, deciding words and winnowed hashes of the templates."""

    def __init__(self, templates: dict[str, str]):
        self.names, self.words = list(templates), []
        self.numbers: list[Counter] = []
        self.deciding: list[dict[int, int]] = []
        rows = []
        for k, (name, text) in enumerate(templates.items()):
            h, first = _hashes(text)
            self.words.append(h)
            held = Counter(h.tolist())
            self.numbers.append(Counter(_hashes(" ".join(re.findall(r"(?<![A-Za-z0-9])[0-9]+(?![A-Za-z0-9])", text)))[0].tolist()))
            self.deciding.append({w: held[w] for family, words in DECIDING.items() if family in name for w in _hashes(" ".join(words))[0].tolist()})
            grams, _ = shingle_hashes(h, first, GRAM)
            rows += [(grams[i], k, i) for i in winnow(grams).tolist()]
        rows.sort()
        self.hashes = np.array([r[0] for r in rows], np.uint64)
        self.template, self.place = (np.array([r[i] for r in rows], np.int64) for i in (1, 2))

    def candidates(self, grams: np.ndarray) -> list[tuple[int, int]]:
        """(template, word where it would begin) for groups of hits that lie
        within a band of each other."""
        at = winnow(grams)
        lo, hi = np.searchsorted(self.hashes, grams[at]), np.searchsorted(self.hashes, grams[at], "right")
        hits = sorted((int(self.template[r]), int(p - self.place[r])) for p, a, b in zip(at, lo, hi) for r in range(a, b))
        out: list[tuple[int, int]] = []
        for t, start in hits:
            if not out or out[-1][0] != t or start - out[-1][1] > BAND:
                out.append((t, start))
        return out

    def agrees(self, t: int, stretch: np.ndarray) -> bool:
        """Whether the words of a stretch leave no doubt about the family's member."""
        held = Counter(stretch.tolist())
        return all(held[w] == n for w, n in self.deciding[t].items()) and all(held[w] >= n for w, n in self.numbers[t].items())


def _hashes(text: str) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(text.encode(), np.uint8)
    return word_hashes(raw, np.array([0, len(raw)]), _BREAK)[:2]


def apart(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Of alignments ``(score, template, first word, last word)`` those that
    overlap none with a better score (ties: the earlier one, then the earlier
    template), by place."""
    kept: list[tuple[int, int, int, int]] = []
    for x in sorted(found, key=lambda x: (-x[0], x[2], x[1])):
        i = bisect(kept, x[2], key=lambda y: y[2])
        if (i == 0 or kept[i - 1][3] < x[2]) and (i == len(kept) or kept[i][2] > x[3]):
            kept.insert(i, x)
    return kept


def align(template: np.ndarray, words: np.ndarray, start: int) -> tuple[int, int, int]:
    """Most template words found in order among the document's words, leaving
    the diagonal of ``start`` by the band at most; and the first and last
    document word of them (the first such alignment)."""
    band = max(BAND, len(template) // 10)
    width = 2 * band + 1
    # per place in the band: matches, first and last matched word so far
    best = [(0, -1, -1)] * (width + 1)
    n = len(words)
    for i, w in enumerate(template):
        row, left = [], (0, -1, -1)
        for b in range(width):
            j = start + i - band + b
            up, diagonal = best[b + 1], best[b]
            if 0 <= j < n and words[j] == w:
                here = (diagonal[0] + 1, diagonal[1] if diagonal[0] else j, j)
                if up[0] >= here[0]:
                    here = up
            else:
                here = up if up[0] >= diagonal[0] else diagonal
            if left[0] >= here[0]:
                here = left
            row.append(here)
            left = here
        best = [*row, (0, -1, -1)]
    return max(best, key=lambda x: x[0])


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """``doc_id, license, template, template_words, matched_words, coverage,
    start, end``: one row for each place of ``docs(doc_id, text)`` where a template
    is covered to three quarters at least, its deciding words and numbers agree,
    and no overlapping alignment is better.  ``license`` is the first word of the
    template's name.  Offsets count code points, ends are exclusive.

    Null and empty texts have no row; repeated rows repeat theirs; a null
    ``doc_id`` is kept; other columns are not read; an empty table gives no rows."""
    templates = dict(templates or TEMPLATES)

    def run(batches):
        index = TemplateIndex(templates)
        for b in batches:
            doc, rows = [], []
            for first_text, n, raw, at in text_groups(b.column("text")):
                h, first, starts, stops = word_hashes(raw, at, _BREAK)
                grams, place = shingle_hashes(h, first, GRAM)
                known = np.isin(grams, index.hashes)
                texts = np.searchsorted(place, np.flatnonzero(known), "right") - 1
                for i in np.unique(texts).tolist():
                    words, w0 = h[first[i]:first[i + 1]], first[i]
                    found: dict[tuple, int] = {}
                    for t, start in index.candidates(grams[place[i]:place[i + 1]]):
                        size = len(index.words[t])
                        matched, lo, hi = align(index.words[t], words, start)
                        if matched >= LEAST_COVERAGE * size and index.agrees(t, words[lo:hi + 1]):
                            found[matched - (size - matched) - (hi + 1 - lo - matched), t, lo, hi] = matched
                    for x in apart(list(found)):
                        _, t, lo, hi = x
                        a, z = (len(raw[at[i]:y].tobytes().decode()) for y in (starts[w0 + lo], stops[w0 + hi]))
                        size = len(index.words[t])
                        doc.append(first_text + i)
                        rows.append((index.names[t].split()[0], index.names[t], size, found[x], found[x] / size, a, z))
            license, name, size, matched, coverage, a, z = map(list, zip(*rows)) if rows else ([], [], [], [], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(doc, pa.int64())), pa.array(license, pa.string()), pa.array(name, pa.string()), pa.array(size, pa.int64()),
                 pa.array(matched, pa.int64()), pa.array(coverage, pa.float64()), pa.array(a, pa.int64()), pa.array(z, pa.int64())],
                ["doc_id", "license", "template", "template_words", "matched_words", "coverage", "start", "end"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        run, f"doc_id {kind}, license string, template string, template_words long, matched_words long, coverage double, start long, end long")
