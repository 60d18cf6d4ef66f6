"""Toxicity by noisy-channel deobfuscation.

Disguised words (digits and signs for letters, letters set apart, letters
repeated) are read as lattices of what each character may stand for; Viterbi
decoding under a character language model, counted over all documents, restores
the likeliest word.  The restored text is scored by its words and word beginnings:
each has a weight learnt from labelled rows, the lower confidence bound of
the log ratio of its frequency in toxic and other documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.steps import holds

#: Labelled rows that the weights are fitted on at most (the first by a hash of
#: their id).  Everything else covers all rows.
FIT_ROWS = 16_000
#: A feature needs so many toxic documents, and such a weight, to be kept.
LEAST_DOCS, LEAST_WEIGHT = 4, 1.5

#: Chunks whose weight a Python worker remembers, in each of two generations.
CACHE_CHUNKS = 120_000

# The alphabet of the character model (0 is the word boundary,
# the last symbol any other character).
LETTERS = "abcdefghijklmnopqrstuvwxyz" "äöüßàâáãçéèêëíîïñóôõúùûœæ"
SYMBOLS = len(LETTERS) + 2
# What a character may stand for in a disguised word.
STANDS_FOR = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
              "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "*": "aeiou", "#": "aeiou"}
# Log probabilities of the channel: a letter replaced, a sign slipped in,
# a character left as it is though it is no letter, a letter repeated.
REPLACED, SLIPPED, LITERAL, REPEATED = math.log(0.1), math.log(0.05), math.log(0.001), math.log(0.2)

#: Between two letters set apart a word may end.
_BOUNDARY = [("", 0.0), (" ", 0.0)]

_CODE = {c: i + 1 for i, c in enumerate(LETTERS)}
_ENDS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»„“”‘’…–—¡¿"
#: Signs that stand for no letter.
_SILENT = "".join(c for c in _ENDS if c not in STANDS_FOR)
_REPEATS = re.compile(r"([^\W\d_])\1\1+")
_APART = f"[{re.escape(LETTERS + ''.join(STANDS_FOR))}]"
_SPACED = re.compile(rf"(?<!\S){_APART}(?:\s+{_APART}){{2,}}(?!\S)")
_LETTER = re.compile(r"[^\W\d_]")
_JOINS = re.compile(r"[-/\\._–—]+")
#: Letters of the longest word whose reading is remembered.
_REMEMBERED = 64


# -- the character model -----------------------------------------------------

def _code_table() -> np.ndarray:
    """Symbol of each code point below U+0180, upper case as lower."""
    table = np.full(0x180, SYMBOLS - 1, np.int64)
    table[[9, 10, 11, 12, 13, 32]] = 0
    for c, i in _CODE.items():
        for x in (c, c.upper()):
            if len(x) == 1 and ord(x) < 0x180:
                table[ord(x)] = i
    return table


def character_model(docs: DataFrame) -> np.ndarray:
    """Log probabilities of a symbol after two others, from the counts of all
    documents: trigram, bigram and unigram frequencies interpolated.  Of fixed
    size (SYMBOLS**3), whatever the corpus."""

    def run(batches):
        holds("toxicity")
        table, total = _code_table(), np.zeros(SYMBOLS ** 3, np.int64)
        for b in batches:
            for text in b.column("text"):
                points = np.frombuffer((" " + (text.as_py() or "") + " ").encode("utf-32-le"), np.uint32)
                s = table[np.minimum(points, 0x17F)]
                s = np.where(points < 0x180, s, SYMBOLS - 1)
                at = (s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:]
                if len(at) > 20_000:
                    total += np.bincount(at, minlength=len(total))
                else:
                    np.add.at(total, at, 1)
        at = np.flatnonzero(total)
        for i in range(0, len(at), 65_536):
            part = at[i:i + 65_536]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], ["gram", "n"])

    counted = docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    three = np.zeros(SYMBOLS ** 3)
    three[counted["gram"].to_numpy()] = counted["n"].to_numpy()
    three = three.reshape((SYMBOLS,) * 3)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p = (one + 1) / (one.sum() + SYMBOLS)
    p = (two + 50 * p) / (two.sum(axis=1, keepdims=True) + 50)
    return np.log((three + 10 * p[None]) / (three.sum(axis=2, keepdims=True) + 10)).astype(np.float32)


# -- restoring words ---------------------------------------------------------

@lru_cache(maxsize=4096)
def _choices(c: str) -> list[tuple[str, float]]:
    """What a character that is no letter of the alphabet may stand for."""
    stands = STANDS_FOR.get(c, "")
    choices = [(x, REPLACED - math.log(len(stands))) for x in stands] + [(c, LITERAL)]
    return choices if c.isdigit() else [*choices, ("", SLIPPED)]


def lattice(word: str) -> list[list[tuple[str, float]]]:
    """For each place (a repeated letter is one place) what it may stand for."""
    out: list[list[tuple[str, float]]] = []
    i = 0
    while i < len(word):
        c, n = word[i], 1
        while i + n < len(word) and word[i + n] == c:
            n += 1
        if c in _CODE:
            if n >= 3:
                out.append([(c, REPEATED), (c + c, REPEATED)])
            else:
                out += [[(c, 0.0)]] * n
        else:
            out += [_choices(c)] * min(n, 2)
        i += n
    return out


def restore(word: str, model: np.ndarray, spaced: bool = False) -> str:
    """The likeliest reading of a disguised word (lower case): Viterbi search
    over its lattice, states being the last two symbols read.  A state keeps its
    reading as a chain, so time and memory grow with the word's length.  If
    ``spaced``, a new word may begin at each place."""
    places = lattice(word)
    if spaced:
        # a letter repeated may end one word and begin the next
        places = [p + [(f"{c}{x}", REPEATED) for c in (p[0][0],) for x in (f" {c}", f"{c} {c}", f" {c}{c}")] if p[0][1] == REPEATED else p for p in places]
        places = [p for place in places for p in (_BOUNDARY, place)][1:]
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    other = SYMBOLS - 1
    for choices in [*places, [(" ", 0.0)]]:
        following: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (score, read) in states.items():
            for letters, channel in choices:
                x, y, total = a, b, score + channel
                for c in letters:
                    s = 0 if c == " " else _CODE.get(c, other)
                    total += float(model[x, y, s])
                    x, y = y, s
                if (x, y) not in following or total > following[x, y][0]:
                    following[x, y] = (total, (read, letters) if letters else read)
        states = following
    best = max(score for score, _ in states.values())
    return max(_written(read) for score, read in states.values() if score == best).strip()


def _written(read: tuple | None) -> str:
    out = []
    while read is not None:
        read, letters = read
        out.append(letters)
    return "".join(reversed(out))


def disguised(word: str) -> bool:
    """Whether a word (without signs at its ends) is worth decoding: it has
    letters beside other signs or repeated, or only signs that stand for letters."""
    if not _LETTER.search(word):
        return word != "" and all(c in STANDS_FOR for c in word)
    return not word.isalpha() or _REPEATS.search(word) is not None


# -- features and weights ----------------------------------------------------

def features(word: str) -> list[str]:
    """The word and its beginnings of 3 to 6 letters."""
    return ["=" + word, *(word[:k] for k in range(3, 7) if len(word) > k)]


class Reader:
    """Restored words of texts, remembered word by word."""

    def __init__(self, model: np.ndarray):
        known = lru_cache(maxsize=50_000)(lambda w, spaced: restore(w, model, spaced))
        self.restore = lambda w, spaced=False: known(w, spaced) if len(w) <= _REMEMBERED else restore(w, model, spaced)

    def words(self, chunk: str) -> list[str]:
        """A chunk between spaces as the words it may be read as: as a whole, and
        by its parts between joining signs."""
        out = self._readings(chunk)
        parts = _JOINS.split(chunk)
        if len(parts) > 1:
            out += [w for p in dict.fromkeys(parts) for w in self._readings(p) if w not in out]
        return out

    def _readings(self, chunk: str) -> list[str]:
        word = chunk.strip(_ENDS)
        out = [word] if word else []
        if not _LETTER.search(word):
            word = chunk.strip(_SILENT)
        if disguised(word) and (read := self.restore(word)) not in out:
            out.append(read)
        return out

    def spaced(self, low: str) -> list[str]:
        """Words written with their letters set apart: each run as one word, and
        as the words it is likeliest made of."""
        out = []
        for m in _SPACED.finditer(low):
            run = "".join(m.group().split())
            out += dict.fromkeys([self.restore(run), *self.restore(run, True).split()])
        return out


class Scorer(NamedTuple):
    """Weights of features and the coefficients of the final logistic curve."""

    weights: dict[str, float]
    curve: tuple[float, float, float] = (-3.0, 1.0, 0.5)

    def word(self, word: str) -> float:
        get = self.weights.get
        return max((get(f, 0.0) for f in features(word)), default=0.0)

    def probability(self, evidence: tuple[float, float]) -> float:
        x = self.curve[0] + self.curve[1] * evidence[0] + self.curve[2] * evidence[1]
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


class TextScorer:
    """Evidence of whole texts: their strongest word, and the sum of the three
    strongest."""

    def __init__(self, scorer: Scorer, model: np.ndarray):
        self.scorer, self.reader, self.known, self.older = scorer, Reader(model), {}, {}

    def _chunk(self, chunk: str) -> float:
        value = self.older.get(chunk)
        if value is None:
            value = max((self.scorer.word(w) for w in self.reader.words(chunk)), default=0.0)
        if len(self.known) >= CACHE_CHUNKS:
            self.known, self.older = {}, self.known
        self.known[chunk] = value
        return value

    def evidence(self, text: str) -> tuple[float, float]:
        low, known = text.lower(), self.known
        found = set()
        for chunk in low.split():
            w = known.get(chunk)
            if w is None:
                w = self._chunk(chunk)
                known = self.known
            if w:
                found.add(w)
        found.update(self.scorer.word(w) for w in self.reader.spaced(low))
        top = sorted(found, reverse=True)[:3]
        return (top[0] if top else 0.0, float(sum(top)))


def _fit_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text, toxic, fold`` of the labelled rows that may be learnt from."""
    sample = (labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).where("doc_id is not null and toxic in (0, 1)")
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 0)
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS))
    return (docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(sample), "doc_id")
            .select("text", "toxic", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).cast("int").alias("fold")))


def _weights(n1, n0, all1: int, all0: int) -> np.ndarray:
    ratio = np.log((n1 + 0.5) / (all1 + 1)) - np.log((n0 + 0.5) / (all0 + 1))
    return ratio - np.sqrt(1 / (n1 + 0.5) + 1 / (n0 + 0.5)) * 0.75


def fit(docs: DataFrame, labels: DataFrame, model: np.ndarray) -> Scorer:
    """Weights from all fit rows, and the curve from evidence that each half of
    them gets from weights of the other half."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    rows = _fit_rows(docs, labels).checkpoint()

    def count(batches):
        holds("toxicity")
        reader, n = Reader(shared.value), Counter()
        for b in batches:
            for text, toxic, fold in zip(*(b.column(c).to_pylist() for c in ("text", "toxic", "fold"))):
                low = (text or "").lower()
                own = {f for chunk in set(low.split()) for w in reader.words(chunk) for f in features(w)}
                own.update(f for w in reader.spaced(low) for f in features(w))
                n.update((f, toxic, fold) for f in own)
        items = list(n.items())
        for i in range(0, len(items), 50_000):
            part = items[i:i + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k, _ in part]), *(pa.array([k[j] for k, _ in part], pa.int32()) for j in (1, 2)), pa.array([v for _, v in part], pa.int64())],
                ["feature", "toxic", "fold", "n"])

    totals = {(r.toxic, r.fold): r["n"] for r in rows.groupBy("toxic", "fold").agg(F.count("*").alias("n")).collect()}
    n = lambda toxic, fold: F.sum(F.when((F.col("toxic") == toxic) & (F.col("fold") == fold), F.col("n")).otherwise(0)).alias(f"n{toxic}{fold}")
    counted = (rows.mapInArrow(count, "feature string, toxic int, fold int, n long").groupBy("feature")
               .agg(*[n(t, f) for t in (0, 1) for f in (0, 1)])
               .where(F.col("n10") + F.col("n11") >= LEAST_DOCS))
    # only what is more frequent in toxic documents comes to the driver
    all1, all0 = (totals.get((t, 0), 0) + totals.get((t, 1), 0) for t in (1, 0))
    counted = counted.where((F.col("n10") + F.col("n11")) * (all0 + 1) > 2 * (F.col("n00") + F.col("n01")) * (all1 + 1)).toArrow()
    names, counted = counted["feature"].to_pylist(), {c: counted[c].to_numpy().astype(float) for c in counted.column_names if c != "feature"}

    def chosen(folds: tuple[int, ...]) -> dict[str, float]:
        n1, n0 = (sum(counted[f"n{t}{f}"] for f in folds) for t in (1, 0))
        w = _weights(n1, n0, *(sum(totals.get((t, f), 0) for f in folds) for t in (1, 0)))
        keep = (w >= LEAST_WEIGHT) & (n1 >= max(2, LEAST_DOCS * len(folds) // 2))
        return dict(zip([names[i] for i in np.flatnonzero(keep)], w[keep].round(4).tolist()))

    if not all1 or not all0:
        shared.destroy()
        return Scorer({}, (-3.0 if all0 or not all1 else 3.0, 0.0, 0.0))
    halves = spark.sparkContext.broadcast([Scorer(chosen((1,))), Scorer(chosen((0,)))])

    def judge(batches):
        holds("toxicity")
        scorers = [TextScorer(s, shared.value) for s in halves.value]
        for b in batches:
            e = [scorers[f].evidence(t or "") for t, f in zip(b.column("text").to_pylist(), b.column("fold").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in e], pa.float64()), pa.array([x[1] for x in e], pa.float64()), b.column("toxic")], ["most", "sum", "toxic"])

    seen = rows.mapInArrow(judge, "most double, sum double, toxic int").toArrow()
    shared.destroy()
    halves.destroy()
    return Scorer(chosen((0, 1)), _logistic(np.column_stack([seen["most"].to_numpy(), seen["sum"].to_numpy()]), seen["toxic"].to_numpy().astype(float)))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Ridge logistic regression on two inputs, by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(3)
    penalty = np.diag([0.01, 0.1, 0.1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, w))


# -- the operator ------------------------------------------------------------

def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of
    ``docs(doc_id, text)``; ``labels(doc_id, toxic)`` marks some of them.

    Labels are learnt from rows only whose crc32(doc_id as text) mod 5 is not 0
    (``held_out`` is false); other labels, and other columns of either table, are
    not read.  Null text counts as empty and gets the score of a text without
    evidence; a null ``doc_id`` is never learnt from and its ``held_out`` is false.
    Without both kinds of labels all rows get one score."""
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    model = character_model(docs)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((fit(docs, labels, model), model))

    def run(batches):
        holds("toxicity")
        scorer = TextScorer(*shared.value)
        for b in batches:
            p = pa.array([scorer.scorer.probability(scorer.evidence(t.as_py())) for t in b.column("text")], pa.float64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), p, pc.greater_equal(p, 0.5).cast(pa.int32())], ["doc_id", "score", "predicted"])

    kind = dict(docs.dtypes)["doc_id"]
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
    return (docs.mapInArrow(run, f"doc_id {kind}, score double, predicted int")
            .select("doc_id", held.alias("held_out"), "score", "predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not predicted toxic.

    A null text is scored as an empty one; repeated rows are scored each."""
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    model = character_model(texts)
    shared = docs.sparkSession.sparkContext.broadcast((fit(texts, labels, model), model))

    def run(batches):
        holds("toxicity")
        scorer = TextScorer(*shared.value)
        for b in batches:
            yield b.filter(pa.array([scorer.scorer.probability(scorer.evidence(t.as_py() or "")) < 0.5 for t in b.column("text")], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
