"""Removal of long passages that occurred in an earlier document.

A *window* is 50 consecutive words of one document.  A word goes if a window that
covers it also starts in a document with a smaller ``doc_id``; windows are judged
on the input, so what is removed elsewhere makes no difference.

The reference of a document is all documents before it, too much for one suffix
automaton, so the reference is dealt to shards such that a window and all windows
equal to it meet in one.  A window's *anchor* is the smallest hash of the 12-word
grams in it; consecutive windows with one anchor form a *piece* of the text, and an
anchor's pieces are a shard.  In a shard the pieces stream, by ascending
``doc_id``, past the suffix automaton of the pieces of smaller ids: where the
matching statistics reach 50 words, the window ending there is repeated.  The piece
then extends the automaton.  Nothing is compared across shards.

* Anchors of one document only (most of them) are left out beforehand by a bitmap
  of fixed size, the only thing that is broadcast.  Its errors cost time only.
* Equal pieces are one piece, that of the smallest id; the others are repeated
  throughout.  The copies of a passage, however many, so meet in the map-side part
  of one aggregation.
* An anchor with more than 512 different pieces (the text around a very common
  passage) is a shard too large for one task.  Its windows become pieces of their
  own, each a shard by its digest, aggregated map-side like all equal pieces.
  Which anchors are dealt so changes the cost, not the result.

Nulls, empty texts and texts of under 50 words lose nothing.  A row with a null
``doc_id`` is neither before nor after another, it loses nothing and nothing is
lost to it.  Rows with one ``doc_id`` aren't compared with each other; equal rows
give equal rows.  Other columns are not read; an empty table gives no rows."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.kernels import CASED, mix, text_groups, word_hashes
from starloom.llm.steps import marked_among, settle

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Words of a window, of a gram; windows of a piece and pieces of a shard at most.
WINDOW, GRAM = 50, 12
PIECE_WINDOWS, SHARD_PIECES = 64, 512
#: Bits of the bitmap of anchors: 8 MiB, whatever the input.
ANCHOR_BITS = 1 << 26

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class SuffixAutomaton:
    """The suffix automaton of a growing set of word sequences."""

    def __init__(self):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, arcs: dict[str, int], link: int) -> int:
        self.next.append(arcs)
        self.length.append(length)
        self.link.append(link)
        return len(self.link) - 1

    def _target(self, state: int, word: str) -> int:
        """Where ``word`` leads from ``state``, as a state whose longest sequence
        is one word longer (split off the present one if need be)."""
        to = self.next[state][word]
        if self.length[to] == self.length[state] + 1:
            return to
        part = self._state(self.length[state] + 1, dict(self.next[to]), self.link[to])
        self.link[to] = part
        while state >= 0 and self.next[state].get(word) == to:
            self.next[state][word] = part
            state = self.link[state]
        return part

    def add(self, words: list[str]) -> None:
        at = 0
        for w in words:
            if w in self.next[at]:
                at = self._target(at, w)
                continue
            new, back = self._state(self.length[at] + 1, {}, 0), at
            while back >= 0 and w not in self.next[back]:
                self.next[back][w] = new
                back = self.link[back]
            if back >= 0:
                self.link[new] = self._target(back, w)
            at = new

    def matches(self, words: list[str], least: int) -> list[int]:
        """Starts of the stretches of ``least`` words that occur in a sequence."""
        arcs, link, length = self.next, self.link, self.length
        state, n, out = 0, 0, []
        for i, w in enumerate(words):
            to = arcs[state].get(w)
            while to is None and state:
                state = link[state]
                n = length[state]
                to = arcs[state].get(w)
            if to is None:
                n = 0
                continue
            state, n = to, n + 1
            if n >= least:
                out.append(i + 1 - least)
        return out


def _ahead(x: np.ndarray, k: int) -> np.ndarray:
    out = np.full(len(x), np.uint64(0xFFFFFFFFFFFFFFFF))
    out[:max(0, len(x) - k)] = x[k:]
    return out


def _anchors(h: np.ndarray) -> np.ndarray:
    """The anchor of the window that starts at each word (of no use where the
    text has no 50 words from there on)."""
    two = mix(h * _A + _ahead(h, 1) * _B)
    four = mix(two * _A + _ahead(two, 2) * _B)
    eight = mix(four * _A + _ahead(four, 4) * _B)
    least, width, grams = mix(eight * _A + _ahead(four, 8) * _B), 1, WINDOW - GRAM + 1
    while 2 * width <= grams:
        least = np.minimum(least, _ahead(least, width))
        width *= 2
    return np.minimum(least, _ahead(least, grams - width))


def _pieces(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each text that has a window: its number, and its pieces' anchors,
    first windows and numbers of windows."""
    for first_text, n, raw, at in text_groups(texts):
        h, first, _, _ = word_hashes(raw, at, values=CASED)
        if not len(h):
            continue
        anchors = _anchors(h)
        for i in np.flatnonzero(np.diff(first) >= WINDOW).tolist():
            a = anchors[first[i]:first[i + 1] - WINDOW + 1]
            starts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
            windows = np.diff(np.append(starts, len(a)))
            if windows.max() > PIECE_WINDOWS:
                parts = -(-windows // PIECE_WINDOWS)
                nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
                starts = np.repeat(starts, parts) + nth * PIECE_WINDOWS
                windows = np.minimum(PIECE_WINDOWS, np.repeat(windows, parts) - nth * PIECE_WINDOWS)
            yield first_text + i, a[starts].view(np.int64), starts, windows


def _shared_anchors(docs: DataFrame) -> np.ndarray:
    """A bitmap of (among others) the anchors that several documents have."""
    def run(batches):
        for b in batches:
            rows = [(i, a) for i, a, _, _ in _pieces(b.column("text"))]
            if rows:
                which = np.repeat([i for i, _ in rows], [len(a) for _, a in rows])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([a for _, a in rows])), b.column("doc_id").take(pa.array(which))],
                                                 ["anchor", "doc_id"])

    kind = dict(docs.dtypes)["doc_id"]
    shared = (docs.mapInArrow(run, f"anchor long, doc_id {kind}").groupBy("anchor")
              .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high"))
    place = F.pmod("anchor", F.lit(ANCHOR_BITS))
    words = (shared.select(F.shiftright(place, 6).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(pmod(anchor, {ANCHOR_BITS}) & 63 as int))").alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow())
    bitmap = np.zeros(ANCHOR_BITS // 64, np.uint64)
    bitmap[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return bitmap


def _shared_pieces(docs: DataFrame) -> DataFrame:
    """``doc_id, text_md5, start, windows, anchor, piece`` of the pieces whose
    anchor may occur in several documents."""
    bitmap = docs.sparkSession.sparkContext.broadcast(_shared_anchors(docs))

    def run(batches):
        for b in batches:
            known, texts = bitmap.value, b.column("text")
            which, columns = [], ([], [], [], [])
            for i, anchors, starts, windows in _pieces(texts):
                place = anchors.view(np.uint64) % np.uint64(ANCHOR_BITS)
                marked = np.flatnonzero(known[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1))
                if not len(marked):
                    continue
                words = WORD.findall(texts[i].as_py())
                for s, n, a in zip(starts[marked].tolist(), windows[marked].tolist(), anchors[marked].tolist()):
                    which.append(i)
                    for column, value in zip(columns, (s, n, a, " ".join(words[s:s + n + WINDOW - 1]))):
                        column.append(value)
            if which:
                start, windows, anchor, piece = (pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.string())))
                row = pa.array(which)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(row), b.column("text_md5").take(row), start, windows, anchor, piece],
                                                 ["doc_id", "text_md5", "start", "windows", "anchor", "piece"])

    kind = dict(docs.dtypes)["doc_id"]
    found = docs.mapInArrow(run, f"doc_id {kind}, text_md5 string, start long, windows int, anchor long, piece string")
    out = settle(found.withColumn("piece_md5", F.md5("piece")))
    bitmap.destroy()
    return out


def _shards(batches: Iterable[pa.RecordBatch]) -> Iterator[list[dict]]:
    rows: list[dict] = []
    for b in batches:
        for row in b.to_pylist():
            if rows and row["anchor"] != rows[0]["anchor"]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def _stream_shard(rows: list[dict]) -> Iterator[tuple[str, int, list[int]]]:
    """Digest, first document and repeated windows of each piece of a shard
    (rows by ascending ``doc_id``)."""
    automaton, waiting = SuffixAutomaton(), []
    for k, row in enumerate(rows):
        words = row["piece"].split(" ")
        if waiting and waiting[0][0] != row["first_doc"]:
            for _, earlier in waiting:
                automaton.add(earlier)
            waiting = []
        yield row["piece_md5"], row["first_doc"], automaton.matches(words, WINDOW)
        waiting.append((row["first_doc"], words))


def _by_automata(pieces: DataFrame) -> DataFrame:
    """Of pieces whose anchors are shards of bounded size."""
    schema = pa.schema([("piece_md5", pa.string()), ("first_doc", _arrow(pieces, "first_doc")), ("repeated", pa.list_(pa.int32()))])

    def run(batches):
        out: list[tuple] = []
        for rows in _shards(batches):
            out.extend(_stream_shard(rows))
            if len(out) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    kind = dict(pieces.dtypes)["first_doc"]
    return (pieces.select("anchor", "first_doc", "piece", "piece_md5").repartition("anchor").sortWithinPartitions("anchor", "first_doc")
            .mapInArrow(run, f"piece_md5 string, first_doc {kind}, repeated array<int>"))


def _by_windows(pieces: DataFrame) -> DataFrame:
    """Of pieces whose anchors are too common: each window is a shard."""
    schema = pa.schema([("piece_md5", pa.string()), ("first_doc", _arrow(pieces, "first_doc")), ("at", pa.int32()), ("window", pa.binary())])

    def run(batches):
        for b in batches:
            rows = []
            for row in b.to_pylist():
                words = row["piece"].split(" ")
                rows.extend((row["piece_md5"], row["first_doc"], i, hashlib.md5(" ".join(words[i:i + WINDOW]).encode()).digest())
                            for i in range(len(words) - WINDOW + 1))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    kind = dict(pieces.dtypes)["first_doc"]
    windows = settle(pieces.select("first_doc", "piece", "piece_md5").mapInArrow(run, f"piece_md5 string, first_doc {kind}, at int, window binary"))
    firsts = windows.groupBy("window").agg(F.min("first_doc").alias("earliest"), F.max("first_doc").alias("latest")).where("earliest < latest")
    again = windows.join(firsts, "window").where("earliest < first_doc").groupBy("piece_md5").agg(F.collect_set("at").alias("repeated"))
    return pieces.select("piece_md5", "first_doc").join(again, "piece_md5", "left").select("piece_md5", "first_doc", "repeated")


def _arrow(rows: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema[column].dataType)


def _judged(docs: DataFrame) -> DataFrame:
    """``doc_id, text_md5, spans``: for each different row with repeated windows
    the first and last-plus-one words of these, as an unordered set."""
    pieces = _shared_pieces(docs)
    different = pieces.groupBy("anchor", "piece", "piece_md5").agg(F.min("doc_id").alias("first_doc"))
    common = (pieces.select("anchor", "piece_md5").distinct().groupBy("anchor").count().where(F.col("count") > SHARD_PIECES))
    different = settle(marked_among(different, common, "anchor", "common"))
    judged = settle(_by_automata(different.where("not common")).unionByName(_by_windows(different.where("common"))))
    judged = judged.select(F.col("piece_md5").alias("p"), "first_doc", "repeated")
    rows = pieces.select("doc_id", "text_md5", "start", "windows", "piece_md5").join(judged, F.col("piece_md5") == F.col("p"))
    whole = F.array(F.struct(F.col("start").alias("first"), (F.col("start") + F.col("windows") + WINDOW - 1).alias("end")))
    some = F.transform("repeated", lambda at: F.struct((F.col("start") + at).alias("first"), (F.col("start") + at + WINDOW).alias("end")))
    spans = rows.select("doc_id", "text_md5", F.when(F.col("doc_id") > F.col("first_doc"), whole).otherwise(some).alias("spans"))
    return (spans.where(F.size("spans") > 0).select("doc_id", "text_md5", F.explode("spans").alias("span"))
            .groupBy("doc_id", "text_md5").agg(F.collect_set("span").alias("spans")))


def _with_spans(docs: DataFrame, columns: str, make) -> DataFrame:
    """One row ``doc_id, *make(words, removed)`` for each document, where
    ``removed`` marks the words that go."""
    docs = docs.select("doc_id", F.col("text").cast("string"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_md5"))
    judged = _judged(docs.where("doc_id is not null and text is not null"))
    kind = dict(docs.dtypes)["doc_id"]
    ddl = f"doc_id {kind}, {columns}"
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches):
        for b in batches:
            rows = []
            for doc_id, text, spans in zip(b.column("doc_id").to_pylist(), b.column("text"), b.column("spans")):
                words = WORD.findall(text.as_py() or "")
                change = np.zeros(len(words) + 1, np.int64)
                for span in spans.as_py() or ():
                    change[span["first"]] += 1
                    change[span["end"]] -= 1
                rows.append((doc_id, *make(words, np.cumsum(change)[:-1] > 0)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return docs.join(judged, ["doc_id", "text_md5"], "left").select("doc_id", "text", "spans").mapInArrow(run, ddl)


def _kept(words: list[str], removed: np.ndarray) -> str:
    return " ".join([w for w, gone in zip(words, removed.tolist()) if not gone] if removed.any() else words)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, text, removed``: the words that stay, joined by one space, and
    the spans that went (first and last-plus-one word, maximal, in order)."""
    def make(words, removed):
        edges = np.flatnonzero(np.diff(np.concatenate([[False], removed, [False]]).astype(np.int8)))
        spans = edges.reshape(-1, 2).tolist()
        return _kept(words, removed), [{"first": a, "end": b} for a, b in spans]

    return _with_spans(docs, "text string, removed array<struct<first: long, end: long>>", make)


def repeat_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row."""
    def make(words, removed):
        return len(words), int(removed.sum()), hashlib.sha256(_kept(words, removed).encode()).hexdigest()

    return _with_spans(docs, "n_words long, n_removed long, kept_sha256 string", make)


__all__ = ["SuffixAutomaton", "remove_repeats", "repeat_digests"]
