"""Token counts by a counting transducer over chunks.

The tokenizer's merge automaton (:mod:`starloom.llm.bpe`) is read as a
deterministic transducer: a transition adds one to the count of the place it
starts from, and no token is written.  Every text is cut into chunks of equal
length.  What a chunk does to the transducer's state is a *state map*: wherever
white space follows a printable ASCII character every split rule ends, so the
transducer is back in its start state whatever came before.  A chunk with such
reset points maps every entry state to (what is read up to the first one, a fixed
count, what is left open after the last one); a chunk without any only lengthens
the open word.  Maps compose associatively, so the chunks of a text are combined
by a balanced scan instead of from left to right; the fixed counts of all chunks
of many texts, and the seams of each round, go through the transducer together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.bpe import BpeCodec, codec

#: Characters of a chunk.
CHUNK_CHARS = 8192
#: Characters of texts that are scanned together.
GROUP_CHARS = 1_000_000

_RESET = re.compile(r"(?<=[!-~])(?=[ \t\n])")


class StateMap(NamedTuple):
    """``head`` is read from the entry state; then, unless the map is open,
    ``count`` tokens follow and ``tail`` is left to be read from the start."""

    head: str
    count: int = 0
    tail: str = ""
    reset: bool = False


def parts(text: str) -> tuple[str, str | None, str]:
    """A chunk up to its first reset point, from there to the last one (None if
    there is none), and from there on."""
    first = _RESET.search(text)
    if first is None:
        return text, None, ""
    # the last reset point, looked for from the end
    last, at = first.start(), len(text)
    while at > first.start():
        at = max(text.rfind(" ", 1, at), text.rfind("\n", 1, at), text.rfind("\t", 1, at))
        if at <= first.start():
            break
        if "!" <= text[at - 1] <= "~":
            last = at
            break
    return text[:first.start()], text[first.start():last], text[last:]


def chunk_maps(chunks: list[str], c: BpeCodec) -> list[StateMap]:
    cut = [parts(x) for x in chunks]
    counts = c.count_all([fixed or "" for _, fixed, _ in cut])
    return [StateMap(head, n, tail, fixed is not None) for (head, fixed, tail), n in zip(cut, counts)]


def compose(pairs: list[tuple[StateMap, StateMap]], c: BpeCodec) -> list[StateMap]:
    """For each pair first the one, then the other."""
    seams = iter([*c.count_all([a.tail + b.head for a, b in pairs if a.reset and b.reset])])
    out = []
    for a, b in pairs:
        if not a.reset:
            out.append(b._replace(head=a.head + b.head))
        elif not b.reset:
            out.append(a._replace(tail=a.tail + b.head))
        else:
            out.append(StateMap(a.head, a.count + next(seams) + b.count, b.tail, True))
    return out


def count_texts(texts: list[str], c: BpeCodec, chunk: int = CHUNK_CHARS) -> list[int]:
    """Number of tokens of each text: the composition of its chunks' maps, in
    log2(n) rounds of neighbours, applied to the start state."""
    chunks = [[t[i:i + chunk] for i in range(0, len(t), chunk)] or [""] for t in texts]
    maps = iter(chunk_maps([x for own in chunks for x in own], c))
    scans = [[next(maps) for _ in own] for own in chunks]
    while any(len(own) > 1 for own in scans):
        joined = iter(compose([(own[i], own[i + 1]) for own in scans for i in range(0, len(own) - 1, 2)], c))
        scans = [[next(joined) if i + 1 < len(own) else own[i] for i in range(0, len(own), 2)] for own in scans]
    ends = [own[0] for own in scans]
    open_ = c.count_all([x for m in ends for x in (m.head, m.tail)])
    return [m.count + next(open_) + next(open_) for m in ends]


def count_text(text: str, c: BpeCodec, chunk: int = CHUNK_CHARS) -> int:
    return count_texts([text], c, chunk)[0]


def _grouped(texts: pa.Array) -> Iterator[list[str]]:
    group, size = [], 0
    for t in texts:
        group.append(t.as_py())
        size += len(group[-1])
        if size > GROUP_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of
    ``docs(doc_id, text)``, in one pass without a shuffle.

    Null text counts as empty (0 bytes, 0 tokens, not over the limit);
    repeated rows are kept; other columns are not read."""

    def run(batches):
        c = codec(tokenizer)
        for b in batches:
            texts = pc.fill_null(b.column("text"), "")
            n = pa.array([x for group in _grouped(texts) for x in count_texts(group, c)], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pc.binary_length(texts).cast(pa.int64()), n, pc.greater(n, limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
