"""Best-fit packing of tokenised documents, certified by lower bounds.

Pieces are dealt into blocks of bounded size.  Each block packs its pieces by
best-fit decreasing and compares the number of bins with a lower bound from
dual-feasible functions: if they agree, no packing of that block uses fewer.
Every block then gives up its least filled bin, and as many more as it is above
its bound; the pieces in them are exchanged (blocks are pooled a few at a time)
and packed again, until one pool is left.  A level only ever sees the bins that
the one before gave up, so no task holds more than one block.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.bpe import codec
from starloom.session import ensure_checkpoint_dir

CAPACITY = 4096
#: Pieces of a block on average, and blocks pooled at each exchange.
BLOCK_PIECES, POOL = 2048, 4


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 1) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: every document's ids, then
    ``end_id``, cut into pieces of ``capacity`` tokens if it is longer.  A null
    or empty text is the single id ``end_id``."""
    end = end_id.to_bytes(4, "little")

    def run(batches):
        c = codec(tokenizer)
        for b in batches:
            rows = []
            for i, ids in enumerate(c.encode_all(t.as_py() or "" for t in b.column("text"))):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    rows.append((i, k, at // 4, len(part) // 4, zlib.crc32(part)))
            at, piece, start, length, crc = map(list, zip(*rows)) if rows else ([], [], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and place of each length: the longest first, each into the fullest
    bin that still takes it."""
    bins, places = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room: list[tuple[int, int]] = []
    n = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        k = bisect_left(room, (size, -1))
        left, b = room.pop(k) if k < len(room) else (capacity, n)
        n += b == n
        bins[i], places[i] = b, capacity - left
        if left > size:
            insort(room, (left - size, b))
    return bins, places


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The best of the bounds that two families of dual-feasible functions give
    for the number of bins (all in whole numbers).

    Threshold k <= capacity/2: lengths above capacity-k count as a whole bin,
    those below k as nothing, the rest by length.  Rounding to k parts: a length
    x counts floor((k+1)x/capacity)/k, or x/capacity where that is exact."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1)[:capacity + 1]
    total = np.concatenate([[0], np.cumsum(count * np.arange(capacity + 1))])
    above = np.concatenate([np.cumsum(count[::-1])[::-1], [0]])
    k = np.arange(0, capacity // 2 + 1)
    big = above[capacity - k + 1]
    best = int(np.max(big + -(-(total[capacity - k + 1] - total[k]) // capacity)))
    x = np.arange(capacity + 1)
    for k in range(1, 65):
        parts = (k + 1) * x
        scaled = np.where(parts % capacity == 0, k * x, parts // capacity * capacity)  # in 1/(k*capacity)
        best = max(best, int(-(-int((count * scaled).sum()) // (k * capacity))))
    return best


def pack(pieces: DataFrame, capacity: int = CAPACITY, block_pieces: int = BLOCK_PIECES, pool: int = POOL) -> DataFrame:
    """Adds ``sequence_id long, offset long`` to ``pieces`` (which needs a
    column ``length``, from 1 to ``capacity``): pieces of one sequence lie gapless from 0.

    Rows are dealt to blocks by their place in a checkpoint, so one repeated
    key can't fill a block.  An empty input gives an empty result."""
    ensure_checkpoint_dir(pieces.sparkSession)
    columns = pieces.columns
    pieces = pieces.checkpoint()
    blocks = max(1, -(-pieces.count() // block_pieces))
    level_of = pieces.select("*", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).alias("_block"))
    schema = ", ".join(f"`{c}` {t}" for c, t in pieces.dtypes)
    done, level = None, 0
    while True:
        last, step = blocks == 1, level

        def run(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values([c for c in ("doc_id", "piece") if c in rows], kind="stable", ignore_index=True)
            lengths = rows["length"].to_numpy(np.int64)
            bins, places = best_fit_decreasing(lengths, capacity)
            block = int(rows["_block"].iloc[0])
            given = np.zeros(bins.max() + 1, bool)
            if not last:
                used = np.bincount(bins, lengths)
                gap = len(used) - lower_bound(lengths, capacity)
                fewest = np.argsort(used, kind="stable")[:2 * gap + 1]
                given[fewest[used[fewest] < capacity]] = True
            return rows.assign(sequence_id=(step << 56) + (block << 24) + bins, offset=places, _given=given[bins])

        level_df = level_of.groupBy("_block").applyInPandas(
            run, f"{schema}, _block long, sequence_id long, offset long, _given boolean").checkpoint()
        part = level_df.where(~F.col("_given")).select(*columns, "sequence_id", "offset")
        done = part if done is None else done.unionByName(part)
        if last:
            return done
        blocks, level = -(-blocks // pool), level + 1
        level_of = level_df.where("_given").select(*columns, F.floor(F.col("_block") / pool).cast("long").alias("_block"))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 1) -> DataFrame:
    """Pieces of every document with their sequence and place in it."""
    return pack(token_pieces(docs, tokenizer, capacity, end_id), capacity)
