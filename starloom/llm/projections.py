"""Embedding near-duplicates by collision-counting projections.

Vectors of one label are dealt into cells by the signs of a few random
projections, several times over with other projections (tables), so that a pair
at the threshold shares a cell of at least one table.  Inside a cell many
one-dimensional projections are sorted; around each query a window of fixed
width is laid on each of them, and vectors are counted by how many of the
query's windows they fall into.  Pairs whose count passes a threshold, chosen so
that a pair at the similarity limit passes with the wanted recall, are verified
by cosine in double precision.

Equal vectors of a label are one class with a multiplicity; cells larger than a
part are searched in pairs of parts.  Links are counted where they are found (a
pair counts in the first table that holds it), so no list of pairs is made:
tasks return a count for each vector and one edge of a spanning forest.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.components import components
from starloom.llm.kernels import runs
from starloom.session import ensure_checkpoint_dir

COSINE = 0.93
#: Share of pairs at the limit that the cells, and the count, are to keep.
CELL_RECALL, COUNT_RECALL = 0.995, 0.998
#: Sorted projections of a cell, and half a window in standard deviations of
#: the difference of two vectors at the limit.
PROJECTIONS, HALF_WINDOW = 32, 1.5
#: Vectors that a cell should hold, and of a part of a much larger one (every
#: part is sent once for each part of its cell).
CELL, PART = 1024, 4096


def tables(bits: int, cosine: float, recall: float = CELL_RECALL) -> int:
    """Tables of ``bits`` signs after which a pair at the limit has met."""
    meet = (1 - math.acos(cosine) / math.pi) ** bits
    return 1 if meet >= recall else math.ceil(math.log(1 - recall) / math.log(1 - meet))


def least_count(cosine: float, recall: float = COUNT_RECALL) -> int:
    """Largest count that a pair at the limit reaches with the wanted recall:
    each window holds it with the same probability."""
    p = math.erf(HALF_WINDOW / math.sqrt(2))
    missed = 0.0
    for count in range(PROJECTIONS + 1):
        missed += math.comb(PROJECTIONS, count) * p ** count * (1 - p) ** (PROJECTIONS - count)
        if missed > 1 - recall:
            return count
    return PROJECTIONS


@lru_cache(maxsize=8)
def directions(dim: int, table: int, n: int) -> np.ndarray:
    """Random directions: of one table's signs, or (table -1) to be sorted."""
    return np.random.default_rng([dim, table + 1, 20_240_501]).standard_normal((dim, n))


def cells(unit: np.ndarray, table: int, bits: int) -> np.ndarray:
    if not bits:
        return np.zeros(len(unit), np.int64)
    return (unit @ directions(unit.shape[1], table, 32)[:, :bits] > 0) @ (1 << np.arange(bits))


def search_cell(cls: np.ndarray, weight: np.ndarray, own: np.ndarray, raw: np.ndarray, table: int, bits: int,
                cosine: float, pair: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Links that each vector has to others of this cell (by their weights) and
    the smallest class it is joined to.  Only pairs whose parts are ``pair`` and
    that share no cell of an earlier table are looked at."""
    norm = np.sqrt((raw * raw).sum(axis=1))
    unit = raw / norm[:, None]
    earlier = np.stack([cells(unit, t, bits) for t in range(table)], axis=1) if table else np.zeros((len(cls), 0), np.int64)
    p = unit @ directions(raw.shape[1], -1, PROJECTIONS)
    half = HALF_WINDOW * math.sqrt(2 - 2 * cosine)
    order = np.argsort(p, axis=0)
    lows, highs = np.empty(p.shape, np.int64), np.empty(p.shape, np.int64)
    for j in range(PROJECTIONS):
        line = p[order[:, j], j]
        lows[:, j], highs[:, j] = np.searchsorted(line, p[:, j] - half), np.searchsorted(line, p[:, j] + half, "right")
    order = np.ascontiguousarray(order.T)
    need = least_count(cosine)
    links, root = np.zeros(len(cls), np.int64), np.arange(len(cls))
    across = pair[0] != pair[1]

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for q in np.flatnonzero(own == pair[0]):
        met = np.zeros(len(cls), np.uint8)
        for j, (lo, hi) in enumerate(zip(lows[q].tolist(), highs[q].tolist())):
            met[order[j, lo:hi]] += 1
        hit = np.flatnonzero(met >= need)
        hit = hit[own[hit] == pair[1]] if across else hit[hit > q]
        if table and len(hit):
            hit = hit[(earlier[hit] != earlier[q]).all(axis=1)]
        if len(hit):
            hit = hit[raw[hit] @ raw[q] / (norm[hit] * norm[q]) >= cosine]
            links[q] += weight[hit].sum()
            links[hit] += weight[q]
            for i in hit:
                a, b = find(q), find(i)
                if a != b:
                    root[max(a, b)] = min(a, b)
    return links, cls[[find(i) for i in range(len(cls))]]


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of
    ``vectors(vec_id, embedding, label)``.

    Only vectors with equal labels (and lengths) are compared.  Null labels,
    null or zero vectors and vectors with null or non-finite components link
    with nothing and keep themselves.  A null ``vec_id`` has a null component and
    ``kept``; a repeated row links with its copies.  Other columns are not read."""
    ensure_checkpoint_dir(vectors.sparkSession)
    values = F.col("embedding").cast("array<double>")
    sound = (F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
             & F.exists(values, lambda x: x != 0))
    # single precision stays so on its way; the tasks compute in double precision
    kind = "array<float>" if dict(vectors.dtypes)["embedding"] == "array<float>" else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), F.col("embedding").cast(kind).alias("embedding"), sound.alias("sound"))
    rows = rows.withColumn("cls", F.when(F.coalesce("sound", F.lit(False)), F.xxhash64("label", F.size("embedding"), "embedding")))
    classes = (rows.where("cls is not null").groupBy("cls").agg(
        F.count("*").alias("weight"), F.min("vec_id").alias("vec_id"), F.min(F.struct("label", "embedding")).alias("v"))
        .select("cls", "weight", "vec_id", F.xxhash64("v.label", F.size("v.embedding")).alias("grp"), F.col("v.embedding").alias("embedding")).checkpoint())

    # how many signs and tables each label needs, by its number of vectors
    sizes = classes.groupBy("grp").agg(F.count("*").alias("n"))
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / CELL))).cast("int")
    repeats = F.create_map(*[x for b in range(33) for x in (F.lit(b), F.lit(tables(b, cosine)))])
    sizes = sizes.select("grp", F.least(bits, F.lit(32)).alias("bits")).withColumn("tables", repeats[F.col("bits")]).checkpoint()

    def place(batches):
        for b in batches:
            emb, bits, repeated = b.column("embedding"), b.column("bits").to_numpy(), b.column("tables").to_numpy()
            size, flat = pc.list_value_length(emb).to_numpy(), emb.flatten().to_numpy().astype(float)
            start, to = np.cumsum(size) - size, np.concatenate([[0], np.cumsum(repeated)])
            out = np.empty(to[-1], np.int64)
            for k, d, n in set(zip(bits.tolist(), size.tolist(), repeated.tolist())):
                at = np.flatnonzero((bits == k) & (size == d))
                raw = flat[start[at][:, None] + np.arange(d)]
                unit = raw / np.sqrt((raw * raw).sum(axis=1))[:, None]
                for t in range(n):
                    out[to[at] + t] = cells(unit, t, k)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.ListArray.from_arrays(pa.array(to, pa.int32()), pa.array(out))], [*b.schema.names[:-1], "cells"])

    placed = (classes.join(sizes, "grp").select("grp", "cls", "weight", "embedding", "bits", "tables")
              .mapInArrow(place, f"grp long, cls long, weight long, embedding {kind}, bits int, cells array<long>"))
    dealt = placed.select("grp", "cls", "weight", "embedding", "bits", F.posexplode("cells").alias("table", "cell"))
    key = ["grp", "table", "cell"]
    large = (dealt.groupBy(*key).count().where(f"count > {PART}")
             .select(*key, F.ceil(F.col("count") / PART).cast("int").alias("parts")).checkpoint())
    dealt = dealt.join(large, key, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = (dealt.withColumn("own", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")).drop("other", "parts"))
    order = [*key, "lo", "hi"]

    def run(batches):
        for t in runs(batches, order):
            t = t.combine_chunks()
            keys = np.stack([t.column(k).to_numpy() for k in order], axis=1)
            first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
            cls, weight, own, bits = (t.column(c).to_numpy() for c in ("cls", "weight", "own", "bits"))
            emb = t.column("embedding")
            for i, j in zip(first, np.append(first[1:], len(keys))):
                raw = emb.slice(i, j - i).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(j - i, -1)
                n, to = search_cell(cls[i:j], weight[i:j], own[i:j], raw, int(keys[i, 1]), int(bits[i]), cosine, (int(keys[i, 3]), int(keys[i, 4])))
                some = n > 0
                yield pa.RecordBatch.from_arrays([pa.array(cls[i:j][some]), pa.array(to[some]), pa.array(n[some])], ["a", "b", "n"])

    found = dealt.repartition(*order).sortWithinPartitions(*order, "cls").mapInArrow(run, "a long, b long, n long").checkpoint()
    links = found.groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("n"))
    label = components(found.select("a", "b")).withColumnRenamed("node", "cls")
    by_class = (classes.select("cls", "weight", "vec_id").join(links, "cls", "left").join(label, "cls", "left")
                .select("cls", "vec_id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "cls").alias("component")))
    group = by_class.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    by_class = by_class.join(group, "component").select("cls", "n_links", "component_id").checkpoint()
    out = rows.select("vec_id", "cls").join(by_class, "cls", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return (out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
            .withColumn("kept", F.col("vec_id") == F.col("component_id")))
