"""N-gram Jaccard join by count vectors in R-trees.

A document is the set of its distinct word shingles; two link when their
Jaccard similarity reaches 3/4.  Steps, each a Spark job over all documents:

1. Equal sets are one *class* (a hash of the set), so copies cost one row.
2. Every class is put into the shards of its *prefix*: its rarest
   ``n - ceil(3n/4) + 1`` shingles in one global order.  Linked sets share at
   least one prefix shingle, so the shards lose no link.  The order ranks
   shingles by an estimated document frequency (a count sketch over the whole
   corpus) and then by hash; any order is right, this one keeps passages that
   many documents share out of the prefixes.
3. Each class is held against one other: of the smallest classes of its shards
   the one that it shares most shards with.  That joins most of a group of near
   copies with one pair a class.  The other pairs of shards of two are kept, and
   those that are still in two components after that are verified with step 4's.
4. Shards that still hold two components after that are searched: a
   class's shingles are hashed into groups, the group counts are a point, the
   points of a shard go into an R-tree, and each point descends only into boxes
   where the summed minima of its coordinates and the box's upper corner, a bound
   on the overlap, can still reach the similarity.  Large shards are searched in
   pairs of parts.  What comes out are the classes for which the bound lets any
   pair through, not the pairs: in a group of near copies just below the
   similarity that would be nearly all.
5. These classes' texts go, once for all shards with the same smallest class, to
   the tasks that hold the shards, where the surviving pairs are verified on the
   whole shingle sets.  A task unites what it links and returns a spanning forest,
   fewer rows than it has classes; the links make the connected components.
"""

from __future__ import annotations

from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.components import components
from starloom.llm.kernels import mix, runs, shingle_sets
from starloom.llm.steps import holds, marked_among, maybe_among, settle
from starloom.session import ensure_checkpoint_dir

WORDS = 5
#: Classes of a part of a large shard, and points of an R-tree leaf.
PART, LEAF = 512, 16
#: Members of mixed shards that are dealt to one task together, and shingles.
TOGETHER, SHINGLES_TOGETHER = 8_000, 4_000_000
#: Shingles that are columns of one matrix when overlaps are counted.
COLUMNS = 4096


def needed_overlap(n, m):
    """Smallest overlap of sets of sizes n and m that are linked:
    100 i >= 75 (n + m - i), in whole numbers."""
    return (3 * (n + m) + 6) // 7


def prefix_length(n):
    """A linked set shares at least ceil(3n/4) shingles, so one of any
    n - ceil(3n/4) + 1 of them."""
    return n - (3 * n + 3) // 4 + 1


# -- count vectors -----------------------------------------------------------

def groups_for(size):
    """Groups of a set of this size: a power of two that leaves 2 to 4 shingles
    a group, so that minima of unlike sets stay well below the sizes."""
    return 1 << max(5, (max(1, (size - 1) // 4)).bit_length())


def count_vector(shingles: np.ndarray) -> bytes:
    """Shingles per group, one byte each if all fit, else four (led by a 4)."""
    g = groups_for(len(shingles))
    v = np.bincount((shingles >> np.uint64(20)).astype(np.int64) & (g - 1), minlength=g)
    return b"\1" + v.astype("u1").tobytes() if v.max(initial=0) < 256 else b"\4" + v.astype("<u4").tobytes()


def vector(point: bytes, groups: int) -> np.ndarray:
    """The counts for ``groups`` groups, which are unions of the point's own."""
    v = np.frombuffer(point, "u1" if point[0] == 1 else "<u4", offset=1)
    return v.reshape(-1, groups).sum(axis=0, dtype=np.int64)


def most_overlap(p: bytes, n: int, q: bytes, m: int) -> int:
    """Summed coordinate minima of two points: no overlap is larger."""
    g = min(groups_for(n), groups_for(m))
    return int(np.minimum(vector(p, g), vector(q, g)).sum())


class CountTree:
    """An R-tree over count vectors, packed bottom-up: points are sorted by set
    size, then by the most varied coordinate among those of similar size; a box
    keeps the upper corner of its points and the smallest and largest size."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        spread = points.var(axis=0).argmax() if len(points) else 0
        # sizes within one eighth of each other count as similar
        self.order = np.lexsort((points[:, spread], np.floor(np.log(sizes) * 8)))
        self.points, self.sizes = points[self.order], sizes[self.order]
        self.levels = []
        top, low, high = self.points, self.sizes, self.sizes
        while len(top) > LEAF:
            at = np.arange(0, len(top), LEAF)
            top = np.maximum.reduceat(top, at, axis=0)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            self.levels.append((top, low, high))

    def search(self, point: np.ndarray, size: int) -> np.ndarray:
        """Points (their places in the input) whose bound reaches the similarity."""
        found = np.arange(len(self.levels[-1][0])) if self.levels else np.arange(len(self.points))
        for depth in range(len(self.levels) - 1, -1, -1):
            top, low, high = self.levels[depth]
            bound = np.minimum(top[found], point).sum(axis=1)
            keep = (bound >= needed_overlap(size, low[found])) & (4 * high[found] >= 3 * size) & (4 * size >= 3 * low[found])
            found = found[keep]
            below = len(self.levels[depth - 1][0]) if depth else len(self.points)
            found = (found[:, None] * LEAF + np.arange(LEAF)).ravel()
            found = found[found < below]
        bound = np.minimum(self.points[found], point).sum(axis=1)
        return self.order[found[bound >= needed_overlap(size, self.sizes[found])]]


# -- one row for each document -----------------------------------------------

def _sketch(docs: DataFrame, bits: int) -> np.ndarray:
    """How many documents hold a shingle of each bucket, for two ways of
    hashing shingles into 2**bits buckets.  Of fixed size, whatever the corpus."""
    width = 1 << bits

    def counted(sets):
        every = np.concatenate([*sets, np.zeros(0, np.uint64)])
        return np.concatenate([np.bincount((every >> np.uint64(32 * k)).astype(np.int64) & (width - 1), minlength=width) for k in range(2)])

    def run(batches):
        holds("jaccard")
        total, some, size = np.zeros(2 * width, np.int64), [], 0
        for b in batches:
            for s in shingle_sets(b.column("text"), WORDS):
                some.append(s)
                size += len(s)
                if size > width:
                    total += counted(some)
                    some, size = [], 0
        total += counted(some)
        at = np.flatnonzero(total)
        for i in range(0, len(at), 65_536):
            part = at[i:i + 65_536]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], ["bucket", "n"])

    rows = docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(2 * width, np.int64)
    held = rows.toArrow()
    out[held["bucket"].to_numpy()] = held["n"].to_numpy()
    return out.reshape(2, width)


def _levels(sketch: np.ndarray) -> np.ndarray:
    """Coarse frequency of a bucket: 0 up to six standard deviations above the
    mean, then one more for each doubling."""
    mean = sketch.mean()
    above = np.maximum(sketch - mean, 0) / (6 * np.sqrt(mean) + 1)
    return np.where(above <= 1, 0, 1 + np.floor(np.log2(np.maximum(above, 1)))).astype(np.uint8)


def class_of(shingles: np.ndarray) -> int:
    """A 63-bit name of the set (0 and up)."""
    return int(mix(np.add.reduce(mix(shingles ^ np.uint64(0x51_7C_C1_B7_27_22_0A_95))).reshape(1) + np.uint64(len(shingles)))[0] >> np.uint64(1))


def signatures(docs: DataFrame, sketch: np.ndarray) -> DataFrame:
    """``doc_id, n, cls, point, rare, common`` (stored): size and class of each
    set, its count vector, and its prefix in two parts by the shingles' estimated
    frequency.  ``cls`` is null and the prefix empty where the set is empty."""
    levels, width = _levels(sketch), sketch.shape[1]
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches):
        holds("jaccard")
        level = shared.value
        for b in batches:
            n, cls, point, rare, common = [], [], [], [], []
            for s in shingle_sets(b.column("text"), WORDS):
                n.append(len(s))
                if not len(s):
                    cls.append(None), point.append(None), rare.append([]), common.append([])
                    continue
                cls.append(class_of(s))
                point.append(count_vector(s))
                f = np.minimum(*(level[k][(s >> np.uint64(32 * k)).astype(np.int64) & (width - 1)] for k in range(2)))
                size = prefix_length(len(s))
                few = s[f == 0]
                rare.append(few[:size].view(np.int64))
                if len(few) >= size:
                    common.append([])
                else:
                    rest, f = s[f > 0], f[f > 0]
                    common.append(rest[np.argsort(f, kind="stable")][:size - len(few)].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.array(point, pa.binary()),
                 pa.array(rare, pa.list_(pa.int64())), pa.array(common, pa.list_(pa.int64()))],
                ["doc_id", "n", "cls", "point", "rare", "common"])

    out = settle(docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n long, cls long, point binary, rare array<long>, common array<long>"))
    shared.destroy()
    return out


# -- candidate pairs ---------------------------------------------------------

def _stars(classes: DataFrame) -> DataFrame:
    """``h, cls, pivot``: each class of a shard with the shard's smallest class.
    ``h`` is null for shards of two, of which this row is the only pair.

    Shards of rare shingles are read in sorted order; those of common ones,
    which may be large, are joined with their minima, where Spark can split them."""

    def run(batches):
        holds("jaccard")
        for t in runs(batches, ["h"]):
            # whole shards, a batch's worth at a time
            h, c = t.column("h").to_numpy(), t.column("cls").to_numpy()
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            size = np.diff(np.append(first, len(h)))
            other = np.ones(len(h), bool)
            other[first] = False
            other &= np.repeat(size, size) > 1
            pivot, large = np.repeat(c[first], size)[other], np.repeat(size, size)[other] > 2
            if other.any():
                yield pa.RecordBatch.from_arrays([pa.array(h[other], mask=~large), pa.array(c[other]), pa.array(pivot)], ["h", "cls", "pivot"])

    rare = classes.select(F.explode("rare").alias("h"), "cls")
    rare = rare.repartition("h").sortWithinPartitions("h", "cls").mapInArrow(run, "h long, cls long, pivot long")
    common = classes.select(F.explode("common").alias("h"), "cls").checkpoint()
    shards = common.groupBy("h").agg(F.min("cls").alias("pivot"), F.count("*").alias("size")).where("size > 1").checkpoint()
    common = (common.join(shards, "h").where("cls != pivot")
              .select(F.when(F.col("size") > 2, F.col("h")).alias("h"), "cls", "pivot"))
    return rare.unionByName(common)


def _one_of_each(shards: DataFrame) -> DataFrame:
    """``h, cls`` without shards that hold the same classes as another one:
    copies share most of their prefixes, and so dozens of equal shards."""
    held = shards.groupBy("h").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("cls")).alias("x"), F.bit_xor(F.xxhash64("cls", F.lit(1))).alias("y"))
    first = held.groupBy("n", "x", "y").agg(F.min("h").alias("h")).select("h").checkpoint()
    return shards.join(first, "h", "left_semi")


def _search(members: DataFrame) -> DataFrame:
    """The rows of ``members`` that the R-tree's bound leaves a pair in their
    part, with a class of another component.  Members of a pair of parts are only
    held against those of the other part."""

    def run(batches):
        holds("jaccard")
        for t in runs(batches, ["h", "part"]):
            h, part, side = (t.column(c).to_numpy() for c in ("h", "part", "own"))
            first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (part[1:] != part[:-1])]))
            comp, n, point = t.column("component").to_numpy(), t.column("n").to_numpy(), t.column("point").to_pylist()
            suspect = np.zeros(len(h), bool)
            for i, j in zip(first, np.append(first[1:], len(h))):
                if comp[i:j].min() == comp[i:j].max():
                    continue
                across = side[i:j].min() < side[i:j].max()
                if not across and part[i] < 0:
                    continue  # the other part is empty
                own = np.array([groups_for(int(x)) for x in n[i:j]])
                for g in np.unique(own).tolist():
                    # linked sets differ by a third at most, so by one doubling of groups
                    at = i + np.flatnonzero((own == g) | (own == 2 * g))
                    points = np.stack([vector(point[k], g) for k in at])
                    tree = CountTree(points, n[at])
                    for k, q in enumerate(at):
                        if own[q - i] == g:
                            hit = at[tree.search(points[k], n[q])]
                            hit = hit[comp[hit] != comp[q]]
                            if across:
                                hit = hit[side[hit] != side[q]]
                            if len(hit):
                                suspect[q] = True
                                suspect[hit] = True
            if suspect.any():
                found = t.select(["pivot", "salt", "h", "part", "own", "cls", "component"]).filter(pa.array(suspect))
                yield from found.to_batches()

    return (members.repartition("pivot", "salt").sortWithinPartitions("pivot", "salt", "h", "part", "cls")
            .mapInArrow(run, "pivot long, salt int, h long, part long, own int, cls long, component long"))


def overlaps(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """Numbers of shingles in common of each set of one list and each of another
    (if that is empty, of the first list again), as products of their incidence
    matrices."""
    both, second = [*one, *two], len(one) if two else 0
    member = np.repeat(np.arange(len(both)), [len(x) for x in both])
    _, column, times = np.unique(np.concatenate(both), return_inverse=True, return_counts=True)
    shared = times > 1  # the others are in one set only
    number = np.cumsum(shared) - 1
    keep = shared[column]
    member, column = member[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    member, column = member[order], column[order]
    out = np.zeros((len(one), len(two) or len(one)), np.float32)
    for low in range(0, int(shared.sum()), COLUMNS):
        i, j = np.searchsorted(column, [low, low + COLUMNS])
        m = np.zeros((len(both), min(COLUMNS, int(shared.sum()) - low)), np.float32)
        m[member[i:j], column[i:j] - low] = 1
        out += m[:len(one)] @ m[second:].T
    if not second:  # what a set shares with nothing else still is in it
        np.fill_diagonal(out, [len(x) for x in one])
    return out.astype(np.int64)


class _Forest:
    """Components that are united as links are found."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while x in self.up:
            self.up[x] = self.up.get(self.up[x], self.up[x])
            x = self.up[x]
        return x

    def link(self, cls: list[np.ndarray], roots: list[np.ndarray], linked: np.ndarray):
        """Pairs of classes of two lists whose link unites two components;
        ``roots`` are their present components, and kept up."""
        for i in range(len(cls[0])):
            while True:
                j = np.flatnonzero(linked[i] & (roots[1] != roots[0][i]))
                if not len(j):
                    break
                here, there = int(roots[0][i]), int(roots[1][j[0]])
                self.up[there] = here
                for r in roots:
                    r[r == there] = here
                yield int(cls[0][i]), int(cls[1][j[0]])


def _forest(suspects: DataFrame, texts: DataFrame) -> DataFrame:
    """``a, b``: verified links that unite components of ``suspects``, at most one
    less in each task than it has classes."""

    def links_of(group: pa.Table):
        kind = group.column("kind").to_numpy()
        named, members = group.filter(pa.array(kind == 0)), group.filter(pa.array(kind == 1))
        text = named.column("text").combine_chunks()
        sets = dict(zip(named.column("cls").to_pylist(), shingle_sets(text.chunk(0) if isinstance(text, pa.ChunkedArray) else text, WORDS)))
        forest = _Forest()
        h, part, side, cls, comp = (members.column(c).to_numpy() for c in ("h", "part", "own", "cls", "component"))
        first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (part[1:] != part[:-1])])) if len(h) else []
        for i, j in zip(first, np.append(first[1:], len(h))):
            low = side[i:j].min()
            across = low < side[i:j].max()
            parts = [np.arange(i, j)[side[i:j] == low], np.arange(i, j)[side[i:j] != low]] if across else [np.arange(i, j)] * 2
            roots = [np.array([forest.root(int(c)) for c in comp[p]]) for p in parts]
            if len({*roots[0].tolist(), *roots[1].tolist()}) == 1:
                continue
            of = [[sets[int(c)] for c in cls[p]] for p in parts]
            size = [np.array([len(x) for x in y]) for y in of]
            linked = overlaps(of[0], of[1] if across else []) >= needed_overlap(size[0][:, None], size[1][None, :])
            yield from forest.link([cls[p] for p in parts], roots, linked)

    def run(batches):
        holds("jaccard")
        for t in runs(batches, ["pivot", "salt"]):
            p, q = t.column("pivot").to_numpy(), t.column("salt").to_numpy()
            first = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1]) | (q[1:] != q[:-1])]))
            found = [x for i, j in zip(first, np.append(first[1:], len(p))) for x in links_of(t.slice(i, j - i))]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in range(2)], ["a", "b"])

    named = (suspects.select("pivot", "salt", "cls").distinct().join(texts, "cls")
             .select("pivot", "salt", F.lit(0).alias("kind"), "cls", "text"))
    rows = suspects.withColumn("kind", F.lit(1)).unionByName(named, allowMissingColumns=True)
    return (rows.repartition("pivot", "salt").sortWithinPartitions("pivot", "salt", "kind", "h", "part", "cls")
            .mapInArrow(run, "a long, b long"))


def _texts(classes: DataFrame, docs: DataFrame, holders: DataFrame) -> DataFrame:
    """``cls, text``: the text of one document of each class of ``classes(cls)``.

    ``holders(cls, doc_id)`` names the documents.  They are found by a bitmap of
    ids, of fixed size (its false hits only cost some shuffle)."""
    wanted = settle(classes.join(holders, "cls"))

    def names(batches):
        holds("jaccard")
        for b in batches:
            cls = [class_of(s) if len(s) else None for s in shingle_sets(b.column("text"), WORDS)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text"), pa.array(cls, pa.int64())], ["doc_id", "text", "cls"])

    named = maybe_among(docs.where("doc_id is not null"), wanted, "doc_id").mapInArrow(names, "doc_id long, text string, cls long")
    return settle(named.join(wanted.withColumnRenamed("doc_id", "holder"), "cls").where("doc_id = holder")
                  .select("cls", "text").dropDuplicates(["cls"]))


def _apart(pairs: DataFrame, label: DataFrame, holders: DataFrame) -> DataFrame:
    """The rows of ``pairs(a, b)`` (classes) that are still in two components and
    whose sizes can reach the similarity."""
    known = (holders.select("cls", "n").join(label.withColumnRenamed("node", "cls"), "cls", "left")
             .select("cls", "n", F.coalesce("component", "cls").alias("component")))
    side = lambda s: known.select(F.col("cls").alias(s), F.col("n").alias(f"n_{s}"), F.col("component").alias(f"c_{s}"))
    return (pairs.join(side("a"), "a").join(side("b"), "b")
            .where("c_a != c_b and 4 * least(n_a, n_b) >= 3 * greatest(n_a, n_b)").select("a", "b"))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows of ``pairs(a, b)`` (classes) that are linked: the whole sets,
    made again from the texts (which are smaller), are intersected."""

    def check(batches):
        holds("jaccard")
        known: OrderedDict[int, np.ndarray] = OrderedDict()

        def sets(column, name):
            ids = column.to_pylist()
            new = {i: k for k, i in enumerate(ids) if i not in known}
            for i, s in zip(new, shingle_sets(name.take(pa.array(list(new.values()), pa.int64())), WORDS)):
                known[i] = s
            return ids

        for b in batches:
            a, c = sets(b.column("a"), b.column("text_a")), sets(b.column("b"), b.column("text_b"))
            keep = []
            for x, y in zip(a, c):
                u, v = known[x], known[y]
                i = len(np.intersect1d(u, v, assume_unique=True))
                keep.append(100 * i >= 75 * (len(u) + len(v) - i))
            while len(known) > 4096:
                known.popitem(last=False)
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = (pairs.join(texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b")), "b"))
    return both.select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long")


def _bounded(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """The pairs whose summed minima can still reach the similarity."""

    def run(batches):
        holds("jaccard")
        for b in batches:
            n, m, p, q = (b.column(c).to_pylist() for c in ("n_a", "n_b", "point_a", "point_b"))
            keep = [4 * min(x, y) >= 3 * max(x, y) and most_overlap(u, x, v, y) >= needed_overlap(x, y) for x, y, u, v in zip(n, m, p, q)]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda s: points.select(F.col("cls").alias(s), F.col("n").alias(f"n_{s}"), F.col("point").alias(f"point_{s}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long")


def _joined(label: DataFrame, links: DataFrame) -> DataFrame:
    """Component labels after more links: only these are contracted."""
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(label, "node", "left_anti")
    label = label.unionByName(nodes.withColumn("component", F.col("node"))).checkpoint()
    side = lambda s: label.select(F.col("node").alias(s), F.col("component").alias(f"c{s}"))
    above = components(links.join(side("a"), "a").join(side("b"), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    return (label.join(above.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left")
                  .select("node", F.coalesce("to", "component").alias("component")).checkpoint())


# -- the operator ------------------------------------------------------------

def jaccard_components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs(doc_id, text)``.

    ``component_id`` is the smallest ``doc_id`` reachable by links.  Texts that
    are null or hold no word have the empty set and are linked with nothing.
    Rows without a ``doc_id`` keep a null component and link nothing; a repeated
    row repeats its result.  Other columns are not read."""
    ensure_checkpoint_dir(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    bits = int(min(22, max(16, np.ceil(np.log2(docs.count() / 4 + 1)))))
    signed = signatures(docs, _sketch(docs, bits))
    named = signed.where("cls is not null and doc_id is not null")
    classes = settle(named.groupBy("cls").agg(F.min(F.struct("doc_id", "n", "point", "rare", "common")).alias("s")).select("cls", "s.*"))
    holders = classes.select("cls", "doc_id", "n", "point").checkpoint()
    signed = settle(signed.select("doc_id", F.col("n").alias("n_shingles"), "cls"))
    stars = settle(_stars(classes.select("cls", "rare", "common")))
    del named, classes
    likeliest = (stars.groupBy("cls", "pivot").agg(F.count("*").alias("shared")).groupBy(F.col("cls").alias("a"))
                 .agg(F.max_by("pivot", F.struct("shared", "pivot")).alias("b")))
    near = settle(_bounded(likeliest, holders))
    texts = _texts(near.select(F.explode(F.array("a", "b")).alias("cls")).distinct(), docs, holders.select("cls", "doc_id"))
    links = settle(_verified(near, texts))
    label = components(links)

    # Pairs of shards of two that were not the likeliest of their class.
    pairs = stars.where("h is null").select(F.col("pivot").alias("a"), F.col("cls").alias("b")).distinct()
    pairs = settle(_bounded(_apart(pairs, label, holders), holders))

    # Shards that the stars have not joined into one component.
    shards = stars.where("h is not null")
    shards = shards.select("h", "cls").unionByName(shards.select("h", F.col("pivot").alias("cls")).distinct())
    shards = settle(_one_of_each(shards))
    del stars
    tried = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).checkpoint()
    placed = settle(shards.join(label.withColumnRenamed("node", "cls"), "cls", "left").join(holders.select("cls", "n"), "cls")
                    .select("h", "cls", "n", F.coalesce("component", "cls").alias("component")))
    del shards
    mixed = (placed.groupBy("h").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("cls").alias("pivot"),
                                     F.count("*").alias("size"), F.sum("n").alias("weight"))
             .where("lo < hi").select("h", "pivot", "size", "weight", F.ceil(F.col("size") / PART).cast("int").alias("parts")).checkpoint())
    held = F.greatest(F.sum(F.col("size") * F.col("parts")) / TOGETHER, F.sum(F.col("weight") * F.col("parts")) / SHINGLES_TOGETHER)
    salts = mixed.groupBy("pivot").agg(F.ceil(held).cast("int").alias("salts")).checkpoint()
    own = F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    # a part by itself has a number from 0 on, a pair of parts one below
    part = (F.when(F.col("own") == F.col("other"), F.col("own"))
            .otherwise(-1 - F.least("own", "other") * F.col("parts") - F.greatest("own", "other"))).cast("long")
    members = (placed.join(mixed.join(salts, "pivot").drop("weight"), "h").select("*", own.alias("own")).select("*", other.alias("other"))
               .select("pivot", F.pmod(F.xxhash64("h", part), F.col("salts")).cast("int").alias("salt"), "h", part.alias("part"), "own", "cls", "component", "n")
               .join(holders.select("cls", "point"), "cls"))
    suspects = settle(_search(members))
    pairs = settle(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).join(tried, ["a", "b"], "left_anti"))
    new = suspects.select("cls").unionByName(pairs.select(F.explode(F.array("a", "b")).alias("cls"))).distinct().join(texts.select("cls"), "cls", "left_anti")
    if not (suspects.isEmpty() and pairs.isEmpty()):
        texts = settle(texts.unionByName(_texts(new, docs, holders.select("cls", "doc_id"))))
        label = _joined(label, settle(_forest(suspects, texts).unionByName(_verified(pairs, texts))))

    smallest = (holders.join(label.withColumnRenamed("node", "cls"), "cls", "left")
                .select("cls", "doc_id", F.coalesce("component", "cls").alias("component")))
    group = smallest.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_class = smallest.join(group, "component").select("cls", "component_id").checkpoint()
    return (signed.join(by_class, "cls", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, of which no row with a smaller
    ``doc_id`` is linked to over any number of links.

    Rows with one ``doc_id``, or with none, count as rows of their own: of linked
    ones one stays, which one is up to their order; null ids come last.  Texts
    without words are linked with nothing and all stay.  An empty table stays so."""
    ids = docs.groupBy("doc_id").count().where("doc_id is null or count > 1")
    if not ids.isEmpty():
        numbered = settle(docs.repartitionByRange(F.asc_nulls_last("doc_id"), F.xxhash64("text")).sortWithinPartitions(F.asc_nulls_last("doc_id"))
                          .withColumn("__row", F.monotonically_increasing_id()))
        return _first_of_each(numbered, "__row").select(*docs.columns)
    return _first_of_each(docs, "doc_id")


def _first_of_each(docs: DataFrame, row: str) -> DataFrame:
    groups = jaccard_components(docs.select(F.col(row).alias("doc_id"), "text"))
    lost = settle(groups.where("component_id < doc_id").select(F.col("doc_id").alias(row)))
    marked = marked_among(docs, lost, row, "__suspect")
    return (marked.where("not __suspect").select(*docs.columns)
            .unionByName(marked.where("__suspect").join(lost, row, "left_anti").select(*docs.columns)))


__all__ = ["CountTree", "jaccard_components", "keep_one_of_each"]
