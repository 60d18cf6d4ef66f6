"""Merkle manifest of a document table, with a witness for every row.

Each document is a leaf.  The leaves of one source, by ascending ``doc_id``, form
a tree whose nodes have up to 16 children; the sources' roots, by source, form one
more tree of the same kind, whose root names the whole table.

Witnesses grow while leaves are appended.  :class:`OpenSubtrees` keeps, for each
level, the run that is still open; a leaf's witness starts empty, and whenever a
run closes, the witnesses of all leaves below each of its members get the other
members' digests.  A task appends the leaves of one *block*, 16**3 consecutive
leaves of a source that start at a multiple of 16**3, so that every run it closes
is a run of the whole tree.  The blocks' roots are then appended in the same
manner to blocks of their own, and so on until one node is left; on the way back
each block gets the witness of its root and puts it behind those of its leaves.
No task holds more than one block, whatever the size of a source.

Nulls: a null field is hashed as ``-``; rows with a null source form a source of
their own (before all others), a null ``doc_id`` comes first in its source and is
never tampered with.  Equal rows are equal leaves, each with its own place.  Rows
with the same source and ``doc_id`` but different content are ordered by digest.
An empty table has no rows and no root.  Other columns are not read."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.steps import settle

#: Children of a node, levels of a block, leaves of a block.
FAN_OUT, LEVELS = 16, 3
BLOCK = FAN_OUT ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height(n: int) -> int:
    """Levels between ``n`` nodes and the one node left in the end."""
    h = 0
    while n > 1:
        n, h = -(-n // FAN_OUT), h + 1
    return h


def fold(leaf: str, witness: Iterable[tuple[str, str]]) -> str:
    """The root that follows from a leaf and its witness."""
    for before, after in witness:
        leaf = digest(before + leaf + after)
    return leaf


class OpenSubtrees:
    """A tree of ``levels`` levels that grows by appending.  ``append`` returns
    the leaf's witness, a list that is extended by the digests before and after
    it (or after the node that holds it) in each run, as soon as the run is
    complete; ``close`` completes the runs that stayed short."""

    def __init__(self, levels: int):
        self.open: list[list[tuple[str, list]]] = [[] for _ in range(levels + 1)]

    def append(self, leaf: str) -> list[tuple[str, str]]:
        witness: list[tuple[str, str]] = []
        self.open[0].append((leaf, [witness]))
        level = 0
        while level + 1 < len(self.open) and len(self.open[level]) == FAN_OUT:
            self._complete(level)
            level += 1
        return witness

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        digests = [d for d, _ in run]
        below: list[list] = []
        for i, (_, witnesses) in enumerate(run):
            step = "".join(digests[:i]), "".join(digests[i + 1:])
            for w in witnesses:
                w.append(step)
            below.extend(witnesses)
        self.open[level + 1].append((digest("".join(digests)), below))

    def close(self) -> str:
        for level in range(len(self.open) - 1):
            if self.open[level]:
                self._complete(level)
        (root, _), = self.open[-1]
        return root


def leaf_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, source, leaf, tampered`` of every row; ``tampered`` is the digest
    after a change of the text, null where it is not changed."""
    field = {c: F.col(c).cast("string") for c in FIELDS}

    def leaf(**changed):
        parts = [F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in (field | changed).values()]
        return F.sha2(F.concat(*parts), 256)

    chosen = F.crc32(field["doc_id"].cast("binary")) % 5 == 0
    return docs.select("doc_id", field["source"].alias("source"), leaf().alias("leaf"),
                       F.when(chosen, leaf(text=F.translate(field["text"], _UPPER, _UPPER.lower()))).alias("tampered"))


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds each row's place ``pos`` in its ``tree`` and the tree's size ``n``.
    Rows are dealt by ranges of the whole order, so a tree may lie in many
    partitions; places follow from the partitions' counts."""
    rows = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    rows = settle(rows.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)))
    tree = Window.partitionBy("tree")
    parts = (rows.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("size"))
             .select(F.col("tree").alias("t"), F.col("part").alias("p"), "first", F.sum("size").over(tree).alias("n"),
                     (F.sum("size").over(tree.orderBy("part")) - F.col("size")).alias("earlier")))
    return (rows.join(parts, rows["tree"].eqNullSafe(parts["t"]) & (F.col("part") == F.col("p")))
            .withColumn("pos", F.col("at") - F.col("first") + F.col("earlier")).drop("at", "part", "t", "p", "first", "earlier"))


def _by_block(rows: DataFrame) -> DataFrame:
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each block, from batches sorted by it."""
    rows: list[dict] = []
    for b in batches:
        for row in b.to_pylist():
            if rows and (row["tree"], row["block"]) != (rows[0]["tree"], rows[0]["block"]):
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def _append_all(rows: list[dict]) -> tuple[str, list[list[tuple[str, str]]]]:
    n = rows[0]["n"]
    tree = OpenSubtrees(LEVELS if n > BLOCK else height(n))
    witnesses = [tree.append(r["digest"]) for r in rows]
    return tree.close(), witnesses


def _emit(rows: Iterable[dict], schema: pa.Schema, size: int = 1024) -> Iterator[pa.RecordBatch]:
    out: list[dict] = []
    for r in rows:
        out.append(r)
        if len(out) == size:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


_ROOTS = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("digest", pa.string())])


def _climb(nodes: DataFrame) -> list[DataFrame]:
    """The nodes and, as further appends, the roots of their blocks, of the
    blocks of these, ..., until every tree has one node."""
    def run(batches):
        yield from _emit(({"tree": rows[0]["tree"], "pos": rows[0]["block"], "n": -(-rows[0]["n"] // BLOCK), "digest": _append_all(rows)[0]}
                          for rows in _blocks(batches)), _ROOTS)

    levels = [nodes]
    while True:
        rows = levels[-1].select("tree", F.shiftright("pos", 4 * LEVELS).alias("block"), "pos", "n", "digest")
        levels.append(settle(_by_block(rows).mapInArrow(run, "tree string, pos long, n long, digest string")))
        if levels[-1].where("n > 1").isEmpty():
            return levels


_WITNESS = "before array<string>, after array<string>, subroot string, root string"
_WITNESS_ARROW = [("before", pa.list_(pa.string())), ("after", pa.list_(pa.string())), ("subroot", pa.string()), ("root", pa.string())]


def _extended(nodes: DataFrame, above: DataFrame, result=None, schema: pa.Schema | None = None, ddl: str | None = None) -> DataFrame:
    """The nodes with their whole witnesses: what the block gives, then what
    ``above(tree, pos, before, after, subroot, root)`` holds for the block's root,
    which is read once, ahead of its block.  ``result`` turns a node and its
    witness into an output row."""
    schema = schema or pa.schema([("tree", pa.string()), ("name", pa.string()), ("pos", pa.int64()), ("digest", pa.string()), *_WITNESS_ARROW])
    ddl = ddl or f"tree string, name string, pos long, digest string, {_WITNESS}"

    def rows_of(batches):
        for head, *rows in _blocks(batches):
            shared = list(zip(head["before"], head["after"]))
            for row, witness in zip(rows, _append_all(rows)[1]):
                witness.extend(shared)
                if result:
                    yield result(row, witness, head)
                else:
                    yield row | {"before": [b for b, _ in witness], "after": [a for _, a in witness],
                                 "subroot": head["subroot"], "root": head["root"]}

    heads = above.select("tree", F.col("pos").alias("block"), F.lit(-1).cast("long").alias("pos"), "before", "after", "subroot", "root")
    both = nodes.withColumn("block", F.shiftright("pos", 4 * LEVELS)).unionByName(heads, allowMissingColumns=True)
    return _by_block(both).mapInArrow(lambda batches: _emit(rows_of(batches), schema), ddl)


def _down(levels: list[DataFrame], heads: DataFrame) -> DataFrame:
    """From the witnesses of the one node of each tree to those of all nodes of
    the second lowest level."""
    for nodes in levels[-2:0:-1]:
        heads = _extended(nodes.withColumn("name", F.lit(None).cast("string")), heads)
    return heads


def _witnessed(leaves: DataFrame, result, schema: pa.Schema, ddl: str) -> DataFrame:
    nodes = leaves.select(F.col("source").alias("tree"), "doc_id", F.col("leaf").alias("digest"), "tampered")
    low = _climb(settle(_numbered(settle(nodes), ["doc_id", "digest"])))
    none = F.array().cast("array<string>")
    names = low[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    high = _climb(settle(_numbered(names, ["name"])))
    top = high[-1].select("tree", "pos", none.alias("before"), none.alias("after"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    sources = _extended(high[0], _down(high, top)).select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("pos"), "before", "after", F.col("digest").alias("subroot"), "root")
    return _extended(low[0], _down(low, settle(sources)), result, schema, ddl)


def manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, before, after`` of every row: the witness
    lists, level by level upwards, the digests before and after the node in its
    run (each a text of joined digests); :func:`fold` gives the root from it."""
    kind = docs.select("doc_id").schema["doc_id"].dataType
    schema = pa.schema([("doc_id", _arrow(kind)), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
                        ("before", pa.list_(pa.string())), ("after", pa.list_(pa.string()))])

    def result(row, witness, head):
        return {"doc_id": row["doc_id"], "leaf": row["digest"], "subroot": head["subroot"], "root": head["root"],
                "before": [b for b, _ in witness], "after": [a for _, a in witness]}

    return _witnessed(leaf_digests(docs), result, schema,
                      f"doc_id {kind.simpleString()}, leaf string, subroot string, root string, before array<string>, after array<string>")


def audit(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of
    every row: the witness's digest, and whether the witness leads from the row's
    leaf, tampered with where :func:`leaf_digests` says so, to the root."""
    kind = docs.select("doc_id").schema["doc_id"].dataType
    schema = pa.schema([("doc_id", _arrow(kind)), *[(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")],
                        ("verified", pa.bool_())])

    def result(row, witness, head):
        folded = fold(row["tampered"] or row["digest"], witness)
        return {"doc_id": row["doc_id"], "leaf": row["digest"], "subroot": head["subroot"], "root": head["root"],
                "proof_sha256": digest("".join(b + a for b, a in witness)), "folded_root": folded, "verified": folded == head["root"]}

    return _witnessed(leaf_digests(docs), result, schema,
                      f"doc_id {kind.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def _arrow(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


__all__ = ["OpenSubtrees", "audit", "fold", "height", "leaf_digests", "manifest"]
