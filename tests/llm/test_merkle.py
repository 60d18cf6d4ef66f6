"""The manifest against a plain recursive tree over the whole table."""

import hashlib
import random
import zlib

import pytest

from starloom.llm import merkle

H = lambda s: hashlib.sha256(s.encode()).hexdigest()


def plain_leaf(doc_id, source, lang, n_chars, text):
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return H("".join(parts))


def plain_tree(nodes):
    """Root, and for each node the lists of (siblings before, after) upwards."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, p in enumerate(at):
            run = nodes[p // 16 * 16:p // 16 * 16 + 16]
            steps[k].append(("".join(run[:p % 16]), "".join(run[p % 16 + 1:])))
            at[k] = p // 16
        nodes = [H("".join(nodes[i:i + 16])) for i in range(0, len(nodes), 16)]
    return nodes[0], steps


def plain_audit(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append(r)
    trees = []
    for source in sorted(by_source, key=lambda s: (s is not None, (s or "").encode())):
        mine = sorted(by_source[source], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(*r)))
        trees.append((mine, *plain_tree([plain_leaf(*r) for r in mine])))
    if not trees:
        return []
    root, upper = plain_tree([t[1] for t in trees])
    out = []
    for (mine, subroot, steps), above in zip(trees, upper):
        for r, own in zip(mine, steps):
            walk = own + above
            change = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None
            at = plain_leaf(*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])) if change else plain_leaf(*r)
            for b, a in walk:
                at = H(b + at + a)
            out.append((r[0], plain_leaf(*r), subroot, root, H("".join(b + a for b, a in walk)), at, at == root))
    return sorted(out, key=repr)


def rows_of(sizes, seed=1):
    r = random.Random(seed)
    out, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            text = r.choice([None, "", "All lower or Not", "É   ß", "plain", "X" * r.randrange(50)])
            out.append((i, source, r.choice([None, "en", "de"]), r.choice([None, 0, len(text or "")]), text))
            i += 1
    r.shuffle(out)
    return out


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {"a": 16, None: 1}, {"a": 17, "b": 15, "é": 33, "Z": 2, "": 3}, {"a": 4096, "b": 4097}, {"hot": 5000, **{f"s{k}": 2 for k in range(40)}}])
def test_audit_equals_the_plain_tree(spark, sizes):
    rows = rows_of(sizes)
    docs = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA + ", leaf long, block string").repartition(5)
    got = merkle.audit(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_audit(rows)


def test_repeated_rows_null_ids_and_the_empty_table(spark):
    rows = [(1, "a", "en", 3, "Abc")] * 20 + [(None, "a", None, None, None), (None, None, None, None, None), (1, "a", "en", 3, "Abd"), (0, "a", "en", 0, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, merkle.audit(docs).collect()), key=repr) == plain_audit(rows)
    assert merkle.audit(docs.limit(0)).count() == 0


def test_witnesses_lead_to_the_root_and_no_other_leaf_does(spark):
    rows = rows_of({"a": 300, "b": 20}, 3)
    got = merkle.manifest(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 320 and len({r["root"] for r in got}) == 1 and len({r["subroot"] for r in got}) == 2
    for r in got:
        assert merkle.fold(r["leaf"], zip(r["before"], r["after"])) == r["root"]
        assert merkle.fold(H("other"), zip(r["before"], r["after"])) != r["root"]


def test_a_long_text_is_hashed_whole(spark):
    text = "Word " * 400_000
    rows = [(i, "a", "en", len(text), text + str(i)) for i in range(3)]
    assert sorted(map(tuple, merkle.audit(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr) == plain_audit(rows)


def test_partial_witnesses_grow_as_siblings_complete():
    tree = merkle.OpenSubtrees(merkle.height(40))
    witnesses = [tree.append(H(str(i))) for i in range(40)]
    assert [len(w) for w in witnesses] == [1] * 32 + [0] * 8  # two runs complete, one open
    root = tree.close()
    assert [len(w) for w in witnesses] == [2] * 40
    assert (root, witnesses) == plain_tree([H(str(i)) for i in range(40)])
