"""Jaccard join, components, collision counting and fingerprints against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from starloom.llm import imatch, jaccard, projections
from starloom.llm.components import components
from starloom.llm.kernels import shingle_sets


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text):
    w = words_of(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def grouped(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_copies(seed, groups=25, vocabulary=400):
    """Random texts, copies of them with some words changed, texts that share a
    passage, short, empty and null texts."""
    r = random.Random(seed)
    word = lambda: f"W{r.randrange(vocabulary)}" + r.choice(["", ",", "é"])
    passage = [word() for _ in range(40)]
    out = []
    for _ in range(groups):
        base = [word() for _ in range(r.choice([3, 5, 8, 30, 120, 400]))]
        out.append(" ".join(base))
        for _ in range(r.randrange(6)):
            copy = list(base)
            for _ in range(r.randrange(1 + len(copy) // 25)):
                copy[r.randrange(len(copy))] = word()
            out.append(r.choice(["\n", " ", "  "]).join(copy + ([word()] if r.random() < 0.3 else [])))
    for _ in range(30):
        out.append(" ".join(passage + [word() for _ in range(r.randrange(25))]))
    return out + ["", None, "  \n", "one two", "ONE two", "one two three"]


def expected_groups(rows):
    sets = {i: shingles(t) for i, t in rows}
    links = []
    ids = list(sets)
    for x in range(len(ids)):
        for y in range(x):
            a, b = sets[ids[x]], sets[ids[y]]
            n = len(a & b)
            if n and 100 * n >= 75 * (len(a) + len(b) - n):
                links.append((ids[x], ids[y]))
    return {i: (len(sets[i]), c) for i, c in grouped(ids, links).items()}


def test_shingle_hashes_equal_the_sets():
    import pyarrow as pa

    texts = near_copies(2)
    for t, s in zip(texts, shingle_sets(pa.array(texts), 5)):
        assert len(s) == len(shingles(t))
    one, two = shingle_sets(pa.array(["A b\tc d e f", "a B c D e\n\nF"]), 5)
    assert (one == two).all()


@pytest.mark.parametrize("part,together", [(jaccard.PART, jaccard.TOGETHER), (4, 10)])
def test_jaccard_groups(spark, monkeypatch, part, together):
    monkeypatch.setattr(jaccard, "PART", part)
    monkeypatch.setattr(jaccard, "TOGETHER", together)
    rows = list(enumerate(near_copies(part)))
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(3 * i, t, "c", 0.5) for i, t in rows], "doc_id long, text string, cls string, n double").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(df).collect()}
    assert got == expected_groups([(3 * i, t) for i, t in rows])


@pytest.mark.parametrize("passage,changed", [(9, 1), (14, 2)])
def test_jaccard_chains_over_shards_of_two(spark, passage, changed):
    """C links to A and to B, which do not link: A changes C's first words, B its
    last.  The words between are C's own (11 words) or shared by all triples."""
    r = random.Random(passage)
    words = lambda n: [f"w{r.randrange(10**9)}" for _ in range(n)]
    shared, texts = words(passage), []
    for _ in range(120):
        first, body, last = words(changed), shared if changed > 1 else words(passage), words(changed)
        texts += [" ".join(t) for t in (words(changed) + body + last, first + body + words(changed), first + body + last)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard.jaccard_components(df).collect()}
    assert len(set(expected_groups(rows).values())) == 120 and got == expected_groups(rows)


def test_jaccard_edges(spark):
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (9, "A B C D E F"), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, jaccard.jaccard_components(df).collect()), key=str)
    assert got == sorted([(None, 2, None), (4, 2, 4), (4, 2, 4), (9, 2, 4), (2, 0, 2)], key=str)
    assert jaccard.jaccard_components(df.limit(0)).count() == 0
    kept = jaccard.keep_one_of_each(df.withColumn("_lost", F.lit(1)))
    assert kept.columns == ["doc_id", "text", "_lost"] and sorted(r.doc_id for r in kept.collect()) == [2, 4]


def test_one_of_each_whatever_the_ids(spark):
    """Repeated and null ids: one row of each group stays, and one with an id."""
    text = "a b c d e f g h i j k l m n o p q r s t"
    rows = [(5, text), (5, text), (5, text + " u"), (None, text), (7, "x y z"), (7, "other words"), (None, "only one"), (None, "only one"), (3, ""), (3, "")]
    kept = jaccard.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert [i for i, t in got if t.startswith("a b")] == [5] and len(got) == 6
    assert [x for x in got if not x[1].startswith("a b")] == sorted([(7, "x y z"), (7, "other words"), (None, "only one"), (3, ""), (3, "")], key=str)


@pytest.mark.parametrize("changes", [3, 5])
def test_large_group_of_near_copies_below_the_similarity(spark, changes):
    """2,000 copies of one text, most pairs at 0.66 (the links join all of them)
    or 0.5 (most stay alone)."""
    r = random.Random(changes)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(2000):
        w = list(base)
        for _ in range(changes):
            w[r.randrange(150)] = f"x{r.randrange(10**9)}"
        rows.append((i, " ".join(w)))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # overlaps of all pairs by the operator's own matrix, checked below
    import pyarrow as pa
    sets = [*shingle_sets(pa.array([t for _, t in rows]), 5)]
    links = []
    for k in range(0, 2000, 500):
        common = jaccard.overlaps(sets[k:k + 500], sets)
        size = np.array([len(x) for x in sets])
        union = size[k:k + 500, None] + size[None, :] - common
        links += [(int(a) + k, int(b)) for a, b in zip(*np.nonzero(100 * common >= 75 * union)) if a + k < b]
    want = grouped(range(2000), links)
    assert {i: c for i, (_, c) in got.items()} == want
    assert (len(set(want.values())) > 500) == (changes == 5)


def test_overlaps_of_two_lists(monkeypatch):
    monkeypatch.setattr(jaccard, "COLUMNS", 7)
    r = np.random.default_rng(1)
    sets = [np.unique(r.integers(0, 60, r.integers(1, 40)).astype(np.uint64)) for _ in range(30)]
    want = [[len(np.intersect1d(a, b)) for b in sets[12:]] for a in sets[:12]]
    assert jaccard.overlaps(sets[:12], sets[12:]).tolist() == want
    assert jaccard.overlaps(sets, []).tolist() == [[len(np.intersect1d(a, b)) for b in sets] for a in sets]


def test_tree_finds_all_that_the_bound_lets_through():
    r = np.random.default_rng(4)
    centres = r.poisson(3, (20, 64))
    points = np.concatenate([centres + r.binomial(1, 0.03, (20, 64)) for _ in range(30)])
    sizes = points.sum(axis=1)
    tree = jaccard.CountTree(points, sizes)
    for q in range(0, len(points), 7):
        bound = np.minimum(points, points[q]).sum(axis=1)
        want = np.flatnonzero((bound >= jaccard.needed_overlap(sizes[q], sizes)))
        assert sorted(tree.search(points[q], sizes[q])) == want.tolist()


def test_overlap_needed_and_prefix():
    for n in range(1, 60):
        for m in range(1, 60):
            least = jaccard.needed_overlap(n, m)
            assert [100 * i >= 75 * (n + m - i) for i in (least - 1, least)] == [False, True]
        assert jaccard.prefix_length(n) == n - -(-3 * n // 4) + 1


def test_components(spark):
    r = random.Random(7)
    path = [(i, i + 1) for i in range(60)]
    r.shuffle(path)
    links = path + [(1000, x) for x in range(900, 960)] + [(5000, 5000), (2000, 2001), (2001, 2000)] + [(r.randrange(3000, 3100), r.randrange(3000, 3100)) for _ in range(60)]
    df = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    got = {x.node: x.component for x in components(df).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == {n: c for n, c in grouped(sorted({x for p in links for x in p}), links).items() if n in nodes}
    assert components(df.limit(0)).count() == 0


def brute_vectors(rows, cosine=projections.COSINE):
    ok = [(k, i, np.asarray(v, float), lab) for k, (i, v, lab) in enumerate(rows)
          if lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = []
    n = defaultdict(int)
    for x in range(len(ok)):
        for y in range(x):
            (kx, ix, a, la), (ky, iy, b, lb) = ok[x], ok[y]
            if la == lb and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine:
                links.append((kx, ky))
                n[kx] += 1
                n[ky] += 1
    comp = grouped(range(len(rows)), links)
    smallest = defaultdict(lambda: 1 << 60)
    for k, c in comp.items():
        smallest[c] = min(smallest[c], rows[k][0])
    return {rows[k][0]: (n[k], smallest[comp[k]], rows[k][0] == smallest[comp[k]]) for k in range(len(rows))}


@pytest.mark.parametrize("cell, kind", [(projections.CELL, "float"), (40, "float"), (40, "double")])
def test_collision_counting(spark, monkeypatch, cell, kind):
    monkeypatch.setattr(projections, "CELL", cell)
    monkeypatch.setattr(projections, "PART", cell)
    r = np.random.default_rng(cell)
    rows = []
    for _ in range(60):
        centre = r.standard_normal(24)
        for _ in range(r.integers(1, 9)):
            rows.append((centre + r.normal(0, r.choice([0.02, 0.2, 0.35]), 24)).astype(np.float32).astype(float).tolist())
    rows += [rows[0]] * 30  # equal vectors
    table = [(int(i), v, int(i % 3) if i % 50 else 0) for i, v in zip(r.permutation(len(rows)) * 2 + 10, rows)]
    table += [(1, None, 0), (3, [0.0] * 24, 0), (5, [float("nan")] * 24, 0), (7, [None] + [1.0] * 23, 0), (9, rows[0], None), (2, [1.0, 2.0], 0)]
    df = spark.createDataFrame([(*t, "x") for t in table], f"vec_id long, embedding array<{kind}>, label int, weight string").repartition(3)
    got = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in projections.near_duplicates(df).collect()}
    want = brute_vectors(table)
    found, all_links = sum(v[0] for v in got.values()), sum(v[0] for v in want.values())
    assert set(got) == set(want) and 0.98 * all_links <= found <= all_links
    assert all(got[k][0] <= want[k][0] for k in want)
    assert sum(got[k] == want[k] for k in want) >= 0.97 * len(want)
    assert projections.near_duplicates(df.limit(0)).count() == 0


def test_calibration():
    r = np.random.default_rng(3)
    need = projections.least_count(projections.COSINE)
    half = projections.HALF_WINDOW * np.sqrt(2 - 2 * projections.COSINE)
    difference = r.normal(0, np.sqrt(2 - 2 * projections.COSINE), (20_000, projections.PROJECTIONS))
    assert ((np.abs(difference) <= half).sum(axis=1) >= need).mean() >= projections.COUNT_RECALL - 0.002
    assert projections.tables(0, projections.COSINE) == 1


def test_fingerprints(spark):
    r = random.Random(9)
    rows = [(i * 3, " ".join(f"w{int(r.paretovariate(0.6)) % 300}" for _ in range(r.randrange(60)))) for i in range(150)]
    rows += [(1000, rows[5][1]), (1001, None), (1002, ""), (1003, "é😀" * 9), (1004, "WORD " * 2000)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, next int").repartition(5)
    got = {x.doc_id: x for x in imatch.fingerprints(df).collect()}
    order = sorted(rows, reverse=True, key=lambda x: x[0])
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        assert got[i].n_chars == len(t)
        edited = t[:len(t) - half] + following[:half]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
        assert (got[i].fingerprint == got[i].edited_fingerprint) == (got[i].near_edited == 1)
    assert got[1000].fingerprint == got[15].fingerprint
    assert len({got[i].fingerprint for i, _ in rows[:150]}) > 130
    near = [x.near_edited for x in got.values()]
    assert sum(near) > 3 * sum(x.near_next for x in got.values())
    assert imatch.fingerprints(df.limit(0)).count() == 0


def plain_fingerprints(rows):
    """Fingerprints by their definition: one text after the other, words in Python sets."""
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    h64 = lambda data, seed=42: xxhash.xxh64(data, seed=seed & (1 << 64) - 1).intdigest()

    def terms(text):
        return sorted({signed(h64(w.encode())) for w in re.split(r"[\s!-/:-@\[-`{-~]+", text.lower(), flags=re.ASCII) if w})

    def hashed(values):
        out = 42
        for v in values:
            out = h64((v & (1 << 64) - 1).to_bytes(8, "little"), out)
        return signed(out) if values else None

    def rehashed(t, version):
        return signed(h64(version.to_bytes(4, "little"), h64((t & (1 << 64) - 1).to_bytes(8, "little")))) if version else t >> 20

    df = defaultdict(int)
    for _, text in rows:
        for t in terms(text or ""):
            df[t] += 1
    least, most = max(2, len(rows) * imatch.LOWEST), max(2, len(rows) * imatch.HIGHEST)
    buckets = {t & imatch.BUCKETS - 1 for t, n in df.items() if least <= n <= most}

    def signature(text):
        every = terms(text)
        own = [t for t in every if t & imatch.BUCKETS - 1 in buckets] or every
        parts = [hashed(own)]
        for version in range(imatch.VERSIONS):
            left = [rehashed(t, version) for t in own]
            for k in range(imatch.RATES):
                left = [x for x in left if not x >> k & 1]
                parts.append(hashed(left))
        return parts

    def printed(parts):
        return ".".join("-" if x is None else f"{x & (1 << 64) - 1:x}" for x in parts)

    def likeness(a, b):
        some = [(x, y) for x, y in zip(a, b) if x is not None or y is not None]
        return sum(x == y for x, y in some) / len(some) if some else 1.0

    order = sorted(rows, reverse=True)
    out = {}
    for k, (i, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        own, edited = signature(text), signature(text[:len(text) - half] + following[:half])
        out[i] = (printed(own), printed(edited), likeness(own, edited), likeness(own, signature(following)))
    return out


def test_fingerprints_equal_the_plain_version(spark):
    r = random.Random(31)
    rows = [(i * 7, " ".join(f"Wort{int(r.paretovariate(0.5)) % 400}{r.choice(['', '', ',', '. é', '-x'])}" for _ in range(r.randrange(80)))) for i in range(120)]
    rows += [(5001, None), (5002, ""), (5003, "... ,;"), (5004, "only_here"), (5005, rows[3][1]), (5006, "É 日本 語\u00a0x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {x.doc_id: (x.fingerprint, x.edited_fingerprint, x.near_edited, x.near_next) for x in imatch.fingerprints(df).collect()}
    want = plain_fingerprints(rows)
    assert set(got) == set(want)
    for i in want:
        assert got[i][:2] == want[i][:2] and got[i][2:] == pytest.approx(want[i][2:]), i


def test_fingerprints_with_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "a b"), (None, "c d"), (2, "e f"), (2, "e f"), (1, "g h")], "doc_id long, text string")
    got = sorted(((x.doc_id, x.edited_sha256) for x in imatch.fingerprints(df).collect()), key=str)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == sorted([(2, sha("e e")), (2, sha("e g")), (1, sha("g a")), (None, sha("a c")), (None, sha("c e"))], key=str)
