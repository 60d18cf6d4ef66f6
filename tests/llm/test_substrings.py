"""Passages removed, against a comparison of every window with every earlier one."""

import hashlib
import random

import pytest

from starloom.llm import substrings

SCHEMA = "doc_id long, text string"


def plain(rows):
    firsts, worded = {}, []
    for i, text in rows:
        w = substrings.WORD.findall(text or "")
        worded.append((i, w))
        for k in range(len(w) - 49) if i is not None else ():
            key = tuple(w[k:k + 50])
            firsts[key] = min(firsts.get(key, i), i)
    out = []
    for i, w in worded:
        gone = {j for k in range(len(w) - 49) if i is not None and firsts[tuple(w[k:k + 50])] < i for j in range(k, k + 50)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def texts(seed, n=150):
    r = random.Random(seed)
    word = lambda: r.choice(["the", "The", "of", "é"]) if r.random() < 0.3 else f"w{r.randrange(3000)}"
    some = lambda k: [word() for _ in range(k)]
    passages = [some(k) for k in (49, 50, 51, 90, 300, 700)]
    loop = some(3) * 60
    out, earlier = [], []
    for _ in range(n):
        w = some(r.randrange(120))
        for _ in range(r.randrange(3)):
            p = r.choice([*passages, loop])
            a = r.randrange(len(p) // 3 + 1)
            w += p[a:len(p) - r.randrange(len(p) // 3 + 1)] + some(r.randrange(30))
        if earlier and r.random() < 0.3:
            w = list(r.choice(earlier))
            for _ in range(r.randrange(4)):
                if w:
                    w[r.randrange(len(w))] = word()
        earlier.append(w)
        out.append(r.choice([" ", "\n", "  \t"]).join(w))
    return out


@pytest.mark.parametrize("seed,shard", [(1, 512), (2, 512), (3, 3), (4, 0)])
def test_digests_equal_the_plain_comparison(spark, monkeypatch, seed, shard):
    """With shards of 3 pieces most, and of none all, go by single windows."""
    monkeypatch.setattr(substrings, "SHARD_PIECES", shard)
    rows = list(enumerate(texts(seed)))
    random.Random(seed).shuffle(rows)
    rows += [(3, rows[0][1]), (3, rows[0][1]), (None, rows[1][1]), (500, None), (501, ""), (502, " \n "), (-7, rows[2][1])]
    docs = spark.createDataFrame([(*x, 1, "p") for x in rows], SCHEMA + ", start int, piece string").repartition(4)
    got = substrings.repeat_digests(docs)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    want = plain(rows)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert sum(x[2] for x in want) > 1000


def test_a_passage_in_every_text_and_one_very_long_text(spark):
    """The passage's edges give an anchor a different piece in every document."""
    r = random.Random(9)
    passage = [f"p{i}" for i in range(130)]
    rows = [(i, " ".join([f"a{r.randrange(10 ** 6)}" for _ in range(60)] + passage + [f"b{r.randrange(10 ** 6)}" for _ in range(60)])) for i in range(700)]
    long = [f"l{i}" for i in range(120_000)]
    rows += [(800, " ".join(long)), (801, " ".join(["x", *long[50_000:], "y"])), (802, "same " * 30_000), (803, "same " * 200)]
    assert sorted(map(tuple, substrings.repeat_digests(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr) == plain(rows)


def test_texts_and_spans(spark):
    p = [f"p{i}" for i in range(60)]
    rows = [(1, " ".join(["a", *p, "b"])), (2, " ".join(["c", *p, "d", *p[5:58]])), (3, None), (4, " ".join(p[:49]))]
    got = {r["doc_id"]: (r["text"], [tuple(s) for s in r["removed"]]) for r in substrings.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: (rows[0][1], []), 2: ("c d", [(1, 61), (62, 115)]), 3: ("", []), 4: (rows[3][1], [])}
    assert substrings.repeat_digests(spark.createDataFrame(rows, SCHEMA).limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_automaton_matches_every_stretch_and_no_other(seed):
    r = random.Random(seed)
    sequences = [[r.choice("abc") for _ in range(r.randrange(1, 40))] for _ in range(8)]
    automaton = substrings.SuffixAutomaton()
    for s in sequences:
        automaton.add(s)
    for least in (1, 3, 6):
        known = {tuple(s[i:i + least]) for s in sequences for i in range(len(s) - least + 1)}
        q = [r.choice("abcd") for _ in range(200)]
        assert automaton.matches(q, least) == [i for i in range(201 - least) if tuple(q[i:i + least]) in known]
