"""Periodic runs against the definition, checked for every start and period."""

import hashlib
import random
from fractions import Fraction

import pytest

from starloom.llm import periods


def plain_runs(w):
    """Every maximal stretch with period q, for every q, without those that have
    a smaller period."""
    n, found = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= 4 * q:
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items() if e - s >= max(6, 4 * q)), key=lambda r: (r[0], r[2]))


def random_words(r):
    kind = r.randrange(7)
    if kind == 0:
        return [r.choice("ab") for _ in range(r.randrange(200))]
    if kind == 1:  # nested repetition
        w = [r.choice("abc") for _ in range(r.randrange(1, 6))]
        for _ in range(r.randrange(1, 4)):
            w = w * r.randrange(1, 7) + [r.choice("abcd") for _ in range(r.randrange(3))]
        return w[:1500]
    if kind == 2:  # Fibonacci words have many runs
        a, b = ["a"], ["a", "b"]
        while len(b) < 400:
            a, b = b, b + a
        return b * r.randrange(1, 4)
    out = [f"w{r.randrange(300)}" for _ in range(r.randrange(150))]
    for _ in range(r.randrange(1, 5)):
        q = r.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 33, 64, 100, 130])
        part = [r.choice("xy") if r.random() < 0.3 else f"w{r.randrange(300)}" for _ in range(q)]
        if r.random() < 0.4:  # highly periodic inside the period
            part = (part[:2] * q)[:q - 1] + ["end"] if q > 4 else part
        out += (part * 9)[:r.randrange(3 * q, 9 * q)] + [f"w{r.randrange(300)}" for _ in range(r.randrange(40))]
    if r.random() < 0.3:
        at = r.randrange(len(out))
        out[at:] = (out[at:at + 1 + (len(out) - at) // 5] * 6)[:len(out) - at]
    return out


@pytest.mark.parametrize("seed", range(12))
def test_runs_of_many_texts_equal_the_definition(seed):
    r = random.Random(seed)
    texts = [random_words(r) for _ in range(60)]
    for words, runs in zip(texts, periods.runs_of(texts)):
        assert runs == plain_runs(words), words


def test_a_long_text_of_one_word_and_a_long_period():
    assert periods.runs_of([["x"] * 200_000]) == [[(0, 200_000, 1)]]
    part = [f"w{i % 5003}-{i % 7}" for i in range(30_000)]
    assert periods.runs_of([["a"] + part * 5 + ["b"]]) == [[(1, 150_000, 30_000)]]


def test_digests_of_every_kind_of_row(spark):
    r = random.Random(5)
    rows = [(i, " ".join(random_words(r))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " \n\t"), (203, "a  a\na\ta a a"), (203, "a  a\na\ta a a"), (None, "b b b b b b b"),
             (204, "é é é é é é"), (205, "a a a a a a a a a a a a"), (-3, "one two")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n_runs int, period string").repartition(3)
    got = sorted(map(tuple, periods.run_digests(docs).collect()), key=repr)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, text in rows:
        w = periods.plant_run(periods.WORD.findall(text or ""), i)
        runs = plain_runs(w)
        dropped = {k for s, n, q in runs for k in range(s + q, s + n)}
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2])) if runs else None
        want.append((i, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                     sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for k, x in enumerate(w) if k not in dropped))))
    assert got == sorted(want, key=repr)
    assert docs.limit(0).transform(periods.run_digests).count() == 0


def test_planted_end_follows_its_formula():
    import zlib

    words = [f"w{i}" for i in range(50)]
    changed = 0
    for i in range(300):
        h = zlib.crc32(str(i).encode())
        want = list(words)
        if h % 10 == 0:
            changed += 1
            g = h // 10
            a = g % 50
            p = 1 + (50 - a) // (3 + g % 8)
            want = [words[k] if k < a else words[a + (k - a) % p] for k in range(50)]
        assert periods.plant_run(words, i) == want
    assert changed > 10 and periods.plant_run([], 4) == [] and periods.plant_run(words, None) == words


def test_runs_and_collapsed_texts(spark):
    docs = spark.createDataFrame([(1, "so so so so so so it goes"), (2, "p q p q p q p q r"), (3, None)], "doc_id long, text string")
    assert sorted(map(tuple, periods.periodic_runs(docs).collect())) == [(1, 0, 6, 1), (2, 0, 8, 2)]
    assert sorted(map(tuple, periods.collapse_runs(docs).collect())) == [(1, "so it goes"), (2, "p q r"), (3, "")]
