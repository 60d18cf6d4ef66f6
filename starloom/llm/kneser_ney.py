"""Quality classifier: perplexity under interpolated modified Kneser-Ney models.

For each language a character 4-gram model is trained on the text of all
documents labelled as good.  Counts, continuation counts, context totals and
probabilities are Spark tables keyed by n-gram and joined by context and by suffix,
each join sharded by its key.  The finished table is cut into shards of bounded
size by language and last context character; documents meet one shard after the
other in a single pass (no document is shuffled), and each shard adds the log
probabilities of the characters it knows the contexts of.  A document is kept
if its perplexity lies between language-specific bounds, which come from
quantiles of the trusted documents.

An n-gram is a long of 16 bits a character (characters beyond U+FFFF count as
U+FFFD); texts are preceded by line ends.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.steps import holds, maybe_among, settle

ORDER = 4
#: Rows of the model that a shard holds on average.
SHARD_ROWS = 2_000_000
#: Bounds: these quantiles of the trusted documents' entropy (in nats a
#: character), moved out by MARGIN times their distance from the median.
LOW, HIGH, MARGIN = 0.01, 0.99, 1.0
#: A text counts as this many characters longer, at its language's mean
#: entropy, so that the noise of short texts doesn't reject them.
SHRINK = 200
#: Languages whose bounds are broadcast at most; more are joined.
MOST_LANGUAGES = 10_000
#: Ids of trusted documents that are broadcast at most (some 50 MB); more are
#: joined, after a bitmap has sorted out most other documents.
MOST_IDS = 1_000_000

_MASK = [(1 << 16 * k) - 1 for k in range(ORDER + 1)]


def grams(text: str) -> np.ndarray:
    """The 4-gram that ends at each character."""
    c = np.frombuffer(("\n" * (ORDER - 1) + text).encode("utf-32-le"), np.uint32)
    c = np.where(c > 0xFFFF, 0xFFFD, c).astype(np.uint64)
    n = len(c) - ORDER + 1
    out = np.zeros(n, np.uint64)
    for k in range(ORDER):
        out = out << np.uint64(16) | c[k:k + n]
    return out


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
    keys, at = np.unique(keys, return_inverse=True)
    return keys, np.bincount(at, counts, len(keys)).astype(np.int64)


def count_grams(texts: DataFrame) -> DataFrame:
    """``lang, gram, n`` of ``texts(lang, text)``: counted inside each task first."""

    def run(batches):
        holds("quality")
        done: dict[str, list] = {}
        waiting: dict[str, list] = {}
        size: dict[str, int] = {}

        def flush(lang):
            if waiting.get(lang):
                keys, n = np.unique(np.concatenate(waiting[lang]), return_counts=True)
                done.setdefault(lang, []).append((keys, n))
                waiting[lang], size[lang] = [], 0
                if len(done[lang]) > 8:
                    done[lang] = [_merged(done[lang])]

        def rows(lang):
            keys, n = _merged(done.pop(lang))
            for i in range(0, len(keys), 65_536):
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys[i:i + 65_536]), pa.string()), pa.array(keys[i:i + 65_536].view(np.int64)), pa.array(n[i:i + 65_536])], ["lang", "gram", "n"])

        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text")):
                g = grams(text.as_py() or "")
                waiting.setdefault(lang, []).append(g)
                size[lang] = size.get(lang, 0) + len(g)
                if size[lang] > 1_000_000:
                    flush(lang)
                    if done[lang][0][0].size > 4_000_000:  # a task holds so many n-grams at most
                        yield from rows(lang)
        for lang in list(waiting):
            flush(lang)
        for lang in list(done):
            yield from rows(lang)

    return texts.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _low(gram: Column, k: int) -> Column:
    """The last ``k`` characters."""
    return gram if k >= ORDER else gram.bitwiseAND(F.lit(_MASK[k]).cast("long"))


def train(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From 4-gram counts: ``lang, k, gram, p`` for each order, and
    ``lang, k, ctx, g``, the weight that a context leaves to the next shorter one."""
    orders = {ORDER: settle(counts)}
    for k in range(ORDER - 1, 0, -1):  # below, an n-gram counts the characters it follows
        orders[k] = settle(orders[k + 1].groupBy("lang", _low(F.col("gram"), k).alias("gram")).agg(F.count("*").alias("n")))
    probabilities, weights, shorter = [], [], None
    for k in range(1, ORDER + 1):
        table = orders[k].withColumn("ctx", F.expr("shiftrightunsigned(gram, 16)"))
        n_of = lambda i: F.sum((F.col("n") == i).cast("double"))
        # three discounts a language, from the numbers of n-grams seen 1 to 4 times
        seen = orders[k].groupBy("lang").agg(*[n_of(i).alias(f"c{i}") for i in (1, 2, 3, 4)], F.count("*").alias("types"))
        y = F.col("c1") / (F.col("c1") + 2 * F.col("c2"))
        d = [F.when((F.col("c1") > 0) & (F.col(f"c{i}") > 0) & (F.col(f"c{i + 1}") > 0),
                    F.greatest(F.lit(0.1), F.least(F.lit(i - 0.1), i - (i + 1) * y * F.col(f"c{i + 1}") / F.col(f"c{i}")))).otherwise(0.5 * min(i, 2)) for i in (1, 2, 3)]
        seen = seen.select("lang", *[x.alias(f"d{i}") for i, x in enumerate(d, 1)], "types")
        context = table.groupBy("lang", "ctx").agg(F.sum("n").alias("total"), n_of(1).alias("n1"), n_of(2).alias("n2"), F.sum((F.col("n") > 2).cast("double")).alias("n3"))
        context = (context.join(seen, "lang").withColumn("g", (F.col("d1") * F.col("n1") + F.col("d2") * F.col("n2") + F.col("d3") * F.col("n3")) / F.col("total")))
        discount = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        own = (F.col("n") - discount) / F.col("total")
        joined = table.join(context, ["lang", "ctx"])
        if k == 1:  # the last weight is shared by all characters seen and one unseen
            model = joined.select("lang", "gram", (own + F.col("g") / (F.col("types") + 1)).alias("p"))
            weights.append(context.select("lang", F.lit(k).alias("k"), "ctx", (F.col("g") / (F.col("types") + 1)).alias("g")))
        else:
            suffix = shorter.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("q"))
            model = (joined.withColumn("suffix", _low(F.col("gram"), k - 1)).join(suffix, ["lang", "suffix"])
                     .select("lang", "gram", (own + F.col("g") * F.col("q")).alias("p")))
            weights.append(context.select("lang", F.lit(k).alias("k"), "ctx", "g"))
        shorter = settle(model)
        probabilities.append(shorter.withColumn("k", F.lit(k)))
    union = lambda xs: functools.reduce(DataFrame.unionByName, xs)
    return union(probabilities), settle(union(weights))


class Shard:
    """Part of a model: for each language and order the sorted n-grams with
    log probabilities, and the sorted contexts with log weights."""

    def __init__(self, number: int, shards: int, p: list[tuple], g: list[tuple]):
        self.number, self.shards = number, shards
        self.tables = {("p", lang, k): self._sorted(keys, v) for lang, k, keys, v in p} | {("g", lang, k): self._sorted(keys, v) for lang, k, keys, v in g}
        self.languages = {lang for _, lang, _ in self.tables}

    @staticmethod
    def _sorted(keys, values):
        order = np.argsort(keys)
        return keys[order], np.log(values[order]).astype(np.float32)

    def _find(self, kind: str, lang: str, k: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own, values = self.tables.get((kind, lang, k), (np.zeros(0, np.uint64), np.zeros(0, np.float32)))
        if not len(own):
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.float32)
        at = np.minimum(np.searchsorted(own, keys), len(own) - 1)
        return own[at] == keys, values[at]

    def log_probability(self, lang: str, text: str) -> float:
        """Of the characters whose last context character is in this shard."""
        g = grams(text)
        if self.shards > 1:
            g = g[shard_of(g >> np.uint64(16) & np.uint64(0xFFFF), self.shards) == self.number]
        g, n = (g, None) if len(g) < 4096 else np.unique(g, return_counts=True)
        out, left, lost = np.zeros(len(g)), np.arange(len(g)), np.zeros(len(g))
        for k in range(ORDER, 0, -1):
            keys = g[left] & np.uint64(_MASK[k])
            known, p = self._find("p", lang, k, keys)
            out[left[known]] = lost[left[known]] + p[known]
            left = left[~known]
            if not len(left):
                break
            seen, weight = self._find("g", lang, k, keys[~known] >> np.uint64(16))
            lost[left] += np.where(seen, weight, 0)
        out[left] = lost[left]  # an unseen character gets the weight that order 1 leaves
        return float(out.sum() if n is None else (out * n).sum())


def shard_of(character, shards: int):
    """The shard of a context's last character (numpy values)."""
    return (character * np.uint64(0x9E3779B1) >> np.uint64(7)) % np.uint64(shards)


def broadcast_shards(p: DataFrame, g: DataFrame) -> list:
    """The model as broadcast shards, each collected by itself and of bounded
    size; orders without a context (one row a character) go with each."""
    spark = p.sparkSession
    shards = max(1, -(-(p.count() + g.count()) // SHARD_ROWS))

    languages = [r[0] for r in p.select("lang").distinct().orderBy("lang").collect()]
    number = F.array_position(F.array(*[F.lit(x) for x in languages]), F.col("lang")).cast("int") if languages else F.lit(0)

    def collected(df: DataFrame, value: str, key: str, last: Column, shard: int) -> list[tuple]:
        if shards > 1:
            own = F.pmod(F.shiftright(last * F.lit(0x9E3779B1), 7), F.lit(shards)) == shard
            df = df.where(own | (F.col("k") == 1))
        rows = df.select(number.alias("lang"), "k", key, value).toArrow()  # numbers only: 24 bytes a row
        lang, k, keys, values = (rows[c].to_numpy() for c in ("lang", "k", key, value))
        return [(languages[i - 1], j, keys[own].view(np.uint64), values[own]) for i in range(1, len(languages) + 1) for j in range(1, ORDER + 1)
                if (own := (lang == i) & (k == j)).any()]

    out = []
    for i in range(shards):
        gram_last = F.expr("shiftrightunsigned(gram, 16) & 65535")
        out.append(spark.sparkContext.broadcast(Shard(i, shards, collected(p, "p", "gram", gram_last, i), collected(g, "g", "ctx", F.col("ctx").bitwiseAND(0xFFFF), i))))
    return out


def with_entropy(docs: DataFrame, shards: list) -> DataFrame:
    """Adds ``__kn_lp double``, the log probability of ``text`` under the model of
    ``lang`` (null where the language has none), shard after shard in one pass."""
    docs = docs.withColumn("__kn_lp", F.lit(0.0))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema])
    for shard in shards:

        def run(batches, shard=shard):
            holds("quality")
            s = shard.value
            for b in batches:
                lp = [None if x is None or lang not in s.languages else x + s.log_probability(lang, text or "")
                      for lang, text, x in zip(*(b.column(c).to_pylist() for c in ("lang", "text", "__kn_lp")))]
                yield b.set_column(b.schema.get_field_index("__kn_lp"), "__kn_lp", pa.array(lp, pa.float64()))

        docs = docs.mapInArrow(run, schema)
    return docs


def _model(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, list]:
    """Ids of trusted documents, and the model of their text."""
    trusted = settle(labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long")).distinct())
    few = trusted.count() <= MOST_IDS
    texts = docs.where("lang is not null and doc_id is not null")
    texts = (texts if few else maybe_among(texts, trusted, "doc_id")).join(F.broadcast(trusted) if few else trusted, "doc_id", "left_semi")
    return trusted, broadcast_shards(*train(count_grams(texts.select("lang", "text"))))


def _bounds(scored: DataFrame, trusted: DataFrame) -> DataFrame:
    """For each language the mean and the bounds, in nats a character."""
    known = scored.join(trusted, "doc_id", "left_semi").where("__kn_lp is not null and __kn_n > 0")
    mean = known.groupBy("lang").agg((-F.sum("__kn_lp") / F.sum("__kn_n")).alias("__kn_mean"))
    q = known.join(mean, "lang").groupBy("lang", "__kn_mean").agg(F.percentile_approx(_shrunk(), [LOW, 0.5, HIGH], 10_000).alias("q"))
    return q.select(F.col("lang").alias("__kn_lang"), "__kn_mean", (F.col("q")[0] - MARGIN * (F.col("q")[1] - F.col("q")[0])).alias("__kn_low"), (F.col("q")[2] + MARGIN * (F.col("q")[2] - F.col("q")[1])).alias("__kn_high"))


def _joined(rows: DataFrame, bounds: DataFrame) -> DataFrame:
    """Rows with their language's bounds; these are broadcast if there are few."""
    bounds = settle(bounds)
    bounds = F.broadcast(bounds) if bounds.count() <= MOST_LANGUAGES else bounds
    return rows.join(bounds, F.col("lang") == F.col("__kn_lang"), "left").drop("__kn_lang")


def _shrunk() -> Column:
    return (-F.col("__kn_lp") + SHRINK * F.col("__kn_mean")) / (F.col("__kn_n") + SHRINK)


def _prepared(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, lang, n_chars, perplexity, low, high, kept`` of every row of
    ``docs(doc_id, text, lang)``; ``labels(doc_id, quality)`` marks the trusted.

    Null text counts as empty; empty texts, rows without a language, and languages
    without trusted text are kept with a null perplexity.  A row with a null
    ``doc_id`` is scored but never trusted.  Repeated rows are scored alike; other
    columns are not read."""
    docs = _prepared(docs)
    trusted, shards = _model(docs, labels)
    scored = settle(with_entropy(docs, shards).select("doc_id", "lang", F.length("text").cast("long").alias("__kn_n"), "__kn_lp"))
    out = _joined(scored, _bounds(scored, trusted))
    scores = (F.col("__kn_n") > 0) & F.col("__kn_lp").isNotNull() & F.col("__kn_mean").isNotNull()
    return out.select("doc_id", "lang", F.col("__kn_n").alias("n_chars"), F.when(scores, F.exp(-F.col("__kn_lp") / F.col("__kn_n"))).alias("perplexity"),
                      F.exp("__kn_low").alias("low"), F.exp("__kn_high").alias("high"),
                      F.coalesce(F.when(scores, _shrunk().between(F.col("__kn_low"), F.col("__kn_high"))), F.lit(True)).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that ``classify`` keeps.

    Rows without text (null or empty), and those whose language has no bounds, stay."""
    prepared = _prepared(docs)
    trusted, shards = _model(prepared, labels)
    scored = settle(with_entropy(prepared, shards).select("doc_id", "lang", F.length("text").cast("long").alias("__kn_n"), "__kn_lp"))
    rows = _joined(with_entropy(docs, shards).withColumn("__kn_n", F.length("text")), _bounds(scored, trusted))
    scores = (F.col("__kn_n") > 0) & F.col("__kn_lp").isNotNull() & F.col("__kn_mean").isNotNull()
    return rows.where(F.coalesce(F.when(scores, _shrunk().between(F.col("__kn_low"), F.col("__kn_high"))), F.lit(True))).select(*docs.columns)
