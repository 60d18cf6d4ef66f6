"""I-Match document fingerprints, with DataFrame functions only.

A document is its set of distinct words.  Words whose document frequency lies
in a band (neither everywhere nor nearly nowhere) form the lexicon; the
lexicon words of a document, sorted, are hashed once as a whole and once for
each of several randomised subsets of the lexicon.  A small change of the text
leaves the hashes of those subsets alone that hold none of the changed words,
so the share of equal hashes tells how alike two documents are.

The lexicon is kept as a bitmap of 2**20 word-hash buckets, 128 KiB whatever the
corpus: it reaches the tasks as a literal of the plan, and documents
are never joined with it or regrouped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import ensure_checkpoint_dir

#: Band of document frequencies, as shares of all documents.  Words are kept
#: from LOWEST (and 2 documents at least) to HIGHEST.
LOWEST, HIGHEST = 1 / 1000, 1 / 10
#: Lexicon buckets (a power of two).
BUCKETS = 1 << 20
#: Randomised subsets: for each of VERSIONS hashes of a word a chain of RATES
#: subsets, each half of the one before (2**-1 to 2**-RATES of the lexicon).
VERSIONS, RATES = 12, 8


def _terms(text: Column) -> Column:
    """Hashes of the distinct words (letters and digits, lower case), sorted."""
    words = F.filter(F.split(F.lower(text), r"[\s\p{Punct}]+"), lambda w: w != "")
    return F.array_sort(F.array_distinct(F.transform(words, lambda w: F.xxhash64(w))))


def lexicon(docs: DataFrame, lowest: float = LOWEST, highest: float = HIGHEST) -> DataFrame:
    """One row with ``bitmap``: an array of longs with a bit for each bucket
    that holds a word of the band."""
    total = F.lit(docs.count())
    counted = docs.select(F.explode(_terms(F.col("text"))).alias("t")).groupBy("t").agg(F.count("*").alias("df"))
    band = counted.where(F.col("df").between(F.greatest(F.lit(2), total * lowest), F.greatest(F.lit(2), total * highest)))
    bucket = F.col("t").bitwiseAND(BUCKETS - 1)
    words = band.select(F.shiftright(bucket, 6).cast("int").alias("i"), F.expr("shiftleft(1L, cast(t & 63 as int))").alias("w"))
    every = docs.sparkSession.range(BUCKETS // 64).select(F.col("id").cast("int").alias("i"), F.lit(0).cast("long").alias("w"))
    filled = words.unionByName(every).groupBy("i").agg(F.bit_or("w").alias("w"))
    return filled.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "w"))), lambda x: x["w"]).alias("bitmap"))


def _in_band(terms: Column, bitmap: Column) -> Column:
    """The lexicon words; all words where a text has none of the lexicon."""
    kept = F.filter(terms, lambda t: F.getbit(F.get(bitmap, F.shiftright(t.bitwiseAND(BUCKETS - 1), 6).cast("int")), t.bitwiseAND(63).cast("int")) == 1)
    return kept


def _signature(docs: DataFrame, text: str, bitmap: Column, name: str) -> DataFrame:
    """Adds ``name``: an array with the hash of the whole selection and of each
    subset, null where nothing is selected."""
    out = docs.withColumn("_all", _terms(F.col(text))).withColumn("_own", _in_band(F.col("_all"), bitmap))
    out = out.withColumn("_own", F.when(F.size("_own") > 0, F.col("_own")).otherwise(F.col("_all"))).drop("_all")

    def rehashed(v: int):
        return lambda t: F.xxhash64(t, F.lit(v)) if v else F.shiftright(t, 20)  # the low bits of t choose the bucket

    def chosen(bit: int):
        return lambda t: F.shiftright(t, bit).bitwiseAND(1) == 0

    def hashed(selected: str) -> Column:
        return F.when(F.size(selected) > 0, F.xxhash64(selected))

    # each step halves all chains and hashes what the last step left
    out = out.withColumns({f"_v{v}": F.transform("_own", rehashed(v)) for v in range(VERSIONS)})
    for k in range(RATES):
        out = out.withColumns({f"_v{v}": F.filter(f"_v{v}", chosen(k)) for v in range(VERSIONS)}
                              | {f"_h{v}_{k - 1}": hashed(f"_v{v}") for v in range(VERSIONS) if k})
    parts = [hashed("_own"), *(F.col(f"_h{v}_{k}") if k < RATES - 1 else hashed(f"_v{v}") for v in range(VERSIONS) for k in range(RATES))]
    return out.withColumn(name, F.array(*parts)).drop("_own", *[f"_v{v}" for v in range(VERSIONS)], *[f"_h{v}_{k}" for v in range(VERSIONS) for k in range(RATES)])


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets that select something from
    either text; 1 for equal signatures, also where nothing is selected."""
    both = F.arrays_zip(a.alias("x"), b.alias("y"))
    some = F.size(F.filter(both, lambda p: p["x"].isNotNull() | p["y"].isNotNull()))
    same = F.size(F.filter(both, lambda p: F.coalesce(p["x"] == p["y"], F.lit(False))))
    return F.when(some == 0, F.lit(1.0)).otherwise(same / some)


def _printed(signature: Column) -> Column:
    return F.array_join(F.transform(signature, lambda h: F.coalesce(F.lower(F.hex(h)), F.lit("-"))), ".")


def _next_rows(docs: DataFrame, sign: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Adds ``own`` (by ``sign``) and ``next``, a struct of text and ``own`` of the next document in descending
    ``doc_id`` (ties by text; null ids last; the first follows the last).

    Documents are dealt into ranges of ids whose limits come from approximate
    quantiles; inside a range a window finds the next row, and the last row of a
    range takes the first of the next, from a table with one row a range."""
    spark = docs.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    limits = docs.select(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 20 * ranges)).first()[0] or []
    limits = sorted(set(limits))
    step = max(1, int(len(limits) ** 0.5))
    array = lambda xs: F.split(F.lit(",".join(map(str, xs))), ",").cast("array<bigint>") if xs else F.array().cast("array<bigint>")
    # the range's number: how many limits lie below the id, counted coarsely and then finely
    below = lambda xs: F.size(F.filter(xs, lambda x: x < F.col("doc_id")))
    coarse = below(array(limits[::step]))
    fine = below(F.slice(array(limits), (F.col("_c") - 1) * step + 1, F.lit(step))) if limits else F.lit(0)
    placed = (docs.withColumn("_c", F.greatest(coarse, F.lit(1))).withColumn("_range", F.when(F.col("doc_id").isNotNull(), (F.col("_c") - 1) * step + fine).otherwise(-1))
              .drop("_c"))
    inside = Window.partitionBy("_range").orderBy(F.desc_nulls_last("doc_id"), "text")
    rows = sign(placed).withColumn("next", F.lead(F.struct("text", "own")).over(inside))

    # the first row of each range, and of which range it is the continuation
    tops = placed.groupBy("_range").agg(F.max("doc_id").alias("top"))
    order = Window.orderBy(F.desc("_range"))
    before = F.coalesce(F.lag("_range").over(order), F.first("_range").over(Window.orderBy("_range")))
    tops = tops.select("_range", "top", before.alias("_before")).checkpoint()
    firsts = (placed.join(F.broadcast(tops.withColumnRenamed("_range", "_r")), F.col("_range").eqNullSafe(F.col("_r")) & F.col("doc_id").eqNullSafe(F.col("top")))
              .groupBy("_before").agg(F.min("text").alias("text")).checkpoint())
    firsts = sign(firsts).select(F.col("_before").alias("_range"), F.struct("text", "own").alias("_first"))
    return (rows.join(F.broadcast(firsts), "_range", "left")
            .withColumn("next", F.coalesce("next", "_first")).drop("_range", "_first"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next`` of every row of ``docs(doc_id, text)``.

    The edited text has the last half of its code points replaced by as many
    from the start of the next document.  Null texts count as empty; equal texts
    have equal fingerprints; other columns are not read."""
    ensure_checkpoint_dir(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # of fixed size, so it may pass through the driver
    bits = lexicon(docs).first()["bitmap"]
    bitmap = F.split(F.lit(",".join(map(str, bits))), ",").cast("array<bigint>")
    rows = _next_rows(docs, lambda rows: _signature(rows, "text", bitmap, "own"))
    half = F.floor(F.length("text") / 2).cast("int")
    rows = (rows.withColumn("n_chars", F.length("text").cast("long"))
            .withColumn("edited", F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next.text", F.lit(1), half)))
            .select("doc_id", "n_chars", "own", F.col("next.own").alias("next_own"), "edited"))
    rows = _signature(rows, "edited", bitmap, "changed")
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), _printed(F.col("own")).alias("fingerprint"),
                       _printed(F.col("changed")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("changed")).alias("near_edited"),
                       likeness(F.col("own"), F.col("next_own")).alias("near_next"))
