"""Lookups of large dimensions against plain loops, and their plans."""

import bisect
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from starloom.operators import facts as FX
from starloom.operators import lookup
from starloom.operators import scd2
from starloom.plans.scenario import Warehouse
from starloom.sources import readers

DAY = dt.date(2000, 1, 1)
day = lambda n: DAY + dt.timedelta(days=n)


@pytest.fixture
def no_broadcast(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def carried(spark, versions, lines, hot=None):
    v = spark.createDataFrame(versions, "m string, since date, until date, key long")
    x = spark.createDataFrame(lines, "m string, day date, n int")
    out = lookup.carry_forward(x, v, ["m"], "day", "since", "until", "key", hot)
    assert out.columns == ["m", "day", "n", "key"]
    return sorted(map(tuple, out.collect()))


@pytest.mark.parametrize("seed", range(3))
def test_each_line_gets_the_version_of_its_day(spark, seed):
    """Gaps, days before the first version, same-day rounds, repeated lines."""
    r = random.Random(seed)
    versions, key = [], 0
    for m in "abcd":
        at = r.randrange(20)
        for _ in range(r.randrange(6)):
            end = at + r.randrange(-1, 30)
            versions.append((m, day(at), day(end), key := key + 1))
            at = max(at, end + 1) + r.choice([0, 0, 5])
    lines = [(r.choice("abcde"), day(r.randrange(150)), r.randrange(3)) for _ in range(300)]
    want = sorted((m, d, n, k) for m, d, n in lines for w, since, until, k in versions if w == m and since <= d <= until)
    hot = spark.createDataFrame([("a",), ("e",)], "_hot string")
    assert carried(spark, versions, lines) == want
    assert carried(spark, versions, lines, hot) == want
    assert carried(spark, versions, [], hot) == [] == carried(spark, [], lines, hot)


def test_a_member_with_ten_thousand_versions(spark):
    n = 10_000
    versions = [("a", day(3 * k), day(3 * k + 1), k) for k in range(n)]  # every third day has none
    lines = [("a", day(k), 0) for k in range(0, 3 * n, 7)]
    want = [("a", d, 0, (d - DAY).days // 3) for _, d, _ in lines if (d - DAY).days % 3 < 2]
    assert carried(spark, versions, lines) == want
    starts = [v[1] for v in versions]
    assert all(versions[bisect.bisect_right(starts, d) - 1][3] == k for _, d, _, k in want)


def test_carried_lookup_has_no_interval_in_a_join(spark, no_broadcast):
    w = Warehouse(spark, SF_SMALL)
    inter, dims = FX.intermediate_fact(w.src), w.dims_after_scd()
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "_product_from" in next(x for x in plan(FX.resolve_fact_keys(inter, dims, w.p.refresh_as_of)).split("\n") if "Join" in x and "_product_from" in x)
    carried_plan = plan(FX.resolve_fact_keys(inter, dims, w.p.refresh_as_of, carried=("product",)))
    assert not [x for x in carried_plan.split("\n") if "Join" in x and "_product_" in x] and "Window" in carried_plan


def test_hot_members_are_found_and_bounded(spark):
    lines = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit("warm"))
                                       .when(F.col("id") % 7 == 1, F.lit(None).cast("string")).otherwise(F.concat(F.lit("c"), F.col("id"))).alias("c"))
    assert sorted(r[0] for r in lookup.hot_members(lines, "c", share=0.01).collect()) == ["hot", "warm"]
    assert lookup.hot_members(lines, "c", share=0.0, most=16).count() <= 16
    assert lookup.hot_members(lines.limit(0), "c").count() == 0


def test_lines_of_a_hot_member_are_not_gathered(spark, no_broadcast):
    """With broadcasts off the plain join puts a third of all lines in one
    partition; the split one doesn't, and neither does the carried one."""
    n = 30_000
    lines = spark.range(n, numPartitions=8).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
        F.concat(F.lit("c"), F.col("id") % 5000)).alias("c"), F.lit(DAY).alias("day")).checkpoint()
    dim = lines.select(F.col("c").alias("name")).distinct().withColumn("key", F.xxhash64("name")).checkpoint()
    largest = lambda df: df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        plain = lines.join(dim, lines.c == dim.name).select("id", "c", "day", "key")
        split = lookup.split_lookup(lines, dim, "c", "name")
        versions = dim.select(F.col("name").alias("c"), F.lit(DAY).alias("since"), F.lit(day(9)).alias("until"), "key")
        carry = lookup.carry_forward(lines, versions, ["c"], "day", "since", "until", "key", lookup.hot_members(lines, "c"))
        assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()
        assert carry.select(*plain.columns).exceptAll(plain).isEmpty() and carry.count() == n
        assert largest(plain) > n / 3 > 3 * max(largest(split), largest(carry))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_only_differing_ranges_are_compared(spark):
    rows = [(f"C{i}", f"name {i}", None if i % 9 == 0 else str(i)) for i in range(2000)]
    dim = spark.createDataFrame([(i, *r, "C") for i, r in enumerate(rows)] + [(9999, "C5", "old", "5", "N")],
                                "Customer_Key long, CustomerID string, CustomerName string, CustomerZip string, CurrentStatus string")
    source = lambda rs: spark.createDataFrame(rs, "CustomerID string, CustomerName string, CustomerZip string")
    key, tracked = ["CustomerID"], ["CustomerName", "CustomerZip"]
    assert scd2.differing_ranges(source(rows), dim, key, tracked).isEmpty()  # nothing goes on to the join
    edits = {7: ("C7", "other", "7"), 8: ("C8", "name 8", "x"), 9: ("C9", "name 9", "new")}  # 9 was NULL: no difference
    changed = source([edits.get(i, r) for i, r in enumerate(rows)] + [("NEW", "n", "z")])
    found = scd2.differing_ranges(changed, dim, key, tracked)
    assert found.count() == 4
    assert scd2.in_ranges(changed, key, found).count() < 20
    want = sorted(map(tuple, scd2.detect(changed, dim, key, tracked).collect()))
    assert sorted(map(tuple, scd2.detect_by_digest(changed, dim, key, tracked).collect())) == want == [("C7",), ("C8",)]


def test_swapped_nulls_are_seen_by_the_digest(spark):
    dim = spark.createDataFrame([("a", None, "x", "C")], "k string, p string, q string, CurrentStatus string")
    rows = spark.createDataFrame([("a", "x", None)], "k string, p string, q string")
    assert scd2.differing_ranges(rows, dim, ["k"], ["p", "q"]).count() == 1


def test_every_undated_table_is_read_in_parts_by_the_database(spark):
    plan = readers.jdbc_plan(dt.date(2020, 1, 1), dt.date(2025, 1, 1), dt.date(2024, 12, 31), 16)
    assert plan["soldvia"]["table"] == "(SELECT l.* FROM soldvia l JOIN salestransaction t ON t.tid = l.tid WHERE t.tdate > DATE '2024-12-31') q"
    assert plan["rentvia"]["table"].startswith("(SELECT l.* FROM rentvia l JOIN rentaltransaction t ")
    assert plan["salestransaction"]["column"] == "tdate" and "2024-12-31" in plan["salestransaction"]["table"]
    assert {n for n, how in plan.items() if len(how) == 1} == {"region", "vendor", "category"}
    for name, (key, _) in readers.UNDATED.items():
        assert len(plan[name]["predicates"]) == 16 and all(key in p for p in plan[name]["predicates"])
    whole = readers.jdbc_plan(dt.date(2020, 1, 1), dt.date(2025, 1, 1))
    assert whole["soldvia"]["table"] == "soldvia" and len(whole["soldvia"]["predicates"]) == 64


def test_hash_parts_cover_every_row_once(spark):
    rows = spark.range(500).select(F.concat(F.lit("T"), F.col("id")).alias("tid")).unionByName(spark.createDataFrame([(None,)], "tid string"))
    parts = [rows.filter(p.replace("CRC32(tid)", "crc32(tid)")).count() for p in readers.hash_predicates("tid", 8)]
    assert sum(parts) == 501 and min(parts) > 30
