"""Lookups of large dimensions: frequent members split off, histories carried.

A dimension that is too large to broadcast is joined by shuffling both sides on
the member.  If one customer or product has a large share of the lines, they all
go to one task.  :func:`hot_members` names the few members with such a share;
:func:`split_lookup` looks these up by a broadcast of their rows only, and
:func:`carry_forward` deals their lines out over several groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Members treated as frequent at most, and items that the sketch follows.
MOST_HOT, SKETCH_ITEMS = 256, 8192
#: A member is frequent from this share of the lines on.
HOT_SHARE = 0.001
#: Groups that the lines of a frequent member are dealt to.
SPREAD = 64


def hot_members(lines: DataFrame, column: str, share: float = HOT_SHARE, most: int = MOST_HOT) -> DataFrame:
    """``_hot``: the members of ``column`` that more than ``share`` of the lines
    have, at most ``most`` rows.  One pass with a frequent-items sketch of fixed
    size in each task: what it gets wrong changes the plan, never the result."""
    top = lines.agg(F.expr(f"approx_top_k({column}, {most}, {SKETCH_ITEMS})").alias("top"), F.count(F.lit(1)).alias("n"))
    return (top.select(F.explode("top").alias("t"), "n").filter(F.col("t.count") > F.col("n") * share)
            .select(F.col("t.item").alias("_hot")).filter(F.col("_hot").isNotNull()))


def split_lookup(lines: DataFrame, dim: DataFrame, column: str, natural: str, hot: DataFrame | None = None) -> DataFrame:
    """``lines ⋈ dim`` on ``lines.column = dim.natural`` (one row a member in
    ``dim``; ``natural`` goes).  Lines of the frequent members meet a broadcast of
    their dimension rows, at most as many as there are frequent members, and are
    not shuffled; the rest is joined as usual.  ``lines`` is read once for the
    sketch and once for each part: pass a stored table."""
    hot = (hot_members(lines, column) if hot is None else hot).withColumnRenamed("_hot", column)
    dim = dim.withColumnRenamed(natural, column)
    few = dim.join(F.broadcast(hot), column, "left_semi")
    often = lines.join(F.broadcast(few), column)
    rest = lines.join(F.broadcast(hot), column, "left_anti").join(dim, column)
    cols = [*lines.columns, *[c for c in dim.columns if c != column]]
    return often.select(*cols).unionByName(rest.select(*cols))


def carry_forward(lines: DataFrame, versions: DataFrame, member: list[str], date: str, since: str, until: str, key: str,
                  hot: DataFrame | None = None, spread: int = SPREAD) -> DataFrame:
    """``lines`` with the ``key`` of the version that holds on ``date``; lines
    without one go.  ``versions(*member, since, until, key)`` doesn't overlap within
    a member (of versions that begin on one day the one that lasts longest counts).

    Lines and versions of a member are sorted together by date, and the last
    version before each line is carried to it: a sort and one pass, whatever the
    number of versions, where a join by interval compares each line with all of
    them.  ``hot`` (column ``_hot``) names values of the first member column with
    very many lines; these are dealt to ``spread`` groups, each with its own copy
    of the member's versions."""
    group = F.lit(0)
    copies = F.array(F.lit(0))
    dealt, rows = versions, lines
    if hot is not None:
        few = F.broadcast(hot)
        rows = lines.join(few, lines[member[0]] == few["_hot"], "left")
        dealt = versions.join(few, versions[member[0]] == few["_hot"], "left")
        group = F.when(F.col("_hot").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(*lines.columns), F.lit(spread)).cast("int"))
        copies = F.when(F.col("_hot").isNull(), copies).otherwise(F.sequence(F.lit(0), F.lit(spread - 1)))
    entry = F.struct(F.col(key).alias("key"), F.col(until).alias("until"))
    events = dealt.select(*member, F.col(since).alias("_at"), F.lit(False).alias("_line"), entry.alias("_version"), F.explode(copies).alias("_group"))
    asked = rows.select(*member, F.col(date).alias("_at"), F.lit(True).alias("_line"), group.alias("_group"), F.struct(*lines.columns).alias("_row"))
    order = Window.partitionBy(*member, "_group").orderBy("_at", "_line", "_version.until", "_version.key").rowsBetween(Window.unboundedPreceding, 0)
    found = (events.unionByName(asked, allowMissingColumns=True)
             .withColumn("_last", F.last("_version", ignorenulls=True).over(order))
             .filter(F.col("_line") & (F.col("_at") <= F.col("_last.until"))))
    return found.select("_row.*", F.col("_last.key").alias(key))


def is_in_bitmap(number: Column, bitmap: Column) -> Column:
    """Whether the bit of ``number`` is set in a bitmap of its bucket."""
    place = F.bitmap_bit_position(number)
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte.cast("long"), (place % 8).cast("int")) == 1
