"""Connected components of a link table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import ensure_checkpoint_dir


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of
    ``links(a, b)``, two long columns; order, loops and repeats don't matter,
    rows with a null are left out.

    Each round hooks every group onto the smallest group it has a link to,
    follows these hooks to their ends, and keeps only the links that still join
    two groups.  At least every second linked group goes in a round or becomes
    the one that others hook onto, so a few rounds do; no round brings links or
    nodes to the driver or gathers a node's links in one place (minima are
    taken map-side, joins have plain shuffles on both sides that can be split)."""
    ensure_checkpoint_dir(links.sparkSession)
    edges = (links.where(F.col("a") != F.col("b"))
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().checkpoint())
    labels = (edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
              .withColumn("component", F.col("node")).checkpoint())
    while not edges.isEmpty():
        hook = _to_the_ends(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("to")).checkpoint())
        labels = (labels.join(hook.select(F.col("node").alias("component"), "to"), "component", "left")
                  .select("node", F.coalesce("to", "component").alias("component")).checkpoint())
        hook_a, hook_b = (hook.select(F.col("node").alias(s), F.col("to").alias(f"to_{s}")) for s in "ab")
        moved = (edges.join(hook_b, "b", "left").join(hook_a, "a", "left")
                 .select(F.coalesce("to_a", "a").alias("a"), F.coalesce("to_b", "b").alias("b")))
        edges = (moved.where(F.col("a") != F.col("b"))
                 .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().checkpoint())
    return labels


def _to_the_ends(hook: DataFrame) -> DataFrame:
    """Hooks always lead to a smaller node: doubling follows each chain to its
    end in log2(length) steps."""
    while True:
        on = hook.select(F.col("node").alias("to"), F.col("to").alias("beyond"))
        longer = hook.join(on, "to", "left").select("node", F.coalesce("beyond", "to").alias("to"), F.col("beyond").isNotNull().alias("went"))
        longer = longer.checkpoint()
        if longer.where("went").isEmpty():
            return longer.drop("went")
        hook = longer.drop("went")
