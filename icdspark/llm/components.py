"""Connected components as repeated joins over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icdspark.llm.common import stored


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        links.select(F.col("b").alias("u"), F.col("a").alias("v")))


def roots(links: DataFrame, folder: str) -> DataFrame:
    """``node, root``: the smallest node of each linked node's component; links are ``a, b`` (long).

    Alternates two rewritings of the links until nothing changes.  "Large
    star" points a node's larger neighbours to its smallest one, "small star"
    its smaller ones and itself.  Both keep the components, and the number of
    rounds grows with the logarithm of a component's size.  Each round is a
    grouped minimum (combined before the shuffle) and a join.
    """
    now = stored(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        folder, "links-0")
    step = 0
    while True:
        step += 1
        around = _both_ways(now)
        least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = around.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large, folder, f"large-star-{step}")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        )
        after = stored(small, folder, f"links-{step}")
        if _sums(after) == _sums(now):
            return after.select(F.col("a").alias("node"), F.col("b").alias("root"))
        now = after


def _sums(links: DataFrame) -> tuple:
    """A digest of a set of links: equal sets have equal digests, different ones hardly ever."""
    hashed = F.xxhash64("a", "b")
    row = links.agg(
        F.count("*"), F.coalesce(F.sum(hashed.bitwiseAND(0xFFFFFFFF)), F.lit(0)),
        F.coalesce(F.sum(F.shiftrightunsigned(hashed, 32)), F.lit(0)), F.coalesce(F.expr("bit_xor(xxhash64(b, a))"), F.lit(0)),
    ).first()
    return tuple(row)


def connected(links: DataFrame, nodes: DataFrame, folder: str) -> DataFrame:
    """``node, label`` for all ``nodes`` (``node, label``): the smallest label of the node's component."""
    root = roots(links, folder)
    root = root.unionByName(root.select(F.col("root").alias("node"), "root").distinct())
    members = stored(nodes.join(root, "node"), folder, "members")
    least = stored(members.groupBy("root").agg(F.min("label").alias("least")), folder, "least")
    linked = stored(members.select("node", "root").join(least, "root").select("node", "least"), folder, "linked")
    return nodes.join(linked, "node", "left").select("node", F.coalesce("least", "label").alias("label"))
