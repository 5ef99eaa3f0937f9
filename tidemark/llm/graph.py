"""Connected components by alternating star contractions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def components(links: DataFrame, put: Callable[[DataFrame, str], DataFrame] = stored) -> DataFrame:
    """``a``, ``b``: linked nodes of any type that has an order. Gives ``node``
    and ``root``, the smallest node reachable, for each node with a link to
    another one.

    Every round hangs a node's neighbours below the smallest node known to it, so
    a long chain halves each time. Rounds are written to the shared folder; what
    comes to the driver is a count and a checksum. ``put`` writes them.
    """
    ends = put(links.filter("a != b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), "links")
    seen = None
    while True:
        mark = ends.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            return ends.selectExpr("a AS node", "b AS root").union(ends.selectExpr("b", "b").distinct())
        seen = mark
        ends = put(_small_star(_large_star(ends)), "links")


def _large_star(ends: DataFrame) -> DataFrame:
    both = ends.union(ends.selectExpr("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a", "least(a, m) AS m")
    return both.join(least, "a").filter("b > a").selectExpr("b AS a", "m AS b").filter("a != b").distinct()


def _small_star(ends: DataFrame) -> DataFrame:
    ends = ends.selectExpr("greatest(a, b) AS a", "least(a, b) AS b")
    least = ends.groupBy("a").agg(F.min("b").alias("m"))
    below = ends.join(least, "a").selectExpr("b AS a", "m AS b")
    return below.union(least.selectExpr("a", "m")).filter("a != b").distinct()
