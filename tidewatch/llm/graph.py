"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.union(edges.selectExpr("v AS u", "u AS v")) if large else \
        edges.selectExpr("greatest(u, v) AS u", "least(u, v) AS v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m")
    linked = both.join(least, "u")
    if large:
        out = linked.where("v > u").selectExpr("v AS u", "m AS v")
    else:
        out = linked.where("v <> m").selectExpr("v AS u", "m AS v").union(
            least.selectExpr("u", "m AS v"))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) long pairs in, one row (node, root) per linked node out; ``root`` is the
    smallest node reachable. Every round is written to the shared folder; only its row
    count and checksum reach the driver."""
    cur = cut(edges.where("u <> v").selectExpr("greatest(u, v) AS u", "least(u, v) AS v").distinct(),
              "edges")
    seen = None
    while True:
        cur = cut(_star(_star(cur, True), False), "stars")
        mark = tuple(cur.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())
        if mark == seen:
            return cur.selectExpr("u AS node", "v AS root")
        seen = mark
