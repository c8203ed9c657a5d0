"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def components(links: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node with a link; root is the component's smallest node.

    Alternating stars: in the large step every node links its larger neighbours to its
    smallest one, in the small step its smaller neighbours and itself; links end as
    stars around the roots after about log(n) rounds. Minima are pre-aggregated, and the
    joins are plain equi-joins that adaptive execution splits at hot nodes. Each
    round's links are written to the shared folder.
    """
    spark = links.sparkSession
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    now = staged(spark, links.select(u, v).filter("u <> v").distinct(), "links")
    mark = _mark(now)
    for _ in range(max_rounds):
        if mark[0] == 0:
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(
            F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").filter("u <> v").distinct())
        now = staged(spark, small, "links")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
