"""Connected components of a link table, by alternating large-star and small-star steps.

Each step is a partial aggregate (least neighbour of a node) and an equi-join back to the links, so a
star whose centre has a third of all links is split by adaptive skew handling; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _pairs(df: DataFrame, a, b) -> DataFrame:
    return df.select(a.alias("u"), b.alias("v"))


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select(F.explode(F.array(F.struct(F.col("u").alias("a"), F.col("v").alias("b")), F.struct(F.col("v").alias("a"), F.col("u").alias("b")))).alias("x")).select("x.a", "x.b")
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
    return _pairs(both.filter("b > a").join(least, F.col("a") == F.col("k")), F.col("b"), F.col("m"))


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
    rest = e.join(least, F.col("u") == F.col("k")).filter("v <> m")
    return _pairs(rest, F.col("v"), F.col("m")).unionByName(_pairs(least, F.col("k"), F.col("m")))


def components(links: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, root) for every node that has a link; root is the component's least node.

    Links are undirected; repeated links, self links and links with a null end change nothing. Nodes
    are longs. An empty table gives an empty result. Steps go on until one changes nothing; their number grows with the logarithm of the nodes.
    """
    e = links.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).filter(F.col(src).isNotNull() & F.col(dst).isNotNull() & (F.col("u") > F.col("v"))).distinct()
    e = cut(e)
    before = None
    while True:
        mark = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == before:
            break
        before = mark
        e = cut(_small_star(_large_star(e).distinct()).distinct())
    # a star forest: each u points to its root
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
