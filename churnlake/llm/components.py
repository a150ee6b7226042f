"""Connected components of a link table as Spark jobs (large-star / small-star).

Each round is two star operations, every one a group minimum (combined map-side)
and a join; the table never holds more than one row per link. The number of
rounds grows with the logarithm of the longest path. Rounds are written to the
shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.llm.common import materialise


def _minima(e: DataFrame) -> DataFrame:
    """(a, m): the smallest neighbour of each node. The key is a fresh
    expression so that the next join shuffles both of its sides plainly and
    adaptive execution can split the rows of a hub."""
    return e.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").bitwiseXOR(F.lit(0)).alias("a"), "m")


def _round(e: DataFrame) -> DataFrame:
    """``e`` holds each link once as (a, b) with a > b."""
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    m = _minima(both).withColumn("m", F.least("a", "m"))
    large = (both.filter("b > a").join(m, "a")
             .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b").distinct())
    low = _minima(large)
    hung = large.join(low, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return (r[0], r[1])


def connected_components(links: DataFrame) -> DataFrame:
    """``links(a long, b long)`` -> ``(node, component)`` for every linked node;
    ``component`` is the smallest node of the component. Self links, repeated
    links and links with a null end are ignored; an empty table gives no rows."""
    e = materialise(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), "components")
    before, now = None, _state(e)
    while now != before:
        e = materialise(_round(e), "components")
        before, now = now, _state(e)
    return (e.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
