"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.session import materialize


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) of longs to (node, root): every node of a link with the
    smallest node it can reach. Alternates large-star and small-star steps;
    each is a minimum per node (combined before the shuffle) and a join, and
    each round's links are written to the shared folder."""
    edges = materialize(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links")
    seen = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))))
        edges = materialize(small.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                            .distinct(), "links")
        state = edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
        if state == seen:
            break
        seen = state
    roots = edges.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
