"""Connected components of a link table, as alternating star contractions.

Each round replaces the links by shorter ones: first every node hands its
larger neighbours to its smallest neighbour, then its smaller ones.  The links
end as stars whose centre is the smallest node.  A node with very many links
is not gathered anywhere: its smallest neighbour is a pre-aggregated minimum,
and the join that hands it out can be split by Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

MAX_ROUNDS = 100


def _star(links: DataFrame) -> DataFrame:
    """(u, v), u > v -> the links handed to each u's smallest neighbour."""
    least = materialize(links.groupBy("u").agg(F.min("v").alias("m")), "least")
    handed = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return handed.unionByName(least.select("u", F.col("m").alias("v")))


def _large(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) for every node with a link to another node.

    ``component`` is the smallest node that can be reached.  Null ends, loops
    and repeated links are ignored; no links give an empty table.
    """
    links = (edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"))
             .where(F.col(src).isNotNull() & F.col(dst).isNotNull() & (F.col(src) != F.col(dst)))
             .distinct())
    links = materialize(links, "links")
    mark = _mark(links)
    for _ in range(MAX_ROUNDS):
        if not mark[0]:
            break
        links = materialize(_star(materialize(_large(links).distinct(), "links")).distinct(), "links")
        new = _mark(links)
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError(f"links did not settle in {MAX_ROUNDS} rounds")
    centres = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(centres)
