"""Connected components by alternating large and small stars, every round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from contrail.llm.common import dropped, written


def _large(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are tied to the least node near it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the least of them. Edges run from larger to smaller."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    ties = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return ties.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) of every node in an edge: label is the least node reachable. Loops and repeated edges do no harm;
    edges with a null end are left out; no edges give no rows. The rounds end when the edges stay as they are.

    The edges are written before the first round and each round's sums are taken as it is written: what stands below the edges would else be
    planned several times in a round, and a job of its own for the sums costs the driver as much as a round.
    """
    x, y = F.col(a), F.col(b)
    edges = edges.where(x.isNotNull() & y.isNotNull() & (x != y)).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct()
    edges, state = written(edges, "edges"), None
    while True:
        held, sums = edges, Observation()
        edges = written(_small(_large(held)).observe(sums, F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")), "stars")
        dropped(held)
        now = sums.get
        if now["n"] == 0 or now == state:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
