"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.tables import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over (u, v) with u > v: the neighbours that take part are joined to the least of u and its neighbours."""
    back = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    around = edges.unionByName(back) if large else edges
    least = around.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("m", "u").alias("m"))
    joined = around.join(least, F.col("u") == F.col("w"))
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("w").alias("u"), F.col("m").alias("v")))
    return out.filter("u > v").distinct()


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b) of longs; root is the component's least node."""
    flat = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct()
    flat, last = stored(flat, f"{label}-edges"), None
    while True:  # every step but the last shortens some path to a least node
        sums = flat.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if (sums.n, sums.x) == last or not sums.n:
            roots = flat.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return flat.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
        last = (sums.n, sums.x)
        flat = stored(_star(_star(flat, True), False), f"{label}-edges")
