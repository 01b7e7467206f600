"""Connected components of a table of links, by minimum labels and pointer jumping. Nothing but a count reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stash


def components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """links (a, b long) -> (v, c): for each vertex on a link the smallest vertex that can be reached from it. Copies of a link, loops and nulls are harmless."""
    pairs = links.filter("a IS NOT NULL AND b IS NOT NULL")
    edges = stash(pairs.select("a", "b").union(pairs.select("b", "a")).distinct(), "edges")
    labels = stash(edges.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("c")), "labels")
    for _ in range(rounds):
        # the least label among a vertex and its neighbours, told to the vertex and to its label's vertex (which joins the two trees), ...
        near = edges.join(labels, edges["b"] == labels["v"]).groupBy("a").agg(F.min("c").alias("m"))
        seen = labels.join(near, labels["v"] == near["a"]).select("v", "c", F.least("c", "m").alias("m"))
        told = seen.select("v", "m").union(seen.select("c", "m")).groupBy("v").agg(F.min("m").alias("m"))
        # ... then every vertex takes its label's label
        far = told.select(F.col("v").alias("w"), F.col("m").alias("mm"))
        new = told.join(far, told["m"] == far["w"], "left").select("v", F.least("m", F.coalesce("mm", "m")).alias("c"))
        new = stash(new, "labels")
        moved = new.join(labels.withColumnRenamed("c", "old"), "v").filter("c <> old").limit(1).count()
        labels = new
        if not moved:
            return labels
    raise RuntimeError(f"links did not settle in {rounds} rounds")
