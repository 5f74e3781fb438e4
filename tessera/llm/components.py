"""Connected components by contraction, for edge tables of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored

JUMPS = 2


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): every id that occurs in ``edges`` with the smallest id
    it is connected to. Rows with a null end or equal ends add nothing.

    Each round hooks every component to its smallest neighbour, follows those
    pointers twice, and maps the remaining edges to components, so the edge
    table shrinks fast. Per component only a combined minimum is gathered, and
    joins are plain equi-joins on unique ids, so a hub with a third of all
    edges is no group in any task. Nothing but row counts reaches the driver.
    """
    pairs = stored(edges.where(f"{a} is not null and {b} is not null and {a} <> {b}").select(
        F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).distinct(), "cc-edges")
    labels = stored(pairs.select(F.explode(F.array("lo", "hi")).alias("id")).distinct()
                    .select("id", F.col("id").alias("component")), "cc-labels")
    while not pairs.isEmpty():
        both = pairs.unionByName(pairs.select(F.col("hi").alias("lo"), F.col("lo").alias("hi")))
        hook = both.groupBy(F.col("lo").alias("node")).agg(
            F.least(F.col("lo"), F.min("hi")).alias("to"))
        for k in range(JUMPS):
            hook = stored(hook, f"cc-hook{k}")
            onward = hook.select(F.col("node").alias("to"), F.col("to").alias("further"))
            hook = hook.join(onward, "to").select("node", F.col("further").alias("to"))
        hook = stored(hook, "cc-hook")
        moved = lambda c: hook.select(F.col("node").alias(c), F.col("to").alias(f"{c}_to"))
        labels = stored(labels.join(moved("component"), "component", "left").select(
            "id", F.coalesce("component_to", "component").alias("component")), "cc-labels")
        pairs = stored(pairs.join(moved("lo"), "lo").join(moved("hi"), "hi").select(
            F.least("lo_to", "hi_to").alias("lo"), F.greatest("lo_to", "hi_to").alias("hi"))
            .where("lo <> hi").distinct(), "cc-edges")
    return labels
