"""Connected components of a distributed edge list by repeated local contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import materialize


def _order(c: Column, rnd: int) -> Column:
    # a new random order each round keeps long paths from contracting one step at a time
    return F.struct(F.xxhash64(c, F.lit(rnd)).alias("h"), c.alias("v"))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Map every vertex of ``edges`` (u, v) to a representative vertex of its component.

    Each round maps every vertex to the smallest vertex (in a random order) among itself and
    its neighbours, then rewrites the edges and drops loops and repeats. Neighbour minima are
    plain aggregates with map-side combining, so a vertex with very many neighbours costs one
    row per map task; no neighbour list is ever collected. Edges shrink geometrically.

    Returns (vertex, root), one row per distinct vertex; an empty edge list gives no rows.
    Null ends are ignored.
    """
    live = materialize(edges.select("u", "v").where("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct(), "cc-edges")
    labels = None
    for rnd in range(max_rounds):
        if live.isEmpty():
            break
        both = live.unionByName(live.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min(_order(F.col("v"), rnd)).alias("m"))
        step = materialize(low.select(F.col("u").alias("from"), F.least(F.col("m"), _order(F.col("u"), rnd))["v"].alias("to")), "cc-step")
        if labels is None:
            labels = step.select(F.col("from").alias("vertex"), F.col("to").alias("root"))
        else:
            labels = materialize(
                labels.join(step, labels["root"] == step["from"], "left").select("vertex", F.coalesce("to", "root").alias("root")), "cc-labels")
        a, b = step.select(F.col("from").alias("u"), F.col("to").alias("nu")), step.select(F.col("from").alias("v"), F.col("to").alias("nv"))
        live = materialize(
            live.join(a, "u").join(b, "v").where("nu <> nv")
            .select(F.least("nu", "nv").alias("u"), F.greatest("nu", "nv").alias("v")).distinct(), "cc-edges")
    else:
        raise RuntimeError(f"components did not converge in {max_rounds} rounds")
    if labels is None:
        return live.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
    return labels
