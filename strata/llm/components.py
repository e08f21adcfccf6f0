"""Connected components by alternating large-star and small-star rounds.

Each round links every vertex to the smallest of its neighbours, once for the
larger neighbours and once for the smaller ones, until all that is left is a
star around the smallest vertex of every component.  The number of edges never
grows, and the number of rounds is logarithmic in practice.  The edges of a
round are a written table, so a lost executor costs no earlier round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strata.llm.store import saved


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    if larger:
        both = edges.union(edges.select("v", "u")).distinct()
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    near = both.join(least, "u")
    if larger:
        return near.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    ends = near.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return ends.union(least.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v"))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component): the smallest vertex reachable, for every vertex of an edge table (u, v).

    Vertices are of any orderable type; self-loops, repeated and reversed
    edges are allowed, edges with a null end are ignored.  A vertex whose only
    edges are self-loops does not appear.
    """
    state = edges.select("u", "v").where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    state = saved(state.distinct(), "edges")
    before = _mark(state)
    while before[0]:
        state = saved(_star(_star(state, True), False).distinct(), "edges")
        now = _mark(state)
        if now == before:
            break
        before = now
    return (state.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
            .union(state.select("v", "v").distinct()))
