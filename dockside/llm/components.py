"""Connected components of an edge table, as rounds of joins and minimum aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from dockside.llm.storage import Scratch


def roots(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``; the root is the smallest node that can be reached.

    Large stars and small stars take turns until the edges no longer change: every node then hangs on its root. The
    number of edges never grows, a node of any degree is summed before it is shuffled, and each round is written to the
    shared folder. Loops and repeated edges are allowed; no edges give no rows.
    """
    edges = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, turn, seen = scratch.keep(edges, "edges-0"), 0, None
    while (now := _mark(edges)) != seen:
        seen, turn = now, turn + 1
        edges = scratch.keep(_large_star(edges, _least(edges, scratch, f"least-{turn}-large")), f"edges-{turn}-large")
        edges = scratch.keep(_small_star(edges, _least(edges, scratch, f"least-{turn}-small")), f"edges-{turn}")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.bit_xor(mixed), F.sum(mixed.cast("decimal(20,0)"))).first())


def _least(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Each larger end's smallest neighbour, as a table: joined straight after the aggregate, a node of high degree could not be split."""
    return scratch.keep(edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("least")), name)


def _large_star(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    moved = both.join(least, both.a == least.u, "left").where("b > a")
    return moved.select(F.col("b").alias("a"), F.coalesce("least", F.col("a").cast("long")).alias("b")).distinct()


def _small_star(edges: DataFrame, least: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    moved = edges.join(least, edges.a == least.u).where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select(F.col("u").alias("a"), F.col("least").alias("b"))).distinct()
