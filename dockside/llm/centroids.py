"""Sums over the subtrees of a forest by centroid decomposition, whatever its depth and width.

A component is split at its centroid, the node without which no part has more than half of its nodes, and its parts are
split in the same way until single nodes are left. What lies below a centroid is its own value and the totals of the
components that hung on it; that sum is added to the nodes on the path from the centroid to its component's top. A node is
in at most log2(size) components, so a path of n nodes costs n log n additions and no chain of n steps.

Components of up to ``LOCAL`` nodes are decomposed each in one task. A larger one (a long path, a hub with a great many
branches) is split by joins: jumps of doubling length give each node its component's top and the number of nodes below
it, from which follow the centroids; the stored jumps also give the path from a centroid to the top.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from dockside.llm.storage import Scratch

LOCAL = 1 << 12  # nodes of a component that one task takes


def subtree_sums(nodes: DataFrame, values: Sequence[str], scratch: Scratch, local: int = LOCAL) -> DataFrame:
    """(id, *values): for each node of ``nodes(id, parent, *values)`` the values summed over it and all below it.

    Ids are unique longs, ``parent`` is null or an id, without cycles. No nodes give no rows.
    """
    values = list(values)
    open_ = scratch.keep(nodes.select("id", F.col("parent").alias("up"), *[F.col(v).cast("long").alias(v) for v in values]), "forest-0")
    done, paths, cuts, totals, turn = [], [], [], [], 0
    while True:
        steps, tops, below = _jumps(open_, scratch, turn)
        placed = scratch.keep(open_.join(tops, "id").join(below, "id", "left").withColumn("below", 1 + F.coalesce("below", F.lit(0))), f"placed-{turn}")
        sized = scratch.keep(placed.join(placed.where("id = top").select("top", F.col("below").alias("_size")), "top"), f"sized-{turn}")
        totals.append(scratch.keep(placed.groupBy("top").agg(*[F.sum(v).alias(v) for v in values]), f"totals-{turn}"))
        small = sized.where(F.col("_size") <= local)
        done.append(scratch.keep(_decomposed(small.select("top", "id", "up", *values), values), f"sums-{turn}"))
        large = sized.where(F.col("_size") > local)
        chosen = large.where(2 * F.col("below") >= F.col("_size")).groupBy("top").agg(F.min_by(F.struct("id", "up", *values), "below").alias("c"))
        centroids = scratch.keep(chosen.select("top", "c.*"), f"centroids-{turn}")
        if centroids.isEmpty():
            break
        cuts.append(centroids)
        paths.append(_above(centroids.select("id", F.col("id").alias("at")), steps, scratch, turn))
        gone = centroids.select(F.col("id").alias("_gone"))
        rest = large.join(gone, F.col("id") == F.col("_gone"), "left_anti")
        marked = rest.join(gone, F.col("up") == F.col("_gone"), "left")
        turn += 1
        open_ = scratch.keep(marked.select("id", F.when(F.col("_gone").isNull(), F.col("up")).alias("up"), *values), f"forest-{turn}")
    return _added(nodes, values, done, paths, cuts, totals, scratch)


def _jumps(forest: DataFrame, scratch: Scratch, turn: int) -> tuple[list[DataFrame], DataFrame, DataFrame]:
    """(steps, tops, below): ``steps[k]`` has (id, up) with the node 2^k steps up, for nodes that have one; ``tops`` (id, top) for
    all; ``below(id, below)`` how many nodes are below those that have any.

    A node leaves the rounds as soon as it has reached its top, so a few deep branches do not keep the others busy.
    """
    first = scratch.keep(forest.select("id", "up", F.coalesce("up", "id").alias("top"), F.lit(1).cast("long").alias("size")), f"jumps-{turn}-0")
    going, arrived = first.where("up is not null"), first.where("up is null").select("id", "top")
    steps, unders = [], []
    while not going.isEmpty():
        k = len(steps)
        steps.append(going.select("id", "up"))
        unders.append(scratch.keep(going.groupBy(F.col("up").alias("id")).agg(F.sum("size").alias("below")), f"under-{turn}-{k}"))
        there = arrived.withColumn("_up", F.lit(None).cast("long")).unionByName(going.select("id", "top", F.col("up").alias("_up")))
        there = there.select(F.col("id").alias("_at"), F.col("top").alias("_top"), "_up")
        further = going.join(there, F.col("up") == F.col("_at")).select("id", F.col("_up").alias("up"), F.col("_top").alias("top"), "size")
        further = further.join(unders[-1], "id", "left").select("id", "up", "top", (F.col("size") + F.coalesce("below", F.lit(0))).alias("size"))
        further = scratch.keep(further, f"jumps-{turn}-{k + 1}")
        going, arrived = further.where("up is not null"), arrived.unionByName(further.where("up is null").select("id", "top"))
    under = reduce(DataFrame.unionByName, unders) if unders else first.where("false").select("id", F.col("size").alias("below"))
    return steps, arrived, under.groupBy("id").agg(F.sum("below").alias("below"))


def _above(starts: DataFrame, steps: list[DataFrame], scratch: Scratch, turn: int) -> DataFrame:
    """(id, at): every node ``at`` on the way from ``id`` to its component's top, ``id`` left out."""
    found = starts
    for k, step in enumerate(steps):
        step = step.select(F.col("id").alias("at"), F.col("up").alias("_up"))
        found = scratch.keep(found.unionByName(found.join(step, "at").select("id", F.col("_up").alias("at"))), f"above-{turn}-{k}")
    return found.where("id != at")


def _added(nodes, values, done, paths, cuts, totals, scratch) -> DataFrame:
    """All sums: what the last round found, then, from the last split to the first, each centroid's sum and its path's additions."""
    links = nodes.select("id", F.col("parent").alias("_parent"))
    found = done[-1]
    for turn in range(len(cuts) - 1, -1, -1):
        cut = cuts[turn]
        # tops of the next round's components whose parent is a centroid of this round
        hung = totals[turn + 1].join(links, F.col("top") == F.col("id")).where("_parent is not null")
        hung = hung.groupBy(F.col("_parent").alias("id")).agg(*[F.sum(v).alias(f"_{v}") for v in values])
        own = cut.join(hung, "id", "left").select("id", *[(F.col(v) + F.coalesce(f"_{v}", F.lit(0))).alias(v) for v in values])
        own = scratch.keep(own, f"cut-sums-{turn}")
        more = paths[turn].join(own, "id").select(F.col("at").alias("id"), *values)
        found = done[turn].unionByName(found).unionByName(own).unionByName(more)
        found = scratch.keep(found.groupBy("id").agg(*[F.sum(v).alias(v) for v in values]), f"found-{turn}")
    return found


def _decomposed(rows: DataFrame, values: Sequence[str]) -> DataFrame:
    """(id, *values): the sums of components of bounded size; each lies in one task, which takes them as they stream by, sorted."""
    names = ["top", "id", "up", *values]

    def components(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((0, len(names)), np.int64)
        for batch in batches:
            held = np.vstack([held, np.column_stack([batch.column(n).to_numpy() for n in names])])
            if len(held):
                whole = int(np.searchsorted(held[:, 0], held[-1, 0]))  # the last component may go on
                yield summed(held[:whole])
                held = held[whole:]
        yield summed(held)

    def summed(table: np.ndarray) -> pa.RecordBatch:
        ids, ups, sums = table[:, 1], table[:, 2], table[:, 3:].copy()
        order = np.argsort(ids)
        parents = np.where(ups == ids, -1, order[np.searchsorted(ids[order], ups)]) if len(ids) else ids
        starts = np.flatnonzero(np.diff(table[:, 0], prepend=table[0, 0] - 1)) if len(ids) else ids
        ends = np.append(starts[1:], len(ids))
        for start, end in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
            of = parents[start:end]
            sums[start:end] = decompose(np.where(of < 0, -1, of - start), sums[start:end])
        return pa.RecordBatch.from_arrays([pa.array(ids), *[pa.array(c) for c in sums.T]], ["id", *values])

    schema = "id long, " + ", ".join(f"{v} long" for v in values)
    # the work on a component is far more than its bytes tell: as many tasks as the session has partitions
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select("top", "id", F.coalesce("up", "id").alias("up"), *values).repartition(tasks, "top").sortWithinPartitions("top")
    return dealt.mapInArrow(components, schema)


def decompose(parents: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Subtree sums of one tree given by parent places (-1: the top), by recursive centroid splits."""
    sums = own.copy()
    if len(parents) == 1:
        return sums
    top_down = _top_down(parents)
    parents = parents.tolist()
    label = [0] * len(parents)
    work, labels = [top_down], 1
    while work:
        members = work.pop()  # parents before children
        mark = label[members[0]]
        size = dict.fromkeys(members, 1)
        for v in reversed(members):
            up = parents[v]
            if up >= 0 and label[up] == mark:
                size[up] += size[v]
        centroid = next(v for v in reversed(members) if 2 * size[v] >= len(members))
        # the part above the centroid, and one for each branch below it
        parts: dict[int, list[int]] = {}
        home: dict[int, int] = {}
        for v in members:
            if v != centroid:
                up = parents[v]
                at = v if up == centroid else home.get(up, -1)
                if at >= 0:
                    home[v] = at
                parts.setdefault(at, []).append(v)
        if home:
            sums[centroid] += own[list(home)].sum(axis=0)
        path, up = [], parents[centroid]
        while up >= 0 and label[up] == mark:
            path.append(up)
            up = parents[up]
        if path:
            sums[path] += own[centroid] + (own[list(home)].sum(axis=0) if home else 0)
        label[centroid] = -1
        for part in parts.values():
            for v in part:
                label[v] = labels
            labels += 1
            if len(part) > 1:
                work.append(part)
    return sums


def _top_down(parents: np.ndarray) -> list[int]:
    """All places, each after its parent's."""
    order = np.argsort(parents, kind="stable")
    starts = np.searchsorted(parents[order], np.arange(-1, len(parents) + 1))
    found = order[: starts[1]].tolist()
    for v in found:
        found.extend(order[starts[v + 1] : starts[v + 2]].tolist())
    return found
