"""Connected components of a table of links: contraction within tasks, then large-star and small-star steps."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise.llm.jobs import discard, written

#: Links a task contracts at once; fewer links in all than this are a single task's work.
TASK_LINKS = 100_000


def components(links: DataFrame, left: str, right: str, task_links: int = TASK_LINKS) -> DataFrame:
    """Every linked node ``v`` that is not the smallest of its component, with that smallest as ``root``.

    Links are undirected; loops and repeats are ignored. Links are dealt to tasks of a bounded number, each of which
    replaces its links by stars with the same components. If that took more than one task, the stars are joined by
    large-star and small-star steps (grouped minima, combined before the shuffle, and equality joins) and contracted
    again until nothing changes; the number of rounds grows with the logarithm of the longest path.
    """
    a, b = F.col(left), F.col(right)
    edges = links.where(a != b).select(F.greatest(a, b).alias("v"), F.least(a, b).alias("root"))
    edges = written(edges, "links")
    before = _digest(edges)
    tasks = -(-before[0] // task_links)
    if not before[0]:
        return edges
    edges = _replaced(edges, _contracted(edges, tasks))
    while tasks > 1:
        edges = _replaced(edges, _contracted(_small_star(_large_star(edges)), tasks))
        after = _digest(edges)
        if after == before:
            break
        before = after
    return edges


def _replaced(old: DataFrame, new: DataFrame) -> DataFrame:
    new = written(new, "links")
    discard(old)
    return new


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("v", "root")), F.sum(F.hash("root", "v"))).first())


def _contracted(edges: DataFrame, tasks: int) -> DataFrame:
    """Links dealt to tasks by their smaller end, replaced by a star per component that a task sees."""

    def contract(batches):
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.get(x, x) != x:
                parent[x] = parent.get(parent[x], parent[x])
                x = parent[x]
            return x

        for batch in batches:
            for v, u in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                low, high = sorted((root(v), root(u)))
                parent[high] = low
        stars = [(x, root(x)) for x in parent if root(x) != x]
        if stars:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*stars, strict=True)], names=["v", "root"])

    return edges.repartition(tasks).mapInArrow(contract, "v long, root long")


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.select(F.col("v").alias("node"), F.col("root").alias("other")).unionAll(
        edges.select(F.col("root").alias("node"), F.col("v").alias("other"))
    )
    least = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))
    larger = edges.select(F.col("root").alias("node"), F.col("v").alias("other"))
    return larger.join(least, "node").select(F.col("other").alias("v"), F.col("least").alias("root"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and all its smaller neighbours to the smallest of them."""
    least = edges.groupBy("v").agg(F.min("root").alias("least"))
    joined = edges.join(least, "v")
    own = least.select("v", F.col("least").alias("root"))
    others = joined.where("root <> least").select(F.col("root").alias("v"), F.col("least").alias("root"))
    return own.unionAll(others).distinct()
