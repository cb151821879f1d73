"""Exact top-k search by inner product: tiled matrix products, partial selection per tile, merged lists.

Queries are held in blocks of a fixed number of rows; every block meets every row of the candidates once. A bounded
number of blocks is in use at a time: their results are written before the next ones are made, so that neither the
driver nor an executor holds more for more queries. A task multiplies a block with one tile of its shard at a time, keeps the k best of each tile and merges them into its
running lists, so that it hands on k rows per query however large its shard is. The lists of all tasks are merged
by a tree: first in a number of groups per query, then per query.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapwise.llm.jobs import prepare, written
from lapwise.session import new_table_path

#: Queries per block: with 1,000 components, 16 MB in every task and on the driver.
QUERY_BLOCK = 2048
#: Blocks that are searched for in one job, each with a pass over the candidates.
BLOCKS_AT_A_TIME = 4
TILE = 1024
MERGE_GROUPS = 16

LISTS = "query_id long, id long, score long"

#: Largest sum that double precision adds without rounding.
EXACT = 2**53


def quantised(column: str, scale: int = 1024) -> Column:
    """Each component x as floor(scale * x); null if the vector or a component is null or not finite."""
    x = F.transform(F.col(column), lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.when(F.col(column).isNotNull() & finite, F.transform(x, lambda v: F.floor(v * scale).cast("long")))


def exact_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = 1024,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, id, score): for each query row its k best rows by integer inner product.

    Candidates are all rows but those with the query's own id; ties go to the smaller id, and repeated rows
    of a candidate each take a place. Queries that repeat an id are asked once, with the smallest vector.
    Vectors of another length than the query's score over none and take no part for it; rows without id, null
    vectors and vectors with null or non-finite components take no part at all. Fewer than k candidates: all of
    them. No queries or no rows: no result. Inner products are exact; where
    a sum could leave 2**53 Python integers are used, and scores beyond 64 bits count as the largest or smallest.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"), quantised(vector_column, scale).alias("v"), is_query.alias("asked")
    ).where("id IS NOT NULL AND v IS NOT NULL")
    asked = rows.where("asked").groupBy("id").agg(F.min("v").alias("v"))
    candidates = rows.select("id", "v")
    # Read back in pieces, also by the driver, without going through the vectors again.
    asked = written(asked, "queries")
    path, searched = new_table_path(spark, "top-lists"), 0
    for blocks in batched(_blocks(asked, query_block), BLOCKS_AT_A_TIME):
        shared = [spark.sparkContext.broadcast(block) for block in blocks]
        lists = [candidates.mapInArrow(_search(block, k), LISTS) for block in shared]
        _merged(reduce(DataFrame.unionAll, lists), k).write.parquet(f"{path}/batch={searched}")
        searched += 1
        for block in shared:
            block.destroy()
    schema = "query_id long, rank int, id long, score long"
    found = spark.read.schema(schema).parquet(path) if searched else spark.createDataFrame([], schema)
    return found.select("query_id", "rank", F.col("id").alias(id_column), "score")


def _merged(lists: DataFrame, k: int) -> DataFrame:
    """The k best of each query out of the lists of all tasks, merged in groups first."""
    best = Window.partitionBy("query_id", "part").orderBy(F.desc("score"), "id")
    parts = lists.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)))
    merged = parts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return merged.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def _blocks(asked: DataFrame, size: int):
    """Queries as (ids, matrix) blocks of one vector length each; the driver holds a block at a time."""
    held: dict[int, list] = {}
    for row in asked.toLocalIterator():
        same = held.setdefault(len(row["v"]), [])
        same.append(row)
        if len(same) == size:
            yield _matrix(same)
            same.clear()
    for same in held.values():
        if same:
            yield _matrix(same)


def _matrix(rows):
    return np.array([r["id"] for r in rows], dtype=np.int64), np.array([r["v"] for r in rows], dtype=np.int64).reshape(len(rows), -1)


def _search(block, k: int) -> Callable:
    def search(batches):
        ids, queries = block.value
        width = queries.shape[1]
        best_score = np.zeros((len(ids), 0), dtype=np.int64)
        best_id = np.zeros((len(ids), 0), dtype=np.int64)
        best_real = np.zeros((len(ids), 0), dtype=bool)
        for batch in batches:
            lists = batch.column(1)
            fits = np.diff(lists.offsets.to_numpy()) == width
            batch = batch.filter(pa.array(fits))
            if batch.num_rows == 0:
                continue
            row_ids = batch.column(0).to_numpy()
            matrix = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, width)
            for first in range(0, batch.num_rows, TILE):
                tile_ids = row_ids[first : first + TILE]
                order = np.argsort(tile_ids, kind="stable")
                tile_ids = tile_ids[order]
                score = products(queries, matrix[first : first + TILE][order])
                real = tile_ids[None, :] != ids[:, None]
                score, tile, real = select(score, np.broadcast_to(tile_ids, score.shape), real, k)
                best_score, best_id, best_real = select(
                    np.hstack([best_score, score]), np.hstack([best_id, tile]), np.hstack([best_real, real]), k
                )
        query, place = np.nonzero(best_real)
        if len(query):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[query]), pa.array(best_id[query, place]), pa.array(best_score[query, place])],
                names=["query_id", "id", "score"],
            )

    return search


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices."""
    if a.size == 0 or b.size == 0:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    bound = np.abs(a.astype(np.float64)).max() * np.abs(b.astype(np.float64)).max() * a.shape[1]
    if bound < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    limits = np.iinfo(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.minimum(np.maximum(exact, limits.min), limits.max).astype(np.int64)


def select(score: np.ndarray, ids: np.ndarray, real: np.ndarray, k: int):
    """The k best columns of each row by (real first, higher score, smaller id), in any order.

    A partial selection finds the k-th score of each row; whatever is above stays, and of the ties with it the
    smallest ids.
    """
    if score.shape[1] <= k:
        return score, ids, real
    least = np.iinfo(np.int64).min
    masked = np.where(real, score, least)
    bar = np.partition(masked, -k, axis=1)[:, -k][:, None]
    above = masked > bar
    level = masked == bar
    room = k - above.sum(axis=1)
    if (level.sum(axis=1) > room).any():
        by_id = np.argsort(np.where(level, ids, np.iinfo(np.int64).max), axis=1, kind="stable")
        chosen = by_id[:, :k]
        level = np.zeros_like(level)
        np.put_along_axis(level, chosen, np.arange(chosen.shape[1])[None, :] < room[:, None], axis=1)
    keep = above | level
    where = np.nonzero(keep)[1].reshape(len(score), k)
    rows = np.arange(len(score))[:, None]
    return score[rows, where], ids[rows, where], real[rows, where]
