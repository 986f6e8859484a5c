"""What both vector searches share: rows that take part, shards, and meeting every shard with every block of queries."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Queries that meet a shard at once.
BLOCK = 4096


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null or empty, and no component null, NaN or infinite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & fine, F.lit(False))


def matrix(table: pa.Table, column: str, kind: type) -> np.ndarray:
    """A column of equally long lists as rows."""
    lists = table.column(column).combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(lists), -1)


def shard_count(rows: int, shard_rows: int) -> int:
    return max(1, -(-rows // shard_rows))


def met(
    index: DataFrame, queries: DataFrame, shards: int, n_queries: int, search: Callable, schema: str, skip: str | None = None
) -> DataFrame:
    """search(key, index rows, query rows) for every shard of `index` (dim, shard, ...) and block of `queries`
    (dim, ...), each pair in a task's hands only as one shard and one block. `skip` names a query column with a shard
    that the query doesn't meet."""
    blocks = shard_count(n_queries, BLOCK)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = index.withColumn("block", every(blocks))
    right = queries.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "query_id"), F.lit(blocks)).cast("int"))
    right = right.withColumn("shard", every(shards))
    if skip:
        right = right.where(F.col("shard") != F.col(skip))
    right = right.select(*[F.col(c).alias(c) for c in right.columns])  # both sides may come from one table
    keys = ["dim", "shard", "block"]

    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def only_if_met(key, rows, asked):  # unannotated: with hints, Spark expects all of them
        return search(rows, asked) if rows.num_rows and asked.num_rows else kinds.empty_table()

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(only_if_met, schema)


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The k highest scores of each query, ties to the smaller vec_id, ranked from 1."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
