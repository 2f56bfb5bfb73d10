"""Exact top-k search by inner product: local score lists, one safe cutoff a query, exact resolution.

Components are floor(64 x), so scores are integers. The components are cut into ``LISTS`` lists; the score of a vector is the
sum of its partial scores on the lists. Candidates are dealt into shards and queries into blocks by a hash; a task holds one
shard and one block, so memory is bounded and neither side is broadcast. Three phases:

1. Each list of each shard names its ``k`` best vectors for a query. Their whole scores are gathered; the k-th best of all
   shards is the cutoff t of the query: k vectors reach it, so no vector below it is in the result.
2. A vector that reaches t has a partial score of at least t / LISTS on some list, whatever the signs. Each shard collects the
   entries that do, on any list.
3. The entries collected are resolved to their exact scores, those below t go, and the first k by (score, vec_id) of each
   shard are merged. At most k rows of a shard and query leave a task, however many tie.

Every query meets every shard, in blocks: that is the stated query set against all rows. Between the phases only lists of k
are shuffled.

A vector that is null or holds a null or non-finite component takes no part, nor does a row without vec_id. Shorter vectors
count as padded with zeros. Rows that repeat a vec_id are candidates each; a repeated query is the smallest of its vectors.
Scores that could leave 2^53 are computed with whole numbers of any size and clamped to 64 bits on output.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .blocks import job


LISTS = 4
SHARD_ROWS = 8192
QUERY_ROWS = 4096
STEP = 256
LONG = np.iinfo(np.int64)


def _floor64(x: Column) -> Column:
    """floor(64 x) as a double."""
    # floor() of a double is a long; beyond its range doubles are whole already.
    y = x.cast("double") * F.lit(64.0)
    return F.when(F.abs(y) < F.lit(2.0**52), F.floor(y).cast("double")).otherwise(y)


def takes_part(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~bad


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), width))
    rows = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[rows, at] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both sides as doubles where every sum stays exact, else as whole numbers of any size."""
    most = np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0) * max(1, a.shape[1])
    if most < 2.0**53:
        return a, b
    return np.array([[int(x) for x in r] for r in a], dtype=object), np.array([[int(x) for x in r] for r in b], dtype=object)


def _cuts(width: int) -> list[slice]:
    edges = np.linspace(0, width, LISTS + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _first_k(scores: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The k best of ``at``, ties in order of ``at``."""
    return at[np.argsort(-scores[at], kind="stable")[:k]]


def _clamp(x) -> int:
    return int(min(max(int(x), LONG.min), LONG.max))


def _work(k: int, width: int, final: bool):
    """One shard against one block of queries: phase 1, or phases 2 and 3 where the queries bring their cutoff."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out_q, out_v, out_s = [], [], []
        if left.num_rows and right.num_rows:
            left = left.sort_by("vec_id")
            ids, qids = left["vec_id"].to_numpy(), right["query_id"].to_numpy()
            v, q = _exact(_matrix(left["vec"], width), _matrix(right["qvec"], width))
            floor = right["cutoff"].to_pylist() if final else [None] * len(qids)
            for start in range(0, len(qids), STEP):
                part = q[start : start + STEP]
                total, lists = 0, []
                for cut in _cuts(width):
                    lists.append(part[:, cut] @ v[:, cut].T)
                    total = total + lists[-1]
                for i in range(len(part)):
                    n = start + i
                    own = ids == qids[n]
                    if final:
                        at = np.arange(len(ids))
                        if floor[n] is not None and floor[n] > LONG.min:
                            enough = np.zeros(len(ids), dtype=bool)
                            for scores in lists:
                                enough |= (scores[i] * LISTS >= floor[n]).astype(bool)
                            at = np.flatnonzero(enough)
                            at = at[(total[i][at] >= floor[n]).astype(bool)]
                    else:
                        best = [np.argpartition(-s[i], min(k, len(ids) - 1))[: k + 1] if len(ids) > k + 1 else np.arange(len(ids)) for s in lists]
                        at = np.unique(np.concatenate(best))
                    at = _first_k(total[i], at[~own[at]], k)
                    out_q += [qids[n]] * len(at)
                    out_v += ids[at].tolist()
                    out_s += [_clamp(x) for x in total[i][at]]
        return pa.table({"query_id": pa.array(out_q, pa.int64()), "vec_id": pa.array(out_v, pa.int64()), "score": pa.array(out_s, pa.int64())})

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(
    vectors: DataFrame, *, k: int, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding",
    shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score of the k best vectors of each query but its own; all, if there are fewer."""
    stages = job(vectors.sparkSession, "topk")
    rows = vectors.filter(F.col(vec_id).isNotNull() & takes_part(F.col(vector))).select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.transform(vector, _floor64).alias("vec"), is_query.alias("asks")
    )
    rows = stages.keep("vectors", rows)
    n, asking, width = rows.agg(F.count(F.lit(1)), F.sum(F.col("asks").cast("bigint")), F.max(F.size("vec"))).first()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-(asking or 0) // query_rows))
    width = max(width or 0, 1)

    def place(count: int, salt: str) -> Column:
        return F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(count)).cast("int")

    left = rows.select(place(shards, "shard").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "vec_id", "vec")
    asks = rows.filter("asks").groupBy("vec_id").agg(F.min("vec").alias("qvec")).withColumn("qblock", place(blocks, "block"))
    asks = stages.keep("asks", asks.withColumnRenamed("vec_id", "query_id"))

    def meet(queries: DataFrame, final: bool) -> DataFrame:
        right = queries.withColumn("qshard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        return left.groupBy("shard", "block").cogroup(right.groupBy("qshard", "qblock")).applyInArrow(
            _work(k, width, final), "query_id bigint, vec_id bigint, score bigint"
        )

    first = _ranked(meet(asks, False), k).filter(F.col("rank") == k).select("query_id", F.col("score").alias("cutoff"))
    asks = asks.join(stages.keep("cutoffs", first), "query_id", "left")
    return _ranked(meet(asks, True), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
