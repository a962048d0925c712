"""Exact top-k inner products by branch and bound on vertical blocks of dimensions.

Vectors lie by dimension, not by row (de Vries et al., 2002). Products are summed
up block of dimensions by block; what the rest can still add or take away is
bounded by the lengths of the remaining parts (Cauchy-Schwarz). Candidates whose
best case is below the k-th best worst case are dropped and the survivors moved
together before the next block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offhours.llm.shared import batches, column, table

K = 10
EVERY = 100
SCALE = 1024
CANDIDATES = 4096
QUERIES = 1024
DIMS = 16


def _integers(batch: pa.RecordBatch, scale: int) -> pa.RecordBatch:
    """Components as floor(scale * x); vectors with null or non-finite ones go."""
    lists = batch.column(1)
    good = np.zeros(batch.num_rows, bool)
    out = []
    for i, vector in enumerate(lists):
        if not vector.is_valid or vector.values.null_count:
            continue
        x = np.floor(scale * vector.values.to_numpy(zero_copy_only=False).astype(np.float64))
        if np.isfinite(x).all():
            good[i] = True
            out.append(x.tobytes())
    ids = batch.column(0).filter(pa.array(good))
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(out, pa.binary()), pc.divide(pc.binary_length(pa.array(out, pa.binary())), 8)],
        ["vec_id", "vector", "dims"],
    )


def _matrix(vectors: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Vertical layout: one row per dimension."""
    rows = np.frombuffer(b"".join(vectors.to_pylist()), np.float64).reshape(-1, dims)
    return np.ascontiguousarray(rows.T)


def best(queries: np.ndarray, ids: np.ndarray, own: np.ndarray, columns: np.ndarray, k: int, step: int):
    """For each query (rows) its k best of the candidates (``columns``, by dimension).

    Yields (places among the candidates, scores) by score, then id; all arithmetic
    is on whole numbers. ``own`` are the queries' ids, which are no candidates.
    """
    dims, many = columns.shape
    most = np.abs(columns).max(initial=0) * np.abs(queries).max(initial=0) * max(1, dims)
    if most < 2**52:  # then doubles are exact
        q_all, c_all = queries, columns
    else:
        q_all = np.array([[int(x) for x in row] for row in queries], object).reshape(queries.shape)
        c_all = np.array([[int(x) for x in row] for row in columns], object).reshape(columns.shape)
    cuts = [*range(0, dims, step), dims]
    # Lengths of what remains behind each cut, rounded up.
    up = 1 + 1e-9
    c_rest = [np.sqrt((columns[a:] ** 2).sum(0)) * up for a in cuts]
    q_rest = [np.sqrt((queries[:, a:] ** 2).sum(1)) * up for a in cuts]
    first = q_all[:, : cuts[1]] @ c_all[: cuts[1]] if dims else np.zeros((len(queries), many))
    for i in range(len(queries)):
        alive = np.flatnonzero(ids != own[i])
        total = first[i][alive]
        for a, b, at in zip(cuts[1:], cuts[2:], range(1, len(cuts))):
            if len(alive) > k:
                slack = q_rest[at][i] * c_rest[at][alive]
                known = total.astype(np.float64)
                worst = known - slack
                floor = np.partition(worst, len(worst) - k)[len(worst) - k]
                stay = known + slack >= floor - 1e-6 * (1 + abs(floor))
                alive, total = alive[stay], total[stay]
            total = total + q_all[i, a:b] @ c_all[a:b, alive]
        if len(alive) > k:
            floor = np.sort(total)[len(total) - k]
            stay = total >= floor
            alive, total = alive[stay], total[stay]
        order = np.array(sorted(range(len(alive)), key=lambda j: (-total[j], ids[alive[j]]))[:k], int)
        yield alive[order], [int(x) for x in total[order]] if len(order) else []


def _long(x: int) -> int:
    return max(-(2**63), min(2**63 - 1, x))


def exact_top_k(
    embeddings: DataFrame,
    every: int = EVERY,
    k: int = K,
    scale: int = SCALE,
    candidates: int = CANDIDATES,
    queries: int = QUERIES,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the k best candidates of each query.

    Queries are the rows whose id is divisible by ``every``; candidates all others
    of the same length. Components are floor(scale * x). Both sides are dealt into
    blocks of bounded size by a hash of the id; each pair of blocks is one small
    group, and k rows per query and group are ranked at the end. Equal scores go
    by smaller id.

    Null vectors, and those with null or non-finite components, take no part, nor
    do null ids. Of rows with one id each is a candidate and a query, but never of
    rows with its own id. Scores beyond 64 bits are given as the nearest long. An
    empty table gives an empty result; other columns are not read.
    """
    vectors = embeddings.select(
        column(embeddings, "vec_id").cast("long").alias("vec_id"),
        column(embeddings, "embedding").alias("embedding"),
    ).where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    asked = F.col("vec_id") % every == 0
    size = vectors.agg(F.count(F.lit(1)).alias("n"), F.count_if(asked).alias("q")).first()
    n_blocks, q_blocks = -(-size["n"] // candidates) or 1, -(-size["q"] // queries) or 1
    whole = vectors.mapInArrow(
        batches(lambda b: _integers(b, scale)), "vec_id long, vector binary, dims long"
    )
    mine = F.xxhash64("vec_id")

    def dealt(rows, own, blocks, other, others, query):
        every_block = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        return rows.select(
            F.pmod(mine, F.lit(blocks)).cast("int").alias(own),
            every_block.alias(other),
            "dims", F.lit(query).alias("query"), "vec_id", "vector",
        ).select("c", "q", "dims", "query", "vec_id", "vector")

    met = dealt(whole, "c", n_blocks, "q", q_blocks, False).union(
        dealt(whole.where(asked), "q", q_blocks, "c", n_blocks, True)
    )

    def search(frame: pa.Table) -> pa.Table:
        dims = frame["dims"][0].as_py()
        query = frame["query"].combine_chunks()
        asking, given = frame.filter(query), frame.filter(pc.invert(query))
        out = {"query_id": [], "vec_id": [], "score": []}
        ids = given["vec_id"].to_numpy()
        own = asking["vec_id"].to_numpy()
        rows = _matrix(asking["vector"], dims).T if dims else np.zeros((len(own), 0))
        columns = _matrix(given["vector"], dims) if dims else np.zeros((0, len(ids)))
        for query_id, (places, found) in zip(own, best(rows, ids, own, columns, k, DIMS)):
            out["query_id"] += [query_id] * len(places)
            out["vec_id"] += ids[places].tolist()
            out["score"] += [_long(s) for s in found]
        return pa.table({name: pa.array(v, pa.int64()) for name, v in out.items()})

    near = met.groupBy("c", "q", "dims").applyInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        near.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(table(spark, sf_dir, "embeddings"))


OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
