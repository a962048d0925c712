"""Approximate nearest neighbours by shifted space-filling curves.

Vectors are projected to a few dimensions several times over, shifted, and put in
the order of a Hilbert curve. Each order is cut into ranges of equal size; a query
looks into its own range and its neighbours, scores what it meets there exactly,
and the best of all orders are merged and ranked (after Liao, Lopez and
Leutenegger, 2001).

Largest inner product becomes nearest neighbour by one more component that gives
every candidate the same length (Bachrach et al., 2014); for vectors of equal
length it is zero.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offhours.llm.shared import batches, column, stored, table

K = 20
EVERY = 20
CURVES = 16
PROJECTED = 8
BITS = 6
RANGES = 24
SEED = 2
GROUP = 8192
QUERIES = 2048
_SPREAD = 14


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of integer points (rows, each below 2**bits) on a Hilbert curve (Skilling, 2004)."""
    x = points.astype(np.uint32).T.copy()
    one = np.uint32(1)
    for level in range(bits - 1, 0, -1):
        low = np.uint32((1 << level) - 1)
        for axis in x:
            high = (axis >> np.uint32(level)) & one == 1
            swap = (x[0] ^ axis) & low
            # Turn the first axis over where the bit is set, else exchange the two.
            turned = np.where(high, x[0] ^ low, x[0] ^ swap)
            if axis is not x[0]:
                axis[:] = np.where(high, axis, axis ^ swap)
            x[0] = turned
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> np.uint32(level)) & one == 1, np.uint32((1 << level) - 1), 0).astype(np.uint32)
    x ^= flip
    key = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << 1) | ((axis >> np.uint32(level)) & one)
    return key


class Curves:
    """Seeded projections, shifts and orders for vectors of one length."""

    def __init__(self, dims: int, longest: float, spread: float, curves: int, seed: int):
        make = np.random.default_rng([seed, dims])
        self.longest, self.spread = max(longest, 1e-300), max(spread, 1e-300)
        self.axes = []
        for _ in range(curves):
            axes = make.normal(size=(dims + 1, min(PROJECTED, dims + 1)))
            self.axes.append((np.linalg.qr(axes)[0], make.random(axes.shape[1])))

    def keys(self, vectors: np.ndarray, query: bool) -> list[np.ndarray]:
        """One key per curve for each row of ``vectors``."""
        lengths = np.linalg.norm(vectors, axis=1)
        if query:
            points = np.column_stack([vectors / np.maximum(lengths, 1e-300)[:, None], np.zeros(len(vectors))])
        else:
            rest = np.sqrt(np.maximum(0, 1 - (lengths / self.longest) ** 2))
            points = np.column_stack([vectors / self.longest, rest])
        out = []
        for axes, shift in self.axes:
            # The logistic curve spreads projections evenly over the unit interval.
            even = 1 / (1 + np.exp(np.clip(-1.7 * (points @ axes) / self.spread, -50, 50)))
            out.append(hilbert(((even + shift) / 2 * (1 << BITS)).astype(np.uint32), BITS))
        return out


def _usable(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Vectors as bytes of doubles, without zero vectors, nulls and non-finite components."""
    good, out = np.zeros(batch.num_rows, bool), []
    for i, vector in enumerate(batch.column(1)):
        if not vector.is_valid or vector.values.null_count:
            continue
        x = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
        if np.isfinite(x).all() and x.any():
            good[i] = True
            out.append(x.tobytes())
    vectors = pa.array(out, pa.binary())
    lengths = [float(np.linalg.norm(np.frombuffer(x))) for x in out]
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0).filter(pa.array(good)),
            vectors,
            pc.divide(pc.binary_length(vectors), 8),
            pa.array(lengths, pa.float64()),
        ],
        ["vec_id", "vector", "dims", "length"],
    )


def _matrix(vectors: pa.ChunkedArray, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(vectors.to_pylist()), np.float64).reshape(-1, dims)


def distinct_vectors(embeddings: DataFrame, k: int) -> DataFrame:
    """Each different usable vector once, with the k + 1 smallest ids that bear it.

    A query can return no more than these, itself left out, so many copies of one
    vector are one point on the curves without any result being lost.
    """
    usable = embeddings.select(
        column(embeddings, "vec_id").cast("long").alias("vec_id"),
        column(embeddings, "embedding").alias("embedding"),
    ).where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).mapInArrow(
        batches(_usable), "vec_id long, vector binary, dims long, length double"
    ).dropDuplicates(["vec_id", "vector"])
    # Ranks up to a limit are taken before the shuffle too, so copies do not pile up.
    first = Window.partitionBy("vector").orderBy("vec_id")
    return (
        usable.withColumn("n", F.row_number().over(first))
        .where(F.col("n") <= k + 1)
        .groupBy("vector", "dims", "length")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
        .withColumn("point", F.xxhash64("vector"))
    )


def _keyed(points: DataFrame, shape: dict, curves: int, seed: int, query: bool) -> DataFrame:
    """A row per point and curve with its key."""

    def run(batch):
        out = []
        all_dims = batch.column(2).to_numpy()
        for dims in np.unique(all_dims):
            some = batch.filter(pa.array(all_dims == dims))
            vectors = _matrix(some.column(1), int(dims))
            maker = Curves(int(dims), *shape[int(dims)], curves, seed)
            tie = (some.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - _SPREAD)).astype(np.int64)
            for number, key in enumerate(maker.keys(vectors, query)):
                out.append(
                    pa.RecordBatch.from_arrays(
                        [
                            some.column(0),
                            some.column(2),
                            pa.array(np.full(len(key), number, np.int32)),
                            # Equal keys are told apart by the hash, so ranges come out even.
                            pa.array((key << _SPREAD) | tie),
                            some.column(1),
                        ],
                        ["point", "dims", "curve", "key", "vector"],
                    )
                )
        return pa.Table.from_batches(out).combine_chunks().to_batches()[0]

    return points.select("point", "vector", "dims").mapInArrow(
        batches(run), "point long, dims long, curve int, key long, vector binary"
    )


def near_vectors(
    embeddings: DataFrame,
    every: int = EVERY,
    k: int = K,
    curves: int = CURVES,
    ranges: int = RANGES,
    seed: int = SEED,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k nearest found for each query.

    Queries are the rows whose id is divisible by ``every``, candidates all others
    of the same length; the score is the inner product in double precision, summed
    from the first component to the last. Equal scores go by smaller id.

    Each of the ``curves`` orders is cut into ``ranges`` ranges (fewer, where they would
    hold less than 4 (k + 1) points), and a query sees
    three of them, so windows grow with the table and recall does not fall with
    its size. Vectors without structure need wide windows (the default finds over
    0.9 of the true neighbours of random directions in 64 dimensions); clustered
    ones do with more ``ranges``. The cuts are quantiles of the keys of all rows.
    Ranges are dealt into groups of bounded size.

    Null, empty and zero vectors and those with null or non-finite components take
    no part, nor do null ids; rows that agree in id and vector are one. An empty
    table gives an empty result; other columns are not read.
    """
    points = stored(distinct_vectors(embeddings, k), "points")
    shape = {
        row["dims"]: (row["longest"], row["longest"] and (1.0 / (row["dims"] + 1)) ** 0.5)
        for row in points.groupBy("dims").agg(F.max("length").alias("longest")).collect()
    }
    # Every copy of a vector may ask, also those above its k + 1 smallest ids.
    askers = embeddings.select(column(embeddings, "vec_id").cast("long").alias("vec_id"),
                               column(embeddings, "embedding").alias("embedding")).where(
        (F.col("vec_id") % every == 0) & F.col("embedding").isNotNull()
    ).mapInArrow(batches(_usable), "vec_id long, vector binary, dims long, length double")
    asking = askers.select(F.xxhash64("vector").alias("point"), F.col("vec_id").alias("query_id")).distinct()
    asked = points.join(asking.select("point").distinct(), "point", "left_semi")

    given = stored(_keyed(points, shape, curves, seed, False), "curve-keys")
    shares = [i / ranges for i in range(1, ranges)]
    quantiles = F.percentile_approx("key", shares, 20 * ranges) if shares else F.array().cast("array<long>")
    cuts = given.groupBy("dims", "curve").agg(quantiles.alias("cuts"), F.count(F.lit(1)).alias("n"))
    # One row per curve and length of vectors.
    cuts = F.broadcast(stored(cuts, "curve-cuts"))
    # A range holds 4 (k + 1) points at least; tables of fewer are searched whole.
    used = F.greatest(F.lit(1), F.least(F.lit(ranges), F.floor(F.col("n") / (4 * (k + 1))))).cast("int")
    cell = F.expr("size(filter(cuts, c -> c <= key))") * used
    cell = F.floor(cell / ranges).cast("int")

    def split(rows, most):
        """Parts of bounded size that a range's rows are dealt into."""
        return F.greatest(F.lit(1), F.ceil(rows / (used * most))).cast("int")

    n_queries = asked.count()
    parts = split(F.col("n"), GROUP)
    q_parts = split(F.lit(n_queries) * 3, QUERIES)
    mine = F.xxhash64("point", "curve")
    placed = given.join(cuts, ["dims", "curve"]).select(
        "dims", "curve", cell.alias("cell"),
        F.pmod(mine, parts).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), q_parts - 1)).alias("q_part"),
        F.lit(False).alias("query"), "point", "vector",
    )
    looking = (
        _keyed(asked, shape, curves, seed, True)
        .join(cuts, ["dims", "curve"])
        .withColumn(
            "cell", F.explode(F.sequence(F.greatest(cell - 1, F.lit(0)), F.least(cell + 1, used - 1)))
        )
        .select(
            "dims", "curve", "cell",
            F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"),
            F.pmod(mine, q_parts).cast("int").alias("q_part"),
            F.lit(True).alias("query"), "point", "vector",
        )
    )

    def rerank(frame: pa.Table) -> pa.Table:
        dims = frame["dims"][0].as_py()
        query = frame["query"].combine_chunks()
        asks, has = frame.filter(query), frame.filter(pc.invert(query))
        if not asks.num_rows or not has.num_rows:
            return pa.table({"point": pa.array([], pa.int64()), "found": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        q, c = _matrix(asks["vector"], dims), _matrix(has["vector"], dims)
        names, own = has["point"].to_numpy(), asks["point"].to_numpy()
        left, right, score = [], [], []
        for at in range(0, len(q), 256):
            rough = q[at : at + 256] @ c.T
            if rough.shape[1] > k + 1:
                # Ties at the end are kept, and what rounding may have put just below it.
                floor = np.partition(rough, rough.shape[1] - k - 1, axis=1)[:, rough.shape[1] - k - 1]
                lengths = np.linalg.norm(q[at : at + 256], axis=1)
                keep = rough >= (floor - 1e-12 * lengths * shape[dims][0])[:, None]
            else:
                keep = np.ones(rough.shape, bool)
            i, j = np.nonzero(keep)
            left.append(own[at + i])
            right.append(names[j])
            score.append(np.cumsum(q[at + i] * c[j], axis=1)[:, -1])
        return pa.table({"point": np.concatenate(left), "found": np.concatenate(right), "score": np.concatenate(score)})

    met = placed.union(looking).groupBy("dims", "curve", "cell", "part", "q_part").applyInArrow(
        rerank, "point long, found long, score double"
    )
    # The same pair may be met on several curves; its score is the same each time.
    pairs = met.groupBy("point", "found").agg(F.max("score").alias("score"))
    best = Window.partitionBy("point").orderBy(F.desc("score"), "first")
    firsts = points.select(F.col("point").alias("found"), "ids", F.col("ids")[0].alias("first"))
    merged = (
        pairs.join(firsts, "found")
        .withColumn("n", F.row_number().over(best))
        .where(F.col("n") <= k + 1)
        .drop("n", "first", "found")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        merged.join(asking, "point")
        .withColumn("vec_id", F.explode("ids"))
        .where(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op2_curve_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
