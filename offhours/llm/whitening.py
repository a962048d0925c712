"""Whitening of embeddings by an eigendecomposition that grows vector by vector.

Each partition keeps the spectrum of the scatter matrix of what it has seen. A new
vector, centred at the mean so far, is a rank-one update: its new eigenvalues are the
roots of a secular equation, one between each two old ones, and the new eigenvectors
follow from the old ones by a Cauchy-like matrix (Golub, 1973; Gu and Eisenstat, 1994).
Directions that an update does not touch, and equal eigenvalues, are deflated first.

The spectra of two partitions are combined in the same way: the eigenvectors of one are
rank-one updates of the other, and one more accounts for the distance of the means.
This goes on in rounds of a fixed number of spectra to a task. A last pass projects the
vectors, exactly centred, on the combined basis (Rayleigh-Ritz), which takes away
the rounding errors of all updates before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offhours.llm.shared import column, stored, table

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
# Entries beyond this are not held: their multiples would not be exact.
LIMIT = 1 << 34
# Spectra, or matrices, that one task combines.
FAN_IN = 16
_EPS = np.finfo(float).eps
_LONG = (1 << 63) - 1
_PARTIAL = "part long, n long, mean binary, vals binary, vecs binary"


# -- rank-one updates ---------------------------------------------------------------------


def secular_roots(d: np.ndarray, z2: np.ndarray, rho: float) -> np.ndarray:
    """``d[j] - root[i]`` at [j, i], for the roots of ``1 + rho * sum(z2 / (d - x)) = 0``.

    ``d`` rises strictly, ``z2`` is positive with sum 1 and ``rho`` is positive. Each root
    is sought as its distance from the nearer pole, so differences keep their digits. A
    step fits a rational function with the two poles around (Li's middle way); one
    that leaves the bracket is replaced by its middle.
    """
    k = len(d)
    if k == 1:
        return np.array([[-rho]])
    apart = d[:, None] - d[None, :]
    gap = np.append(d[1:] - d[:-1], rho)
    at = np.arange(k)
    # Shares of the poles up to each root, whose terms are negative.
    below = np.where(at[:, None] <= at[None, :], z2[:, None], 0.0)
    inverse = 1.0 / rho
    middle = inverse + (z2[:, None] / (apart - gap / 2)).sum(0)
    right = middle < 0
    near = at + (right & (at < k - 1))
    base = apart[:, near]
    # Bounds of the distance from the nearer pole; the last root has a pole on its left only.
    low = np.where(right, -gap / 2, 0.0)
    high = np.where(right, 0.0, gap / 2)
    low[-1], high[-1] = (gap[-1] / 2, gap[-1]) if right[-1] else (0.0, gap[-1] / 2)
    x = (low + high) / 2
    x[right[:-1].nonzero()[0]] = low[:-1][right[:-1]] / 2
    upper = np.append(d[1:], d[-1] + rho) - d[near]
    left_pole = d - d[near]
    for _ in range(80):
        turned = 1.0 / (base - x)
        squares = turned * turned
        f = z2 @ turned
        size = inverse + f - 2 * np.einsum("ji,ji->i", below, turned)
        f += inverse
        slope = z2 @ squares
        slope_low = np.einsum("ji,ji->i", below, squares)
        high = np.where(f >= 0, np.minimum(high, x), high)
        low = np.where(f < 0, np.maximum(low, x), low)
        done = (np.abs(f) <= k * _EPS * size) | (high - low <= _EPS * np.maximum(np.abs(low), np.abs(high)))
        if done.all():
            break
        first, second = left_pole - x, upper - x
        a = (first + second) * f - first * second * slope
        b = first * second * f
        c = f - first * slope_low - second * (slope - slope_low)
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            new = x + step
        outside = ~((new > low) & (new < high))
        new[outside] = ((low + high) / 2)[outside]
        x = np.where(done, x, new)
    return base - x


def _deflated(d, z, vectors, tolerance):
    """Rotate equal eigenvalues until at most one of them has a share in the update."""
    live = np.flatnonzero(np.abs(z) > tolerance)
    if len(live) > 1:
        a, b = live[:-1], live[1:]
        size = np.hypot(z[a], z[b])
        if (np.abs((d[b] - d[a]) * (z[a] / size) * (z[b] / size)) <= tolerance).any():
            kept, last = [], live[0]
            for j in live[1:]:
                size = np.hypot(z[last], z[j])
                c, s = z[j] / size, z[last] / size
                if abs((d[j] - d[last]) * c * s) <= tolerance:
                    z[j], z[last] = size, 0.0
                    d[last], d[j] = d[last] * c * c + d[j] * s * s, d[last] * s * s + d[j] * c * c
                    vectors[:, [last, j]] = vectors[:, [last, j]] @ np.array([[c, s], [-s, c]])
                else:
                    kept.append(last)
                last = j
            live = np.array([*kept, last])
    return live


def rank_one(d: np.ndarray, vectors: np.ndarray, rho: float, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and vectors of ``vectors diag(d) vectors' + rho v v'``, rho >= 0."""
    z = vectors.T @ v
    norm = float(z @ z)
    strength = rho * norm
    largest = max(abs(d[-1]), abs(d[0]), strength)
    if not strength > _EPS * _EPS * largest:
        return d, vectors
    z = z / np.sqrt(norm)
    d, vectors = d.copy(), vectors.copy()
    # In units of the update: shares and gaps below this change nothing in double precision.
    unit = d / strength
    live = _deflated(unit, z, vectors, 8 * _EPS * max(1.0, largest / strength))
    d = unit * strength
    if len(live):
        poles, shares = unit[live], z[live]
        total = float(shares @ shares)
        delta = secular_roots(poles, shares * shares / total, total)
        new = poles - np.diagonal(delta)
        # Shares for which the computed roots are exact (Gu and Eisenstat), so that the
        # vectors are orthogonal whatever the errors of the roots.
        k = len(live)
        at = np.arange(k)
        other = np.where(at[None, :] < at[:, None], at[None, :], np.minimum(at[None, :] + 1, k - 1))
        against = poles[other] - poles[:, None]
        against[:, -1] = 1.0
        exact = np.sqrt(np.abs((-delta / against).prod(1)))
        exact = np.where(shares < 0, -exact, exact)
        inner = exact[:, None] / delta
        inner /= np.sqrt((inner * inner).sum(0))
        vectors[:, live] = vectors[:, live] @ inner
        d[live] = new * strength
    order = np.argsort(d, kind="stable")
    return d[order], vectors[:, order]


class Spectrum:
    """Number, mean and eigendecomposition of the scatter matrix of some vectors."""

    def __init__(self, dims: int):
        self.n, self.mean = 0, np.zeros(dims)
        self.values, self.vectors = np.zeros(dims), np.eye(dims)

    def add(self, x: np.ndarray) -> None:
        """One more vector: a rank-one update by its distance from the mean so far."""
        away = x - self.mean
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, self.n / (self.n + 1), away)
        self.n += 1
        self.mean = self.mean + away / self.n

    def merge(self, other: Spectrum) -> None:
        """The vectors of another spectrum too: its eigenvectors and the distance of the means."""
        if not other.n:
            return
        for value, v in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, float(value), v)
        away = other.mean - self.mean
        both = self.n + other.n
        self.values, self.vectors = rank_one(self.values, self.vectors, self.n * other.n / both, away)
        self.mean = self.mean + away * (other.n / both)
        self.n = both

    def row(self, part: int) -> dict:
        return {
            "part": part,
            "n": self.n,
            "mean": self.mean.tobytes(),
            "vals": self.values.tobytes(),
            "vecs": self.vectors.tobytes(),
        }

    @staticmethod
    def of(row: dict) -> Spectrum:
        mean = np.frombuffer(row["mean"])
        found = Spectrum(len(mean))
        found.n, found.mean = row["n"], mean
        found.values = np.frombuffer(row["vals"])
        found.vectors = np.frombuffer(row["vecs"]).reshape(len(mean), -1)
        return found


# -- over partitions ----------------------------------------------------------------------


def _matrix(values: pa.Array) -> np.ndarray:
    """Lists of equal length as rows."""
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def _partials(fit: DataFrame, work: Callable[[Iterator[np.ndarray]], dict | None]) -> DataFrame:
    """One row per partition of ``fit``, from blocks of its vectors."""

    def run(it):
        part = TaskContext.get().partitionId()
        row = work(_matrix(b.column(0)) for b in it if b.num_rows)
        if row is not None:
            yield pa.RecordBatch.from_pylist([row | {"part": part}], _SCHEMA)

    return fit.mapInArrow(run, _PARTIAL)


_SCHEMA = pa.schema(
    [("part", pa.int64()), ("n", pa.int64()), ("mean", pa.binary()), ("vals", pa.binary()), ("vecs", pa.binary())]
)


def _combined(partials: DataFrame, join: Callable[[list[dict]], dict]) -> dict | None:
    """All rows joined to one, in rounds of at most ``FAN_IN`` rows to a task."""
    rows = stored(partials, "partials")
    parts = rows.agg(F.max("part")).first()[0]
    while parts:  # the numbers 0 to parts become 0 to parts // FAN_IN
        rows = stored(
            rows.groupBy(F.expr(f"part div {FAN_IN}").alias("group")).applyInArrow(
                lambda t: pa.Table.from_pylist(
                    [_renumbered(join(t.sort_by("part").to_pylist()), t.column("part")[0].as_py() // FAN_IN)],
                    _SCHEMA,
                ),
                _PARTIAL,
            ),
            "partials",
        )
        parts //= FAN_IN
    found = rows.collect()
    return found[0].asDict() if found else None


def _renumbered(row: dict, part: int) -> dict:
    return row | {"part": part}


def incremental_spectrum(fit: DataFrame, dims: int) -> Spectrum | None:
    """Spectrum of all vectors, shifted by ``OFFSET``: updates in partitions, then merges."""

    def grow(blocks):
        found = Spectrum(dims)
        for block in blocks:
            for x in block:
                found.add((x - OFFSET).astype(float))
        return found.row(0) if found.n else None

    def join(rows):
        found = Spectrum.of(rows[0])
        for row in rows[1:]:
            found.merge(Spectrum.of(row))
        return found.row(0)

    row = _combined(_partials(fit, grow), join)
    return Spectrum.of(row) if row else None


def _away(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - sums``, exact: as int64 where that surely holds it, else as Python's integers."""
    bound = max(int(np.abs(x).max(initial=0)) * n, max(map(abs, sums.tolist()), default=0))
    if bound < 1 << 62:
        return x * np.int64(n) - sums
    return x.astype(object) * n - sums.astype(object)


def _deviations(away: np.ndarray) -> list[int | None]:
    """Sums of squares of the rows, exact; null beyond a long."""
    most = int(np.abs(away).max(initial=0))
    if most * most * max(1, away.shape[1]) <= _LONG and away.dtype != object:
        return (away * away).sum(1).tolist()
    sums = (sum(v * v for v in row) for row in away.astype(object).tolist())
    return [s if s <= _LONG else None for s in sums]


def projected_covariance(fit: DataFrame, n: int, sums: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Covariance of ``(x - sums / n) basis`` over the vectors of ``fit``, divisor n."""

    def multiply(blocks):
        total = np.zeros((basis.shape[1], basis.shape[1]))
        plain = np.zeros(basis.shape[1])
        for block in blocks:
            y = (_away(block, n, sums) / n).astype(float) @ basis
            total += y.T @ y
            plain += y.sum(0)
        return {"n": 0, "mean": plain.tobytes(), "vals": b"", "vecs": total.tobytes()}

    def join(rows):
        return rows[0] | {
            "mean": sum(np.frombuffer(r["mean"]) for r in rows).tobytes(),
            "vecs": sum(np.frombuffer(r["vecs"]) for r in rows).tobytes(),
        }

    row = _combined(_partials(fit, multiply), join)
    mean = np.frombuffer(row["mean"]) / n
    return np.frombuffer(row["vecs"]).reshape(len(mean), -1) / n - np.outer(mean, mean)


# -- the operator -------------------------------------------------------------------------


@dataclass
class Whitening:
    """A fitted model: its size depends on the number of dimensions alone."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray  # a column per component, largest eigenvalue first
    values: np.ndarray
    trace: float
    identity_error: float | None


def whole_vectors(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``id`` and ``x``: entries times 64, rounded down, plus a million.

    Vectors that are null, empty, or hold a null, a NaN or an infinity are left out, and so
    are those with an entry of 2**34 or more in size.
    """
    inside = F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < LIMIT))
    return (
        df.select(column(df, id_column).alias("id"), column(df, vector).cast("array<double>").alias("v"))
        .where(F.coalesce(inside, F.lit(False)) & (F.size("v") > 0))
        .select("id", F.transform("v", lambda c: F.floor(c * SCALE).cast("long") + OFFSET).alias("x"))
    )


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Principal components of the distinct vectors of ``x``; None without any.

    Equal vectors count once; copies collapse map-side before they are moved. Vectors have to
    have one length: the one that most distinct vectors have counts (of equals the
    shortest), others are left out.
    """
    distinct = stored(vectors.select("x").distinct(), "distinct-vectors")
    lengths = distinct.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    if lengths is None:
        return None
    dims, n = lengths
    fit_list = distinct.where(F.size("x") == dims)
    found = fit_list.select(F.posexplode("x").alias("at", "c")).groupBy("at").agg(F.sum("c").alias("s")).collect()
    sums = np.array([r["s"] for r in sorted(found)], np.int64)
    basis = np.linalg.qr(incremental_spectrum(fit_list, dims).vectors)[0]
    # Rayleigh-Ritz: the covariance in the basis found, whose eigenvectors turn it into place.
    values, turn = np.linalg.eigh(projected_covariance(fit_list, n, sums, basis))
    values, turn = values[::-1], turn[:, ::-1]
    trace = float(values.sum())
    kept = values[: min(components, dims)]
    # What is zero but for rounding has no direction.
    kept = np.where(kept > dims * _EPS * max(values[0], 0.0), kept, 0.0)
    model = Whitening(n, sums, (basis @ turn)[:, : len(kept)], kept, trace, None)
    there = kept > 0
    if there.any():
        scaled = (model.vectors / np.sqrt(np.where(there, kept, 1.0)))[:, there]
        spread = projected_covariance(fit_list, n, sums, scaled)
        model.identity_error = float(np.abs(spread - np.eye(len(spread))).max())
    return model


def whitened(vectors: DataFrame, model: Whitening) -> DataFrame:
    """``id``, ``deviation`` and ``whitened`` (a value per component) of each of ``vectors``.

    Vectors of another length than the model's are left out. ``deviation`` is exact, and null
    where it does not fit a long. Components without variance have null.
    """
    there = model.values > 0
    scaled = model.vectors / np.sqrt(np.where(there, model.values, 1.0))
    sent = vectors.sparkSession.sparkContext.broadcast((model.n, model.sums, scaled, there))

    def run(it):
        n, sums, basis, real = sent.value
        for batch in it:
            if not batch.num_rows:
                continue
            away = _away(_matrix(batch.column(1)), n, sums)
            found = (away / n).astype(float) @ basis
            mask = pa.array(np.tile(~real, len(found)))
            flat = pa.array(found.ravel(), mask=mask.to_numpy(zero_copy_only=False))
            ends = pa.array(np.arange(len(found) + 1, dtype=np.int32) * found.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_deviations(away), pa.int64()), pa.ListArray.from_arrays(ends, flat)],
                ["id", "deviation", "whitened"],
            )

    kind = dict(vectors.dtypes)["id"]
    alike = vectors.where(F.size("x") == len(model.sums))
    return alike.mapInArrow(run, f"id {kind}, deviation long, whitened array<double>")


def whiten(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row per vector and component: ``vec_id``, ``component``, ``n``, ``deviation``,
    ``whitened``, ``explained`` and ``identity_error``.

    ``n`` is the number of distinct vectors, ``explained`` the component's share of the
    variance, ``identity_error`` the largest entry of the covariance of what is whitened minus
    the identity. Repeated rows and null ids stay. Where nothing varies, ``whitened``,
    ``explained`` and ``identity_error`` are null; a table without usable vectors gives no
    rows. Other columns are not read. See `whole_vectors`, `fit` and `whitened`.
    """
    vectors = whole_vectors(df, id_column, vector)
    model = fit(vectors, components)
    kind = dict(vectors.dtypes)["id"]
    if model is None:
        return df.sparkSession.createDataFrame(
            [],
            f"{id_column} {kind}, component int, n long, deviation long, whitened double,"
            " explained double, identity_error double",
        )
    shares = F.array(*[F.lit(float(v) / model.trace if model.trace > 0 else None).cast("double") for v in model.values])
    rows = whitened(vectors, model).select("id", "deviation", F.posexplode("whitened").alias("at", "value"))
    return rows.select(
        F.col("id").alias(id_column),
        (F.col("at") + 1).alias("component"),
        F.lit(int(model.n)).cast("long").alias("n"),
        "deviation",
        F.col("value").alias("whitened"),
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(model.identity_error).cast("double").alias("identity_error"),
    )


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
