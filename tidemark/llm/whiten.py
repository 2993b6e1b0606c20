"""Embedding whitening by shifted CholeskyQR.

The centred rows A are orthogonalised without ever being held in one place: a
distributed pass sums the Gram matrix of the rows, its Cholesky factor R turns
each row into its share of an orthogonal Q by a triangular solve, and further
passes do the same to Q until its Gram matrix is the identity.  The first
factor is shifted, so that it exists for badly conditioned rows too.  A = Q R
with the factors' product R, a small matrix, whose singular value decomposition
gives the components.

The driver holds matrices of the size of a vector squared, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType, DoubleType

from tidemark.llm.common import batched, staged

SCALE, OFFSET = 1024, 100_000
#: Larger entries count as this; beyond it a double has no room for the fraction.
LARGEST = 1 << 52
#: Directions this much shorter than the longest one are rounding errors.
NEGLIGIBLE = 1e-7
#: Integers below this can be added once and stay 64-bit.
SAFE = 1 << 62


@dataclass
class Whitening:
    """``n`` vectors with sums ``sums``; column k of ``axes`` is the unit
    eigenvector of the covariance with eigenvalue ``eigen[k]``; ``explained`` is
    its share of the total variance."""

    n: int
    sums: list[int]
    axes: np.ndarray
    eigen: np.ndarray
    explained: np.ndarray


def usable(vectors: DataFrame) -> DataFrame:
    """The rows whose vector is not null and has only finite entries."""
    ok = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.where(F.coalesce(ok, F.lit(False)))


def _integers(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of floor(1024 c) + 100000; short ones as if filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype("f8"))
    flat = np.clip(flat, -LARGEST, LARGEST).astype("i8") + OFFSET
    if (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.full((len(sizes), dim), OFFSET, "i8")
    out[np.arange(dim) < sizes[:, None]] = flat
    return out


def _largest(x: np.ndarray) -> int:
    return max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exactly (as Python integers where 64 bits don't do)."""
    if n * _largest(x) + max(map(abs, sums), default=0) >= SAFE:
        x = x.astype(object)
    return n * x - np.array(sums, x.dtype)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return _deviations(x, n, sums).astype("f8") / n


def _solve(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """Rows times the inverse of an upper triangular factor, by substitution."""
    out = np.empty_like(rows)
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def _gram(rows: DataFrame, dim: int, matrix_of) -> np.ndarray:
    """Sum over all rows of the outer products of ``matrix_of(batch)``'s rows.
    Each task sends one partial sum by cells; Spark adds them up."""
    upper = np.triu_indices(dim)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            m = matrix_of(batch)
            total += m.T @ m
        cells = total[upper]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], ["cell", "v"])

    out = np.zeros((dim, dim))
    sums = rows.mapInArrow(partial, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v"))
    for r in sums.collect():  # dim * (dim + 1) / 2 cells
        i, j = upper[0][r["cell"]], upper[1][r["cell"]]
        out[i, j] = out[j, i] = r["v"]
    return out


def _factor(gram: np.ndarray, dead: set[int]) -> np.ndarray:
    """Upper triangular R with R'R = gram.  A column that the ones before it
    give but for rounding goes to ``dead``: its row of R has the diagonal 1 alone."""
    dim = len(gram)
    r, least = np.zeros((dim, dim)), NEGLIGIBLE ** 2 * max(np.diag(gram).max(), np.finfo(float).tiny)
    for j in range(dim):
        pivot = gram[j, j] - r[:j, j] @ r[:j, j]
        if j in dead or pivot <= least:
            dead.add(j)
            r[j, j] = 1
            continue
        r[j, j] = np.sqrt(pivot)
        r[j, j + 1:] = (gram[j, j + 1:] - r[:j, j] @ r[:j, j + 1:]) / r[j, j]
    return r


def _moments(rows: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Number of rows and exact sums by dimension."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dim, object)
        for batch in batches:
            x = _integers(batch.column(0), dim)
            wide = _largest(x) * max(1, len(x)) >= SAFE
            total += x.astype(object).sum(axis=0) if wide else x.sum(axis=0).astype(object)
            n += len(x)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, dim)), pa.array([n, *map(int, total)], pa.decimal128(38, 0))], ["d", "s"])

    got = rows.mapInArrow(partial, "d long, s decimal(38, 0)").groupBy("d").agg(
        F.sum("s").cast("decimal(38, 0)").alias("s")).collect()  # dim + 1 rows
    by = {r["d"]: int(r["s"]) for r in got}
    return by.get(-1, 0), [by.get(d, 0) for d in range(dim)]


def fit(vectors: DataFrame, components: int = 8, most_passes: int = 8) -> Whitening:
    """Learn the whitening of ``vectors(embedding, ...)`` from all its usable rows.

    A component c counts as floor(1024 c) + 100000 (beyond 2^52 as that).  The
    dimension is that of the longest vector, shorter ones are filled up with zeros.
    Components are ordered by falling variance, with the largest entry positive.
    Where rows span fewer directions than ``components``, the others have the
    eigenvalue 0.  Repeated rows count each time; without rows, n is 0.
    """
    rows = batched(usable(vectors)).select(F.col("embedding").cast("array<double>").alias("x"))
    dim = rows.agg(F.max(F.size("x"))).first()[0] or 0
    n, sums = _moments(rows, dim) if dim else (0, [])
    if not n:
        return Whitening(0, [], np.zeros((0, 0)), np.zeros(0), np.zeros(0))
    factors: list[np.ndarray] = []

    def orthogonal(batch: pa.RecordBatch) -> np.ndarray:
        q = _centred(_integers(batch.column(0), dim), n, sums)
        for r in factors:
            q = _solve(q, r)
        return q

    whole, dead, eps = np.eye(dim), set(), np.finfo(float).eps
    total = 0.0
    for k in range(most_passes):
        gram = _gram(rows, dim, orthogonal)
        if not k:
            total = float(np.trace(gram))
            if not total:
                break
            # Rows that are a whole number of steps from the mean: no shift is left if all are equal.
            gram += np.eye(dim) * 11 * (n * dim + dim * (dim + 1)) * eps / 2 * np.linalg.norm(gram, 2)
        live = [j for j in range(dim) if j not in dead]
        if k and np.abs(gram[np.ix_(live, live)] - np.eye(len(live))).max() <= 50 * dim * eps:
            break
        factors.append(_factor(gram, dead))
        whole = factors[-1] @ whole
    if not total:
        axes, eigen = np.eye(dim), np.zeros(dim)
    else:
        whole[sorted(dead)] = 0  # nothing of Q is left there
        _, values, axes_t = np.linalg.svd(whole)
        axes = axes_t.T
        eigen = np.where(values > NEGLIGIBLE * values[0], values ** 2 / n, 0.0)
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(dim)])
    keep = min(components, dim)
    share = eigen[:keep] * n / total if total else np.zeros(keep)
    return Whitening(n, sums, axes[:, :keep], eigen[:keep], share)


def apply(vectors: DataFrame, model: Whitening) -> DataFrame:
    """``vectors(embedding, ...)`` -> its usable rows, all other columns, and
    ``whitened array<double>`` (one entry a component, null where the eigenvalue
    is 0) and ``deviation decimal(38,0)``: the sum over dimensions of (n x - S)^2,
    exact, null beyond 38 digits.  Columns already so called are replaced."""
    kept = [c for c in vectors.columns if c not in ("embedding", "whitened", "deviation")]
    n, sums, dim = model.n, model.sums, len(model.sums)
    live = model.eigen > 0
    scale = np.where(live, 1 / np.sqrt(np.where(live, model.eigen, 1)), 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _integers(batch.column(len(kept)), dim)
            d = _deviations(x, n, sums)
            projected = (d.astype("f8") / n) @ model.axes * scale
            if _largest(d) ** 2 * dim >= SAFE:
                d = d.astype(object)
            square = [int(v) if v < 10 ** 38 else None for v in (d * d).sum(axis=1)]
            flat = pa.array(projected.ravel(), mask=np.tile(~live, len(x)))
            offsets = pa.array(np.arange(len(x) + 1, dtype="i4") * len(live))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(kept)], pa.ListArray.from_arrays(offsets, flat),
                 pa.array(square, pa.decimal128(38, 0))], [*kept, "whitened", "deviation"])

    rows = batched(usable(vectors)).select(*[F.col(f"`{c}`") for c in kept],
                                           F.col("embedding").cast("array<double>").alias("embedding"))
    schema = rows.select(*[F.col(f"`{c}`") for c in kept]).schema.add(
        "whitened", ArrayType(DoubleType())).add("deviation", DecimalType(38, 0))
    if not n:
        return vectors.sparkSession.createDataFrame([], schema)
    return rows.mapInArrow(run, schema)


def identity_error(whitened: DataFrame, model: Whitening) -> float:
    """Largest entry, by its amount, of the covariance of ``whitened`` less the
    identity, over the components with an eigenvalue above 0 (0 if there are none)."""
    live = np.flatnonzero(model.eigen > 0)
    if not len(live):
        return 0.0

    def with_one(batch: pa.RecordBatch) -> np.ndarray:
        flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
        m = flat.reshape(batch.num_rows, -1)[:, live]
        return np.column_stack([m, np.ones(len(m))])

    gram = _gram(batched(whitened).select("whitened"), len(live) + 1, with_one) / model.n
    mean = gram[:-1, -1]  # 0 but for rounding, as the rows were centred before
    return float(np.abs(gram[:-1, :-1] - np.outer(mean, mean) - np.eye(len(live))).max())


def whiten(vectors: DataFrame, components: int = 8) -> DataFrame:
    """``vectors(vec_id, embedding, ...)`` -> a row for each usable vector and
    component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null or holds a null or non-finite entry are left out; a
    null id is as good as any, repeated rows are answered each time, and an empty
    table gives no row.  Vectors have up to ``components`` components, fewer where
    the dimension is smaller; where all rows lie in fewer directions, the rest are
    null in ``whitened`` with ``explained`` 0.  ``deviation`` is null where it does
    not fit a long.  Other columns are left out.
    """
    rows = vectors.select("vec_id", "embedding")
    model = fit(rows, components)
    done = staged(apply(rows, model), "whitened")
    error = identity_error(done, model)
    explained = F.array(*[F.lit(float(x)) for x in model.explained]) if model.n else F.array().cast("array<double>")
    return done.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
        F.expr("try_cast(deviation as long)").alias("deviation"), "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
