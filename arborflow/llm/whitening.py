"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred rows, in blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborflow.llm.common import keep

#: Vectors that go through one alternating product together.
BLOCK = 16
#: Directions below this share of the largest deviation are noise of double precision.
NOISE = 1e-7
#: Residual, relative to the largest deviation, at which a component counts as found.
TOLERANCE = 1e-13
#: Largest absolute value of an entry of the fit list; beyond it entries saturate.
MOST = 1 << 52


def integers(embedding: Column) -> Column:
    """floor(1024 * c) + 100000 of every entry as long, saturated at MOST."""
    def one(c: Column) -> Column:
        whole = F.least(F.greatest(c.cast("double") * 1024, F.lit(-float(MOST))), F.lit(float(MOST)))
        return F.floor(whole).cast("long") + F.lit(100000).cast("long")

    return F.transform(embedding, one)


def usable(rows: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """Rows (vec_id, x, dim) of vectors that are not null, not empty and hold finite entries only."""
    array = F.col(f"`{embedding}`").cast("array<double>")
    sound = (F.size(array) > 0) & F.forall(array, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    some = rows.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), integers(array).alias("x"), F.size(array).alias("dim"), sound.alias("sound"))
    return some.where("sound").drop("sound")


def _summed(rows: DataFrame, step: Callable[[np.ndarray], np.ndarray], size: int, exact: bool = False) -> np.ndarray:
    """Sum over all rows of what `step` makes of a block of them (`size` numbers); one partial a task, added up in Spark."""
    kind, total = ("long", "decimal(38,0)") if exact else ("double", "double")

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = None
        for frame in frames:
            if len(frame):
                some = step(np.stack(frame.x.to_numpy()))
                out = some if out is None else out + some
        if out is not None:
            yield pd.DataFrame({"at": np.arange(size), "part": out.ravel()})

    parts = rows.select("x").mapInPandas(partial, f"at int, part {kind}")
    got = parts.groupBy("at").agg(F.sum(F.col("part").cast(total)).alias("part")).collect()  # `size` rows
    out = np.zeros(size, object if exact else np.float64)
    for r in got:
        out[r["at"]] = int(r.part) if exact else r.part
    return out


def _cut(gram: np.ndarray, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """(M, R) with orthonormal T M and T = (T M) R, given gram = TᵀT; directions shorter than `floor` are left out."""
    size, turn = np.linalg.eigh((gram + gram.T) / 2)
    held = size > max(floor, 1e-300) ** 2
    length = np.sqrt(size[held])
    return turn[:, held] / length, (turn[:, held] * length).T


def _orthonormal(block: np.ndarray, basis: np.ndarray, floor: float) -> np.ndarray:
    """Orthonormal columns that span what `block` has outside of `basis`."""
    for _ in range(2):
        block = block - basis @ (basis.T @ block)
    left, size, _ = np.linalg.svd(block, full_matrices=False)
    left = left[:, size > floor]
    return left - basis @ (basis.T @ left)


def bidiagonal(rows: DataFrame, mean: np.ndarray, n: int, top: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray, float]:
    """(components as columns, deviations, trace of the covariance) of the centred rows X of `rows.x`, the first `top` at most.

    X V = U B with orthonormal V and U: blocks of V and U follow from each other by the products XV and XᵀU, each made
    orthogonal to all before it, twice. V and the small B live on the driver. U has a row for every vector; its
    columns are combinations of X's, so each task makes its rows of U anew from X and a small matrix of
    coefficients, and U is never stored. A block costs two passes over X, and what a pass gathers is of size
    dim * BLOCK. It ends when the first `top` components have settled, after dim / BLOCK blocks at the latest.
    """
    dim = len(mean)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, min(BLOCK, dim))))[0]
    fresh, coefficients, back = basis, np.zeros((dim, 0)), np.zeros((dim, 0))  # V block; U = X coefficients; back = XᵀU
    small = np.zeros((0, 0))  # B
    trace, largest = 0.0, 0.0

    def measured(made: np.ndarray, known: np.ndarray, spread: bool) -> tuple[np.ndarray, ...]:
        """Over all rows with T = X made and U = X known: TᵀT, UᵀT, XᵀT, and the square sum of X if asked for."""
        a, b = made.shape[1], known.shape[1]

        def step(x: np.ndarray) -> np.ndarray:
            x = x - mean
            t = x @ made
            square = [np.array([(x * x).sum()])] if spread else []
            return np.concatenate([(t.T @ t).ravel(), ((x @ known).T @ t).ravel(), (x.T @ t).ravel(), *square])

        flat = _summed(rows, step, a * a + b * a + dim * a + spread)
        parts = np.split(flat, np.cumsum([a * a, b * a, dim * a]))
        return parts[0].reshape(a, a), parts[1].reshape(b, a), parts[2].reshape(dim, a), parts[3]

    while True:
        made, old = fresh, coefficients.shape[1]
        _, along, _, square = measured(made, coefficients, not old)  # the product Xv, and what of it U has already
        if not old:
            trace = float(square[0]) / n
        made = made - coefficients @ along
        gram, again, towards, _ = measured(made, coefficients, False)  # the product Xᵀu of the block made orthogonal
        made, towards, gram = made - coefficients @ again, towards - back @ again, gram - again.T @ again
        largest = max(largest, float(np.sqrt(max(np.linalg.eigvalsh(gram).max(), 0.0))))
        turn, rest = _cut(gram, NOISE * largest)
        grown = np.zeros((old + turn.shape[1], small.shape[1] + fresh.shape[1]))
        grown[:old, : small.shape[1]] = small
        grown[:old, small.shape[1] :] = along + again
        grown[old:, small.shape[1] :] = rest
        small = grown
        coefficients = np.hstack([coefficients, made @ turn])
        back = np.hstack([back, towards @ turn])
        if not len(small):
            return np.zeros((dim, 0)), np.zeros(0), trace
        left, sizes, right = np.linalg.svd(small, full_matrices=False)
        residual = back - basis @ (basis.T @ back)  # XᵀU outside of V, the same for every vector of U but the last
        open_ends = np.linalg.norm(residual @ left[:, :top], axis=0)
        done = len(sizes) >= min(top, dim) and open_ends.max() <= TOLERANCE * sizes[0]
        fresh = _orthonormal(residual, basis, NOISE * largest)[:, : dim - basis.shape[1]]
        if done or not turn.shape[1] or not fresh.shape[1]:
            held = sizes[:top] > NOISE * sizes[0]
            return basis @ right[:top][held].T, sizes[:top][held] / np.sqrt(n), trace
        basis = np.hstack([basis, fresh])


def whiten(vectors: DataFrame, top: int = 8, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Every usable vector on the `top` first components: vec_id, component, n, deviation, whitened, explained, identity_error.

    An entry c is x = floor(1024 * c) + 100000. `deviation` is the sum over dimensions of (n * x - S)^2 with S the
    sums of the fit list, exact, null where a long cannot hold it. `whitened` is the centred row's projection over the
    component's deviation, `explained` the component's share of the variance, `identity_error` the largest distance of the
    whitened covariance, measured over all rows, from the identity. Components have the sign in which their largest entry is positive.

    Null and empty vectors and those with null or non-finite entries are dropped; entries saturate at 2^52. Vectors of
    another length than the most common one (the smaller on a tie) are dropped too. Rows that repeat count each, null
    ids stay null. Components without variance have no rows: equal rows only, or a single one, give an empty result,
    as an empty table does. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = keep(usable(vectors, vec_id, embedding), "integers")
    sizes = rows.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    if sizes is None:
        return spark.createDataFrame([], schema)
    dim, n = sizes.dim, sizes.n
    rows = rows.where(F.col("dim") == dim).select("vec_id", "x")
    halves = _summed(rows, lambda x: np.concatenate([(x >> 26).sum(axis=0), (x & ((1 << 26) - 1)).sum(axis=0)]), 2 * dim, exact=True)
    sums = [(int(high) << 26) + int(low) for high, low in zip(halves[:dim], halves[dim:], strict=True)]
    # integer and remainder apart: the mean to the last bit, however large the sums are
    mean = np.array([s // n + (s % n) / n for s in sums], np.float64)
    components, deviations, trace = bidiagonal(rows, mean, n, top)
    found = len(deviations)
    if not found:
        return spark.createDataFrame([], schema)
    components = components * np.sign(components[np.abs(components).argmax(axis=0), np.arange(found)])
    scaled = components / deviations

    centre = _summed(rows, lambda x: ((x - mean) @ scaled).sum(axis=0), found) / n

    def products(x: np.ndarray) -> np.ndarray:
        z = (x - mean) @ scaled - centre
        return (z.T @ z).ravel()

    error = float(np.abs(_summed(rows, products, found * found).reshape(found, found) / n - np.eye(found)).max())

    def project(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                z = (np.stack(frame.x.to_numpy()) - mean) @ scaled
                yield pd.DataFrame({"vec_id": frame.vec_id, "deviation": frame.deviation, "z": list(z)})

    def square(x: Column, s: Column) -> Column:
        away = F.try_subtract(F.try_multiply(F.lit(n).cast("long"), x), s)
        return F.try_multiply(away, away)

    totals = F.array(*[F.lit(s if abs(s) < 1 << 63 else None).cast("long") for s in sums])
    away = F.aggregate(F.zip_with("x", totals, square), F.lit(0).cast("long"), F.try_add)
    # ids and deviations as text on their way through pandas, which has no null integers
    texts = rows.select(F.col("vec_id").cast("string").alias("vec_id"), away.cast("string").alias("deviation"), "x")
    wide = texts.mapInPandas(project, "vec_id string, deviation string, z array<double>")
    shares = F.array(*[F.lit(float(d * d / trace)) for d in deviations])
    long = wide.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("deviation").cast("long").alias("deviation"), F.posexplode("z").alias("k", "whitened"))
    return long.select(
        "vec_id", (F.col("k") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        shares[F.col("k")].alias("explained"), F.lit(error).alias("identity_error"),
    )
