"""Whitening of embeddings: principal components of their covariance by FEAST contour integration.

Sums and products over the vectors are whole numbers, added up by Spark, so the covariance does not depend on how the rows
are dealt out as long as they stay below 2^53, and only by rounding beyond. Its spectrum is cut into intervals by counting eigenvalues: the shifted matrix V - s has as many
positive pivots as V has eigenvalues above s (Sylvester's law of inertia). The shifts of a round are counted in one job,
and so are the intervals solved, each by itself (Polizzi, "Density-matrix-based algorithm for solving eigenvalue
problems", 2009): the integral of the resolvent around an interval projects onto its eigenvectors, and Gauss-Legendre
quadrature turns it into a few complex shifted solves; Rayleigh-Ritz steps in the projected space extract the
components. An interval is done when it has as many converged components as the inertia counts say, so none is missed.

Only tables of the size of the covariance reach the driver: dimensions times dimensions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingmill.sources.shared import materialize


@dataclass(frozen=True)
class WhiteningOptions:
    """How many components; an entry c counts as floor(`scale` * c) + `offset`; quadrature nodes of half a circle,
    eigenvalues up to which an interval is not cut again, parts into which one is cut, refinements of an
    interval, and how often other cuts are tried if one falls on an eigenvalue."""

    components: int = 16
    scale: int = 64
    offset: int = 1_000_000
    nodes: int = 8
    most: int = 4
    parts: int = 8
    refinements: int = 40
    attempts: int = 4
    seed: int = 13


@dataclass(frozen=True)
class Components:
    """`n` different vectors with the sums `sums`; `values` (falling) and unit `vectors` (one a column) of their
    covariance, whose trace is `trace`."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def centre(self) -> np.ndarray:
        """The whole numbers next to the means."""
        return np.array([_nearest(s, self.n) for s in self.sums], dtype=np.int64)

    @property
    def beside(self) -> np.ndarray:
        """What the means have beside them."""
        return np.array([(s - self.n * _nearest(s, self.n)) / self.n for s in self.sums])

    @property
    def weights(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def _nearest(total: int, n: int) -> int:
    return (2 * total + n) // (2 * n)


def whole_vectors(rows: DataFrame, vector: str, options: WhiteningOptions = WhiteningOptions()) -> DataFrame:
    """`rows` with `x` ARRAY<BIGINT>, the entries as whole numbers, without rows whose vector is NULL or empty or holds a
    NULL or non-finite entry."""
    real = F.transform(F.col(vector), lambda c: c.cast("double"))
    sound = F.forall(real, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = rows.filter(F.col(vector).isNotNull() & (F.size(vector) > 0) & sound)
    return kept.withColumn("x", F.transform(real, lambda c: F.floor(c * options.scale) + F.lit(options.offset).cast("long")))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column(0)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _products(y: np.ndarray) -> np.ndarray:
    """y' y of whole numbers: exact as long as all sums stay below 2^53."""
    real = y.astype(np.float64)
    return real.T @ real


def _summed(vectors: DataFrame, part: Callable[[np.ndarray], np.ndarray], kind: str = "long") -> np.ndarray:
    """The sum over all rows of `part`, which maps a block of vectors to a matrix of fixed shape.

    Every task adds its own blocks up and gives one row of the matrix at a time; those are added by a
    combining aggregate.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = part(_matrix(batch))
                total = found if total is None else total + found
        if total is not None:
            rows = pa.array(list(total), type=pa.list_(pa.int64() if kind == "long" else pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), type=pa.int32()), rows], names=["i", "row"])

    found = vectors.select("x").mapInArrow(sums, f"i int, row array<{kind}>")
    cells = found.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((1 + max(c["i"] for c in cells), 1 + max(c["j"] for c in cells)), dtype=object if kind == "long" else float)
    for c in cells:
        out[c["i"], c["j"]] = c["v"]
    return out


def positive_pivots(matrix: np.ndarray) -> int:
    """The number of positive eigenvalues of a symmetric matrix, from the blocks of its factors L D L'.

    Pivots are single or in pairs, chosen from the whole rest (Bunch and Parlett); a pair has one positive and one
    negative eigenvalue.
    """
    rest, found = np.array(matrix, dtype=float), 0
    while len(rest):
        sizes = np.abs(rest)
        diagonal = sizes.diagonal().copy()
        single = int(diagonal.argmax())
        np.fill_diagonal(sizes, 0)
        p, q = divmod(int(sizes.argmax()), len(rest))
        if max(diagonal[single], sizes[p, q]) == 0:
            break
        if diagonal[single] >= 0.6404 * sizes[p, q]:
            pivots = [single]
            found += rest[single, single] > 0
        else:
            pivots = [p, q]
            found += 1
        others = np.delete(np.arange(len(rest)), pivots)
        side = rest[np.ix_(others, pivots)]
        rest = rest[np.ix_(others, others)] - side @ np.linalg.solve(rest[np.ix_(pivots, pivots)], side.T)
        rest = (rest + rest.T) / 2
    return int(found)


def contour_projection(matrix: np.ndarray, low: float, high: float, block: np.ndarray, nodes: int) -> np.ndarray:
    """The columns of `block` projected onto the eigenvectors with eigenvalues between `low` and `high`, as far as
    the quadrature goes. The lower half of the circle gives the conjugate of the upper one."""
    places, weights = np.polynomial.legendre.leggauss(nodes)
    centre, radius = (low + high) / 2, (high - low) / 2
    out = np.zeros(block.shape)
    for place, weight in zip(places, weights):
        turn = radius * np.exp(0.5j * np.pi * (1 - place))
        shifted = (centre + turn) * np.eye(len(matrix)) - matrix
        out += weight / 2 * (turn * np.linalg.solve(shifted, block)).real
    return out


def interval_components(matrix: np.ndarray, low: float, high: float, count: int, options: WhiteningOptions) -> tuple[np.ndarray, np.ndarray] | None:
    """Eigenvalues and unit eigenvectors between `low` and `high`, of which there are `count`; None if not that many
    converge."""
    d = len(matrix)
    scale = np.abs(matrix).sum(axis=0).max()
    block = np.random.default_rng(options.seed).standard_normal((d, min(d, 2 * count + 8)))
    best, found = np.inf, None
    for _ in range(options.refinements):
        base, _ = np.linalg.qr(contour_projection(matrix, low, high, block, options.nodes))
        values, turns = np.linalg.eigh(base.T @ matrix @ base)
        block = base @ turns
        inside = (values > low) & (values < high)
        off = np.linalg.norm(matrix @ block - block * values, axis=0)
        converged = inside & (off <= 1e-9 * scale)
        if converged.sum() == count:
            worst = off[converged].max()
            if worst >= best / 2:  # as good as rounding allows
                return found
            best, found = worst, (values[converged], block[:, converged])
    return found


def _by_spark(vectors: DataFrame, rows: list[tuple], schema: str, out: str, work: Callable[[pd.DataFrame], pd.DataFrame]) -> list:
    """`work` on each row in a task of its own; `rows` are shifts or intervals, a few per component."""
    spark = vectors.sparkSession

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield work(batch)

    dealt = spark.createDataFrame(rows, schema).repartition(min(len(rows), 2 * spark.sparkContext.defaultParallelism))
    return dealt.mapInPandas(each, out).collect()


def intervals(vectors: DataFrame, matrix, options: WhiteningOptions, attempt: int = 0) -> list[tuple[float, float, int]]:
    """(low, high, count): intervals without a common point that hold the largest eigenvalues, `components` of them or
    all that are not 0 within rounding. None holds over `most`, unless they lie closer than can be told apart.

    `matrix` is the broadcast covariance; every round counts its shifts in one job.
    """

    def counts(shifts: list[float]) -> list[int]:
        def work(batch: pd.DataFrame) -> pd.DataFrame:
            v = matrix.value
            return batch.assign(above=[positive_pivots(v - s * np.eye(len(v))) for s in batch["shift"]])

        rows = _by_spark(vectors, list(enumerate(shifts)), "at long, shift double", "at long, shift double, above long", work)
        return [r["above"] for r in sorted(rows, key=lambda r: r["at"])]

    bound = float(np.abs(matrix.value).sum(axis=0).max())
    low, high = float(bound * len(matrix.value) * np.finfo(float).eps * 4), bound * (1 + 1e-9)
    if bound == 0:
        return []
    done, open_ = [], [(low, high, counts([low])[0], 0)]
    while open_:
        # uneven parts, others with each attempt, so that a cut is unlikely to be on an eigenvalue
        steps = [(i + 0.0371 * (attempt + 1)) / options.parts for i in range(1, options.parts)]
        cuts = [[lo + (hi - lo) * s for s in steps] for lo, hi, _, _ in open_]
        above = iter(counts([c for row in cuts for c in row]))
        cells = []
        for (lo, hi, n_lo, n_hi), row in zip(open_, cuts):
            edges = [lo, *row, hi]
            numbers = [n_lo, *(next(above) for _ in row), n_hi]
            cells += [(a, b, x, y) for a, b, x, y in zip(edges, edges[1:], numbers, numbers[1:]) if x > y and y < options.components]
        small = [c[2] - c[3] <= options.most or c[1] - c[0] < 1e-11 * bound for c in cells]
        done += [(lo, hi, x - y) for (lo, hi, x, y), ok in zip(cells, small) if ok]
        open_ = [c for c, ok in zip(cells, small) if not ok]
    return done


def principal_components(vectors: DataFrame, options: WhiteningOptions = WhiteningOptions()) -> Components | None:
    """The largest components of the covariance (divisor: the number of rows) of `vectors` (x ARRAY<BIGINT>).

    All vectors need one length, else the job fails with a message. None without rows. There are fewer components
    than asked for if the covariance has a lower rank, none if all vectors are equal.
    """
    shape = vectors.agg(F.count("*").alias("n"), F.min(F.size("x")).alias("low"), F.max(F.size("x")).alias("high")).first()
    if not shape["n"]:
        return None
    if shape["low"] != shape["high"]:
        raise ValueError(f"vectors of {shape['low']} to {shape['high']} entries; all need as many")
    n = shape["n"]
    sums = [int(s) for s in _summed(vectors, lambda x: x.sum(axis=0, keepdims=True))[0]]
    centre = np.array([_nearest(s, n) for s in sums], dtype=np.int64)
    products = _summed(vectors, lambda x: _products(x - centre), "double")
    beside = [s - n * int(c) for s, c in zip(sums, centre)]
    # whole numbers of any size, rounded once
    covariance = np.array([[(n * int(p) - a * b) / (n * n) for p, b in zip(row, beside)] for row, a in zip(products, beside)])
    trace = float(np.trace(covariance))
    matrix = vectors.sparkSession.sparkContext.broadcast(covariance)
    for attempt in range(options.attempts):
        cells = intervals(vectors, matrix, options, attempt)
        if not cells:
            return Components(n, sums, np.zeros(0), np.zeros((len(sums), 0)), trace)

        def work(batch: pd.DataFrame) -> pd.DataFrame:
            solved = [interval_components(matrix.value, lo, hi, k, options) for lo, hi, k in batch.itertuples(index=False, name=None)]
            return pd.DataFrame({"vectors": [None if s is None else s[1].tobytes() for s in solved]})

        parts = [r["vectors"] for r in _by_spark(vectors, cells, "low double, high double, count long", "vectors binary", work)]
        if all(p is not None for p in parts):
            break
    else:
        raise RuntimeError("components were missed: the counts of eigenvalues and those found differ")
    found = np.hstack([np.frombuffer(p).reshape(len(sums), -1) for p in parts])
    # one more Rayleigh-Ritz step over all intervals makes them unit vectors at right angles to each other
    base, _ = np.linalg.qr(found)
    values, turns = np.linalg.eigh(base.T @ covariance @ base)
    best = np.argsort(-values, kind="stable")[: options.components]
    chosen = (base @ turns)[:, best]
    signs = np.sign(chosen[np.abs(chosen).argmax(axis=0), np.arange(len(best))])
    return Components(n, sums, values[best], chosen * signs, trace)


def _whitened(x: Column, found: Components) -> Column:
    centre, beside, weights = found.centre, found.beside, found.weights

    @F.pandas_udf("array<double>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            rows = np.stack(batch.to_list()) if len(batch) else np.zeros((0, len(centre)))
            yield pd.Series(list((rows - centre - beside) @ weights), dtype=object)

    return of(x)


def whiten(
    rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", options: WhiteningOptions = WhiteningOptions()
) -> DataFrame:
    """One row per sound row and component: id, component (from 1, by falling variance), n, deviation, whitened, explained,
    identity_error.

    Components are fitted to the different vectors, each once, and applied to all rows. `n` is the number of
    different vectors, `deviation` DECIMAL(38,0) the exact sum over dimensions of (n * x - sum)^2, `whitened` the
    centred vector on the component over its standard deviation, `explained` the component's share of
    the variance, and `identity_error` the largest entry of the covariance of `whitened` over the fitted vectors
    minus the identity, measured on them. Rows whose vector is NULL or empty or holds a NULL or non-finite entry
    are left out; repeated rows stay repeated, and NULL ids are ids. A component whose variance is 0 within rounding cannot be
    whitened and is none; with one different vector, or no row, the result is empty. Vectors of
    different lengths are an error. Other columns are neither read nor returned.
    """
    sound = whole_vectors(rows.select(F.col(id_col).alias("id"), F.col(vector).alias("v")), "v", options).select("id", "x")
    different = materialize(sound.select("x").distinct())
    found = principal_components(different, options)
    out = (
        f"{id_col} {rows.schema[id_col].dataType.simpleString()}, component int, n long, deviation decimal(38,0), "
        "whitened double, explained double, identity_error double"
    )
    if found is None or not len(found.values):
        return rows.sparkSession.createDataFrame([], out)
    centre, beside, weights = found.centre, found.beside, found.weights

    def spread(x: np.ndarray) -> np.ndarray:
        z = (x - centre - beside) @ weights
        return np.vstack([z.T @ z, z.sum(axis=0, keepdims=True)])

    total = _summed(different, spread, "double") / found.n
    error = float(np.abs(total[:-1] - np.outer(total[-1], total[-1]) - np.eye(len(found.values))).max())
    wide = "decimal(19,0)"
    apart = F.zip_with("x", F.lit(found.sums).cast("array<bigint>"), lambda x, s: x * F.lit(found.n).cast("long") - s)
    squares = F.aggregate(
        apart, F.lit(0).cast("decimal(38,0)"), lambda sum_, y: (sum_ + y.cast(wide) * y.cast(wide)).cast("decimal(38,0)")
    )
    explained = F.lit([float(v) for v in found.values / found.trace]).cast("array<double>")
    done = sound.select("id", squares.alias("deviation"), _whitened(F.col("x"), found).alias("z"))
    each = done.select("id", "deviation", F.posexplode("z").alias("at", "whitened"))
    return each.select(
        F.col("id").alias(id_col),
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(found.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
