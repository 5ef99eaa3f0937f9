"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Vectors become whole numbers, ``floor(scale * c)``. The fit list holds each distinct
vector once; it is written as blocks, so a pass is one job of matrix products over
blocks. Centred rows X and unit vectors u, v give a bidiagonal matrix B, X V = U B:

* A pass multiplies every block with z (``X z``, a slice of the next u) and at once
  that slice with the block (``Xᵀ u``), which is the next v before it is made
  orthogonal. u has an entry for each row, so it never leaves the tasks: it is kept as
  ``u = X w`` with a w of the vectors' dimension, and made again in each pass.
* Full reorthogonalisation: the pass also brings the products of the new u with all
  earlier ones, and earlier u and v are taken out of the new ones.
* Where a step finds nothing more (a rank or a repeated deviation is used up) it goes
  on with a fresh direction, so that equal deviations are found as often as they occur.
* It stops when as many components as asked are settled and what is left of the
  trace cannot hold a larger one, or after as many steps as there are dimensions.

The singular values of B are the deviations (times the root of the row count), its
right vectors turn V into the components.

A pass brings one row of a few numbers for each dimension from each of at most
``TASKS`` tasks to the driver, whatever the number of vectors. Nothing is sampled.

Defined results: NULL vectors and those with NULL or non-finite entries are left out;
of different lengths the commonest one counts (the longest of several such) and vectors of other
lengths are left out too; repeated rows are each whitened but fitted once; directions
without deviation give no component, so equal vectors or a single one give no rows,
as does an empty table; NULL identifiers stay. Only the identifier and the
vector are read, whatever other columns there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

SCALE, COMPONENTS = 256, 4
#: Rows of a block, tasks of a pass, and bytes for which a task is worth its start.
BLOCK_ROWS, TASKS, TASK_BYTES = 2048, 4096, 16 << 20
#: Error of a component, and deviation below which a direction has none, both
#: relative to the largest deviation.
SETTLED, NOTHING = 1e-15, 1e-10
SEED = 13


@dataclass(frozen=True)
class Whitening:
    """n vectors of the fit list, their sums by dimension (exact), components as
    rows, eigenvalues of the covariance (divisor n), its trace."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    def centred(self, vectors: np.ndarray) -> np.ndarray:
        """n x - S as whole numbers, divided by n only then."""
        return _scaled(self.n, vectors, self.sums) / self.n

    def whitened(self, vectors: np.ndarray) -> np.ndarray:
        return self.centred(vectors) @ (self.components.T / np.sqrt(self.eigenvalues))


def _scaled(n: int, vectors: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """n x - S: in 64 bits where that is surely exact, else as Python's numbers."""
    top = max(int(np.abs(vectors).max(initial=0)) * n, int(np.abs(sums).max(initial=0)))
    if top < 2**62:
        return n * vectors - sums.astype(np.int64)
    return n * vectors.astype(object) - sums.astype(object)


def _squares(rows: np.ndarray) -> list[int]:
    """Sum of squares of each row, exact."""
    if rows.dtype != object and int(np.abs(rows).max(initial=0)) ** 2 * max(1, rows.shape[1]) < 2**63:
        return (rows * rows).sum(1).tolist()
    return [sum(int(x) ** 2 for x in row) for row in rows]


def whole_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """vec_id and x, the vectors that count as whole numbers, written to the shared
    folder."""
    found = vectors.select(F.col(id_column).alias("vec_id"), F.col(vector_column).alias("v"))
    usable = F.col("v").isNotNull() & F.forall(
        "v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf")))
    )
    whole = F.transform("v", lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    rows = stored(found.filter(usable).select("vec_id", whole.alias("x")), "whitening-vectors")
    lengths = rows.groupBy(F.size("x").alias("length")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    return rows if most is None else rows.filter(F.size("x") == most["length"])


def _matrix(block: bytes, width: int) -> np.ndarray:
    return np.frombuffer(block, "<i8").reshape(-1, width)


def _blocks(rows: DataFrame) -> DataFrame:
    """Distinct vectors as blocks of bytes: few large tasks for few vectors, at most
    ``TASKS`` for many."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK_ROWS):
                some = batch["x"].iloc[at : at + BLOCK_ROWS]
                yield pd.DataFrame({"block": [np.stack(some.to_list()).astype("<i8").tobytes()], "rows": [len(some)]})

    distinct = stored(rows.select("x").distinct(), "whitening-distinct")
    size = distinct.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("width")).first()
    tasks = min(TASKS, 1 + (size["n"] * 8 * (size["width"] or 0)) // TASK_BYTES)
    return stored(distinct.repartition(tasks).mapInPandas(pack, "block binary, rows int"), "whitening-blocks").coalesce(tasks)


def _total(blocks: DataFrame, width: int, of_block: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all blocks of what a function makes of each; one row for each task
    comes to the driver."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            for block in batch["block"]:
                own = of_block(_matrix(block, width))
                total = own if total is None else total + own
        if total is not None:
            yield pd.DataFrame({"total": [total.tobytes()]})

    parts = [np.frombuffer(r.total) for r in blocks.select("block").mapInPandas(add, "total binary").collect()]
    return np.sum(parts, axis=0)


def _exact_sums(blocks: DataFrame, width: int) -> tuple[int, np.ndarray, int]:
    """Row count, sum by dimension and sum of all squares, as whole numbers. Each
    block gives 64-bit halves, which Spark adds as decimals."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n, sums, squares = 0, [0] * width, 0
            for block in batch["block"]:
                x = _matrix(block, width)
                n += len(x)
                exact = x if len(x) * int(np.abs(x).max(initial=0)) < 2**62 else x.astype(object)
                sums = [a + int(b) for a, b in zip(sums, exact.sum(0), strict=True)]
                squares += sum(_squares(x))
            yield pd.DataFrame({"at": range(width + 2), "value": [str(v) for v in [n, squares, *sums]]})

    parts = blocks.select("block").mapInPandas(add, "at int, value string")
    totals = parts.groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("total")).collect()
    found = {r["at"]: int(r["total"]) for r in totals}
    return found[0], np.array([found[i + 2] for i in range(width)], object), found[1]


class _Bidiagonal:
    """V, w (of u = X w), g = Xᵀu and the diagonals of B, as far as they are built."""

    def __init__(self, width: int):
        self.v, self.w, self.g = (np.zeros((0, width)) for _ in range(3))
        self.alphas: list[float] = []
        self.betas: list[float] = []

    def matrix(self) -> np.ndarray:
        return np.diag(self.alphas) + np.diag(self.betas[: len(self.alphas) - 1], 1)


def _orthogonal(v: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Twice is enough."""
    for _ in range(2):
        v = v - to.T @ (to @ v)
    return v


def _fresh(draw: np.random.Generator, to: np.ndarray) -> np.ndarray:
    v = _orthogonal(draw.standard_normal(to.shape[1]), to)
    return v / np.linalg.norm(v)


def bidiagonalise(
    product: Callable[[np.ndarray, np.ndarray], tuple[float, np.ndarray, np.ndarray]], width: int, mass: float, components: int
) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors (rows) and singular values of a matrix X, largest first,
    at least as many as asked where the rank has them. ``product(z, w)`` gives, of
    r = X z and U = X wᵀ, the square of r's norm, the products Uᵀr, and Xᵀr. ``mass``
    is the sum of squares of X."""
    draw = np.random.default_rng(SEED)
    b = _Bidiagonal(width)
    v, beta, scale = _fresh(draw, b.v), 0.0, np.sqrt(mass)
    for step in range(1, width + 1):
        z = v - beta * b.w[-1] if step > 1 else v
        square, along, back = product(z, b.w)
        # Reorthogonalise the new u against all earlier ones.
        z = z - along @ b.w
        back = back - along @ b.g
        alpha = np.sqrt(max(0.0, square - float(along @ along)))
        b.v = np.vstack([b.v, v])
        if alpha <= NOTHING * scale:  # v has no deviation but what earlier ones share
            alpha, z, back = 0.0, np.zeros(width), np.zeros(width)
        else:
            z, back = z / alpha, back / alpha
        b.w, b.g = np.vstack([b.w, z]), np.vstack([b.g, back])
        b.alphas.append(float(alpha))
        follow = _orthogonal(back, b.v)
        beta = float(np.linalg.norm(follow))
        left, values, right = np.linalg.svd(b.matrix())
        if step == width or _settled(left, values, beta, mass, components):
            break
        if beta <= NOTHING * scale:
            v, beta = _fresh(draw, b.v), 0.0
        else:
            v = follow / beta
        b.betas.append(beta)
    return right @ b.v, values


def _settled(left: np.ndarray, values: np.ndarray, beta: float, mass: float, components: int) -> bool:
    """Are the first components exact, and can nothing outside be as large?"""
    if len(values) <= components:
        return False
    errors = beta * np.abs(left[-1, :components])
    outside = mass - float(values @ values)
    return bool(errors.max() <= SETTLED * values[0] and outside < (1 - 1e-6) * values[components - 1] ** 2)


def _fit(blocks: DataFrame, width: int, components: int) -> Whitening:
    n, sums, squares = _exact_sums(blocks, width)
    trace = (n * squares - sum(int(s) ** 2 for s in sums)) / n**2
    nothing = Whitening(n, sums, np.zeros((0, width)), np.zeros(0), trace)
    if trace <= 0:
        return nothing

    def product(z: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def of_block(x: np.ndarray) -> np.ndarray:
            rows = nothing.centred(x).astype(np.float64)
            r = rows @ z
            return np.concatenate([[r @ r], (rows @ w.T).T @ r, rows.T @ r])

        total = _total(blocks, width, of_block)
        return float(total[0]), total[1 : 1 + len(w)], total[1 + len(w) :]

    found, values = bidiagonalise(product, width, trace * n, components)
    eigenvalues = values**2 / n
    kept = [i for i in range(min(components, len(values))) if eigenvalues[i] > NOTHING * trace]
    return Whitening(n, sums, found[kept], eigenvalues[kept], trace)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on the distinct vectors of a frame with the column x (``whole_vectors``);
    None where there are none."""
    first = vectors.select(F.size("x").alias("width")).first()
    if first is None or not first["width"]:
        return None
    return _fit(_blocks(vectors), first["width"], components)


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the
    identity, from the rows themselves."""
    return _identity_error(_blocks(vectors), model)


def _identity_error(blocks: DataFrame, model: Whitening) -> float:
    k, width = len(model.eigenvalues), len(model.sums)
    if not k:
        return 0.0
    mean = _total(blocks, width, lambda x: model.whitened(x).astype(np.float64).sum(0)) / model.n

    def of_block(x: np.ndarray) -> np.ndarray:
        rows = model.whitened(x).astype(np.float64) - mean
        return (rows.T @ rows).ravel()

    covariance = _total(blocks, width, of_block).reshape(k, k) / model.n
    return float(np.abs(covariance - np.eye(k)).max())


WHITENED = (
    "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """For each vector that counts and each component, from 1: vec_id, component, n
    (distinct vectors), deviation (sum over dimensions of (n x - S)^2, exact),
    whitened (projection of x - S/n over the component's deviation), explained (its
    share of the trace), identity_error."""
    spark = vectors.sparkSession
    rows = whole_vectors(vectors)
    first = rows.select(F.size("x").alias("width")).first()
    if first is None or not first["width"]:
        return spark.createDataFrame([], WHITENED)
    blocks = _blocks(rows)
    model = _fit(blocks, first["width"], components)
    k, error = len(model.eigenvalues), _identity_error(blocks, model)
    share = (model.eigenvalues / model.trace).tolist() if k else []

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from decimal import Decimal

        for batch in batches:
            if not k or not len(batch):
                continue
            x = np.stack(batch["x"].to_list()).astype(np.int64)
            deviation = [Decimal(s) for s in _squares(_scaled(model.n, x, model.sums))]
            whitened = model.whitened(x).astype(np.float64)
            yield pd.DataFrame(
                {
                    "vec_id": batch["vec_id"].astype("Int64").repeat(k),
                    "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(batch)),
                    "n": np.full(len(batch) * k, model.n),
                    "deviation": pd.Series(deviation, dtype=object).repeat(k).to_numpy(),
                    "whitened": whitened.ravel(),
                    "explained": np.tile(share, len(batch)),
                    "identity_error": np.full(len(batch) * k, error),
                }
            )

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInPandas(project, WHITENED)
