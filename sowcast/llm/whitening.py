"""Embeddings whitened on their leading principal components, found by Jacobi-Davidson.

Entries are made integers, ``floor(scale * c)``, so that counts and sums are exact. Each
different vector counts once in the covariance (the fit list), whose matrix is never
formed: a pass over the list multiplies it with a few directions at once, each task with
its centred vectors, and what tasks return are sums as long as the directions.

The search space is of the length of a vector and lies on the driver. Each step takes
its Rayleigh-Ritz pairs, locks the leading ones whose residual is at the rounding error,
and extends the space by corrections of the others: MINRES on the equation projected to
what is orthogonal to the pair and to all locked ones. All pairs' MINRES run abreast, so
that one pass serves them all. A space that gets large is restarted from its best pairs.

Rows are left out whose vector is null or empty or holds a null, NaN or infinite entry.
Vectors of different lengths are an error, and so are integers of 2**24 and more. Fewer
components come back where the covariance has no more of variance above rounding, none at
all for one different vector or none. Rows count once each in the result, those that
repeat an id or a vector too. Other columns are not read.
"""

from collections.abc import Callable, Generator, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sowcast.sources.scratch import stored

LARGEST = 1 << 24  # of an integer: its square, summed over an Arrow batch, fits into 64 bits
EPS = float(np.finfo(float).eps)


class Components(NamedTuple):
    """Of the fit list: its length, sums and trace of the covariance, and unit vectors
    (as columns) with their variances, largest first."""

    n: int
    sums: list[int]
    trace: float
    directions: np.ndarray
    variances: np.ndarray


def integer_vectors(rows: DataFrame, vector_column: str, scale: int) -> tuple[Column, Column]:
    """Whether a row's vector is used, and its integers."""
    vector = F.col(vector_column)
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    too_large = F.raise_error(F.lit(f"vectors have entries of {LARGEST // scale} or more")).cast("bigint")

    def integer(c: Column) -> Column:
        x = F.floor(c.cast("double") * F.lit(float(scale)))
        return F.when(F.abs(x) < LARGEST, x).otherwise(too_large)

    return vector.isNotNull() & (F.size(vector) > 0) & finite, F.transform(vector, integer)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _summed(fit: DataFrame, of: Callable[[np.ndarray], np.ndarray], type_: str) -> list:
    """The sum over all batches of the numbers that ``of`` makes of each, in Spark."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = of(_matrix(batch.column(0)))
                if type_ == "LONG":  # exact: added up by Spark, in more digits
                    yield rows(own)
                else:
                    total = own if total is None else total + own
        if total is not None:
            yield rows(total)

    def rows(values: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.arange(values.size, dtype=np.int32)), pa.array(values.ravel())], names=["at", "value"])

    value = F.col("value").cast("decimal(20,0)") if type_ == "LONG" else F.col("value")
    found = fit.mapInArrow(partial, f"at INT, value {type_}").groupBy("at").agg(F.sum(value).alias("value")).collect()
    return [r.value for r in sorted(found, key=lambda r: r["at"])]  # one for each entry, whatever the rows


def minres(b: np.ndarray, steps: int, tolerance: float) -> Generator[np.ndarray, np.ndarray, np.ndarray]:
    """Solve a symmetric, maybe indefinite system by minimal residuals. Yields the
    vectors that are to be multiplied and is sent the products; returns the solution."""
    x = np.zeros_like(b)
    beta = size = float(np.linalg.norm(b))
    if not beta:
        return x
    before, now = np.zeros_like(b), b / beta
    w_before, w = np.zeros_like(b), np.zeros_like(b)
    # of the last two plane rotations
    cosine_before, sine_before, cosine, sine = 1.0, 0.0, 1.0, 0.0
    beta_now = 0.0
    for _ in range(steps):
        product = yield now
        alpha = float(now @ product)
        next_ = product - alpha * now - beta_now * before
        beta_next = float(np.linalg.norm(next_))
        # the new column of the tridiagonal matrix, rotated as the ones before
        above = sine_before * beta_now
        middle = cosine_before * beta_now
        diagonal = cosine * alpha - sine * middle
        upper = sine * alpha + cosine * middle
        corner = float(np.hypot(diagonal, beta_next))
        if not corner:
            break
        cosine_before, sine_before = cosine, sine
        cosine, sine = diagonal / corner, beta_next / corner
        w_before, w = w, (now - upper * w - above * w_before) / corner
        x = x + cosine * beta * w
        beta = -sine * beta
        if abs(beta) <= tolerance * size or beta_next <= EPS * corner:
            break
        before, now, beta_now = now, next_ / beta_next, beta_next
    return x


def _orthonormal(new: np.ndarray, against: np.ndarray) -> np.ndarray:
    """What is new in some vectors, as orthonormal ones, without those that bring nothing."""
    kept = against
    for v in new.T:
        size = np.linalg.norm(v)
        if not np.isfinite(size) or not size:
            continue
        v = v / size
        for _ in range(3):
            v = v - kept @ (kept.T @ v)
            left = np.linalg.norm(v)
            if left < 1e-10:
                break
            v = v / left
        else:
            kept = np.column_stack([kept, v])
    return kept[:, against.shape[1] :]


def jacobi_davidson(
    multiply: Callable[[np.ndarray], np.ndarray],
    dims: int,
    wanted: int,
    inner_steps: int = 4,
    together: int = 6,
    most_vectors: int = 40,
    seed: int = 7,
) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix that is known by its
    products with blocks of vectors, and unit eigenvectors as columns.

    A residual is at the rounding error when its norm is at most ``dims`` roundings of
    the largest eigenvalue. Raises if that is not reached.
    """
    rng = np.random.default_rng(seed)
    wanted = min(wanted, dims)
    locked, values = np.zeros((dims, 0)), []
    space = _orthonormal(rng.standard_normal((dims, min(dims, 2 * wanted))), locked)
    products = multiply(space)
    restart = min(dims, 3 * wanted)
    for step in range(300):
        small = space.T @ products
        theta, rotate = np.linalg.eigh((small + small.T) / 2)
        theta, rotate = theta[::-1], rotate[:, ::-1]
        space, products = space @ rotate, products @ rotate
        largest = max([abs(theta[0]), *map(abs, values)])
        whole = locked.shape[1] + space.shape[1] == dims  # nothing can be added
        while len(values) < wanted:
            residual = products[:, 0] - theta[0] * space[:, 0]
            residual -= locked @ (locked.T @ residual)
            if np.linalg.norm(residual) > dims * EPS * largest and not whole:
                break
            locked, values = np.column_stack([locked, space[:, 0]]), [*values, float(theta[0])]
            space, products, theta = space[:, 1:], products[:, 1:], theta[1:]
        if len(values) == wanted:
            return np.array(values), locked
        if space.shape[1] > most_vectors:
            space, products, theta = space[:, :restart], products[:, :restart], theta[:restart]
        solvers = []
        # pairs behind the wanted ones come along: they cost no pass, and help the others
        for i in range(min(together, space.shape[1])):
            u = space[:, i]
            residual = products[:, i] - theta[i] * u
            others = np.column_stack([locked, u])
            residual = residual - others @ (others.T @ residual)
            # the correction needs no more digits than the residual has gained
            solvers.append((others, theta[i], minres(-residual, inner_steps, max(1e-4, 0.5 ** (step + 2)))))
        new = _abreast(multiply, solvers)
        if space.shape[1] == 0 or not new.shape[1]:
            new = rng.standard_normal((dims, 1))
        added = _orthonormal(new, np.column_stack([locked, space]))
        if not added.shape[1]:
            added = _orthonormal(rng.standard_normal((dims, wanted)), np.column_stack([locked, space]))
        space, products = np.column_stack([space, added]), np.column_stack([products, multiply(added)])
    raise RuntimeError("the residuals did not reach the rounding error")


def _abreast(multiply: Callable[[np.ndarray], np.ndarray], solvers: list[tuple]) -> np.ndarray:
    """Solutions of several projected systems, whose products are computed together."""
    asked = {i: next(solver) for i, (_, _, solver) in enumerate(solvers)}
    found = {}
    while asked:
        block = np.column_stack([v - solvers[i][0] @ (solvers[i][0].T @ v) for i, v in asked.items()])
        answers = multiply(block)
        for (i, _), own, v in zip(list(asked.items()), answers.T, block.T):
            others, theta, solver = solvers[i]
            own = own - theta * v
            try:
                asked[i] = solver.send(own - others @ (others.T @ own))
            except StopIteration as end:
                found[i] = end.value
                del asked[i]
    return np.column_stack([found[i] for i in sorted(found)]) if found else np.zeros((0, 0))


def _moments(x: np.ndarray) -> np.ndarray:
    return np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])


def principal_components(fit: DataFrame, wanted: int) -> Components:
    """The leading components of a stored table of different integer vectors."""
    lengths = fit.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if lengths[0] is None:
        return Components(0, [], 0.0, np.zeros((0, 0)), np.zeros(0))
    if lengths[0] != lengths[1]:
        raise ValueError(f"vectors of {lengths[0]} to {lengths[1]} entries")
    dims = lengths[0]
    moments = [int(m) for m in _summed(fit, _moments, "LONG")]
    n, sums, squares = moments[0], moments[1 : dims + 1], moments[dims + 1 :]
    spread = sum(n * q - s * s for q, s in zip(squares, sums))  # exact
    if not spread:
        return Components(n, sums, 0.0, np.zeros((dims, 0)), np.zeros(0))
    mean = np.array([s / n for s in sums])

    def multiply(block: np.ndarray) -> np.ndarray:
        def products(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return centred.T @ (centred @ block)

        return np.array(_summed(fit, products, "DOUBLE")).reshape(block.shape) / n

    variances, directions = jacobi_davidson(multiply, dims, wanted)
    some = variances > dims * EPS * max(variances[0], 0)
    return Components(n, sums, spread / n**2, directions[:, some], variances[some])


def identity_error(fit: DataFrame, found: Components) -> float:
    """The largest entry of the whitened fit list's covariance minus the identity."""
    k = len(found.variances)
    if not k:
        return 0.0
    mean = np.array([s / found.n for s in found.sums])
    whiten = found.directions / np.sqrt(found.variances)
    centre = np.array(_summed(fit, lambda x: ((x - mean) @ whiten).sum(0), "DOUBLE")) / found.n

    def squares(x: np.ndarray) -> np.ndarray:
        w = (x - mean) @ whiten - centre
        return w.T @ w

    covariance = np.array(_summed(fit, squares, "DOUBLE")).reshape(k, k) / found.n
    return float(np.abs(covariance - np.eye(k)).max())


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """Of each row the sum of (n x - S)^2, exactly; an error if 64 bits do not hold it."""
    largest = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if largest * largest * max(1, len(sums)) < 1 << 63:
        apart = n * x - np.array(sums, np.int64)
        return (apart * apart).sum(1)
    exact = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x.tolist()]
    return np.array(exact, np.int64)


def whitened(
    rows: DataFrame,
    components: int = 4,
    scale: int = 256,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """Per row whose vector is used and component, from 1: ``n``, the length of the fit
    list; ``deviation``, the squared distance of n times the vector from the sums;
    ``whitened``; ``explained``, the component's share of all variance; and
    ``identity_error``, one number that tells how white the fit list has become."""
    used, x = integer_vectors(rows, vector_column, scale)
    vectors = rows.where(used).select(F.col(id_column).alias("id"), x.alias("x"))
    fit = stored(vectors.select("x").distinct(), "fit-list")
    found = principal_components(fit, components)
    error = identity_error(fit, found)
    n, sums = found.n, found.sums
    k = len(found.variances)
    mean = np.array([s / n for s in sums]) if n else np.zeros(0)
    whiten = found.directions / np.sqrt(found.variances) if k else found.directions
    explained = found.variances / found.trace if k else found.variances

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            x = _matrix(batch.column(1))
            rows_ = len(x)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(rows_), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows_)),
                    pa.array(np.full(rows_ * k, n, np.int64)),
                    pa.array(np.repeat(_deviations(x, n, sums), k)),
                    pa.array(((x - mean) @ whiten).ravel()),
                    pa.array(np.tile(explained, rows_)),
                    pa.array(np.full(rows_ * k, error)),
                ],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    schema = f"id {vectors.schema['id'].dataType.simpleString()}, component INT, n LONG, deviation LONG, whitened DOUBLE, explained DOUBLE, identity_error DOUBLE"
    return vectors.mapInArrow(project, schema).withColumnRenamed("id", id_column)
