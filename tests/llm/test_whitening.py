import duckdb
import numpy as np
import pytest
from llm_helpers import frame

from sowcast.llm import queries, whitening

SF = "/root/testdata/sf0.001"


def table(spark, vectors, ids=None):
    rows = [(i, v, "clash") for i, v in zip(ids or range(len(vectors)), vectors)]
    return spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<FLOAT>, whitened STRING")


def brute(vectors, components=4, scale=256):
    """Covariance as a matrix, from all different integer vectors."""
    x = np.floor(scale * np.array(vectors, np.float32).astype(float)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1][:components], directions[:, ::-1][:, :components]
    deviation = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums)) for row in x]
    return n, deviation, (x - sums / n) @ directions / np.sqrt(values), values / (centred**2).sum() * n


def check(got, ids, vectors, components=4):
    n, deviation, white, explained = brute(vectors, components)
    got = got.sort_values(["vec_id", "component"])
    assert len(got) == len(ids) * components and (got.n == n).all()
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9
    for c in range(components):
        own = got[got.component == c + 1]
        assert list(own.vec_id) == ids and list(own.deviation) == deviation
        mine = own.whitened.to_numpy()
        sign = np.sign(mine @ white[:, c])
        assert np.abs(mine - sign * white[:, c]).max() < 1e-9
        assert np.allclose(own.explained, explained[c], rtol=1e-12)


def test_query_against_a_matrix(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet' ORDER BY 1").fetchall()
    check(frame(queries.op13_embedding_whitening(spark, SF)), [r[0] for r in rows], [r[1] for r in rows])


def test_copies_count_once_in_the_fit(spark):
    rng = np.random.default_rng(2)
    vectors = (rng.standard_normal((40, 6)) * [5, 3, 2, 1, 0.5, 0.5]).round(2).tolist()
    vectors += [vectors[0]] * 30
    check(frame(whitening.whitened(table(spark, vectors))), list(range(70)), vectors)


def test_rows_that_are_left_out(spark):
    rng = np.random.default_rng(3)
    good = rng.standard_normal((20, 5)).tolist()
    bad = [None, [], [1.0, None, 1.0, 1.0, 1.0], [float("nan")] * 5, [1.0, float("inf"), 0.0, 0.0, 0.0], [float("-inf")] * 5]
    got = frame(whitening.whitened(table(spark, good + bad)))
    check(got, list(range(20)), good)
    twice = whitening.whitened(table(spark, good[:19] + good[:1], ids=[None, None, *range(2, 18), 17, 17]))
    assert twice.count() == 80 and twice.where("vec_id IS NULL").count() == 8


def test_fewer_components_than_wanted(spark):
    vectors = [[float(i), float(i)] for i in range(5)]  # one direction
    got = frame(whitening.whitened(table(spark, vectors)))
    assert list(got.component) == [1] * 5 and np.allclose(got.explained, 1)
    assert whitening.whitened(table(spark, [[1.0, 2.0]] * 3)).count() == 0
    empty = whitening.whitened(table(spark, [[1.0]]).limit(0))
    assert empty.count() == 0 and "identity_error" in empty.columns


def test_unequal_lengths_and_huge_entries_are_errors(spark):
    with pytest.raises(ValueError, match="1 to 2 entries"):
        whitening.whitened(table(spark, [[1.0], [1.0, 2.0]]))
    with pytest.raises(Exception, match="entries of 65536 or more"):
        whitening.whitened(table(spark, [[1.0], [1e9]])).collect()


def test_deviations_are_exact():
    x = np.array([[1 << 20, -3], [5, 7]])
    sums = [-(1 << 30), 11]
    want = [sum((900 * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    assert whitening._deviations(x, 900, sums).tolist() == want
    with pytest.raises(OverflowError):
        whitening._deviations(x, 1 << 40, sums)


@pytest.mark.parametrize("values", [np.linspace(1, 2, 200), [5, 5, 5, 5, 5, *[1] * 40], [9, 1e-3, 1e-6, *[0] * 20], [4, 3, 2], [1]])
def test_jacobi_davidson(values):
    rng = np.random.default_rng(1)
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    matrix = q @ np.diag(values) @ q.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = whitening.jacobi_davidson(lambda block: matrix @ block, len(values), 4)
    want = np.sort(values)[::-1][:4]
    assert np.allclose(found, want, atol=1e-12 * want[0], rtol=0)
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-12 * want[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(want))).max() < 1e-12


def test_minres():
    rng = np.random.default_rng(4)
    m = rng.standard_normal((30, 30))
    m = m + m.T  # indefinite
    b = rng.standard_normal(30)
    for steps in (1, 3, 10, 60):
        solver = whitening.minres(b, steps, 0.0)
        krylov = np.column_stack([np.linalg.matrix_power(m, k) @ b for k in range(min(steps, 10))])
        v = next(solver)
        while True:
            try:
                v = solver.send(m @ v)
            except StopIteration as end:
                x = end.value
                break
        left = np.linalg.norm(b - m @ x)
        if steps <= 10:  # the smallest residual over the Krylov space
            basis, _ = np.linalg.qr(krylov)
            best = np.linalg.lstsq(m @ basis, b, rcond=None)[0]
            assert left == pytest.approx(np.linalg.norm(b - m @ basis @ best), rel=1e-5)
        else:
            assert left < 1e-6
