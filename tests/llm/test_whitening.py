import numpy as np
import pytest

from tablewright.llm import queries, whitening
from tests.llm.conftest import SMALL

SCHEMA = "vec_id long, embedding array<float>, deviation long, whitening string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 7, "x") for i, v in enumerate(vectors)], SCHEMA)


def expected(vectors):
    """Whole vectors that stay, and eigenpairs of the covariance of the distinct ones."""
    whole = {i: [int(np.floor(256 * np.float32(c).astype(float))) for c in v] for i, v in enumerate(vectors) if v and None not in v and np.isfinite(v).all()}
    distinct = np.array(sorted(set(map(tuple, whole.values()))))
    away = distinct - distinct.mean(axis=0)
    values, axes = np.linalg.eigh(away.T @ away / len(distinct))
    order = np.argsort(-values)
    return whole, distinct, values[order], axes[:, order]


def drawn(seed, n=200, size=12):
    draw = np.random.default_rng(seed)
    return (draw.standard_normal((n, size)) * np.linspace(2, 0.1, size)).astype(np.float32).tolist()


def compare(spark, vectors):
    df = frame(spark, vectors)
    model = whitening.fit(df)
    whole, distinct, values, axes = expected(vectors)
    assert model.n == len(distinct) and list(model.sums) == distinct.sum(axis=0).tolist()
    np.testing.assert_allclose(model.values, values[:4], rtol=1e-12)
    np.testing.assert_allclose(model.explained, values[:4] / values.sum(), rtol=1e-12)
    signs = np.sign((model.vectors * axes[:, :4]).sum(axis=0))
    rows = {r["vec_id"]: r["whitening"] for r in whitening.with_whitened(df, model).collect()}
    assert len(rows) == len(vectors) and {i for i, row in rows.items() if row is not None} == set(whole)
    for i, x in whole.items():
        away = np.array(x, object) * model.n - distinct.sum(axis=0).astype(object)
        assert rows[i]["deviation"] == int((away * away).sum())
        plain = (np.array(x) - distinct.mean(axis=0)) @ (axes[:, :4] / np.sqrt(values[:4]))
        np.testing.assert_allclose(np.array(rows[i]["whitened"]) * signs, plain, atol=1e-9)
    assert model.identity_error < 1e-10
    return model


def test_against_a_dense_solver(spark):
    vectors = drawn(1)
    vectors += vectors[:40] + [vectors[0]] * 100  # copies have no weight in the fit
    vectors += [None, [1.0] * 11 + [None], [float("nan")] * 12, [float("inf")] + [0.0] * 11, [-0.0] * 12]
    compare(spark, vectors)


def test_query(spark):
    rows = queries.op12_whitening(spark, SMALL).collect()
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    whole, distinct, values, axes = expected([r["embedding"] for r in table])
    assert len(rows) == 4 * len(whole) and {r["n"] for r in rows} == {len(distinct)}
    scores = {(r["vec_id"], r["component"]): r["whitened"] for r in rows}
    plain = {table[i]["vec_id"]: (np.array(x) - distinct.mean(axis=0)) @ (axes[:, :4] / np.sqrt(values[:4])) for i, x in whole.items()}
    for component in range(1, 5):
        ours = np.array([scores[i, component] for i in plain])
        theirs = np.array([one[component - 1] for one in plain.values()])
        assert min(np.abs(ours - theirs).max(), np.abs(ours + theirs).max()) < 1e-8
    assert {r["component"]: r["explained"] for r in rows} == pytest.approx(dict(enumerate(values[:4] / values.sum(), 1)), rel=1e-10)
    assert max(r["identity_error"] for r in rows) < 1e-10


def test_few_vectors_have_fewer_components(spark):
    for count, components in ((1, 0), (2, 1), (3, 2)):
        model = whitening.fit(frame(spark, drawn(2, count)))
        assert len(model.values) == components
    assert len(whitening.fit(frame(spark, [[1.0, 2.0]] * 9)).values) == 0


def test_no_vectors(spark):
    df = frame(spark, [None, [], [None]])
    assert whitening.fit(df) is None
    assert [r["whitening"] for r in whitening.with_whitened(df, None).collect()] == [None] * 3


def test_other_lengths_and_sizes_are_dropped(spark):
    vectors = drawn(3, 50) + [[1.0, 2.0], [], [3e38] * 12]
    df = frame(spark, vectors)
    model = whitening.fit(df)
    rows = {r["vec_id"]: r["whitening"] for r in whitening.with_whitened(df, model).collect()}
    assert model.n == 50 and [i for i, row in rows.items() if row is None] == [50, 51, 52]


def test_exact_beyond_a_double(spark):
    big = [[2.0**40 + 1024 * i, float(i % 3)] for i in range(6)]
    model = whitening.fit(frame(spark, big))
    whole = [[int(256 * np.float32(c)) for c in v] for v in big]
    distinct = sorted(set(map(tuple, whole)))
    assert list(model.sums) == [sum(v[d] for v in distinct) for d in range(2)]
    huge = frame(spark, [[1e16, 0.0], [-1e16, 1.0]])
    model = whitening.fit(huge)
    assert [r["whitening"]["deviation"] for r in whitening.with_whitened(huge, model).collect()] == [None, None]


@pytest.mark.parametrize("values", [
    [9, 8, 7, 6, 5, 4, 3, 2, 1], [5, 5, 5, 5, 5, 1], [1e9, 1e3, 1, 1e-3, 1e-6], [3, 3 - 1e-9, 3 - 2e-9, 2, 1], [1, 1, 0, 0], [7],
    np.linspace(1, 2, 40).tolist(),
])
def test_contour_finds_the_leading_pairs(values):
    values = np.array(values, float)
    turn, _ = np.linalg.qr(np.random.default_rng(4).standard_normal((len(values), len(values))))
    matrix = turn * values @ turn.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = whitening.leading(matrix, 4)
    wanted = [v for v in sorted(values, reverse=True)[:4] if v > 1e-13 * values.sum()]
    np.testing.assert_allclose(found, wanted, rtol=1e-6, atol=1e-14 * values.max())
    np.testing.assert_allclose(vectors.T @ vectors, np.eye(len(wanted)), atol=1e-12)
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-12 * values.max()


def test_inertia():
    draw = np.random.default_rng(5)
    for size in (1, 2, 7, 30):
        matrix = draw.standard_normal((size, size))
        matrix = matrix + matrix.T
        np.fill_diagonal(matrix, 0)  # pivots of two are needed
        values = np.linalg.eigvalsh(matrix)
        for shift in (-1.0, 0.0, 0.5, 3.0):
            assert whitening.count_below(matrix, shift) == (values < shift - 1e-12).sum()
