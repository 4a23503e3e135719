import numpy as np
import pytest

from punctual.llm import queries, whitening

SMALL = "/root/testdata/sf0.01"


def scatter(spectrum):
    return (spectrum.vectors * spectrum.values) @ spectrum.vectors.T


@pytest.mark.parametrize("size", [1, 2, 5, 40])
def test_updates_against_dense_eigenvalues(size):
    chance = np.random.default_rng(size)
    tables = [
        chance.normal(size=(300, size)) * 100,
        np.repeat(chance.normal(size=(7, size)) * 100, 20, 0),
        np.zeros((30, size)) + 5,
        np.eye(size)[np.arange(200) % size] * 7,
        chance.normal(size=(300, size)) * np.logspace(0, 6, size),
        np.outer(chance.normal(size=100) * 50, np.ones(size)),
    ]
    for table in tables:
        x = table.astype(np.int64) + whitening.SHIFT
        parts = []
        for half in np.array_split(x, 3):
            own = whitening.Spectrum.none(size)
            for at in range(0, len(half), 17):
                own.add_rows(half[at : at + int(chance.integers(1, 17))] if at % 2 else half[at : at + 17])
            parts.append((own, half))
        whole = whitening.Spectrum.none(size)
        for own, half in parts:
            taken = whitening.Spectrum.none(size)
            taken.add_rows(half)
            whole.add(taken)
        centred = x - x.mean(0)
        want = centred.T @ centred
        assert whole.n == len(x) and (whole.sums == x.sum(0)).all()
        assert np.abs(scatter(whole) - want).max() <= 1e-11 * max(np.abs(want).max(), 1)
        assert np.abs(whole.vectors.T @ whole.vectors - np.eye(size)).max() < 1e-12
        assert (np.diff(whole.values) >= 0).all()


def test_roots_lie_between_poles():
    poles, z = np.array([0.0, 1.0, 1.0 + 1e-9, 5.0]), np.array([0.5, 1e-5, 0.3, 0.8])
    _, roots = whitening._secular_roots(poles, z, 2.0)
    assert (roots[:-1] >= poles[:-1]).all() and (roots[:-1] <= poles[1:]).all() and roots[-1] <= 5 + 2 * z @ z
    want = np.linalg.eigvalsh(np.diag(poles) + 2 * np.outer(z, z))
    assert np.abs(roots - want).max() < 1e-14 * 5


def dense(vectors, components):
    x = np.floor(vectors.astype(float) * 1024).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(0)
    centred = x - sums / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1], basis[:, ::-1]
    return values, centred @ basis[:, :components] / np.sqrt(values[:components]), ((n * x - sums) ** 2).sum(1)


def test_query_against_dense_eigenvectors(spark, monkeypatch):
    monkeypatch.setattr(whitening, "MERGED_AT_ONCE", 3)
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").repartition(11)
    got = whitening.whiten(table, "vec_id", "embedding").toPandas().sort_values(["vec_id", "component"])
    pandas = table.toPandas().sort_values("vec_id")
    values, want, deviation = dense(np.stack(pandas.embedding), 8)
    n = len(pandas)
    assert (got.component.to_numpy().reshape(n, 8) == np.arange(1, 9)).all() and (got.n == n).all()
    seen = got.whitened.to_numpy().reshape(n, 8)
    assert np.abs(seen * np.sign((seen * want).sum(0)) - want).max() < 1e-9
    assert (got.deviation.to_numpy().reshape(n, 8) == deviation[:, None]).all()
    assert np.abs(got.explained.to_numpy()[:8] - values[:8] / values.sum()).max() < 1e-12
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-10
    plain = queries.QUERIES["op12_incremental_whitening"](spark, SMALL)
    assert plain.columns == ["vec_id", *whitening.RESULTS] and plain.count() == 8 * n


SCHEMA = "component long, embedding array<float>, label int, n string, vector int, _fate int"


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 2.0, 0.5], [0.0, 1.0, 0.25], [3.0, -1.0, 0.125], [1.0, 2.0, 0.5], None, [nan, 1.0, 1.0], [1.0, inf, 1.0], [None, 1.0, 1.0], [], [1.0, 2.0], [1e20, 0.0, 0.0]]
    rows = [(None if i == 2 else i, vector, None, "x", 1, 2) for i, vector in enumerate(vectors)] + [(1, vectors[1], 3, "x", 1, 2)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(3), "component", "embedding")
    assert got.columns == ["key", *whitening.RESULTS]
    got = got.collect()
    used = np.array([vectors[i] for i in (0, 1, 2, 3, 1)])
    values, want, deviation = dense(used, 3)
    assert len(got) == 15 and {row.n for row in got} == {5}
    assert sorted((row.key is None, row.deviation) for row in got if row.component == 1) == sorted(zip([False, False, True, False, False], deviation.tolist(), strict=True))
    real = [row for row in got if row.whitened is not None]
    assert {row.component for row in real} == {1, 2}  # three different points span a plane
    assert max(row.identity_error for row in got) < 1e-8
    assert sum(row.explained for row in got if row.key == 0) == pytest.approx(1)
    one = whitening.whiten(spark.createDataFrame(rows[:1], SCHEMA), "component", "embedding").collect()
    assert [(row.component, row.n, row.deviation, row.whitened, row.explained, row.identity_error) for row in one] == [(i, 1, 0, None, None, None) for i in (1, 2, 3)]
    none = whitening.whiten(spark.createDataFrame([], SCHEMA), "component", "embedding")
    assert none.count() == 0 and none.columns == ["key", *whitening.RESULTS]
    assert whitening.whiten(spark.createDataFrame(rows[4:9], SCHEMA), "component", "embedding").count() == 0


def test_deviation_beyond_a_long(spark):
    rows = [(i, [float(i % 2) * (1 << 29), 1.0]) for i in range(40)]
    got = whitening.whiten(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v").collect()
    assert {row.deviation for row in got} == {None} and {row.whitened is None for row in got if row.component == 1} == {False}
