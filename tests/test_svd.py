import numpy as np
import pyarrow as pa
import pytest

from textspark.operators import svd


def long(spark, matrix):
    cells = [(i, f"t{j:03d}", float(x)) for i, row in enumerate(matrix) for j, x in enumerate(row) if x]
    return spark.createDataFrame(cells, "id long, term string, value double")


def signed(v):
    return v * np.sign(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])])


@pytest.fixture(scope="module")
def matrix():
    """Ninety rows whose singular values fall by a third each, beside noise; some rows and columns are zero."""
    rng = np.random.default_rng(2)
    u, v = np.linalg.qr(rng.normal(size=(90, 12)))[0], np.linalg.qr(rng.normal(size=(40, 12)))[0]
    m = u * (0.66 ** np.arange(12)) @ v.T + 1e-6 * rng.normal(size=(90, 40))
    m[[3, 50]] = 0
    m[:, 7] = 0
    return m


def test_equals_numpy(spark, matrix):
    model = svd.decompose(long(spark, matrix).repartition(6), "id", 5)
    _, size, vt = np.linalg.svd(matrix, full_matrices=False)
    assert np.allclose(model.values, size[:5], rtol=1e-8)
    factor = {r.term: r.vector for r in model.factor.collect()}
    want = signed(vt[:5].T)
    assert factor.keys() == {f"t{j:03d}" for j in range(40) if j != 7}
    assert np.allclose([factor[f"t{j:03d}"] for j in range(40) if j != 7], np.delete(want, 7, 0), atol=1e-7)
    keys = spark.range(92).withColumnRenamed("id", "id")
    rows = {r.id: r.vector for r in model.project(long(spark, matrix), keys, "id").collect()}
    assert np.allclose([rows[i] for i in range(90)], matrix @ want, atol=1e-7)
    assert rows[90] == rows[91] == [0.0] * 5
    unit = {r.id: np.linalg.norm(r.vector) for r in model.project(long(spark, matrix), keys, "id", unit=True).collect()}
    assert {i for i, n in unit.items() if n == 0} == {3, 50, 90, 91} and all(n == 0 or abs(n - 1) < 1e-9 for n in unit.values())


def test_a_matrix_of_smaller_rank_gives_as_many_as_it_has(spark):
    m = np.outer(np.arange(1, 9), [1.0, 2.0, -3.0])
    model = svd.decompose(long(spark, m), "id", 3)
    assert np.allclose(model.values, [np.linalg.norm(m)])
    assert sorted(np.round(r.vector[0], 9) for r in model.factor.collect()) == sorted(np.round(np.array([-1, -2, 3]) / 14**0.5, 9))


def test_an_empty_matrix(spark):
    model = svd.decompose(spark.createDataFrame([], "id long, term string, value double"), "id", 3)
    assert model.values == [] and model.factor.count() == 0
    assert [r.vector for r in model.project(long(spark, [[1.0]]), spark.range(1), "id").collect()] == [[]]


def test_triangles_of_many_partitions_are_reduced_in_rounds(spark):
    x = np.random.default_rng(1).normal(size=(500, 4))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, vector array<double>").repartition(70)
    r = svd.triangle(df, 4)
    assert np.allclose(r.T @ r, x.T @ x)
    _, turn = svd._turned(r)
    q = np.array([row.vector for row in svd.times(df, "id", turn).collect()])
    assert np.allclose(q.T @ q, np.eye(4))


def test_a_block_of_too_many_terms_becomes_blocks_of_whole_rows(monkeypatch):
    monkeypatch.setattr(svd, "TERMS", 6)
    monkeypatch.setattr(svd, "ROW_CELLS", 4)
    cells = [(i, f"t{(i + j) % 9}", float(10 * i + j + 1)) for i in range(8) for j in range(3)]
    table = pa.table({n: list(c) for n, c in zip(("key", "term", "value"), zip(*cells))})
    found, terms, home = [], {}, {}
    for batch in svd._index_rows(iter(range(5, 1000, 10)), table, pa.int64()):
        for row in batch.to_pylist():
            if row["kind"] == svd.TERM:
                terms[row["block"], row["place"]] = row["term"]
                continue
            sizes, idx, value = (np.frombuffer(row[c], t) for c, t in (("sizes", np.int32), ("idx", np.int32), ("value", float)))
            for key, at, x in zip(np.repeat(row["keys"], sizes), idx, value):
                found.append((key, terms[row["block"], at], x))
                home.setdefault(key, set()).add(row["block"])
    assert sorted(found) == sorted(cells) and all(len(h) == 1 for h in home.values())
    assert len({b for b, _ in terms}) > 1 and {b % 10 for b, _ in terms} == {5}
    assert max(sum(b == block for b, _ in terms) for block, _ in terms) <= 6
