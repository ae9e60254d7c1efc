from decimal import Decimal

import numpy as np
import pytest

from carelens.llm import whitening as W

from .test_neighbours import frame

SCHEMA = "vec_id long, embedding array<double>"


def by_hand(vectors):
    """n, S, covariance of the distinct whole vectors, in Python's integers."""
    x = sorted({tuple(int(np.floor(64 * c)) + 1_000_000 for c in v) for v in vectors})
    n, dims = len(x), len(x[0])
    s = [sum(r[d] for r in x) for d in range(dims)]
    cov = [[sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x) / n**3 for j in range(dims)] for i in range(dims)]
    return n, s, np.array(cov)


def test_scatter_counts_exactly():
    rng = np.random.default_rng(1)
    for low, high, rows in ((-40, 700, 1000), (0, 1, 65), (-(1 << 40), 1 << 40, 130), (5, 6, 3)):
        f = rng.integers(low, high, (rows, 5))
        g = W.scatter(f)
        ones = np.concatenate([f, np.ones((rows, 1), np.int64)], 1).astype(object)
        assert (g == ones.T @ ones).all()


def test_keys_keep_vectors():
    f = np.array([[1, -2], [70_000, 1], [-(1 << 62), 3], [-(1 << 15), 0], [(1 << 15) - 1, 0]])
    keys = W._keys(f)
    assert [len(k) for k in keys] == [4, 8, 16, 8, 4]
    assert (W._from_keys(keys, 2) == f).all()


@pytest.mark.parametrize("block", [W.BLOCK, 7])
def test_against_plain_covariance(spark, block):
    rng = np.random.default_rng(7)
    vectors = (rng.standard_normal((60, 4)) * [3, 1, 0.5, 0.2] @ rng.standard_normal((4, 4))).tolist()
    rows = [(i, v) for i, v in enumerate(vectors)] + [(900 + i, vectors[0]) for i in range(40)]
    got = W.whiten(spark, frame(spark, rows, SCHEMA), block=block).toPandas()
    n, s, cov = by_hand(vectors)
    e, axes = np.linalg.eigh(cov)
    e, axes = e[::-1], axes[:, ::-1]
    assert len(got) == 100 * 4 and set(got.n) == {n}
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    for vec_id, part in got.groupby("vec_id"):
        v = dict(rows)[vec_id]
        x = [int(np.floor(64 * c)) + 1_000_000 for c in v]
        assert set(part.deviation) == {sum((n * a - b) ** 2 for a, b in zip(x, s, strict=True))} == {int(d) for d in part.deviation_wide}
    part = got.pivot(index="vec_id", columns="component", values="whitened")
    x = np.array([[int(np.floor(64 * c)) - 0 for c in dict(rows)[i]] for i in part.index], float)
    want = (x - np.array([(a - n * 1_000_000) / n for a in s])) @ axes / np.sqrt(e)
    sign = np.sign((want * part.to_numpy()).sum(0))
    assert np.abs(want * sign - part.to_numpy()).max() < 1e-9
    explained = got.groupby("component").explained.first().to_numpy()
    assert np.abs(explained / (e / e.sum()) - 1).max() < 1e-9


def test_odd_rows(spark):
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [3.0, -1.0]), (3, None), (4, []), (5, [None, 1.0]), (6, [float("nan"), 1.0]),
            (7, [float("inf"), 0.0]), (None, [0.5, 0.25]), (8, [1.0, 2.0, 3.0]), (9, [0.0, 0.0])]
    got = W.whiten(spark, frame(spark, rows, SCHEMA)).toPandas()
    assert sorted(got.vec_id.fillna(-1)) == sorted([-1, 1, 1, 2, 9] * 2) and set(got.n) == {4}
    assert set(got.component) == {1, 2} and got.identity_error.max() < 1e-9


def test_entries_beyond_any_long(spark):
    rows = [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [1e17, 2.0]), (4, [0.0, 5.0])]
    got = W.whiten(spark, frame(spark, rows, SCHEMA)).toPandas()
    assert set(got.vec_id) == {1, 2, 3, 4} and got.deviation.isna().any()
    far = [1 << 62, -(1 << 62), 64 * 10**17, 0]
    low = [0, 64, 128, 320]
    want = sum((4 * v - sum(c)) ** 2 for v, c in ((far[0], far), (low[0], low)))
    assert Decimal(got[got.vec_id == 1].deviation_wide.iloc[0] or 0) in (want, 0) and (want >= 10**38) == got[got.vec_id == 1].deviation_wide.isna().all()


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert W.whiten(spark, frame(spark, rows, SCHEMA)).count() == 0


def test_a_dimension_without_variance(spark):
    got = W.whiten(spark, frame(spark, [(i, [float(i), 7.0, float(i * i)]) for i in range(9)], SCHEMA)).toPandas()
    assert set(got.component) == {1, 2} and got.identity_error.max() < 1e-6


def test_whole_query(spark):
    from carelens.llm.queries import op13_whitening

    sf = "/root/testdata/sf0.001"
    got = op13_whitening(spark, sf).toPandas()
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    n, s, cov = by_hand([v for _, v in rows])
    e = np.linalg.eigvalsh(cov)[::-1]
    assert len(got) == len(rows) * 16 and set(got.n) == {n} and got.identity_error[0] < 1e-4
    assert np.abs(got.groupby("component").explained.first().to_numpy() / (e[:16] / e.sum()) - 1).max() < 1e-4
    for vec_id, v in rows:
        x = [int(np.floor(64 * c)) + 1_000_000 for c in v]
        assert set(got[got.vec_id == vec_id].deviation) == {sum((n * a - b) ** 2 for a, b in zip(x, s, strict=True))}
