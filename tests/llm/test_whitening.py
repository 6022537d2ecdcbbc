"""Whitening equals NumPy's eigendecomposition of the covariance of the distinct integer vectors."""

import math

import numpy as np
import pytest

from attrition.llm import whitening
from attrition.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(vectors):
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], dtype=object)
    fit = np.array(sorted({tuple(r) for r in x}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    a = np.array((n * fit - sums) / n, dtype=float)
    e, v = np.linalg.eigh(a.T @ a / n)
    order = np.argsort(-e)
    e, v = e[order], v[:, order]
    dev = ((n * x - sums) ** 2).sum(axis=1)
    white = np.array((n * x - sums) / n, dtype=float) @ v / np.sqrt(np.maximum(e, 1e-300))
    return n, dev, e, white


def test_query_equals_eigendecomposition(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    got = QUERIES["op13_whitening"](spark, SF).toPandas()
    n, dev, e, white = brute(table["embedding"])
    assert len(got) == 16 * len(table)
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[table["vec_id"]].to_numpy()
    for k in range(16):
        sign = np.sign((wide[:, k] * white[:, k]).sum())
        assert np.allclose(wide[:, k] * sign, white[:, k], atol=1e-8)
    one = got[got["component"] == 1].set_index("vec_id").loc[table["vec_id"]]
    assert one["deviation"].tolist() == dev.tolist()
    assert set(got["n"]) == {n}
    explained = got.groupby("component")["explained"].first().to_numpy()
    assert np.allclose(explained, e[:16] / e.sum(), rtol=1e-9)
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9


def test_does_not_depend_on_partitions(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    a = whitening.fit(whitening.integer_vectors(rows.repartition(13)))
    b = whitening.fit(whitening.integer_vectors(rows.coalesce(1)))
    assert np.allclose(a.eigenvalues, b.eigenvalues, rtol=1e-10)
    assert np.array_equal(a.sums, b.sums)


def test_ill_conditioned_directions_are_kept(spark):
    rng = np.random.default_rng(1)
    basis = np.linalg.qr(rng.normal(size=(6, 6)))[0]
    rows = (rng.normal(size=(400, 6)) * [1e6, 1e4, 100, 10, 3, 1]) @ basis
    df = spark.createDataFrame([(i, [float(c) for c in r]) for i, r in enumerate(rows)], "vec_id long, embedding array<double>")
    got = whitening.whitened_components(df).toPandas()
    _, _, e, white = brute(rows)
    wide = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert wide.shape == (400, 6) and got["identity_error"].iloc[0] < 1e-4
    assert np.allclose(np.abs((wide * white).mean(axis=0)), 1, atol=1e-4)
    assert np.allclose(got.groupby("component")["explained"].first(), e / e.sum(), rtol=1e-4)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0, 0.0], "a"), (1, [1.0, 2.0, 0.0], "a"), (2, [3.0, -1.0, 0.0], "b"), (None, [0.5, 0.25, 0.0], None),
        (4, None, "x"), (5, [1.0, None, 0.0], "x"), (6, [nan, 1.0, 0.0], "x"), (7, [1.0, -inf, 0.0], "x"), (8, [], "x"),
        (9, [1.0], "x"), (10, [1e300, 0.0, 0.0], "x"),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component string")
    got = whitening.whitened_components(df).toPandas()
    n, dev, e, _ = brute([r[1] for r in rows[:4]])
    # three distinct vectors span two directions; the constant third entry adds none
    assert n == 3 and sorted(set(got["component"])) == [1, 2]
    ids = got[got["component"] == 1]["vec_id"]
    assert sorted(ids.dropna()) == [1, 1, 2] and ids.isna().sum() == 1
    assert sorted(got[got["component"] == 1]["deviation"]) == sorted(dev)


def test_large_sums_stay_exact():
    x = np.array([[1 << 40, 5], [7, 9]], dtype=np.int64)
    sums = x.sum(axis=0)
    want = [int(sum((2 * int(v) - int(s)) ** 2 for v, s in zip(r, sums, strict=True))) for r in x]
    assert whitening._deviation(x, 2, sums) == [w if w < 1 << 63 else None for w in want]


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_no_variance_gives_no_rows(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = whitening.whitened_components(df)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.count() == 0
