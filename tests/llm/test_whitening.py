import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveyloom.llm import embedding_whitening as ew

SCHEMA = "vec_id long, embedding array<float>"


def check(got, table):
    """Results against numpy on the rows (id, vector) that are to be used."""
    ids = [i for i, _ in table]
    x = np.floor(256 * np.array([v for _, v in table], dtype=np.float32).astype(float)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = min(4, x.shape[1])
    assert len(got) == len(x) * kept
    assert {r["n"] for r in got} == {n}
    deviation = ((n * x - sums) ** 2).sum(1)
    expected = (x - sums / n) @ vectors[:, :kept] / np.sqrt(values[:kept])
    found = {}
    for r in got:
        # Equal vectors may differ in the last bit, by their place in a block.
        found.setdefault((r["vec_id"], r["deviation"]), {})[r["component"]] = r["whitened"]
        assert math.isclose(r["explained"], values[r["component"] - 1] / values.sum(), rel_tol=1e-9)
        assert r["identity_error"] < 1e-9
    rows = np.array([
        [w for _, w in sorted(found[i, int(d)].items())] for i, d in zip(ids, deviation)
    ])
    sign = np.sign((rows * expected).sum(0))
    assert np.abs(rows * sign - expected).max() < 1e-8


@pytest.mark.parametrize("shape", [(500, 6), (3, 2), (2000, 40)])
def test_against_numpy(spark, monkeypatch, shape):
    rng = np.random.default_rng(shape[0])
    data = rng.normal(size=shape) * np.linspace(3, 0.2, shape[1]) + 5
    table = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(data)]
    table += table[:1] * 700  # one popular vector
    monkeypatch.setattr(ew, "FAN_IN", 2)
    df = spark.createDataFrame(table, SCHEMA).repartition(9)
    check(ew.whiten(df).collect(), table)


def test_rows_that_are_dropped_and_clashing_columns(spark):
    good = [(i, [float(i % 3), float(i % 5), float(i % 7)]) for i in range(50)] + [(None, [9.0, 9.0, 1.0])]
    bad = [
        (100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, float("nan"), 2.0]),
        (104, [float("inf"), 1.0, 2.0]), (105, [1.0, 2.0]), (106, [-0.0, float("-inf"), 0.0]),
    ]
    df = spark.createDataFrame(good + bad, SCHEMA)
    df = df.withColumn("x", F.lit(1)).withColumn("n", F.lit(2)).withColumn("component", F.lit(3))
    check(ew.whiten(df).collect(), good)


def test_empty_and_constant_tables(spark):
    assert ew.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert ew.whiten(spark.createDataFrame([(1, None), (2, [])], SCHEMA)).collect() == []
    same = ew.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, SCHEMA)).collect()
    assert len(same) == 6
    assert {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in same} == {
        (1, 0, 0.0, 0.0, 1.0)
    }


def test_component_without_variance(spark):
    table = [(i, [float(i), float(2 * i), 1.0]) for i in range(20)]
    got = ew.whiten(spark.createDataFrame(table, SCHEMA)).collect()
    assert {r["whitened"] for r in got if r["component"] > 1} == {0.0}
    assert abs(sum(r["whitened"] ** 2 for r in got if r["component"] == 1) / 20 - 1) < 1e-9


def test_huge_entries_do_not_overflow(spark):
    table = [(i, [1e30 if i % 2 else -1e30, float(i), 7e6 * i]) for i in range(30)]
    got = ew.whiten(spark.createDataFrame(table, SCHEMA)).collect()
    assert len(got) == 90 and all(math.isfinite(r["whitened"]) for r in got)
    assert {r["deviation"] for r in got} == {None}


def test_exact_deviation_beyond_floats(spark):
    table = [(i, [3000.5 + i, -2000.25 * i]) for i in range(40)]
    got = {r["vec_id"]: r["deviation"] for r in ew.whiten(spark.createDataFrame(table, SCHEMA)).collect()}
    x = [[math.floor(256 * c) for c in v] for _, v in table]
    sums = [sum(c) for c in zip(*x)]
    assert got == {i: sum((40 * c - s) ** 2 for c, s in zip(v, sums)) for i, v in enumerate(x)}


def random_spectrum(rng, size, kind):
    vectors = np.linalg.qr(rng.normal(size=(size, size)))[0]
    values = np.sort(np.abs(rng.normal(size=size)) * 10.0 ** rng.integers(-8, 8, size))
    if kind == "ties":
        values = np.sort(np.round(np.abs(rng.normal(size=size)) * 2))
    return values, vectors


@pytest.mark.parametrize("kind", ["spread", "ties", "along", "nought"])
def test_rank_one_updates(kind):
    rng = np.random.default_rng(5)
    for _ in range(60):
        size = int(rng.integers(1, 24))
        values, vectors = random_spectrum(rng, size, kind)
        row = rng.normal(size=size) * 10.0 ** rng.integers(-4, 4)
        if kind == "along":
            row = vectors[:, 0] * 3
        if kind == "nought":
            row = row * 0
        new_values, new_vectors = ew.rank_one_update(values, vectors, row)
        whole = vectors @ np.diag(values) @ vectors.T + np.outer(row, row)
        again = new_vectors @ np.diag(new_values) @ new_vectors.T
        assert np.abs(whole - again).max() <= 1e-12 * max(np.abs(whole).max(), 1e-300)
        assert np.abs(new_vectors.T @ new_vectors - np.eye(size)).max() < 1e-12
        assert (np.diff(new_values) >= 0).all()


def test_secular_roots_lie_between_poles():
    rng = np.random.default_rng(2)
    d, z = np.sort(rng.normal(size=30)), rng.normal(size=30)
    pole, x = ew.secular_roots(d, z)
    exact = np.linalg.eigvalsh(np.diag(d) + np.outer(z, z))
    assert np.abs(d[pole] + x - exact).max() < 1e-12


def test_merged_spectra_equal_the_whole():
    rng = np.random.default_rng(1)
    data = np.floor(rng.normal(size=(3000, 20)) * 50 + 1000)
    whole = ew.Spectrum.empty(20)
    for part in np.array_split(data, 7):
        one = ew.Spectrum.empty(20)
        for block in np.array_split(part, 3):
            one.add_vectors(block)
        whole.merge(one)
    exact = np.linalg.eigvalsh(np.cov(data.T, bias=True))
    assert whole.n == 3000 and np.allclose(whole.mean, data.mean(0))
    assert np.abs(whole.values / 3000 - exact).max() < 1e-9 * exact.max()
