"""Scorers against plain versions of what they compute, and the choice among them."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from veritrail.operators import scorers

NAMES = ["a", "b", "c"]


def drawn(n, seed, missing=0.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [1, 50, 0.01] + [3, -200, 7]
    y = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] - 3) * 2 - (x[:, 1] + 200) / 40))).astype(int)
    return [(i, *(None if rng.random() < missing else float(v) for v in row), int(k)) for i, (row, k) in enumerate(zip(x, y, strict=True))]


SCHEMA = "id int, a double, b double, c double, y int"


def matrix(rows, of=None):
    x = np.array([[np.nan if v is None else v for v in r[1:4]] for r in rows])
    of = of or (np.nanmean(x, axis=0), np.nanstd(x, axis=0))
    return np.nan_to_num((x - of[0]) / of[1]), of


def plain_newton(x, y, penalty):
    x = np.column_stack((np.ones(len(x)), x))
    ridge, w = penalty * np.array([0, 1, 1, 1]), np.zeros(4)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (p - y) + ridge * w)
    return w


@pytest.mark.parametrize("missing", [0.0, 0.2])
def test_logistic_equals_plain_newton(spark, missing):
    rows, book = drawn(600, 1, missing), drawn(300, 2, missing)
    context = spark.createDataFrame(rows, SCHEMA).repartition(3)
    fitted = scorers.logistic(context, features=NAMES, label="y")
    x, of = matrix(rows)
    w = plain_newton(x, np.array([r[4] for r in rows]), 2.0)
    assert np.allclose(fitted.weights, w, atol=1e-8)
    got = {r.id: r.p for r in fitted(spark.createDataFrame(book, SCHEMA).withColumn("odd.name", F.lit(1))).collect()}
    want = 1 / (1 + np.exp(-(matrix(book, of)[0] @ w[1:] + w[0])))
    assert np.allclose([got[i] for i in range(300)], want, atol=1e-9)


def test_logistic_separable_and_constant_features(spark):
    rows = [(i, float(i), 5.0, 0.0, int(i > 50)) for i in range(100)]
    fitted = scorers.logistic(spark.createDataFrame(rows, SCHEMA), features=NAMES, label="y")
    p = [r.p for r in fitted(spark.createDataFrame(rows, SCHEMA)).orderBy("id").collect()]
    assert p == sorted(p) and p[0] < 0.1 < 0.9 < p[-1]


@pytest.mark.parametrize("block", [7, 1024])
def test_kernel_equals_the_plain_sum(spark, block):
    rows, book = drawn(150, 3, 0.1), drawn(90, 4, 0.1)
    x, of = matrix(rows)
    q, y = matrix(book, of)[0], np.array([r[4] for r in rows])
    k = np.exp(-((q[:, None] - x) ** 2).sum(2) / (2 * 0.25 * 3))
    got = {r.id: r.p for r in scorers.kernel(spark.createDataFrame(rows, SCHEMA), features=NAMES, label="y", block=block)(spark.createDataFrame(book, SCHEMA)).collect()}
    assert np.allclose([got[i] for i in range(90)], k @ y / k.sum(1), atol=1e-9)
    far = spark.createDataFrame([(0, 1e9, 0.0, 0.0, 0)], SCHEMA)  # all weights vanish but for their ratio
    assert 0 <= scorers.kernel(spark.createDataFrame(rows, SCHEMA), features=NAMES, label="y")(far).first().p <= 1


def test_kernel_refuses_a_context_without_bound(spark, monkeypatch):
    monkeypatch.setattr(scorers, "MOST_CONTEXT", 20)
    for n in (0, 21):
        with pytest.raises(ValueError, match="context"):
            scorers.kernel(spark.createDataFrame(drawn(n, 5), SCHEMA), features=NAMES, label="y")


def test_families_by_name_and_device(spark):
    assert [scorers.resolved(f, d) for f, d in (("auto", "cpu"), (None, "gpu"), ("Kernel", "cpu"), ("STUB", "gpu"))] == ["stub", "kernel", "kernel", "stub"]
    with pytest.raises(ValueError, match="no scorer"):
        scorers.resolved("nope")
    assert scorers.device(spark) == "cpu"
    budget = {"max_mules": 2000}
    assert [scorers.max_positives(budget, f, d) for f, d in (("stub", "cpu"), ("kernel", "cpu"), ("kernel", "gpu"))] == [2000, 500, 2000]
    assert scorers.max_positives(budget | {"max_mules_cpu": 300}, "kernel") == 300
