"""Linear models from sufficient statistics against closed forms."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression

from lendlake.operators import linear


def _data(spark, n=240, seed=3, offset=0.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)) + offset
    y = x @ np.array([2.0, 0.0, -1.0, 0.5]) + rng.normal(size=n) + 3
    rows = [(Vectors.dense(a.tolist()), float(b)) for a, b in zip(x, y)] + [(Vectors.dense([0.0] * 4), None)]
    return x, y, spark.createDataFrame(rows, ["features", "label"]).repartition(5)


@pytest.mark.parametrize("offset", [0.0, 1e6])
def test_moments_are_pooled_without_losing_digits(spark, offset):
    x, y, df = _data(spark, offset=offset)
    m = linear.moments(df, linear.Design((0, 1, 2, 3)))
    c, d = x - x.mean(0), y - y.mean()
    assert m.n == len(y) and np.allclose(m.x_mean, x.mean(0)) and m.y_mean == pytest.approx(y.mean())
    assert np.allclose(m.xx, c.T @ c, rtol=1e-8, atol=1e-8) and np.allclose(m.xy, c.T @ d, rtol=1e-7, atol=1e-7)


@pytest.mark.parametrize("alpha", [0.0, 10.0])
def test_ridge_solves_the_normal_equations(spark, alpha):
    x, y, df = _data(spark)
    m = linear.moments(df, linear.Design((0, 1, 2, 3)))
    model = linear.ridge(m, alpha)
    c = x - x.mean(0)
    assert np.allclose(model.coefficients, np.linalg.solve(c.T @ c + alpha * np.eye(4), c.T @ (y - y.mean())))
    assert linear.certificate(m, model, alpha, "l2") < 1e-12
    got = linear.predictions(df, linear.Design((0, 1, 2, 3)), [model, model]).where("label IS NOT NULL").collect()
    assert np.allclose(sorted(r["predictions"][1] for r in got), sorted(x @ model.coefficients + model.intercept))


def test_least_squares_of_dependent_columns_is_the_shortest(spark):
    rng = np.random.default_rng(1)
    level = rng.integers(0, 3, 90)
    x = np.concatenate([np.eye(3)[level], rng.normal(size=(90, 1)), np.zeros((90, 1))], axis=1)
    y = level + x[:, 3] + rng.normal(size=90) / 10
    df = spark.createDataFrame([(Vectors.dense(a.tolist()), float(b)) for a, b in zip(x, y)], ["features", "label"])
    m = linear.moments(df, linear.Design(tuple(range(5))))
    model = linear.ridge(m, 0.0)
    z = np.concatenate([x, np.ones((90, 1))], axis=1)
    best = np.linalg.lstsq(z, y, rcond=None)[0]
    assert np.allclose(z @ best, x @ model.coefficients + model.intercept)
    assert linear.certificate(m, model, 0.0, "l2") < 1e-10 and model.coefficients[4] == 0


def test_lasso_meets_its_conditions_and_equals_elastic_net(spark):
    x, y, df = _data(spark)
    m = linear.moments(df, linear.Design((0, 1, 2, 3)))
    alphas = [0.001, 0.1, 0.5, 100.0]
    models = linear.lasso(m, alphas)
    for alpha in alphas:
        assert linear.certificate(m, models[alpha], alpha, "l1") < 1e-6
        fitted = LinearRegression(regParam=alpha, elasticNetParam=1.0, standardization=False, maxIter=2000, tol=1e-12).fit(df.dropna())
        # Spark scales the penalty by the target's deviation only where it standardises: same objective here.
        loss = lambda b, a: ((y - x @ b - a) ** 2).mean() / 2 + alpha * np.abs(b).sum()  # noqa: E731, B023
        assert loss(models[alpha].coefficients, models[alpha].intercept) <= loss(fitted.coefficients.toArray(), fitted.intercept) + 1e-9
    assert not models[100.0].coefficients.any()


def test_degrees_share_one_matrix(spark):
    _, _, df = _data(spark)
    wide = linear.Design((0, 3), (1, 2), 3)
    m = linear.moments(df, wide)
    assert wide.width == len(wide.terms) + 2 == 11
    for degree in (1, 2, 3):
        alone = linear.moments(df, linear.Design((0, 3), (1, 2), degree))
        part = m.only(wide.columns(degree))
        assert np.allclose(part.xx, alone.xx) and np.allclose(part.xy, alone.xy)
        fit = linear.ridge(alone, 0.0)
        pred = linear.predictions(df.dropna(), linear.Design((0, 3), (1, 2), degree), [fit]).collect()
        assert sum((r["label"] - r["predictions"][0]) ** 2 for r in pred) == pytest.approx(linear.residual_sum(alone, fit.coefficients))


def test_too_wide_and_empty(spark):
    _, _, df = _data(spark)
    with pytest.raises(ValueError):
        linear.moments(df, linear.Design(tuple(range(linear.MAX_WIDTH + 1))))
    with pytest.raises(ValueError):
        linear.moments(df.limit(0), linear.Design((0,)))
