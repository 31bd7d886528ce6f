"""Features, arms and the decision rule."""

import itertools

import numpy as np
import pytest

from quillstone.operators import features, quantile
from quillstone.operators.gates import drifted

PANEL = "account_code string, cost_center_code string, accounting_period string, balance double"


def months(n, first=2024):
    return [f"{first + i // 12}-{i % 12 + 1:02d}" for i in range(n)]


@pytest.fixture
def noisy(rows):
    draw = np.random.default_rng(3)
    centres = [("C1", 500, 20), ("C2", 4000, 150), *((f"C{k}", 300 * k, 12 * k) for k in range(3, 9))]
    data = [("a", c, p, float(level + draw.normal(0, spread))) for c, level, spread in centres for p in months(36)]
    return rows(PANEL, *data)


def test_design(rows):
    panel = rows(PANEL, *[("a", "C", p, float(i + 1)) for i, p in enumerate(months(15))])
    got = {r.accounting_period: r for r in features.design(panel, features.size_bands(panel)).collect()}
    assert set(got) == set(months(15)[12:])
    r = got[months(15)[12]]
    assert (r.actual, r.lag_1, r.lag_3, r.lag_12, r.month_1, r.month_2) == (13, 12, 10, 1, 1, 0)
    assert features.gaps(panel).count() == 0 and features.gaps(panel.where("accounting_period <> '2024-05'")).count() == 1


def test_flag_rule(rows):
    got = features.flags(rows("actual double, predicted double, lower_bound double, upper_bound double", (5000., 500., 900., 100.), (5000., 700., 700., 700.), (50., 500., 100., 900.), (5000., 500., 100., 900.), (900., 500., 100., 900.))).collect()
    assert sorted((r.side, round(r.score, 4)) for r in got) == [("above", 5.125), ("below", 0.0625)]


def test_linear_arm_reaches_the_optimum():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(200, 2))
    y = 3 + 2 * x[:, 0] + draw.normal(size=200)
    for q in quantile.QUANTILES:
        arm = quantile.LinearQuantile(q, 1e-6).fit(x, y)
        assert abs((y <= arm.predict(x)).mean() - q) <= 0.02
        loss = arm._loss(y - arm.predict(x))
        for step in np.eye(3) * 0.02:
            for s in (step, -step):
                assert loss <= arm._loss(y - arm.predict(x) - s[0] - x @ s[1:]) + 1e-5


@pytest.mark.parametrize("penalty", [1e-3, 0.05])
def test_linear_arm_solves_its_programme(penalty):
    """The best of all vertices: an optimum has as many zero residuals and zero weights as there are weights."""
    draw = np.random.default_rng(4)
    for n, k in ((12, 2), (25, 1)):
        x = draw.normal(size=(n, k))
        y = 3 + 2 * x[:, 0] + draw.normal(size=n) * (1 + np.abs(x[:, 0]))
        for q in quantile.QUANTILES:
            arm = quantile.LinearQuantile(q, penalty).fit(x, y)
            z, t, weight = (x - arm.shift) / arm.scale, y / arm.unit, penalty / arm.scale
            sides = np.vstack([np.column_stack([np.ones(n), z]), np.eye(k + 1)[1:]])
            values = np.concatenate([t, np.zeros(k)])
            corners = [list(c) for c in itertools.combinations(range(n + k), k + 1) if abs(np.linalg.det(sides[list(c)])) > 1e-9]
            best = min(arm._objective(t, z, np.linalg.solve(sides[c], values[c]), weight) for c in corners)
            assert abs(arm._objective(t, z, arm.weights, weight) - best) < 1e-7


def test_boosted_arm_orders_quantiles():
    x = np.random.default_rng(1).uniform(size=(300, 1))
    y = x[:, 0] * 10 + np.random.default_rng(2).normal(size=300)
    low, high = (quantile.BoostedQuantile(q, 40).fit(x, y).predict(x) for q in (0.05, 0.95))
    assert (low < high).mean() > 0.99 and 0.8 < ((y > low) & (y < high)).mean() < 0.98


def test_a_planted_jump_is_flagged(spark, noisy):
    from pyspark.sql import functions as F

    last = months(36)[-1]
    planted = noisy.withColumn("balance", F.when((F.col("accounting_period") == last) & (F.col("cost_center_code") == "C1"), 5000.0).otherwise(F.col("balance")))
    got = quantile.judge_periods(planted, [last], "run").collect()
    assert ("C1", "above") in [(r.cost_center_code, r.side) for r in got]
    with pytest.raises(ValueError):
        quantile.arm("forest")
    with pytest.raises(ValueError):
        quantile.judge_periods(planted, [last], "")


def test_no_leak_and_folds(noisy):
    from pyspark.sql import functions as F

    p = months(36)[-3]
    base = quantile.predict_periods(noisy, [p]).orderBy("cost_center_code").collect()
    later = noisy.withColumn("balance", F.when(F.col("accounting_period") > p, 1e9).otherwise(F.col("balance")))
    assert quantile.predict_periods(later, [p]).orderBy("cost_center_code").collect() == base
    assert quantile.folds(months(36), 5) == months(36)[-5:]
    with pytest.raises(ValueError):
        quantile.folds(months(14), 5)


def test_scores_of_nothing_are_null(rows):
    assert features.interval_scores(rows("actual double, predicted double, lower_bound double, upper_bound double")).first().coverage is None


def test_drift(rows):
    history = [(f"b{i}", f"2026-01-0{i} 00:00:00", "m", 100) for i in range(1, 6)]

    def red(n, past=history):
        data = [*past, ("now", "2026-02-01 00:00:00", "m", n)]
        return drifted(rows("invocation_id string, built_at string, model string, row_count long", *data), "now").count()

    assert red(105) == 0 and red(110) == 0 and red(111) == 1 and red(89) == 1 and red(1, history[:4]) == 0
    assert red(0, [(i, t, m, 0) for i, t, m, _ in history]) == 1
