"""Quantile regression in numpy, fitted per judged period by grouped maps."""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .features import LAGS, MIDDLE_BAND, SERIES, design, flags, interval_scores, size_bands

#: Quantiles, penalty and nominal coverage of the interval.
QUANTILES = (0.05, 0.5, 0.95)
PENALTY = 0.001
COVERAGE = 0.90
RANDOM_STATE = 0
FEATURES = [*(f"lag_{k}" for k in LAGS), *(f"month_{m}" for m in range(1, 13)), "size_band"]


class LinearQuantile:
    """min mean(pinball) + penalty * |w|_1 with a free intercept: the linear programme itself, solved on its dual.

    The dual gives each row a price between (q - 1) / n and q / n; the prices' products with the
    features stay within the penalty. It is solved by a primal-dual interior-point method (predictor
    and corrector) whose linear systems have a row per feature; weights are the prices of its
    constraints. It ends when the gap between both programmes, which bounds the error, is below GAP.
    """

    #: Largest gap between the programmes, relative to the loss.
    GAP = 1e-9

    def __init__(self, q: float, penalty: float = PENALTY, steps: int = 200):
        self.q, self.penalty, self.steps = q, penalty, steps

    def fit(self, x: np.ndarray, y: np.ndarray) -> LinearQuantile:
        self.shift, self.scale = x.mean(0), np.where(x.std(0) > 0, x.std(0), 1.0)
        self.unit = max(float(np.abs(y - np.median(y)).mean()), 1e-9)
        z, t, n = (x - self.shift) / self.scale, y / self.unit, len(y)
        weight = np.maximum(self.penalty, 1e-12) / self.scale  # a slack needs some room
        k = z.shape[1]
        # Variables: a price per row, and a slack per feature (the intercept has none).
        cost = np.concatenate([-t, np.zeros(k)])
        low = np.concatenate([np.full(n, (self.q - 1) / n), -weight])
        high = np.concatenate([np.full(n, self.q / n), weight])
        design = np.column_stack([np.ones(n), z])

        def gather(v: np.ndarray) -> np.ndarray:  # the constraints' left sides
            out = design.T @ v[:n]
            out[1:] += v[n:]
            return out

        def spread(w: np.ndarray) -> np.ndarray:
            return np.concatenate([design @ w, w[1:]])

        point, w = np.zeros(n + k), np.zeros(k + 1)
        w[0] = -np.quantile(t, self.q)
        over, under = point - low, high - point
        rest = cost - spread(w)
        up, down = np.maximum(rest, 0) + 1.0, np.maximum(-rest, 0) + 1.0
        best = (np.inf, -w)
        for _ in range(self.steps):
            loss = self._objective(t, z, -w, weight)
            if loss < best[0]:
                best = (loss, -w)
            if best[0] + cost @ point <= self.GAP * max(1e-3, abs(best[0])) and np.abs(gather(point)).max() <= self.GAP:
                break
            missing, uneven = -gather(point), cost - spread(w) - up + down
            give = 1 / (up / over + down / under)
            system = (design * give[:n, None]).T @ design
            system[np.arange(1, k + 1), np.arange(1, k + 1)] += give[n:]
            system += np.eye(k + 1) * 1e-14 * max(1.0, np.trace(system))

            def move(toward_up: np.ndarray, toward_down: np.ndarray) -> tuple[np.ndarray, ...]:
                right = uneven - toward_up / over + toward_down / under  # noqa: B023
                dw = np.linalg.solve(system, missing + gather(give * right))  # noqa: B023
                dp = give * (spread(dw) - right)  # noqa: B023
                return dp, dw, (toward_up - up * dp) / over, (toward_down + down * dp) / under  # noqa: B023

            def reach(v: np.ndarray, dv: np.ndarray) -> float:
                back = dv < 0
                return min(1.0, float((v[back] / -dv[back]).min())) if back.any() else 1.0

            dp, dw, du, dd = move(-up * over, -down * under)
            first, second = min(reach(over, dp), reach(under, -dp)), min(reach(up, du), reach(down, dd))
            mean = (up @ over + down @ under) / (2 * len(point))
            ahead = ((up + second * du) @ (over + first * dp) + (down + second * dd) @ (under - first * dp)) / (2 * len(point))
            middle = mean * (ahead / mean) ** 3
            dp, dw, du, dd = move(middle - up * over - du * dp, middle - down * under + dd * dp)
            first, second = 0.9995 * min(reach(over, dp), reach(under, -dp)), 0.9995 * min(reach(up, du), reach(down, dd))
            point, over, under = point + first * dp, over + first * dp, under - first * dp
            w, up, down = w + second * dw, up + second * du, down + second * dd
        self.weights, self.gap = best[1], float(best[0] + cost @ point)
        return self

    def _objective(self, t: np.ndarray, z: np.ndarray, w: np.ndarray, weight: np.ndarray) -> float:
        return self._loss(t - w[0] - z @ w[1:]) + float(np.abs(w[1:]) @ weight)

    def _loss(self, r: np.ndarray) -> float:
        return float(np.where(r > 0, self.q * r, (self.q - 1) * r).mean())

    def predict(self, x: np.ndarray) -> np.ndarray:
        return (self.weights[0] + (x - self.shift) / self.scale @ self.weights[1:]) * self.unit


class BoostedQuantile:
    """Least-squares trees on the sign of the residual, with the residuals' quantile in each leaf."""

    def __init__(self, q: float, rounds: int = 100, depth: int = 3, rate: float = 0.1, random_state: int = RANDOM_STATE):
        self.q, self.rounds, self.depth, self.rate = q, rounds, depth, rate
        self.draw = np.random.default_rng(random_state)  # of features with equal gains the first of a random order splits

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedQuantile:
        self.start = float(np.quantile(y, self.q))
        self.order = [np.argsort(x[:, j], kind="stable") for j in range(x.shape[1])]
        now, self.trees = np.full(len(y), self.start), []
        for _ in range(self.rounds):
            gradient = np.where(y > now, self.q, self.q - 1)
            tree = self._grow(x, gradient, y - now, np.ones(len(y), bool), 0)
            self.trees.append(tree)
            now = now + self.rate * self._apply(tree, x)
        return self

    def _grow(self, x: np.ndarray, g: np.ndarray, residual: np.ndarray, rows: np.ndarray, level: int):
        n, total = int(rows.sum()), g[rows].sum()
        best = (total * total / n + 1e-9, None)
        if level < self.depth and n > 1:
            for j in self.draw.permutation(len(self.order)).tolist():
                own = self.order[j][rows[self.order[j]]]
                left = np.cumsum(g[own])[:-1]
                count = np.arange(1, n)
                gain = np.where(x[own[1:], j] > x[own[:-1], j], left**2 / count + (total - left) ** 2 / (n - count), -np.inf)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], (j, (x[own[k], j] + x[own[k + 1], j]) / 2))
        if best[1] is None:
            return float(np.quantile(residual[rows], self.q))
        j, cut = best[1]
        low = x[:, j] <= cut
        return j, cut, self._grow(x, g, residual, rows & low, level + 1), self._grow(x, g, residual, rows & ~low, level + 1)

    def _apply(self, tree, x: np.ndarray) -> np.ndarray:
        if not isinstance(tree, tuple):
            return np.full(len(x), tree)
        j, cut, low, high = tree
        return np.where(x[:, j] <= cut, self._apply(low, x), self._apply(high, x))

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.start + self.rate * sum(self._apply(t, x) for t in self.trees)


ARMS: dict[str, Callable] = {"quantile_linear": LinearQuantile, "quantile_gbr": BoostedQuantile}


def arm(family: str) -> Callable:
    if family not in ARMS:
        raise ValueError(f"unknown model family {family!r}; one of {sorted(ARMS)}")
    return ARMS[family]


def money(c: Column, places: int = 4) -> Column:
    """Rounded half to even."""
    return F.bround(c.cast("decimal(38,8)"), places).cast(f"decimal(38,{places})")


def panels(balances: DataFrame, periods: Sequence[str]) -> DataFrame:
    """Design rows up to and including each judged period, with `judged`; bands come from the periods before it.

    Lags and flags don't depend on the judged period, so one plan makes the rows once and repeats them
    for each; only the bands are made for each judged period, of one row a centre.
    """
    ordered = sorted(set(periods))
    if not ordered:
        raise ValueError("no periods to judge")
    judged = balances.sparkSession.createDataFrame([(p,) for p in ordered], "judged string")
    before = balances.join(F.broadcast(judged), F.col("accounting_period") < F.col("judged"))  # months judged: one row each
    bands = size_bands(before, by=("judged",)).withColumnRenamed("size_band", "__band")
    rows = design(balances).join(F.broadcast(judged), F.col("accounting_period") <= F.col("judged"))
    banded = rows.join(bands, ["judged", "cost_center_code"], "left")
    return banded.withColumn("size_band", F.coalesce("__band", F.lit(MIDDLE_BAND))).drop("__band")


def predict_periods(balances: DataFrame, periods: Sequence[str], family: str = "quantile_linear", random_state: int = RANDOM_STATE) -> DataFrame:
    """For each judged period a fit on all earlier ones, and its predictions.

    The training panels of all judged periods are one frame, grouped by judged period. A group is a
    panel of series x earlier months, the unit that the model needs whole: 16 numbers a row, so ten
    years of 100,000 series take some 1.6 GB in one worker, and that is the bound of this arm.
    """
    own = {"random_state": random_state} if family == "quantile_gbr" else {}
    make = functools.partial(arm(family), **own)
    panel = panels(balances, periods)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        period = pdf["judged"].iloc[0]
        old, new = pdf[pdf["accounting_period"] < period], pdf[pdf["accounting_period"] == period]
        out = new[[*SERIES, "accounting_period", "actual"]].copy()
        if old.empty or new.empty:
            return out.iloc[:0].assign(lower_bound=[], predicted=[], upper_bound=[])
        old = old.sort_values([*SERIES, "accounting_period"])
        x, y, ahead = old[FEATURES].to_numpy(float), old["actual"].to_numpy(float), new[FEATURES].to_numpy(float)
        for name, q in zip(("lower_bound", "predicted", "upper_bound"), QUANTILES, strict=True):
            out[name] = make(q).fit(x, y).predict(ahead)
        return out

    return panel.groupBy("judged").applyInPandas(fit, "account_code string, cost_center_code string, accounting_period string, actual double, lower_bound double, predicted double, upper_bound double")


def judge_periods(balances: DataFrame, periods: Sequence[str], run_id: str, family: str = "quantile_linear") -> DataFrame:
    """Flags of the judged periods, money with four places (half even)."""
    if not run_id:
        raise ValueError("a run id is required")
    found = flags(predict_periods(balances, periods, family))
    return found.select(*SERIES, "accounting_period", *[money(F.col(c)).alias(c) for c in ("actual", "predicted", "lower_bound", "upper_bound", "residual", "score")], "side", F.lit(family).alias("model_family"), F.lit(COVERAGE).alias("nominal_coverage"), F.lit(run_id).alias("run_id"))


def folds(periods: Sequence[str], splits: int = 5) -> list[str]:
    """The last `splits` periods, each to be predicted from all before it."""
    ordered = sorted(set(periods))
    if splits < 1 or len(ordered) <= splits + max(LAGS):
        raise ValueError(f"{len(ordered)} periods are too few for {splits} folds after {max(LAGS)} lags")
    return ordered[-splits:]


def backtest(balances: DataFrame, splits: int = 5, random_state: int = RANDOM_STATE) -> dict[str, dict]:
    """Scores of every arm over the same folds."""
    judged = folds([r[0] for r in balances.select("accounting_period").distinct().collect()], splits)
    return {family: interval_scores(predict_periods(balances, judged, family, random_state)).first().asDict() for family in ARMS}
