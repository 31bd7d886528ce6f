"""The panel features and decision rule of the anomaly layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstone.functions.core import month_flags, pinball

LAGS = (1, 3, 12)
MIDDLE_BAND = 1.0
SERIES = ["account_code", "cost_center_code"]


def size_bands(balances: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(cost_center_code, size_band): tercile band of a centre's median balance; all-zero centres have none. With `by`, for each of its values."""
    centres = balances.groupBy(*by, "cost_center_code").agg(F.expr("percentile(cast(balance as double), 0.5)").alias("middle"), F.max((F.col("balance") != 0).cast("int")).alias("live")).where("live = 1")
    cuts = centres.groupBy(*by).agg(F.expr("percentile(middle, array(1D/3, 2D/3))").alias("cuts"))
    placed = centres.join(cuts, list(by)) if by else centres.crossJoin(F.broadcast(cuts))  # one row
    band = F.when(F.col("middle") <= F.col("cuts")[0], 0.0).when(F.col("middle") > F.col("cuts")[1], 2.0).otherwise(MIDDLE_BAND)
    return placed.select(*by, "cost_center_code", band.alias("size_band"))


def design(balances: DataFrame, bands: DataFrame | None = None, lags: Sequence[int] = LAGS) -> DataFrame:
    """Lagged balances, month flags and size band per series and period; rows without all lags are left out.

    A centre without a band takes the middle one, as all do without bands.

    Lags go by position, so the series must have no gaps (the dense balance has none).
    """
    order = Window.partitionBy(*SERIES).orderBy("accounting_period")
    value = F.col("balance").cast("double")
    rows = balances.withColumns({f"lag_{k}": F.lag(value, k).over(order) for k in lags} | {"__place": F.row_number().over(order)})
    rows = rows.where(F.col("__place") > max(lags)).drop("__place")
    rows = rows.withColumn("size_band", F.lit(None).cast("double")) if bands is None else rows.join(bands, "cost_center_code", "left")
    return rows.select(*SERIES, "accounting_period", value.alias("actual"), *[f"lag_{k}" for k in lags], *month_flags(F.col("accounting_period")), F.coalesce("size_band", F.lit(MIDDLE_BAND)).alias("size_band"))


def gaps(balances: DataFrame) -> DataFrame:
    """Places where a series skips a month."""
    order = Window.partitionBy(*SERIES).orderBy("accounting_period")
    start = F.to_date(F.concat("accounting_period", F.lit("-01")))
    rows = balances.withColumn("__before", F.lag(start).over(order))
    return rows.where(F.months_between(start, "__before") != 1).select(*SERIES, "accounting_period")


def flags(predictions: DataFrame) -> DataFrame:
    """Predictions outside their interval, with score (excess over width) and side.

    Needs actual, lower_bound, predicted and upper_bound. Crossed and zero-width intervals are not
    flagged; the ends belong to the interval.
    """
    width = F.col("upper_bound") - F.col("lower_bound")
    above, below = F.col("actual") > F.col("upper_bound"), F.col("actual") < F.col("lower_bound")
    excess = F.when(above, F.col("actual") - F.col("upper_bound")).when(below, F.col("lower_bound") - F.col("actual"))
    rows = predictions.where((width > 0) & (above | below))
    return rows.withColumns({"residual": F.col("actual") - F.col("predicted"), "score": excess / width, "side": F.when(above, "above").otherwise("below")})


def interval_scores(predictions: DataFrame, quantiles: Sequence[float] = (0.05, 0.5, 0.95), by: Sequence[str] = ()) -> DataFrame:
    """Coverage, mean width, mean absolute error and pinball losses; null for no rows."""
    inside = F.col("actual").between(F.col("lower_bound"), F.col("upper_bound"))
    columns = dict(zip(quantiles, ("lower_bound", "predicted", "upper_bound"), strict=True))
    return predictions.groupBy(*by).agg(
        F.avg(inside.cast("double")).alias("coverage"), F.avg(F.col("upper_bound") - F.col("lower_bound")).alias("mean_width"), F.avg(F.abs(F.col("actual") - F.col("predicted"))).alias("mae"),
        *[F.avg(pinball(F.col("actual"), F.col(c), q)).alias(f"pinball_{int(q * 100):02d}") for q, c in columns.items()],
    )
