"""Analytic predicates over ledgers: growth streaks, outliers, long tails, breakdowns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def growth_streaks(totals: DataFrame, series: str, total: str, ratio: str = "1.5", least: int = 3) -> DataFrame:
    """(series, since, months): at least `least` calendar-adjacent months that each grew by the ratio."""
    w = Window.partitionBy(series).orderBy("accounting_period")
    month = F.to_date(F.concat("accounting_period", F.lit("-01")))
    grew = (F.col(total) >= F.lag(total).over(w) * F.lit(ratio).cast("decimal(5,2)")) & (F.add_months(F.lag(month).over(w), 1) == month)
    steps = totals.withColumn("broken", F.when(grew, 0).otherwise(1))
    islands = steps.withColumn("island", F.sum("broken").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy(series, "island").agg(F.min("accounting_period").alias("since"), (F.count("*") - 1).alias("months")).where(F.col("months") >= least).drop("island")


def amount_outliers(lines: DataFrame, group: str, amount: str, times: float = 20) -> DataFrame:
    found = lines.groupBy(group).agg(F.max(amount).alias("largest"), F.expr(f"percentile({amount}, 0.5)").alias("middle"))
    return found.where((F.col("middle") > 0) & (F.col("largest") >= times * F.col("middle")))


def long_tail_shape(lines: DataFrame, period: str, amount: str, top: int = 20) -> DataFrame:
    """(period, raised, top_share): total against the mean of the other periods, and the largest lines' share."""
    place = F.row_number().over(Window.partitionBy(period).orderBy(F.desc(amount)))
    # Nothing but the rank and its bound, so each map task sends its own largest lines only.
    tops = lines.select(period, amount).withColumn("place", place).where(F.col("place") <= top).groupBy(period).agg(F.sum(amount).cast("double").alias("top"))
    sums = lines.groupBy(period).agg(F.sum(amount).cast("double").alias("total")).join(tops, period)
    whole = sums.agg(F.sum("total").alias("all_total"), F.count("*").alias("n"))
    others = (F.col("all_total") - F.col("total")) / F.nullif(F.col("n") - 1, F.lit(0))
    return sums.crossJoin(F.broadcast(whole)).select(period, (F.col("total") / F.nullif(others, F.lit(0.0))).alias("raised"), (F.col("top") / F.nullif(F.col("total"), F.lit(0.0))).alias("top_share"))


def spread_of(grown: DataFrame, amount: str) -> DataFrame:
    """(n_groups, total, top_share) of a breakdown: how many groups have a part in it, and the largest one's share."""
    sums = grown.agg(F.count("*").alias("n_groups"), F.sum(amount).alias("total"), F.max(amount).alias("top"))
    return sums.select("n_groups", "total", (F.col("top").cast("double") / F.nullif(F.col("total").cast("double"), F.lit(0.0))).alias("top_share"))


def increases(now: DataFrame, before: DataFrame, key: str, amount: str) -> DataFrame:
    """(key, increase): groups whose sum has grown."""
    then = before.groupBy(key).agg(F.sum(amount).alias("then"))
    grown = now.groupBy(key).agg(F.sum(amount).alias("now")).join(then, key, "left")
    return grown.withColumn("increase", F.col("now") - F.coalesce("then", F.lit(0))).where("increase > 0").select(key, "increase")
