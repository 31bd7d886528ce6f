"""Upserts by primary key: pure frame operators, used by the raw layer's loader."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by_order(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key in the given order; the fold is pre-aggregated, so hot keys are cheap."""
    whole = F.struct(*[F.col(c) for c in rows.columns])
    picked = rows.groupBy(*keys).agg(F.max_by(whole, F.struct(*order)).alias("__row"))
    return picked.select("__row.*")


def differs(columns: Sequence[str], left: str = "old", right: str = "new") -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | ~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out


def _paired(old: DataFrame, new: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(f"old.{k}") == F.col(f"new.{k}"))
    return old.withColumn("__old", F.lit(True)).alias("old").join(new.withColumn("__new", F.lit(True)).alias("new"), on, how)


def merge_rows(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every key once: the new row where there is one, else the old row. Keys absent from new are kept."""
    kept = old.join(new.select(*keys), list(keys), "left_anti").select(*old.columns)
    return kept.unionByName(new.select(*old.columns))


def changed_keys(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(keys, outcome): kept, inserted, updated or same."""
    both = _paired(old, new, keys, "full_outer")
    outcome = F.when(F.col("__new").isNull(), "kept").when(F.col("__old").isNull(), "inserted").when(differs(columns), "updated").otherwise("same")
    return both.select(*[F.coalesce(f"new.{k}", f"old.{k}").alias(k) for k in keys], outcome.alias("outcome"))


def moved_keys(old: DataFrame, new: DataFrame, keys: Sequence[str], home: str) -> DataFrame:
    """(keys, old_<home>, new_<home>): keys that the new rows put elsewhere."""
    both = _paired(old.select(*keys, home), new.select(*keys, home), keys, "inner").where(F.col(f"old.{home}") != F.col(f"new.{home}"))
    return both.select(*[F.col(f"new.{k}").alias(k) for k in keys], F.col(f"old.{home}").alias(f"old_{home}"), F.col(f"new.{home}").alias(f"new_{home}"))


def compared(new: DataFrame, old: DataFrame, keys: Sequence[str], columns: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """new with its outcome (inserted, updated or same), the names of changed columns, and old's `carry` columns as __old_<name>.

    One left join from new's side: rows that only old has are not looked at.
    """
    there = old.select(*keys, *[c for c in columns if c not in keys], *carry)
    both = _paired(there, new, keys, "right")
    changed = F.array_compact(F.array(*[F.when(~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")), F.lit(c)) for c in columns]))
    outcome = F.when(F.col("__old").isNull(), "inserted").when(F.size("__changed") > 0, "updated").otherwise("same")
    wide = both.select(*[F.col(f"new.{c}").alias(c) for c in new.columns], "__old", changed.alias("__changed"), *[F.col(f"old.{c}").alias(f"__old_{c}") for c in carry])
    return wide.withColumns({"outcome": outcome, "columns_changed": F.when(F.col("__old"), F.col("__changed")).otherwise(F.array().cast("array<string>"))}).drop("__old", "__changed")


def restated_columns(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """For rows that must not change: (keys, columns_changed) of those that do."""
    return compared(new, old, keys, columns).where("outcome = 'updated'").select(*keys, "columns_changed")


def stamped(found: DataFrame, columns: Sequence[str], run_id: str) -> DataFrame:
    """Rows of `compared` (carry: _first_run_id) with the run that first brought their key, and this run as the last."""
    return found.select(*columns, F.coalesce("__old__first_run_id", F.lit(run_id)).alias("_first_run_id"), F.lit(run_id).alias("_last_run_id"))


def numbered(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return rows.withColumn("__place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
