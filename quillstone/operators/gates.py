"""Quality gates: each returns its failing rows, so an empty frame is a pass."""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstone.functions.core import OPEN_END


def not_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values that occur more than once; rows with a null in the key are not_null's business."""
    whole = df.dropna(subset=list(columns))
    return whole.groupBy(*columns).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def nulls(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Children whose non-null reference has no parent."""
    keys = parent.select(F.col(parent_column).alias("__parent")).distinct()
    return child.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("__parent"), "left_anti")


def not_accepted(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.where(~F.col(column).isin(*values))


def unbalanced(lines: DataFrame, group: str = "doc_id", debit: str = "amount_dr_base", credit: str = "amount_cr_base", tolerance: float = 0) -> DataFrame:
    sums = lines.groupBy(group).agg(F.sum(debit).alias("debit"), F.sum(credit).alias("credit"))
    return sums.where(F.abs(F.col("debit") - F.col("credit")) > F.lit(tolerance))


def interval_faults(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, problem): inverted, overlap, gap, and keys without exactly one current version."""
    ahead = dim.withColumn("__next", F.lead("valid_from").over(Window.partitionBy(*keys).orderBy("valid_from", "valid_to")))
    expected = F.date_add(F.least("valid_to", F.date_sub(F.lit(OPEN_END).cast("date"), 1)), 1)
    problem = F.array_compact(F.array(
        F.when(F.col("valid_to") < F.col("valid_from"), F.lit("inverted")),
        F.when(F.col("__next") <= F.col("valid_to"), F.lit("overlap")),
        F.when((F.col("__next") > expected), F.lit("gap")),
    ))
    faults = ahead.select(*keys, F.explode(problem).alias("problem"))
    current = dim.groupBy(*keys).agg(F.count_if(F.col("is_current")).alias("n")).where("n <> 1").select(*keys, F.lit("current").alias("problem"))
    return faults.unionByName(current)


def drifted(counts: DataFrame, invocation_id: str, window: int = 5, tolerance: str = "0.10") -> DataFrame:
    """Models whose count leaves the median of the last `window` other builds by more than the tolerance.

    Silent while a model has fewer builds than the window; a median of 0 always fails.
    """
    recent = counts.where(F.col("invocation_id") != invocation_id)
    order = Window.partitionBy("model").orderBy(F.desc("built_at"), F.desc("invocation_id"))
    recent = recent.withColumn("recency", F.row_number().over(order)).where(F.col("recency") <= window)
    baseline = recent.groupBy("model").agg(F.expr("percentile(row_count, 0.5)").cast("decimal(38,2)").alias("baseline"), F.count("*").alias("builds")).where(F.col("builds") >= window)
    now = counts.where(F.col("invocation_id") == invocation_id).select("model", "row_count")
    low, high = (F.col("baseline") * (F.lit(1).cast("decimal(5,2)") + F.lit(s + tolerance).cast("decimal(5,2)")) for s in ("-", ""))
    return now.join(baseline, "model").where((F.col("baseline") == 0) | ~F.col("row_count").between(low, high))


def unattributed(source: DataFrame, fact: DataFrame, label: str) -> DataFrame:
    """A row if the fact's number of lines or original-currency totals differ from the source's."""
    def totals(df: DataFrame, prefix: str) -> DataFrame:
        side = lambda c: F.coalesce(F.sum(F.col(c).cast("decimal(18,2)")), F.lit(0)).cast("decimal(38,2)")
        return df.agg(F.count("*").alias(f"{prefix}_lines"), side("amount_dr").alias(f"{prefix}_dr"), side("amount_cr").alias(f"{prefix}_cr")).withColumn("source", F.lit(label))

    both = totals(source, "source").join(totals(fact, "fact"), "source")
    differs = F.lit(False)
    for c in ("lines", "dr", "cr"):
        differs = differs | (F.col(f"source_{c}") != F.col(f"fact_{c}"))
    label_of = F.when(F.col("source_lines") != F.col("fact_lines"), F.lit("lines are missing or multiplied")).otherwise(F.lit("totals differ"))
    return both.where(differs).withColumn("problem", label_of)


@dataclass
class Gate:
    name: str
    model: str
    failing: DataFrame
    table: DataFrame | None = None  # where the gate forbids nulls in one column: its table
    column: str | None = None


@dataclass
class Verdicts:
    failed: dict[str, int] = field(default_factory=dict)
    passed: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)

    @property
    def green(self) -> bool:
        return not self.failed


def null_counts(df: DataFrame, gates: dict[str, str]) -> DataFrame:
    """(gate, n) for gates that each forbid nulls in one column (gate -> column): one pass over df for all."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(gates.values())])
    each = F.array(*[F.struct(F.lit(g).alias("gate"), F.col(f"n{i}").alias("n")) for i, g in enumerate(gates)])
    return counts.select(F.explode(each).alias("x")).select("x.gate", "x.n")


def judge(gates: Sequence[Gate], audit: str | None = None) -> Verdicts:
    """Count the failing rows of all gates in one job, then store those of the gates that fail under `audit`, a folder per gate.

    Gates that forbid nulls in columns of one table share one pass over it.
    """
    out = Verdicts()
    if not gates:
        return out
    by_table: dict[int, tuple[DataFrame, dict[str, str]]] = {}
    parts = []
    for gate in gates:
        if gate.column is not None:
            by_table.setdefault(id(gate.table), (gate.table, {}))[1][gate.name] = gate.column
        else:
            parts.append(gate.failing.agg(F.count("*").alias("n")).select(F.lit(gate.name).alias("gate"), "n"))
    parts += [null_counts(df, own) for df, own in by_table.values()]
    counts = dict(functools.reduce(DataFrame.unionByName, parts).collect())  # a row per gate
    for gate in gates:
        if counts[gate.name]:
            out.failed[gate.name] = counts[gate.name]
            if audit is not None:
                gate.failing.write.mode("overwrite").parquet(f"{audit}/{gate.name}")
        else:
            out.passed.append(gate.name)
    return out
