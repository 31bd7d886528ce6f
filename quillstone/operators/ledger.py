"""The mart: dimensions, point-in-time facts and the dense monthly balance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstone.functions.core import Windows, empty_to_null, period_end, period_of, share, signed

from .scd2 import asof_join, renamed, scd2


def dim_account(source: DataFrame) -> DataFrame:
    return scd2(source, ["account_code"], ["name", "parent_code", "account_type"], "effective_date", nullable=["parent_code"])


def dim_cost_center(source: DataFrame) -> DataFrame:
    return scd2(source, ["cc_code"], ["name", "dept_code"], "effective_date")


def dim_fx_rate(source: DataFrame) -> DataFrame:
    return scd2(source, ["currency"], ["rate_to_base"], "rate_date", casts={"rate_to_base": "decimal(18,6)"})


def dim_vendor(source: DataFrame) -> DataFrame:
    return source.select("vendor_code", "name", "category")


def base_amount(amount: Column, rate: Column) -> Column:
    """Converted and rounded half up at the line: decimal(18,2) x decimal(18,6) -> decimal(32,2)."""
    return F.round(amount * rate, 2).cast("decimal(32,2)")


def entry_facts(source: DataFrame, accounts: DataFrame, centres: DataFrame, rates: DataFrame, vendors: DataFrame, extra: tuple[str, ...] = (), strategy: str = "auto") -> DataFrame:
    """Typed journal lines with the account, centre and rate versions valid at their date.

    A line without a valid version of all three is dropped (a gate reports it); a line without
    vendor stays.
    """
    lines = source.select(
        "entry_id", "version", F.col("accounting_date").cast("date").alias("accounting_date"), F.col("posted_at").cast("date").alias("posted_at"), "account_code", "cost_center_code", "currency",
        F.col("amount_dr").cast("decimal(18,2)").alias("amount_dr"), F.col("amount_cr").cast("decimal(18,2)").alias("amount_cr"), "doc_id", *extra, empty_to_null(F.col("vendor_code")).alias("vendor_code"),
        "description", F.col("_first_run_id").alias("source_first_run_id"), F.col("_last_run_id").alias("source_last_run_id"),
    )
    at = "accounting_date"
    lines = renamed(asof_join(lines, accounts, {"account_code": "account_code"}, at, strategy=strategy), account_key="surrogate_key", account_name="name", account_type="account_type", parent_code="parent_code")
    lines = renamed(asof_join(lines, centres, {"cost_center_code": "cc_code"}, at, strategy=strategy), cost_center_key="surrogate_key", cost_center_name="name", dept_code="dept_code")
    lines = renamed(asof_join(lines, rates, {"currency": "currency"}, at, strategy=strategy), fx_key="surrogate_key", rate_to_base="rate_to_base")
    names = vendors.select("vendor_code", F.col("name").alias("vendor_name"))
    lines = lines.join(names, "vendor_code", "left")
    rate = F.col("rate_to_base")
    lines = lines.withColumns({"accounting_period": period_of(F.col(at)), "amount_dr_base": base_amount(F.col("amount_dr"), rate), "amount_cr_base": base_amount(F.col("amount_cr"), rate)})
    return lines.select(
        "entry_id", "version", at, "accounting_period", "posted_at", "account_key", "cost_center_key", "fx_key", "account_code", "account_name", "account_type", "parent_code",
        "cost_center_code", "cost_center_name", "dept_code", "currency", "rate_to_base", "amount_dr", "amount_cr", "amount_dr_base", "amount_cr_base", "doc_id", *extra,
        "vendor_code", "vendor_name", "description", "source_first_run_id", "source_last_run_id",
    )


def closing_type(date: Column, kind: Column) -> Column:
    """The account type at the latest date; on a tie the greatest text."""
    return F.max_by(kind, F.struct(date, kind))


def monthly_balance(entries: DataFrame, adjustments: DataFrame, accounts: DataFrame | None = None, centres: DataFrame | None = None, periods: tuple[str, str] | None = None, windows: Windows | None = None, type_source: str = "reported", strategy: str = "auto") -> DataFrame:
    """A row for every (account, centre) pair and month, on the reported and the restated basis.

    entries and adjustments need account_code, cost_center_code, accounting_period, accounting_date,
    account_type and base amounts; adjustments also adjustment_type. periods fixes the range (default:
    the one the facts span). type_source="all" also takes types from restatements, for pairs that have
    nothing else; by default such a pair has no type and the credit-normal sign.
    """
    windows = windows or Windows()
    pair = ["account_code", "cost_center_code"]
    grain = [*pair, "accounting_period"]
    used = [*grain, "accounting_date", "account_type", "amount_dr_base", "amount_cr_base"]
    lines = entries.select(*used, F.lit(None).cast("string").alias("adjustment_type")).unionByName(adjustments.select(*used, "adjustment_type"))
    restated = F.coalesce(F.col("adjustment_type") == "restatement", F.lit(False))
    counted = ~restated & (F.col("adjustment_type").isNull() | (F.col("adjustment_type") == "correction"))
    amount = lambda side, when: F.sum(F.when(when, F.col(f"amount_{side}_base"))).cast("decimal(38,2)")
    typed = counted if type_source == "reported" else counted | restated
    kind = F.when(typed, F.col("account_type"))
    # One aggregation gives both bases and the pairs: the lines are read and shuffled once.
    sums = lines.groupBy(*grain).agg(
        amount("dr", counted).alias("debit_total"), amount("cr", counted).alias("credit_total"), amount("dr", restated).alias("restated_dr"), amount("cr", restated).alias("restated_cr"),
        F.max_by(kind, F.when(typed, F.struct("accounting_date", "account_type"))).alias("closing_type"),
    )
    identity = sums.select(*pair).distinct()
    if periods is None:
        span = sums.agg(F.min("accounting_period").alias("first"), F.max("accounting_period").alias("last")).where("first is not null")
    else:
        span = entries.sparkSession.createDataFrame([periods], "first string, last string")
    month = lambda c: F.to_date(F.concat(F.col(c), F.lit("-01")))
    months = span.select(F.explode(F.sequence(month("first"), month("last"), F.expr("interval 1 month"))).alias("start")).select(period_of(F.col("start")).alias("accounting_period"))
    # The months of a range, some thousands at most: one row each.
    dense = identity.crossJoin(F.broadcast(months)).join(sums, grain, "left")
    order = Window.partitionBy(*pair).orderBy("accounting_period")
    before, after = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(0, Window.unboundedFollowing)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("decimal(38,2)"))
    dense = dense.withColumns({c: zero(c) for c in ("debit_total", "credit_total", "restated_dr", "restated_cr")} | {"account_type": F.coalesce(F.last("closing_type", True).over(before), F.first("closing_type", True).over(after))})
    based = dense.withColumns({
        "balance_as_reported": signed(F.col("account_type"), F.col("debit_total"), F.col("credit_total")).cast("decimal(38,2)"),
        "restatement_delta": signed(F.col("account_type"), F.col("restated_dr"), F.col("restated_cr")).cast("decimal(38,2)"),
    })
    balance = F.col("balance_as_restated")
    based = based.withColumn("balance_as_restated", (F.col("balance_as_reported") + F.col("restatement_delta")).cast("decimal(38,2)"))
    rolling = order.rowsBetween(1 - windows.rolling, 0)
    compared = based.withColumns({
        "__mom": F.lag(balance, windows.mom).over(order), "__yoy": F.lag(balance, windows.yoy).over(order),
        "balance_rolling_3m": F.round(F.avg(balance).over(rolling), 2).cast("decimal(38,2)"), "rolling_periods": F.count(balance).over(rolling).cast("int"),
        "__end": period_end(F.col("accounting_period")),
    })
    for k in ("mom", "yoy"):
        delta = (balance - F.col(f"__{k}")).cast("decimal(38,2)")
        compared = compared.withColumns({f"balance_delta_{k}": delta, f"balance_pct_{k}": share(delta, F.col(f"__{k}"))})
    named = compared
    if accounts is not None:
        named = renamed(asof_join(named, accounts, {"account_code": "account_code"}, "__end", "left", strategy), account_name="name")
    else:
        named = named.withColumn("account_name", F.lit(None).cast("string"))
    if centres is not None:
        named = renamed(asof_join(named, centres, {"cost_center_code": "cc_code"}, "__end", "left", strategy), cost_center_name="name", dept_code="dept_code")
    else:
        named = named.withColumns({"cost_center_name": F.lit(None).cast("string"), "dept_code": F.lit(None).cast("string")})
    return named.select(
        "account_code", "account_name", "cost_center_code", "cost_center_name", "dept_code", "accounting_period", "account_type", "debit_total", "credit_total", "balance_as_reported",
        "restatement_delta", "balance_as_restated", "balance_delta_mom", "balance_pct_mom", "balance_delta_yoy", "balance_pct_yoy", "balance_rolling_3m", "rolling_periods",
    )


def row_counts(models: dict[str, DataFrame], invocation_id: str) -> DataFrame:
    """A row per model: who counted, when, how many."""
    parts = [df.agg(F.count("*").alias("row_count")).select(F.lit(invocation_id).alias("invocation_id"), F.current_timestamp().alias("built_at"), F.lit(name).alias("model"), "row_count") for name, df in models.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
