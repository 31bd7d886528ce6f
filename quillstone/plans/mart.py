"""The mart: a registry of models, gated builds, and publication by one pointer."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.contracts import all_contracts
from quillstone.operators import gates, ledger
from quillstone.operators.scd2 import asof_join
from quillstone.sources import files, parts, raw

# Model, gate and column names, and the prefix of a build's name.
PREFIX = "mart__b"
#: Seconds that a promotion waits for another one.
LOCK_TIMEOUT = 30.0
COUNTED = ("dim_account", "dim_cost_center", "dim_fx_rate", "dim_vendor", "fct_gl_entry", "fct_gl_adjustment", "agg_monthly_balance")


@dataclass(frozen=True)
class Model:
    name: str
    needs: tuple[str, ...]  # landing tables as landing.x, models by name
    build: Callable[..., DataFrame]


MODELS: dict[str, Model] = {m.name: m for m in (
    Model("dim_account", ("landing.dim_account_src",), ledger.dim_account),
    Model("dim_cost_center", ("landing.dim_cost_center_src",), ledger.dim_cost_center),
    Model("dim_fx_rate", ("landing.fx_rate",), ledger.dim_fx_rate),
    Model("dim_vendor", ("landing.dim_vendor",), ledger.dim_vendor),
    Model("fct_gl_entry", ("landing.gl_entry", "dim_account", "dim_cost_center", "dim_fx_rate", "dim_vendor"), ledger.entry_facts),
    Model("fct_gl_adjustment", ("landing.gl_adjustment", "dim_account", "dim_cost_center", "dim_fx_rate", "dim_vendor"), lambda *a: ledger.entry_facts(*a, extra=("adjusts_entry_id", "adjustment_type"))),
    Model("agg_monthly_balance", ("fct_gl_entry", "fct_gl_adjustment", "dim_account", "dim_cost_center"), ledger.monthly_balance),
)}


class MartUnavailable(LookupError):
    pass


class WrongWarehouse(RuntimeError):
    pass


class GatesFailed(RuntimeError):
    def __init__(self, failed: dict[str, int]):
        super().__init__(f"gates failed: {failed}")
        self.failed = failed


def impact(table: str) -> list[str]:
    """All models that a source table reaches, by the declared feeds and the models' needs."""
    contract = all_contracts().get(table)
    if contract is None:
        raise KeyError(f"no contract for {table}")
    reached, frontier = set(), set(contract.feeds)
    while frontier:
        frontier = {m.name for m in MODELS.values() if frontier & set(m.needs)} - reached
        reached |= frontier
    return sorted(reached)


def unresolved_feeds(used: set[str] | None = None) -> list[str]:
    """Declared feeds that no model needs."""
    used = used if used is not None else {n for m in MODELS.values() for n in m.needs}
    return sorted({f for c in all_contracts().values() for f in c.feeds} - used)


# ---- publication ----


def current(spark: SparkSession, warehouse: str) -> str | None:
    name = files.read_text(spark, f"{warehouse}/_CURRENT")
    return name.strip() if name else None


def published(spark: SparkSession, warehouse: str, model: str) -> DataFrame:
    """A model of the published build."""
    build = current(spark, warehouse)
    if build is None or not files.exists(spark, f"{warehouse}/{build}/{model}"):
        raise MartUnavailable(f"{model} is not published under {warehouse}")
    return spark.read.parquet(f"{warehouse}/{build}/{model}")


def prepare(spark: SparkSession, warehouse: str, run_id: str) -> str:
    """A clean folder for a build; the published row counts are carried forward into it."""
    build = f"{PREFIX}{run_id}"
    if build == current(spark, warehouse):
        raise ValueError(f"{build} is the published build")
    files.delete(spark, f"{warehouse}/{build}")
    if (now := current(spark, warehouse)) and files.exists(spark, f"{warehouse}/{now}/model_row_count"):
        spark.read.parquet(f"{warehouse}/{now}/model_row_count").write.parquet(f"{warehouse}/{build}/model_row_count")
    return build


def claim(spark: SparkSession, warehouse: str, root: str) -> None:
    """Bind a warehouse to the raw layer it is built from; a warehouse of another one is refused."""
    own = files.read_text(spark, f"{warehouse}/_SOURCE")
    if own is None:
        files.write_text(spark, f"{warehouse}/_SOURCE", root)
    elif own != root:
        raise WrongWarehouse(f"{warehouse} is built from {own}, not from {root}")


def promote(spark: SparkSession, warehouse: str, build: str, lock_timeout: float = LOCK_TIMEOUT) -> None:
    """Publish a build: one atomic change of the pointer, under a lock that is waited for `lock_timeout` seconds at most.

    A build that doesn't exist is refused. On any failure the published build stays.
    """
    with files.lock(spark, f"{warehouse}/_publishing", lock_timeout):
        if not files.exists(spark, f"{warehouse}/{build}/agg_monthly_balance/_SUCCESS"):
            raise MartUnavailable(f"{build} was not built")
        files.write_text(spark, f"{warehouse}/_CURRENT", build)


def sweep(spark: SparkSession, warehouse: str, keep: int = 1) -> list[str]:
    """Delete old builds: all but the published one and the `keep` newest others, whose readers may still run."""
    now = current(spark, warehouse)
    old = [n for n in files.names(spark, warehouse) if n.startswith(PREFIX) and n != now and not n.endswith("_audit")]
    gone = old[: max(0, len(old) - keep)]
    for name in gone:
        files.delete(spark, f"{warehouse}/{name}")
        files.delete(spark, f"{warehouse}/{name}_audit")
    return gone


def export_landing(spark: SparkSession, root: str, out: str, run_id: str) -> dict[str, dict[str, str]]:
    """Copy every table of the raw layer out, below a folder of this run: table -> exported type of each column.

    A table of which nothing has been loaded is refused before any is copied.
    """
    tables = {t: raw.read(spark, root, c, required=c.partition_by is not None) for t, c in all_contracts().items()}
    return {t: raw.export(rows, f"{out}/{run_id}/{t}") for t, rows in tables.items()}


# ---- building ----

# The columns of the models that must be present, and those that together name a row.
NOT_NULL = {
    "dim_account": ["surrogate_key", "account_code", "valid_from", "valid_to", "is_current"], "dim_cost_center": ["surrogate_key", "cc_code", "valid_from", "valid_to", "is_current"],
    "dim_fx_rate": ["surrogate_key", "currency", "rate_to_base", "valid_from", "valid_to", "is_current"], "dim_vendor": ["vendor_code"],
    "fct_gl_entry": ["entry_id", "version", "accounting_date", "account_key", "cost_center_key", "fx_key", "account_name", "cost_center_name", "amount_dr_base", "amount_cr_base"],
    "fct_gl_adjustment": ["entry_id", "version", "accounting_date", "account_key", "cost_center_key", "fx_key", "account_name", "cost_center_name", "amount_dr_base", "amount_cr_base", "adjustment_type"],
    "agg_monthly_balance": ["account_code", "cost_center_code", "accounting_period", "account_name", "cost_center_name", "balance_as_reported", "restatement_delta", "balance_as_restated"],
}
UNIQUE = {
    "dim_account": ["surrogate_key"], "dim_cost_center": ["surrogate_key"], "dim_fx_rate": ["surrogate_key"], "dim_vendor": ["vendor_code"], "fct_gl_entry": ["entry_id", "version"],
    "fct_gl_adjustment": ["entry_id", "version"], "agg_monthly_balance": ["account_code", "cost_center_code", "accounting_period"],
}
INTERVALS = {"dim_account": ["account_code"], "dim_cost_center": ["cc_code"], "dim_fx_rate": ["currency"]}
REFERENCES = (("account_key", "dim_account", "surrogate_key"), ("cost_center_key", "dim_cost_center", "surrogate_key"), ("fx_key", "dim_fx_rate", "surrogate_key"), ("vendor_code", "dim_vendor", "vendor_code"))


def _gates(spark: SparkSession, name: str, built: dict[str, DataFrame], landing: Callable[[str], DataFrame]) -> list[gates.Gate]:
    df = built[name]
    out = [gates.Gate(f"unique_{name}", name, gates.not_unique(df, UNIQUE[name]))]
    out += [gates.Gate(f"not_null_{name}_{c}", name, gates.nulls(df, c), df, c) for c in NOT_NULL[name]]
    if name in INTERVALS:
        out.append(gates.Gate(f"intervals_are_consistent_{name}", name, gates.interval_faults(df, INTERVALS[name])))
    if name.startswith("fct_"):
        out += [gates.Gate(f"relationships_{name}_{c}", name, gates.orphans(df, c, built[p], pc)) for c, p, pc in REFERENCES]
        source = name.removeprefix("fct_")
        out.append(gates.Gate(f"every_entry_is_attributed_{source}", name, gates.unattributed(landing(f"landing.{source}"), df, source)))
    if name == "fct_gl_entry":
        out.append(gates.Gate("vouchers_are_balanced", name, gates.unbalanced(df)))
    if name == "fct_gl_adjustment":
        out.append(gates.Gate("accepted_values_adjustment_type", name, gates.not_accepted(df, "adjustment_type", ["correction", "restatement"])))
    return out


def landing_of(spark: SparkSession, root: str) -> Callable[[str], DataFrame]:
    contracts = {f: c for c in all_contracts().values() for f in c.feeds}

    def read(name: str) -> DataFrame:
        return raw.read(spark, root, contracts[name]).drop(raw.PERIOD)

    return read


def build_and_promote(spark: SparkSession, root: str, warehouse: str, run_id: str, landing: Callable[[str], DataFrame] | None = None) -> gates.Verdicts:
    """Build every model aside, judge its gates, and publish if all are green.

    A model whose gate fails stops what stands on it: those models are skipped. Failing rows are kept
    under the build's audit folder. On red the published build stays as it was.
    """
    claim(spark, warehouse, root)
    landing = landing or landing_of(spark, root)
    build = prepare(spark, warehouse, run_id)
    audit = f"{warehouse}/{build}_audit"
    built: dict[str, DataFrame] = {}
    verdicts = gates.Verdicts()
    for model in MODELS.values():
        if any(n in MODELS and n not in built for n in model.needs):
            verdicts.skipped.append(model.name)
            continue
        path = f"{warehouse}/{build}/{model.name}"
        model.build(*(built[n] if n in MODELS else landing(n) for n in model.needs)).write.mode("overwrite").parquet(path)
        built[model.name] = spark.read.parquet(path)
        own = gates.judge(_gates(spark, model.name, built, landing), audit)
        verdicts.passed += own.passed
        verdicts.failed |= own.failed
        if own.failed:
            del built[model.name]
    if verdicts.green:
        counts = f"{warehouse}/{build}/model_row_count"
        ledger.row_counts({n: built[n] for n in COUNTED}, run_id).write.mode("append").parquet(counts)
        drift = gates.judge([gates.Gate("row_counts_have_not_drifted", "model_row_count", gates.drifted(spark.read.parquet(counts), run_id))], audit)
        verdicts.passed += drift.passed
        verdicts.failed |= drift.failed
    if not verdicts.green:
        raise GatesFailed(verdicts.failed)
    promote(spark, warehouse, build)
    return verdicts


# ---- anomaly flags ----


def balances(spark: SparkSession, warehouse: str, ordered: bool = False) -> DataFrame:
    """The restated balance of the published build; `ordered` by account, centre and period."""
    rows = published(spark, warehouse, "agg_monthly_balance").select("account_code", "cost_center_code", "accounting_period", F.col("balance_as_restated").alias("balance"))
    return rows.orderBy("account_code", "cost_center_code", "accounting_period") if ordered else rows


def replace_flags(flags: DataFrame, warehouse: str, periods: list[str], family: str) -> None:
    """Put the flags of the judged periods in place, all in one change; a judged period without flags is emptied."""
    if periods:
        kept = flags.where(F.col("accounting_period").isin(*periods) & (F.col("model_family") == family))
        parts.replace(kept, f"{warehouse}/anomaly_flag", ("model_family", "accounting_period"), [f"{family}/{p}" for p in periods])


def read_flags(spark: SparkSession, warehouse: str) -> DataFrame | None:
    """All flags in place; None if nothing has been judged."""
    base = f"{warehouse}/anomaly_flag"
    found = []
    for part, folder in parts.held(spark, base).items():
        family, _, period = part.partition("/")
        found.append((family, period, f"{base}/{folder}"))
    out = None
    for family, period, path in found:
        rows = spark.read.parquet(path).withColumns({"model_family": F.lit(family), "accounting_period": F.lit(period)})
        out = rows if out is None else out.unionByName(rows)
    return out


#: Source table of a dimension -> its model, its key there, and the column of the facts that refers to it.
DIMENSIONS = {"dim_account_src": ("dim_account", "account_code", "account_code"), "dim_cost_center_src": ("dim_cost_center", "cc_code", "cost_center_code"), "fx_rate": ("dim_fx_rate", "currency", "currency")}


def owed_by_versions(spark: SparkSession, warehouse: str, versions: DataFrame) -> list[str]:
    """The periods in which published entries fall under new versions (table, key, effective_date) of a dimension.

    A version that changes nothing has collapsed into the one before it and owes none.
    """
    used = ["accounting_date", "accounting_period", *{c for _, _, c in DIMENSIONS.values()}]
    facts = published(spark, warehouse, "fct_gl_entry").select(*used).unionByName(published(spark, warehouse, "fct_gl_adjustment").select(*used))
    found = None
    for table, (model, key, column) in DIMENSIONS.items():
        new = versions.where(F.col("table") == table).select(F.col("key")[0].alias(key), F.col("effective_date").cast("date").alias("valid_from"))
        rows = published(spark, warehouse, model).join(new, [key, "valid_from"], "left_semi")
        own = periods_of_versions(facts, rows, {column: key})
        found = own if found is None else found.unionByName(own)
    return sorted(r[0] for r in found.distinct().collect())  # months


def periods_of_versions(entries: DataFrame, versions: DataFrame, keys: dict[str, str]) -> DataFrame:
    """The periods in which entries fall under new dimension versions: what a change of a dimension owes.

    versions has the dimension's key columns, valid_from and valid_to; keys maps entry columns to them.
    """
    days = entries.select(*keys, "accounting_date", "accounting_period").distinct()
    return asof_join(days, versions, keys, "accounting_date").select("accounting_period").distinct()
