"""The ledger operators on the star-schema test tables, each with its DuckDB equivalent.

The tables are read through a ledger lens: a line item is a journal line (debit if its number is
odd), its order's customer gives the centre, its flags the account, its order's priority the
currency. Money is decimal inside and double in the results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstone.functions import core
from quillstone.operators import features, gates, ledger, quantile
from quillstone.operators.merge import changed_keys, latest_by_order, merge_rows, moved_keys
from quillstone.operators.scd2 import asof_join, renamed, scd2
from quillstone.operators.validate import duplicate_keys, exactly_one_nonzero, not_after, value_findings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    return df.select(*columns) if columns else df


def _d(name: str):
    return F.col(name).cast("double").alias(name)


# ---- the lens ----

ENTRY_SQL = """
entry AS (
  SELECT l_orderkey AS doc_id, l_linenumber, CAST(l_shipdate AS DATE) AS accounting_date, l_returnflag || l_linestatus AS account_code, CAST(c_nationkey AS VARCHAR) AS cost_center_code,
    o_orderpriority AS currency, o_custkey, CAST(o_orderdate AS DATE) AS posted_at, l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m') AS accounting_period,
    CASE WHEN l_returnflag = 'A' THEN 'asset' WHEN l_returnflag = 'N' THEN 'revenue' WHEN l_linenumber % 3 = 0 THEN 'expense' ELSE 'liability' END AS account_type,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'correction' WHEN l_returnflag = 'R' THEN 'restatement' END AS adjustment_type,
    CASE WHEN l_linenumber % 2 = 1 THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS amount_dr,
    CASE WHEN l_linenumber % 2 = 1 THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS amount_cr
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""


def entry_lens(spark: SparkSession, sf: str) -> DataFrame:
    lines = _t(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag", "l_linestatus", "l_extendedprice")
    orders = _t(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    customers = _t(spark, sf, "customer", "c_custkey", "c_nationkey")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customers, F.col("o_custkey") == F.col("c_custkey"))
    money, odd, none = F.col("l_extendedprice").cast("decimal(18,2)"), F.col("l_linenumber") % 2 == 1, F.lit(0).cast("decimal(18,2)")
    flag = F.col("l_returnflag")
    return joined.select(
        F.col("l_orderkey").alias("doc_id"), "l_linenumber", F.col("l_shipdate").cast("date").alias("accounting_date"), F.concat("l_returnflag", "l_linestatus").alias("account_code"),
        F.col("c_nationkey").cast("string").alias("cost_center_code"), F.col("o_orderpriority").alias("currency"), "o_custkey", F.col("o_orderdate").cast("date").alias("posted_at"), "l_returnflag", "l_linestatus",
        F.date_format("l_shipdate", "yyyy-MM").alias("accounting_period"),
        F.when(flag == "A", "asset").when(flag == "N", "revenue").when(F.col("l_linenumber") % 3 == 0, "expense").otherwise("liability").alias("account_type"),
        F.when((flag == "R") & (F.col("l_linestatus") == "O"), "correction").when(flag == "R", "restatement").alias("adjustment_type"),
        F.when(odd, money).otherwise(none).alias("amount_dr"), F.when(odd, none).otherwise(money).alias("amount_cr"),
    )


RENDER = "CAST(length({0}) AS VARCHAR) || ':' || {0}"
CUST_SQL = f"""
src AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS eff, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus, arg_max(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY 1, 2),
prints AS (SELECT *, sha256({RENDER.format("o_orderstatus")} || chr(31) || {RENDER.format("o_orderpriority")}) AS f FROM src),
marked AS (SELECT *, lag(f) OVER (PARTITION BY o_custkey ORDER BY eff) AS b FROM prints),
kept AS (SELECT *, lead(eff) OVER (PARTITION BY o_custkey ORDER BY eff) AS nxt FROM marked WHERE b IS NULL OR b <> f),
dim_cust AS (SELECT sha256({RENDER.format("CAST(o_custkey AS VARCHAR)")} || chr(31) || {RENDER.format("strftime(eff, '%Y-%m-%d')")}) AS surrogate_key, o_custkey, o_orderstatus, o_orderpriority,
  eff AS valid_from, CAST(coalesce(nxt - INTERVAL 1 DAY, DATE '9999-12-31') AS DATE) AS valid_to, nxt IS NULL AS is_current FROM kept)"""
RATE_SQL = """
rsrc AS (SELECT o_orderpriority AS currency, CAST(o_orderdate AS DATE) AS rate_date, CAST(max(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,6)) AS rate_to_base FROM orders GROUP BY 1, 2),
rmarked AS (SELECT *, lag(rate_to_base) OVER (PARTITION BY currency ORDER BY rate_date) AS b FROM rsrc),
rkept AS (SELECT *, lead(rate_date) OVER (PARTITION BY currency ORDER BY rate_date) AS nxt FROM rmarked WHERE b IS NULL OR b <> rate_to_base),
rate AS (SELECT currency, rate_to_base, rate_date AS valid_from, CAST(coalesce(nxt - INTERVAL 1 DAY, DATE '9999-12-31') AS DATE) AS valid_to, nxt IS NULL AS is_current FROM rkept)"""


def customer_source(spark: SparkSession, sf: str) -> DataFrame:
    orders = _t(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    latest = lambda c: F.max_by(c, "o_orderkey").alias(c)
    return orders.groupBy("o_custkey", F.col("o_orderdate").cast("date").alias("eff")).agg(latest("o_orderstatus"), latest("o_orderpriority"))


def dim_cust(spark: SparkSession, sf: str) -> DataFrame:
    return scd2(customer_source(spark, sf), ["o_custkey"], ["o_orderstatus", "o_orderpriority"], "eff")


def rate_lens(spark: SparkSession, sf: str) -> DataFrame:
    orders = _t(spark, sf, "orders", "o_orderdate", "o_totalprice", "o_orderpriority")
    source = orders.groupBy(F.col("o_orderpriority").alias("currency"), F.col("o_orderdate").cast("date").alias("rate_date")).agg(F.max(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(18,6)").alias("rate_to_base"))
    return scd2(source, ["currency"], ["rate_to_base"], "rate_date")


# ---- projections, filters, functions ----


@query("SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS shipped, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS price FROM lineitem")
def scan_project_cast(spark, sf):
    return _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("shipped"), F.col("l_extendedprice").cast("decimal(18,2)").cast("double").alias("price"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus IN ('O', 'F') AND NOT l_quantity BETWEEN 10 AND 40")
def filter_predicates(spark, sf):
    rows = _t(spark, sf, "lineitem").where((F.col("l_returnflag") == "R") & F.col("l_linestatus").isin("O", "F") & ~F.col("l_quantity").between(10, 40))
    return rows.select("l_orderkey", "l_linenumber")


@query("SELECT o_orderkey, nullif(o_orderstatus, 'O') AS status, coalesce(nullif(o_orderstatus, 'O'), 'open') AS shown, CASE WHEN o_totalprice > 250000 THEN 'high' WHEN o_totalprice > 100000 THEN 'mid' ELSE 'low' END AS band FROM orders")
def nullif_coalesce_case(spark, sf):
    status, price = F.nullif(F.col("o_orderstatus"), F.lit("O")), F.col("o_totalprice")
    return _t(spark, sf, "orders").select("o_orderkey", status.alias("status"), F.coalesce(status, F.lit("open")).alias("shown"), F.when(price > 250000, "high").when(price > 100000, "mid").otherwise("low").alias("band"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS period, CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS month_end, CAST(CAST(o_orderdate AS DATE) - INTERVAL 7 DAY AS DATE) AS bound, CAST(CAST(o_orderdate AS DATE) + INTERVAL 12 MONTH AS DATE) AS year_on FROM orders")
def period_functions(spark, sf):
    day = F.col("o_orderdate").cast("date")
    period = core.period_of(day)
    return _t(spark, sf, "orders").select("o_orderkey", period.alias("period"), core.period_end(period).alias("month_end"), F.date_sub(day, 7).alias("bound"), F.add_months(day, 12).alias("year_on"))


@query(f"SELECT n_nationkey, {RENDER.format('n_name')} || chr(31) || {RENDER.format('CAST(n_regionkey AS VARCHAR)')} AS rendered FROM nation")
def injective_rendering(spark, sf):
    return _t(spark, sf, "nation").select("n_nationkey", core.rendered([F.col("n_name"), F.col("n_regionkey")]).alias("rendered"))


# ---- effective-dated dimensions and joins ----


@query(f"WITH {CUST_SQL} SELECT o_custkey, o_orderstatus, o_orderpriority, valid_from, valid_to, is_current FROM dim_cust")
def scd2_customer(spark, sf):
    return dim_cust(spark, sf).drop("surrogate_key")


@query(f"WITH {CUST_SQL} SELECT o_custkey, count(*) AS n_versions, sum(CASE WHEN is_current THEN 1 ELSE 0 END) AS n_current FROM dim_cust GROUP BY 1")
def scd2_collapse(spark, sf):
    return dim_cust(spark, sf).groupBy("o_custkey").agg(F.count("*").alias("n_versions"), F.sum(F.col("is_current").cast("long")).alias("n_current"))


@query(f"WITH {RATE_SQL} SELECT currency, CAST(rate_to_base AS DOUBLE) AS rate_to_base, valid_from, valid_to, is_current FROM rate")
def scd2_rate(spark, sf):
    return rate_lens(spark, sf).select("currency", _d("rate_to_base"), "valid_from", "valid_to", "is_current")


@query(f"WITH {CUST_SQL} SELECT surrogate_key, o_custkey, valid_from FROM dim_cust")
def surrogate_key_sha256(spark, sf):
    return dim_cust(spark, sf).select("surrogate_key", "o_custkey", "valid_from")


@query(f"WITH {ENTRY_SQL}, {CUST_SQL} SELECT doc_id, l_linenumber, accounting_date, e.o_custkey, o_orderstatus, valid_from FROM entry e JOIN dim_cust d ON e.o_custkey = d.o_custkey AND accounting_date BETWEEN valid_from AND valid_to")
def asof_join_inner(spark, sf):
    joined = asof_join(entry_lens(spark, sf), dim_cust(spark, sf), {"o_custkey": "o_custkey"}, "accounting_date")
    return renamed(joined, o_orderstatus="o_orderstatus", valid_from="valid_from").select("doc_id", "l_linenumber", "accounting_date", "o_custkey", "o_orderstatus", "valid_from")


@query(f"WITH {ENTRY_SQL}, {CUST_SQL} SELECT doc_id, l_linenumber, o_orderstatus FROM entry e JOIN dim_cust d ON e.o_custkey = d.o_custkey AND accounting_date BETWEEN valid_from AND valid_to")
def asof_join_by_month(spark, sf):
    """The same join by months, as for a dimension too large to broadcast."""
    joined = asof_join(entry_lens(spark, sf), dim_cust(spark, sf), {"o_custkey": "o_custkey"}, "accounting_date", strategy="months")
    return renamed(joined, o_orderstatus="o_orderstatus").select("doc_id", "l_linenumber", "o_orderstatus")


THREE_SQL = f"""{ENTRY_SQL}, {CUST_SQL}, {RATE_SQL},
three AS (SELECT e.*, d.o_orderstatus, r.rate_to_base, n_name FROM entry e JOIN dim_cust d ON e.o_custkey = d.o_custkey AND accounting_date BETWEEN d.valid_from AND d.valid_to
  JOIN rate r ON e.currency = r.currency AND accounting_date BETWEEN r.valid_from AND r.valid_to LEFT JOIN nation ON cost_center_code = CAST(n_nationkey AS VARCHAR) AND n_regionkey < 3)"""


def three_way(spark, sf):
    lines = renamed(asof_join(entry_lens(spark, sf), dim_cust(spark, sf), {"o_custkey": "o_custkey"}, "accounting_date"), o_orderstatus="o_orderstatus")
    return renamed(asof_join(lines, rate_lens(spark, sf), {"currency": "currency"}, "accounting_date"), rate_to_base="rate_to_base")


@query(f"WITH {THREE_SQL} SELECT doc_id, l_linenumber, o_orderstatus, CAST(rate_to_base AS DOUBLE) AS rate_to_base, n_name FROM three")
def asof_join_three_way(spark, sf):
    nations = _t(spark, sf, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").cast("string").alias("cost_center_code"), "n_name")
    return three_way(spark, sf).join(nations, "cost_center_code", "left").select("doc_id", "l_linenumber", "o_orderstatus", _d("rate_to_base"), "n_name")


@query(f"WITH {THREE_SQL} SELECT doc_id, l_linenumber, CAST(round(CAST(amount_dr AS DECIMAL(20,2)) * rate_to_base, 2) AS DOUBLE) AS amount_dr_base, CAST(round(CAST(amount_cr AS DECIMAL(20,2)) * rate_to_base, 2) AS DOUBLE) AS amount_cr_base FROM three")
def base_amount_rounded(spark, sf):
    rate = F.col("rate_to_base")
    return three_way(spark, sf).select("doc_id", "l_linenumber", *[ledger.base_amount(F.col(f"amount_{s}"), rate).cast("double").alias(f"amount_{s}_base") for s in ("dr", "cr")])


PERIODS_SQL = f"""{CUST_SQL}, ends AS (SELECT DISTINCT o_custkey, CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS period_end FROM orders
UNION SELECT c_custkey, DATE '1990-01-31' FROM customer)"""


@query(f"WITH {PERIODS_SQL} SELECT e.o_custkey, period_end, o_orderstatus FROM ends e LEFT JOIN dim_cust d ON e.o_custkey = d.o_custkey AND period_end BETWEEN valid_from AND valid_to")
def asof_join_left_period_end(spark, sf):
    ends = _t(spark, sf, "orders").select("o_custkey", F.last_day("o_orderdate").alias("period_end"))
    early = _t(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.lit("1990-01-31").cast("date").alias("period_end"))
    joined = asof_join(ends.unionByName(early).distinct(), dim_cust(spark, sf), {"o_custkey": "o_custkey"}, "period_end", "left")
    return renamed(joined, o_orderstatus="o_orderstatus").select("o_custkey", "period_end", "o_orderstatus")


@query("SELECT c_custkey, n_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey = 1) ON c_nationkey = n_nationkey")
def left_join_optional(spark, sf):
    nations = _t(spark, sf, "nation").where("n_regionkey = 1").select("n_nationkey", "n_name")
    return _t(spark, sf, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", "n_name")


@query("SELECT c_custkey FROM customer WHERE c_nationkey IS NOT NULL AND c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def anti_join_orphans(spark, sf):
    return gates.orphans(_t(spark, sf, "customer", "c_custkey", "c_nationkey"), "c_nationkey", _t(spark, sf, "nation").where("n_regionkey = 1"), "n_nationkey").select("c_custkey")


RAW_SQL = """
raw AS (SELECT o_orderkey AS k, strftime(o_orderdate, '%Y-%m') AS period, o_orderstatus AS v FROM orders WHERE o_orderkey % 10 < 8),
batch AS (SELECT o_orderkey AS k, strftime(o_orderdate + CASE WHEN o_orderkey % 7 = 0 THEN INTERVAL 1 MONTH ELSE INTERVAL 0 MONTH END, '%Y-%m') AS period,
  CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS v FROM orders WHERE o_orderkey % 10 >= 4)"""


def raw_and_batch(spark, sf):
    orders = _t(spark, sf, "orders", "o_orderkey", "o_orderdate", "o_orderstatus")
    key = F.col("o_orderkey")
    raw = orders.where(key % 10 < 8).select(key.alias("k"), F.date_format("o_orderdate", "yyyy-MM").alias("period"), F.col("o_orderstatus").alias("v"))
    when = F.when(key % 7 == 0, F.add_months("o_orderdate", 1)).otherwise(F.col("o_orderdate").cast("date"))
    batch = orders.where(key % 10 >= 4).select(key.alias("k"), F.date_format(when, "yyyy-MM").alias("period"), F.when(key % 5 == 0, "X").otherwise(F.col("o_orderstatus")).alias("v"))
    return raw, batch


@query(f"WITH {RAW_SQL} SELECT r.k, r.period AS old_period, b.period AS new_period FROM raw r JOIN batch b ON r.k = b.k WHERE r.period <> b.period")
def semi_join_moved_keys(spark, sf):
    return moved_keys(*raw_and_batch(spark, sf), ["k"], "period")


@query(f"WITH {RAW_SQL} SELECT coalesce(b.k, r.k) AS k, CASE WHEN b.k IS NOT NULL THEN b.period ELSE r.period END AS period, CASE WHEN b.k IS NOT NULL THEN b.v ELSE r.v END AS v FROM raw r FULL OUTER JOIN batch b ON r.k = b.k")
def upsert_full_outer(spark, sf):
    return merge_rows(*raw_and_batch(spark, sf), ["k"])


@query(f"WITH {RAW_SQL} SELECT coalesce(b.k, r.k) AS k, CASE WHEN b.k IS NULL THEN 'kept' WHEN r.k IS NULL THEN 'inserted' WHEN r.period <> b.period OR r.v <> b.v THEN 'updated' ELSE 'same' END AS outcome FROM raw r FULL OUTER JOIN batch b ON r.k = b.k")
def merge_incremental(spark, sf):
    return changed_keys(*raw_and_batch(spark, sf), ["k"], ["period", "v"])


@query(f"WITH {RAW_SQL} SELECT r.period, count(*) AS n_evicted FROM raw r JOIN batch b ON r.k = b.k WHERE r.period <> b.period GROUP BY 1")
def evict_moved(spark, sf):
    return semi_join_moved_keys(spark, sf).groupBy(F.col("old_period").alias("period")).agg(F.count("*").alias("n_evicted"))


@query(f"WITH {RAW_SQL} SELECT r.k FROM raw r JOIN batch b ON r.k = b.k WHERE r.v <> b.v")
def immutable_violation(spark, sf):
    raw, batch = raw_and_batch(spark, sf)
    return changed_keys(raw, batch, ["k"], ["v"]).where("outcome = 'updated'").select("k")


@query(f"""WITH {RAW_SQL}, dirty AS (SELECT b.period FROM batch b LEFT JOIN raw r ON r.k = b.k WHERE r.k IS NULL OR r.period <> b.period OR r.v <> b.v UNION SELECT r.period FROM raw r JOIN batch b ON r.k = b.k WHERE r.period <> b.period),
reach AS (SELECT DISTINCT strftime(CAST(period || '-01' AS DATE) + to_months(CAST(s AS INTEGER)), '%Y-%m') AS period FROM dirty, (SELECT unnest([0, 1, 2, 12]) AS s))
SELECT period FROM reach WHERE period <= (SELECT max(period) FROM dirty)""")
def dirty_closure(spark, sf):
    raw, batch = raw_and_batch(spark, sf)
    outcome = changed_keys(raw, batch, ["k"], ["period", "v"]).where("outcome in ('inserted', 'updated')")
    dirty = batch.join(outcome, "k", "left_semi").select("period").union(moved_keys(raw, batch, ["k"], "period").select("old_period")).distinct()
    steps = F.array(*[F.lit(s) for s in sorted(core.Windows().reach())])
    month = F.add_months(core.period_start(F.col("period")), F.col("s"))
    reach = dirty.select("period", F.explode(steps).alias("s")).select(core.period_of(month).alias("period")).distinct()
    return reach.join(dirty.agg(F.max("period").alias("last")), F.col("period") <= F.col("last")).select("period")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE CAST(l_shipdate AS DATE) >= (SELECT CAST(max(CAST(l_shipdate AS DATE)) - INTERVAL 7 DAY AS DATE) FROM lineitem)")
def watermark_window(spark, sf):
    lines = _t(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_shipdate")
    bound = lines.agg(F.date_sub(F.max("l_shipdate").cast("date"), 7)).first()[0]
    return lines.where(F.col("l_shipdate").cast("date") >= F.lit(bound)).select("l_orderkey", "l_linenumber")


@query("SELECT p_brand, period FROM (SELECT DISTINCT p_brand FROM part), (SELECT strftime(unnest(generate_series(DATE '1995-01-01', DATE '1995-12-01', INTERVAL 1 MONTH)), '%Y-%m') AS period)")
def cross_join_grid(spark, sf):
    months = spark.range(1).select(F.explode(F.sequence(F.lit("1995-01-01").cast("date"), F.lit("1995-12-01").cast("date"), F.expr("interval 1 month"))).alias("m")).select(core.period_of(F.col("m")).alias("period"))
    return _t(spark, sf, "part", "p_brand").distinct().crossJoin(F.broadcast(months))


# ---- aggregation, windows, sets ----


@query(f"WITH {ENTRY_SQL} SELECT account_code, cost_center_code, accounting_period, CAST(sum(amount_dr) AS DOUBLE) AS debit_total, CAST(sum(amount_cr) AS DOUBLE) AS credit_total FROM entry GROUP BY ALL")
def group_sum_period(spark, sf):
    return entry_lens(spark, sf).groupBy("account_code", "cost_center_code", "accounting_period").agg(F.sum("amount_dr").cast("double").alias("debit_total"), F.sum("amount_cr").cast("double").alias("credit_total"))


@query(f"WITH {ENTRY_SQL} SELECT account_code, accounting_period, arg_max(account_type, (accounting_date, account_type)) AS closing_type FROM entry GROUP BY ALL")
def max_by_closing_type(spark, sf):
    return entry_lens(spark, sf).groupBy("account_code", "accounting_period").agg(ledger.closing_type(F.col("accounting_date"), F.col("account_type")).alias("closing_type"))


@query(f"WITH {ENTRY_SQL} SELECT account_code, cost_center_code FROM entry WHERE adjustment_type IS NULL UNION SELECT account_code, cost_center_code FROM entry WHERE adjustment_type IS NOT NULL")
def distinct_identity(spark, sf):
    return entry_lens(spark, sf).select("account_code", "cost_center_code").distinct()


@query(f"WITH {ENTRY_SQL} SELECT min(accounting_period) AS first_period, max(accounting_period) AS last_period FROM entry")
def min_max_span(spark, sf):
    return entry_lens(spark, sf).agg(F.min("accounting_period").alias("first_period"), F.max("accounting_period").alias("last_period"))


@query(f"WITH {ENTRY_SQL} SELECT doc_id, CAST(sum(amount_dr) AS DOUBLE) AS debit, CAST(sum(amount_cr) AS DOUBLE) AS credit FROM entry GROUP BY 1 HAVING sum(amount_dr) <> sum(amount_cr)")
def voucher_balance(spark, sf):
    return gates.unbalanced(entry_lens(spark, sf), "doc_id", "amount_dr", "amount_cr").select("doc_id", _d("debit"), _d("credit"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def having_count(spark, sf):
    return gates.not_unique(_t(spark, sf, "lineitem", "l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])


@query("SELECT c_nationkey, quantile_cont(c_acctbal, 0.5) AS median FROM customer GROUP BY 1")
def percentile_median(spark, sf):
    return _t(spark, sf, "customer").groupBy("c_nationkey").agg(F.expr("percentile(c_acctbal, 0.5)").alias("median"))


@query("SELECT quantile_cont(m, 1.0 / 3) AS low, quantile_cont(m, 2.0 / 3) AS high FROM (SELECT c_nationkey, quantile_cont(c_acctbal, 0.5) AS m FROM customer GROUP BY 1)")
def terciles(spark, sf):
    middle = percentile_median(spark, sf)
    return middle.agg(F.expr("percentile(median, 1D/3)").alias("low"), F.expr("percentile(median, 2D/3)").alias("high"))


SERIES_SQL = f"{ENTRY_SQL}, series AS (SELECT account_code, accounting_period, sum(amount_dr) - sum(amount_cr) AS balance FROM entry GROUP BY ALL)"


def series(spark, sf):
    return entry_lens(spark, sf).groupBy("account_code", "accounting_period").agg((F.sum("amount_dr") - F.sum("amount_cr")).alias("balance"))


def by_account():
    return Window.partitionBy("account_code").orderBy("accounting_period")


@query(f"WITH {SERIES_SQL} SELECT account_code, accounting_period, CAST(lag(balance, 1) OVER w AS DOUBLE) AS mom, CAST(lag(balance, 12) OVER w AS DOUBLE) AS yoy FROM series WINDOW w AS (PARTITION BY account_code ORDER BY accounting_period)")
def mom_yoy_lag(spark, sf):
    return series(spark, sf).select("account_code", "accounting_period", F.lag("balance", 1).over(by_account()).cast("double").alias("mom"), F.lag("balance", 12).over(by_account()).cast("double").alias("yoy"))


# Half-up rounding in whole cents, as DuckDB's decimal division is binary.
ROLL_SQL = f"{SERIES_SQL}, rolled AS (SELECT account_code, accounting_period, CAST(sum(balance) OVER w * 100 AS HUGEINT) AS c, count(balance) OVER w AS n FROM series WINDOW w AS (PARTITION BY account_code ORDER BY accounting_period ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))"


@query(f"WITH {ROLL_SQL} SELECT account_code, accounting_period, CAST(sign(c) * ((2 * abs(c) + n) // (2 * n)) AS DOUBLE) / 100.0 AS rolling FROM rolled")
def rolling_mean_3(spark, sf):
    w = by_account().rowsBetween(-2, 0)
    return series(spark, sf).select("account_code", "accounting_period", F.round(F.avg("balance").over(w), 2).cast("double").alias("rolling"))


@query(f"WITH {SERIES_SQL} SELECT account_code, accounting_period, CAST(count(balance) OVER (PARTITION BY account_code ORDER BY accounting_period ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS INTEGER) AS n FROM series")
def rolling_count_3(spark, sf):
    return series(spark, sf).select("account_code", "accounting_period", F.count("balance").over(by_account().rowsBetween(-2, 0)).cast("int").alias("n"))


@query("SELECT o_custkey, o_orderkey, last_value(nullif(o_orderstatus, 'O') IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS before, first_value(nullif(o_orderstatus, 'O') IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after FROM orders")
def carry_forward_type(spark, sf):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    status = F.nullif(F.col("o_orderstatus"), F.lit("O"))
    back, ahead = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    return _t(spark, sf, "orders").select("o_custkey", "o_orderkey", F.last(status, True).over(back).alias("before"), F.first(status, True).over(ahead).alias("after"))


@query("SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS INTEGER) AS recency FROM orders")
def row_number_recency(spark, sf):
    return _t(spark, sf, "orders").select("o_custkey", "o_orderkey", F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey"))).alias("recency"))


@query(f"WITH {CUST_SQL} SELECT o_custkey, valid_from, lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from) AS next_from FROM dim_cust")
def lead_intervals(spark, sf):
    return dim_cust(spark, sf).select("o_custkey", "valid_from", F.lead("valid_from").over(Window.partitionBy("o_custkey").orderBy("valid_from")).alias("next_from"))


@query("SELECT n_regionkey AS k FROM nation UNION SELECT r_regionkey FROM region")
def union_distinct(spark, sf):
    return _t(spark, sf, "nation").select(F.col("n_regionkey").alias("k")).unionByName(_t(spark, sf, "region").select(F.col("r_regionkey").alias("k"))).distinct()


@query("SELECT n_regionkey AS k FROM nation UNION ALL SELECT r_regionkey FROM region")
def union_all(spark, sf):
    return _t(spark, sf, "nation").select(F.col("n_regionkey").alias("k")).unionByName(_t(spark, sf, "region").select(F.col("r_regionkey").alias("k")))


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r <= 5")
def topk_recent(spark, sf):
    return row_number_recency(spark, sf).where("recency <= 5").select("o_custkey", "o_orderkey")


@query("SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY 1")
def dedup_last(spark, sf):
    return latest_by_order(_t(spark, sf, "orders", "o_custkey", "o_orderdate", "o_orderkey"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


# ---- the balance ----

GRAIN = "account_code, cost_center_code, accounting_period"
BALANCE_SQL = f"""{ENTRY_SQL},
reported AS (SELECT * FROM entry WHERE adjustment_type IS NULL OR adjustment_type = 'correction'),
posted AS (SELECT {GRAIN}, sum(amount_dr) AS dr, sum(amount_cr) AS cr, arg_max(account_type, (accounting_date, account_type)) AS closing FROM reported GROUP BY ALL),
restated AS (SELECT {GRAIN}, sum(amount_dr) AS rdr, sum(amount_cr) AS rcr FROM entry WHERE adjustment_type = 'restatement' GROUP BY ALL),
pairs AS (SELECT DISTINCT account_code, cost_center_code FROM entry),
months AS (SELECT strftime(unnest(generate_series(CAST(min(accounting_period) || '-01' AS DATE), CAST(max(accounting_period) || '-01' AS DATE), INTERVAL 1 MONTH)), '%Y-%m') AS accounting_period FROM entry),
dense AS (SELECT account_code, cost_center_code, accounting_period, coalesce(dr, 0) AS dr, coalesce(cr, 0) AS cr, coalesce(rdr, 0) AS rdr, coalesce(rcr, 0) AS rcr,
  coalesce(last_value(closing IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(closing IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS account_type
  FROM pairs CROSS JOIN months LEFT JOIN posted USING ({GRAIN}) LEFT JOIN restated USING ({GRAIN}) WINDOW w AS (PARTITION BY account_code, cost_center_code ORDER BY accounting_period)),
based AS (SELECT *, CASE WHEN account_type IN ('asset', 'expense') THEN dr - cr ELSE cr - dr END AS reported, CASE WHEN account_type IN ('asset', 'expense') THEN rdr - rcr ELSE rcr - rdr END AS delta FROM dense),
bridged AS (SELECT *, reported + delta AS restated FROM based),
compared AS (SELECT *, lag(restated, 1) OVER w AS mom, lag(restated, 12) OVER w AS yoy, sum(restated) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rsum, count(restated) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rn
  FROM bridged WINDOW w AS (PARTITION BY account_code, cost_center_code ORDER BY accounting_period))"""


def balance(spark, sf):
    lines = entry_lens(spark, sf).withColumnsRenamed({"amount_dr": "amount_dr_base", "amount_cr": "amount_cr_base"})
    return ledger.monthly_balance(lines.where("adjustment_type is null"), lines.where("adjustment_type is not null"))


@query(f"""WITH {BALANCE_SQL} SELECT {GRAIN}, account_type, CAST(dr AS DOUBLE) AS debit_total, CAST(cr AS DOUBLE) AS credit_total, CAST(reported AS DOUBLE) AS balance_as_reported, CAST(delta AS DOUBLE) AS restatement_delta,
CAST(restated AS DOUBLE) AS balance_as_restated, CAST(restated - mom AS DOUBLE) AS balance_delta_mom, CAST(restated - yoy AS DOUBLE) AS balance_delta_yoy,
CASE WHEN mom <> 0 THEN round(CAST(restated - mom AS DOUBLE) / abs(CAST(mom AS DOUBLE)), 4) + 0.0 END AS balance_pct_mom, CAST(rn AS INTEGER) AS rolling_periods FROM compared""")
def monthly_balance(spark, sf):
    """The flagship: a dense, signed balance on both bases with its comparisons."""
    money = ("debit_total", "credit_total", "balance_as_reported", "restatement_delta", "balance_as_restated", "balance_delta_mom", "balance_delta_yoy")
    before = F.col("balance_as_restated") - F.col("balance_delta_mom")
    pct = F.when(F.col("balance_pct_mom").isNotNull(), F.round(F.col("balance_delta_mom").cast("double") / F.abs(before.cast("double")), 4) + F.lit(0.0)).alias("balance_pct_mom")
    return balance(spark, sf).select("account_code", "cost_center_code", "accounting_period", "account_type", *map(_d, money), pct, "rolling_periods")


@query(f"WITH {BALANCE_SQL} SELECT {GRAIN}, CAST(restated AS DOUBLE) AS balance FROM compared")
def dense_grid_series(spark, sf):
    return balance(spark, sf).select("account_code", "cost_center_code", "accounting_period", F.col("balance_as_restated").cast("double").alias("balance"))


@query(f"WITH {BALANCE_SQL} SELECT accounting_period, CAST(sum(reported) AS DOUBLE) AS reported, CAST(sum(delta) AS DOUBLE) AS delta, CAST(sum(restated) AS DOUBLE) AS restated FROM compared GROUP BY 1")
def two_bases_bridge(spark, sf):
    names = {"reported": "balance_as_reported", "delta": "restatement_delta", "restated": "balance_as_restated"}
    return balance(spark, sf).groupBy("accounting_period").agg(*[F.sum(c).cast("double").alias(n) for n, c in names.items()])


# ---- gates and contracts ----


@query("SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, count(*) AS n_rows FROM orders GROUP BY 1, 2 HAVING count(*) > 1")
def gate_unique(spark, sf):
    return gates.not_unique(_t(spark, sf, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("day")), ["o_custkey", "day"])


@query("SELECT o_orderkey FROM orders WHERE nullif(o_orderstatus, 'P') IS NULL")
def gate_not_null(spark, sf):
    orders = _t(spark, sf, "orders", "o_orderkey", "o_orderstatus").withColumn("status", F.nullif(F.col("o_orderstatus"), F.lit("P")))
    return gates.nulls(orders, "status").select("o_orderkey")


@query("SELECT s_suppkey FROM supplier WHERE s_nationkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM nation WHERE n_nationkey = s_nationkey AND n_regionkey <> 2)")
def gate_relationships(spark, sf):
    return gates.orphans(_t(spark, sf, "supplier"), "s_nationkey", _t(spark, sf, "nation").where("n_regionkey <> 2"), "n_nationkey").select("s_suppkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus NOT IN ('F', 'O')")
def gate_accepted_values(spark, sf):
    return gates.not_accepted(_t(spark, sf, "orders", "o_orderkey", "o_orderstatus"), "o_orderstatus", ["F", "O"]).select("o_orderkey")


@query(f"""WITH {CUST_SQL}, hurt AS (SELECT o_custkey, valid_from, CASE WHEN o_custkey % 11 = 0 THEN CAST(valid_to - INTERVAL 1 DAY AS DATE) WHEN o_custkey % 13 = 0 AND valid_to < DATE '9999-01-01' THEN CAST(valid_to + INTERVAL 1 DAY AS DATE) ELSE valid_to END AS valid_to, is_current AND o_custkey % 17 <> 0 AS is_current FROM dim_cust),
led AS (SELECT *, lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from, valid_to) AS nxt FROM hurt)
SELECT o_custkey, 'inverted' AS problem FROM led WHERE valid_to < valid_from UNION ALL SELECT o_custkey, 'overlap' FROM led WHERE nxt <= valid_to UNION ALL SELECT o_custkey, 'gap' FROM led WHERE nxt > valid_to + INTERVAL 1 DAY
UNION ALL SELECT o_custkey, 'current' FROM hurt GROUP BY 1 HAVING sum(CASE WHEN is_current THEN 1 ELSE 0 END) <> 1""")
def gate_intervals(spark, sf):
    key, end = F.col("o_custkey"), F.col("valid_to")
    hurt = F.when(key % 11 == 0, F.date_sub(end, 1)).when((key % 13 == 0) & (end < F.lit("9999-01-01").cast("date")), F.date_add(end, 1)).otherwise(end)
    dim = dim_cust(spark, sf).withColumns({"valid_to": hurt, "is_current": F.col("is_current") & (key % 17 != 0)})
    return gates.interval_faults(dim, ["o_custkey"])


DRIFT_SQL = """counts AS (SELECT o_orderpriority AS model, strftime(o_orderdate, '%Y-%m') AS build, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS built_at, count(*) AS row_count FROM orders GROUP BY ALL),
now AS (SELECT max(build) AS build FROM counts),
ranked AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY built_at DESC, build DESC) AS r FROM counts WHERE build <> (SELECT build FROM now)),
base AS (SELECT model, quantile_cont(row_count, 0.5) AS baseline, count(*) AS builds FROM ranked WHERE r <= 5 GROUP BY 1 HAVING count(*) >= 5)"""


@query(f"WITH {DRIFT_SQL} SELECT model, row_count, CAST(baseline AS DOUBLE) AS baseline FROM counts JOIN base USING (model) WHERE build = (SELECT build FROM now) AND (baseline = 0 OR NOT row_count BETWEEN baseline * 0.9 AND baseline * 1.1)")
def gate_drift(spark, sf):
    orders = _t(spark, sf, "orders", "o_orderpriority", "o_orderdate")
    counts = orders.groupBy(F.col("o_orderpriority").alias("model"), F.date_format("o_orderdate", "yyyy-MM").alias("invocation_id"), F.date_trunc("month", "o_orderdate").alias("built_at")).agg(F.count("*").alias("row_count"))
    last = orders.agg(F.date_format(F.max("o_orderdate"), "yyyy-MM")).first()[0]
    return gates.drifted(counts, last).select("model", "row_count", _d("baseline"))


@query(f"""WITH {ENTRY_SQL}, {CUST_SQL}, fact AS (SELECT e.* FROM entry e JOIN dim_cust d ON e.o_custkey = d.o_custkey AND accounting_date BETWEEN valid_from AND valid_to)
SELECT 'lineitem' AS source, (SELECT count(*) FROM entry) AS source_lines, (SELECT count(*) FROM fact) AS fact_lines, CAST((SELECT sum(amount_dr) FROM entry) AS DOUBLE) AS source_dr, CAST((SELECT sum(amount_dr) FROM fact) AS DOUBLE) AS fact_dr, 'lines are missing or multiplied' AS problem""")
def gate_attributed(spark, sf):
    entries = entry_lens(spark, sf)
    fact = asof_join(entries, dim_cust(spark, sf), {"o_custkey": "o_custkey"}, "accounting_date")
    return gates.unattributed(entries, fact, "lineitem").select("source", "source_lines", "fact_lines", _d("source_dr"), _d("fact_dr"), "problem")


@query("""SELECT event_id, 'value' AS v, rule FROM (SELECT event_id, unnest([CASE WHEN event_type NOT IN ('view', 'click') THEN 'allowed' END, CASE WHEN value < 20 THEN 'min' END, CASE WHEN event_id % 50 = 0 THEN 'date' END]) AS rule FROM events) WHERE rule IS NOT NULL""")
def contract_values(spark, sf):
    events = _t(spark, sf, "events", "event_id", "event_type", F.col("value").cast("string").alias("value")).withColumn("day", F.when(F.col("event_id") % 50 == 0, "2026-02-30").otherwise("2026-02-28"))
    rules = {"allowed": value_findings("event_type", "string", allowed=["view", "click"]), "min": value_findings("value", "decimal", least="20"), "date": value_findings("day", "date")}
    return events.select("event_id", F.lit("value").alias("v"), F.explode(F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]))).alias("rule"))


@query(f"WITH {ENTRY_SQL} SELECT doc_id, l_linenumber FROM entry WHERE accounting_date < posted_at")
def contract_not_after(spark, sf):
    return entry_lens(spark, sf).where(not_after("posted_at", "accounting_date")).select("doc_id", "l_linenumber")


@query(f"WITH {ENTRY_SQL} SELECT doc_id, l_linenumber FROM entry WHERE (CASE WHEN amount_dr <> 0 THEN 1 ELSE 0 END) + (CASE WHEN amount_cr * (l_linenumber % 4) <> 0 THEN 1 ELSE 0 END) <> 1")
def contract_one_nonzero(spark, sf):
    return entry_lens(spark, sf).withColumn("amount_cr", F.col("amount_cr") * (F.col("l_linenumber") % 4)).where(exactly_one_nonzero(["amount_dr", "amount_cr"])).select("doc_id", "l_linenumber")


@query("SELECT l_orderkey, l_linenumber, count(*) - 1 AS n_repeats FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def contract_duplicate_key(spark, sf):
    repeats = duplicate_keys(_t(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey", "l_linenumber"], ["l_partkey"])
    return repeats.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n_repeats"))


@query(f"SELECT sha256(string_agg(h, '' ORDER BY h)) AS checksum, count(*) AS n_rows FROM (SELECT sha256({RENDER.format('n_name')} || chr(31) || {RENDER.format('CAST(n_nationkey AS VARCHAR)')}) AS h FROM nation)")
def row_checksum_digest(spark, sf):
    from quillstone.sources.raw import checksum

    return checksum(_t(spark, sf, "nation"), ["n_name", "n_nationkey"])


@query()
def row_checksum_rolling(spark, sf):
    """The digest that every task folds, over the largest table. DuckDB has no xxhash64; a test compares with the library."""
    from quillstone.sources.raw import rolling_checksum

    lines = _t(spark, sf, "lineitem")
    return rolling_checksum(lines, lines.columns)


# ---- the anomaly layer ----

PANEL_SQL = f"{BALANCE_SQL}, panel AS (SELECT {GRAIN}, CAST(restated AS DOUBLE) AS balance FROM compared)"


def panel(spark, sf):
    return dense_grid_series(spark, sf)


@query(f"""WITH {PANEL_SQL}, lagged AS (SELECT *, lag(balance, 1) OVER w AS lag_1, lag(balance, 3) OVER w AS lag_3, lag(balance, 12) OVER w AS lag_12, row_number() OVER w AS r FROM panel WINDOW w AS (PARTITION BY account_code, cost_center_code ORDER BY accounting_period))
SELECT {GRAIN}, balance AS actual, lag_1, lag_3, lag_12 FROM lagged WHERE r > 12""")
def lag_features_1_3_12(spark, sf):
    bands = spark.createDataFrame([], "cost_center_code string, size_band double")
    return features.design(panel(spark, sf), bands).select(*features.SERIES, "accounting_period", "actual", "lag_1", "lag_3", "lag_12")


@query(f"""WITH {PANEL_SQL}, mid AS (SELECT cost_center_code, quantile_cont(balance, 0.5) AS m FROM panel GROUP BY 1 HAVING max(CASE WHEN balance <> 0 THEN 1 ELSE 0 END) = 1), cuts AS (SELECT quantile_cont(m, 1.0 / 3) AS a, quantile_cont(m, 2.0 / 3) AS b FROM mid)
SELECT cost_center_code, CASE WHEN m <= a THEN 0.0 WHEN m > b THEN 2.0 ELSE 1.0 END::DOUBLE AS size_band FROM mid, cuts""")
def size_band(spark, sf):
    return features.size_bands(panel(spark, sf))


@query("SELECT o_orderkey, CASE WHEN month(o_orderdate) = 1 THEN 1.0 ELSE 0.0 END::DOUBLE AS month_1, CASE WHEN month(o_orderdate) = 12 THEN 1.0 ELSE 0.0 END::DOUBLE AS month_12 FROM orders")
def month_onehot(spark, sf):
    marks = core.month_flags(F.date_format("o_orderdate", "yyyy-MM"))
    return _t(spark, sf, "orders").select("o_orderkey", marks[0], marks[11])


NAIVE_SQL = f"{PANEL_SQL}, naive AS (SELECT {GRAIN}, balance AS actual, lag(balance, 1) OVER w AS predicted, lag(balance, 1) OVER w - abs(lag(balance, 2) OVER w) AS lower_bound, lag(balance, 1) OVER w + abs(lag(balance, 2) OVER w) AS upper_bound FROM panel WINDOW w AS (PARTITION BY account_code, cost_center_code ORDER BY accounting_period))"


def naive(spark, sf):
    w = Window.partitionBy(*features.SERIES).orderBy("accounting_period")
    last, spread = F.lag("balance", 1).over(w), F.abs(F.lag("balance", 2).over(w))
    return panel(spark, sf).select(*features.SERIES, "accounting_period", F.col("balance").alias("actual"), last.alias("predicted"), (last - spread).alias("lower_bound"), (last + spread).alias("upper_bound"))


@query(f"""WITH {NAIVE_SQL} SELECT accounting_period, round(avg(CASE WHEN actual BETWEEN lower_bound AND upper_bound THEN 1.0 ELSE 0.0 END), 6) AS coverage, round(avg(CASE WHEN actual - predicted > 0 THEN 0.5 * (actual - predicted) ELSE -0.5 * (actual - predicted) END), 2) AS pinball_50 FROM naive WHERE upper_bound IS NOT NULL GROUP BY 1""")
def pinball_scores(spark, sf):
    scores = features.interval_scores(naive(spark, sf).where("upper_bound is not null"), by=["accounting_period"])
    return scores.select("accounting_period", F.round("coverage", 6).alias("coverage"), F.round("pinball_50", 2).alias("pinball_50"))


@query(f"""WITH {NAIVE_SQL} SELECT {GRAIN}, CASE WHEN actual > upper_bound THEN 'above' ELSE 'below' END AS side, round(CASE WHEN actual > upper_bound THEN actual - upper_bound ELSE lower_bound - actual END / (upper_bound - lower_bound), 6) AS score FROM naive WHERE upper_bound > lower_bound AND (actual > upper_bound OR actual < lower_bound)""")
def flag_rule(spark, sf):
    return features.flags(naive(spark, sf)).select(*features.SERIES, "accounting_period", "side", F.round("score", 6).alias("score"))


@query()
def quantile_interval_flags(spark, sf):
    """Flags of the last two periods of the restated balance, by the linear arm."""
    rows = panel(spark, sf)
    last = rows.agg(F.max("accounting_period")).first()[0]
    return quantile.judge_periods(rows, [core.shift(last, -1), last], "testdata")


# ---- predicates over ledgers ----


@query(f"WITH {ENTRY_SQL} SELECT doc_id, l_linenumber FROM entry WHERE posted_at - CAST(date_trunc('month', accounting_date) + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) >= 30")
def late_entries(spark, sf):
    return entry_lens(spark, sf).where(F.datediff("posted_at", F.last_day("accounting_date")) >= 30).select("doc_id", "l_linenumber")


@query(f"WITH {ENTRY_SQL} SELECT account_code FROM entry GROUP BY 1 HAVING count(DISTINCT account_type) > 1")
def attribute_moved(spark, sf):
    return entry_lens(spark, sf).groupBy("account_code").agg(F.count_distinct("account_type").alias("n")).where("n > 1").select("account_code")


GROWTH_SQL = f"""{ENTRY_SQL}, totals AS (SELECT account_code || cost_center_code AS series, accounting_period, sum(amount_dr + amount_cr) AS total FROM entry GROUP BY ALL),
steps AS (SELECT *, CASE WHEN total >= 1.1 * lag(total) OVER w AND accounting_period = strftime(CAST(lag(accounting_period) OVER w || '-01' AS DATE) + INTERVAL 1 MONTH, '%Y-%m') THEN 0 ELSE 1 END AS broken FROM totals WINDOW w AS (PARTITION BY series ORDER BY accounting_period)),
islands AS (SELECT *, sum(broken) OVER (PARTITION BY series ORDER BY accounting_period ROWS UNBOUNDED PRECEDING) AS island FROM steps)"""


@query(f"WITH {GROWTH_SQL} SELECT series, min(accounting_period) AS since, count(*) - 1 AS months FROM islands GROUP BY series, island HAVING count(*) > 3")
def growth_streak(spark, sf):
    from quillstone.operators.predicates import growth_streaks

    totals = entry_lens(spark, sf).groupBy(F.concat("account_code", "cost_center_code").alias("series"), "accounting_period").agg(F.sum(F.col("amount_dr") + F.col("amount_cr")).alias("total"))
    return growth_streaks(totals, "series", "total", ratio="1.1")


@query("SELECT l_suppkey, max(l_extendedprice) AS largest, quantile_cont(l_extendedprice, 0.5) AS middle FROM lineitem GROUP BY 1 HAVING quantile_cont(l_extendedprice, 0.5) > 0 AND max(l_extendedprice) >= 2 * quantile_cont(l_extendedprice, 0.5)")
def amount_outlier(spark, sf):
    from quillstone.operators.predicates import amount_outliers

    return amount_outliers(_t(spark, sf, "lineitem", "l_suppkey", "l_extendedprice"), "l_suppkey", "l_extendedprice", times=2)


@query(f"""WITH {ENTRY_SQL}, sums AS (SELECT accounting_period, CAST(sum(amount_dr + amount_cr) AS DOUBLE) AS total FROM entry GROUP BY 1), tops AS (SELECT accounting_period, CAST(sum(a) AS DOUBLE) AS top FROM (SELECT accounting_period, amount_dr + amount_cr AS a, row_number() OVER (PARTITION BY accounting_period ORDER BY amount_dr + amount_cr DESC) AS r FROM entry) WHERE r <= 20 GROUP BY 1)
SELECT accounting_period, round(total / ((sum(total) OVER () - total) / (count(*) OVER () - 1)), 6) AS raised, round(top / total, 6) AS top_share FROM sums JOIN tops USING (accounting_period)""")
def long_tail(spark, sf):
    from quillstone.operators.predicates import long_tail_shape

    lines = entry_lens(spark, sf).select("accounting_period", (F.col("amount_dr") + F.col("amount_cr")).alias("amount"))
    return long_tail_shape(lines, "accounting_period", "amount").select("accounting_period", F.round("raised", 6).alias("raised"), F.round("top_share", 6).alias("top_share"))


@query("""WITH a AS (SELECT l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS v FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1), b AS (SELECT l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS v FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1)
SELECT a.l_suppkey, round(a.v - coalesce(b.v, 0), 2) AS increase FROM a LEFT JOIN b ON a.l_suppkey = b.l_suppkey WHERE a.v > coalesce(b.v, 0)""")
def vendor_breakdown(spark, sf):
    from quillstone.operators.predicates import increases

    lines = _t(spark, sf, "lineitem", "l_suppkey", "l_linestatus", "l_extendedprice").withColumn("v", F.col("l_extendedprice").cast("decimal(18,2)"))
    return increases(lines.where("l_linestatus = 'O'"), lines.where("l_linestatus = 'F'"), "l_suppkey", "v").select("l_suppkey", F.round(F.col("increase").cast("double"), 2).alias("increase"))


@query(f"WITH {ENTRY_SQL} SELECT account_code, accounting_period, count(*) AS n_lines FROM entry GROUP BY ALL")
def entry_count_stability(spark, sf):
    return entry_lens(spark, sf).groupBy("account_code", "accounting_period").agg(F.count("*").alias("n_lines"))


# ---- extras: event-time windows ----


@query("SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS window_start, event_type, count(*) AS n_events FROM events GROUP BY 1, 2")
def extra_tumbling_window(spark, sf):
    from quillstone.streaming.ingest import windowed_counts

    return windowed_counts(_t(spark, sf, "events", "ts", "event_type"), "ts", "event_type", "1 hour")
