"""The raw layer, the validator, the mart and the run record on the test tables, each with its DuckDB equivalent.

Orders are read as journal lines in the contract's text form; dimension sources are written by rule.
What an operator needs as files goes to a folder of its own in the session's shared folder.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.contracts import all_contracts
from quillstone.functions import core
from quillstone.operators import features, ledger, merge, quantile
from quillstone.operators.predicates import increases, spread_of
from quillstone.operators.validate import finding_rows, validate_table
from quillstone.sources import files, loader, raw
from quillstone.sources.csv_source import METADATA, select_rows
from quillstone.streaming.ingest import merge_stream

from . import mart, runlog
from .queries import NAIVE_SQL, PANEL_SQL, SERIES_SQL, _d, _t, naive, panel, query, series

ENTRY = all_contracts()["gl_entry"]


def scratch(spark: SparkSession, name: str) -> str:
    return f"{files.shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def extract(spark: SparkSession, rows: DataFrame, order: list[str], columns: list[str], table: str = "gl_entry") -> str:
    """Write rows in order as the CSV extract of a table; returns its folder."""
    folder = scratch(spark, "extract")
    rows.orderBy(*order).select(*columns).coalesce(1).write.option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "").csv(f"{folder}/parts")
    part = next(n for n in files.names(spark, f"{folder}/parts") if n.endswith(".csv"))
    files.rename_new(spark, f"{folder}/parts/{part}", f"{folder}/{table}.csv")
    return folder


# ---- orders as journal lines ----

# Expressions that both engines read alike; {0} stands for days added to a date as text.
CURRENCY = "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'CNY' WHEN '2' THEN 'EUR' WHEN '3' THEN 'USD' ELSE 'GBP' END"
PRICE = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS {text})"
LINE = {
    "entry_id": "CAST(o_orderkey AS {text})", "version": "'1'", "accounting_date": "{day}", "posted_at": "{arrival}", "account_code": "concat('60', CAST(o_orderkey % 10 AS {text}))",
    "cost_center_code": "concat('CC-', CAST(o_custkey % 12 AS {text}))", "currency": CURRENCY, "amount_dr": f"CASE WHEN o_orderkey % 2 = 1 THEN {PRICE} ELSE '0.00' END", "amount_cr": f"CASE WHEN o_orderkey % 2 = 1 THEN '0.00' ELSE {PRICE} END",
    "doc_id": "concat('V', CAST(o_custkey AS {text}))", "vendor_code": "CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE concat('S', CAST(o_orderkey % 10 AS {text})) END", "description": "o_orderstatus",
}
SPARK = {"text": "STRING", "day": "date_format(o_orderdate, 'yyyy-MM-dd')", "arrival": "date_format(date_add(o_orderdate, CAST(o_orderkey % 9 AS INT)), 'yyyy-MM-dd')"}
DUCK = {"text": "VARCHAR", "day": "strftime(o_orderdate, '%Y-%m-%d')", "arrival": "strftime(o_orderdate + to_days(CAST(o_orderkey % 9 AS INTEGER)), '%Y-%m-%d')"}
LINES_SQL = f"journal AS (SELECT o_orderkey, {', '.join(f'{e.format(**DUCK)} AS {c}' for c, e in LINE.items())} FROM orders)"


def journal(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "orders").selectExpr("o_orderkey", *[f"{e.format(**SPARK)} AS {c}" for c, e in LINE.items()])


@query(f"WITH {LINES_SQL} SELECT {', '.join(LINE)} FROM journal WHERE posted_at >= '1996-01-01'")
def csv_window_scan(spark, sf):
    """Declared columns of an extract with another column first, from a bound on."""
    folder = extract(spark, journal(spark, sf), ["o_orderkey"], ["o_orderkey", *ENTRY.columns])
    return select_rows(spark, f"{folder}/gl_entry.csv", ENTRY, "1996-01-01").drop("__row")


# ---- the validator ----

# Planted faults, one a row at most: (divisor of the key, name).
FAULTS = ((11, "currency"), (13, "amount"), (17, "early"), (19, "no_id"), (23, "date"), (29, "version"), (31, "scale"), (37, "both"), (41, "whole"), (43, "no_code"))
FAULT = "CASE " + " ".join(f"WHEN o_orderkey % {n} = 0 THEN '{name}'" for n, name in FAULTS) + " ELSE '' END"
FINDINGS = {
    "currency": ("value", "currency"), "amount": ("value", "amount_dr"), "early": ("row_constraint", "not_after"), "no_id": ("null", "entry_id"), "date": ("value", "accounting_date"), "version": ("value", "version"),
    "scale": ("value", "amount_dr"), "both": ("row_constraint", "exactly_one_nonzero"), "whole": ("value", "version"), "no_code": ("null", "account_code"),
}
FAULTY_SQL = f"""hurt AS (SELECT o_orderkey, {FAULT} AS fault, 0 AS again FROM orders UNION ALL SELECT o_orderkey, {FAULT}, 1 FROM orders WHERE o_orderkey % 47 = 0),
numbered AS (SELECT *, row_number() OVER (ORDER BY again, o_orderkey) AS row FROM hurt),
kinds AS (SELECT * FROM (VALUES {', '.join(f"('{f}', '{k}', '{c}')" for f, (k, c) in FINDINGS.items())}) AS v(fault, kind, "column"))"""


def faulty_extract(spark: SparkSession, sf: str) -> str:
    rows = _t(spark, sf, "orders").selectExpr("o_orderkey", "o_orderdate", f"{FAULT} AS fault", *[f"{e.format(**SPARK)} AS {c}" for c, e in LINE.items()])
    when = lambda fault, value, c: F.when(F.col("fault") == fault, value).otherwise(F.col(c))
    key = F.col("o_orderkey").cast("string")
    rows = rows.withColumn("version", F.when(F.col("fault") == "no_id", key).when(F.col("fault") == "version", "0").when(F.col("fault") == "whole", "1.5").otherwise(F.col("version")))
    rows = rows.withColumns({
        "currency": when("currency", "XXX", "currency"), "entry_id": when("no_id", "", "entry_id"), "account_code": when("no_code", "", "account_code"), "accounting_date": when("date", "1996-02-30", "accounting_date"),
        "posted_at": when("early", F.date_format(F.date_sub("o_orderdate", 1), "yyyy-MM-dd"), "posted_at"),
        "amount_dr": F.when(F.col("fault") == "amount", "1e").when(F.col("fault") == "scale", "5.000").when(F.col("fault") == "both", "7").otherwise(F.col("amount_dr")),
        "amount_cr": F.when(F.col("fault") == "both", "8").otherwise(F.col("amount_cr")),
    })
    twice = rows.withColumn("again", F.lit(0)).unionByName(rows.where("o_orderkey % 47 = 0").withColumn("again", F.lit(1)))
    return extract(spark, twice, ["again", "o_orderkey"], ENTRY.columns)


@query(f"""WITH {FAULTY_SQL} SELECT row, kind, "column" FROM numbered JOIN kinds USING (fault) UNION ALL SELECT row, 'duplicate_key', 'entry_id,version' FROM numbered WHERE again = 1""")
def validator_findings(spark, sf):
    """All findings of an extract with planted faults and repeated rows."""
    return finding_rows(spark, f"{faulty_extract(spark, sf)}/gl_entry.csv", ENTRY).select("row", "kind", "column")


@query(f"""WITH {FAULTY_SQL}, each AS (SELECT row, kind, "column" FROM numbered JOIN kinds USING (fault) UNION ALL SELECT row, 'duplicate_key', 'entry_id,version' FROM numbered WHERE again = 1)
SELECT row, kind, "column", (SELECT count(*) FROM each) AS total, (SELECT count(*) FROM numbered) AS n_rows FROM each ORDER BY row, kind, "column" LIMIT 7""")
def validator_report_capped(spark, sf):
    """The report of a table: the first findings, the number of all, and the rows scanned."""
    report = validate_table(spark, faulty_extract(spark, sf), ENTRY, most=7)
    return spark.createDataFrame([(f.row, f.kind, f.column, report.total, report.rows) for f in report.findings], "row long, kind string, column string, total long, n_rows long")


@query("""SELECT * FROM (VALUES ('absent', 'missing_table', ''), ('lacking', 'missing_column', 'description'), ('swapped', 'column_order', 'version,entry_id,accounting_date,posted_at,account_code,cost_center_code,currency,amount_dr,amount_cr,doc_id,vendor_code,description'),
('more', 'added_column', 'o_orderkey'), ('twice', 'duplicate_column', 'doc_id')) AS v("case", kind, "column")""")
def validator_headers(spark, sf):
    """One table in five forms; a header that fails stops its table."""
    names = ENTRY.columns
    rows = journal(spark, sf).where("o_orderkey % 2 = 0").limit(1)
    forms = {"lacking": names[:-1], "swapped": [names[1], names[0], *names[2:]], "more": [*names, "o_orderkey"]}
    found = [("absent", validate_table(spark, scratch(spark, "none"), ENTRY))]
    found += [(case, validate_table(spark, extract(spark, rows, ["o_orderkey"], columns), ENTRY)) for case, columns in forms.items()]
    folder = scratch(spark, "extract")
    files.write_file(spark, f"{folder}/gl_entry.csv", ",".join([*names, "doc_id"]) + "\n")
    found.append(("twice", validate_table(spark, folder, ENTRY)))
    return spark.createDataFrame([(case, f.kind, f.column) for case, r in found for f in r.findings], "case string, kind string, column string")


# ---- merges ----

SECOND_SQL = f"""{LINES_SQL}, first AS (SELECT * FROM journal WHERE o_orderkey % 10 < 8),
second AS (SELECT * REPLACE (CASE WHEN o_orderkey % 7 = 0 THEN strftime(CAST(accounting_date AS DATE) + INTERVAL 1 MONTH, '%Y-%m-%d') ELSE accounting_date END AS accounting_date,
  CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE description END AS description) FROM journal WHERE o_orderkey % 10 >= 4),
paired AS (SELECT coalesce(s.entry_id, f.entry_id) AS entry_id, f.entry_id IS NOT NULL AS old, s.entry_id IS NOT NULL AS new, f.accounting_date AS was, coalesce(s.accounting_date, f.accounting_date) AS accounting_date,
  coalesce(s.description, f.description) AS description, f.entry_id IS NOT NULL AND s.entry_id IS NOT NULL AND (s.accounting_date <> f.accounting_date OR s.description <> f.description) AS changed FROM first f FULL OUTER JOIN second s ON f.entry_id = s.entry_id)"""


def batches(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    lines = journal(spark, sf)
    later = F.date_format(F.add_months(F.col("accounting_date").cast("date"), 1), "yyyy-MM-dd")
    second = lines.where("o_orderkey % 10 >= 4").withColumns({
        "accounting_date": F.when(F.col("o_orderkey") % 7 == 0, later).otherwise(F.col("accounting_date")), "description": F.when(F.col("o_orderkey") % 5 == 0, "X").otherwise(F.col("description")),
    })
    return lines.where("o_orderkey % 10 < 8").select(*ENTRY.columns), second.select(*ENTRY.columns)


@functools.lru_cache(maxsize=4)
def _merged(spark: SparkSession, sf: str, application: str) -> tuple[str, list[loader.LoadReport]]:
    root = scratch(spark, "raw")
    first, second = batches(spark, sf)
    return root, [loader.merge_batch(rows, root, ENTRY, run) for rows, run in ((first, "r1"), (second, "r2"), (second, "r3"))]


def merged(spark: SparkSession, sf: str) -> tuple[str, list[loader.LoadReport]]:
    """A raw layer after two batches, and the second once more; made once for the queries of a session that look at it."""
    return _merged(spark, sf, spark.sparkContext.applicationId)


@query(f"WITH {SECOND_SQL} SELECT entry_id, '1' AS version, accounting_date, substr(accounting_date, 1, 7) AS accounting_period, description, CASE WHEN old THEN 'r1' ELSE 'r2' END AS _first_run_id, CASE WHEN new THEN 'r3' ELSE 'r1' END AS _last_run_id FROM paired")
def raw_after_merges(spark, sf):
    """The layer's rows with their provenance after an insert, an update with moves, and the same batch again."""
    root, _ = merged(spark, sf)
    return raw.read(spark, root, ENTRY).select("entry_id", "version", "accounting_date", raw.PERIOD, "description", *METADATA)


@query(f"""WITH {SECOND_SQL} SELECT 'r1' AS run, count(*) AS rows_read, count(*) AS inserted, 0 AS updated, 0 AS evicted FROM first UNION ALL
SELECT 'r2', count(*) FILTER (WHERE new), count(*) FILTER (WHERE new AND NOT old), count(*) FILTER (WHERE changed), count(*) FILTER (WHERE new AND substr(was, 1, 7) <> substr(accounting_date, 1, 7)) FROM paired UNION ALL
SELECT 'r3', count(*), 0, 0, 0 FROM second""")
def merge_reports(spark, sf):
    """What each merge did; the same batch again does nothing."""
    _, reports = merged(spark, sf)
    return spark.createDataFrame([(f"r{k}", r.rows_read, r.inserted, r.updated, r.evicted) for k, r in enumerate(reports, 1)], "run string, rows_read long, inserted long, updated long, evicted long")


@query(f"WITH {SECOND_SQL} SELECT substr(accounting_date, 1, 7) AS period FROM first UNION SELECT substr(accounting_date, 1, 7) FROM paired WHERE new AND (changed OR NOT old) UNION SELECT substr(was, 1, 7) FROM paired WHERE new AND substr(was, 1, 7) <> substr(accounting_date, 1, 7)")
def dirty_periods(spark, sf):
    """The periods that the merges owe a judgement."""
    root, _ = merged(spark, sf)
    return spark.createDataFrame([(p,) for p in sorted(loader.Affected.load(spark, root).periods)], "period string")


@query(f"WITH {SECOND_SQL} SELECT substr(accounting_date, 1, 7) AS period, count(*) AS n_rows FROM paired GROUP BY 1")
def partition_counts(spark, sf):
    """Rows of each partition, from the footers."""
    root, _ = merged(spark, sf)
    return spark.createDataFrame(list(raw.count_rows(spark, root, ENTRY).items()), "period string, n_rows long")


@query(f"WITH {SECOND_SQL} SELECT entry_id, '1' AS version, substr(accounting_date, 1, 7) AS accounting_period FROM paired WHERE substr(accounting_date, 1, 4) = '1995'")
def key_scan(spark, sf):
    """Keys alone, of some partitions."""
    root, _ = merged(spark, sf)
    return raw.read_keys(spark, root, ENTRY, core.period_range("1995-01", "1995-12"))


@query(f"""WITH {SECOND_SQL} SELECT s.entry_id, CASE WHEN s.accounting_date <> f.accounting_date THEN 'accounting_date' ELSE '' END || CASE WHEN s.accounting_date <> f.accounting_date AND s.description <> f.description THEN ',' ELSE '' END
|| CASE WHEN s.description <> f.description THEN 'description' ELSE '' END AS changed FROM first f JOIN second s USING (entry_id) WHERE s.accounting_date <> f.accounting_date OR s.description <> f.description""")
def immutable_columns(spark, sf):
    """The columns in which rows that must not change do: what the loader refuses by."""
    first, second = batches(spark, sf)
    found = merge.restated_columns(first, second, ENTRY.primary_key, [c for c in ENTRY.columns if c not in ENTRY.primary_key])
    return found.select("entry_id", F.concat_ws(",", "columns_changed").alias("changed"))


@query(f"WITH {SECOND_SQL} SELECT entry_id, CASE WHEN entry_id IN (SELECT entry_id FROM first) THEN 'r1' ELSE 'r2' END AS first_run FROM second")
def first_runs(spark, sf):
    """The run that first brought each key of a batch."""
    first, second = batches(spark, sf)
    old = first.withColumn("_first_run_id", F.lit("r1"))
    return merge.stamped(merge.compared(second, old, ENTRY.primary_key, [], ["_first_run_id"]), ["entry_id"], "r2").select("entry_id", F.col("_first_run_id").alias("first_run"))


@query(f"WITH {LINES_SQL} SELECT 'gl_entry' AS \"table\", max(posted_at) AS newest, strftime(CAST(max(posted_at) AS DATE) - INTERVAL 7 DAY, '%Y-%m-%d') AS bound FROM journal")
def watermark_state(spark, sf):
    """The watermark that a load saves, and the bound of the next load's window."""
    root = scratch(spark, "raw")
    folder = extract(spark, journal(spark, sf), ["o_orderkey"], ENTRY.columns)
    loader.load_table(spark, folder, root, ENTRY, "r1")
    marks = loader.Watermarks(spark, root)
    return spark.createDataFrame([(t, day, marks.bound(t, 7)) for t, day in marks.held.items()], "table string, newest string, bound string")


# ---- the mart ----

ACCOUNTS_SQL = """accounts AS (SELECT '60' || i AS account_code, 'account ' || i || CASE WHEN v > 0 THEN ' new' ELSE '' END AS name, CASE WHEN i < 3 THEN '' ELSE '600' END AS parent_code,
  CASE (i + least(v, 1)) % 5 WHEN 0 THEN 'asset' WHEN 1 THEN 'liability' WHEN 2 THEN 'equity' WHEN 3 THEN 'revenue' ELSE 'expense' END AS account_type, CASE v WHEN 0 THEN '1990-01-01' WHEN 1 THEN '1995-06-15' ELSE '1996-06-15' END AS effective_date
  FROM (SELECT unnest(range(10)) AS i), (SELECT unnest(range(3)) AS v) WHERE v = 0 OR i % 2 = 0)"""
CENTRES_SQL = """centres AS (SELECT 'CC-' || i AS cc_code, 'centre ' || i AS name, 'D' || ((i + v) % 4) AS dept_code, CASE v WHEN 0 THEN '1990-01-01' ELSE '1996-01-01' END AS effective_date
  FROM (SELECT unnest(range(12)) AS i), (SELECT unnest(range(2)) AS v) WHERE v = 0 OR i % 3 = 0)"""
RATES_SQL = """rates AS (SELECT c AS currency, strftime(DATE '1990-01-01' + to_months(CAST(m AS INTEGER)), '%Y-%m-%d') AS rate_date, ((m // 2 * 37 + length(c) + ascii(c)) % 9 + 1) || '.' || lpad(CAST(m // 2 * 131 % 1000000 AS VARCHAR), 6, '0') AS rate_to_base
  FROM (SELECT unnest(['CNY', 'EUR', 'USD', 'GBP']) AS c), (SELECT unnest(range(144)) AS m))"""
VENDORS_SQL = "vendors AS (SELECT 'S' || i AS vendor_code, 'vendor ' || i AS name, 'services' AS category FROM (SELECT unnest(range(9)) AS i))"


def sources(spark: SparkSession, sf: str):
    """landing.<table> -> rows, from the orders and from rules."""
    lines = journal(spark, sf).withColumns({"_first_run_id": F.lit("r1"), "_last_run_id": F.lit("r1")})
    fixed = lines.where("o_orderkey % 7 = 0").withColumns({"adjusts_entry_id": F.col("entry_id"), "entry_id": F.concat(F.lit("A"), "entry_id"), "adjustment_type": F.when(F.col("o_orderkey") % 3 == 0, "restatement").otherwise("correction")})
    grid = lambda n, v, keep: spark.range(n).selectExpr("id AS i", f"explode(sequence(0, {v - 1})) AS v").where(keep)
    own = {
        "landing.gl_entry": lines.drop("o_orderkey"), "landing.gl_adjustment": fixed.drop("o_orderkey"),
        "landing.dim_account_src": grid(10, 3, "v = 0 OR i % 2 = 0").selectExpr("concat('60', i) AS account_code", "concat('account ', i, if(v > 0, ' new', '')) AS name", "if(i < 3, '', '600') AS parent_code",
            "element_at(array('asset', 'liability', 'equity', 'revenue', 'expense'), cast((i + least(v, 1)) % 5 + 1 as int)) AS account_type", "element_at(array('1990-01-01', '1995-06-15', '1996-06-15'), v + 1) AS effective_date"),
        "landing.dim_cost_center_src": grid(12, 2, "v = 0 OR i % 3 = 0").selectExpr("concat('CC-', i) AS cc_code", "concat('centre ', i) AS name", "concat('D', (i + v) % 4) AS dept_code", "if(v = 0, '1990-01-01', '1996-01-01') AS effective_date"),
        "landing.fx_rate": spark.range(144).selectExpr("cast(id as int) AS m", "explode(array('CNY', 'EUR', 'USD', 'GBP')) AS currency").selectExpr("currency", "date_format(add_months(date'1990-01-01', m), 'yyyy-MM-dd') AS rate_date",
            "concat((m div 2 * 37 + length(currency) + ascii(currency)) % 9 + 1, '.', lpad(m div 2 * 131 % 1000000, 6, '0')) AS rate_to_base"),
        "landing.dim_vendor": spark.range(9).selectExpr("concat('S', id) AS vendor_code", "concat('vendor ', id) AS name", "'services' AS category"),
    }
    return own.__getitem__


def _dim_sql(name: str, source: str, key: str, attributes: list[str], date: str, shown: str) -> str:
    render = lambda c: f"CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR)"
    prints = " || chr(31) || ".join(map(render, attributes))
    return f"""{name}_m AS (SELECT *, {prints} AS f, lag({prints}) OVER (PARTITION BY {key} ORDER BY {date}) AS b FROM {source}),
{name}_k AS (SELECT *, lead({date}) OVER (PARTITION BY {key} ORDER BY {date}) AS nxt FROM {name}_m WHERE b IS NULL OR b <> f),
{name} AS (SELECT sha256({render(key)} || chr(31) || {render(date)}) AS surrogate_key, {key}, {shown}, CAST({date} AS DATE) AS valid_from, CAST(coalesce(CAST(nxt AS DATE) - INTERVAL 1 DAY, DATE '9999-12-31') AS DATE) AS valid_to, nxt IS NULL AS is_current FROM {name}_k)"""


DIM_SQL = ",\n".join([
    ACCOUNTS_SQL, CENTRES_SQL, RATES_SQL, VENDORS_SQL, _dim_sql("dim_account", "accounts", "account_code", ["name", "parent_code", "account_type"], "effective_date", "name, nullif(parent_code, '') AS parent_code, account_type"),
    _dim_sql("dim_cost_center", "centres", "cc_code", ["name", "dept_code"], "effective_date", "name, dept_code"), _dim_sql("dim_fx_rate", "rates", "currency", ["rate_to_base"], "rate_date", "CAST(rate_to_base AS DECIMAL(18,6)) AS rate_to_base"),
])


@query(f"WITH {DIM_SQL} SELECT * FROM dim_account")
def dim_account(spark, sf):
    return ledger.dim_account(sources(spark, sf)("landing.dim_account_src"))


@query(f"WITH {DIM_SQL} SELECT * FROM dim_cost_center")
def dim_cost_center(spark, sf):
    return ledger.dim_cost_center(sources(spark, sf)("landing.dim_cost_center_src"))


@query(f"WITH {DIM_SQL} SELECT surrogate_key, currency, CAST(rate_to_base AS DOUBLE) AS rate_to_base, valid_from, valid_to, is_current FROM dim_fx_rate")
def dim_fx_rate(spark, sf):
    return ledger.dim_fx_rate(sources(spark, sf)("landing.fx_rate")).withColumn("rate_to_base", _d("rate_to_base"))


@query(f"WITH {VENDORS_SQL} SELECT vendor_code, name, category FROM vendors")
def dim_vendor(spark, sf):
    return ledger.dim_vendor(sources(spark, sf)("landing.dim_vendor"))


FIXED_SQL = "fixed AS (SELECT * REPLACE ('A' || entry_id AS entry_id), entry_id AS adjusts_entry_id, CASE WHEN o_orderkey % 3 = 0 THEN 'restatement' ELSE 'correction' END AS adjustment_type FROM journal WHERE o_orderkey % 7 = 0)"
MONEY = ("rate_to_base", "amount_dr", "amount_cr", "amount_dr_base", "amount_cr_base")


def _fact_sql(name: str, source: str, extra: str = "") -> str:
    between = "CAST(j.accounting_date AS DATE) BETWEEN {0}.valid_from AND {0}.valid_to"
    base = lambda c: f"round(CAST(j.{c} AS DECIMAL(18,2)) * r.rate_to_base, 2)"
    return f"""{name} AS (SELECT j.entry_id, j.version, CAST(j.accounting_date AS DATE) AS accounting_date, substr(j.accounting_date, 1, 7) AS accounting_period, CAST(j.posted_at AS DATE) AS posted_at, a.surrogate_key AS account_key, c.surrogate_key AS cost_center_key,
  r.surrogate_key AS fx_key, j.account_code, a.name AS account_name, a.account_type, a.parent_code, j.cost_center_code, c.name AS cost_center_name, c.dept_code, j.currency, r.rate_to_base, CAST(j.amount_dr AS DECIMAL(18,2)) AS amount_dr, CAST(j.amount_cr AS DECIMAL(18,2)) AS amount_cr,
  {base('amount_dr')} AS amount_dr_base, {base('amount_cr')} AS amount_cr_base, j.doc_id{extra}, nullif(j.vendor_code, '') AS vendor_code, v.name AS vendor_name, j.description, 'r1' AS source_first_run_id, 'r1' AS source_last_run_id
  FROM {source} j JOIN dim_account a ON j.account_code = a.account_code AND {between.format('a')} JOIN dim_cost_center c ON j.cost_center_code = c.cc_code AND {between.format('c')} JOIN dim_fx_rate r ON j.currency = r.currency AND {between.format('r')}
  LEFT JOIN vendors v ON nullif(j.vendor_code, '') = v.vendor_code)"""


MART_SQL = ",\n".join([LINES_SQL, FIXED_SQL, DIM_SQL, _fact_sql("fct_gl_entry", "journal"), _fact_sql("fct_gl_adjustment", "fixed", ", j.adjusts_entry_id, j.adjustment_type")])
DOUBLES = " REPLACE (" + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in MONEY) + ")"


def facts(spark: SparkSession, sf: str) -> tuple[DataFrame, ...]:
    """(entries, adjustments, accounts, centres) of the mart."""
    landing = sources(spark, sf)
    dims = [mart.MODELS[m].build(landing(mart.MODELS[m].needs[0])) for m in ("dim_account", "dim_cost_center", "dim_fx_rate", "dim_vendor")]
    return mart.MODELS["fct_gl_entry"].build(landing("landing.gl_entry"), *dims), mart.MODELS["fct_gl_adjustment"].build(landing("landing.gl_adjustment"), *dims), *dims[:2]


@query(f"WITH {MART_SQL} SELECT *{DOUBLES} FROM fct_gl_entry")
def fact_entries(spark, sf):
    """Every column of the journal's facts, by the model's own builder."""
    return facts(spark, sf)[0].withColumns({c: _d(c) for c in MONEY})


@query(f"WITH {MART_SQL} SELECT *{DOUBLES} FROM fct_gl_adjustment")
def fact_adjustments(spark, sf):
    return facts(spark, sf)[1].withColumns({c: _d(c) for c in MONEY})


def _balance_sql(mom: int, yoy: int, rolling: int) -> str:
    w = "(PARTITION BY account_code, cost_center_code ORDER BY accounting_period"
    cents = lambda n, d: f"CAST(sign({n}) * ((2 * abs({n}) + {d}) // (2 * {d})) AS DOUBLE)"
    pct = lambda k: f"CASE WHEN {k} <> 0 THEN {cents(f'CAST((restated - {k}) * 100 AS HUGEINT) * 1000000', f'CAST(abs({k}) * 100 AS HUGEINT)')} / 1000000.0 END"
    return f"""{MART_SQL},
lines AS (SELECT account_code, cost_center_code, accounting_period, accounting_date, account_type, amount_dr_base AS dr, amount_cr_base AS cr, NULL AS kind FROM fct_gl_entry UNION ALL SELECT account_code, cost_center_code, accounting_period, accounting_date, account_type, amount_dr_base, amount_cr_base, adjustment_type FROM fct_gl_adjustment),
sums AS (SELECT account_code, cost_center_code, accounting_period, coalesce(sum(dr) FILTER (WHERE kind IS DISTINCT FROM 'restatement'), 0) AS dr, coalesce(sum(cr) FILTER (WHERE kind IS DISTINCT FROM 'restatement'), 0) AS cr,
  coalesce(sum(dr) FILTER (WHERE kind = 'restatement'), 0) AS rdr, coalesce(sum(cr) FILTER (WHERE kind = 'restatement'), 0) AS rcr, arg_max(account_type, (accounting_date, account_type)) FILTER (WHERE kind IS DISTINCT FROM 'restatement') AS closing FROM lines GROUP BY ALL),
months AS (SELECT strftime(unnest(generate_series(CAST(min(accounting_period) || '-01' AS DATE), CAST(max(accounting_period) || '-01' AS DATE), INTERVAL 1 MONTH)), '%Y-%m') AS accounting_period FROM sums),
dense AS (SELECT account_code, cost_center_code, accounting_period, coalesce(dr, 0) AS dr, coalesce(cr, 0) AS cr, coalesce(rdr, 0) AS rdr, coalesce(rcr, 0) AS rcr,
  coalesce(last_value(closing IGNORE NULLS) OVER {w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(closing IGNORE NULLS) OVER {w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS account_type
  FROM (SELECT DISTINCT account_code, cost_center_code FROM sums) CROSS JOIN months LEFT JOIN sums USING (account_code, cost_center_code, accounting_period)),
based AS (SELECT *, CASE WHEN account_type IN ('asset', 'expense') THEN dr - cr ELSE cr - dr END AS reported, CASE WHEN account_type IN ('asset', 'expense') THEN rdr - rcr ELSE rcr - rdr END AS delta FROM dense),
bridged AS (SELECT *, reported + delta AS restated FROM based),
compared AS (SELECT *, lag(restated, {mom}) OVER {w}) AS mom, lag(restated, {yoy}) OVER {w}) AS yoy, sum(restated) OVER {w} ROWS BETWEEN {rolling - 1} PRECEDING AND CURRENT ROW) AS rsum, count(*) OVER {w} ROWS BETWEEN {rolling - 1} PRECEDING AND CURRENT ROW) AS rn,
  CAST(date_trunc('month', CAST(accounting_period || '-01' AS DATE)) + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS closes FROM bridged)
SELECT b.account_code, a.name AS account_name, b.cost_center_code, c.name AS cost_center_name, c.dept_code, accounting_period, b.account_type, CAST(dr AS DOUBLE) AS debit_total, CAST(cr AS DOUBLE) AS credit_total, CAST(reported AS DOUBLE) AS balance_as_reported,
  CAST(delta AS DOUBLE) AS restatement_delta, CAST(restated AS DOUBLE) AS balance_as_restated, CAST(restated - mom AS DOUBLE) AS balance_delta_mom, {pct('mom')} AS balance_pct_mom, CAST(restated - yoy AS DOUBLE) AS balance_delta_yoy, {pct('yoy')} AS balance_pct_yoy,
  {cents('CAST(rsum * 100 AS HUGEINT)', 'rn')} / 100.0 AS balance_rolling_3m, CAST(rn AS INTEGER) AS rolling_periods
FROM compared b LEFT JOIN dim_account a ON b.account_code = a.account_code AND closes BETWEEN a.valid_from AND a.valid_to LEFT JOIN dim_cost_center c ON b.cost_center_code = c.cc_code AND closes BETWEEN c.valid_from AND c.valid_to"""


def _shown(balance: DataFrame) -> DataFrame:
    kinds = {f.name: f.dataType.simpleString() for f in balance.schema}
    return balance.withColumns({c: _d(c) for c, k in kinds.items() if k.startswith("decimal")})


@query("WITH " + _balance_sql(1, 12, 3))
def ledger_balance(spark, sf):
    """All eighteen columns of the dense balance, over the mart's own facts."""
    return _shown(ledger.monthly_balance(*facts(spark, sf)))


@query("WITH " + _balance_sql(2, 6, 4))
def ledger_balance_other_windows(spark, sf):
    """The same with other comparison windows."""
    return _shown(ledger.monthly_balance(*facts(spark, sf), windows=core.Windows(mom=2, yoy=6, rolling=4)))


COUNTED = {"dim_account": "dim_account", "dim_cost_center": "dim_cost_center", "dim_fx_rate": "dim_fx_rate", "dim_vendor": "vendors", "fct_gl_entry": "fct_gl_entry", "fct_gl_adjustment": "fct_gl_adjustment"}


@query(f"WITH {MART_SQL} SELECT model, row_count, invocation_id FROM ({' UNION ALL '.join(f'SELECT {m!r} AS model, count(*) AS row_count FROM {t}' for m, t in COUNTED.items())}), (SELECT unnest(['b1', 'b2']) AS invocation_id)")
def mart_row_counts(spark, sf):
    """Row counts of two builds; the second is appended to the first's."""
    landing = sources(spark, sf)
    models = {m: mart.MODELS[m].build(landing(mart.MODELS[m].needs[0])) for m in ("dim_account", "dim_cost_center", "dim_fx_rate", "dim_vendor")}
    models |= dict(zip(("fct_gl_entry", "fct_gl_adjustment"), facts(spark, sf), strict=False))
    at = scratch(spark, "counts")
    for build in ("b1", "b2"):
        ledger.row_counts(models, build).write.mode("append").parquet(at)
    return spark.read.parquet(at).select("model", "row_count", "invocation_id")


def small_landing(spark: SparkSession, sf: str):
    """The sources with few lines, each voucher balanced by a second line."""
    landing = sources(spark, sf)

    def read(name: str) -> DataFrame:
        rows = landing(name)
        if name != "landing.gl_entry":
            return rows.where("doc_id like 'V1%'") if name == "landing.gl_adjustment" else rows
        lines = rows.where("doc_id like 'V1%'").withColumn("doc_id", F.concat("doc_id", F.lit("-"), "entry_id"))
        other = lines.withColumns({"version": F.lit("2"), "amount_dr": F.col("amount_cr"), "amount_cr": F.col("amount_dr")})
        return lines.unionByName(other)

    return read


@query(f"WITH {MART_SQL} SELECT 'mart__bone' AS build, 2 * count(*) AS n_entries, (SELECT count(*) FROM fct_gl_adjustment WHERE doc_id LIKE 'V1%' AND vendor_code IS DISTINCT FROM 'S9') AS n_adjustments, true AS drift_silent FROM fct_gl_entry WHERE doc_id LIKE 'V1%' AND vendor_code IS DISTINCT FROM 'S9'")
def mart_build(spark, sf):
    """A gated build, published: what readers of the pointer see."""
    landing = small_landing(spark, sf)
    own = lambda name: landing(name).where("vendor_code <> 'S9'") if name.startswith("landing.gl_") else landing(name)
    warehouse = scratch(spark, "warehouse")
    verdicts = mart.build_and_promote(spark, "none", warehouse, "one", own)
    n = [mart.published(spark, warehouse, m).count() for m in ("fct_gl_entry", "fct_gl_adjustment")]
    return spark.createDataFrame([(mart.current(spark, warehouse), *n, "row_counts_have_not_drifted" in verdicts.passed)], "build string, n_entries long, n_adjustments long, drift_silent boolean")


@query(f"""WITH {MART_SQL} SELECT 'relationships_fct_gl_entry_vendor_code' AS gate, 2 * count(*) AS n_failing FROM fct_gl_entry WHERE doc_id LIKE 'V1%' AND vendor_code = 'S9'""")
def mart_red_build(spark, sf):
    """A build whose journal names an unknown vendor: the failing rows are stored, what stands on it is skipped, nothing is published."""
    warehouse = scratch(spark, "warehouse")
    landing = small_landing(spark, sf)
    try:
        mart.build_and_promote(spark, "none", warehouse, "red", lambda n: landing(n).where("vendor_code <> 'S9'") if n == "landing.gl_adjustment" else landing(n))
        raise AssertionError("a red build was published")
    except mart.GatesFailed as red:
        assert mart.current(spark, warehouse) is None and not files.exists(spark, f"{warehouse}/mart__bred/agg_monthly_balance")
        stored = [(gate, spark.read.parquet(f"{warehouse}/mart__bred_audit/{gate}").count()) for gate in red.failed]
    return spark.createDataFrame(stored, "gate string, n_failing long")


FEEDS_SQL = """feeds(source, model) AS (VALUES ('gl_entry', 'fct_gl_entry'), ('gl_adjustment', 'fct_gl_adjustment'), ('fx_rate', 'dim_fx_rate'), ('dim_account_src', 'dim_account'), ('dim_cost_center_src', 'dim_cost_center'), ('dim_vendor', 'dim_vendor')),
needs(above, below) AS (SELECT d, f FROM (SELECT unnest(['dim_account', 'dim_cost_center', 'dim_fx_rate', 'dim_vendor']) AS d), (SELECT unnest(['fct_gl_entry', 'fct_gl_adjustment']) AS f) UNION ALL SELECT unnest(['fct_gl_entry', 'fct_gl_adjustment', 'dim_account', 'dim_cost_center']), 'agg_monthly_balance'),
reach(source, model) AS (SELECT source, model FROM feeds UNION SELECT source, below FROM reach JOIN needs ON model = above)"""


@query(f"WITH RECURSIVE {FEEDS_SQL} SELECT source, model FROM reach")
def model_impact(spark, sf):
    """Every model that each source table reaches."""
    return spark.createDataFrame([(t, m) for t in all_contracts() for m in mart.impact(t)], "source string, model string")


@query("SELECT 'run ' || i AS run_id, CASE i % 3 WHEN 0 THEN 'succeeded' WHEN 1 THEN 'failed' ELSE 'interrupted' END AS status, CAST(i % 3 AS INTEGER) AS n_steps FROM (SELECT unnest(range(2, 7)) AS i)")
def run_listing(spark, sf):
    """The newest five of seven runs, folded from their events."""
    log = runlog.RunLog(spark, scratch(spark, "log"))
    for i in range(7):
        log.append("started", f"run {i}")
        for k in range(i % 3):
            log.append("step_started", f"run {i}", step=str(k))
            log.append("step_finished", f"run {i}", step=str(k), status="succeeded")
        if i % 3 < 2:
            log.append("finished", f"run {i}", status="succeeded" if i % 3 == 0 else "failed")
    return spark.createDataFrame([(r.run_id, r.status, len(r.attempts[0].steps)) for r in log.runs(5)], "run_id string, status string, n_steps int")


@query("SELECT strftime(DATE '1999-11-01' + to_months(CAST(i AS INTEGER)), '%Y-%m') AS period, strftime(DATE '1999-11-01' + to_months(CAST(i AS INTEGER) - 13), '%Y-%m') AS shifted FROM (SELECT unnest(range(16)) AS i)")
def period_arithmetic(spark, sf):
    """A range of periods, and each thirteen months earlier."""
    return spark.createDataFrame([(p, core.shift(p, -13)) for p in core.parse_periods("1999-11:2001-02")], "period string, shifted string")


@query("SELECT o_orderkey, CAST(round_even(CAST(o_orderkey AS DOUBLE) / 8, 2) AS DOUBLE) AS quantized FROM orders")
def half_even(spark, sf):
    return _t(spark, sf, "orders").select("o_orderkey", quantile.money(F.col("o_orderkey").cast("decimal(38,8)") / 8, 2).cast("double").alias("quantized"))


BANDS_SQL = f"""{PANEL_SQL}, mid AS (SELECT cost_center_code, quantile_cont(balance, 0.5) AS m FROM panel GROUP BY 1 HAVING max(CASE WHEN balance <> 0 THEN 1 ELSE 0 END) = 1), cuts AS (SELECT quantile_cont(m, 1.0 / 3) AS a, quantile_cont(m, 2.0 / 3) AS b FROM mid),
bands AS (SELECT cost_center_code, CASE WHEN m <= a THEN 0.0 WHEN m > b THEN 2.0 ELSE 1.0 END AS size_band FROM mid, cuts WHERE cost_center_code <> '3'),
lagged AS (SELECT *, lag(balance, 1) OVER w AS lag_1, lag(balance, 3) OVER w AS lag_3, lag(balance, 12) OVER w AS lag_12, row_number() OVER w AS r FROM panel WINDOW w AS (PARTITION BY account_code, cost_center_code ORDER BY accounting_period)),
design AS (SELECT account_code, cost_center_code, accounting_period, balance AS actual, lag_1, lag_3, lag_12, {', '.join(f"CAST(substr(accounting_period, 6, 2) = '{m:02d}' AS DOUBLE) AS month_{m}" for m in range(1, 13))}, CAST(coalesce(size_band, 1.0) AS DOUBLE) AS size_band
  FROM lagged LEFT JOIN bands USING (cost_center_code) WHERE r > 12)"""


@query(f"WITH {BANDS_SQL} SELECT * FROM design")
def design_rows(spark, sf):
    """Whole rows of the design matrix; a centre without a band (here centre 3) takes the middle one."""
    rows = panel(spark, sf)
    return features.design(rows, features.size_bands(rows).where("cost_center_code <> '3'"))


@query(f"""WITH {PANEL_SQL}, judged AS (SELECT DISTINCT accounting_period AS judged FROM panel ORDER BY 1 DESC LIMIT 3),
lagged AS (SELECT *, lag(balance, 1) OVER w AS lag_1, row_number() OVER w AS r FROM panel WINDOW w AS (PARTITION BY account_code, cost_center_code ORDER BY accounting_period))
SELECT judged, accounting_period, count(*) AS n_rows, round(sum(lag_1), 2) AS sum_lag, accounting_period = judged AS predicted FROM lagged JOIN judged ON accounting_period <= judged WHERE r > 12 GROUP BY ALL""")
def training_panels(spark, sf):
    """What each judged period trains on and predicts: nothing later, bands from earlier periods alone."""
    rows = panel(spark, sf)
    periods = quantile.folds([r[0] for r in rows.select("accounting_period").distinct().collect()], 3)
    return quantile.panels(rows, periods).groupBy("judged", "accounting_period").agg(F.count("*").alias("n_rows"), F.round(F.sum("lag_1"), 2).alias("sum_lag")).withColumn("predicted", F.col("accounting_period") == F.col("judged"))


@query(f"""WITH {NAIVE_SQL}, f AS (SELECT account_code, cost_center_code, accounting_period, CASE WHEN actual > upper_bound THEN 'above' ELSE 'below' END AS side FROM naive WHERE upper_bound > lower_bound AND (actual > upper_bound OR actual < lower_bound))
SELECT * FROM f WHERE accounting_period < '1996-01' OR accounting_period >= '1996-07' UNION ALL SELECT account_code, cost_center_code, accounting_period, 'above' FROM f WHERE accounting_period BETWEEN '1996-01' AND '1996-03' AND side = 'below'""")
def flags_replaced(spark, sf):
    """Flags of all periods, then those of six periods judged anew: three get other flags, three get none."""
    found = features.flags(naive(spark, sf)).select(*features.SERIES, "accounting_period", "side", F.lit("naive").alias("model_family"))
    warehouse = scratch(spark, "warehouse")
    mart.replace_flags(found, warehouse, sorted(r[0] for r in found.select("accounting_period").distinct().collect()), "naive")
    anew = found.where("accounting_period between '1996-01' and '1996-03' and side = 'below'").withColumn("side", F.lit("above"))
    mart.replace_flags(anew, warehouse, core.period_range("1996-01", "1996-06"), "naive")
    return mart.read_flags(spark, warehouse).select(*features.SERIES, "accounting_period", "side")


@query(f"""WITH {NAIVE_SQL} SELECT round(avg(CASE WHEN actual BETWEEN lower_bound AND upper_bound THEN 1.0 ELSE 0.0 END), 6) AS coverage, round(avg(upper_bound - lower_bound), 2) AS mean_width, round(avg(abs(actual - predicted)), 2) AS mae,
round(avg(CASE WHEN actual > lower_bound THEN 0.05 * (actual - lower_bound) ELSE 0.95 * (lower_bound - actual) END), 2) AS pinball_05, round(avg(CASE WHEN actual > upper_bound THEN 0.95 * (actual - upper_bound) ELSE 0.05 * (upper_bound - actual) END), 2) AS pinball_95 FROM naive WHERE upper_bound IS NOT NULL""")
def interval_scores(spark, sf):
    """All scores of a backtest's predictions."""
    found = features.interval_scores(naive(spark, sf).where("upper_bound is not null"))
    return found.select(F.round("coverage", 6).alias("coverage"), *[F.round(c, 2).alias(c) for c in ("mean_width", "mae", "pinball_05", "pinball_95")])


@query("""WITH a AS (SELECT l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS v FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1), b AS (SELECT l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS v FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1),
up AS (SELECT a.v - coalesce(b.v, 0) AS increase FROM a LEFT JOIN b USING (l_suppkey) WHERE a.v > coalesce(b.v, 0))
SELECT count(*) AS n_groups, CAST(sum(increase) AS DOUBLE) AS total, round(CAST(max(increase) AS DOUBLE) / CAST(sum(increase) AS DOUBLE), 6) AS top_share FROM up""")
def breakdown_spread(spark, sf):
    """How far an increase is spread: groups that have grown, and the largest one's share."""
    lines = _t(spark, sf, "lineitem", "l_suppkey", "l_linestatus", "l_extendedprice").withColumn("v", F.col("l_extendedprice").cast("decimal(18,2)"))
    grown = increases(lines.where("l_linestatus = 'O'"), lines.where("l_linestatus = 'F'"), "l_suppkey", "v")
    return spread_of(grown, "increase").select("n_groups", _d("total"), F.round("top_share", 6).alias("top_share"))


@query(f"WITH {DIM_SQL} SELECT 'dim_fx_rate' AS model, count(*) AS n_rows, 'surrogate_key text, currency text, rate_to_base numeric(18,6), valid_from date, valid_to date, is_current boolean' AS kinds FROM dim_fx_rate")
def exported_tables(spark, sf):
    """A model copied out with the type of each column; a type without a counterpart is refused."""
    at = scratch(spark, "export")
    kinds = raw.export(ledger.dim_fx_rate(sources(spark, sf)("landing.fx_rate")), at)
    return spark.createDataFrame([("dim_fx_rate", spark.read.parquet(at).count(), ", ".join(f"{c} {k}" for c, k in kinds.items()))], "model string, n_rows long, kinds string")


@query(f"WITH {SERIES_SQL} SELECT account_code, accounting_period, CAST(balance AS DOUBLE) AS balance FROM series ORDER BY account_code, accounting_period")
def ordered_read(spark, sf):
    """A series in the order of its keys."""
    return series(spark, sf).select("account_code", "accounting_period", _d("balance")).orderBy("account_code", "accounting_period")


@query(f"WITH {SECOND_SQL} SELECT entry_id, accounting_date, description, CASE WHEN old THEN 'r1' ELSE 'stream-0' END AS _first_run_id, CASE WHEN new THEN 'stream-0' ELSE 'r1' END AS _last_run_id FROM paired")
def streamed_merge(spark, sf):
    """A batch merged as one load, the next as a stream of what lies in a folder."""
    root, folder = scratch(spark, "raw"), scratch(spark, "arrivals")
    first, second = batches(spark, sf)
    loader.merge_batch(first, root, ENTRY, "r1")
    second.withColumn("__row", F.lit(0).cast("long")).write.parquet(folder)
    rows = spark.readStream.schema(", ".join(f"{c} string" for c in ENTRY.columns) + ", __row long").parquet(folder)
    merge_stream(rows, root, ENTRY, scratch(spark, "offsets")).awaitTermination()
    return raw.read(spark, root, ENTRY).select("entry_id", "accounting_date", "description", *METADATA)


@query("SELECT unnest(['mart__ba', 'mart__bb']) AS swept, 'mart__bd' AS published")
def swept_builds(spark, sf):
    """Old builds that are deleted: all but the published one and the newest other."""
    warehouse = scratch(spark, "warehouse")
    for name in "abcd":
        _t(spark, sf, "region").write.parquet(f"{warehouse}/{mart.PREFIX}{name}/agg_monthly_balance")
    mart.promote(spark, warehouse, f"{mart.PREFIX}d")
    gone = mart.sweep(spark, warehouse)
    assert not any(files.exists(spark, f"{warehouse}/{name}") for name in gone)
    return spark.createDataFrame([(name, mart.current(spark, warehouse)) for name in gone], "swept string, published string")
