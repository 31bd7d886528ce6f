"""The raw layer and the pipeline on a generated ledger."""

import dataclasses
import os
import time
import tracemalloc

import pytest

from quillstone import settings
from quillstone.__main__ import main, parser
from quillstone.contracts import ContractError, all_contracts, parse
from quillstone.operators.validate import validate_source, validate_table
from quillstone.plans import mart, pipeline, runlog
from quillstone.sources import files, generator, loader, raw
from quillstone.sources.csv_source import SourceError, select_rows

ENTRY = all_contracts()["gl_entry"]


def line(number, period_day, arrived, dr="0.00", cr="0.00", **other):
    """A journal line as text, from its number, day and arrival."""
    blank = dict.fromkeys(ENTRY.columns, "")
    return blank | {"entry_id": f"J{number:04d}", "version": "1", "accounting_date": period_day, "posted_at": arrived, "account_code": "6030", "cost_center_code": "CC-007", "currency": "EUR",
                    "amount_dr": dr, "amount_cr": cr, "doc_id": f"V{number // 10}", "description": 'tea, "green"; 2 kg'} | other


JULY = [line(11, "2024-07-03", "2024-07-04", dr="18.50"), line(12, "2024-07-30", "2024-08-02", cr="18.50")]
AUGUST = [line(21, "2024-08-09", "2024-08-11", dr="4.05"), line(22, "2024-08-31", "2024-09-05", cr="4.05"), line(23, "2024-08-31", "2024-09-06", dr="990.00")]


def extract(folder, data, columns=None, table="gl_entry"):
    """Write rows as the CSV extract of a table; returns the folder."""
    os.makedirs(folder, exist_ok=True)
    columns = columns or all_contracts()[table].columns
    quoted = lambda v: '"' + v.replace('"', '""') + '"' if set(v) & set('",\n') else v
    lines = [",".join(columns), *(",".join(quoted(r.get(c, "")) for c in columns) for r in data)]
    with open(os.path.join(folder, f"{table}.csv"), "w", newline="", encoding="utf-8") as out:
        out.write("\n".join(lines) + "\n")
    return str(folder)


@pytest.fixture
def lake(spark, tmp_path):
    """lake(rows, run): load an extract of those rows; lake.root is the raw layer."""

    def load(data, run="r0", **options):
        return loader.load_table(spark, extract(tmp_path / "extracts", data), load.root, ENTRY, run, **options)

    load.root = str(tmp_path / "raw")
    load.rows = lambda: {(r.entry_id, int(r.version)): r for r in raw.read(spark, load.root, ENTRY).collect()}
    return load


def test_merge_inserts_updates_moves_and_keeps(spark, lake):
    first = lake(JULY + AUGUST, "r1")
    assert (first.rows_read, first.inserted, first.updated, first.periods) == (5, 5, 0, ["2024-07", "2024-08"])
    digest = lambda: raw.checksum(raw.read(spark, lake.root, ENTRY), ENTRY.columns).first()
    before = digest()
    again = lake(JULY + AUGUST, "r2")  # seven days back from the newest arrival
    assert (again.rows_read, again.inserted, again.updated, again.periods) == (2, 0, 0, []) and digest() == before
    back = {**AUGUST[1], "accounting_date": "2024-07-31", "posted_at": "2024-09-07"}
    second = {**AUGUST[2], "version": "2", "amount_dr": "989.00"}
    twice = [line(31, "2024-09-01", "2024-09-08", dr="1.00"), line(31, "2024-09-02", "2024-09-08", dr="2.00")]
    report = lake([back, second, *twice], "r3")
    got = lake.rows()
    assert (report.inserted, report.updated, report.evicted, report.periods) == (2, 1, 1, ["2024-07", "2024-08", "2024-09"])
    assert set(got) == {("J0011", 1), ("J0012", 1), ("J0021", 1), ("J0022", 1), ("J0023", 1), ("J0023", 2), ("J0031", 1)}  # absent keys are kept
    moved = got["J0022", 1]
    assert (moved.accounting_period, moved._first_run_id, moved._last_run_id) == ("2024-07", "r1", "r3")
    assert got["J0031", 1].amount_dr == "2.00"  # the last of a repeated key
    assert got["J0011", 1]._last_run_id == "r1" and got["J0011", 1].description == JULY[0]["description"]
    assert loader.Watermarks(spark, lake.root).held == {"gl_entry": "2024-09-08"}
    assert loader.Affected.load(spark, lake.root).periods == {"2024-07", "2024-08", "2024-09"}
    assert raw.count_rows(spark, lake.root, ENTRY) == {"2024-07": 3, "2024-08": 3, "2024-09": 1}
    keys = raw.read_keys(spark, lake.root, ENTRY)
    assert keys.columns == ["entry_id", "version", "accounting_period"] and keys.count() == 7
    assert "amount_dr" not in keys._jdf.queryExecution().executedPlan().toString()


def test_a_period_that_empties_is_dropped_and_full_reads_all(spark, lake):
    lake(JULY + AUGUST)
    away = [{**r, "accounting_date": "2024-08-01"} for r in JULY]
    assert lake(away).rows_read == 0  # arrived before the window
    assert raw.periods(spark, lake.root, ENTRY) == ["2024-07", "2024-08"]
    assert lake(away, full=True).evicted == 2
    assert raw.periods(spark, lake.root, ENTRY) == ["2024-08"]
    with pytest.raises(raw.EmptyTable):
        raw.read(spark, f"{lake.root}/none", ENTRY, required=True)


def test_immutable_rows_and_state_errors(spark, tmp_path):
    rate, root = all_contracts()["fx_rate"], str(tmp_path / "raw")
    quote = {"currency": "GBP", "rate_date": "2024-07-01", "rate_to_base": "9.125000"}
    source = extract(tmp_path / "s", [quote], table="fx_rate")
    loader.load_table(spark, source, root, rate, "a")
    owed = loader.Affected.load(spark, root)
    assert [tuple(r) for r in owed.versions(spark).collect()] == [("fx_rate", ["GBP"], "2024-07-01")]
    extract(tmp_path / "s", [{**quote, "rate_to_base": "9.2"}, {**quote, "rate_date": "2024-07-02"}], table="fx_rate")
    with pytest.raises(loader.Restated, match="rate_to_base"):
        loader.load_table(spark, source, root, rate, "b")
    assert raw.read(spark, root, rate).count() == 1
    loader.Affected.record(spark, root, ["2024-07"])
    owed.clear(spark, root)  # what was recorded later stays owed
    assert loader.Affected.load(spark, root).periods == {"2024-07"} and loader.Affected.load(spark, root).versions(spark).count() == 0
    files.write_text(spark, f"{root}/_state/watermarks.json", '{"gl_entry": "soon"}')
    with pytest.raises(loader.StateError):
        loader.Watermarks(spark, root)


class Stop(Exception):
    pass


def stopped_at_each_step(monkeypatch, act, look):
    """Run act, stopped before its 1st, 2nd, ... change of a file, until it runs through; what look() saw after each."""
    steps = ("_write_whole", "rename_new", "delete")
    real = {n: getattr(files, n) for n in steps}
    seen = []
    for k in range(200):
        left = k

        def step(name):
            def run(*a, **b):
                nonlocal left
                left -= 1
                if left < 0:
                    raise Stop
                return real[name](*a, **b)

            return run

        with monkeypatch.context() as patch:
            for n in steps:
                patch.setattr(files, n, step(n))
            try:
                act(k)
                done = True
            except Stop:
                done = False
        seen.append(look())
        if done:
            return seen
    raise AssertionError("no end")


def test_a_stop_between_any_two_steps_leaves_the_old_state_or_the_new_one(spark, lake, tmp_path, monkeypatch):
    at = str(tmp_path / "state")
    files.write_text(spark, at, "old")
    seen = stopped_at_each_step(monkeypatch, lambda k: files.write_text(spark, at, "new"), lambda: files.read_text(spark, at))
    assert seen[0] == "old" and seen[-1] == "new" and set(seen) == {"old", "new"} and len(seen) >= 3

    lake(JULY + AUGUST, "r1")
    old = sorted(map(str, lake.rows().values()))
    away = [{**r, "accounting_date": "2024-09-30"} for r in JULY]  # one period empties, another begins
    look = lambda: sorted(map(str, lake.rows().values()))
    seen = stopped_at_each_step(monkeypatch, lambda k: lake(away, "r2", full=True), look)
    new = seen[-1]
    assert seen[0] == old != new and all(s in (old, new) for s in seen) and len(new) == 5
    assert loader.Affected.load(spark, lake.root).periods >= {"2024-07", "2024-09"}  # owed, however often it was stopped

    log = runlog.RunLog(spark, str(tmp_path / "log"))
    log.append("started", "a run")
    seen = stopped_at_each_step(monkeypatch, lambda k: log.append("step_started", "a run", step="one"), lambda: len(log.events()))
    assert seen[0] == 1 and seen[-1] == 2 and set(seen) == {1, 2}


def test_writers_do_not_lose_each_others_changes(spark, tmp_path):
    at = str(tmp_path / "state")
    n = files.write_text(spark, at, "one")
    files.write_text(spark, at, "two", n)
    with pytest.raises(files.Conflict):
        files.write_text(spark, at, "three", n)
    assert files.read_text(spark, at) == "two"
    log = runlog.RunLog(spark, str(tmp_path))
    for r in ("r/1", "r:2"):
        log.append("started", r)
    log.append("finished", "r/1", status="succeeded")
    log.append("finished", "r:2", status="failed")
    log.append("started", "r/1")
    assert [(r.run_id, r.status, len(r.attempts)) for r in log.runs()] == [("r:2", "failed", 1), ("r/1", "interrupted", 2)]
    assert len(log.runs(1)) == 1


def test_promotion_waits_for_a_held_lock_and_gives_up(spark, tmp_path):
    warehouse = str(tmp_path / "wh")
    spark.range(1).write.parquet(f"{warehouse}/mart__bx/agg_monthly_balance")
    with files.lock(spark, f"{warehouse}/_publishing"):
        begun = time.monotonic()
        with pytest.raises(files.LockTimeout):
            mart.promote(spark, warehouse, "mart__bx", lock_timeout=1)
        assert 1 <= time.monotonic() - begun < 15 and mart.current(spark, warehouse) is None
    mart.promote(spark, warehouse, "mart__bx", lock_timeout=1)
    assert mart.current(spark, warehouse) == "mart__bx"
    with files.lock(spark, f"{warehouse}/left", wait=0), files.lock(spark, f"{warehouse}/left", wait=5, stale=0):
        pass  # a lock that a crash left behind is broken
    mart.claim(spark, warehouse, "raw one")
    with pytest.raises(mart.WrongWarehouse):
        mart.claim(spark, warehouse, "raw two")


def test_flags_of_judged_periods_are_replaced(rows, tmp_path):
    spark, warehouse = rows("a int").sparkSession, str(tmp_path)
    flags = lambda *p: rows("account_code string, accounting_period string, model_family string", *[(a, x, "m") for a, x in p])
    assert mart.read_flags(spark, warehouse) is None
    mart.replace_flags(flags(("a", "2024-01"), ("b", "2024-02")), warehouse, ["2024-01", "2024-02"], "m")
    mart.replace_flags(flags(("c", "2024-02")), warehouse, ["2024-01", "2024-02"], "m")
    mart.replace_flags(flags(("d", "2024-03"), ("e", "2024-04")), warehouse, ["2024-03"], "m")
    assert sorted((r.account_code, r.accounting_period) for r in mart.read_flags(spark, warehouse).collect()) == [("c", "2024-02"), ("d", "2024-03")]


def test_source_guards(spark, tmp_path):
    with pytest.raises(SourceError, match="not exist"):
        select_rows(spark, str(tmp_path / "none.csv"), ENTRY)
    path = extract(tmp_path, JULY, ENTRY.columns[1:]) + "/gl_entry.csv"
    with pytest.raises(SourceError, match="entry_id"):
        select_rows(spark, path, ENTRY)
    path = extract(tmp_path, JULY + AUGUST, ["new", *ENTRY.columns]) + "/gl_entry.csv"
    assert select_rows(spark, path, ENTRY, "2024-09-01").count() == 2
    with pytest.raises(raw.UnmappedType):
        raw.exported_type(spark.range(1).selectExpr("map(1, 2) as m").schema[0].dataType)


GOOD = line(1, "2026-01-31", "2026-02-03", dr="31.00")


@pytest.mark.parametrize(("change", "kinds"), [
    ({}, []), ({"amount_dr": "abc"}, ["value"]), ({"entry_id": ""}, ["null"]), ({"vendor_code": ""}, []), ({"currency": "XXX"}, ["value"]), ({"version": "0"}, ["value"]), ({"version": "--5"}, ["value"]),
    ({"amount_dr": "1.234"}, ["value"]), ({"amount_dr": "NaN"}, ["value"]), ({"accounting_date": "2026-1-5"}, ["value"]), ({"accounting_date": "2026-02-30"}, ["value"]), ({"posted_at": "2026-01-01"}, ["row_constraint"]),
    ({"amount_cr": "5.00"}, ["row_constraint"]), ({"amount_dr": "0.00"}, ["row_constraint"]), ({"amount_dr": "-1.00"}, ["value"]),
])
def test_row_rules(spark, tmp_path, change, kinds):
    report = validate_table(spark, extract(tmp_path, [{**GOOD, **change}]), ENTRY)
    assert [f.kind for f in report.findings] == kinds and report.failed == bool(kinds)


def test_header_rules_and_caps(spark, tmp_path):
    def kinds(columns, data=(GOOD,)):
        return [f.kind for f in validate_table(spark, extract(tmp_path, data, columns), ENTRY).findings]

    names = ENTRY.columns
    assert kinds([*names, "extra"]) == ["added_column"] and kinds(names[:-1]) == ["missing_column"]
    assert kinds([names[1], names[0], *names[2:]]) == ["column_order"] and kinds([*names, names[0]]) == ["duplicate_column"]
    report = validate_table(spark, extract(tmp_path, [{**GOOD, "currency": "X"}] * 4), ENTRY, most=2)
    assert report.total == 7 and len(report.findings) == 2 and report.failed
    assert {r.table: r.findings[0].kind for r in validate_source(spark, str(tmp_path / "none"))}["fx_rate"] == "missing_table"


def test_contract_faults():
    good = {"table": "t", "primary_key": ["a"], "feeds": ["landing.t"], "columns": [{"name": "a", "type": "string", "nullable": False}]}
    assert parse(good).columns == ["a"]
    for name in ("feeds", "columns", "primary_key", "table"):
        with pytest.raises(ContractError):
            parse({k: v for k, v in good.items() if k != name})
    for change in ({"more": 1}, {"feeds": []}, {"feeds": ["a.b.c"]}, {"feeds": ["a.1b"]}, {"primary_key": ["b"]}, {"watermark": "a"}, {"feeds": ["X"]}, {"columns": [{"name": "a", "type": "float", "nullable": False}]}, {"columns": [{"name": "a", "type": "string", "nullable": False, "min": 1}]}, {"row_constraints": [{"type": "not_after"}]}):
        with pytest.raises(ContractError):
            parse({**good, **change})


@pytest.fixture(scope="module")
def ledger(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("ledger")
    generator.write(generator.Config(periods="2025-01:2026-03", entries_per_period=40, restatements=True, account_move=True), str(at / "src"))
    context = pipeline.Context(spark, str(at / "src"), str(at / "raw"), str(at / "wh"), "run1")
    pipeline.run("daily", context)
    return at, context


def test_daily(spark, ledger):
    at, context = ledger
    balance = mart.published(spark, context.warehouse, "agg_monthly_balance")
    pairs = balance.select("account_code", "cost_center_code").distinct().count()
    assert balance.count() == pairs * 15 and balance.where("restatement_delta <> 0").count() == 2
    assert balance.where("account_name is null or cost_center_name is null").count() == 0
    assert loader.Affected.load(spark, context.raw).periods == set()
    run = runlog.RunLog(spark, context.raw).runs()[0]
    assert run.status == "succeeded" and list(run.attempts[0].steps) == ["validate", "load", "mart-load", "dbt-build", "judge", "clear-affected"]
    assert mart.impact("fx_rate") == ["agg_monthly_balance", "dim_fx_rate", "fct_gl_adjustment", "fct_gl_entry"] and mart.unresolved_feeds() == []


def test_red_gates_keep_the_published_build(spark, ledger):
    at, context = ledger
    real = mart.landing_of(spark, context.raw)
    before = mart.current(spark, context.warehouse)

    def hurt(name):
        rows = real(name)
        if name == "landing.dim_vendor":
            return rows.unionByName(rows.where("vendor_code = 'V-0001'"))
        if name == "landing.dim_cost_center_src":
            return rows.where("cc_code <> 'CC-005'")
        return rows

    with pytest.raises(mart.GatesFailed) as failure:
        mart.build_and_promote(spark, context.raw, context.warehouse, "bad", hurt)
    assert set(failure.value.failed) == {"unique_dim_vendor"}  # what stands on the dimension is skipped
    only_centre = lambda name: real(name) if name != "landing.dim_cost_center_src" else hurt(name)
    with pytest.raises(mart.GatesFailed) as failure:
        mart.build_and_promote(spark, context.raw, context.warehouse, "worse", only_centre)
    assert "every_entry_is_attributed_gl_entry" in failure.value.failed
    assert mart.current(spark, context.warehouse) == before
    assert spark.read.parquet(f"{context.warehouse}/mart__bworse_audit/every_entry_is_attributed_gl_entry").count() == 1
    with pytest.raises(mart.MartUnavailable):
        mart.promote(spark, context.warehouse, "mart__bnone")
    assert mart.sweep(spark, context.warehouse, keep=0) == ["mart__bbad", "mart__bworse"]


def test_generator_is_deterministic(tmp_path):
    config = generator.Config(periods="2026-01:2026-08", entries_per_period=10, unbalanced_vouchers=True, growing_account=True, late_entries=True, long_tail_anomaly=True, amount_outliers=True, cost_centre_move=True)
    generator.write(config, str(tmp_path / "a"))
    generator.write(config, str(tmp_path / "b"))
    for name in os.listdir(tmp_path / "a"):
        assert (tmp_path / "a" / name).read_bytes() == (tmp_path / "b" / name).read_bytes()
    with pytest.raises(ValueError):
        generator.Config(schema_drift="other")


def test_generator_holds_no_rows(tmp_path):
    """Ten times the rows take no more than twice the memory."""
    peaks = []
    for n in (1000, 10_000):
        tracemalloc.start()
        generator.write(generator.Config(periods="2026-01:2026-01", entries_per_period=n), str(tmp_path / str(n)))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] <= 2 * peaks[0]
    lines = list(generator.entries(generator.Config(periods="2026-01:2026-02", entries_per_period=20)))
    more = list(generator.entries(generator.Config(periods="2026-01:2026-02", entries_per_period=20, late_entries=True, amount_outliers=True)))
    assert [x for x in more if not x["entry_id"].startswith("X-")] == lines  # planted shapes leave the others alone


def test_settings(tmp_path):
    env = tmp_path / ".env"
    env.write_text("# places\nQUILLSTONE_RAW = 'from file'\n\nQUILLSTONE_WAREHOUSE=file too\n", encoding="utf-8")
    got = settings.load(str(env), {"QUILLSTONE_WAREHOUSE": "from environment", "QUILLSTONE_SOURCE": ""})
    assert (got.source, got.raw, got.warehouse) == ("data/source", "from file", "from environment")
    assert settings.load(str(tmp_path / "none"), {}) == settings.Settings()


def judged_by(spark, context, monkeypatch, **options):
    """The periods that a run's judge step looks at, without fitting anything."""
    seen = []
    monkeypatch.setattr(pipeline.quantile, "judge_periods", lambda balances, judged, *a: seen.extend(judged))
    monkeypatch.setattr(mart, "replace_flags", lambda *a: None)
    c = dataclasses.replace(context, **options)
    pipeline._judge(c)
    return c, seen


def test_a_daily_run_judges_what_is_owed_within_its_range(spark, ledger, monkeypatch):
    _, context = ledger
    assert judged_by(spark, context, monkeypatch)[1] == []  # nothing is owed after the daily run
    loader.Affected.record(spark, context.raw, ["2026-02"])
    assert judged_by(spark, context, monkeypatch)[1] == ["2026-02"]  # later months lie beyond the newest one owed
    assert judged_by(spark, context, monkeypatch, periods=["2025-01", "2026-03"])[1] == ["2026-02", "2026-03"]
    assert judged_by(spark, context, monkeypatch, periods=["2026-03", "2026-03"])[1] == ["2026-03"]
    assert judged_by(spark, context, monkeypatch, periods=["2026-01", "2026-02", "2026-03"], force=True)[1] == ["2026-02", "2026-03"]  # a backfill judges its range, as far as there are lags
    with pytest.raises(ValueError, match="range"):
        pipeline._judge(dataclasses.replace(context, force=True))
    c, _ = judged_by(spark, context, monkeypatch)
    loader.Affected.record(spark, context.raw, ["2025-12"])
    pipeline._clear(c)
    assert loader.Affected.load(spark, context.raw).periods == {"2025-12"}  # recorded after this run looked
    loader.Affected.load(spark, context.raw).clear(spark, context.raw)


def test_a_new_version_of_an_account_owes_its_periods(spark, ledger, rows, monkeypatch):
    _, context = ledger
    moved = mart.published(spark, context.warehouse, "dim_account").where("name = 'moved account'").first()
    version = rows("table string, key array<string>, effective_date string", ("dim_account_src", [moved.account_code], str(moved.valid_from)), ("fx_rate", ["EUR"], "1999-01-01"))
    loader.Affected.record(spark, context.raw, versions=version)
    lines = mart.published(spark, context.warehouse, "fct_gl_entry").where(f"account_code = '{moved.account_code}' and accounting_date >= '{moved.valid_from}'")
    want = sorted({r[0] for r in lines.select("accounting_period").collect()})
    assert mart.owed_by_versions(spark, context.warehouse, version) == want and len(want) > 1
    c, judged = judged_by(spark, context, monkeypatch)
    assert set(judged) <= {"2026-02", "2026-03"} and ("2026-03" in want) <= bool(judged)
    pipeline._clear(c)
    assert loader.Affected.load(spark, context.raw).folders == []


def test_export_and_backtest_commands(spark, ledger, tmp_path, monkeypatch):
    _, context = ledger
    kinds = mart.export_landing(spark, context.raw, str(tmp_path / "out"), "r")
    assert kinds["fx_rate"]["rate_to_base"] == "text" and spark.read.parquet(str(tmp_path / "out/r/gl_entry")).count() == raw.read(spark, context.raw, ENTRY).count()
    with pytest.raises(raw.EmptyTable):
        mart.export_landing(spark, str(tmp_path / "none"), str(tmp_path / "out"), "s")
    args = parser().parse_args(["backtest", "--random-state", "7", "--splits", "2"])
    assert (args.random_state, args.splits) == (7, 2)
    with pytest.raises(SystemExit):
        parser().parse_args(["backfill"])  # a range is needed


def test_run_log_refuses_nonsense():
    start = {"event": "started", "run_id": "r", "at": "t"}
    assert runlog.fold([start])["r"].status == "interrupted"
    for bad in ([start, start], [{**start, "event": "finished", "status": "x"}], [start, {**start, "event": "step_finished", "step": "s", "status": "x"}]):
        with pytest.raises(runlog.LogError):
            runlog.fold(bad)


def test_commands(tmp_path, capsys):
    assert main(["generate", "--periods", "2026-01:2026-01", "--entries-per-period", "4", "--out", str(tmp_path / "s")]) == 0
    assert main(["impact", "gl_entry"]) == 0 and "fct_gl_entry" in capsys.readouterr().out
    assert main(["impact", "nothing"]) == 2 and main(["nonsense"]) == 2
    assert parser().parse_args(["backfill", "--periods", "2026-01"]).command == "backfill"
