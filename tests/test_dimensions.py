"""Intervals, as-of boundaries and the edge cases of the dense balance."""

import datetime
from decimal import Decimal

import pytest

from quillstone.functions.core import Windows, closure, parse_periods, shift
from quillstone.operators import gates
from quillstone.operators.ledger import monthly_balance
from quillstone.operators.scd2 import asof_join, renamed, scd2

D = datetime.date.fromisoformat


@pytest.fixture
def dim(rows):
    source = rows("k string, eff string, attr string", ("K", "2026-01-01", "A"), ("K", "2026-02-01", "A"), ("K", "2026-04-01", "B"), ("K", "2026-07-01", "A"))
    return scd2(source, ["k"], ["attr"], "eff")


def test_consecutive_equal_versions_collapse(dim):
    got = [(r.attr, str(r.valid_from), str(r.valid_to), r.is_current) for r in dim.orderBy("valid_from").collect()]
    assert got == [("A", "2026-01-01", "2026-03-31", False), ("B", "2026-04-01", "2026-06-30", False), ("A", "2026-07-01", "9999-12-31", True)]
    assert gates.interval_faults(dim, ["k"]).count() == 0


@pytest.mark.parametrize("strategy", ["broadcast", "months"])
def test_asof_boundaries(rows, dim, strategy):
    fact = rows("k string, day date", ("K", D("2026-03-31")), ("K", D("2026-04-01")), ("K", D("2025-12-31")), (None, D("2026-04-01")))
    joined = renamed(asof_join(fact, dim, {"k": "k"}, "day", strategy=strategy), attr="attr")
    assert sorted((str(r.day), r.attr) for r in joined.collect()) == [("2026-03-31", "A"), ("2026-04-01", "B")]
    left = renamed(asof_join(fact, dim, {"k": "k"}, "day", "left", strategy), attr="attr")
    assert left.count() == 4 and left.where("attr is null").count() == 2


def test_asof_of_empty_facts(rows, dim):
    assert asof_join(rows("k string, day date"), dim, {"k": "k"}, "day", strategy="months").count() == 0


LINE = "account_code string, cost_center_code string, accounting_period string, accounting_date date, account_type string, amount_dr_base decimal(32,2), amount_cr_base decimal(32,2), adjustment_type string"


def line(day, kind="asset", dr="0", cr="0", adjustment=None, account="1"):
    return (account, "C", day[:7], D(day), kind, Decimal(dr), Decimal(cr), adjustment)


def balance(rows, lines, **options):
    every = rows(LINE, *lines)
    out = monthly_balance(every.where("adjustment_type is null"), every.where("adjustment_type is not null"), **options)
    return {(r.account_code, r.accounting_period): r for r in out.collect()}


def test_gaps_are_filled_and_types_borrowed(rows):
    got = balance(rows, [line("2026-01-05", dr="10"), line("2026-03-05", dr="5"), line("2026-03-06", "revenue", cr="7", account="2")])
    assert got["1", "2026-02"].balance_as_restated == 0 and got["1", "2026-02"].account_type == "asset"
    assert got["2", "2026-01"].account_type == "revenue" and got["2", "2026-03"].balance_as_reported == 7
    assert [got["1", f"2026-0{m}"].rolling_periods for m in (1, 2, 3)] == [1, 2, 3]


def test_type_of_the_latest_date_then_greatest_text(rows):
    got = balance(rows, [line("2026-01-05", "asset"), line("2026-01-25", "expense"), line("2026-01-25", "asset")])
    assert got["1", "2026-01"].account_type == "expense"


def test_percentages(rows):
    got = balance(rows, [line("2026-01-05"), line("2026-02-05", dr="50"), line("2026-03-05", cr="100"), line("2026-04-05", cr="50")])
    assert got["1", "2026-02"].balance_delta_mom == 50 and got["1", "2026-02"].balance_pct_mom is None
    assert got["1", "2026-04"].balance_pct_mom == Decimal("0.500000")


def test_corrections_and_restatements(rows):
    got = balance(rows, [line("2026-01-05", dr="10"), line("2026-01-06", dr="3", adjustment="correction"), line("2026-01-07", dr="4", adjustment="restatement")])["1", "2026-01"]
    assert (got.balance_as_reported, got.restatement_delta, got.balance_as_restated, got.debit_total) == (13, 4, 17, 13)


def test_a_pair_with_restatements_only(rows):
    lines = [line("2026-01-07", dr="4", adjustment="restatement")]
    got = balance(rows, lines)["1", "2026-01"]
    assert got.account_type is None and got.balance_as_restated == -4
    assert balance(rows, lines, type_source="all")["1", "2026-01"].balance_as_restated == 4


def test_a_given_range_is_honoured(rows):
    assert len(balance(rows, [line("2026-02-05", dr="1")], periods=("2026-01", "2026-04"))) == 4
    assert balance(rows, []) == {}


def test_period_arithmetic():
    assert shift("2026-01", -1) == "2025-12" and parse_periods("2026-11:2027-01") == ["2026-11", "2026-12", "2027-01"]
    assert closure(["2026-01"], last="2030-01") == ["2026-01", "2026-02", "2026-03", "2027-01"]
    assert closure(["2026-01", "2026-03"]) == ["2026-01", "2026-02", "2026-03"]
    assert closure([]) == [] and closure(["2026-01"], Windows(1, 2, 1), "2027-01") == ["2026-01", "2026-02", "2026-03"]
    with pytest.raises(ValueError):
        parse_periods("2026-13")
