"""Column functions and period arithmetic shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The open end of an interval, and the separator of rendered values.
OPEN_END = "9999-12-31"
UNIT_SEPARATOR = "\x1f"
#: Account types whose balance is debit minus credit.
DEBIT_NORMAL = ("asset", "expense")


@dataclass(frozen=True)
class Windows:
    """The comparison windows; the aggregate and the dirty closure both read them from here."""

    mom: int = 1
    yoy: int = 12
    rolling: int = 3

    def reach(self) -> set[int]:
        """How many months after a change its traces end up in a comparison."""
        return {0, self.mom, self.yoy, *range(self.rolling)}


def rendered(columns: Sequence[Column]) -> Column:
    """Values as `length:value`, joined by a separator: different rows never render alike. Null gives null."""
    parts: list[Column] = []
    for c in columns:
        text = c.cast("string")
        parts += [F.lit(UNIT_SEPARATOR)] * bool(parts) + [F.length(text).cast("string"), F.lit(":"), text]
    return F.concat(*parts)


def fingerprint(columns: Sequence[Column]) -> Column:
    return F.sha2(rendered(columns), 256)


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def period_of(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def period_start(period: Column) -> Column:
    return F.to_date(F.concat(period, F.lit("-01")), "yyyy-MM-dd")


def period_end(period: Column) -> Column:
    return F.last_day(period_start(period))


def signed(account_type: Column, debit: Column, credit: Column) -> Column:
    """Debit-normal types count debit minus credit; all others, null too, credit minus debit."""
    return F.when(account_type.isin(*DEBIT_NORMAL), debit - credit).otherwise(credit - debit)


def share(delta: Column, base: Column) -> Column:
    """delta / |base| with six places; null where the base is null or 0."""
    return F.when(base != 0, (delta / F.abs(base)).cast("decimal(18,6)"))


def pinball(actual: Column, predicted: Column, q: float) -> Column:
    gap = actual - predicted
    return F.when(gap > 0, q * gap).otherwise((q - 1) * gap)


def month_flags(period: Column) -> list[Column]:
    month = F.substring(period, 6, 2).cast("int")
    return [(month == m).cast("double").alias(f"month_{m}") for m in range(1, 13)]


# ---- periods as text, on the driver ----


def _number(period: str) -> int:
    year, _, month = period.partition("-")
    if not (len(year) == 4 and len(month) == 2 and year.isdigit() and month.isdigit() and 1 <= int(month) <= 12):
        raise ValueError(f"{period!r} is not YYYY-MM")
    return int(year) * 12 + int(month) - 1


def shift(period: str, months: int) -> str:
    year, month = divmod(_number(period) + months, 12)
    return f"{year:04d}-{month + 1:02d}"


def period_range(first: str, last: str) -> list[str]:
    if _number(last) < _number(first):
        raise ValueError(f"{last} lies before {first}")
    return [shift(first, i) for i in range(_number(last) - _number(first) + 1)]


def parse_periods(text: str) -> list[str]:
    """`A:B` is an inclusive range, otherwise a comma-separated list."""
    if ":" in text:
        first, _, last = text.partition(":")
        return period_range(first, last)
    periods = [p.strip() for p in text.split(",") if p.strip()]
    for p in periods:
        _number(p)
    return sorted(set(periods))


def closure(periods: Iterable[str], windows: Windows | None = None, last: str | None = None) -> list[str]:
    """The periods whose figures a change in these reaches: M, the rolling window, month and year on."""
    periods = set(periods)
    if not periods:
        return []
    bound = last or max(periods)
    return sorted({shift(p, s) for p in periods for s in (windows or Windows()).reach() if shift(p, s) <= bound})
