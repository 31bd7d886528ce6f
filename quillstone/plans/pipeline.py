"""Ordered steps with a record of each run."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession

from quillstone.functions.core import closure
from quillstone.operators import quantile
from quillstone.operators.validate import validate_source
from quillstone.sources import loader

from . import mart
from .runlog import RunLog, new_run_id


class ValidationFailed(RuntimeError):
    pass


@dataclass
class Context:
    spark: SparkSession
    source: str
    raw: str
    warehouse: str
    run_id: str
    periods: Sequence[str] | None = None  # the range reported on
    family: str = "quantile_linear"
    force: bool = False  # judge the whole range, owed or not
    owed: loader.Affected | None = None  # what this run judges, to be cleared at its end


@dataclass(frozen=True)
class Step:
    name: str
    run: Callable[[Context], dict]


def _validate(c: Context) -> dict:
    reports = validate_source(c.spark, c.source)
    failed = [r.table for r in reports if r.failed]
    if failed:
        raise ValidationFailed(f"incompatible: {', '.join(failed)}")
    return {"rows_scanned": sum(r.rows for r in reports), "findings": sum(r.total for r in reports)}


def _load(c: Context) -> dict:
    reports = loader.load_source(c.spark, c.source, c.raw, c.run_id)
    return {"rows_read": sum(r.rows_read for r in reports), "inserted": sum(r.inserted for r in reports), "updated": sum(r.updated for r in reports)}


def _mart_load(c: Context) -> dict:
    landing = mart.landing_of(c.spark, c.raw)
    names = sorted({n for m in mart.MODELS.values() for n in m.needs if n.startswith("landing.")})
    for name in names:
        landing(name).createOrReplaceTempView(name.replace(".", "_"))
    return {"tables": len(names)}


def _build(c: Context) -> dict:
    verdicts = mart.build_and_promote(c.spark, c.raw, c.warehouse, c.run_id)
    try:
        swept = len(mart.sweep(c.spark, c.warehouse))
    except Exception as error:  # old builds are only disk; they don't fail a published run
        swept = str(error)
    return {"gates_passed": len(verdicts.passed), "swept": swept}


def _judge(c: Context) -> dict:
    """Judge the range (force), or the closure of what is owed as far as it lies within the range.

    Owed are the periods whose content has changed and those whose entries fall under new versions of
    a dimension.
    """
    if c.force and not c.periods:
        raise ValueError("a range of periods is needed to force")
    c.owed = loader.Affected.load(c.spark, c.raw)
    if c.force:
        periods = list(c.periods)
    else:
        owed = c.owed.periods | set(mart.owed_by_versions(c.spark, c.warehouse, c.owed.versions(c.spark)) if c.owed.folders else ())
        first, last = (min(c.periods), max(c.periods)) if c.periods else ("", max(owed, default=None))
        periods = [p for p in closure(owed, last=last) if p >= first]
    balances = mart.balances(c.spark, c.warehouse)
    there = {r[0] for r in balances.select("accounting_period").distinct().collect()}
    judged = [p for p in periods if p in there and sum(q < p for q in there) > max(quantile.LAGS)]
    if judged:
        flags = quantile.judge_periods(balances, judged, c.run_id, c.family)
        mart.replace_flags(flags, c.warehouse, judged, c.family)
    return {"judged": judged, "not_judged": [p for p in periods if p not in judged]}


def _clear(c: Context) -> dict:
    owed = c.owed or loader.Affected.load(c.spark, c.raw)
    owed.clear(c.spark, c.raw)
    return {"cleared": len(owed.periods)}


BACKFILL = [Step("mart-load", _mart_load), Step("dbt-build", _build), Step("judge", _judge), Step("clear-affected", _clear)]
DAILY = [Step("validate", _validate), Step("load", _load), *BACKFILL]
PIPELINES = {"daily": DAILY, "backfill": BACKFILL}


def run(pipeline: str, context: Context, **origin) -> str:
    """Run the steps in order; the first failure ends the run and is raised again after it is recorded."""
    log = RunLog(context.spark, context.raw)
    context.run_id = context.run_id or new_run_id()
    log.append("started", context.run_id, pipeline=pipeline, **origin)
    try:
        for step in PIPELINES[pipeline]:
            log.append("step_started", context.run_id, step=step.name)
            try:
                detail = step.run(context)
            except Exception as error:
                log.append("step_finished", context.run_id, step=step.name, status="failed", detail={"error": str(error)[:500]})
                raise
            log.append("step_finished", context.run_id, step=step.name, status="succeeded", detail=detail)
    except Exception:
        log.append("finished", context.run_id, status="failed")
        raise
    log.append("finished", context.run_id, status="succeeded")
    return context.run_id
