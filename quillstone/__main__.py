"""Commands: generate, validate, load, affected, export, runs, daily, backfill, judge, backtest, impact."""

from __future__ import annotations

import argparse
import dataclasses
import json
import sys

from quillstone import settings
from quillstone.functions.core import parse_periods


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("quillstone").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def parser() -> argparse.ArgumentParser:
    from quillstone.sources.generator import DRIFTS, Config

    top = argparse.ArgumentParser(prog="quillstone", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)

    def add(name: str, *options: tuple) -> argparse.ArgumentParser:
        p = sub.add_parser(name)
        for flag, settings in options:
            p.add_argument(flag, **settings)
        return p

    own = settings.load()
    source, raw = ("--source", {"default": own.source}), ("--raw", {"default": own.raw})
    warehouse, run_id = ("--warehouse", {"default": own.warehouse}), ("--run-id", {"default": None})
    tables, family = ("--table", {"action": "append", "dest": "tables"}), ("--family", {"default": "quantile_linear"})
    g = add("generate", ("--seed", {"type": int, "default": 42}), ("--periods", {"default": "2026-01:2026-12"}), ("--entries-per-period", {"type": int, "default": 1000}), ("--out", {"default": "data/source"}), ("--schema-drift", {"choices": DRIFTS, "default": "none"}), ("--schema-drift-table", {"default": "gl_entry"}))
    for f in dataclasses.fields(Config):
        if isinstance(f.default, bool):
            g.add_argument(f"--enable-{f.name.replace('_', '-')}", dest=f.name, action="store_true")
    add("validate", source, tables, ("--max-findings", {"type": int, "default": 50}))
    add("load", source, raw, tables, ("--overlap-days", {"type": int, "default": 7}), ("--full", {"action": "store_true"}), run_id)
    add("affected", raw, ("--clear", {"action": "store_true"}))
    add("runs", raw, ("--run", {"default": None}), ("--limit", {"type": int, "default": 20}))
    add("export", raw, ("--out", {"default": own.landing}), run_id)
    for name in ("daily", "backfill"):
        add(name, source, raw, warehouse, ("--periods", {"default": None, "required": name == "backfill"}), run_id, family, ("--orchestrator", {"default": None}), ("--orchestrator-run-id", {"default": None}))
    add("judge", warehouse, ("--periods", {"nargs": "+", "required": True}), ("--run-id", {"required": True}), family)
    add("backtest", warehouse, ("--splits", {"type": int, "default": 5}), ("--random-state", {"type": int, "default": 0}), ("--out", {"default": "backtest.json"}))
    add("impact", ("table", {}))
    return top


def main(argv: list[str] | None = None) -> int:
    """0: done; 1: the data or a step failed; 2: wrong use or state."""
    try:
        a = parser().parse_args(argv)
    except SystemExit as stop:
        return int(stop.code or 0)
    from quillstone.plans import mart, pipeline, runlog
    from quillstone.sources import files, generator, loader
    from quillstone.sources import raw as raw_layer

    try:
        if a.command == "generate":
            names = {f.name for f in dataclasses.fields(generator.Config)}
            generator.write(generator.Config(**{k: v for k, v in vars(a).items() if k in names}), a.out)
        elif a.command == "impact":
            print("\n".join(mart.impact(a.table)))
        else:
            spark = _session()
            if a.command == "validate":
                from quillstone.operators.validate import validate_source

                reports = validate_source(spark, a.source, a.tables, a.max_findings)
                for r in reports:
                    print(f"{r.table}: {r.rows} rows, {r.total} findings")
                    for f in r.findings:
                        print(f"  {f.kind} {f.column} {'' if f.row is None else f'row {f.row} '}{f.message}")
                return int(any(r.failed for r in reports))
            if a.command == "load":
                for r in loader.load_source(spark, a.source, a.raw, a.run_id or runlog.new_run_id(), a.tables, a.overlap_days, a.full):
                    print(f"{r.table}: {r.rows_read} read, {r.inserted} inserted, {r.updated} updated, {r.evicted} moved")
            elif a.command == "affected":
                held = loader.Affected.load(spark, a.raw)
                print(json.dumps({"periods": sorted(held.periods), "dimension_versions": held.versions(spark).count()}))
                if a.clear:
                    held.clear(spark, a.raw)
            elif a.command == "export":
                for table, kinds in mart.export_landing(spark, a.raw, a.out, a.run_id or runlog.new_run_id()).items():
                    print(f"{table}: " + ", ".join(f"{c} {k}" for c, k in kinds.items()))
            elif a.command == "runs":
                for r in runlog.RunLog(spark, a.raw).runs(None if a.run else a.limit):
                    if a.run in (None, r.run_id):
                        print(f"{r.run_id} {r.status} " + " ".join(f"{s}={d['status']}" for s, d in r.attempts[-1].steps.items()))
            elif a.command in pipeline.PIPELINES:
                context = pipeline.Context(spark, a.source, a.raw, a.warehouse, a.run_id or runlog.new_run_id(), parse_periods(a.periods) if a.periods else None, a.family, force=a.command == "backfill")
                origin = {k: v for k, v in (("orchestrator", a.orchestrator), ("orchestrator_run_id", a.orchestrator_run_id)) if v}
                print(pipeline.run(a.command, context, **origin))
            elif a.command == "judge":
                from quillstone.operators.quantile import judge_periods

                mart.replace_flags(judge_periods(mart.balances(spark, a.warehouse), a.periods, a.run_id, a.family), a.warehouse, a.periods, a.family)
            elif a.command == "backtest":
                from quillstone.operators.quantile import backtest

                with open(a.out, "w", encoding="utf-8") as out:
                    json.dump({"random_state": a.random_state, "splits": a.splits, "arms": backtest(mart.balances(spark, a.warehouse), a.splits, a.random_state)}, out, indent=1)
    except raw_layer.EmptyTable as error:  # a LookupError, but of the data
        print(error, file=sys.stderr)
        return 1
    except (loader.StateError, runlog.LogError, KeyError, FileNotFoundError) as error:
        print(error, file=sys.stderr)
        return 2
    except (loader.Restated, mart.GatesFailed, mart.MartUnavailable, mart.WrongWarehouse, files.LockTimeout, files.Conflict, pipeline.ValidationFailed, ValueError) as error:
        print(error, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
