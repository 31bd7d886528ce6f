"""The run record: an append-only log of events, folded into runs."""

from __future__ import annotations

import datetime
import json
import secrets
import urllib.parse
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from quillstone.sources import files


class LogError(ValueError):
    pass


def new_run_id(now: datetime.datetime | None = None) -> str:
    now = now or datetime.datetime.now(datetime.UTC)
    return f"{now:%Y%m%dT%H%M%SZ}-{secrets.token_hex(3)}"


@dataclass
class Attempt:
    started: str
    steps: dict[str, dict] = field(default_factory=dict)
    status: str = "interrupted"
    detail: dict = field(default_factory=dict)


@dataclass
class Run:
    run_id: str
    attempts: list[Attempt] = field(default_factory=list)

    @property
    def status(self) -> str:
        return self.attempts[-1].status


class RunLog:
    """Events: started, step_started, step_finished, finished. A run without an end was interrupted.

    Each event is a file of its own, flushed to disk and never rewritten: a folder per run, numbered
    in order. So recording an event costs the same however many there are, and writers of different
    runs can't lose each other's.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, f"{root}/_state/runs"

    def _folder(self, run_id: str) -> str:
        return f"{self.path}/{urllib.parse.quote(run_id, safe='')}"

    def append(self, event: str, run_id: str, **detail) -> None:
        while True:
            own = self._events(run_id)
            entry = {"event": event, "run_id": run_id, "at": datetime.datetime.now(datetime.UTC).isoformat(), **detail}
            fold([*own, json.loads(json.dumps(entry))])  # an event that doesn't fit is refused before it is written
            if files.append_numbered(self.spark, self._folder(run_id), len(own) + 1, json.dumps(entry, sort_keys=True)):
                return

    def _events(self, run_id: str) -> list[dict]:
        out = []
        for name, text in files.read_numbered(self.spark, self._folder(run_id)):
            try:
                out.append(json.loads(text))
            except ValueError as error:
                raise LogError(f"{run_id}/{name} is not JSON") from error
        return out

    def events(self) -> list[dict]:
        """All events, by time."""
        runs = [urllib.parse.unquote(n) for n in files.names(self.spark, self.path)]
        return sorted((e for r in runs for e in self._events(r)), key=lambda e: e["at"])

    def runs(self, limit: int | None = None) -> list[Run]:
        """Newest first."""
        found = list(fold(self.events()).values())[::-1]
        return found[:limit] if limit is not None else found


def fold(events: list[dict]) -> dict[str, Run]:
    runs: dict[str, Run] = {}
    open_: dict[str, Attempt] = {}
    for e in events:
        run_id, kind = e["run_id"], e["event"]
        attempt = open_.get(run_id)
        if kind == "started":
            if attempt is not None:
                raise LogError(f"{run_id} was started twice")
            open_[run_id] = Attempt(e["at"])
            runs.setdefault(run_id, Run(run_id)).attempts.append(open_[run_id])
            continue
        if attempt is None:
            raise LogError(f"{run_id}: {kind} outside of a run")
        if kind == "step_started":
            attempt.steps[e["step"]] = {"status": "interrupted", "at": e["at"]}
        elif kind == "step_finished":
            if e["step"] not in attempt.steps:
                raise LogError(f"{run_id}: step {e['step']} ended before it began")
            attempt.steps[e["step"]] |= {"status": e["status"], "detail": e.get("detail", {})}
        elif kind == "finished":
            attempt.status, attempt.detail = e["status"], e.get("detail", {})
            del open_[run_id]
        else:
            raise LogError(f"{run_id}: unknown event {kind}")
    return runs
