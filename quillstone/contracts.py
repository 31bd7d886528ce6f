"""Source contracts: hand-written schemas with rules, loaded from YAML and checked on loading."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from functools import lru_cache

import yaml

#: The column types and the modifiers that each may carry.
MODIFIERS = {"string": {"allowed"}, "integer": {"min"}, "decimal": {"min", "scale"}, "date": set()}
TOP_LEVEL = {"table", "primary_key", "columns", "watermark", "partition_by", "rows_are_immutable", "feeds", "row_constraints"}
REQUIRED = {"table", "primary_key", "columns", "feeds"}
CONSTRAINTS = {"not_after": {"type", "earlier", "later"}, "exactly_one_nonzero": {"type", "columns"}}


class ContractError(ValueError):
    pass


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    nullable: bool
    allowed: tuple[str, ...] = ()
    min: str | None = None
    scale: int | None = None


@dataclass(frozen=True)
class Contract:
    table: str
    primary_key: tuple[str, ...]
    fields: tuple[Field, ...]
    watermark: str | None = None
    partition_by: str | None = None
    rows_are_immutable: bool = False
    feeds: tuple[str, ...] = ()
    constraints: tuple[dict, ...] = field(default=(), hash=False)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    def column(self, name: str) -> Field:
        return next(f for f in self.fields if f.name == name)


def _need(ok: bool, where: str, what: str) -> None:
    if not ok:
        raise ContractError(f"{where}: {what}")


def _field(table: str, raw: dict) -> Field:
    _need(isinstance(raw, dict) and isinstance(raw.get("name"), str), table, "a column needs a name")
    where = f"{table}.{raw['name']}"
    kind = raw.get("type")
    _need(kind in MODIFIERS, where, f"type must be one of {sorted(MODIFIERS)}")
    _need(isinstance(raw.get("nullable"), bool), where, "nullable must be true or false")
    extra = set(raw) - {"name", "type", "nullable"}
    _need(extra <= MODIFIERS[kind], where, f"{sorted(extra - MODIFIERS[kind])} can't stand on a {kind}")
    allowed = raw.get("allowed", [])
    _need("allowed" not in raw or isinstance(allowed, list) and allowed and all(isinstance(x, str) for x in allowed), where, "allowed must be a list of strings")
    _need("min" not in raw or isinstance(raw["min"], int | float) and not isinstance(raw["min"], bool), where, "min must be a number")
    _need("scale" not in raw or isinstance(raw["scale"], int) and not isinstance(raw["scale"], bool) and raw["scale"] >= 0, where, "scale must be a whole number, 0 or more")
    return Field(raw["name"], kind, raw["nullable"], tuple(allowed), str(raw["min"]) if "min" in raw else None, raw.get("scale"))


def _is_feed(name: str) -> bool:
    """Two names of lower-case letters, digits and low lines, joined by one dot, neither beginning with a digit."""
    parts = name.split(".")
    return len(parts) == 2 and all(p.isidentifier() and p.isascii() and p == p.lower() for p in parts)


def parse(raw: dict) -> Contract:
    """A contract from its YAML mapping; every fault is a ContractError that names the place."""
    _need(isinstance(raw, dict), "contract", "must be a mapping")
    table = raw.get("table", "contract")
    _need(set(raw) <= TOP_LEVEL, table, f"unknown keys {sorted(set(raw) - TOP_LEVEL)}")
    _need(REQUIRED <= set(raw), table, f"missing keys {sorted(REQUIRED - set(raw))}")
    fields = tuple(_field(table, c) for c in raw["columns"])
    names = [f.name for f in fields]
    _need(len(set(names)) == len(names), table, "a column is declared twice")
    key = raw["primary_key"]
    _need(isinstance(key, list) and key and set(key) <= set(names) and len(set(key)) == len(key), table, "primary_key must name declared columns, each once")
    by_name = {f.name: f for f in fields}
    for role in ("watermark", "partition_by"):
        if role in raw:
            f = by_name.get(raw[role])
            _need(f is not None and f.type == "date" and not f.nullable, table, f"{role} must name a date column that is not nullable")
    _need(isinstance(raw.get("rows_are_immutable", False), bool), table, "rows_are_immutable must be true or false")
    feeds = raw["feeds"]
    _need(isinstance(feeds, list) and feeds and all(isinstance(x, str) and _is_feed(x) for x in feeds), table, "feeds must name at least one schema.table")
    for c in raw.get("row_constraints", []):
        _need(isinstance(c, dict) and c.get("type") in CONSTRAINTS and set(c) == CONSTRAINTS[c["type"]], table, "a row constraint has exactly its own keys")
        used = [c["earlier"], c["later"]] if c["type"] == "not_after" else c["columns"]
        _need(set(used) <= set(names), table, "a row constraint names an undeclared column")
    return Contract(table, tuple(key), fields, raw.get("watermark"), raw.get("partition_by"), raw.get("rows_are_immutable", False), tuple(feeds), tuple(raw.get("row_constraints", [])))


@lru_cache(maxsize=1)
def all_contracts() -> dict[str, Contract]:
    path = os.path.join(os.path.dirname(__file__), "contracts.yaml")
    with open(path, encoding="utf-8") as source:
        found = [parse(c) for c in yaml.safe_load_all(source)]
    return {c.table: c for c in found}
