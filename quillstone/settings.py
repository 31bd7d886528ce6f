"""Where things are: from the environment, else from a .env file, else as here."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    source: str = "data/source"
    raw: str = "data/raw"
    warehouse: str = "data/warehouse"
    landing: str = "data/landing"


def _pairs(path: str) -> dict[str, str]:
    """NAME=value lines; blank ones and those that begin with # don't count, quotes around a value are dropped."""
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as source:
        lines = [line.strip() for line in source]
    named = (line.partition("=") for line in lines if line and not line.startswith("#") and "=" in line)
    return {name.strip(): value.strip().strip("\"'") for name, _, value in named}


def load(env_file: str = ".env", environment: dict[str, str] | None = None) -> Settings:
    """QUILLSTONE_<NAME> of each setting; an empty value counts as none."""
    given = {**_pairs(env_file), **{k: v for k, v in (os.environ if environment is None else environment).items() if v}}
    return Settings(**{f.name: given.get(f"QUILLSTONE_{f.name.upper()}") or f.default for f in fields(Settings)})
