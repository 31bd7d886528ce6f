"""A table as named parts: a manifest says in which folder each part's rows are, and one new manifest changes them all."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from . import files


def held(spark: SparkSession, base: str) -> dict[str, str]:
    """Part -> folder below base, by the newest manifest."""
    return json.loads(files.read_text(spark, f"{base}/_manifest") or "{}")


def replace(rows: DataFrame, base: str, by: tuple[str, ...], gone: Iterable[str] = (), whole: str | None = None) -> None:
    """Write rows as parts named by their values of the columns `by` (or as the one part `whole`), in place of those there.

    Parts in `gone` that rows don't bring are dropped. The rows go to a folder of their own first, and
    the manifest changes last, so a stop before that leaves every part as it was; Conflict is raised if
    another writer has changed it in between. Folders that neither this manifest nor the one before
    names are deleted afterwards.
    """
    spark = rows.sparkSession
    number, before = files.version(spark, f"{base}/_manifest"), held(spark, base)
    data = f"data-{uuid.uuid4().hex}"
    if whole is None:
        rows.write.partitionBy(*by).parquet(f"{base}/{data}")
        found = [""]  # a folder level for each column
        for _ in by:
            found = [f"{f}/{n}" for f in found for n in files.names(spark, f"{base}/{data}{f}") if "=" in n]
        written = {"/".join(level.partition("=")[2] for level in f.strip("/").split("/")): f"{data}{f}" for f in found}
    else:
        rows.write.parquet(f"{base}/{data}")
        written = {whole: data}
    left = set(gone)
    now = {p: f for p, f in before.items() if p not in left} | written
    files.write_text(spark, f"{base}/_manifest", json.dumps(now, sort_keys=True), number)
    used = {f.partition("/")[0] for f in (*before.values(), *now.values())}
    for name in files.names(spark, base):
        if name.startswith("data-") and name not in used:
            files.delete(spark, f"{base}/{name}")
