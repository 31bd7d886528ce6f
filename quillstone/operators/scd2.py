"""Effective-dated dimensions as closed validity intervals, and point-in-time joins to them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstone.functions.core import OPEN_END, empty_to_null, fingerprint

#: A dimension of at most this many rows (counted) may be broadcast.
BROADCAST_ROWS = 100_000
#: A key with more versions than this is matched by key and month: equal keys alone would try them all.
MANY_VERSIONS = 32


def scd2(source: DataFrame, natural_key: Sequence[str], attributes: Sequence[str], effective: str, casts: Mapping[str, str] | None = None, nullable: Sequence[str] = ()) -> DataFrame:
    """Versions of a natural key as intervals [valid_from, valid_to].

    Consecutive versions with equal attributes collapse (A, B, A stays three). Attributes are cast
    and emptied to null after the comparison. One shuffle on the natural key serves both windows.
    """
    casts = casts or {}
    order = Window.partitionBy(*natural_key).orderBy(effective)
    marked = source.withColumn("__print", fingerprint([F.col(a) for a in attributes])).withColumn("__before", F.lag("__print").over(order))
    versions = marked.where(F.col("__before").isNull() | (F.col("__before") != F.col("__print"))).withColumn("__next", F.lead(effective).over(order))
    start = F.col(effective).cast("date")

    def shaped(name: str):
        c = F.col(name)
        if name in nullable:
            c = empty_to_null(c)
        return c.cast(casts[name]).alias(name) if name in casts else c.alias(name)

    key = fingerprint([*(F.col(k) for k in natural_key), F.date_format(start, "yyyy-MM-dd")])
    return versions.select(
        key.alias("surrogate_key"), *natural_key, *(shaped(a) for a in attributes), start.alias("valid_from"),
        F.coalesce(F.date_sub(F.col("__next").cast("date"), 1), F.lit(OPEN_END).cast("date")).alias("valid_to"), F.col("__next").isNull().alias("is_current"),
    )


def asof_join(fact: DataFrame, dim: DataFrame, keys: Mapping[str, str], date: str, how: str = "inner", strategy: str = "auto") -> DataFrame:
    """fact with the dim version that is valid at fact's date: equal keys and date in [valid_from, valid_to].

    keys maps fact columns to dim columns. By `months`, versions are cut into the months they cover
    and matched by key and month: a key with many versions tries few of them, and a key with most of
    the facts is spread over its months. Months after the last one in which any version begins count
    as that one, so open ends stay finite and only the dim is looked at. `auto` counts the dim: small
    with few versions per key is broadcast, anything else goes by months, broadcast if the cut dim is
    small.
    """
    dim = dim.select(*[F.col(c).alias(f"__d_{c}") for c in dim.columns])
    same = [F.col(f) == F.col(f"__d_{d}") for f, d in keys.items()]
    valid = F.col(date).between(F.col("__d_valid_from"), F.col("__d_valid_to"))
    month = lambda c: F.year(c) * 12 + F.month(c)
    first = month(F.col("__d_valid_from"))
    each = dim.groupBy(*[f"__d_{d}" for d in keys.values()]).agg(F.count("*").alias("n"), F.max(first).alias("last"), F.min(first).alias("start"))
    nothing = lambda c, name: F.coalesce(c, F.lit(0)).alias(name)
    size = each.agg(nothing(F.sum("n"), "rows"), nothing(F.max("n"), "most"), nothing(F.max("last"), "last"), F.count("*").alias("keys"), nothing(F.sum("start"), "starts")).first()
    if strategy == "auto":
        strategy = "broadcast" if size["rows"] <= BROADCAST_ROWS and size["most"] <= MANY_VERSIONS else "months"
    if strategy == "broadcast":
        return fact.join(F.broadcast(dim), [*same, valid], how)
    end = F.least(month(F.col("__d_valid_to")), F.lit(size["last"]))
    # A key's intervals don't overlap, so cut they are its months from first to last, and one more for each version at most.
    n = size["keys"] * (size["last"] + 1) - size["starts"] + size["rows"]
    cut = dim.where(first <= end).withColumn("__d_month", F.explode(F.sequence(first, end)))
    binned = fact.withColumn("__month", F.least(month(F.col(date)), F.lit(size["last"])))
    return binned.join(F.broadcast(cut) if n <= BROADCAST_ROWS else cut, [*same, F.col("__month") == F.col("__d_month"), valid], how).drop("__month", "__d_month")


def renamed(joined: DataFrame, **names: str) -> DataFrame:
    """Name some of the joined version's columns (new name = dim column) and drop the others."""
    picked = joined.withColumns({new: F.col(f"__d_{old}") for new, old in names.items()})
    return picked.drop(*[c for c in picked.columns if c.startswith("__d_")])
