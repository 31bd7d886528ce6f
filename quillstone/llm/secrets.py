"""Secret scans with DataFrame functions only.

Base patterns give spans in each text. The method then looks at the whole corpus: the hash of each
candidate value is counted by distinct repositories. A value in many of them is a widely copied
example; one that stays with its owner looks live. Long mixed runs without a telling name (kind
`generic`) are added to a document's spans only when they look live.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

# The base patterns and their least lengths, in the order of the kinds.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{14,}"  # a run of 18 or more
HEX = "[0-9a-f]{16,}"
GENERIC = r"(?<![A-Za-z0-9+_-])(?=[A-Za-z+_-]*[0-9])(?=[0-9+_-]*[A-Za-z])[A-Za-z0-9+_-]{20,}"
KINDS = ("assign", "access", "hex", "generic")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
LEAST_VALUE = 12

#: A value found in more repositories than this is a copied example.
MAX_OWNERS = 2
#: Candidates of one value that a task takes, and matches of a text that one fold gathers.
PART, BLOCK = 100_000, 128
_SPANS = "array<struct<start:long,kind:int,stop:long,value:string>>"


def _blocks(items: Column) -> Column:
    """An array cut into arrays of BLOCK elements: a fold that copies what it has gathered stays short within each."""

    def cut(held: Column) -> Column:
        n = F.size(held["items"])
        numbers = F.when(n > 0, F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int"))).otherwise(F.expr("cast(array() as array<int>)"))
        return F.transform(numbers, lambda k: F.slice(held["items"], k * BLOCK + 1, F.lit(BLOCK)))

    # An array of one binds the items, which a lambda would otherwise compute anew for every block.
    return F.transform(F.array(F.struct(items.alias("items"))), cut)[0]


def _found(text: Column, kind: int, pattern: str, worth: Column, least: int = 0) -> Column:
    """Spans of a pattern: the pieces between matches and the matches themselves add up to positions.

    They add up within blocks of matches, then over the blocks, so the work grows with the matches
    and not with their square.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g).cast("long"))
    pairs = F.filter(F.zip_with(hits, gaps, lambda hit, gap: F.struct(hit.alias("hit"), gap.alias("gap"))), lambda p: p["hit"].isNotNull())
    nothing = F.expr(f"cast(array() as {_SPANS})")

    def step(held: Column, pair: Column) -> Column:
        begin = held["at"] + pair["gap"]
        stop = begin + F.length(pair["hit"])
        value = F.regexp_extract(pair["hit"], f"^{pattern}$", 2) if least else pair["hit"]
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), stop.alias("stop"), value.alias("value"))
        return F.struct(stop.alias("at"), F.concat(held["out"], F.array(span)).alias("out"))

    each = F.transform(_blocks(pairs), lambda block: F.aggregate(block, F.struct(F.lit(0).cast("long").alias("at"), nothing.alias("out")), step))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.expr(f"cast(array() as array<struct<base:long,out:{_SPANS}>>)").alias("parts"))
    placed = F.aggregate(each, start, lambda held, b: F.struct((held["at"] + b["at"]).alias("at"), F.concat(held["parts"], F.array(F.struct(held["at"].alias("base"), b["out"].alias("out")))).alias("parts")))["parts"]
    moved = lambda p: F.transform(p["out"], lambda s: F.struct((s["start"] + p["base"]).alias("start"), s["kind"].alias("kind"), (s["stop"] + p["base"]).alias("stop"), s["value"].alias("value")))
    spans = F.flatten(F.transform(placed, moved))
    if least:
        spans = F.filter(spans, lambda s: F.length(s["value"]) >= least)
    return F.when(worth, spans).otherwise(nothing)


def _free(generic: Column, base: Column) -> Column:
    """The generic spans that touch no base span.

    Blocks of blocks of them narrow the base spans down to those in their reach, then blocks do, so a
    span is held against few.
    """
    touches = lambda a, b: (b["start"] < a["stop"]) & (a["start"] < b["stop"])
    reach = lambda first, last: F.struct(first["start"].alias("start"), last["stop"].alias("stop"))
    near = lambda items, whole, spans: F.struct(items.alias("items"), F.filter(spans, lambda b: touches(whole, b)).alias("near"))
    first, last = lambda block: F.element_at(block, 1), lambda block: F.element_at(block, -1)
    coarse = F.transform(_blocks(_blocks(generic)), lambda blocks: near(blocks, reach(first(first(blocks)), last(last(blocks))), base))
    fine = F.flatten(F.transform(coarse, lambda x: F.transform(x["items"], lambda block: near(block, reach(first(block), last(block)), x["near"]))))
    return F.flatten(F.transform(fine, lambda x: F.filter(x["items"], lambda g: ~F.exists(x["near"], lambda b: touches(g, b)))))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["stop"])))
    return F.concat_ws(",", F.transform(ordered, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))))


def _scanned(docs: DataFrame) -> DataFrame:
    """doc_id, owner and spans of each row, with a digest of doc_id and text where there are candidates."""
    text = F.coalesce(F.col("text"), F.lit(""))
    low = F.lower(text)
    named = F.lit(False)
    for name in NAMES:
        named = named | F.contains(low, F.lit(name))
    base = F.concat(
        _found(text, 0, ASSIGN, named, LEAST_VALUE),
        _found(text, 1, ACCESS, F.contains(text, F.lit("AKIA"))),
        _found(text, 2, HEX, text.rlike(HEX)),
    )
    spans = docs.withColumns({"base": base, "generic": _found(text, 3, GENERIC, text.rlike(GENERIC))})
    spans = spans.withColumn("generic", _free(F.col("generic"), F.col("base")))
    key = F.sha2(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), text), 256)
    return spans.withColumn("row_key", F.when(F.size("base") + F.size("generic") > 0, key))


def _classified(scanned: DataFrame) -> DataFrame:
    """For each row_key: spans to add, live values, and numbers of live and copied candidates.

    Owners are counted from distinct (value, repository) pairs, which map tasks pre-aggregate; the
    counts go back to the candidates in as many parts as a value's counted candidates need, so that
    one that many documents hold does not meet in one task.
    """
    each = scanned.where(F.col("row_key").isNotNull()).select("row_key", "owner", F.explode(F.concat("base", "generic")).alias("span"))
    each = each.select("row_key", "owner", "span", F.sha2("span.value", 256).alias("value_hash")).dropDuplicates(["row_key", "span"])
    owners = each.groupBy("value_hash", "owner").agg(F.count("*").alias("n")).groupBy("value_hash").agg(F.count("*").alias("n_owners"), F.ceil(F.sum("n") / PART).cast("int").alias("parts"))
    hot = owners.where("parts > 1").select("value_hash", "parts")
    spread = owners.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    salted = each.join(hot, "value_hash", "left").withColumn("salt", F.pmod(F.xxhash64("row_key"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
    joined = salted.join(spread, ["value_hash", "salt"]).withColumn("live", F.col("n_owners") <= MAX_OWNERS)
    span, live = F.col("span"), F.col("live")
    return joined.groupBy("row_key").agg(
        F.collect_list(F.when(live & (span["kind"] == 3), span)).alias("added"),
        F.collect_set(F.when(live, span["value"])).alias("live_values"),
        F.count_if(live).alias("n_live"),
        F.count_if(~live).alias("n_copied"),
    )


def scan_secrets(docs: DataFrame, owner: str = "source") -> DataFrame:
    """Spans of each row: base ones, and those the ownership counts add.

    One output row per input row, repeated rows included (a repeated row counts once as a candidate).
    Null and empty texts have no spans; a very long text is scanned whole, and its work grows with its
    length and matches. Spans that begin at one place come in the order of the kinds. A null owner
    counts as one owner of its own; a null doc_id stays null; an empty table gives an empty one. Only
    doc_id, text and the owner column are read, so other columns can't clash. Positions are code
    points. More columns: n_added, n_live and n_copied candidates.
    """
    common.prepare(docs.sparkSession)
    scanned = _scanned(docs.select("doc_id", "text", F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner")))
    scanned = common.settle(scanned.select("doc_id", "owner", "base", "generic", "row_key"), "secret-scan")
    some = scanned.where(F.col("row_key").isNotNull()).join(_classified(scanned), "row_key", "left")
    none = scanned.where(F.col("row_key").isNull()).withColumns({"added": F.expr(f"cast(array() as {_SPANS})"), "n_live": F.lit(0).cast("long"), "n_copied": F.lit(0).cast("long")})
    columns = ["doc_id", "base", "added", "n_live", "n_copied"]
    found = some.select(columns).unionByName(none.select(columns))
    number = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"), "n_live", "n_copied",
    )


def mask_secrets(docs: DataFrame, owner: str = "source", mask: str = "[SECRET]") -> DataFrame:
    """docs with every live-looking value replaced by `mask` in its text; copied examples stay.

    All rows and columns stay; docs needs doc_id, text and the owner column. Where docs has n_chars,
    masked rows get their new length. Other columns are carried in one struct, so no name clashes.
    """
    common.prepare(docs.sparkSession)
    wide = docs.select("doc_id", "text", F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("carried"))
    scanned = common.settle(_scanned(wide).drop("text"), "secret-mask")
    some = scanned.where(F.col("row_key").isNotNull()).join(_classified(scanned).select("row_key", "live_values"), "row_key", "left")
    ordered = F.array_sort("live_values", lambda a, b: F.length(b) - F.length(a))
    masked = F.aggregate(ordered, F.col("carried.text"), lambda text, value: F.replace(text, value, F.lit(mask)))
    changed = F.col("carried").withField("text", masked)
    if "n_chars" in docs.columns:
        changed = F.when(F.size("live_values") > 0, changed.withField("n_chars", F.length(masked).cast(docs.schema["n_chars"].dataType))).otherwise(F.col("carried"))
    some = some.select(changed.alias("carried"))
    both = some.unionByName(scanned.where(F.col("row_key").isNull()).select("carried"))
    return both.select(*[F.col("carried").getField(c).alias(c) for c in docs.columns])
