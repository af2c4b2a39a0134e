"""Benchmark decontamination through templates.

Texts become token templates: numbers, units and names turn into typed placeholders, all else is lower-cased. A
window of consecutive template tokens that a document shares with a benchmark item is a match, found by a hash
join. Along one alignment of a document and an item, the values in the placeholders must agree: one item value
always stands for one document value. Where they do not, only windows without changed values count. That keeps
re-parameterised questions (other numbers, other names, the same text) and refuses chance agreement of templates. A document is contaminated by an item if consistent
windows cover enough of the item's tokens. A window that is nearly all placeholders must be found as it is written,
and an item shorter than a window is one window of its own length.

Each text is templated twice, with names as placeholders and with names as lower-cased words; the second sees
through changed capitals. Everything is DataFrame functions; window hashes are made in the scan and joined with
the benchmark's windows. Those are broadcast only if their counted rows are at most ``broadcast_rows``; beyond
that the join is left to Spark's shuffled joins. Only matches are ever shuffled otherwise.

Defined results: null or empty texts match nothing, nor do items without a token; documents that are equal
in id and text are reported once; a null id is kept as null; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import store

TOKEN = r"(\p{N}+(?:[.,]\p{N}+)*|\p{L}[\p{L}\p{M}'’]*)"
# Words that state a unit, and words that state a number.
UNITS = (
    "mm cm m km ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers "
    "mg g kg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ml l liter liters litre litres gallon gallons "
    "second seconds minute minutes hour hours day days week weeks month months year years cent cents dollar dollars euro euros "
    "percent degree degrees"
).split()
NUMBERS = "two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million".split()

#: What a window's hash stands for: its template, its template with names as placeholders, or its very words.
PLAIN, NAMED, RAW = 0, 1, 2


@dataclass(frozen=True)
class Params:
    window: int = 8
    #: Plain words that a template must have to say something; windows with fewer are looked for as they are written.
    min_words: int = 4
    #: Share of an item's tokens that consistent windows must cover.
    coverage: float = 0.5
    #: The benchmark's windows are broadcast up to this many rows (about 300 bytes each).
    broadcast_rows: int = 200_000


def template(token: Column, names: bool) -> Column:
    low = F.lower(token)
    head = F.substring(token, 1, 1)
    kind = F.when(head.between("0", "9") | low.isin(NUMBERS), "<num>").when(low.isin(UNITS), "<unit>")
    if names:
        tail = F.substring(token, 2, 1_000_000)
        kind = kind.when((head != F.lower(head)) & (tail != "") & (tail == F.lower(tail)), "<name>")
    return kind.otherwise(low)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def token_hashes(tokens: Column, raw: bool = False) -> Column:
    """Hashes of all tokens' templates: ``plain``, ``named`` with names as placeholders, and ``raw`` without any if asked for.

    The tokens are lower-cased at once, and a token that has no capital has the same hash in the first two.
    """

    def plain(t: Column) -> Column:
        return F.xxhash64(F.when(F.substring(t, 1, 1).between("0", "9") | t.isin(NUMBERS), "<num>").when(t.isin(UNITS), "<unit>").otherwise(t))

    def named(l: Column, h: Column) -> Column:
        def one(t: Column, i: Column) -> Column:
            own, x = F.get(h, i), F.get(l, i)
            name = (F.length(t) > 1) & x.endswith(F.substring(t, 2, 1_000_000)) & ~x.isin(NUMBERS) & ~x.isin(UNITS)
            return F.when(t == x, own).when(name, F.xxhash64(F.lit("<name>"))).otherwise(own)

        return F.transform(tokens, one)

    def every(l: Column) -> Column:
        spelled = [F.transform(l, lambda t: F.xxhash64(t)).alias("raw")] if raw else []
        return let(F.transform(l, plain), lambda h: F.struct(h.alias("plain"), named(l, h).alias("named"), *spelled))

    return let(F.split(F.lower(F.array_join(tokens, " ")), " "), every)


def spans(hashes: Column, w: int) -> Column:
    """A hash of every w consecutive hashes, by doubling: pairs, pairs of pairs, and so on. The last w - 1 mean nothing."""
    if w == 1:
        return hashes

    def joined(half: Column) -> Column:
        two = F.transform(half, lambda v, i: F.xxhash64(v, F.get(half, i + w // 2)))
        return F.transform(two, lambda v, i: F.xxhash64(v, F.get(hashes, i + (w - 1)))) if w % 2 else two

    return let(spans(hashes, w // 2), joined)


def window_hashes(hashes: Column, w: int) -> Column:
    n = F.size(hashes) - (w - 1)
    return F.when(n > 0, F.slice(spans(hashes, w), F.lit(1), F.greatest(n, F.lit(0)))).otherwise(F.array().cast("array<bigint>"))


def tokens_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), 1)


def windows(rows: DataFrame, kinds: list[tuple[int, int]]) -> tuple[DataFrame, Column]:
    """rows and, for each window of its tokens, ``at`` and ``hash``; and the column that makes at its first token (from 0).

    kinds: the (mode, length) pairs to look for. A window is given with names as placeholders only if it has a name,
    and as it is written only if it has a placeholder.
    """
    by_length = {w: {m for m, x in kinds if x == w} for w in sorted({x for _, x in kinds})}

    def of_length(h: Column, w: int) -> Column:
        def more(p: Column) -> Column:
            new = [F.transform(window_hashes(h[name], w), lambda v, i: F.when(v != F.get(p, i), v)) for m, name in ((NAMED, "named"), (RAW, "raw")) if m in by_length[w]]
            return F.concat(p, *new)

        return let(window_hashes(h["plain"], w), more)

    every = let(token_hashes(F.col("tokens"), any(m == RAW for m, _ in kinds)), lambda h: F.concat(*[of_length(h, w) for w in by_length]))
    # The array is a column of its own, so that exploding and probing are compiled and copy no tokens of a window without
    # a match; outer, so that Spark infers no filter on its size, which would make the array twice.
    out = rows.withColumn("hashes", every).select(*rows.columns, F.posexplode_outer("hashes").alias("at", "hash"))
    start, pos = F.lit(0), None
    for w, modes in by_length.items():
        n = F.greatest(F.size("tokens") - (w - 1), F.lit(0))
        here = F.try_mod(F.col("at") - start, n)
        start = start + n * len(modes | {PLAIN})
        pos = F.when(F.col("at") < start, here) if pos is None else pos.when(F.col("at") < start, here)
    return out, pos


def slots(raw: Column, names: bool) -> Column:
    """The placeholders of a window's tokens; null for plain words."""
    return F.transform(raw, lambda t: let(template(t, names), lambda x: F.when(x.startswith("<"), x)))


def benchmark_windows(items: DataFrame, id_col: str, text_col: str, params: Params) -> DataFrame:
    """One row for each window of an item in each mode; an item shorter than a window is one window of its own length.

    A window that its placeholders leave too few plain words is looked for as it is written (RAW) in their place.
    """
    rows = items.select(F.col(id_col).alias("item_id"), tokens_of(F.col(text_col)).alias("tokens")).filter("item_id IS NOT NULL AND size(tokens) > 0")
    parts = []
    lengths = [r[0] for r in rows.select(F.least(F.size("tokens"), F.lit(params.window))).distinct().collect()]
    for w in sorted(lengths) or [params.window]:
        own = rows.filter(F.size("tokens") == w) if w < params.window else rows.filter(F.size("tokens") >= w)
        modes = F.array(*[F.struct(F.lit(m).alias("mode"), window_hashes(F.col(f"h.{name}"), w).alias("hashes")) for m, name in ((PLAIN, "plain"), (NAMED, "named"), (RAW, "raw"))])
        each = own.withColumn("h", token_hashes(F.col("tokens"), True)).select("item_id", "tokens", F.explode(modes).alias("m"))
        parts.append(each.select("item_id", "tokens", "m.mode", F.posexplode("m.hashes").alias("item_pos", "hash"), F.lit(w).alias("length")))
    out = reduce(DataFrame.unionByName, parts).withColumn("item_raw", F.slice("tokens", F.col("item_pos") + 1, F.col("length")))
    out = out.withColumn("as_plain", slots(F.col("item_raw"), False)).withColumn("as_named", slots(F.col("item_raw"), True))
    few = [F.size(F.filter(c, lambda s: s.isNull())) < params.min_words for c in ("as_plain", "as_named")]
    out = out.filter(F.get(F.array(~few[PLAIN], ~few[NAMED], few[PLAIN] | few[NAMED]), F.col("mode")))
    bound = F.when(F.col("mode") == PLAIN, F.col("as_plain")).when(F.col("mode") == NAMED, F.col("as_named")).otherwise(F.array().cast("array<string>"))
    return out.select("hash", "item_id", "item_pos", "item_raw", bound.alias("slots"), F.size("tokens").alias("item_tokens"), "mode", "length")


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", params: Params = Params()) -> DataFrame:
    """(doc_id, text_hash, item_id, covered_tokens, item_tokens, slots_changed) of all contaminated pairs."""
    bench = store(benchmark_windows(items, item_id, item_text, params), "benchmark-windows")
    kinds = [(r["mode"], r["length"]) for r in bench.select("mode", "length").distinct().collect()]  # three for each length at most
    if bench.count() <= params.broadcast_rows:
        bench = F.broadcast(bench)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), tokens_of(F.col(text_col)).alias("tokens"))
    found, pos = windows(rows, kinds or [(PLAIN, params.window)])
    hits = found.join(bench, "hash").withColumn("pos", pos)
    now = F.slice("tokens", F.col("pos") + 1, F.col("length"))
    hits = hits.select("doc_id", "text_hash", "item_id", "item_tokens", "mode", "length", (F.col("pos") - F.col("item_pos")).alias("shift"), F.struct("item_pos", "item_raw", "slots", now.alias("now")).alias("hit"))
    # one alignment has each item position once, so a group is no larger than an item
    whole = hits.groupBy("doc_id", "text_hash", "item_id", "item_tokens", "mode", "length", "shift").agg(F.collect_set("hit").alias("hits"))

    def bound(h: Column) -> Column:
        slotted = F.filter(F.arrays_zip(h["item_raw"], h["now"], h["slots"]), lambda x: x["slots"].isNotNull())
        return F.transform(slotted, lambda x: F.struct(F.lower(x["item_raw"]).alias("was"), F.lower(x["now"]).alias("now")))

    whole = whole.withColumn("hit", F.transform("hits", lambda h: F.struct(h["item_pos"].alias("item_pos"), bound(h).alias("bound"))))
    bindings = F.array_distinct(F.flatten(F.transform("hit", lambda h: h["bound"])))
    consistent = F.size(F.array_distinct(F.transform(bindings, lambda x: x["was"]))) == F.size(bindings)
    # where values disagree, windows that hold the item's own values still count
    same = F.filter("hit", lambda h: F.forall(h["bound"], lambda x: x["was"] == x["now"]))
    whole = whole.withColumn("hit", F.when(consistent, F.col("hit")).otherwise(same)).filter(F.size("hit") > 0)
    lines = whole.withColumn("starts", F.transform("hit", lambda h: h["item_pos"])).withColumn("bound", F.array_distinct(F.flatten(F.transform("hit", lambda h: h["bound"]))))
    changed = F.size(F.filter("bound", lambda x: x["was"] != x["now"]))
    covered = F.flatten(F.transform("starts", lambda p: F.sequence(p, p + (F.col("length") - 1))))
    pairs = lines.withColumn("spans", F.array_distinct(covered)).withColumn("changed", changed).groupBy("doc_id", "text_hash", "item_id", "item_tokens").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("spans")))).alias("covered_tokens"), F.max_by("changed", F.struct(F.size("starts"), F.col("mode"))).alias("slots_changed")
    )
    return pairs.filter(F.col("covered_tokens") >= params.coverage * F.col("item_tokens")).select("doc_id", "text_hash", "item_id", "covered_tokens", "item_tokens", "slots_changed")


def remove(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: Params = Params()) -> DataFrame:
    """docs without the contaminated ones."""
    found = matches(docs, items, id_col, text_col, params=params).select(F.col("doc_id").alias("__leak_of"), F.col("text_hash").alias("__leak_hash")).distinct()
    found = store(found, "contaminated")
    return docs.join(found, F.col(id_col).eqNullSafe(F.col("__leak_of")) & (F.xxhash64(F.col(text_col)) == F.col("__leak_hash")), "left_anti")
