"""Secret scans that weigh each candidate by who else has it.

Base spans come from three fixed patterns. A fourth, wide pattern proposes bare credential-looking strings. The
hashes of all candidate values are then counted over the whole corpus by distinct repository and distinct owner:
a value that many owners have is a copied example, a value that few have looks like a live credential. Bare
candidates become spans of kind ``owned`` only if they are owner-specific; base spans stay whatever the count.

Everything is DataFrame functions. Values are hashed in the scan, so no text is shuffled. Distinct (value,
repository, owner) triples are aggregated before they are counted, and the counts are joined back with both
sides as plain scans, so that a value in a third of all rows is split by Spark.

Positions are code points, ends are exclusive. Defined results: a null or empty text has no spans; a null
repository counts as one of its own; repeated rows each get their own result; columns other than the id, the
text and the repository are left out; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import store

# The patterns and least lengths of the base kinds, in their listed order.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 8, 16, 32
KINDS = ("assign", "access", "hex", "owned")


@dataclass(frozen=True)
class Params:
    bare_least: int = 16
    #: A value in more repositories or with more owners than this is a copied example.
    max_repos: int = 2
    max_owners: int = 2


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """start, end and the group's value of every leftmost non-overlapping match."""
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    lit = F.lit(pattern)

    def placed(s: Column) -> Column:
        lengths = F.transform(s["hits"], lambda h, i: F.length(h) + F.length(F.get(s["pieces"], i)))

        def rows(t: Column) -> Column:
            def row(h: Column, i: Column) -> Column:
                block = F.floor(i / 256).cast("int")
                total = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)
                start = F.get(t["before"], block) + total(F.slice(t["lengths"], block * 256 + 1, i % 256)) + F.length(F.get(s["pieces"], i))
                return F.struct(start.alias("start"), (start + F.length(h)).alias("end"), F.get(s["values"], i).alias("value"))

            return F.transform(s["hits"], row)

        return let(F.struct(lengths.alias("lengths")), lambda a: let(F.struct(a["lengths"].alias("lengths"), block_starts(a["lengths"]).alias("before")), rows))

    found = let(
        F.struct(F.split(text, pattern, -1).alias("pieces"), F.regexp_extract_all(text, lit, 0).alias("hits"), F.regexp_extract_all(text, lit, group).alias("values")),
        placed,
    )
    return F.when(text.rlike(pattern), found).otherwise(empty)


def block_starts(lengths: Column, block: int = 256) -> Column:
    """The sums of all lengths before each block, so that a position costs a block at most."""
    total = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)
    n = F.floor(F.size(lengths) / block).cast("int")
    sums = F.transform(F.sequence(F.lit(0), n), lambda b: total(F.slice(lengths, b * block + 1, F.lit(block))))
    return let(sums, lambda s: F.transform(F.sequence(F.lit(0), n), lambda b: total(F.slice(s, F.lit(1), b))))


def candidates(docs: DataFrame, id_col: str, text_col: str, repo_col: str, owner: Column | None, params: Params) -> DataFrame:
    """One narrow row for each document: a row number, the id, who has it, and all base and bare matches."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    repo = F.coalesce(F.col(repo_col).cast("string"), F.lit("\x00none"))
    # what comes before the first slash owns a repository; a repository without one owns itself
    owner = F.split_part(repo, F.lit("/"), F.lit(1)) if owner is None else owner
    # runs are maximal, so asking for the least length at once finds the same matches as dropping shorter ones
    kinds = {
        "assign": F.filter(matches(text, ASSIGN, 2), lambda m: F.length(m["value"]) >= ASSIGN_LEAST),
        "access": matches(text, rf"AKIA[A-Z0-9]{{{ACCESS_LEAST - 4},}}"),
        "hex": matches(text, rf"[0-9a-f]{{{HEX_LEAST},}}"),
        "owned": F.filter(
            matches(text, rf"[A-Za-z0-9+/_-]{{{params.bare_least},}}"),
            lambda m: m["value"].rlike("[0-9].*[0-9]") & m["value"].rlike("[A-Za-z].*[A-Za-z]"),
        ),
    }

    def tag(kind: str) -> Callable[[Column], Column]:
        return lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), x["end"].alias("end"), F.md5(x["value"].cast("binary")).alias("hash"))

    tagged = [F.transform(m, tag(k)).alias(f"m_{k}") for k, m in kinds.items()]
    rows = docs.select(F.col(id_col).alias("doc_id"), repo.alias("repo"), owner.alias("owner"), F.xxhash64(F.col(text_col)).alias("text_hash"), *tagged)
    for k in ("assign", "access", "hex"):
        rows = rows.withColumn(f"e_{k}", chunk_ends(F.col(f"m_{k}")))
    free = F.filter("m_owned", lambda x: ~(touched(x, "assign") | touched(x, "access") | touched(x, "hex")))
    rows = rows.withColumn("spans", F.array_sort(F.concat("m_assign", "m_access", "m_hex", free)))
    return rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "repo", "owner", "text_hash", "spans")


def chunk_ends(spans: Column, chunk: int = 256) -> Column:
    """The last end in each chunk of a kind's spans, which are in order and don't overlap."""
    n = F.size(spans)
    last = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / chunk).cast("int")), lambda b: F.get(spans, F.least((b + 1) * chunk, n) - 1)["end"])
    return F.when(n > 0, last).otherwise(F.array().cast("array<int>"))


def touched(x: Column, kind: str, chunk: int = 256) -> Column:
    """Whether a span overlaps one of a kind: the first that ends after its start tells, and only its chunk is gone through."""
    before = F.size(F.filter(F.col(f"e_{kind}"), lambda e: e <= x["start"]))
    return F.exists(F.slice(F.col(f"m_{kind}"), before * chunk + 1, F.lit(chunk)), lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))


def ownership(found: DataFrame) -> DataFrame:
    """For each value's hash, the number of distinct repositories and owners that have it."""
    has = found.select("repo", "owner", F.explode("spans.hash").alias("hash")).groupBy("hash", "owner", "repo").agg(F.count("*").alias("uses"))
    by_owner = has.groupBy("hash", "owner").agg(F.count("*").alias("repos"), F.sum("uses").alias("uses"))
    return by_owner.groupBy("hash").agg(F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners"), F.sum("uses").alias("n_uses"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "source", owner: Column | None = None, params: Params = Params()) -> DataFrame:
    """doc_id, text_hash and ``secrets`` of every document: kind, start, end, counts and whether it looks live."""
    found = store(candidates(docs, id_col, text_col, repo_col, owner, params), "secret-candidates")
    counts = store(ownership(found), "secret-owners")
    each = found.select("row", F.explode("spans").alias("s")).select("row", "s.*")
    live = (F.col("n_repos") <= params.max_repos) & (F.col("n_owners") <= params.max_owners)
    judged = each.join(counts, "hash").withColumn("live", live).filter((F.col("kind") != KINDS.index("owned")) | F.col("live"))
    by_row = judged.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "hash", "n_repos", "n_owners", "n_uses", "live"))).alias("found"))
    names = F.array(*map(F.lit, KINDS))
    named = F.transform("found", lambda x: F.struct(F.get(names, x["kind"]).alias("kind"), *[x[c].alias(c) for c in ("start", "end", "hash", "n_repos", "n_owners", "n_uses", "live")]))
    out = found.select("row", "doc_id", "text_hash").join(by_row, "row", "left")
    none = F.array().cast("array<struct<kind:string,start:int,end:int,hash:string,n_repos:bigint,n_owners:bigint,n_uses:bigint,live:boolean>>")
    return out.select("doc_id", "text_hash", F.coalesce(named, none).alias("secrets"))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "source", params: Params = Params()) -> DataFrame:
    """docs with every span replaced by a tag that says its kind and whether it looked live or copied."""
    found = scan(docs, id_col, text_col, repo_col, None, params).filter(F.size("secrets") > 0)
    found = store(found.select(F.col("doc_id").alias("__secret_of"), F.col("text_hash").alias("__secret_hash"), F.col("secrets").alias("__secret_spans")).dropDuplicates(["__secret_of", "__secret_hash"]), "secret-spans")
    text = F.col(text_col)

    def step(acc: Column, s: Column) -> Column:
        tag = F.concat(F.lit("<"), F.when(s["live"], "secret").otherwise("example"), F.lit(":"), s["kind"], F.lit(">"))
        fresh = s["start"] >= acc["at"]
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(acc["out"], text.substr(acc["at"] + 1, s["start"] - acc["at"]), tag)).otherwise(acc["out"]).alias("out"),
        )

    clean = F.aggregate("__secret_spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda a: F.concat(a["out"], text.substr(a["at"] + 1, F.length(text))))
    same = F.col(id_col).eqNullSafe(F.col("__secret_of")) & (F.xxhash64(text) == F.col("__secret_hash"))
    return docs.join(found, same, "left").withColumn(text_col, F.when(F.col("__secret_spans").isNull(), text).otherwise(clean)).select(*docs.columns)
