"""Building training sets: filters, resume, caps, samples, splits, upserts, projections."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from parlance.functions.text import BENGALI, chat_messages, is_script, strip


def present(text: Column) -> Column:
    return F.coalesce(strip(text), F.lit("")) != ""


def sample_filter(text: Column, duration_s: Column | None = None, token_count: Column | None = None, noisy: Column | None = None, script: str = BENGALI, min_ratio: float = 0.5) -> Column:
    """Which samples train: text there, 1 to 20 seconds, mostly the script, tokens, and noisy text if asked for."""
    keep = present(text) & is_script(text, min_ratio, script)
    if duration_s is not None:
        keep &= duration_s.between(1.0, 20.0)
    if token_count is not None:
        keep &= token_count > 0
    if noisy is not None:
        keep &= present(noisy)
    return keep


def quality_filter(wer: Column, wps: Column, max_wer: float = 1.0, min_wps: float = 0.5, max_wps: float = 8.0) -> Column:
    """Known error rate below the limit, and a speaking rate in range; a missing rate counts as 5."""
    return wer.isNotNull() & (wer < max_wer) & F.coalesce(wps, F.lit(5.0)).between(min_wps, max_wps)


def clip_filter(duration_s: Column, least: float = 2.0, most: float = 20.0) -> Column:
    return duration_s.between(least, most)


def counted(df: DataFrame, keep: Column, keys: list[str]) -> DataFrame:
    """Per key: rows in all, kept, filtered."""
    k = F.coalesce(keep, F.lit(False))
    return df.groupBy(*keys).agg(F.count("*").alias("total"), F.count_if(k).alias("kept"), F.count_if(~k).alias("filtered"))


def not_done(df: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key a ledger lacks; put before the expensive stage, so that a second run does only what is new."""
    return df.join(done.select(*keys).distinct(), keys, "left_anti")


def with_english(df: DataFrame, english: DataFrame, key: str = "id") -> DataFrame:
    """df with its parallel text, empty where there is none."""
    return df.join(english.select(key, F.col("english").alias("_en")), key, "left").withColumn("english", F.coalesce("_en", F.lit(""))).drop("_en")


def first_per_group(df: DataFrame, groups: list[str], order: list[Column | str], n: int | Column) -> DataFrame:
    """The first n rows of each group.

    A group may be a third of all rows, so rows are ranked within random-free slices of it first: each slice
    keeps its first n, and only those meet in the group's window.
    """
    limit = n if isinstance(n, Column) else F.lit(n)
    slice_ = F.pmod(F.xxhash64(*df.columns), F.lit(64))
    part = df.withColumn("_slice", slice_)
    part = part.withColumn("_k", F.row_number().over(Window.partitionBy(*groups, "_slice").orderBy(*order))).filter(F.col("_k") <= limit)
    ranked = part.withColumn("_k", F.row_number().over(Window.partitionBy(*groups).orderBy(*order)))
    return ranked.filter(F.col("_k") <= limit).drop("_k", "_slice")


def capped(df: DataFrame, cap: int, groups: list[str], key: str, done: DataFrame | None = None) -> DataFrame:
    """At most cap rows of each group, counting those that are written already."""
    if done is None:
        return first_per_group(df, groups, [key], cap)
    have = done.groupBy(*groups).agg(F.count("*").alias("_have"))
    rest = not_done(df, done, [key]).join(have, groups, "left").withColumn("_room", F.lit(cap) - F.coalesce("_have", F.lit(0)))
    return first_per_group(rest, groups, [key], F.col("_room")).drop("_have", "_room")


def by_hash(key: str, seed: int = 42) -> list[Column]:
    """A fixed random-looking order of rows, which other engines can follow: the MD5 of seed and key as text, then the key."""
    return [F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary")), F.col(key)]


def first_by_hash(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """The first n rows in hash order: all below a hash bound, which counts of hash ranges give, and what the bound's own range lacks.

    Counting by the hash's first 16 bits gives at most 65,536 numbers; only the rows of one of these ranges are sorted.
    """
    h = df.withColumn("_h", by_hash(key, seed)[0]).withColumn("_top", F.left("_h", F.lit(4)))
    upto, edge, room = 0, None, 0
    for r in sorted(h.groupBy("_top").count().collect()):
        if upto + r["count"] > n:
            edge, room = r["_top"], n - upto
            break
        upto += r["count"]
    if edge is None:
        return df
    below = h.filter(F.col("_top") < edge)
    return below.unionByName(h.filter(F.col("_top") == edge).orderBy("_h", key).limit(room)).drop("_h", "_top")


def random_sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    return first_by_hash(df, n, key, seed)


def even_sample(df: DataFrame, n: int, groups: list[str], key: str, seed: int = 42, order: list[Column | str] | None = None) -> DataFrame:
    """max(1, n // groups) rows of each group; the number of groups is counted."""
    k = max(1, n // max(1, df.select(*groups).distinct().count()))
    return first_per_group(df, groups, order or by_hash(key, seed), k)


def split_sizes(n: Column, k: int, rule: str = "share") -> Column:
    """Validation rows of a group of n: rule ``share`` is max(1, min(k, n/5 cut)), ``floor`` is min(k, max(1, n // 5))."""
    if rule == "share":
        return F.greatest(F.lit(1), F.least(F.lit(k), F.floor(n * 0.2)))
    return F.least(F.lit(k), F.greatest(F.lit(1), F.floor(n / 5)))


def stratified_split(df: DataFrame, k: int, groups: list[str], key: str, seed: int = 42, rule: str = "share", order: list[Column | str] | None = None) -> DataFrame:
    """df with ``split`` (val or train); every group has a validation key, a single one is it.

    Which keys validate is found on narrow rows (group and key, each once): the first few of each group. Rows that
    repeat a key share its split, so no sample is on both sides; null is a key and a group like any other.
    """
    order = order or by_hash(key, seed)
    keys = df.select(*dict.fromkeys([*groups, key])).distinct()
    sizes = keys.groupBy(*groups).agg(split_sizes(F.count("*"), k, rule).cast("int").alias("_n"))
    same = [F.col(f"_n_{c}").eqNullSafe(F.col(c)) for c in groups]
    sizes = sizes.select(*[F.col(c).alias(f"_n_{c}") for c in groups], "_n")
    narrow = keys.join(sizes, same).drop(*[f"_n_{c}" for c in groups])
    val = first_per_group(narrow, groups, order, F.col("_n")).select(*groups, key).withColumn("_val", F.lit(True))
    on = F.lit(True)
    right = val.select(*[F.col(c).alias(f"_r_{c}") for c in dict.fromkeys([*groups, key])], "_val")
    for c in dict.fromkeys([*groups, key]):
        on &= F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return df.join(right, on, "left").withColumn("split", F.when(F.col("_val"), "val").otherwise("train")).select(*df.columns, "split")


def dev_split(df: DataFrame, key: str, share: float = 0.1, seed: int = 42) -> DataFrame:
    """df with ``split``: a share of all keys, one at least, by hash order, drawn after missing files are dropped.

    Rows that repeat a key share its split; null is a key like any other.
    """
    keys = df.select(key).distinct()
    n = max(1, int(keys.count() * share))
    dev = first_by_hash(keys, n, key, seed).select(F.col(key).alias("_dev_key"), F.lit(True).alias("_dev"))
    return df.join(dev, F.col(key).eqNullSafe(F.col("_dev_key")), "left").select(*df.columns, F.when(F.col("_dev"), "dev").otherwise("train").alias("split"))


def existing(df: DataFrame, listing: DataFrame, path: str = "path") -> tuple[DataFrame, DataFrame]:
    """(rows whose file is listed, rows whose file is missing, to report)."""
    have = listing.select(path).distinct()
    return df.join(have, path, "left_semi"), df.join(have, path, "left_anti")


def project(df: DataFrame, mode: str) -> DataFrame:
    """Output columns by mode: ``ipa``, ``fst`` (noisy text) or ``both``; what a mode lacks is null."""
    if mode not in ("ipa", "fst", "both"):
        raise ValueError(f"unknown mode {mode}")
    null = F.lit(None).cast("string")
    return df.select("src", "subsource", "id", (F.col("ipa") if mode != "fst" else null).alias("ipa"), (F.col("noisy") if mode != "ipa" else null).alias("noisy"), "bengali", "english")


def row_id(subsource: Column, natural: Column) -> Column:
    """A key that a second run gives again."""
    return F.concat_ws("_", subsource, natural.cast("string"))


def chat_records(df: DataFrame, system: str, user_col: str = "ipa") -> DataFrame:
    return df.select(chat_messages(F.lit(system), F.col(user_col), F.col("bengali"), F.col("english")).alias("messages"))


def composition(df: DataFrame, groups: list[str]) -> DataFrame:
    return df.groupBy(*groups).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *groups)


def concat_sources(*frames: DataFrame) -> DataFrame:
    """All rows of several sources in one shape; columns that a source lacks are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def extract(samples: DataFrame, done: DataFrame, keep: Column, model: Callable[[DataFrame], DataFrame], cap: int | None = None, groups: list[str] | None = None, key: str = "id") -> DataFrame:
    """A resumable extraction: what is done is left out, the rest filtered, capped, and only then sent to the model."""
    todo = not_done(samples, done, [key]).filter(keep)
    if cap is not None:
        todo = capped(todo, cap, groups or ["src"], key, done)
    return model(todo)


def extract_observed(samples: DataFrame, done: DataFrame, keep: Column, model: Callable[[DataFrame], DataFrame], key: str = "id", error: str = "error") -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """(what the model makes of new rows that pass, counters): the counters are taken as the result is written, in the same job.

    ``total`` new rows, of which ``filtered`` and ``kept``; ``written`` rows of the result, of which ``errors`` have one.
    They are the numbers of the first action on the result; until then asking for them waits.
    """
    before, after = Observation(), Observation()
    passes = F.coalesce(keep, F.lit(False))
    todo = not_done(samples, done, [key]).observe(before, F.count(F.lit(1)).alias("total"), F.count_if(passes).alias("kept"), F.count_if(~passes).alias("filtered"))
    made = model(todo.filter(passes)).observe(after, F.count(F.lit(1)).alias("written"), F.count_if(F.col(error).isNotNull()).alias("errors"))
    return made, lambda: dict.fromkeys(("total", "kept", "filtered", "written", "errors"), 0) | before.get | after.get
