"""Scores of hypotheses against references, and of candidate rankings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.functions.scores import cer, char_distance, wer
from parlance.functions.text import base_norm, num_norm

SIDES = ("A", "B", "C")


def score_pairs(references: DataFrame, hypotheses: DataFrame, rule: str = "floor") -> DataFrame:
    """Per file and system: error rates with plain and number normalisation; files without a hypothesis are left out."""
    both = references.select("file", F.col("transcript").alias("ref")).join(hypotheses.select("file", "system", F.col("text").alias("hyp")), "file")
    m1 = lambda c: base_norm(F.col(c), "space")
    both = both.withColumns({"ref1": m1("ref"), "hyp1": m1("hyp")}).withColumns({"ref2": num_norm(F.col("ref1")), "hyp2": num_norm(F.col("hyp1"))})
    metrics = F.array(*[F.struct(F.lit(f"M{k}").alias("metric"), F.col(f"ref{k}").alias("r"), F.col(f"hyp{k}").alias("h")) for k in (1, 2)])
    rows = both.select("file", "system", F.explode(metrics).alias("m")).select("file", "system", "m.*")
    return rows.select("file", "system", "metric", cer(F.col("h"), F.col("r"), rule).alias("cer"), wer(F.col("h"), F.col("r"), rule).alias("wer"), char_distance(F.col("h"), F.col("r")).alias("edits"), F.length("r").alias("ref_chars"), F.length("h").alias("hyp_chars"))


def means(scores: DataFrame, groups: list[str]) -> DataFrame:
    """Mean of the rates, and rate of the sums, for each group."""
    return scores.groupBy(*groups).agg(F.count("*").alias("n"), F.avg("cer").alias("macro_cer"), F.avg("wer").alias("macro_wer"), (F.sum("edits") / F.greatest(F.sum("ref_chars"), F.lit(1))).alias("micro_cer"))


def document_scores(reference: DataFrame, parts: DataFrame, rule: str = "floor") -> DataFrame:
    """Parts of each document and system joined in order, then scored once."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), " ")
    hyp = parts.groupBy("file", "system").agg(text.alias("text"))
    return score_pairs(reference, hyp, rule)


def summary(scores: DataFrame, groups: list[str], value: str = "cer") -> DataFrame:
    """Mean, upper median, best and worst of each group.

    The upper median is the value at place n // 2 of the sorted values. It is read from counts of distinct
    rounded values, so no group's values are gathered.
    """
    v = scores.select(*groups, F.col(value).alias("v"))
    n = v.groupBy(*groups).agg(F.count("*").alias("n"), F.avg("v").alias("mean"), F.min("v").alias("best"), F.max("v").alias("worst"))
    counts = v.groupBy(*groups, "v").agg(F.count("*").alias("k"))
    upto = counts.withColumn("upto", F.sum("k").over(Window.partitionBy(*groups).orderBy("v")))
    median = upto.join(n.select(*groups, "n"), groups).filter(F.col("upto") > F.floor(F.col("n") / 2)).groupBy(*groups).agg(F.min("v").alias("median"))
    return n.join(median, groups)


def bands(wide: DataFrame, new: str, old: str, band_pp: float = 1.0) -> DataFrame:
    """How many samples a system makes better, leaves or makes worse, by a band in percentage points."""
    d = (F.col(new) - F.col(old)) * 100
    return wide.agg(F.count_if(d < -band_pp).alias("better"), F.count_if(F.abs(d) <= band_pp).alias("same"), F.count_if(d > band_pp).alias("worse"))


def improvements(mean_by_system: DataFrame, baseline: str) -> DataFrame:
    """Percentage points and relative reduction of each system's mean rate against a baseline."""
    base = mean_by_system.filter(F.col("system") == baseline).select(F.col("macro_cer").alias("base"))
    # one row, so the product has as many rows as there are systems
    both = mean_by_system.join(F.broadcast(base))
    return both.select("system", ((F.col("base") - F.col("macro_cer")) * 100).alias("gain_pp"), (100 * (F.col("base") - F.col("macro_cer")) / F.col("base")).alias("reduction_pct"))


def winner(means_wide: Column | None, **rates: Column) -> Column:
    """The name with the least rate, the first of equals."""
    return F.least(*[F.struct(v.alias("rate"), F.lit(i).alias("i"), F.lit(k).alias("name")) for i, (k, v) in enumerate(rates.items())])["name"]


def wins(wide: DataFrame, systems: list[str]) -> DataFrame:
    """Exactly one win for each sample, ties to the system named first."""
    best = winner(None, **{s: F.col(s) for s in systems})
    return wide.withColumn("system", best).groupBy("system").agg(F.count("*").alias("wins"))


def ranking_metrics(df: DataFrame, k: int) -> DataFrame:
    """df: gold, candidates (array of words), picked (zero-based or null). One row of rates."""
    place = F.array_position(F.slice("candidates", 1, k), F.col("gold")) - 1
    pick = F.get("candidates", F.col("picked"))
    hit = lambda c: F.avg(F.coalesce(c, F.lit(False)).cast("int"))
    m = df.agg(
        F.count("*").alias("n"), hit(place == 0).alias("rank1"), hit(pick == F.col("gold")).alias("picker"), hit(place >= 0).alias("recall_at_k"),
        F.count_if(F.col("picked").isNull()).alias("unparseable"), F.count_if(F.col("picked").isNotNull() & ~pick.eqNullSafe(F.col("gold"))).alias("wrong"),
    )
    m = m.withColumns({"lift": F.col("picker") - F.col("rank1"), "utilisation": F.when(F.col("recall_at_k") > 0, F.col("picker") / F.col("recall_at_k"))})
    return m.withColumn("verdict", F.when(F.col("lift") >= 0.20, "strong").when(F.col("lift") >= 0.05, "modest").otherwise("none"))


def gold_rank(gold: Column, candidates: Column) -> Column:
    """Zero-based place of the right word, -1 if it is absent."""
    return F.coalesce(F.array_position(candidates, gold) - 1, F.lit(-1))


def examples(df: DataFrame, condition: Column, n: int, order: str) -> DataFrame:
    return df.filter(condition).orderBy(order).limit(n)


def top_k(queries: DataFrame, items: DataFrame, block: list[str], distance: Column, k: int, query_id: str = "query_id", item_id: str = "item_id") -> DataFrame:
    """The k nearest items of each query among those of its block, by an exact distance.

    Blocks bound what is compared. A query's candidates are cut to k in slices before they meet.
    """
    from parlance.operators.dataset import first_per_group

    pairs = queries.join(items, block).withColumn("distance", distance).filter(F.col(query_id) != F.col(item_id))
    best = first_per_group(pairs.select(query_id, item_id, "distance"), [query_id], ["distance", item_id], k)
    return best.withColumn("rank", F.row_number().over(Window.partitionBy(query_id).orderBy("distance", item_id)))


def top_k_cosine(queries: DataFrame, items: DataFrame, block: str, k: int, digits: int = 5, query_id: str = "query_id", item_id: str = "item_id", vector: str = "vector", slice_rows: int = 4096) -> DataFrame:
    """(query_id, item_id, distance, rank): the k nearest items of each query among its block's, by rounded cosine distance, ties to the smaller id.

    Items are dealt over slices of their block and each query meets every slice once, where its distances to all items
    are taken at a time, their products added in the vectors' order. A slice gives those that may be among its k best
    after rounding; only these are rounded and cut to k. Vectors that are null, or hold null or non-finite entries, and
    null blocks are left out; vectors of different lengths don't meet. A zero vector's distance is not a number, which comes last.
    """
    from parlance.operators.dataset import first_per_group

    good = F.forall(vector, lambda v: v.isNotNull() & (F.abs(v.cast("double")) < float("inf"))) & F.col(block).isNotNull()
    side = lambda df, own: df.filter(good).select(F.col(own[0]).alias(own[1]), F.col(block).alias("block"), F.size(vector).alias("size"), F.col(vector).cast("array<double>").alias("v"))
    q, t = side(queries, (query_id, "q")), side(items, (item_id, "t"))
    counts = t.groupBy("block", "size").agg(F.ceil(F.count("*") / slice_rows).cast("int").alias("slices"))
    t = t.join(counts, ["block", "size"]).withColumn("slice", F.pmod(F.xxhash64("t"), F.col("slices")).cast("int")).drop("slices")
    q = q.join(counts, ["block", "size"]).withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("slices")
    room = 2.0 * 10.0**-digits
    kinds = {c: d.schema[c].dataType.simpleString() for c, d in (("q", q), ("t", t))}

    def search(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not len(asked) or not len(held):  # a slice or a block of one side alone
            return pa.table([asked["q"].slice(0, 0), held["t"].slice(0, 0), pa.array([], pa.float64())], names=["q", "t", "d"])
        square = lambda c: np.ascontiguousarray(c.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(c), -1).T)
        x, y = square(asked["v"]), square(held["v"])
        ids, own = held["t"].combine_chunks(), asked["q"].combine_chunks()
        length = lambda m: sum((row * row for row in m), np.zeros(m.shape[1]))
        xx, yy = length(x), length(y)
        plain, mine, parts = ids.to_numpy(zero_copy_only=False), own.to_numpy(zero_copy_only=False), []
        for r in range(len(mine)):
            dot = np.zeros(len(plain))
            for a, b in zip(x[:, r], y, strict=True):
                dot += a * b
            with np.errstate(invalid="ignore", divide="ignore"):
                d = 1 - dot / np.sqrt(xx[r] * yy)
            rows = np.flatnonzero(plain != mine[r])
            # at most k of a query's rows count, all others within rounding of the last of them too
            if len(rows) > k:
                last = np.partition(d[rows], k - 1)[k - 1]
                rows = rows[~(d[rows] > last + room)]
                if np.isnan(last):  # fewer than k numbers: the smallest ids without one go along
                    odd = rows[np.isnan(d[rows])]
                    rows = np.concatenate([rows[~np.isnan(d[rows])], odd[np.argsort(plain[odd], kind="stable")][:k]])
                else:
                    rows = rows[~np.isnan(d[rows])]
            parts.append((np.full(len(rows), r), rows, d[rows]))
        at, rows, d = (np.concatenate([p[i] for p in parts]) if parts else np.empty(0, int if i < 2 else float) for i in range(3))
        return pa.table([own.take(pa.array(at)), ids.take(pa.array(rows)), pa.array(d, pa.float64())], names=["q", "t", "d"])

    keys = ["block", "size", "slice"]
    met = q.groupBy(*keys).cogroup(t.groupBy(*keys)).applyInArrow(search, f"q {kinds['q']}, t {kinds['t']}, d double").withColumn("d", F.round("d", digits))
    best = first_per_group(met, ["q"], ["d", "t"], k)
    return best.select(F.col("q").alias(query_id), F.col("t").alias(item_id), F.col("d").alias("distance"), F.row_number().over(Window.partitionBy("q").orderBy("d", "t")).alias("rank"))


def model_matrix(models: DataFrame, audio: DataFrame, baseline: str | None = None, most: int = 10_000) -> DataFrame:
    """Every model with every file, the baseline first, duplicates dropped; more than ``most`` models are refused.

    Both lists keep their first occurrence's order (columns ``pos``).
    """
    m = models.groupBy("model_id").agg(F.min("pos").alias("m_pos"))
    if baseline is not None:
        m = m.withColumn("m_pos", F.when(F.col("model_id") == baseline, -1).otherwise(F.col("m_pos")))
    a = audio.groupBy("audio_file").agg(F.min("pos").alias("a_pos"))
    if m.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} models")
    listed = m.agg(F.array_sort(F.collect_list(F.struct("m_pos", "model_id"))).alias("ms"))
    return a.join(F.broadcast(listed)).select("audio_file", "a_pos", F.explode("ms").alias("m")).select("m.model_id", "m.m_pos", "audio_file", "a_pos")


def comparison(runs: DataFrame, models: list[str]) -> DataFrame:
    """One row for each file with every model's transcript, translation, time and status."""
    status = F.when(F.col("error").isNotNull(), "FAIL").otherwise("OK")
    cell = [F.first("transcript").alias("transcript"), F.first("translation").alias("translation"), F.first(F.round("elapsed_s", 2)).alias("time"), F.first(status).alias("status")]
    return runs.groupBy("audio_file").pivot("model_id", models).agg(*cell)


def language_histogram(detected: DataFrame, means: tuple[str, ...] = ()) -> DataFrame:
    """Rows of each detected language, the most frequent first, with means of the named rates."""
    return detected.groupBy("language").agg(F.count("*").alias("n"), *[F.avg(c).alias(f"mean_{c}") for c in means]).orderBy(F.desc("n"), "language")
