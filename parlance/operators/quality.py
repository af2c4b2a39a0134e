"""Quality rules over metrics, summaries, scores and rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FLAGS = ("EXCELLENT", "GOOD", "FAIR", "LOW SPEECH", "OK", "POOR", "BAD", "CLIPPED", "MUTED", "EMPTY", "BROKEN")
UNUSABLE = ("BAD", "POOR", "CLIPPED", "MUTED", "BROKEN", "EMPTY")
MEANS = ("duration_s", "snr_db", "clipping_ratio", "spectral_rolloff_hz", "effective_bandwidth_hz", "crosstalk_ratio", "rms_dbfs", "speech_ratio")
# Weights of the composite score, and whether a low value is good.
WEIGHTS = {"avg_snr_db": (0.35, False), "avg_crosstalk_ratio": (0.25, True), "avg_clipping_ratio": (0.15, True), "avg_effective_bandwidth_hz": (0.15, False), "total_plosive_spikes": (0.10, True)}


def classify(snr: Column, speech_pct: Column, clip_pct: Column, rms: Column, duration_s: Column | None = None) -> Column:
    """(flag, score, comment) of a recording; the first rule that holds decides."""
    clipped = F.greatest(F.lit(10), F.lit(40) - F.least(F.lit(100), F.floor(clip_pct * 30).cast("int")))
    say = lambda fmt, *c: F.format_string(fmt, *[x.cast("double") for x in c])
    rules: list[tuple[Column, str, Column | int, Column]] = [
        (clip_pct > 1, "CLIPPED", clipped, say("%.2f%% of samples clipped", clip_pct)),
        (clip_pct > 0.1, "CLIPPED", 60, say("%.2f%% of samples clipped", clip_pct)),
        (rms < -55, "MUTED", 0, say("level %.1f dBFS", rms)),
        (rms < -45, "BAD", 15, say("level %.1f dBFS", rms)),
        (snr < 6, "BAD", 10, say("SNR %.1f dB", snr)),
        (snr < 10, "POOR", 25, say("SNR %.1f dB", snr)),
        (snr < 13, "POOR", 40, say("SNR %.1f dB", snr)),
        (speech_pct < 10, "EMPTY", 30, say("%.0f%% speech", speech_pct)),
        (speech_pct < 25, "LOW SPEECH", 55, say("%.0f%% speech", speech_pct)),
        ((snr >= 25) & (speech_pct >= 50) & (clip_pct < 0.05), "EXCELLENT", 95, say("SNR %.1f dB, %.0f%% speech", snr, speech_pct)),
        ((snr >= 20) & (speech_pct >= 35), "GOOD", 85, say("SNR %.1f dB, %.0f%% speech", snr, speech_pct)),
        ((snr >= 15) & (speech_pct >= 25), "FAIR", 65, say("SNR %.1f dB, %.0f%% speech", snr, speech_pct)),
        (F.lit(True), "FAIR", 50, say("SNR %.1f dB, %.0f%% speech, borderline", snr, speech_pct)),
    ]
    if duration_s is not None:
        rules.insert(0, ((duration_s > 0) & (duration_s < 1), "BROKEN", 0, say("only %.2f s", duration_s)))
    out: Column | None = None
    for holds, flag, score, comment in rules:
        value = F.struct(F.lit(flag).alias("flag"), (score if isinstance(score, Column) else F.lit(score)).alias("score"), comment.alias("comment"))
        out = F.when(holds, value) if out is None else out.when(holds, value)
    return out


def folder_flag(snr: Column, speech_pct: Column) -> Column:
    good = (snr >= 20) & (speech_pct >= 40)
    low = (snr >= 15) & (speech_pct < 25)
    return F.when(snr < 8, "BAD").when(snr < 12, "POOR").when(good, "GOOD").when(low, "LOW SPEECH").when((snr >= 12) & (speech_pct >= 30), "OK").otherwise("OK borderline")


def gap_class(rms_dbfs: Column, flatness: Column, has_wave: Column) -> Column:
    """What a stretch without speech is: silence, noise or music; non_speech without a waveform."""
    quiet = rms_dbfs.isNull() | (rms_dbfs < -50)
    return F.when(~has_wave, "non_speech").when(quiet, "silence").when(flatness > 0.5, "noise").otherwise("music")


def usable(df: DataFrame, force: bool = False, limit: int | None = None, order: str = "file_path") -> DataFrame:
    """Rows worth an expensive stage; to be put before it, since nothing is pushed below a Python stage."""
    kept = df if force else df.filter(~F.col("quality").isin(*UNUSABLE))
    return kept if limit is None else kept.orderBy(order).limit(limit)


def recording_quality(gaps: DataFrame, totals: DataFrame) -> DataFrame:
    """One row for each recording from its non-speech regions; none for one without gaps and length."""
    d = F.col("end_s") - F.col("start_s")
    g = gaps.groupBy("recording_id").agg(F.sum(d).alias("ns"), F.count("*").alias("n"), F.max(d).alias("longest"))
    t = totals.join(g, "recording_id", "left").filter((F.col("total_s") > 0) | F.col("n").isNotNull())
    ns, n = F.coalesce("ns", F.lit(0.0)), F.coalesce("n", F.lit(0))
    speech = F.greatest(F.lit(0.0), F.col("total_s") - ns)
    return t.select(
        "recording_id",
        F.round("total_s", 1).alias("total_duration_s"),
        F.round(speech, 1).alias("speech_duration_s"),
        F.round(ns, 1).alias("non_speech_duration_s"),
        F.round(F.when(F.col("total_s") > 0, speech / F.col("total_s")).otherwise(0.0), 3).alias("speech_ratio"),
        (n + 1).alias("num_speech_regions"),
        n.alias("num_non_speech_regions"),
        F.round(F.when(n > 0, ns / n).otherwise(0.0), 1).alias("avg_silence_s"),
        F.round(F.coalesce("longest", F.lit(0.0)), 1).alias("longest_silence_s"),
    )


def mic_summary(files: DataFrame, with_files: bool = False) -> DataFrame:
    """Per microphone: files, means, spikes; nested file rows only if asked for, as they grow with the input."""
    nested = [F.array_sort(F.collect_list(F.struct("file_path", *[c for c in files.columns if c != "file_path"]))).alias("files")] if with_files else []
    return files.groupBy("mic_name").agg(F.count("*").alias("num_files"), *[F.avg(c).alias(f"avg_{c}") for c in MEANS], F.sum("plosive_spike_count").alias("total_plosive_spikes"), *nested)


def folder_summary(files: DataFrame, order: str | Column = "file_path") -> DataFrame:
    """One row for each folder. Sums of doubles run through its files by ``order``, so that they are the same in every run.

    Sums in an open order differ in their last digits, and so do means that lie on a half of the last digit shown or on
    the bound of a flag. A folder's sorted files are one partition of a window, which Spark spills where it is large.
    """
    w = Window.partitionBy("folder_key").orderBy(order)
    so_far = {
        "n_files": F.count("*"), "mic": F.min_by("mic_name", "file_path"), "total_s": F.sum("duration_s"),
        "snr_db": F.avg("snr_db"), "speech_pct": F.avg("speech_ratio"), "clip_pct": F.avg("clipping_ratio"),
        "crosstalk": F.avg("crosstalk_ratio"), "rms_dbfs": F.avg("rms_dbfs"), "rolloff_hz": F.avg("spectral_rolloff_hz"),
        "bandwidth_hz": F.avg("effective_bandwidth_hz"), "plosives": F.sum("plosive_spike_count"),
    }
    rows = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = files.select("folder_key", *[c.over(rows).alias(name) for name, c in so_far.items()], F.lead(F.lit(True)).over(w).isNull().alias("last"))
    s = s.filter("last").drop("last").withColumns({c: F.col(c) * 100 for c in ("speech_pct", "clip_pct")})
    return s.withColumn("quality", folder_flag(F.col("snr_db"), F.col("speech_pct")))


def with_footer(df: DataFrame, label: str, numeric: list[str], flag: str) -> DataFrame:
    """df and one more row: means of the numeric columns, and ``flag:n | flag:n`` of the flags."""
    tally = df.groupBy(flag).agg(F.count("*").alias("n")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(flag, "n"))), lambda x: F.concat(x[flag], F.lit(":"), x["n"].cast("string"))), " | ").alias("tally"))
    foot = df.agg(*[F.avg(c).alias(c) for c in numeric]).join(tally)
    values = {c: F.col(c) for c in numeric} | {label: F.lit("MEAN"), flag: F.col("tally")}
    row = foot.select(*[values.get(c, F.lit(None).cast(df.schema[c].dataType)).alias(c) for c in df.columns])
    return df.select(*[F.col(c).cast("double").alias(c) if c in numeric else c for c in df.columns]).unionByName(row)


def distribution(df: DataFrame, flag: str = "quality", means: tuple[str, ...] = ()) -> DataFrame:
    """Count, percentage and means of the named metrics of each flag that occurs, in the fixed order."""
    n = df.groupBy(flag).agg(F.count("*").alias("n"), *[F.avg(c).alias(f"mean_{c}") for c in means])
    order = F.array_position(F.array(*map(F.lit, FLAGS)), F.col(flag))
    # a handful of flags: the window over them has no key because there is nothing to cut them by
    return n.withColumn("pct", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy()), 1)).withColumn("ord", order)


def composite_score(summary: DataFrame, key: str = "mic_name") -> DataFrame:
    """summary with ``score``: weighted min-max values over all rows; all equal counts as one."""
    all_ = Window.partitionBy()
    total: Column = F.lit(0.0)
    for c, (weight, low) in WEIGHTS.items():
        lo, hi = F.min(c).over(all_), F.max(c).over(all_)
        part = (F.col(c) - lo) / (hi - lo)
        total += weight * F.when(hi == lo, 1.0).otherwise(1 - part if low else part)
    return summary.withColumn("score", F.round(total, 4))


def recommend(scored: DataFrame, key: str = "mic_name") -> DataFrame:
    """Rank by score, and what each is best and worst at."""
    all_ = Window.partitionBy()
    best = [
        ("avg_snr_db", F.max, "best SNR (%.1f dB)"), ("avg_crosstalk_ratio", F.min, "lowest crosstalk (%.4f)"), ("avg_clipping_ratio", F.min, "lowest clipping (%.6f)"),
        ("avg_effective_bandwidth_hz", F.max, "widest bandwidth (%.0f Hz)"), ("total_plosive_spikes", F.min, "fewest plosive spikes (%.0f)"),
    ]
    worst = [("avg_snr_db", F.min, "lowest SNR (%.1f dB)"), ("avg_crosstalk_ratio", F.max, "highest crosstalk (%.4f)"), ("avg_clipping_ratio", F.max, "most clipping (%.6f)")]
    say = lambda rules, more: F.array_compact(F.array(*[F.when((F.col(c) == f(c).over(all_)) & more, F.format_string(t, F.col(c).cast("double"))) for c, f, t in rules]))
    return scored.select(
        "*",
        F.row_number().over(all_.orderBy(F.desc("score"), key)).alias("rank"),
        F.array_join(say(best, F.lit(True)), ", ").alias("strengths"),
        F.array_join(say(worst, F.count("*").over(all_) > 1), ", ").alias("weaknesses"),
    )


def highlight(df: DataFrame, columns: dict[str, bool]) -> DataFrame:
    """df with c_best and c_worst flags for each column; the value says whether high is good."""
    all_ = Window.partitionBy()
    for c, high in columns.items():
        lo, hi = F.min(c).over(all_), F.max(c).over(all_)
        df = df.withColumns({f"{c}_best": F.col(c) == (hi if high else lo), f"{c}_worst": F.col(c) == (lo if high else hi)})
    return df


def upsert_files(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows over old ones of the same key. Summaries and scores are to be made again from the result."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)
