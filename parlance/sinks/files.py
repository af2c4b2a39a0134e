"""Writers of tables and reports. All are Spark's own sinks; text is made by column functions before."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.functions.times import three_decimals


def append_json_lines(df: DataFrame, path: str) -> None:
    """One object a line, characters as they are, added to what is there."""
    df.write.mode("append").json(path)


def training_shards(df: DataFrame, path: str) -> None:
    """text, audio bytes and size under version=0/corpus=/split=/language= folders; a split without rows has none."""
    rows = df.select("text", F.col("audio_bytes").cast("binary").alias("audio_bytes"), F.octet_length("audio_bytes").cast("long").alias("audio_size"), F.lit(0).alias("version"), "corpus", "split", "language")
    rows.write.mode("append").partitionBy("version", "corpus", "split", "language").parquet(path)


def csv_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def json_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def runs_report(runs: DataFrame, path: str) -> None:
    """Model runs with times rounded to two places."""
    times = {c: F.round(c, 2) for c in ("elapsed_s", "translation_elapsed_s") if c in runs.columns}
    runs.withColumns(times).write.mode("overwrite").json(path)


def reference_files(refs: DataFrame, path: str) -> None:
    """file and transcript as JSON and as tab-separated lines."""
    rows = refs.select("file", "transcript")
    rows.write.mode("overwrite").json(f"{path}/json")
    rows.write.mode("overwrite").option("sep", "\t").option("quote", "\u0000").csv(f"{path}/tsv")


def comparison_text(runs: DataFrame) -> DataFrame:
    """Per file, in first-seen order, a text block with each model's status, time and transcript.

    runs carries ``pos``; a run without an error is OK, and a time of zero is shown as a dash.
    """
    status = F.when(F.col("error").isNotNull(), "FAIL").otherwise("OK")
    shown = F.when(F.coalesce("elapsed_s", F.lit(0.0)) == 0, "-").otherwise(F.format_string("%.1fs", "elapsed_s"))
    line = F.concat(F.lit("  ["), status, F.lit("] "), "model_id", F.lit(" ("), shown, F.lit("): "), F.coalesce("error", "transcript", F.lit("")))
    per = runs.groupBy("audio_file").agg(F.min("pos").alias("pos"), F.array_sort(F.collect_list(F.struct("pos", line.alias("line")))).alias("lines"))
    return per.select("pos", "audio_file", F.concat_ws("\n", "audio_file", F.array_join(F.transform("lines", lambda x: x["line"]), "\n")).alias("value"))


def write_turns(regions: DataFrame, path: str, label: str = "speech") -> None:
    """Speaker-file lines with three decimals; empty regions are left out."""
    turn_lines(regions, label).write.mode("overwrite").text(path)


def turn_lines(regions: DataFrame, label: str = "speech") -> DataFrame:
    d = F.col("end_s") - F.col("start_s")
    return regions.filter(d > 0).select(F.format_string("SPEAKER %s 1 %s %s <NA> <NA> %s <NA> <NA>", "recording_id", three_decimals(F.col("start_s")), three_decimals(d), F.lit(label)).alias("value"))


def write_manifest(audio: DataFrame, path: str) -> None:
    """One object for each recording: file, offset, length and open fields."""
    audio.select(F.col("path").alias("audio_filepath"), F.lit(0.0).alias("offset"), F.col("duration_s").alias("duration"), F.lit("infer").alias("label"), F.lit("-").alias("text")).write.mode("overwrite").json(path)
