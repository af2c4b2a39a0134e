"""Assembly of interviews from several files, and the transcript's timeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.functions.times import absolute, file_speaker


def file_index(files: DataFrame) -> DataFrame:
    """files (interview_key, path, recording_start, failed) that succeeded, numbered from one in start order."""
    w = Window.partitionBy("interview_key").orderBy("recording_start", "path")
    return files.filter(~F.coalesce(F.col("failed"), F.lit(False))).withColumn("file_idx", F.row_number().over(w))


def place(segments: DataFrame, files: DataFrame) -> DataFrame:
    """segments (path, pos, …) with their interview, absolute times and speakers named by file."""
    f = files.select("path", "interview_key", "recording_start", "file_idx")
    s = segments.join(f, "path")
    s = s.withColumns({"absolute_start": absolute(F.col("recording_start"), F.col("start_s")), "absolute_end": absolute(F.col("recording_start"), F.col("end_s"))})
    return s.withColumn("speaker_id", file_speaker(F.col("speaker_id"), F.col("file_idx")))


def merge_order(placed: DataFrame) -> DataFrame:
    """Segments numbered from zero over their interview by clock time, then file, then position."""
    w = Window.partitionBy("interview_key").orderBy("absolute_start", "file_idx", "pos")
    return placed.withColumn("segment_id", F.row_number().over(w) - 1)


def union_of(c: str) -> Column:
    return F.array_sort(F.array_distinct(F.flatten(F.collect_set(c))))


def roll_up(files: DataFrame) -> DataFrame:
    """One row for each interview: times, sums, and sorted unions of what its files have."""
    end = F.timestamp_micros(F.unix_micros(F.col("recording_start").cast("timestamp")) + (F.col("duration_s") * 1e6).cast("long")).cast("timestamp_ntz")
    order = F.struct("recording_start", "path")
    return files.groupBy("interview_key").agg(
        F.min("recording_start").alias("recording_start"), F.max(end).alias("recording_end"), F.sum("duration_s").alias("total_duration_s"),
        F.sum("num_speakers").alias("num_speakers"), F.count("*").alias("n_files"), union_of("languages").alias("languages"), union_of("engines").alias("engines"),
        union_of("stages").alias("stages"), F.min_by("uuid", order).alias("interview_id"), F.min_by("style", order).alias("style"),
    ).withColumn("recording_date", F.date_format("recording_start", "yyyy-MM-dd"))


def timeline(speech: DataFrame, non_speech: DataFrame) -> DataFrame:
    """Both kinds of rows of a recording with one order: by start, speech before gaps, then by position."""
    both = speech.withColumn("kind", F.lit(0)).unionByName(non_speech.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    return both.withColumn("line", F.row_number().over(Window.partitionBy("recording_id").orderBy("start_s", "kind", "pos")))


def language_set(requested: Column, seen: Column) -> Column:
    """The requested language, then those seen besides it, in their order."""
    return F.array_union(F.array(requested), seen)


def joined_text(segments: DataFrame) -> DataFrame:
    """Per recording the texts in order: corrected, else raw, blank ones left out."""
    text = F.coalesce(F.nullif(F.trim("corrected_text"), F.lit("")), F.trim("raw_text"))
    rows = segments.select("recording_id", "pos", text.alias("t")).filter("t <> ''")
    return rows.groupBy("recording_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "t"))), lambda x: x["t"]), " ").alias("text"))
