"""Inputs of the operators derived from the supplied tables by Spark, and the same as SQL table expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORDS = "array<struct<word:string,start_s:double,end_s:double,confidence:double>>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(c: str) -> Column:
    """Seconds as whole tenths of a millisecond, cut where no time of whole or quarter microseconds lies."""
    return F.floor(F.col(c) * 1e4 + 0.123).alias(c)


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    us = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', cast(ts as timestamp_ntz))")
    t0 = us.cast("long")
    return e.select("event_id", "user_id", "event_type", "value", t0.alias("t0"), (t0 + F.floor(F.col("value") * 6e8).cast("long")).alias("t1"))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of even number as segments of their user's recording."""
    e = _timed(spark, sf_dir).filter("event_id % 2 = 0")
    return e.select(
        F.col("user_id").cast("string").alias("recording_id"), F.col("event_id").alias("pos"), F.col("event_id").alias("segment_id"),
        (F.col("t0") / 1e6).alias("start_s"), (F.col("t1") / 1e6).alias("end_s"), F.col("event_type").alias("raw_text"), F.lit("eng").alias("language"),
        (F.col("event_id") % 100 / 100).alias("confidence"), F.lit(None).cast(WORDS).alias("words"),
    )


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of odd number as speaker turns."""
    e = _timed(spark, sf_dir).filter("event_id % 2 = 1")
    return e.select(F.col("user_id").cast("string").alias("recording_id"), F.col("event_id").alias("turn_no"), F.concat(F.lit("SPK_"), "event_type").alias("speaker_id"), (F.col("t0") / 1e6).alias("start_s"), (F.col("t1") / 1e6).alias("end_s"))


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _timed(spark, sf_dir)
    w = F.row_number().over(Window.partitionBy("user_id").orderBy("t0", "event_id"))
    return e.select(F.col("user_id").cast("string").alias("recording_id"), w.alias("pos"), (F.col("t0") / 1e6).alias("start_s"), (F.col("t1") / 1e6).alias("end_s"))


def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _timed(spark, sf_dir).groupBy(F.col("user_id").cast("string").alias("recording_id")).agg(((F.max("t1") + 1_000_000) / 1e6).alias("total_s"))


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric rows of files from event numbers."""
    i = F.col("event_id")
    clip = F.when(i % 10 == 0, i % 200 / 100.0).otherwise(i % 10 / 100.0)
    return table(spark, sf_dir, "events").select(
        i.cast("string").alias("file_path"), F.col("event_type").alias("mic_name"), F.col("user_id").cast("string").alias("folder_key"),
        F.col("value").alias("duration_s"), (i * 7 % 400 / 10.0).alias("snr_db"), (i * 13 % 100 / 100.0).alias("speech_ratio"), clip.alias("clip_pct"),
        (clip / 100).alias("clipping_ratio"), (i * 11 % 45 - 60).cast("double").alias("rms_dbfs"), (i % 9).cast("int").alias("plosive_spike_count"),
        (i * 17 % 8000).cast("double").alias("spectral_rolloff_hz"), (i * 19 % 7000).cast("double").alias("effective_bandwidth_hz"), (i * 3 % 50 / 100.0).alias("crosstalk_ratio"),
    )


def waveform(spark: SparkSession, sf_dir: str, blocks: int = 4) -> DataFrame:
    """Embeddings as 64 samples at 16 Hz in a few blocks. Spectra need blocks no shorter than their frames: one block."""
    n = 64 // blocks
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("recording_id"), "embedding", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block_no"))
    return e.select("recording_id", "block_no", (F.col("block_no") * n).cast("long").alias("start_sample"), F.lit(16).alias("sample_rate"), F.slice("embedding", F.col("block_no") * n + 1, F.lit(n)).alias("samples"))


def joined_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings end to end, 64 of them a recording of 4,096 samples at 16 Hz, each one a block."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.floor(F.col("vec_id") / 64).cast("string").alias("recording_id"), (F.col("vec_id") % 64).cast("int").alias("block_no"), (F.col("vec_id") % 64 * 64).cast("long").alias("start_sample"),
        F.lit(16).alias("sample_rate"), F.col("embedding").alias("samples"),
    )


def interview_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as files of an interview, one a minute."""
    c = table(spark, sf_dir, "conversations")
    start = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(turn as int), 0)")
    return c.select(
        F.col("conv_id").cast("string").alias("interview_key"), F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("path"), "turn",
        F.col("role").alias("speaker"), F.coalesce("text", F.lit("")).alias("text"), start.alias("recording_start"), (F.length(F.coalesce("text", F.lit(""))) / 15).alias("duration_s"),
        F.lit(False).alias("failed"), F.lit(1).alias("num_speakers"), F.array("role").alias("languages"), F.array(F.lit("whisper")).alias("engines"), F.array(F.lit("asr")).alias("stages"),
        F.md5(F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string"))).alias("uuid"), F.lit("verbatim").alias("style"),
    )


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as training samples."""
    d = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    return d.select(F.col("source").alias("src"), F.col("lang").alias("subsource"), F.col("doc_id").alias("id"), text.alias("text"), F.when(F.col("doc_id") % 17 != 0, F.length(text) / 600).alias("wps"), (F.col("doc_id") % 120 / 100).alias("wer"))


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of a conversation as reference, the turn after it as hypothesis, whole: (file, ref, hyp)."""
    c = table(spark, sf_dir, "conversations").filter("text IS NOT NULL").select("conv_id", "turn", "text")
    after = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("hyp"))
    return c.join(after, ["conv_id", "turn"]).select(F.concat_ws("/", "conv_id", "turn").alias("file"), F.col("text").alias("ref"), "hyp")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as runs of speech models, one model for each place in a conversation; every seventh place fails."""
    c = table(spark, sf_dir, "conversations")
    failed = F.col("turn") % 7 == 3
    return c.select(
        F.col("turn").alias("pos"), F.concat(F.lit("m"), F.col("turn").cast("string")).alias("model_id"), F.col("conv_id").cast("string").alias("audio_file"),
        F.when(~failed, F.col("text")).alias("transcript"), F.when(~failed, F.length("text") / 7).alias("elapsed_s"), F.when(failed, "timeout").alias("error"),
        F.lit(None).cast("string").alias("translation"), F.when(F.col("conv_id") % 3 == 0, "eng").otherwise("fra").alias("language"),
    )


TIMED = "(SELECT event_id, user_id, event_type, value, epoch_us(ts) AS t0, epoch_us(ts) + CAST(floor(value * 6e8) AS BIGINT) AS t1 FROM events)"
SEGMENTS = f"(SELECT CAST(user_id AS VARCHAR) AS recording_id, event_id AS pos, t0, t1, event_type AS txt, event_id % 100 AS conf FROM {TIMED} WHERE event_id % 2 = 0)"
TURNS = f"(SELECT CAST(user_id AS VARCHAR) AS recording_id, event_id AS turn_no, 'SPK_' || event_type AS speaker_id, t0, t1 FROM {TIMED} WHERE event_id % 2 = 1)"
REGIONS = f"(SELECT CAST(user_id AS VARCHAR) AS recording_id, row_number() OVER (PARTITION BY user_id ORDER BY t0, event_id) AS pos, t0, t1 FROM {TIMED})"
TOTALS = f"(SELECT CAST(user_id AS VARCHAR) AS recording_id, max(t1) + 1000000 AS total FROM {TIMED} GROUP BY user_id)"
METRICS = """(SELECT CAST(event_id AS VARCHAR) AS file_path, event_type AS mic_name, CAST(user_id AS VARCHAR) AS folder_key, value AS duration_s,
  (event_id * 7 % 400) / 10.0::DOUBLE AS snr_db, (event_id * 13 % 100) / 100.0::DOUBLE AS speech_ratio,
  CASE WHEN event_id % 10 = 0 THEN (event_id % 200) / 100.0::DOUBLE ELSE (event_id % 10) / 100.0::DOUBLE END AS clip_pct,
  CAST(event_id * 11 % 45 - 60 AS DOUBLE) AS rms_dbfs, event_id % 9 AS plosive_spike_count, CAST(event_id * 17 % 8000 AS DOUBLE) AS spectral_rolloff_hz,
  CAST(event_id * 19 % 7000 AS DOUBLE) AS effective_bandwidth_hz, (event_id * 3 % 50) / 100.0::DOUBLE AS crosstalk_ratio FROM events)"""
FILES = """(SELECT CAST(conv_id AS VARCHAR) AS interview_key, CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR) AS path, turn, role, coalesce(text, '') AS text,
  turn * 60000000 AS t0, length(coalesce(text, '')) / 15.0::DOUBLE AS duration_s FROM conversations)"""
PAIRS = """(SELECT source AS src, lang AS subsource, doc_id AS id, coalesce(text, '') AS text, CASE WHEN doc_id % 17 <> 0 THEN length(coalesce(text, '')) / 600.0::DOUBLE END AS wps,
  (doc_id % 120) / 100.0::DOUBLE AS wer FROM documents)"""
#: The other engine's edit distance counts bytes, so accented letters stand as one-byte marks on both sides.
LETTERS = "éèÍÉßêçÇíÈÑüöÖóÓäÜÄÊñáÁúÚ"
MARKS = " || ".join(f"chr({k})" for k in [*range(1, 9), *range(14, 32)][: len(LETTERS)])


def narrow(c: str) -> str:
    return f"translate({c}, '{LETTERS}', {MARKS})"


TURN_PAIRS = f"""(SELECT a.conv_id || '/' || a.turn AS file, {narrow("a.text")} AS ref, {narrow("b.text")} AS hyp FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1
  WHERE a.text IS NOT NULL AND b.text IS NOT NULL)"""
RUNS = """(SELECT turn AS pos, 'm' || turn AS model_id, CAST(conv_id AS VARCHAR) AS audio_file, CASE WHEN turn % 7 <> 3 THEN text END AS transcript, CASE WHEN turn % 7 <> 3 THEN length(text) / 7::DOUBLE END AS elapsed_s,
  CASE WHEN turn % 7 = 3 THEN 'timeout' END AS error, CASE WHEN conv_id % 3 = 0 THEN 'eng' ELSE 'fra' END AS language FROM conversations)"""
