"""Streams over a supplied table, run until nothing is left; the result is that of the batch."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parlance.plans import fixtures as fx
from parlance.plans.ratings import FLAG
from parlance.storage import fresh_path, store
from parlance.streaming import live


def q_stream_quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality flags of events counted by the hour of their arrival."""
    events = _arriving(spark, sf_dir, "events")
    i = F.col("event_id")
    clip = F.when(i % 10 == 0, i % 200 / 100.0).otherwise(i % 10 / 100.0)
    rows = events.select(F.col("ts").cast("timestamp").alias("ts"), (i * 7 % 400 / 10.0).alias("snr"), (i * 13 % 100).alias("speech_pct"), clip.alias("clip_pct"), (i * 11 % 45 - 60).alias("rms"))
    out = fresh_path(spark, "quality-counts")
    counts = live.quality_counts(rows, delay="1000 days")
    live.write_changed(counts, out, fresh_path(spark, "quality-checkpoint")).awaitTermination()
    return live.newest(spark, out, ["window", "quality"]).select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("hour"), "quality", "n")


STREAM_SQL = f"""SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour, {FLAG} AS quality, count(*) AS n
FROM (SELECT m.*, CAST(round(speech_ratio * 100) AS INT) AS pct, e.ts FROM {fx.METRICS} m JOIN events e ON m.file_path = CAST(e.event_id AS VARCHAR)) GROUP BY ALL"""



def _arriving(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table as a stream, be it one file or a folder of files."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    # a pattern that only this name matches: a plain path would have to be a folder
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def q_stream_new_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents through a step as they arrive, in two runs with one checkpoint: the second finds nothing new."""
    out, checkpoint = fresh_path(spark, "new-documents"), fresh_path(spark, "new-checkpoint")
    step = lambda df: df.select("doc_id", "source", F.md5(F.col("text").cast("binary")).alias("text"))
    for _ in range(2):
        live.process_new(_arriving(spark, sf_dir, "documents"), step, out, checkpoint).awaitTermination()
    return spark.read.parquet(out).select("doc_id", "source", "text")


def in_files(rows: DataFrame, part: Column, n: int, label: str) -> DataFrame:
    """rows as a stream that gets one file a trigger: n files one after the other, by the number in ``part``."""
    spark = rows.sparkSession
    path = fresh_path(spark, label)
    numbered = store(rows.withColumn("_part", part), label)
    for k in range(n):
        numbered.filter(F.col("_part") == k).drop("_part").coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


@contextmanager
def state_in_rocks(spark: SparkSession) -> Iterator[None]:
    """Processors keep their state in RocksDB; the session's setting is put back."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def q_stream_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source up to a cap over five triggers of documents, by a count in keyed state; the cap is the feature."""
    d = fx.table(spark, sf_dir, "documents").select(F.col("source").alias("src"), F.col("doc_id").alias("id"))
    last = d.agg(F.max("id")).first()[0] or 0
    stream = in_files(d, F.floor(F.col("id") * 5 / F.lit(last + 1)), 5, "capped-in")
    out = fresh_path(spark, "capped-documents")
    with state_in_rocks(spark):
        live.process_new(live.capped(stream, 25, ["src"], "id"), lambda df: df, out, fresh_path(spark, "capped-checkpoint")).awaitTermination()
    return spark.read.parquet(out).select("src", "id")


def q_stream_late_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns in six triggers, up to four hours out of order, merged in order as the watermark passes: the batch's result."""
    e = fx.table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    us = F.unix_micros(ts)
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))  # narrow rows of one user
    rows = e.select(
        F.col("user_id").cast("string").alias("recording_id"), place.alias("pos"), F.concat(F.lit("S"), (F.col("event_id") % 2).cast("string")).alias("speaker_id"), F.lit("eng").alias("language"),
        (us / 1e6).alias("start_s"), ((us + F.floor(F.col("value") * 6e8)) / 1e6).alias("end_s"), F.col("event_type").alias("raw_text"), ts.alias("at"),
    )
    first, last = (r.timestamp() for r in e.agg(F.min(ts), F.max(ts)).first())
    late = F.pmod(F.xxhash64("recording_id", "pos"), F.lit(4 * 3600))
    part = F.least(F.lit(5), F.floor((F.col("start_s") + late - first) * 6 / (last - first + 4 * 3600))).cast("int")
    # one row of a recording of its own lets the watermark pass all others
    flush = spark.range(1).select(F.lit("").alias("recording_id"), F.lit(1).alias("pos"), F.lit("S0").alias("speaker_id"), F.lit("eng").alias("language"), F.lit(0.0).alias("start_s"), F.lit(0.0).alias("end_s"), F.lit("").alias("raw_text"), F.timestamp_seconds(F.lit(last + 3e8)).alias("at"))
    stream = in_files(rows.unionByName(flush), F.when(F.col("recording_id") == "", 6).otherwise(part), 7, "late-turns")
    out = fresh_path(spark, "late-merged")
    with state_in_rocks(spark):
        live.process_new(live.merge_late_turns(stream, delay="4 hours"), lambda df: df, out, fresh_path(spark, "late-checkpoint")).awaitTermination()
    m = spark.read.parquet(out)
    return m.select("recording_id", "pos", "speaker_id", "n_merged", F.md5(F.col("raw_text").cast("binary")).alias("text"))


LATE_SQL = f"""
WITH r AS (SELECT CAST(user_id AS VARCHAR) AS recording_id, row_number() OVER (PARTITION BY user_id ORDER BY t0, event_id) AS pos, 'S' || event_id % 2 AS speaker_id, event_type AS txt, t0, t1 FROM {fx.TIMED}),
b AS (SELECT *, (lag(speaker_id) OVER w IS DISTINCT FROM speaker_id OR t0 - lag(t1) OVER w > 500000)::INT AS new FROM r WINDOW w AS (PARTITION BY recording_id ORDER BY pos)),
i AS (SELECT *, sum(new) OVER (PARTITION BY recording_id ORDER BY pos) AS k FROM b)
SELECT recording_id, CAST(min(pos) AS INT) AS pos, any_value(speaker_id) AS speaker_id, CAST(count(*) AS INT) AS n_merged, md5(string_agg(txt, ' ' ORDER BY pos)) AS text FROM i GROUP BY recording_id, k
"""


def q_stream_first_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated user and kind pairs within the watermark are dropped as events arrive."""
    e = _arriving(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    out = fresh_path(spark, "first-visits")
    live.process_new(live.without_repeats(e, ["user_id", "event_type"], "ts", "1000 days"), lambda df: df, out, fresh_path(spark, "visits-checkpoint")).awaitTermination()
    return spark.read.parquet(out).select("user_id", "event_type").distinct()


def q_stream_merged_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns merged as they arrive, with a closing row for every recording: the batch's result."""
    e = _arriving(spark, sf_dir, "events")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = e.select(
        F.col("user_id").cast("string").alias("recording_id"), F.col("event_id").cast("int").alias("pos"), F.concat(F.lit("S"), (F.col("event_id") % 2).cast("string")).alias("speaker_id"), F.lit("eng").alias("language"),
        (us / 1e6).alias("start_s"), ((us + F.floor(F.col("value") * 6e8)) / 1e6).alias("end_s"), F.col("event_type").alias("raw_text"),
    )
    # the last place closes a recording, so it is given with every row and counts once
    close = e.select(F.col("user_id").cast("string").alias("recording_id"), F.lit(2**31 - 1).alias("pos"), F.lit(None).cast("string").alias("speaker_id"), F.lit("eng").alias("language"), F.lit(0.0).alias("start_s"), F.lit(0.0).alias("end_s"), F.lit("").alias("raw_text"))
    out = fresh_path(spark, "merged-turns")
    with state_in_rocks(spark):
        live.process_new(live.merge_turns(rows.unionByName(close)), lambda df: df, out, fresh_path(spark, "merged-checkpoint")).awaitTermination()
    m = spark.read.parquet(out)
    return m.select("recording_id", F.col("pos").cast("long").alias("pos"), "speaker_id", "n_merged", F.md5(F.col("raw_text").cast("binary")).alias("text"))


MERGED_SQL = f"""
WITH r AS (SELECT CAST(user_id AS VARCHAR) AS recording_id, event_id AS pos, 'S' || event_id % 2 AS speaker_id, event_type AS txt, t0, t1 FROM {fx.TIMED}),
b AS (SELECT *, (lag(speaker_id) OVER w IS DISTINCT FROM speaker_id OR t0 - lag(t1) OVER w > 500000)::INT AS new FROM r WINDOW w AS (PARTITION BY recording_id ORDER BY pos)),
i AS (SELECT *, sum(new) OVER (PARTITION BY recording_id ORDER BY pos) AS k FROM b)
SELECT recording_id, min(pos) AS pos, any_value(speaker_id) AS speaker_id, CAST(count(*) AS INT) AS n_merged, md5(string_agg(txt, ' ' ORDER BY pos)) AS text FROM i GROUP BY recording_id, k
"""

QUERIES = {
    "q_stream_quality_counts": (q_stream_quality_counts, STREAM_SQL),
    "q_stream_new_documents": (q_stream_new_documents, "SELECT doc_id, source, md5(text) AS text FROM documents"),
    "q_stream_capped": (q_stream_capped, "SELECT source AS src, doc_id AS id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents) WHERE k <= 25"),
    "q_stream_first_visits": (q_stream_first_visits, "SELECT DISTINCT user_id, event_type FROM events"),
    "q_stream_merged_turns": (q_stream_merged_turns, MERGED_SQL),
    "q_stream_late_turns": (q_stream_late_turns, LATE_SQL),
}
