"""Interviews from conversations: merge order, roll-ups, transcripts, context, model steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.functions.times import iso_ms
from parlance.operators import interviews, postprocess
from parlance.plans import fixtures as fx
from parlance.sinks import transcripts


def placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each file's text as two segments, on the interview's clock."""
    f = interviews.file_index(fx.interview_files(spark, sf_dir))
    s = fx.interview_files(spark, sf_dir).select("path", F.explode(F.array(F.lit(0), F.lit(1))).alias("pos"), "speaker", "text", "duration_s")
    half = F.floor(F.length("text") / 2).cast("int")
    s = s.select(
        "path", "pos", F.concat(F.lit("SPEAKER_"), "speaker").alias("speaker_id"), F.lit("eng").alias("language"),
        F.when(F.col("pos") == 0, F.left("text", half)).otherwise(F.substring("text", half + 1, F.length("text"))).alias("raw_text"),
        (F.col("pos") * F.col("duration_s") / 2).alias("start_s"), ((F.col("pos") + 1) * F.col("duration_s") / 2).alias("end_s"),
    )
    return interviews.merge_order(interviews.place(s, f))


def q_interview_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placed(spark, sf_dir).select("interview_key", "segment_id", "path", "pos", "file_idx", "speaker_id", iso_ms(F.col("absolute_start")).alias("starts"), F.md5(F.col("raw_text").cast("binary")).alias("text"))


SEGMENTS = f"""(SELECT *, row_number() OVER (PARTITION BY interview_key ORDER BY ms, file_idx, pos) - 1 AS segment_id FROM (
  SELECT f.*, p AS pos, dense_rank() OVER (PARTITION BY interview_key ORDER BY turn) AS file_idx, 1704067200000 + turn * 60000 + CAST(floor(round(p * duration_s / 2 * 1000000) / 1000) AS BIGINT) AS ms,
    CASE WHEN p = 0 THEN left(text, CAST(length(text) // 2 AS INT)) ELSE substring(text, length(text) // 2 + 1) END AS half
  FROM {fx.FILES} f, (VALUES (0), (1)) v(p)))"""
SEGMENTS_SQL = f"""SELECT interview_key, CAST(segment_id AS INT) AS segment_id, path, CAST(pos AS INT) AS pos, CAST(file_idx AS INT) AS file_idx, 'SPEAKER_F' || file_idx || '_' || role AS speaker_id,
  strftime(make_timestamp(ms * 1000), '%Y-%m-%dT%H:%M:%S.%g') AS starts, md5(half) AS text FROM {SEGMENTS}"""


def q_interview_roll_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = interviews.roll_up(fx.interview_files(spark, sf_dir))
    return r.select("interview_key", iso_ms(F.col("recording_start")).alias("starts"), F.round("total_duration_s", 4).alias("total_s"), "n_files", "num_speakers", F.array_join("languages", ",").alias("languages"), "interview_id", "recording_date")


ROLL_UP_SQL = f"""SELECT interview_key, strftime(make_timestamp(1704067200000000 + min(t0)), '%Y-%m-%dT%H:%M:%S.%g') AS starts, round(sum(duration_s), 4) AS total_s, count(*) AS n_files, count(*) AS num_speakers,
  string_agg(DISTINCT role, ',' ORDER BY role) AS languages, arg_min(md5(path), turn) AS interview_id, '2024-01-01' AS recording_date FROM {fx.FILES} GROUP BY interview_key"""


def q_interview_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = placed(spark, sf_dir).select(F.col("interview_key").alias("recording_id"), F.col("segment_id").alias("pos"), "raw_text", F.lit(None).cast("string").alias("corrected_text"))
    return interviews.joined_text(s).select("recording_id", F.md5(F.col("text").cast("binary")).alias("text"))


TEXT_SQL = f"SELECT interview_key AS recording_id, md5(string_agg(trim(half, ' '), ' ' ORDER BY segment_id)) AS text FROM {SEGMENTS} WHERE trim(half, ' ') <> '' GROUP BY ALL"


def q_subtitles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subtitles of every file, as digests."""
    s = placed(spark, sf_dir).select(F.col("path").alias("recording_id"), "pos", "start_s", "end_s", "speaker_id", "language", F.col("raw_text").alias("corrected_text"), F.lit(None).cast("string").alias("refined_translation"))
    return transcripts.srt(s).select("recording_id", F.md5(F.col("value").cast("binary")).alias("srt"))


_TS = "printf('%02d:%02d:%02d,%03d', CAST(floor({0} / 3600) AS BIGINT), CAST(floor(({0} % 3600) / 60) AS BIGINT), CAST(floor({0} % 60) AS BIGINT), CAST(floor(({0} % 1) * 1000) AS BIGINT))"
SRT_SQL = f"""SELECT path AS recording_id, md5(string_agg((pos + 1) || chr(10) || {_TS.format("(pos * duration_s / 2)")} || ' --> ' || {_TS.format("((pos + 1) * duration_s / 2)")} || chr(10) || '[SPEAKER_F' || file_idx || '_' || role || '] ' || half || chr(10), chr(10) ORDER BY pos)) AS srt
FROM {SEGMENTS} GROUP BY path"""


def _exclaim():
    def model(rows: list[dict]) -> list[str]:
        return [r["raw_text"] + "!" for r in rows]

    return model


def q_context_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three turns before and after each."""
    s = placed(spark, sf_dir).select(F.col("interview_key").alias("recording_id"), F.col("segment_id").alias("pos"), "speaker_id", "raw_text", F.lit("").alias("english_translation"))
    return postprocess.context(s).select("recording_id", "pos", F.md5(F.col("context").cast("binary")).alias("context"))


CONTEXT_SQL = f"""
WITH l AS (SELECT interview_key, segment_id, '[SPEAKER_F' || file_idx || '_' || role || '] ' || half AS x FROM {SEGMENTS})
SELECT interview_key AS recording_id, CAST(segment_id AS INT) AS pos, md5(concat_ws(chr(10), string_agg(x, chr(10)) OVER (PARTITION BY interview_key ORDER BY segment_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),
  '>>> CURRENT SEGMENT <<<', string_agg(x, chr(10)) OVER (PARTITION BY interview_key ORDER BY segment_id ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING))) AS context FROM l
"""


def q_model_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correction through the guard with a model that exclaims; what is blank stays."""
    s = placed(spark, sf_dir).select(F.col("interview_key").alias("recording_id"), F.col("segment_id").alias("pos"), "language", "raw_text")
    return postprocess.correct(s, _exclaim).select("recording_id", "pos", F.md5(F.col("corrected_text").cast("binary")).alias("corrected"))


STEPS_SQL = rf"SELECT interview_key AS recording_id, CAST(segment_id AS INT) AS pos, md5(CASE WHEN regexp_replace(half, '[\s\x{{85}}\p{{Z}}]', '', 'g') = '' THEN half ELSE regexp_replace(half || '!', '^[\s\x{{85}}\p{{Z}}]+', '') END) AS corrected FROM {SEGMENTS}"


def q_refine_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns in batches of ten by interview."""
    s = placed(spark, sf_dir).select(F.col("interview_key").alias("recording_id"), F.col("segment_id").alias("pos"), "language", F.col("raw_text").alias("english_translation"))
    return postprocess.batches(s).select("recording_id", "pos", "batch", "seq")


BATCH_SQL = f"""SELECT interview_key AS recording_id, CAST(segment_id AS INT) AS pos, CAST(k // 10 AS INT) AS batch, CAST(k % 10 + 1 AS INT) AS seq FROM (
  SELECT interview_key, segment_id, row_number() OVER (PARTITION BY interview_key ORDER BY segment_id) - 1 AS k FROM {SEGMENTS} WHERE trim(half, ' ') <> '')"""

QUERIES = {
    "q_interview_segments": (q_interview_segments, SEGMENTS_SQL),
    "q_interview_roll_up": (q_interview_roll_up, ROLL_UP_SQL),
    "q_interview_text": (q_interview_text, TEXT_SQL),
    "q_subtitles": (q_subtitles, SRT_SQL),
    "q_context_windows": (q_context_windows, CONTEXT_SQL),
    "q_model_steps": (q_model_steps, STEPS_SQL),
    "q_refine_batches": (q_refine_batches, BATCH_SQL),
}
