"""Quality rules, summaries, scores and rankings over metric rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.operators import quality, speakers
from parlance.plans import fixtures as fx

FLAG = """CASE WHEN clip_pct > 1 THEN 'CLIPPED' WHEN clip_pct > 0.1 THEN 'CLIPPED' WHEN rms_dbfs < -55 THEN 'MUTED' WHEN rms_dbfs < -45 THEN 'BAD' WHEN snr_db < 6 THEN 'BAD'
  WHEN snr_db < 10 THEN 'POOR' WHEN snr_db < 13 THEN 'POOR' WHEN pct < 10 THEN 'EMPTY' WHEN pct < 25 THEN 'LOW SPEECH' WHEN snr_db >= 25 AND pct >= 50 AND clip_pct < 0.05 THEN 'EXCELLENT'
  WHEN snr_db >= 20 AND pct >= 35 THEN 'GOOD' WHEN snr_db >= 15 AND pct >= 25 THEN 'FAIR' ELSE 'FAIR' END"""
SCORE = """CASE WHEN clip_pct > 1 THEN greatest(10, 40 - least(100, CAST(floor(clip_pct * 30) AS INT))) WHEN clip_pct > 0.1 THEN 60 WHEN rms_dbfs < -55 THEN 0 WHEN rms_dbfs < -45 THEN 15 WHEN snr_db < 6 THEN 10
  WHEN snr_db < 10 THEN 25 WHEN snr_db < 13 THEN 40 WHEN pct < 10 THEN 30 WHEN pct < 25 THEN 55 WHEN snr_db >= 25 AND pct >= 50 AND clip_pct < 0.05 THEN 95
  WHEN snr_db >= 20 AND pct >= 35 THEN 85 WHEN snr_db >= 15 AND pct >= 25 THEN 65 ELSE 50 END"""
RATED = f"(SELECT *, {FLAG} AS quality, {SCORE} AS score FROM (SELECT *, CAST(round(speech_ratio * 100) AS INT) AS pct FROM {fx.METRICS}))"


def rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fx.metrics(spark, sf_dir).withColumn("pct", F.round(F.col("speech_ratio") * 100).cast("int"))
    return m.withColumn("c", quality.classify(F.col("snr_db"), F.col("pct"), F.col("clip_pct"), F.col("rms_dbfs"))).withColumns({"quality": F.col("c.flag"), "score": F.col("c.score")})


def q_file_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rated(spark, sf_dir).select("file_path", "quality", F.col("score").cast("int").alias("score"))


def q_quality_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = quality.distribution(rated(spark, sf_dir), means=("duration_s", "snr_db", "pct"))
    return d.select("quality", "n", "pct", *[F.round(f"mean_{c}", 4).alias(f"mean_{c}") for c in ("duration_s", "snr_db", "pct")])


DISTRIBUTION_SQL = f"SELECT quality, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 1) AS pct, round(avg(duration_s), 4) AS mean_duration_s, round(avg(snr_db), 4) AS mean_snr_db, round(avg(pct), 4) AS mean_pct FROM {RATED} GROUP BY quality"


def q_usable_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.usable(rated(spark, sf_dir)).select("file_path", "quality")


def rounded(c: str, digits: int) -> Column:
    """Rounded as the SQL does it: the scaled number to a whole one, halves up, which may differ from halves of the shortest text."""
    return (F.round(F.col(c) * 10.0**digits) / 10.0**digits).alias(c)


def q_folder_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = quality.folder_summary(fx.metrics(spark, sf_dir), F.col("file_path").cast("long"))
    return s.select("folder_key", "n_files", "mic", "plosives", "quality", *[rounded(c, 4) for c in ("total_s", "snr_db", "speech_pct", "clip_pct", "rms_dbfs")])


FOLDER_SQL = f"""
WITH s AS (SELECT folder_key, count(*) AS n_files, arg_min(mic_name, file_path) AS mic, sum(plosive_spike_count)::BIGINT AS plosives, sum(duration_s) AS total_s, avg(snr_db) AS snr_db,
  avg(speech_ratio) * 100 AS speech_pct, avg(clipping_ratio) * 100 AS clip_pct, avg(rms_dbfs) AS rms_dbfs
  FROM (SELECT *, clip_pct / 100 AS clipping_ratio FROM {fx.METRICS}) GROUP BY folder_key)
SELECT folder_key, n_files, mic, plosives, CASE WHEN snr_db < 8 THEN 'BAD' WHEN snr_db < 12 THEN 'POOR' WHEN snr_db >= 20 AND speech_pct >= 40 THEN 'GOOD' WHEN snr_db >= 15 AND speech_pct < 25 THEN 'LOW SPEECH'
  WHEN snr_db >= 12 AND speech_pct >= 30 THEN 'OK' ELSE 'OK borderline' END AS quality,
  round(total_s, 4) AS total_s, round(snr_db, 4) AS snr_db, round(speech_pct, 4) AS speech_pct, round(clip_pct, 4) AS clip_pct, round(rms_dbfs, 4) AS rms_dbfs FROM s
"""


def q_folder_footer(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = q_folder_summary(spark, sf_dir).select("folder_key", "quality", "snr_db", "speech_pct")
    return quality.with_footer(s, "folder_key", ["snr_db", "speech_pct"], "quality").select("folder_key", "quality", *[rounded(c, 3) for c in ("snr_db", "speech_pct")])


FOOTER_SQL = f"""
WITH s AS ({FOLDER_SQL})
SELECT folder_key, quality, round(snr_db, 3) AS snr_db, round(speech_pct, 3) AS speech_pct FROM s
UNION ALL SELECT 'MEAN', (SELECT string_agg(quality || ':' || n, ' | ' ORDER BY quality) FROM (SELECT quality, count(*) AS n FROM s GROUP BY quality)), round(avg(snr_db), 3), round(avg(speech_pct), 3) FROM s
"""


def mics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = quality.mic_summary(fx.metrics(spark, sf_dir))
    # means as they are shown, so that "best" means the same on every engine
    return m.withColumns({c: F.round(c, 6) for c in m.columns if c.startswith("avg_")})


MICS = f"""(SELECT mic_name, count(*) AS num_files, sum(plosive_spike_count)::BIGINT AS total_plosive_spikes, round(avg(snr_db), 6) AS avg_snr_db, round(avg(crosstalk_ratio), 6) AS avg_crosstalk_ratio,
  round(avg(clip_pct / 100), 6) AS avg_clipping_ratio, round(avg(effective_bandwidth_hz), 6) AS avg_effective_bandwidth_hz FROM {fx.METRICS} GROUP BY mic_name)"""


def q_mic_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mics(spark, sf_dir).select("mic_name", "num_files", "total_plosive_spikes", "avg_snr_db", "avg_crosstalk_ratio", "avg_clipping_ratio", "avg_effective_bandwidth_hz")


def q_mic_recommendation(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = quality.recommend(quality.composite_score(mics(spark, sf_dir)))
    return r.select("mic_name", "score", "rank", "strengths", "weaknesses")


def _norm(c: str, low: bool) -> str:
    n = f"({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ())"
    return f"CASE WHEN max({c}) OVER () = min({c}) OVER () THEN 1.0 ELSE {'1 - ' if low else ''}{n} END"


_TOTAL = " + ".join(f"{w}::DOUBLE * ({_norm(c, low)})" for c, (w, low) in quality.WEIGHTS.items())
RECOMMEND_SQL = f"""
WITH s AS (SELECT *, round({_TOTAL}, 4) AS score FROM {MICS})
SELECT mic_name, score, CAST(row_number() OVER (ORDER BY score DESC, mic_name) AS INT) AS rank,
  concat_ws(', ', CASE WHEN avg_snr_db = max(avg_snr_db) OVER () THEN printf('best SNR (%.1f dB)', avg_snr_db) END,
    CASE WHEN avg_crosstalk_ratio = min(avg_crosstalk_ratio) OVER () THEN printf('lowest crosstalk (%.4f)', avg_crosstalk_ratio) END,
    CASE WHEN avg_clipping_ratio = min(avg_clipping_ratio) OVER () THEN printf('lowest clipping (%.6f)', avg_clipping_ratio) END,
    CASE WHEN avg_effective_bandwidth_hz = max(avg_effective_bandwidth_hz) OVER () THEN printf('widest bandwidth (%.0f Hz)', avg_effective_bandwidth_hz) END,
    CASE WHEN total_plosive_spikes = min(total_plosive_spikes) OVER () THEN printf('fewest plosive spikes (%.0f)', total_plosive_spikes::DOUBLE) END) AS strengths,
  concat_ws(', ', CASE WHEN avg_snr_db = min(avg_snr_db) OVER () AND count(*) OVER () > 1 THEN printf('lowest SNR (%.1f dB)', avg_snr_db) END,
    CASE WHEN avg_crosstalk_ratio = max(avg_crosstalk_ratio) OVER () AND count(*) OVER () > 1 THEN printf('highest crosstalk (%.4f)', avg_crosstalk_ratio) END,
    CASE WHEN avg_clipping_ratio = max(avg_clipping_ratio) OVER () AND count(*) OVER () > 1 THEN printf('most clipping (%.6f)', avg_clipping_ratio) END) AS weaknesses
FROM s
"""


def q_mic_highlights(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = quality.highlight(mics(spark, sf_dir), {"avg_snr_db": True, "avg_crosstalk_ratio": False})
    return h.select("mic_name", "avg_snr_db_best", "avg_snr_db_worst", "avg_crosstalk_ratio_best", "avg_crosstalk_ratio_worst")


HIGHLIGHT_SQL = f"""SELECT mic_name, avg_snr_db = max(avg_snr_db) OVER () AS avg_snr_db_best, avg_snr_db = min(avg_snr_db) OVER () AS avg_snr_db_worst,
  avg_crosstalk_ratio = min(avg_crosstalk_ratio) OVER () AS avg_crosstalk_ratio_best, avg_crosstalk_ratio = max(avg_crosstalk_ratio) OVER () AS avg_crosstalk_ratio_worst FROM {MICS}"""


def q_metrics_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New metric rows (of every third file) over old ones, and the summaries made again."""
    old = fx.metrics(spark, sf_dir)
    new = old.filter(F.col("file_path").cast("long") % 3 == 0).withColumn("snr_db", F.col("snr_db") + 1)
    m = quality.mic_summary(quality.upsert_files(old, new, ["file_path"]))
    return m.select("mic_name", "num_files", F.round("avg_snr_db", 6).alias("avg_snr_db"))


UPSERT_SQL = f"SELECT mic_name, count(*) AS num_files, round(avg(snr_db + CASE WHEN CAST(file_path AS BIGINT) % 3 = 0 THEN 1 ELSE 0 END), 6) AS avg_snr_db FROM {fx.METRICS} GROUP BY mic_name"


def q_speaker_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fx.metrics(spark, sf_dir)
    return m.select("file_path", speakers.quality_of(F.col("snr_db"), F.col("duration_s")).alias("quality"), quality.gap_class(F.col("rms_dbfs"), F.col("speech_ratio"), F.col("plosive_spike_count") > 0).alias("gap"))


SPEAKER_SQL = f"""SELECT file_path, CASE WHEN duration_s < 1 THEN 'BAD' WHEN snr_db < 8 THEN 'BAD' WHEN snr_db < 12 THEN 'POOR' WHEN snr_db >= 20 THEN 'GOOD' ELSE 'OK' END AS quality,
  CASE WHEN plosive_spike_count = 0 THEN 'non_speech' WHEN rms_dbfs < -50 THEN 'silence' WHEN speech_ratio > 0.5 THEN 'noise' ELSE 'music' END AS gap FROM {fx.METRICS}"""

QUERIES = {
    "q_file_quality": (q_file_quality, f"SELECT file_path, quality, CAST(score AS INT) AS score FROM {RATED}"),
    "q_quality_distribution": (q_quality_distribution, DISTRIBUTION_SQL),
    "q_usable_files": (q_usable_files, f"SELECT file_path, quality FROM {RATED} WHERE quality NOT IN ('BAD', 'POOR', 'CLIPPED', 'MUTED', 'BROKEN', 'EMPTY')"),
    "q_folder_summary": (q_folder_summary, FOLDER_SQL),
    "q_folder_footer": (q_folder_footer, FOOTER_SQL),
    "q_mic_summary": (q_mic_summary, f"SELECT * FROM {MICS}"),
    "q_mic_recommendation": (q_mic_recommendation, RECOMMEND_SQL),
    "q_mic_highlights": (q_mic_highlights, HIGHLIGHT_SQL),
    "q_metrics_upsert": (q_metrics_upsert, UPSERT_SQL),
    "q_speaker_quality": (q_speaker_quality, SPEAKER_SQL),
}
