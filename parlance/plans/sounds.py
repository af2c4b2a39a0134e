"""Embeddings as short waves of several speakers: per-speaker metrics, cuts, gaps, spectra, a detector; guards on chunks and speakers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.operators import intervals, signal, speakers
from parlance.plans import fixtures as fx
from parlance.plans.waves import FRAMES, JOINED, SNR_SQL, SPECTRUM_SQL, WAVE


def ranges(spark: SparkSession, sf_dir: str, rows: list[tuple], columns: str) -> DataFrame:
    """The same few ranges for every recording."""
    b = fx.waveform(spark, sf_dir).filter("block_no = 0").select("recording_id")
    names = columns.split()
    items = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r, strict=True)]) for r in rows])
    return b.select("recording_id", F.explode(items).alias("r")).select("recording_id", "r.*")


TALK = [(0, "S0", 0.5, 1.5), (1, "S1", 2.0, 3.0), (2, "S0", 3.25, 3.5)]
#: Squares of samples, by speaker and outside of every turn.
PARTS = f"""(SELECT recording_id, list_sum(list_transform(x[9:24] || x[53:56], lambda v: v * v)) AS e0, list_sum(list_transform(x[33:48], lambda v: v * v)) AS e1,
  list_sum(list_transform(x[1:8] || x[25:32] || x[49:52] || x[57:64], lambda v: v * v)) AS en FROM {WAVE})"""


def q_speaker_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ranges(spark, sf_dir, TALK, "turn_no speaker_id start_s end_s")
    m = signal.speaker_metrics(fx.waveform(spark, sf_dir), t)
    return m.select("recording_id", "speaker_id", *[F.round(c, 4).alias(c) for c in ("talk_time_s", "snr_db", "crosstalk")])


SPEAKER_SQL = f"""
WITH s AS (SELECT recording_id, 'S0' AS speaker_id, e0 / 20 AS p, e1 / 16 AS o, en / 28 AS n, 1.25::DOUBLE AS t FROM {PARTS} UNION ALL SELECT recording_id, 'S1', e1 / 16, e0 / 20, en / 28, 1.0 FROM {PARTS})
SELECT recording_id, speaker_id, t AS talk_time_s, round(10 * log10(greatest(p, 1e-12) / greatest(n, 1e-12)), 4) AS snr_db, round(CASE WHEN p > 1e-12 THEN o / p ELSE 0 END, 4) AS crosstalk FROM s
"""


def q_others_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ranges(spark, sf_dir, TALK, "turn_no speaker_id start_s end_s")
    p = signal.inside_power(fx.waveform(spark, sf_dir), t, ["recording_id", "speaker_id"]).select("recording_id", "speaker_id", (F.col("in_energy") / F.col("in_n")).alias("power"))
    return speakers.others_power(p).select("recording_id", "speaker_id", F.round("crosstalk", 4).alias("crosstalk"))


OTHERS_SQL = f"SELECT recording_id, 'S0' AS speaker_id, round((e1 / 16) / (e0 / 20), 4) AS crosstalk FROM {PARTS} UNION ALL SELECT recording_id, 'S1', round((e0 / 20) / (e1 / 16), 4) FROM {PARTS}"


def q_speaker_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each speaker's own samples as a recording: how many, and their weighted sum in order."""
    t = ranges(spark, sf_dir, TALK, "turn_no speaker_id start_s end_s")
    a = signal.speaker_audio(fx.waveform(spark, sf_dir), t)
    weighed = F.aggregate(F.transform("samples", lambda x, i: x.cast("double") * (F.col("start_sample") + i + 1)), F.lit(0.0), lambda s, v: s + v)
    return a.groupBy("recording_id").agg(F.sum(F.size("samples")).alias("n"), F.round(F.sum(weighed), 4).alias("weighed"))


def q_joined_speaker_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over waves of 64 blocks, with turns that reach over many of them and come in another order than their times."""
    b = fx.joined_waves(spark, sf_dir)
    turns = [(0, "S0", 100.25, 130.0), (1, "S1", 1.0, 77.5), (2, "S0", 3.0, 9.75), (3, "S0", 120.0, 400.0)]
    items = F.array(*[F.struct(F.lit(n).alias("turn_no"), F.lit(s).alias("speaker_id"), F.lit(x).alias("start_s"), F.lit(y).alias("end_s")) for n, s, x, y in turns])
    t = b.filter("block_no = 0").select("recording_id", F.explode(items).alias("r")).select("recording_id", "r.*")
    a = signal.speaker_audio(b, t)
    weighed = F.aggregate(F.transform("samples", lambda x, i: x.cast("double") * (F.col("start_sample") + i + 1)), F.lit(0.0), lambda s, v: s + v)
    return a.groupBy("recording_id").agg(F.sum(F.size("samples")).alias("n"), F.round(F.sum(weighed), 3).alias("weighed"))


JOINED_AUDIO_SQL = f"""
WITH t(n, s, a, b) AS (VALUES (0, 'S0', 1604, 2080), (1, 'S1', 16, 1240), (2, 'S0', 48, 156), (3, 'S0', 1920, 6400)),
o AS (SELECT recording_id || '/' || s AS recording_id, v, row_number() OVER (PARTITION BY recording_id, s ORDER BY n, p) AS i FROM {JOINED} JOIN t ON p >= a AND p < b)
SELECT recording_id, count(*) AS n, round(sum(v * i), 3) AS weighed FROM o GROUP BY ALL
"""


def _weighed(x: str) -> str:
    return f"round(list_sum(list_transform({x}, lambda v, i: v * i)), 4)"


AUDIO_SQL = f"""SELECT recording_id || '/S0' AS recording_id, 20 AS n, {_weighed("x[9:24] || x[53:56]")} AS weighed FROM {WAVE} UNION ALL SELECT recording_id || '/S1', 16, {_weighed("x[33:48]")} FROM {WAVE}"""


def q_chunk_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of overlapping chunks, cut from blocks."""
    c = ranges(spark, sf_dir, [(0, 0.0, 2.5), (1, 1.25, 4.0), (2, 3.9, 9.0)], "chunk_id start_s end_s")
    s = intervals.slice_samples(fx.waveform(spark, sf_dir), c)
    return s.groupBy("recording_id", "chunk_id").agg(F.sum(F.size("samples")).alias("n"), F.round(F.sum(F.aggregate("samples", F.lit(0.0), lambda a, x: a + x)), 4).alias("total"))


CHUNK_SQL = f"""SELECT recording_id, 0 AS chunk_id, 40 AS n, round(list_sum(x[1:40]), 4) AS total FROM {WAVE} UNION ALL SELECT recording_id, 1, 44, round(list_sum(x[21:64]), 4) FROM {WAVE}
UNION ALL SELECT recording_id, 2, 2, round(list_sum(x[63:64]), 4) FROM {WAVE}"""


def q_speech_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of half a second, and whether they start inside a turn."""
    fr = signal.frames(fx.waveform(spark, sf_dir), 0.5).withColumn("t1", F.col("t0") + 500_000)
    return intervals.frames_in_regions(fr, ranges(spark, sf_dir, TALK, "turn_no speaker_id start_s end_s")).select("recording_id", "frame_no", "in_speech")


FRAME_SQL = f"SELECT recording_id, frame_no, frame_no IN (1, 2, 4, 5) AS in_speech FROM {FRAMES}"
#: Magnitudes of the 64 samples.
FLAT = f"""(SELECT recording_id, b, sqrt(pow(sum(v * cos(2 * pi() * b * (k - 1) / 64)), 2) + pow(sum(v * sin(2 * pi() * b * (k - 1) / 64)), 2)) AS m
  FROM (SELECT recording_id, unnest(x) AS v, unnest(range(1, 65)) AS k FROM {WAVE}), (SELECT unnest(range(1, 33)) AS b) GROUP BY ALL)"""


def q_gap_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole recordings and a second of each as gaps: level, flatness and class. Less than 64 samples are noise."""
    g = signal.gap_classes(fx.waveform(spark, sf_dir), ranges(spark, sf_dir, [(0.0, 4.0), (1.0, 2.0), (5.0, 6.0)], "start_s end_s"))
    return g.select("recording_id", "start_s", "end_s", F.round("rms_dbfs", 4).alias("rms_dbfs"), F.round("flatness", 4).alias("flatness"), "region_type")


GAP_SQL = f"""
WITH f AS (SELECT recording_id, exp(avg(ln(m + 1e-10))) / avg(m) AS flatness FROM {FLAT} GROUP BY ALL),
g AS (SELECT recording_id, 0.0::DOUBLE AS start_s, 4.0::DOUBLE AS end_s, 20 * log10(sqrt(list_sum(list_transform(x, lambda v: v * v)) / 64)) AS db, flatness FROM {WAVE} JOIN f USING (recording_id)
  UNION ALL SELECT recording_id, 1.0, 2.0, 20 * log10(sqrt(list_sum(list_transform(x[17:32], lambda v: v * v)) / 16)), 1.0 FROM {WAVE} UNION ALL SELECT recording_id, 5.0, 6.0, -120.0, 1.0 FROM {WAVE})
SELECT recording_id, start_s, end_s, round(db, 4) AS rms_dbfs, round(flatness, 4) AS flatness, CASE WHEN db < -50 THEN 'silence' WHEN flatness > 0.5 THEN 'noise' ELSE 'music' END AS region_type FROM g
"""


def q_file_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All metrics of each recording in one row."""
    m = signal.file_metrics(fx.waveform(spark, sf_dir, 1), ranges(spark, sf_dir, [(1.0, 2.0)], "start_s end_s"))
    return m.select("recording_id", "duration_s", "clipped_samples", *[F.round(c, 4).alias(c) for c in ("clipping_ratio", "peak_amplitude", "rms_dbfs", "snr_db", "crosstalk_ratio", "speech_ratio", "spectral_rolloff_hz", "effective_bandwidth_hz")])


FILE_SQL = f"""
WITH s AS (SELECT recording_id, len(list_filter(x, lambda v: abs(v) >= 0.99)) AS c, list_max(list_transform(x, lambda v: abs(v))) AS p, list_sum(list_transform(x, lambda v: v * v)) / 64 AS e,
  list_sum(list_transform(x[17:32], lambda v: v * v)) / 16 AS ps, list_sum(list_transform(x[1:16] || x[33:64], lambda v: v * v)) / 48 AS pn FROM {WAVE}), q AS ({SPECTRUM_SQL})
SELECT recording_id, 4.0::DOUBLE AS duration_s, CAST(c AS BIGINT) AS clipped_samples, round(c / 64::DOUBLE, 4) AS clipping_ratio, round(p, 4) AS peak_amplitude, round(20 * log10(sqrt(e + 1e-10) + 1e-10), 4) AS rms_dbfs,
  round(10 * log10(ps / pn), 4) AS snr_db, round(pn / ps, 4) AS crosstalk_ratio, 0.25::DOUBLE AS speech_ratio, round(spectral_rolloff_hz, 4) AS spectral_rolloff_hz, round(effective_bandwidth_hz, 4) AS effective_bandwidth_hz FROM s JOIN q USING (recording_id)
"""


def q_report_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics that the quality rules take, from frames of half a second, since these waves have 16 samples a second."""
    m = signal.report_metrics(fx.waveform(spark, sf_dir), 0.5, 2.0)
    return m.select("recording_id", "duration_s", *[F.round(c, 4).alias(c) for c in ("rms_dbfs", "clip_pct", "snr_db", "speech_pct")])


REPORT_SQL = f"""
WITH q AS ({SNR_SQL})
SELECT recording_id, 4.0::DOUBLE AS duration_s, round(20 * log10(greatest(sqrt(list_sum(list_transform(x, lambda v: v * v)) / 64), 1e-12)), 4) AS rms_dbfs,
  round(100 * len(list_filter(x, lambda v: abs(v) >= 0.997)) / 64::DOUBLE, 4) AS clip_pct, snr_db, speech_pct FROM {WAVE} JOIN q USING (recording_id)"""


def q_energy_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of half seconds that are louder than the quiet quarter by 1 dB."""
    return signal.energy_regions(fx.waveform(spark, sf_dir), 0.5, 1.0, -60.0, 0.3).select("recording_id", "pos", "start_s", "end_s")


ENERGY_SQL = f"""
WITH d AS (SELECT recording_id, frame_no AS k, 20 * log10(greatest(sqrt(power), 1e-9)) AS db FROM {FRAMES}), p AS (SELECT recording_id, quantile_cont(db, 0.25) AS lo FROM d GROUP BY ALL),
l AS (SELECT recording_id, k, (k - lag(k) OVER (PARTITION BY recording_id ORDER BY k) > 1 OR lag(k) OVER (PARTITION BY recording_id ORDER BY k) IS NULL)::INT AS new FROM d JOIN p USING (recording_id) WHERE db > lo + 1 AND db > -60),
i AS (SELECT *, sum(new) OVER (PARTITION BY recording_id ORDER BY k) AS g FROM l)
SELECT recording_id, CAST(g - 1 AS INT) AS pos, min(k) / 2::DOUBLE AS start_s, (max(k) + 1) / 2::DOUBLE AS end_s FROM i GROUP BY recording_id, g
"""


def q_contained_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions that lie wholly inside windows of an hour that start every half hour, by recording."""
    r = fx.regions(spark, sf_dir).withColumns({"start_s": F.col("start_s") % 7200, "end_s": F.col("start_s") % 7200 + (F.col("end_s") - F.col("start_s")) / 50})
    g = fx.totals(spark, sf_dir).select("recording_id", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("g_no")).withColumns({"g0_s": F.col("g_no") * 1800.0, "g1_s": F.col("g_no") * 1800.0 + 3600})
    return intervals.contained(r, g, 600.0).select("recording_id", F.col("pos").cast("long").alias("pos"), "g_no")


CONTAINED_SQL = f"""
WITH r AS (SELECT recording_id, pos, (t0 / 1e6) % 7200 AS a, (t0 / 1e6) % 7200 + (t1 / 1e6 - t0 / 1e6) / 50 AS b FROM {fx.REGIONS})
SELECT recording_id, pos, CAST(g AS INT) AS g_no FROM r, (SELECT unnest(range(4)) AS g) WHERE round(a * 1e6) >= g * 1800000000 AND round(b * 1e6) <= g * 1800000000 + 3600000000
"""


def q_chunk_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks that an engine accepts and those that are too long for it."""
    c = fx.metrics(spark, sf_dir).select("file_path", "duration_s")
    fits, long = intervals.chunks_within(c, 40.0)
    return fits.select("file_path", F.lit(True).alias("fits")).unionByName(long.select("file_path", F.lit(False).alias("fits")))


def q_speakers_by_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speakers with enough talk, in the order of their roles; the place in the order is given."""
    from pyspark.sql import Window

    m = fx.metrics(spark, sf_dir).withColumn("i", F.col("file_path").cast("long"))
    role = F.get(F.array(*map(F.lit, ("OTHER", "ENUMERATOR", "UNKNOWN", "RESPONDENT"))), (F.col("i") % 4).cast("int"))
    s = m.select(F.col("folder_key").alias("recording_id"), F.col("file_path").alias("speaker_id"), (F.col("i") % 97 / 10).alias("talk_time_s"), role.alias("role"))
    ordered = speakers.by_role(speakers.long_enough(s)).withColumn("row", F.monotonically_increasing_id())
    return ordered.select("recording_id", "speaker_id", "role", F.row_number().over(Window.partitionBy("recording_id").orderBy("row")).alias("place"))


ROLE_SQL = """
WITH s AS (SELECT CAST(user_id AS VARCHAR) AS recording_id, CAST(event_id AS VARCHAR) AS speaker_id, event_id % 97 / 10::DOUBLE AS t, event_id % 4 AS r FROM events)
SELECT recording_id, speaker_id, CASE r WHEN 0 THEN 'OTHER' WHEN 1 THEN 'ENUMERATOR' WHEN 2 THEN 'UNKNOWN' ELSE 'RESPONDENT' END AS role,
  CAST(row_number() OVER (PARTITION BY recording_id ORDER BY CASE r WHEN 1 THEN 0 WHEN 3 THEN 1 WHEN 0 THEN 2 ELSE 3 END, t DESC, speaker_id) AS INT) AS place FROM s WHERE t >= 0.5
"""

QUERIES = {
    "q_speaker_metrics": (q_speaker_metrics, SPEAKER_SQL),
    "q_others_power": (q_others_power, OTHERS_SQL),
    "q_speaker_audio": (q_speaker_audio, AUDIO_SQL),
    "q_joined_speaker_audio": (q_joined_speaker_audio, JOINED_AUDIO_SQL),
    "q_chunk_samples": (q_chunk_samples, CHUNK_SQL),
    "q_speech_frames": (q_speech_frames, FRAME_SQL),
    "q_gap_classes": (q_gap_classes, GAP_SQL),
    "q_file_metrics": (q_file_metrics, FILE_SQL),
    "q_report_metrics": (q_report_metrics, REPORT_SQL),
    "q_energy_regions": (q_energy_regions, ENERGY_SQL),
    "q_contained_regions": (q_contained_regions, CONTAINED_SQL),
    "q_chunk_guard": (q_chunk_guard, f"SELECT file_path, round(duration_s * 1e6) <= 40000000 AS fits FROM {fx.METRICS}"),
    "q_speakers_by_role": (q_speakers_by_role, ROLE_SQL),
}
