"""Level metrics over embeddings read as short waveforms, and over the same in frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.operators import signal, words
from parlance.plans import fixtures as fx

WAVE = "(SELECT CAST(vec_id AS VARCHAR) AS recording_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)"
FRAMES = f"""(SELECT recording_id, k AS frame_no, list_sum(list_transform(x[k * 8 + 1 : k * 8 + 8], lambda v: v * v)) / 8 AS power
  FROM (SELECT recording_id, x, unnest(range(8)) AS k FROM {WAVE}))"""


def q_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    lv = signal.levels(fx.waveform(spark, sf_dir), 0.3)
    return lv.select("recording_id", "n", "clipped_samples", *[F.round(c, 4).alias(c) for c in ("rms_dbfs", "peak_dbfs", "rms_dbfs_soft", "clip_pct")])


LEVELS_SQL = f"""
WITH s AS (SELECT recording_id, len(x) AS n, list_sum(list_transform(x, lambda v: v * v)) AS e, list_max(list_transform(x, lambda v: abs(v))) AS p, len(list_filter(x, lambda v: abs(v) >= 0.3)) AS c FROM {WAVE})
SELECT recording_id, CAST(n AS BIGINT) AS n, CAST(c AS BIGINT) AS clipped_samples, round(20 * log10(greatest(sqrt(e / n), 1e-12)), 4) AS rms_dbfs, round(20 * log10(greatest(p, 1e-12)), 4) AS peak_dbfs,
  round(20 * log10(sqrt(e / n + 1e-10) + 1e-10), 4) AS rms_dbfs_soft, round(100 * c / n::DOUBLE, 4) AS clip_pct FROM s
"""


def q_percentile_snr(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = signal.percentile_snr(signal.frames(fx.waveform(spark, sf_dir), 0.5), margin_db=2.0)
    return s.select("recording_id", F.round("snr_db", 4).alias("snr_db"), F.round("speech_pct", 4).alias("speech_pct"))


SNR_SQL = f"""
WITH d AS (SELECT recording_id, 20 * log10(greatest(sqrt(power), 1e-9)) AS db FROM {FRAMES}),
p AS (SELECT recording_id, quantile_cont(db, 0.25) AS lo, quantile_cont(db, 0.75) AS hi FROM d GROUP BY ALL)
SELECT recording_id, round(max(hi - lo), 4) AS snr_db, round(100 * avg((db > lo + 2)::INT), 4) AS speech_pct FROM d JOIN p USING (recording_id) GROUP BY recording_id
"""


def q_region_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second of every four seconds as speech: SNR and crosstalk against the rest."""
    b = fx.waveform(spark, sf_dir)
    r = b.filter("block_no = 0").select("recording_id", F.lit(1.0).alias("start_s"), F.lit(2.0).alias("end_s"))
    m = signal.region_metrics(b, r)
    return m.select("recording_id", *[F.round(c, 4).alias(c) for c in ("snr_db", "crosstalk_ratio", "speech_ratio")])


REGION_SQL = f"""
WITH s AS (SELECT recording_id, list_sum(list_transform(x[17:32], lambda v: v * v)) / 16 AS ps, (list_sum(list_transform(x[1:16], lambda v: v * v)) + list_sum(list_transform(x[33:64], lambda v: v * v))) / 48 AS pn FROM {WAVE})
SELECT recording_id, round(CASE WHEN pn < 1e-12 THEN 60 ELSE 10 * log10(ps / pn) END, 4) AS snr_db, round(CASE WHEN ps < 1e-12 THEN 0 ELSE pn / ps END, 4) AS crosstalk_ratio, 0.25::DOUBLE AS speech_ratio FROM s
"""


def q_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signal.plosive_spikes(fx.waveform(spark, sf_dir), 0.25, 1.5, 1.5)


SPIKES_SQL = f"""
WITH f AS (SELECT recording_id, k, list_sum(list_transform(x[k * 4 + 1 : k * 4 + 4], lambda v: v * v)) / 4 AS power FROM (SELECT recording_id, x, unnest(range(16)) AS k FROM {WAVE})),
m AS (SELECT *, quantile_cont(power, 0.5) OVER (PARTITION BY recording_id ORDER BY k ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS m FROM f)
SELECT recording_id, count(*) FILTER (m > 1e-10 AND power > 1.5 * m) AS plosive_spike_count FROM m GROUP BY ALL
"""


def q_spectrum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roll-off and bandwidth of the short waves, padded to a frame."""
    b = fx.waveform(spark, sf_dir, 1)
    return signal.recording_shapes(b, b.select("recording_id", "sample_rate").distinct())


#: Magnitudes of the 64 samples padded to 2048.
PADDED = f"""(SELECT recording_id, b, sqrt(pow(sum(v * cos(2 * pi() * b * (k - 1) / 2048)), 2) + pow(sum(v * sin(2 * pi() * b * (k - 1) / 2048)), 2)) AS m
  FROM (SELECT recording_id, unnest(x) AS v, unnest(range(1, 65)) AS k FROM {WAVE}), (SELECT unnest(range(0, 1025)) AS b) GROUP BY ALL)"""
SPECTRUM_SQL = f"""
WITH s AS (SELECT *, sum(m * m) OVER (PARTITION BY recording_id ORDER BY b) AS c, sum(m * m) OVER (PARTITION BY recording_id) AS t, 20 * log10(m + 1e-10) AS db, max(20 * log10(m + 1e-10)) OVER (PARTITION BY recording_id) AS top FROM {PADDED})
SELECT recording_id, min(b) FILTER (c >= 0.85 * t) * 16 / 2048::DOUBLE AS spectral_rolloff_hz, (max(b) FILTER (db >= top - 20) - min(b) FILTER (db >= top - 20)) * 16 / 2048::DOUBLE AS effective_bandwidth_hz FROM s GROUP BY recording_id
"""


def q_joined_spectrum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roll-off and bandwidth of waves of 64 blocks, whose frames reach over 32 of them."""
    b = fx.joined_waves(spark, sf_dir)
    return signal.recording_shapes(b, b.select("recording_id", "sample_rate").distinct())


#: Samples of the joined waves by place, with the number of frames (a recording has one at least).
JOINED = """(SELECT recording_id, p, v, greatest(1, (total - 2048) // 1024) AS frames FROM (SELECT CAST(vec_id // 64 AS VARCHAR) AS recording_id, vec_id % 64 * 64 + k - 1 AS p, CAST(v AS DOUBLE) AS v,
  sum(1) OVER (PARTITION BY vec_id // 64) AS total FROM (SELECT vec_id, unnest(embedding) AS v, unnest(range(1, 65)) AS k FROM embeddings)))"""
JOINED_SQL = f"""
WITH f AS (SELECT recording_id, i, p - i * 1024 AS k, v, frames FROM {JOINED}, (SELECT unnest(range(4)) AS i) WHERE i < frames AND p >= i * 1024 AND p < i * 1024 + 2048),
m AS (SELECT recording_id, i, b, max(frames) AS frames, sqrt(pow(sum(v * cos(2 * pi() * (b * k % 2048) / 2048)), 2) + pow(sum(v * sin(2 * pi() * (b * k % 2048) / 2048)), 2)) AS m FROM f, (SELECT unnest(range(0, 1025)) AS b) GROUP BY recording_id, i, b),
a AS (SELECT recording_id, b, sum(m) / max(frames) AS m FROM m GROUP BY ALL),
s AS (SELECT *, sum(m * m) OVER (PARTITION BY recording_id ORDER BY b) AS c, sum(m * m) OVER (PARTITION BY recording_id) AS t, 20 * log10(m + 1e-10) AS db, max(20 * log10(m + 1e-10)) OVER (PARTITION BY recording_id) AS top FROM a)
SELECT recording_id, min(b) FILTER (c >= 0.85 * t) * 16 / 2048::DOUBLE AS spectral_rolloff_hz, (max(b) FILTER (db >= top - 20) - min(b) FILTER (db >= top - 20)) * 16 / 2048::DOUBLE AS effective_bandwidth_hz FROM s GROUP BY recording_id
"""


def q_joined_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loud frames of waves of 64 blocks against the median of 201 around each."""
    return signal.plosive_spikes(fx.joined_waves(spark, sf_dir), 0.25, 50.0, 1.5)


JOINED_SPIKES_SQL = f"""
WITH f AS (SELECT recording_id, p // 4 AS k, sum(v * v) / 4 AS power FROM {JOINED} GROUP BY ALL),
m AS (SELECT *, quantile_cont(power, 0.5) OVER (PARTITION BY recording_id ORDER BY k ROWS BETWEEN 100 PRECEDING AND 100 FOLLOWING) AS m FROM f)
SELECT recording_id, count(*) FILTER (m > 1e-10 AND power > 1.5 * m) AS plosive_spike_count FROM m GROUP BY ALL
"""


def q_ctc_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents as frame ids by their length, repeats and blanks dropped."""
    d = fx.table(spark, sf_dir, "documents").select("doc_id", F.transform(F.split(F.coalesce("text", F.lit("")), " "), lambda w: F.length(w) % 6).alias("ids"))
    vocabulary = F.create_map(*[F.lit(x) for i, c in enumerate("abcde", 1) for x in (i, c)])
    return d.select("doc_id", F.md5(F.array_join(words.ctc_collapse(F.col("ids"), vocabulary), " ").cast("binary")).alias("tokens"))


CTC_SQL = """
WITH d AS (SELECT doc_id, list_transform(string_split(coalesce(text, ''), ' '), lambda w: CAST(length(w) % 6 AS INT)) AS x FROM documents)
SELECT doc_id, md5(array_to_string([ 'abcde'[x[i]] FOR i IN range(1, len(x) + 1) IF x[i] <> 0 AND (i = 1 OR x[i] <> x[i - 1])], ' ')) AS tokens FROM d
"""

QUERIES = {
    "q_levels": (q_levels, LEVELS_SQL),
    "q_percentile_snr": (q_percentile_snr, SNR_SQL),
    "q_region_power": (q_region_power, REGION_SQL),
    "q_spikes": (q_spikes, SPIKES_SQL),
    "q_spectrum": (q_spectrum, SPECTRUM_SQL),
    "q_joined_spectrum": (q_joined_spectrum, JOINED_SQL),
    "q_joined_spikes": (q_joined_spikes, JOINED_SPIKES_SQL),
    "q_ctc_collapse": (q_ctc_collapse, CTC_SQL),
}
