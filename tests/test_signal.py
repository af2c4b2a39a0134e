import math
import wave

import numpy as np
import pytest

from parlance import schemas
from parlance.operators import signal
from parlance.operators.quality import classify
from parlance.sources import audio
from pyspark.sql import functions as F

RATE = 16_000


def save(path, x, rate=RATE, channels=1):
    with wave.open(str(path), "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(x, -1, 1) * 32767).astype("<i2").tobytes())


@pytest.fixture(scope="module")
def waves(tmp_path_factory):
    d = tmp_path_factory.mktemp("waves")
    rng = np.random.default_rng(1)
    t = np.arange(2 * RATE) / RATE
    sine = np.sin(2 * np.pi * 440 * t)
    save(d / "silence.wav", np.zeros(2 * RATE))
    save(d / "sine.wav", 0.5 * sine)
    save(d / "noise.wav", 0.1 * rng.standard_normal(2 * RATE))
    save(d / "clipped.wav", 3 * sine)
    save(d / "short.wav", 0.5 * sine[: RATE // 2])
    save(d / "empty.wav", np.zeros(0))
    (d / "corrupt.wav").write_bytes(b"not a wave file at all")
    long = np.zeros(10 * RATE)
    for a, b in ((1, 3), (5, 8)):
        long[a * RATE : b * RATE] = 0.5 * np.sin(2 * np.pi * 300 * np.arange((b - a) * RATE) / RATE)
    save(d / "bursts.wav", long + 0.0005 * rng.standard_normal(len(long)))
    return d


@pytest.fixture(scope="module")
def blocks(spark, waves):
    b = audio.blocks(spark, str(waves), block=2048 * 10)
    name = F.regexp_extract("recording_id", r"([a-z]+)\.wav$", 1)
    return b.withColumn("recording_id", name).cache()


def by(df):
    return {r["recording_id"]: r for r in df.collect()}


def test_metadata(spark, waves):
    m = {r["path"].rsplit("/", 1)[1]: r for r in audio.metadata(spark, str(waves)).collect()}
    assert m["sine.wav"]["duration_s"] == 2.0 and m["sine.wav"]["channels"] == 1 and m["corrupt.wav"]["error"]


def test_mono_and_resampling():
    x = np.stack([np.ones(100), np.zeros(100)], 1)
    assert np.allclose(audio.mono(x, RATE), 0.5) and len(audio.mono(x, 8000)) == 200


def test_levels(blocks):
    lv = by(signal.levels(blocks))
    assert abs(lv["sine"]["rms_dbfs"] + 9.03) < 0.02 and abs(lv["sine"]["peak_amplitude"] - 0.5) < 1e-3
    assert lv["silence"]["rms_dbfs"] == -240.0 and lv["empty"]["rms_dbfs"] == -120.0 and lv["clipped"]["clip_pct"] > 1
    assert lv["corrupt"]["n"] == 0 and blocks.filter("recording_id = 'corrupt'").first()["error"]


def test_report_rows_are_classified(blocks):
    m = signal.report_metrics(blocks).withColumn("q", classify(F.col("snr_db"), F.col("speech_pct"), F.col("clip_pct"), F.col("rms_dbfs"), F.col("duration_s"))["flag"])
    q = {r["recording_id"]: r["q"] for r in m.collect()}
    assert (q["silence"], q["clipped"], q["short"]) == ("MUTED", "CLIPPED", "BROKEN")


def test_percentile_snr_against_numpy(spark, blocks):
    got = by(signal.percentile_snr(signal.frames(blocks, 0.02)))["bursts"]
    x = np.concatenate([np.array(r["samples"]) for r in blocks.filter("recording_id = 'bursts'").orderBy("block_no").collect()])
    f = []
    for k in range(0, len(x), 20480):  # frames inside blocks
        y = x[k : k + 20480]
        f += list(np.sqrt((y[: len(y) // 320 * 320].reshape(-1, 320).astype(float) ** 2).mean(1)))
    db = 20 * np.log10(np.maximum(f, 1e-9))
    lo, hi = np.percentile(db, 25), np.percentile(db, 75)
    assert abs(got["snr_db"] - (hi - lo)) < 1e-6 and abs(got["speech_pct"] - 100 * np.mean(db > lo + 15)) < 1e-9


def test_regions_and_metrics(spark, blocks):
    b = blocks.filter("recording_id = 'bursts'")
    r = signal.energy_regions(b).orderBy("start_s").collect()
    assert [(round(x["start_s"]), round(x["end_s"])) for x in r] == [(1, 3), (5, 8)]
    regions = spark.createDataFrame([("bursts", 0, 1.0, 3.0), ("bursts", 1, 5.0, 8.0), ("bursts", 2, 6.0, 7.0)], schemas.REGIONS)
    m = signal.region_metrics(b, regions).first()
    x = np.concatenate([np.array(k["samples"]) for k in b.orderBy("block_no").collect()]).astype(float)
    mask = np.zeros(len(x), bool)
    mask[RATE : 3 * RATE] = mask[5 * RATE : 8 * RATE] = True
    assert abs(m["snr_db"] - 10 * math.log10((x[mask] ** 2).mean() / (x[~mask] ** 2).mean())) < 1e-6 and m["speech_ratio"] == 0.5
    turns = spark.createDataFrame([("bursts", 0, "A", 1.0, 3.0), ("bursts", 1, "B", 5.0, 8.0)], schemas.TURNS)
    s = {q["speaker_id"]: q for q in signal.speaker_metrics(b, turns).collect()}
    assert (s["A"]["talk_time_s"], s["B"]["talk_time_s"]) == (2.0, 3.0) and abs(s["A"]["crosstalk"] - 1) < 0.01
    own = signal.speaker_audio(b, turns)
    assert own.groupBy("recording_id").agg(F.sum(F.size("samples")).alias("n")).orderBy("recording_id").collect()[0]["n"] == 2 * RATE


def test_spectrum_against_numpy(blocks):
    rates = blocks.groupBy("recording_id").agg(F.max("sample_rate").alias("sample_rate"))
    spec = signal.mean_spectrum(blocks.filter("recording_id IN ('sine', 'noise', 'bursts', 'short')"))
    got_roll, got_band = by(signal.roll_off(spec, rates)), by(signal.bandwidth(spec, rates))
    for name in ("sine", "noise", "bursts", "short"):
        x = np.concatenate([np.array(k["samples"]) for k in blocks.filter(F.col("recording_id") == name).orderBy("block_no").collect()]).astype(float)
        n = max(1, (len(x) - 2048) // 1024)
        mean = sum(np.abs(np.fft.rfft(np.pad(x[i * 1024 : i * 1024 + 2048], (0, max(0, 2048 - len(x[i * 1024 : i * 1024 + 2048])))))) for i in range(n)) / n
        c = np.cumsum(mean**2)
        db = 20 * np.log10(mean + 1e-10)
        above = np.where(db >= db.max() - 20)[0]
        assert got_roll[name]["spectral_rolloff_hz"] == np.searchsorted(c, 0.85 * c[-1]) * RATE / 2048
        assert got_band[name]["effective_bandwidth_hz"] == (above[-1] - above[0]) * RATE / 2048


def test_flatness_tells_noise_from_tone(blocks):
    f = {r["recording_id"]: r["f"] for r in blocks.filter("block_no = 0").select("recording_id", signal.flatness(F.col("samples")).alias("f")).collect()}
    assert f["noise"] > 0.5 > f["sine"] and f["silence"] == f["empty"] == 1.0


def test_spikes_against_numpy(blocks):
    b = blocks.filter("recording_id IN ('noise', 'bursts')")
    got = by(signal.plosive_spikes(b))
    for name in ("noise", "bursts"):
        x = np.concatenate([np.array(k["samples"]) for k in b.filter(F.col("recording_id") == name).orderBy("block_no").collect()]).astype(float)
        e = (x[: len(x) // 80 * 80].reshape(-1, 80) ** 2).mean(1)
        n = sum((m := np.median(e[max(0, i - 20) : i + 21])) > 1e-10 and e[i] > 3 * m for i in range(len(e)))
        assert got[name]["plosive_spike_count"] == n


def test_file_metrics_one_row(spark, blocks):
    regions = spark.createDataFrame([("sine", 0, 0.0, 1.0)], schemas.REGIONS)
    r = signal.file_metrics(blocks.filter("recording_id = 'sine'"), regions).collect()
    assert len(r) == 1 and abs(r[0]["snr_db"]) < 0.1


def test_rolling_median_against_numpy():
    rng = np.random.default_rng(4)
    for n, half in ((1, 3), (2, 0), (50, 1), (200, 20), (333, 400)):
        for x in (rng.normal(size=n), rng.integers(0, 3, n).astype(float), np.zeros(n)):
            want = [np.median(x[max(0, i - half) : i + half + 1]) for i in range(n)]
            assert signal.rolling_median(x, half).tolist() == want


def dealt(spark, waves, size):
    rows = [(name, k, k * size, RATE, x[k * size : (k + 1) * size].tolist(), None) for name, x in waves.items() for k in range(max(1, -(-len(x) // size)))]
    return spark.createDataFrame(rows, schemas.BLOCKS).repartition(5)


@pytest.mark.parametrize("size", [64, 1000, 1024, 3333, 20_000])
def test_metrics_do_not_depend_on_blocks(spark, size):
    rng = np.random.default_rng(9)
    waves = {"long": rng.normal(size=9_000).astype(np.float32), "short": rng.normal(size=1500).astype(np.float32), "none": np.empty(0, np.float32)}
    b = dealt(spark, waves, size)
    got = {r["recording_id"]: np.array(r["magnitude"]) for r in signal.mean_spectrum(b).collect()}
    for name in ("long", "short"):
        x = waves[name].astype(float)
        n = max(1, (len(x) - 2048) // 1024)
        frames = [x[i * 1024 : i * 1024 + 2048] for i in range(n)]
        want = sum(np.abs(np.fft.rfft(np.pad(f, (0, 2048 - len(f))))) for f in frames) / n
        assert np.allclose(got[name], want, atol=1e-9)
    turns = spark.createDataFrame([("long", 0, "A", 0.3, 0.5), ("long", 1, "B", 0.0, 0.25), ("long", 2, "A", 0.1, 0.2)], schemas.TURNS)
    rows = sorted(signal.speaker_audio(b, turns).filter("recording_id = 'long/A'").collect(), key=lambda r: r["start_sample"])
    assert np.concatenate([r["samples"] for r in rows]).tolist() == np.concatenate([waves["long"][4800:8000], waves["long"][1600:3200]]).tolist()
    assert [r["block_no"] for r in rows] == list(range(len(rows)))


def test_shapes_of_one_and_of_several_blocks_without_a_row_a_bin(spark, blocks):
    """Shapes of recordings are those of their mean spectra, and no plan makes a row of each of a spectrum's bins."""
    rates = blocks.select("recording_id", "sample_rate").distinct()
    got = {r["recording_id"]: r[1:] for r in signal.recording_shapes(blocks, rates).collect()}
    mean = signal.mean_spectrum(blocks)
    assert got and got == {r["recording_id"]: r[1:] for r in signal.spectrum_shape(mean, rates).collect()}
    assert "Generate" not in mean._jdf.queryExecution().executedPlan().toString()
