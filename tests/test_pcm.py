"""Wave files by byte ranges, resampling, and word-processor files."""

import struct
import wave
import zipfile

import numpy as np
import pytest

from parlance.sinks import documents
from parlance.sources import audio, pcm, texts

RATE = 16_000


def riff(fmt: bytes, data: bytes, before: bytes = b"") -> bytes:
    body = b"WAVE" + b"fmt " + struct.pack("<I", len(fmt)) + fmt + before + b"data" + struct.pack("<I", len(data)) + data
    return b"RIFF" + struct.pack("<I", len(body)) + body


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("pcm") / "in"
    (d / "deep").mkdir(parents=True)
    rng = np.random.default_rng(1)
    stereo = rng.uniform(-1, 1, (7001, 2))

    def save(name, width, rate, x):
        with wave.open(str(d / name), "wb") as w:
            w.setnchannels(x.shape[1])
            w.setsampwidth(width)
            w.setframerate(rate)
            top = float(1 << 8 * width - 1)
            v = np.clip(np.rint(x * top), -top, top - 1).astype(np.int64)
            w.writeframes((v + 128).astype(np.uint8).tobytes() if width == 1 else b"".join(int(s).to_bytes(width, "little", signed=True) for s in v.ravel()))

    for width in (1, 2, 3, 4):
        save(f"w{width}.wav", width, RATE, stereo)
    save("deep/cd.wav", 2, 44_100, stereo[:, :1])
    save("empty.wav", 2, RATE, stereo[:0])
    flat = stereo[:, 0].astype("<f4")
    (d / "float.wav").write_bytes(riff(struct.pack("<HHIIHH", 3, 1, RATE, 4 * RATE, 4, 32), flat.tobytes(), b"LIST" + struct.pack("<I", 3) + b"abc\0"))
    extended = struct.pack("<HHIIHHHHI", 0xFFFE, 1, RATE, 2 * RATE, 2, 16, 22, 16, 4) + struct.pack("<H", 1) + bytes(14)
    (d / "extended.wav").write_bytes(riff(extended, (stereo[:, 0] * 32767).astype("<i2").tobytes()))
    (d / "cut.wav").write_bytes((d / "w2.wav").read_bytes()[:20_001])
    (d / "bad.wav").write_bytes(b"no wave at all")
    (d / "none.wav").write_bytes(b"")
    (d / "law.wav").write_bytes(riff(struct.pack("<HHIIHH", 7, 1, 8000, 8000, 1, 8), b"\xff" * 100))
    (d / "other.txt").write_text("x")
    return d


def whole(df):
    rows = {}
    for r in df.collect():
        rows.setdefault(r["recording_id"].rsplit("/", 1)[1], []).append(r)
    return {k: sorted(v, key=lambda r: r["block_no"]) for k, v in rows.items()}


@pytest.mark.parametrize(("block", "split"), [(1000, 777), (2048 * 500, 64 << 20), (1, 5000), (3001, 40)])
def test_byte_ranges_give_whole_files(spark, folder, block, split):
    if block == 1:
        block = 64
    got = whole(pcm.blocks(spark, str(folder), block=block, split_bytes=split))
    want = whole(audio.blocks(spark, str(folder), block=block, decoder=audio.decode_wave))
    assert set(got) == {"w1.wav", "w2.wav", "w3.wav", "w4.wav", "cd.wav", "empty.wav", "float.wav", "extended.wav", "cut.wav", "bad.wav", "none.wav", "law.wav"}
    for name in ("w1.wav", "w2.wav", "w3.wav", "w4.wav", "cd.wav", "empty.wav"):
        assert [(r["block_no"], r["start_sample"], r["error"]) for r in got[name]] == [(r["block_no"], r["start_sample"], r["error"]) for r in want[name]]
        assert np.allclose(np.concatenate([r["samples"] for r in got[name]]), np.concatenate([r["samples"] for r in want[name]]), atol=1e-6)
    assert sum(len(r["samples"]) for r in got["float.wav"]) == sum(len(r["samples"]) for r in got["extended.wav"]) == 7001
    assert sum(len(r["samples"]) for r in got["cut.wav"]) == (20_001 - 44) // 4
    for name in ("bad.wav", "none.wav", "law.wav"):
        assert len(got[name]) == 1 and got[name][0]["error"] and not got[name][0]["samples"]


def test_headers(spark, folder):
    got = {r["path"].rsplit("/", 1)[1]: r for r in pcm.metadata(spark, str(folder)).collect()}
    same = {r["path"].rsplit("/", 1)[1]: r for r in audio.metadata(spark, str(folder)).collect()}
    assert got.pop("none.wav")["error"] and got == same  # the other reader leaves out files without bytes
    assert (got["cd.wav"]["duration_s"], got["cd.wav"]["sample_rate"], got["w3.wav"]["channels"]) == (7001 / 44_100, 44_100, 2) and got["bad.wav"]["error"]
    other = audio.metadata(spark, str(folder), "w2.wav", audio.decoded_facts(lambda data: (np.zeros((80, 3)), 40))).first()
    assert (other["duration_s"], other["sample_rate"], other["channels"]) == (2.0, 40, 3)


@pytest.mark.parametrize(("rate", "target"), [(16_000, 8000), (44_100, 16_000), (8000, 16_000), (48_000, 16_000)])
def test_resampling(rate, target):
    x = np.random.default_rng(2).normal(size=3000)
    up, down, weights = pcm.low_pass(rate, target)
    half, n = weights.shape[1] // 2, round(3000 * target / rate)
    want = np.zeros(n)
    for m in range(n):
        for j in range(2 * half):
            i = m * down // up - half + 1 + j
            want[m] += x[i] * weights[m * down % up][j] if 0 <= i < 3000 else 0.0
    assert np.allclose(pcm.resample(x, rate, target), want, atol=1e-12)
    for lo, hi in ((0, 10), (7, 300), (n - 5, n)):
        a, b = pcm.span(lo, hi, rate, target)
        a = max(0, a)
        assert np.allclose(pcm.resampled(x[a : max(0, b)], a, lo, hi, rate, target), want[lo:hi], atol=1e-12)
    t, lower = np.arange(rate) / rate, min(rate, target)
    level = lambda hz: 20 * np.log10(np.sqrt(2 * (pcm.resample(np.sin(2 * np.pi * hz * t), rate, target)[target // 8 : -target // 8] ** 2).mean()) + 1e-12)
    assert abs(level(0.1 * lower)) < 0.01 and abs(level(0.4 * lower)) < 0.1
    if target < rate:
        assert level(0.55 * target) < -80 and level(0.9 * target) < -80  # above what the lower rate can hold
    assert np.allclose(pcm.resample(np.ones(2000), rate, target)[200:-200], 1.0)


def test_written_waves(spark, tmp_path):
    x = np.random.default_rng(3).uniform(-1.1, 1.1, 500).astype(np.float32)
    rows = [(f"a/{r}", k, 8000, x[k * 90 : k * 90 + 90].tolist()) for r in range(3) for k in range(6)] + [("none", 0, 8000, [])]
    pcm.write_waves(spark.createDataFrame(rows, "recording_id string, block_no int, sample_rate int, samples array<float>").repartition(4), str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["a_0.wav", "a_1.wav", "a_2.wav", "none.wav"]
    with wave.open(str(tmp_path / "out/a_1.wav")) as w:
        assert (w.getframerate(), w.getnframes()) == (8000, 500)
        assert np.frombuffer(w.readframes(500), "<i2").tolist() == np.clip(np.rint(x * np.float64(32767)), -32768, 32767).astype(int).tolist()


def test_word_documents(spark, tmp_path):
    rows = [("one", "a & b <c>\nline é \U0001f642\n\n  spaces  "), ("two", ""), ("bell", "x\x07y"), ("odd/name", "z"), ("none", None)]
    documents.write_documents(spark.createDataFrame(rows, "name string, text string"), str(tmp_path / "out"))
    assert zipfile.ZipFile(tmp_path / "out/one.docx").testzip() is None
    (tmp_path / "out/broken.docx").write_bytes(b"not a container")
    got = {r["path"].rsplit("/", 1)[1]: r for r in texts.documents(spark, str(tmp_path / "out")).collect()}
    assert got["one.docx"]["text"] == rows[0][1] + "\n" and got["two.docx"]["text"] == got["none.docx"]["text"] == "\n"
    assert got["bell.docx"]["text"] == "xy\n" and got["odd_name.docx"]["text"] == "z\n" and got["broken.docx"]["error"]
