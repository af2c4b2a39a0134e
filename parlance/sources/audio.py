"""Recordings as metadata rows and as blocks of samples. PCM wave files are read here; other codecs plug in."""

from __future__ import annotations

import io
import wave
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance import schemas
from parlance.sources.pcm import header, resample

RATE = 16_000
#: Samples of a block: a multiple of the spectrum's 2048 and of 20 ms and 5 ms frames at 16 kHz.
BLOCK = 2048 * 500
Decoder = Callable[[bytes], tuple[np.ndarray, int]]


def decode_wave(data: bytes) -> tuple[np.ndarray, int]:
    """Samples in [-1, 1] by channel, and their rate."""
    with wave.open(io.BytesIO(data)) as w:
        n, width, raw = w.getnchannels(), w.getsampwidth(), w.readframes(w.getnframes())
        rate = w.getframerate()
    if width == 1:
        x = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) >> 8).astype(np.float32) / (1 << 23)
    else:
        x = np.frombuffer(raw, {2: "<i2", 4: "<i4"}[width]).astype(np.float32) / float(1 << 8 * width - 1)
    return x.reshape(-1, n), rate


def mono(x: np.ndarray, rate: int, target: int = RATE) -> np.ndarray:
    """Mean of the channels at the target rate, low-passed to what that rate can hold."""
    y = x.mean(axis=1) if x.ndim == 2 else x
    return (y if rate == target else resample(y, rate, target)).astype(np.float32)


def wave_facts(data: bytes) -> tuple[float, int, int]:
    """(seconds, rate, channels) from a wave file's header."""
    w = header(io.BytesIO(data))
    return w.frames / w.rate, w.rate, w.channels


def decoded_facts(decoder: Decoder) -> Callable[[bytes], tuple[float, int, int]]:
    """The same of another format, by decoding it."""

    def facts(data: bytes) -> tuple[float, int, int]:
        x, rate = decoder(data)
        return len(x) / rate, rate, x.shape[1] if x.ndim == 2 else 1

    return facts


def metadata(spark: SparkSession, path: str, glob: str = "*.wav", facts: Callable[[bytes], tuple[float, int, int]] = wave_facts) -> DataFrame:
    """One row for each file: duration, rate, channels, format, size; defaults and an error where it can't be read.

    facts says what a file holds, by its header or by ``decoded_facts``. ``pcm.metadata`` reads headers alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for p, n, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                ext = p.rsplit(".", 1)[-1].lower()
                try:
                    rows.append((p, *facts(data), ext, n, None))
                except Exception as e:
                    rows.append((p, 0.0, RATE, 1, ext, n, f"{type(e).__name__}: {e}"))
            kinds = [pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=[c.split()[0] for c in schemas.AUDIO_FILES.split(", ")])

    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return f.select("path", "length", "content").mapInArrow(run, schemas.AUDIO_FILES)


def blocks(spark: SparkSession, path: str, glob: str = "*.wav", decoder: Decoder = decode_wave, target: int = RATE, block: int = BLOCK) -> DataFrame:
    """Mono samples at the target rate in blocks of bounded size; a file that fails is one row with an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in schemas.BLOCKS.split(", ")]

        def row(p: str, k: int, x: np.ndarray, error: str | None) -> pa.RecordBatch:
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.float32()), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((p, k, k * block, target, x, error), kinds, strict=True)], names=names)

        for b in batches:
            for p, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                try:
                    y = mono(*decoder(data), target)
                except Exception as e:
                    yield row(p, 0, np.empty(0, np.float32), f"{type(e).__name__}: {e}")
                    continue
                for k in range(max(1, -(-len(y) // block))):
                    yield row(p, k, y[k * block : (k + 1) * block], None)

    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return f.select("path", "content").mapInArrow(run, schemas.BLOCKS)


def with_duration(rows: DataFrame, facts: Callable[[bytes], tuple[float, int, int]] = wave_facts) -> DataFrame:
    """Corpus rows (audio struct of bytes and path) with their duration in seconds, from headers; null where bytes can't be read."""

    @F.pandas_udf("double")
    def seconds(data):
        def one(x: bytes | None) -> float | None:
            try:
                return facts(x)[0]
            except Exception:
                return None

        return data.map(one)

    return rows.withColumn("duration_s", seconds(F.col("audio.bytes")))
