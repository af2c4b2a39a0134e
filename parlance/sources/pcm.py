"""Wave files as a Spark data source: read by byte ranges, written from blocks, brought to another rate by a low-pass filter.

``spark.read.format("pcm_waves")`` plans byte ranges of files from their names and sizes alone; each task reads the
header and, for every block that starts in its range, just the bytes that this block is made of, with the filter's
margin on both sides. So one huge file is many tasks, and no file is ever one value. Files are opened through
pyarrow's file systems (local or shared folders, and the object stores it knows); where only Spark reaches a store,
``audio.blocks`` reads whole files instead.

Defined results: a file that cannot be read is one row with an error and no samples; a file without samples is one
empty block; samples cut off at a file's end are left out.
"""

from __future__ import annotations

import fnmatch
import io
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import gcd

import numpy as np
import pyarrow as pa
from pyarrow import fs as afs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from parlance import schemas

#: Formats of samples in a wave header, and zero crossings of the filter on either side.
WHOLE, FLOATING, EXTENSIBLE = 1, 3, 0xFFFE
CROSSINGS = 32
#: Samples in the filter's pass band, as a part of the lower rate's band.
BAND = 0.94


@dataclass(frozen=True)
class Wave:
    """What a header says: where samples start, how many frames follow, and how they are written."""

    rate: int
    channels: int
    width: int
    kind: int
    start: int
    frames: int

    @property
    def step(self) -> int:
        return self.channels * self.width

    def samples(self, raw: bytes) -> np.ndarray:
        """Mean of the channels, in [-1, 1]."""
        raw = raw[: len(raw) // self.step * self.step]
        if self.kind == FLOATING:
            x = np.frombuffer(raw, {4: "<f4", 8: "<f8"}[self.width]).astype(np.float64)
        elif self.width == 1:
            x = (np.frombuffer(raw, np.uint8).astype(np.float64) - 128) / 128
        elif self.width == 3:
            b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
            x = ((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) >> 8) / float(1 << 23)
        else:
            x = np.frombuffer(raw, {2: "<i2", 4: "<i4"}[self.width]) / float(1 << 8 * self.width - 1)
        return x.reshape(-1, self.channels).mean(axis=1)


def header(f) -> Wave:
    """The header of an open wave file; raises ValueError for anything else."""
    size = f.seek(0, io.SEEK_END)
    f.seek(0)
    head = f.read(12)
    if head[:4] != b"RIFF" or head[8:12] != b"WAVE":
        raise ValueError("not a wave file")
    at, shape = 12, None
    while at + 8 <= size:
        f.seek(at)
        name, length = struct.unpack("<4sI", f.read(8))
        if name == b"fmt ":
            kind, channels, rate, _, _, bits = struct.unpack("<HHIIHH", f.read(16))
            if kind == EXTENSIBLE and length >= 26:
                f.read(8)
                kind = struct.unpack("<H", f.read(2))[0]
            shape = kind, channels, rate, bits // 8
        elif name == b"data":
            if shape is None:
                raise ValueError("samples before their format")
            kind, channels, rate, width = shape
            if kind not in (WHOLE, FLOATING) or channels < 1 or rate < 1 or width not in ((1, 2, 3, 4) if kind == WHOLE else (4, 8)):
                raise ValueError(f"samples of format {kind} with {8 * width} bits are not handled")
            return Wave(rate, channels, width, kind, at + 8, min(length, size - at - 8) // (channels * width))
        at += 8 + length + length % 2
    raise ValueError("no samples in the file")


@lru_cache(maxsize=16)
def low_pass(rate: int, target: int) -> tuple[int, int, np.ndarray]:
    """(up, down, weights of each phase): a windowed sinc below the lower of both rates' bands; each phase sums to one."""
    g = gcd(rate, target)
    up, down = target // g, rate // g
    cut = min(1.0, up / down) * (BAND if up < down else 1.0)
    half = int(np.ceil(CROSSINGS / cut))
    u = np.arange(-half + 1, half + 1) - (np.arange(up) / up)[:, None]
    weights = np.sinc(cut * u) * (0.5 + 0.5 * np.cos(np.pi * np.clip(u / half, -1, 1)))
    return up, down, weights / weights.sum(axis=1, keepdims=True)


def span(first: int, last: int, rate: int, target: int) -> tuple[int, int]:
    """Source samples that the target's samples [first, last) are made of; the first may be negative."""
    if rate == target:
        return first, last
    up, down, weights = low_pass(rate, target)
    half = weights.shape[1] // 2
    return first * down // up - half + 1, (last - 1) * down // up + half + 1


def resampled(x: np.ndarray, at: int, first: int, last: int, rate: int, target: int) -> np.ndarray:
    """The target's samples [first, last), from source samples x that start at place ``at``; what x lacks is zero.

    Output samples of one phase are a stride of windows over the source, so each phase is one product.
    """
    lo, hi = span(first, last, rate, target)
    x = np.pad(x[max(0, lo - at) : max(0, hi - at)], (max(0, at - lo), max(0, hi - max(at, lo) - max(0, len(x) - max(0, lo - at)))))
    if rate == target:
        return x[: last - first]
    up, down, weights = low_pass(rate, target)
    out = np.empty(last - first)
    windows = np.lib.stride_tricks.sliding_window_view(x, weights.shape[1])
    for k in range(min(up, last - first)):
        place = (first + k) * down
        out[k::up] = windows[place // up - weights.shape[1] // 2 + 1 - lo :: down][: -(-(last - first - k) // up)] @ weights[place % up]
    return out


def resample(x: np.ndarray, rate: int, target: int) -> np.ndarray:
    """A whole wave at another rate."""
    n = round(len(x) * target / rate)
    return resampled(np.asarray(x, np.float64), 0, 0, n, rate, target) if n else np.empty(0)


@dataclass
class Ranges(InputPartition):
    """Parts of files: (path, size, first byte, byte after the last)."""

    parts: list[tuple[str, int, int, int]]


def file_system(path: str) -> tuple[afs.FileSystem, str]:
    return afs.FileSystem.from_uri(path) if "://" in path else afs.FileSystem.from_uri(f"file:{path}") if path.startswith("/") else (afs.LocalFileSystem(), path)


def uri_of(path: str, base: str) -> str:
    """A file's address as Spark's own readers write it."""
    scheme = base.partition(":")[0] if ":" in base else "file"
    return f"{scheme}:{path if scheme == 'file' else '//' + path}"


class WaveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.glob = options["path"], options.get("glob", "*.wav")
        self.target, self.block = int(options.get("target", 16_000)), int(options.get("block", 2048 * 500))
        self.split = int(options.get("splitbytes", 64 << 20))
        self.headers = options.get("rows", "blocks") == "files"

    def partitions(self) -> list[Ranges]:
        """Files cut into ranges of split bytes; ranges of small files are put together up to that size."""
        files, inside = file_system(self.path)
        found = files.get_file_info(afs.FileSelector(inside, recursive=True)) if files.get_file_info(inside).type == afs.FileType.Directory else [files.get_file_info(inside)]
        out, held = [Ranges([])], 0
        for f in sorted((f for f in found if f.type == afs.FileType.File and fnmatch.fnmatchcase(f.base_name, self.glob)), key=lambda f: f.path):
            for start in [0] if self.headers else range(0, max(1, f.size), self.split):
                stop = f.size if self.headers else min(f.size, start + self.split)
                size = (1 << 16) + (0 if self.headers else stop - start)  # opening a file costs something too
                if held and held + size > self.split:
                    out.append(Ranges([]))
                    held = 0
                out[-1].parts.append((f.path, f.size, start, stop))
                held += size
        return out

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        files, _ = file_system(self.path)
        for path, size, start, stop in partition.parts:
            yield from self.file_rows(files, path, size) if self.headers else self.block_rows(files, path, start, stop)

    def file_rows(self, files: afs.FileSystem, path: str, size: int) -> Iterator[pa.RecordBatch]:
        ext = path.rsplit(".", 1)[-1].lower()
        try:
            with files.open_input_file(path) as f:
                w = header(f)
            row = (uri_of(path, self.path), w.frames / w.rate, w.rate, w.channels, ext, size, None)
        except Exception as e:  # the row says what is wrong
            row = (uri_of(path, self.path), 0.0, 16_000, 1, ext, size, f"{type(e).__name__}: {e}")
        yield one_row(schemas.AUDIO_FILES, row)

    def block_rows(self, files: afs.FileSystem, path: str, start: int, stop: int) -> Iterator[pa.RecordBatch]:
        """The blocks whose first source sample lies in these bytes; a file's first block belongs to its first bytes."""
        name = uri_of(path, self.path)
        try:
            with files.open_input_file(path) as f:
                w = header(f)
                n = w.frames if w.rate == self.target else round(w.frames * self.target / w.rate)
                where = lambda k: w.start + k * self.block * w.rate // self.target * w.step
                for k in range(max(0, (start - w.start) // w.step * self.target // (w.rate * self.block)), max(1, -(-n // self.block))):
                    first, last = k * self.block, min(n, (k + 1) * self.block)
                    if (where(k) >= start if k else start == 0) and (not k or where(k) < stop):
                        x = np.empty(0)
                        if last > first:
                            lo, hi = span(first, last, w.rate, self.target)
                            lo, hi = max(0, lo), min(w.frames, hi)
                            f.seek(w.start + lo * w.step)
                            x = resampled(w.samples(f.read((hi - lo) * w.step)), lo, first, last, w.rate, self.target)
                        yield one_row(schemas.BLOCKS, (name, k, first, self.target, x.astype(np.float32), None))
                    elif where(k) >= stop:
                        break
        except Exception as e:  # the row says what is wrong
            if start == 0:
                yield one_row(schemas.BLOCKS, (name, 0, 0, self.target, np.empty(0, np.float32), f"{type(e).__name__}: {e}"))


KINDS = {"string": pa.string(), "double": pa.float64(), "int": pa.int32(), "long": pa.int64(), "array<float>": pa.list_(pa.float32())}


def one_row(schema: str, values: tuple) -> pa.RecordBatch:
    fields = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], KINDS[kind]) for v, (_, kind) in zip(values, fields, strict=True)], names=[name for name, _ in fields])


@dataclass
class Written(WriterCommitMessage):
    files: int


class WaveWriter(DataSourceArrowWriter):
    """Rows of (file, total, sample_rate, samples) that come in order, file after file, as 16-bit wave files.

    A file is written under a name of its own and moved when it is whole, so a task that runs again does no harm.
    """

    def __init__(self, options: dict):
        self.path = options["path"]

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        files, base = file_system(self.path)
        files.create_dir(base, recursive=True)
        name, out, count, temporary = None, None, 0, f"{base}/.{uuid.uuid4().hex}"

        def finish() -> None:
            nonlocal count
            if out is not None:
                out.close()
                files.move(temporary, f"{base}/{name}")
                count += 1

        for batch in batches:
            for file, total, rate, samples in zip(*(batch.column(c).to_pylist() for c in ("file", "total", "sample_rate")), batch.column("samples"), strict=True):
                if file != name:
                    finish()
                    name, out = file, files.open_output_stream(temporary)
                    out.write(struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + 2 * total, b"WAVE", b"fmt ", 16, WHOLE, 1, rate, 2 * rate, 2, 16, b"data", 2 * total))
                x = np.asarray(samples.values.to_numpy(zero_copy_only=False) if samples.is_valid else [], np.float64)
                out.write(np.clip(np.rint(x * 32767), -32768, 32767).astype("<i2").tobytes())
        finish()
        return Written(count)


class PcmWaves(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pcm_waves"

    def schema(self) -> str:
        return schemas.AUDIO_FILES if self.options.get("rows", "blocks") == "files" else schemas.BLOCKS

    def reader(self, schema: StructType) -> WaveReader:
        return WaveReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> WaveWriter:
        return WaveWriter(dict(self.options))


def blocks(spark: SparkSession, path: str, glob: str = "*.wav", target: int = 16_000, block: int = 2048 * 500, split_bytes: int = 64 << 20) -> DataFrame:
    """Mono samples at the target rate in blocks, from byte ranges of wave files."""
    spark.dataSource.register(PcmWaves)
    return spark.read.format("pcm_waves").options(glob=glob, target=target, block=block, splitbytes=split_bytes).load(path)


def metadata(spark: SparkSession, path: str, glob: str = "*.wav") -> DataFrame:
    """Duration, rate, channels, format and size of wave files, from their headers alone."""
    spark.dataSource.register(PcmWaves)
    return spark.read.format("pcm_waves").options(glob=glob, rows="files").load(path)


def write_waves(recordings: DataFrame, path: str) -> None:
    """One 16-bit mono file for each recording (recording_id, block_no, sample_rate, samples), named by its id.

    A file is one stream, so a recording is one task's work; its length is counted on narrow rows first.
    """
    recordings.sparkSession.dataSource.register(PcmWaves)
    total = recordings.select("recording_id", "block_no", F.size("samples").alias("n")).withColumn("total", F.sum("n").over(Window.partitionBy("recording_id"))).drop("n")
    file = F.concat(F.regexp_replace("recording_id", "[^A-Za-z0-9._-]", "_"), F.lit(".wav"))
    rows = recordings.join(total, ["recording_id", "block_no"]).withColumn("file", file).repartition("file").sortWithinPartitions("file", "block_no")
    rows.select("file", F.col("total").cast("long").alias("total"), "sample_rate", "samples").write.format("pcm_waves").mode("append").save(path)
