"""Helpers that the corpus operators share: shared-folder tables, Arrow batches, word splitting.

Words are the maximal runs of bytes other than U+0020 and U+0009-U+000D. ``bytes.split()`` cuts at
exactly those six characters, and UTF-8 never uses their bytes inside another character.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlance.storage import fresh_path

#: The same words for Java's and RE2's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"
#: Spark's option to delete the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def store(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it again: lineage ends there, and a lost executor loses nothing.

    The shuffle files of the write go with it; Spark would keep them until the driver's memory is next cleaned.
    """
    path, conf = fresh_path(df.sparkSession, label), df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that store() made, once nothing reads it any more."""
    jvm = df.sparkSession.sparkContext._jvm
    for place in {f.rsplit("/", 1)[0] for f in df.inputFiles()[:1]}:
        path = jvm.org.apache.hadoop.fs.Path(place)
        if "/parlance/" in place:
            path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*(columns or ("doc_id", "text")))


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as bytes; null is empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def slices(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items of at most limit in all, or of one larger item."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def by_range(keys: np.ndarray, bits: int) -> tuple[list[int], list[slice]]:
    """The ranges of 2**bits equal ones that sorted 64-bit keys fall in, and where each one's keys are: no more than keys."""
    part = (keys >> np.uint64(64 - bits)).astype(np.int64)
    at = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.empty(0, np.int64)
    return part[at].tolist(), [slice(a, b) for a, b in zip(at.tolist(), [*at[1:].tolist(), len(part)], strict=False)]


def pieces_of(batch: pa.RecordBatch, size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in slices of some MB, so that what a worker makes of one at a time stays small."""
    rows = max(1, batch.num_rows * size // max(1, batch.nbytes))
    for a in range(0, batch.num_rows, rows):
        yield batch.slice(a, rows)


def trim() -> None:
    """Give freed memory back to the system where the C library can: an idle worker otherwise keeps its largest size."""
    release = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if release:
        release(0)


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, and trim() when its task ends."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            trim()

    return whole


def with_struct(df: DataFrame, out: str, fields: T.StructType, fn: Callable[[pa.RecordBatch], pa.Array], done: Callable[[], None] = lambda: None) -> DataFrame:
    """df and a struct column ``out`` that fn makes from each Arrow batch; a column of that name is replaced.

    done is called when a task ends: workers are used again, and what they keep would stay beside the next stage.
    """
    rest = df.drop(out)
    schema = T.StructType([*rest.schema.fields, T.StructField(out, fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                for part in pieces_of(batch):
                    yield pa.RecordBatch.from_arrays([*part.columns, fn(part)], names=[*part.schema.names, out])
        finally:
            done()
            trim()

    return rest.mapInArrow(run, schema)


def bucket_of(column, modulus: int):
    """crc32 of an id's decimal text modulo modulus; null for a null id."""
    return F.crc32(column.cast("string").cast("binary")) % F.lit(modulus)
