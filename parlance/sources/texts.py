"""Readers of transcripts, references, reports, training pairs, turn files and documents."""

from __future__ import annotations

import html
import io
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance import schemas



def json_lines(spark: SparkSession, path: str, schema: str = schemas.PAIRS, strict: bool = False) -> DataFrame:
    """One object a line; broken lines are skipped, or fail if strict."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def transcripts(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Transcript files, or one a line, with two texts: raw ones joined, and corrected ones (else translated-from, else plain) joined."""
    t = spark.read.schema(schemas.TRANSCRIPT).option("multiLine", not lines).json(path).withColumn("file", F.col("_metadata.file_name"))
    join = lambda pick: F.array_join(F.filter(F.transform("segments", lambda s: F.trim(pick(s))), lambda x: x.isNotNull() & (x != "")), " ")
    filled = lambda c: F.nullif(F.trim(c), F.lit(""))
    return t.select("file", "metadata", "segments", join(lambda s: s["raw_text"]).alias("raw"), join(lambda s: F.coalesce(filled(s["corrected_text"]), filled(s["raw_text"]), s["text"])).alias("text"))


def mic_report(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """File rows of nested microphone reports, a file each or one a line."""
    schema = f"mic_summaries array<struct<mic_name:string,files:array<struct<{schemas.struct(schemas.FILE_METRICS).simpleString()[7:-1]}>>>>"
    r = spark.read.schema(schema).option("multiLine", not lines).json(path)
    return r.select(F.explode("mic_summaries").alias("m")).select(F.explode("m.files").alias("f")).select("f.*")


def references(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """file and transcript of a list in a file, or of one object a line."""
    return spark.read.schema("file string, transcript string").option("multiLine", not lines).json(path)


def corpus(spark: SparkSession, path: str, columns: tuple[str, ...] = ("transcription", "raw_transcription")) -> DataFrame:
    """A speech corpus's rows: the first text column that it has, trimmed and not blank; a missing id is -1."""
    t = spark.read.parquet(path)
    text = F.coalesce(*[F.col(c) for c in columns if c in t.columns])
    rid = F.coalesce(F.col("id").cast("long"), F.lit(-1)) if "id" in t.columns else F.lit(-1).cast("long")
    return t.select(rid.alias("id"), F.trim(text).alias("transcription"), F.col("audio")).filter("transcription <> ''")


def tsv_pairs(spark: SparkSession, path: str) -> DataFrame:
    """name, text of two-column lines, cut at the first tab; other lines are skipped."""
    cut = spark.read.text(path).select(F.split("value", "\t", 2).alias("c")).filter(F.size("c") == 2)
    return cut.select(F.trim(F.col("c")[0]).alias("name"), F.trim(F.col("c")[1]).alias("text")).filter("name <> '' AND text <> ''")


def english_index(spark: SparkSession, path: str) -> DataFrame:
    """id to English from lines of four fields or more; later lines replace earlier ones."""
    lines = spark.read.text(path).select(F.split("value", "\t").alias("c"), F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"))
    rows = lines.filter(F.size("c") >= 4).select(F.col("c")[0].try_cast("long").alias("id"), F.trim(F.col("c")[3]).alias("english"), "at").filter("id IS NOT NULL")
    return rows.groupBy("id").agg(F.max_by("english", "at").alias("english"))


def load_sources(spark: SparkSession, sources: dict[str, Callable[[SparkSession], DataFrame]], names: list[str] | None = None) -> DataFrame:
    """Named loaders' rows in one shape (src, id, audio, transcription, english)."""
    out: DataFrame | None = None
    for name in names or list(sources):
        rows = sources[name](spark).withColumn("src", F.lit(name))
        for c in ("id", "audio", "transcription", "english"):
            if c not in rows.columns:
                rows = rows.withColumn(c, F.lit(None))
        rows = rows.select("src", F.col("id").cast("string"), "audio", "transcription", F.coalesce(F.col("english").cast("string"), F.lit("")).alias("english"))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("no source named")
    return out


def turn_files(spark: SparkSession, path: str, least_s: float = 0.5) -> DataFrame:
    """Turns of speaker files: lines that begin with SPEAKER and have eight fields or more, of a least length."""
    f = spark.read.text(path).select(F.split(F.trim("value"), r"\s+").alias("f"))
    rows = f.filter((F.get("f", F.lit(0)) == "SPEAKER") & (F.size("f") >= 8))
    t = rows.select(F.col("f")[1].alias("recording_id"), F.col("f")[3].try_cast("double").alias("start_s"), F.col("f")[4].try_cast("double").alias("d"), F.col("f")[7].alias("speaker_id"))
    return t.filter(F.col("d") >= least_s).select("recording_id", "speaker_id", "start_s", (F.col("start_s") + F.col("d")).alias("end_s"))


def documents(spark: SparkSession, path: str) -> DataFrame:
    """Plain text of word-processor files; an unreadable file has an error instead."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for p, data in zip(b["path"], b["content"], strict=True):
                try:
                    rows.append((p, zipfile.ZipFile(io.BytesIO(data)).read("word/document.xml").decode("utf-8", "ignore"), None))
                except Exception as e:
                    rows.append((p, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "xml", "error"])

    x = spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, xml string, error string")
    text = F.regexp_replace(F.replace("xml", F.lit("</w:p>"), F.lit("\n")), "<[^>]+>", "")
    unescape = F.pandas_udf(lambda s: s.map(lambda t: None if t is None else html.unescape(t)), "string")
    return x.select("path", unescape(text).alias("text"), "error")
