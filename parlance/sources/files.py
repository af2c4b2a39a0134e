"""File listings and what paths say. Listings read names only: file contents are pruned from the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

AUDIO = (".m4a", ".wav", ".mp3", ".flac", ".ogg", ".opus", ".wma")
SCANNED = (".m4a", ".wav", ".mp3", ".flac", ".ogg", ".opus", ".aac")
KEY = r"^\d{2}-\d{2}-\d{2}-\d{2}$"
NAME = r"(?i)^([0-9a-f]+)-audio-audit-(\d{8})_(\d{9})\.m4a$"


def listing(spark: SparkSession, path: str) -> DataFrame:
    """path, name, parent and grandparent names, size and time of every file below a folder (or of one file)."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
    part = lambda k: F.try_element_at(F.split("path", "/"), F.lit(k))
    return f.select("path", "length", "modificationTime", part(-1).alias("name"), part(-2).alias("parent"), part(-3).alias("grandparent"))


def with_extension(files: DataFrame, extensions: tuple[str, ...] = AUDIO, any_case: bool = False) -> DataFrame:
    name = F.lower("name") if any_case else F.col("name")
    return files.filter(F.regexp_extract(name, r"(\.[^.]*)$", 1).isin(*extensions))


def audio_files(spark: SparkSession, path: str) -> DataFrame:
    return with_extension(listing(spark, path)).orderBy("path")


def scan(spark: SparkSession, path: str, extensions: tuple[str, ...] = SCANNED, limit: int | None = None) -> DataFrame:
    found = with_extension(listing(spark, path), extensions, any_case=True).orderBy("path")
    return found if limit is None else found.limit(limit)


def parse_name(name: Column) -> Column:
    """(uuid, recording_start) of a recorder's file name; null if it has another form or an impossible date."""
    d, t = F.regexp_extract(name, NAME, 2), F.regexp_extract(name, NAME, 3)
    text = F.concat(d, F.lit(" "), F.substring(t, 1, 6), F.lit("."), F.substring(t, 7, 3))
    at = F.try_to_timestamp(text, F.lit("yyyyMMdd HHmmss.SSS")).cast("timestamp_ntz")
    return F.when(name.rlike(NAME) & at.isNotNull(), F.struct(F.regexp_extract(name, NAME, 1).alias("uuid"), at.alias("recording_start")))


def interviews(files: DataFrame) -> DataFrame:
    """Recordings below ``{key}/AudioAudit/``, in start order; an exact folder name goes before other cases of it."""
    rows = files.filter(F.lower("parent") == "audioaudit").withColumn("parsed", parse_name(F.col("name"))).filter("parsed IS NOT NULL")
    keyed = rows.withColumn("interview_key", F.col("grandparent"))
    exact = F.max((F.col("parent") == "AudioAudit").cast("int")).over(Window.partitionBy("interview_key"))
    chosen = keyed.withColumn("_exact", exact).filter((F.col("_exact") == 0) | (F.col("parent") == "AudioAudit"))
    w = Window.partitionBy("interview_key").orderBy("parsed.recording_start", "path")
    return chosen.select("interview_key", "path", "name", "length", "parsed.uuid", "parsed.recording_start", F.row_number().over(w).alias("file_idx"))


def test_recordings(files: DataFrame) -> DataFrame:
    return files.filter(F.col("grandparent").rlike(KEY) & (F.col("parent") == "AudioAudit") & F.lower("name").endswith(".m4a")).withColumn("folder_key", F.col("grandparent"))


def not_finished(keys: DataFrame, outputs: DataFrame) -> DataFrame:
    """Interviews without any output file: the key is the output's folder."""
    return keys.join(outputs.select(F.col("parent").alias("interview_key")).distinct(), "interview_key", "left_anti")


def assets(files: DataFrame, stems: DataFrame) -> DataFrame:
    """Per stem its recordings, sorted, and its first transcript document."""
    # a name is cut at every length that a stem has (a few), so that stems and files meet by equality
    lengths = sorted(r[0] for r in stems.select(F.length("stem")).distinct().collect() if r[0])
    cut = files.withColumn("_key", F.explode(F.array(*[F.lower(F.substring("name", 1, n)) for n in lengths]).cast("array<string>")))
    j = stems.withColumn("_key", F.lower("stem")).join(cut.distinct(), "_key")
    return j.groupBy("stem").agg(
        F.array_sort(F.collect_set(F.when(F.col("name").endswith(".m4a") & F.col("name").startswith(F.col("stem")), F.col("path")))).alias("audio"),
        F.min(F.when(F.lower("name").endswith(".docx") & F.lower("name").contains("ranscription"), F.col("path"))).alias("document"),
    )


def mic_mapping(spark: SparkSession, path: str) -> DataFrame:
    """(folder_key, mic_name) from a text of headings and keys: a heading holds for the lines below it."""
    text = spark.read.option("wholetext", True).text(path)
    lines = text.select(F.posexplode(F.split("value", "\r?\n")).alias("pos", "line"))
    head = F.when(F.col("line").rlike(r"^\s*#"), F.trim(F.regexp_replace("line", r"^\s*#+", "")))
    # one small document: its lines have one order
    w = Window.partitionBy(F.lit(0)).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = lines.withColumn("mic", F.last(head, True).over(w)).filter(head.isNull()).withColumn("key", F.regexp_extract("line", r"(\d{2}-\d{2}-\d{2}-\d{2})", 1))
    return rows.filter("key <> '' AND mic IS NOT NULL").groupBy(F.col("key").alias("folder_key")).agg(F.max_by("mic", "pos").alias("mic_name"))


def with_mic(df: DataFrame, mapping: DataFrame) -> DataFrame:
    m = mapping.select("folder_key", F.col("mic_name").alias("_mic"))
    return df.join(m, "folder_key", "left").withColumn("mic_name", F.coalesce("_mic", F.concat(F.lit("Unknown ("), "folder_key", F.lit(")")))).drop("_mic")
