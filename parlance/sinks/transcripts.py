"""Transcripts as text, JSON and subtitles, one row for each recording, and their writers.

Rows of a recording are brought together here only, at the sink.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions.languages import tag
from parlance.functions.text import display_label
from parlance.functions.times import format_srt, format_timestamp, iso_ms
from parlance.operators.interviews import timeline

RULE = "=" * 72
FORMATS = ("txt", "json", "srt")


def ordered(value: Column, *order: str) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct(*order, value.alias("_v")))), lambda x: x["_v"])


def speech_block(fmt: str, include_raw: bool, include_translation: bool, english_only: Column) -> Column:
    """A turn's lines: time and speaker; then the text alone, or raw, corrected and translated text with tags."""
    at = F.coalesce(iso_ms(F.col("absolute_start")), format_timestamp(F.col("start_s"), fmt))
    head = F.concat(F.lit("["), at, F.lit("] "), "speaker_id", F.lit(":"))
    raw, corrected = F.trim(F.coalesce("raw_text", F.lit(""))), F.trim(F.coalesce("corrected_text", F.lit("")))
    short = tag(F.col("language"))
    changed = F.when((raw != "") & (raw != corrected), F.concat(F.lit("["), short, F.lit("-raw] "), "raw_text"))
    fixed = F.concat(F.lit("["), short, F.lit("] "), "corrected_text")
    english = F.coalesce(F.nullif(F.col("refined_translation"), F.lit("")), F.nullif(F.col("english_translation"), F.lit("")))
    translated = F.when(F.col("language") != "eng", F.concat(F.lit("[en] "), english))
    none = F.lit(None).cast("string")
    many = F.concat_ws("\n", head, changed if include_raw else none, fixed if include_raw else none, translated if include_translation else none)
    return F.when(english_only, F.concat_ws("\n", head, "corrected_text")).otherwise(many)


def gap_block() -> Column:
    d = F.when(F.col("duration_s") > 0, F.col("duration_s")).otherwise(F.col("end_s") - F.col("start_s"))
    label = F.concat(F.lit("["), display_label(F.col("region_type")), F.format_string(" — %.1fs]", d))
    return F.concat(F.lit("        "), F.coalesce(F.concat(F.lit("["), iso_ms(F.col("absolute_start")), F.lit("] ")), F.lit("")), label)


def header(meta: DataFrame) -> Column:
    """The block above a transcript; lines whose facts are missing are left out."""
    c = lambda n: F.col(n) if n in meta.columns else F.lit(None)
    field = lambda name, value: F.concat(F.lit(f"{name + ':':<16}"), value.cast("string"))
    quality = F.format_string("%.0f%% speech | %.0f%% non-speech | Longest gap: %.1fs", c("speech_ratio").cast("double") * 100, (1 - c("speech_ratio").cast("double")) * 100, c("longest_silence_s").cast("double"))
    return F.concat_ws(
        "\n", F.lit(RULE), F.lit("TRANSCRIPT"), F.lit(RULE),
        field("Interview", c("interview_key")), F.when(c("interview_key").isNotNull(), field("Time Range", F.concat_ws(" — ", c("recording_start").cast("string"), c("recording_end").cast("string")))),
        F.when(c("interview_key").isNotNull(), field("Source Files", c("n_files"))),
        field("Project", F.coalesce(c("project_name"), F.lit("N/A"))), field("Date", F.coalesce(c("recording_date"), F.current_date().cast("string"))),
        field("Duration", format_timestamp(F.col("total_s"))), field("Audio File", F.col("recording_id")), field("Languages", F.array_join("languages", ", ")),
        field("Speakers", F.concat(F.col("num_speakers").cast("string"), F.lit(" identified"))), field("Transcription", F.initcap(F.replace(F.coalesce(c("style"), F.lit("verbatim")), F.lit("_"), F.lit(" ")))),
        field("ASR Engines", F.array_join("engines", ", ")), field("Post-processed", F.array_join("stages", ", ")),
        F.when(c("speech_ratio").isNotNull(), field("Audio Quality", quality)), F.lit(RULE), F.lit(""),
    )


def text(meta: DataFrame, speech: DataFrame, gaps: DataFrame, fmt: str = "HH:MM:SS", include_raw: bool = True, include_translation: bool = True) -> DataFrame:
    """(recording_id, value): header, timeline of turns and gaps, footer."""
    head = meta.select("recording_id", header(meta).alias("head"), ((F.size("languages") == 1) & F.get("languages", F.lit(0)).isin("English", "eng")).alias("only_english"))
    if "absolute_start" not in gaps.columns:
        gaps = gaps.withColumn("absolute_start", F.lit(None).cast("timestamp_ntz"))
    lines = timeline(speech, gaps).join(head.select("recording_id", "only_english"), "recording_id")
    block = F.when(F.col("kind") == 1, gap_block()).otherwise(speech_block(fmt, include_raw, include_translation, F.col("only_english")))
    body = lines.groupBy("recording_id").agg(F.array_join(ordered(F.concat(block, F.lit("\n")), "line"), "\n").alias("body"))
    foot = F.lit(f"{RULE}\nEND OF TRANSCRIPT\n{RULE}")
    return head.join(body, "recording_id", "left").select("recording_id", F.concat_ws("\n", "head", "body", foot).alias("value"))


def json(meta: DataFrame, speech: DataFrame, gaps: DataFrame) -> DataFrame:
    """(recording_id, value): metadata, segments and gaps as one object."""
    inner = lambda df: F.struct(*[c for c in df.columns if c != "recording_id"])
    s = speech.groupBy("recording_id").agg(ordered(inner(speech), "pos").alias("segments"))
    g = gaps.groupBy("recording_id").agg(ordered(inner(gaps), "start_s").alias("non_speech_segments"))
    m = meta.select("recording_id", F.struct(*meta.columns).alias("metadata"))
    both = m.join(s, "recording_id", "left").join(g, "recording_id", "left")
    return both.select("recording_id", F.to_json(F.struct("metadata", "segments", "non_speech_segments")).alias("value"))


def srt(speech: DataFrame, use_translation: bool = True) -> DataFrame:
    """(recording_id, value): numbered subtitles of the turns; gaps have none."""
    better = F.when((F.col("language") != "eng") & (F.coalesce("refined_translation", F.lit("")) != ""), F.col("refined_translation"))
    shown = F.coalesce(better, F.col("corrected_text")) if use_translation else F.col("corrected_text")
    entry = F.concat(format_srt(F.col("start_s")), F.lit(" --> "), format_srt(F.col("end_s")), F.lit("\n["), "speaker_id", F.lit("] "), shown, F.lit("\n"))
    per = speech.groupBy("recording_id").agg(ordered(entry, "pos").alias("entries"))
    return per.select("recording_id", F.array_join(F.transform("entries", lambda e, i: F.concat((i + 1).cast("string"), F.lit("\n"), e)), "\n").alias("value"))


def write(path: str, meta: DataFrame, speech: DataFrame, gaps: DataFrame, fmt: str = "all", folders: bool = False, **options) -> list[str]:
    """Write one format or all under ``format=`` folders; an unknown format writes nothing.

    ``json`` has one transcript object a line. ``txt`` and ``srt`` have one object of recording_id and value a line, since
    their texts have lines of their own. With ``folders`` every recording is a folder of plain text files instead, as a
    person wants to open them; that is for a selection of recordings, not for millions.
    """
    made = {"txt": lambda: text(meta, speech, gaps, **options), "json": lambda: json(meta, speech, gaps), "srt": lambda: srt(speech)}
    wanted = [f for f in FORMATS if fmt in (f, "all")]
    for f in wanted:
        rows, out = made[f](), f"{path}/format={f}"
        if folders:
            rows.write.mode("overwrite").partitionBy("recording_id").option("lineSep", "\n\n").text(out)
        elif f == "json":
            rows.select("value").write.mode("overwrite").text(out)
        else:
            rows.select(F.to_json(F.struct("recording_id", "value")).alias("value")).write.mode("overwrite").text(out)
    return wanted
