"""What sinks write and sources read, as round trips over the shared folder, and listings of recordings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance import schemas
from parlance.operators import dataset
from parlance.plans import fixtures as fx
from parlance.plans.meetings import SEGMENTS, placed
from parlance.sinks import files as sinks
from parlance.sinks import transcripts
from parlance.sources import audio, files, texts
from parlance.storage import fresh_path

md5 = lambda c: F.md5(F.col(c).cast("binary"))


def q_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents appended twice as JSON lines beside broken lines, and read again without these."""
    d = fx.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    path = fresh_path(spark, "json-lines")
    sinks.append_json_lines(d, path)
    sinks.append_json_lines(d, path)
    d.select(F.concat(F.lit('{"doc_id": '), F.col("doc_id").cast("string"), F.lit(', "text": "cut')).alias("value")).write.mode("append").text(path)
    return texts.json_lines(spark, path, "doc_id long, text string, lang string").select("doc_id", md5("text").alias("text"), "lang")


JSON_SQL = "SELECT doc_id, md5(text) AS text, lang FROM documents UNION ALL SELECT doc_id, md5(text), lang FROM documents"


def q_training_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as audio bytes in version, corpus, split and language folders, read again and summed by folder."""
    d = dataset.stratified_split(fx.pairs(spark, sf_dir), 10, ["src", "subsource"], "id", order=["id"])
    path = fresh_path(spark, "shards")
    sinks.training_shards(d.select("text", F.col("text").cast("binary").alias("audio_bytes"), F.col("src").alias("corpus"), "split", F.col("subsource").alias("language")), path)
    t = spark.read.parquet(path)
    return t.groupBy("version", "corpus", "split", "language").agg(F.count("*").alias("n"), F.sum("audio_size").alias("bytes"))


SHARD_SQL = f"""WITH s AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY src, subsource ORDER BY id) <= greatest(1, least(10, floor(count(*) OVER (PARTITION BY src, subsource) * 0.2))) THEN 'val' ELSE 'train' END AS split FROM {fx.PAIRS})
SELECT 0 AS version, src AS corpus, split, subsource AS language, count(*) AS n, CAST(sum(octet_length(encode(text))) AS BIGINT) AS bytes FROM s GROUP BY ALL"""


def q_corpus_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A speech corpus of documents written and read: its first text column, trimmed, blank rows left out, a missing id as -1."""
    d = fx.table(spark, sf_dir, "documents")
    path = fresh_path(spark, "corpus")
    d.select(F.when(F.col("doc_id") % 5 != 0, F.col("doc_id")).alias("id"), F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit(" "), "text")).alias("transcription"), F.col("lang").alias("raw_transcription"), F.lit(None).cast("binary").alias("audio")).write.parquet(path)
    return texts.corpus(spark, path).select("id", md5("transcription").alias("transcription"))


CORPUS_SQL = """WITH t AS (SELECT CASE WHEN doc_id % 5 <> 0 THEN doc_id ELSE -1 END AS id, trim(coalesce(CASE WHEN doc_id % 3 <> 0 THEN ' ' || text END, lang), ' ') AS t FROM documents)
SELECT id, md5(t) AS transcription FROM t WHERE t <> ''"""


def q_csv_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File metrics as a report with a header, read again by its names."""
    path = fresh_path(spark, "report")
    sinks.csv_report(fx.metrics(spark, sf_dir).select("file_path", "mic_name", "snr_db", "plosive_spike_count"), path)
    return spark.read.option("header", True).csv(path).select("file_path", "mic_name", F.col("snr_db").cast("double").alias("snr_db"), F.col("plosive_spike_count").cast("int").alias("spikes"))


def q_runs_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model runs as a report, times to two places, read again."""
    path = fresh_path(spark, "runs")
    sinks.runs_report(fx.runs(spark, sf_dir).drop("pos", "language"), path)
    return spark.read.schema(schemas.MODEL_RUNS).json(path).select("model_id", "audio_file", md5("transcript").alias("transcript"), "elapsed_s", "error")


RUNS_SQL = f"SELECT model_id, audio_file, md5(transcript) AS transcript, round(elapsed_s, 2) AS elapsed_s, error FROM {fx.RUNS}"


def q_nested_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nested report, microphones with their files, written as JSON and read as file rows."""
    m = fx.metrics(spark, sf_dir).select("file_path", "mic_name", "folder_key", "snr_db", "speech_ratio")
    path = fresh_path(spark, "nested")
    # one report for each folder, as a batch writes them
    mics = m.groupBy("folder_key", "mic_name").agg(F.collect_list(F.struct("file_path", "mic_name", "folder_key", "snr_db", "speech_ratio")).alias("files"))
    reports = mics.groupBy("folder_key").agg(F.collect_list(F.struct("mic_name", "files")).alias("mic_summaries"))
    sinks.json_report(reports.select("mic_summaries"), path)
    return texts.mic_report(spark, path, lines=True).select("file_path", "mic_name", "folder_key", "snr_db", "speech_ratio")


NESTED_SQL = f"SELECT file_path, mic_name, folder_key, snr_db, speech_ratio FROM {fx.METRICS}"


def q_reference_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References written as JSON and as tab-separated lines; both read again."""
    r = fx.table(spark, sf_dir, "conversations").select(F.concat_ws("/", "conv_id", "turn").alias("file"), F.replace("text", F.lit("\n"), F.lit(" ")).alias("transcript"))
    path = fresh_path(spark, "references")
    sinks.reference_files(r, path)
    one = texts.references(spark, f"{path}/json", lines=True).select("file", md5("transcript").alias("transcript"), F.lit("json").alias("kind"))
    return one.unionByName(texts.tsv_pairs(spark, f"{path}/tsv").select(F.col("name").alias("file"), md5("text").alias("transcript"), F.lit("tsv").alias("kind")))


REFERENCE_SQL = """WITH t AS (SELECT conv_id || '/' || turn AS file, replace(text, chr(10), ' ') AS t FROM conversations)
SELECT file, md5(t) AS transcript, 'json' AS kind FROM t UNION ALL SELECT file, md5(trim(t, ' ')), 'tsv' FROM t WHERE trim(t, ' ') <> ''"""


def q_english_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English by id from lines of four fields; short lines and lines without a number are skipped."""
    p = fx.table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    path = fresh_path(spark, "english")
    p.select(F.concat_ws("\t", F.when(k % 7 == 0, "x").otherwise(k.cast("string")), "p_brand", "p_type", F.when(k % 5 != 0, F.concat(F.lit(" "), "p_name"))).alias("value")).write.text(path)
    return texts.english_index(spark, path)


ENGLISH_SQL = "SELECT p_partkey AS id, p_name AS english FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 5 <> 0"


def q_turn_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as speaker-file lines of three decimals, read again if they last half a second."""
    t = fx.turns(spark, sf_dir).withColumns({"start_s": F.col("start_s") % 86400, "end_s": F.col("start_s") % 86400 + F.col("turn_no") % 90 / 32})
    path = fresh_path(spark, "turns")
    sinks.write_turns(t, path, "talk")
    r = texts.turn_files(spark, path)
    return r.select("recording_id", "speaker_id", F.round(F.col("start_s") * 1000).cast("long").alias("start_ms"), F.round((F.col("end_s") - F.col("start_s")) * 1000).cast("long").alias("ms"))


TURN_SQL = f"""WITH t AS (SELECT recording_id, (t0 / 1e6) % 86400 AS a, (t0 / 1e6) % 86400 + turn_no % 90 / 32::DOUBLE - (t0 / 1e6) % 86400 AS d FROM {fx.TURNS})
SELECT recording_id, 'talk' AS speaker_id, CAST(round(CAST(printf('%.3f', a) AS DOUBLE) * 1000) AS BIGINT) AS start_ms, CAST(round(CAST(printf('%.3f', d) AS DOUBLE) * 1000) AS BIGINT) AS ms FROM t WHERE CAST(printf('%.3f', d) AS DOUBLE) >= 0.5"""


def q_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest of recordings, written and read."""
    path = fresh_path(spark, "manifest")
    sinks.write_manifest(fx.metrics(spark, sf_dir).select(F.col("file_path").alias("path"), "duration_s"), path)
    return texts.json_lines(spark, path, "audio_filepath string, offset double, duration double, label string, text string")


MANIFEST_SQL = f"SELECT file_path AS audio_filepath, 0.0::DOUBLE AS offset, duration_s AS duration, 'infer' AS label, '-' AS text FROM {fx.METRICS}"


def spoken(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Facts, turns and gaps of every file of the interviews."""
    s = placed(spark, sf_dir).select(
        F.col("path").alias("recording_id"), "pos", F.col("pos").alias("segment_id"), "start_s", "end_s", "speaker_id", F.when(F.col("pos") == 0, "eng").otherwise("fra").alias("language"), "raw_text",
        F.concat("raw_text", F.lit("!")).alias("corrected_text"), F.lit("said").alias("english_translation"), F.lit(None).cast("string").alias("refined_translation"), F.lit(None).cast("timestamp_ntz").alias("absolute_start"),
    )
    f = fx.interview_files(spark, sf_dir)
    meta = f.select(
        F.col("path").alias("recording_id"), F.col("path").alias("audio_file"), F.col("duration_s").alias("total_s"), F.lit("2024-01-01").alias("recording_date"), F.lit("P").alias("project_name"),
        F.array(F.lit("eng"), F.lit("fra")).alias("languages"), F.lit(1).alias("num_speakers"), F.array(F.lit("whisper")).alias("engines"), F.array(F.lit("asr")).alias("stages"),
    )
    gaps = f.select(F.col("path").alias("recording_id"), F.col("duration_s").alias("start_s"), (F.col("duration_s") + 2).alias("end_s"), F.lit("noise_region").alias("region_type"), F.lit(2.0).alias("duration_s"))
    return meta, s, gaps


def q_transcript_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts as text: header, turns with raw, corrected and translated lines, gaps, footer; as digests."""
    return transcripts.text(*spoken(spark, sf_dir)).select("recording_id", md5("value").alias("text"))


_HMS = "printf('%02d:%02d:%02d', CAST(floor({0} / 3600) AS BIGINT), CAST(floor(({0} % 3600) / 60) AS BIGINT), CAST(floor({0} % 60) AS BIGINT))"
_FIELDS = [("Project", "'P'"), ("Date", "'2024-01-01'"), ("Duration", _HMS.format("duration_s")), ("Audio File", "path"), ("Languages", "'eng, fra'"), ("Speakers", "'1 identified'"), ("Transcription", "'Verbatim'"), ("ASR Engines", "'whisper'"), ("Post-processed", "'asr'")]
_HEAD = " || chr(10) || ".join(["repeat('=', 72)", "'TRANSCRIPT'", "repeat('=', 72)", *(f"rpad('{n}:', 16, ' ') || {v}" for n, v in _FIELDS), "repeat('=', 72)", "''"])
TEXT_SQL = f"""
WITH l AS (SELECT path, duration_s, pos, '[' || {_HMS.format("(pos * duration_s / 2)")} || '] SPEAKER_F' || file_idx || '_' || role || ':' || CASE WHEN trim(half, ' ') <> '' THEN chr(10) || CASE WHEN pos = 0 THEN '[en-raw] ' ELSE '[fr-raw] ' END || half ELSE '' END
  || chr(10) || CASE WHEN pos = 0 THEN '[en] ' ELSE '[fr] ' END || half || '!' || CASE WHEN pos = 1 THEN chr(10) || '[en] said' ELSE '' END || chr(10) AS block FROM {SEGMENTS})
SELECT path AS recording_id, md5({_HEAD} || chr(10) || string_agg(block, chr(10) ORDER BY pos) || chr(10) || '        [NOISE-REGION — 2.0s]' || chr(10) || chr(10) || repeat('=', 72) || chr(10) || 'END OF TRANSCRIPT' || chr(10) || repeat('=', 72)) AS text FROM l GROUP BY path, duration_s
"""


def q_transcript_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts in every format, written, listed, and the JSON ones read again with both texts."""
    meta, s, gaps = spoken(spark, sf_dir)
    path = fresh_path(spark, "transcripts")
    written = transcripts.write(path, meta, s, gaps)
    r = texts.transcripts(spark, f"{path}/format=json", lines=True)
    return r.select(F.col("metadata.audio_file").alias("file"), F.size("segments").alias("n"), md5("raw").alias("raw"), md5("text").alias("text"), F.lit(",".join(written)).alias("formats"))


JSON_TEXT_SQL = f"""SELECT path AS file, CAST(count(*) AS INT) AS n, md5(coalesce(string_agg(trim(half, ' '), ' ' ORDER BY pos) FILTER (trim(half, ' ') <> ''), '')) AS raw, md5(string_agg(trim(half || '!', ' '), ' ' ORDER BY pos)) AS text, 'txt,json,srt' AS formats
FROM {SEGMENTS} GROUP BY path"""


def q_written_subtitles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One format asked for: only its table is there, one row for each recording."""
    meta, s, gaps = spoken(spark, sf_dir)
    path = fresh_path(spark, "subtitles")
    transcripts.write(path, meta, s, gaps, "srt")
    t = spark.read.schema("recording_id string, value string, format string").json(path)
    return t.select("format", "recording_id", F.size(F.split("value", "-->")).alias("n"))


WRITTEN_SQL = f"SELECT 'srt' AS format, path AS recording_id, 3 AS n FROM {SEGMENTS} GROUP BY path"


def recorded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing of recordings as a recorder leaves them, from events: interview folders, other folders, odd names."""
    e = fx.table(spark, sf_dir, "events")
    i = F.col("event_id")
    day = F.when(i % 11 == 0, "20241345").otherwise(F.date_format("ts", "yyyyMMdd"))
    name = F.concat(F.sha1(i.cast("string").cast("binary")), F.lit("-audio-audit-"), day, F.lit("_"), F.date_format("ts", "HHmmssSSS"), F.when(i % 13 == 0, ".mp3").otherwise(".m4a"))
    parent = F.when(F.col("user_id") % 3 == 0, "audioaudit").when(i % 4 == 0, "audioaudit").otherwise("AudioAudit")
    key = F.format_string("%02d-%02d-00-01", (F.col("user_id") % 90 + 10).cast("int"), (F.col("user_id") % 7).cast("int"))
    return e.select(F.concat_ws("/", F.lit("file:/r"), key, parent, name).alias("path"), i.alias("length"), name.alias("name"), parent.alias("parent"), key.alias("grandparent"))


RECORDED = """(SELECT *, '/' AS x, 'file:/r/' || key || '/' || parent || '/' || name AS path FROM (SELECT event_id AS i, ts, printf('%02d-%02d-00-01', user_id % 90 + 10, user_id % 7) AS key,
  CASE WHEN user_id % 3 = 0 OR event_id % 4 = 0 THEN 'audioaudit' ELSE 'AudioAudit' END AS parent, event_id % 11 <> 0 AS dated,
  sha1(CAST(event_id AS VARCHAR)) || '-audio-audit-' || CASE WHEN event_id % 11 = 0 THEN '20241345' ELSE strftime(ts, '%Y%m%d') END || '_' || strftime(ts, '%H%M%S%g') || CASE WHEN event_id % 13 = 0 THEN '.mp3' ELSE '.m4a' END AS name FROM events))"""


def q_recorder_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What recorders' file names say: id and start; nothing for other names and impossible dates."""
    p = recorded(spark, sf_dir).select("path", files.parse_name(F.col("name")).alias("p"))
    return p.select("path", "p.uuid", F.date_format("p.recording_start", "yyyy-MM-dd HH:mm:ss.SSS").alias("starts"))


NAMES_SQL = f"SELECT path, CASE WHEN dated AND i % 13 <> 0 THEN sha1(CAST(i AS VARCHAR)) END AS uuid, CASE WHEN dated AND i % 13 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%g') END AS starts FROM {RECORDED}"


def q_interview_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings by interview in start order; a folder named exactly goes before other cases of its name."""
    return files.interviews(recorded(spark, sf_dir)).select("interview_key", "path", "file_idx")


INTERVIEW_SQL = f"""WITH k AS (SELECT *, max((parent = 'AudioAudit')::INT) OVER (PARTITION BY key) AS exact FROM {RECORDED} WHERE dated AND i % 13 <> 0)
SELECT key AS interview_key, path, CAST(row_number() OVER (PARTITION BY key ORDER BY date_trunc('millisecond', ts), path) AS INT) AS file_idx FROM k WHERE exact = 0 OR parent = 'AudioAudit'"""


def q_test_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings of a microphone test, with their microphone, or the folder's name where none is known."""
    t = files.test_recordings(recorded(spark, sf_dir)).groupBy("folder_key").agg(F.count("*").alias("n"))
    known = fx.table(spark, sf_dir, "nation").select(F.format_string("%02d-%02d-00-01", (F.col("n_nationkey") + 10).cast("int"), (F.col("n_nationkey") % 7).cast("int")).alias("folder_key"), F.col("n_name").alias("mic_name"))
    return files.with_mic(t, known).select("folder_key", "n", "mic_name")


TEST_SQL = f"""SELECT key AS folder_key, count(*) AS n, coalesce(max(n_name), 'Unknown (' || key || ')') AS mic_name FROM {RECORDED} LEFT JOIN nation ON key = printf('%02d-%02d-00-01', n_nationkey + 10, n_nationkey % 7)
WHERE parent = 'AudioAudit' AND i % 13 <> 0 GROUP BY key"""


def q_unfinished_interviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interviews without any output."""
    r = recorded(spark, sf_dir)
    return files.not_finished(r.select(F.col("grandparent").alias("interview_key")).distinct(), r.filter("length % 100 = 7").select(F.col("grandparent").alias("parent")))


UNFINISHED_SQL = f"SELECT DISTINCT key AS interview_key FROM {RECORDED} WHERE key NOT IN (SELECT key FROM {RECORDED} WHERE i % 100 = 7)"


def q_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every supplier's stem its recordings and its transcript document."""
    s = fx.table(spark, sf_dir, "supplier").select(F.format_string("S%04d-", F.col("s_suppkey")).alias("stem"))
    c = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    name = F.concat(F.format_string("S%04d-%d", F.col("k") % 120, F.col("k")), F.when(F.col("k") % 3 == 0, "_Transcription.docx").otherwise(".m4a"))
    listing = c.select(F.concat(F.lit("/a/"), name).alias("path"), name.alias("name"))
    return files.assets(listing, s).select("stem", F.array_join("audio", ",").alias("audio"), "document")


ASSETS_SQL = """WITH f AS (SELECT printf('S%04d-%d', c_custkey % 120, c_custkey) || CASE WHEN c_custkey % 3 = 0 THEN '_Transcription.docx' ELSE '.m4a' END AS name, c_custkey % 120 AS s FROM customer)
SELECT printf('S%04d-', s_suppkey) AS stem, coalesce(string_agg('/a/' || name, ',' ORDER BY name) FILTER (name LIKE '%.m4a'), '') AS audio, min('/a/' || name) FILTER (name LIKE '%.docx') AS document FROM supplier JOIN f ON s = s_suppkey GROUP BY s_suppkey"""


def q_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders of a written table, listed, with the kinds of files that are asked for."""
    path = fresh_path(spark, "listed")
    fx.table(spark, sf_dir, "documents").select("doc_id", "lang").write.partitionBy("lang").json(path)
    found = files.with_extension(files.listing(spark, path), (".json",))
    none = files.audio_files(spark, path).count() + files.scan(spark, path).count()
    return found.select(F.col("parent").alias("folder"), F.lit(none).alias("recordings")).distinct()


LISTING_SQL = "SELECT DISTINCT 'lang=' || coalesce(lang, '__HIVE_DEFAULT_PARTITION__') AS folder, 0 AS recordings FROM documents"


def q_mic_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders below headings of one note: regions as microphones, nations as folders."""
    n, r = fx.table(spark, sf_dir, "nation"), fx.table(spark, sf_dir, "region")
    lines = r.select((F.col("r_regionkey") * 1000).alias("k"), F.concat(F.lit("## "), "r_name").alias("line")).unionByName(
        n.select((F.col("n_regionkey") * 1000 + 1 + F.col("n_nationkey")).alias("k"), F.concat(F.lit("- "), F.format_string("%02d-00-11-22", "n_nationkey"), F.lit(" room")).alias("line"))
    )
    note = lines.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "line"))), lambda x: x["line"]), "\n").alias("value"))  # one short note
    path = fresh_path(spark, "note")
    note.coalesce(1).write.text(path)
    return files.mic_mapping(spark, path)


MAPPING_SQL = "SELECT printf('%02d-00-11-22', n_nationkey) AS folder_key, r_name AS mic_name FROM nation JOIN region ON r_regionkey = n_regionkey"


def wave_bytes(data: Column, rate: int) -> Column:
    """Bytes as the samples of a mono wave file of 8 bits."""
    little = lambda v: F.unhex(F.regexp_replace(F.lpad(F.hex(v), 8, "0"), "^(..)(..)(..)(..)$", "$4$3$2$1"))
    n = F.octet_length(data)
    head = [F.unhex(F.lit("52494646")), little(n + 36), F.unhex(F.lit("57415645666d74201000000001000100")), little(F.lit(rate)), little(F.lit(rate)), F.unhex(F.lit("0100080064617461")), little(n)]
    return F.concat(*head, data)


def q_clip_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' bytes as wave files of 50 samples a second: those of 2 to 20 seconds, and what can't be read."""
    d = fx.table(spark, sf_dir, "documents").filter("text IS NOT NULL")
    data = F.when(F.col("doc_id") % 10 == 3, F.col("text").cast("binary")).otherwise(wave_bytes(F.col("text").cast("binary"), 50))
    rows = audio.with_duration(d.select("doc_id", F.struct(data.alias("bytes"), F.lit("x.wav").alias("path")).alias("audio")))
    return rows.filter(dataset.clip_filter(F.col("duration_s")) | F.col("duration_s").isNull()).select("doc_id", "duration_s")


CLIP_SQL = """SELECT doc_id, CASE WHEN doc_id % 10 <> 3 THEN octet_length(encode(text)) / 50::DOUBLE END AS duration_s FROM documents
WHERE text IS NOT NULL AND (doc_id % 10 = 3 OR octet_length(encode(text)) / 50::DOUBLE BETWEEN 2 AND 20)"""


def q_loaded_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loaders in one shape, each with the columns that it has."""
    loaders = {
        "documents": lambda s: fx.table(s, sf_dir, "documents").select(F.col("doc_id").alias("id"), md5("text").alias("transcription")),
        "parts": lambda s: fx.table(s, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_type").alias("transcription"), F.col("p_name").alias("english")),
        "pages": lambda s: fx.table(s, sf_dir, "pages").select(F.col("url").alias("audio"), md5("html").alias("transcription")),
    }
    return texts.load_sources(spark, loaders).select("src", "id", "audio", "transcription", "english")


LOADED_SQL = """SELECT 'documents' AS src, CAST(doc_id AS VARCHAR) AS id, NULL AS audio, md5(text) AS transcription, '' AS english FROM documents
UNION ALL SELECT 'parts', CAST(p_partkey AS VARCHAR), NULL, p_type, coalesce(p_name, '') FROM part UNION ALL SELECT 'pages', NULL, url, md5(html), '' FROM pages"""

QUERIES = {
    "q_json_lines": (q_json_lines, JSON_SQL),
    "q_training_shards": (q_training_shards, SHARD_SQL),
    "q_corpus_rows": (q_corpus_rows, CORPUS_SQL),
    "q_csv_report": (q_csv_report, f"SELECT file_path, mic_name, snr_db, CAST(plosive_spike_count AS INT) AS spikes FROM {fx.METRICS}"),
    "q_runs_report": (q_runs_report, RUNS_SQL),
    "q_nested_report": (q_nested_report, NESTED_SQL),
    "q_reference_files": (q_reference_files, REFERENCE_SQL),
    "q_english_index": (q_english_index, ENGLISH_SQL),
    "q_turn_files": (q_turn_files, TURN_SQL),
    "q_manifest": (q_manifest, MANIFEST_SQL),
    "q_transcript_text": (q_transcript_text, TEXT_SQL),
    "q_transcript_json": (q_transcript_json, JSON_TEXT_SQL),
    "q_written_subtitles": (q_written_subtitles, WRITTEN_SQL),
    "q_recorder_names": (q_recorder_names, NAMES_SQL),
    "q_interview_files": (q_interview_files, INTERVIEW_SQL),
    "q_test_recordings": (q_test_recordings, TEST_SQL),
    "q_unfinished_interviews": (q_unfinished_interviews, UNFINISHED_SQL),
    "q_assets": (q_assets, ASSETS_SQL),
    "q_listing": (q_listing, LISTING_SQL),
    "q_mic_mapping": (q_mic_mapping, MAPPING_SQL),
    "q_clip_durations": (q_clip_durations, CLIP_SQL),
    "q_loaded_sources": (q_loaded_sources, LOADED_SQL),
}
