import datetime
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from parlance import schemas
from parlance.functions import times
from parlance.operators.inference import region_fallback
from parlance.sinks import files as out
from parlance.sinks import transcripts
from parlance.sources import files, texts

STAMP = "20231014_141450489"


@pytest.fixture
def tree(tmp_path):
    for p in [f"k1/AudioAudit/02c8-audio-audit-{STAMP}.m4a", "k1/AudioAudit/02c9-audio-audit-20231014_141400000.m4a", "k1/audioaudit/02ca-audio-audit-20231014_141300000.m4a", f"k2/audioAUDIT/ab-audio-audit-{STAMP}.M4A",
              "k2/audioAUDIT/ab-audio-audit-20231399_141450489.m4a", "k2/audioAUDIT/other.m4a", "01-02-03-04/AudioAudit/x.m4a", "z.WAV", "z.txt"]:
        f = tmp_path / "in" / p
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_bytes(b"x")
    return str(tmp_path / "in")


def test_listings(spark, tree):
    assert files.audio_files(spark, tree).count() == 6
    assert files.scan(spark, tree).count() == 8 and files.scan(spark, tree, limit=2).count() == 2
    plan = files.listing(spark, tree)._jdf.queryExecution().toString()
    assert "content" not in plan.split("ReadSchema")[-1]


def test_interviews(spark, tree):
    i = files.interviews(files.listing(spark, tree)).orderBy("interview_key", "file_idx").collect()
    assert [(r["interview_key"], r["uuid"], r["file_idx"]) for r in i] == [("k1", "02c9", 1), ("k1", "02c8", 2), ("k2", "ab", 1)]
    assert i[1]["recording_start"] == datetime.datetime(2023, 10, 14, 14, 14, 50, 489000)
    assert files.test_recordings(files.listing(spark, tree)).first()["folder_key"] == "01-02-03-04"


def test_mic_mapping(spark, tmp_path):
    (tmp_path / "README.txt").write_text("00-00-00-00 early\n# Mic A\n01-01-01-01\n\n# Mic B\nsee 02-02-02-02 and more\n01-01-01-01\n")
    m = files.mic_mapping(spark, str(tmp_path / "README.txt"))
    assert {r["folder_key"]: r["mic_name"] for r in m.collect()} == {"01-01-01-01": "Mic B", "02-02-02-02": "Mic B"}
    df = spark.createDataFrame([("02-02-02-02",), ("09-09-09-09",)], "folder_key string")
    assert {r["mic_name"] for r in files.with_mic(df, m).collect()} == {"Mic B", "Unknown (09-09-09-09)"}


def test_json_lines(spark, tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text('{"src":"a","id":"1","bengali":"ক"}\n{broken\n{"src":"b","id":"2"}\n', encoding="utf-8")
    assert texts.json_lines(spark, str(p)).count() == 2
    out.append_json_lines(texts.json_lines(spark, str(p)), str(tmp_path / "o"))
    out.append_json_lines(texts.json_lines(spark, str(p)), str(tmp_path / "o"))
    assert texts.json_lines(spark, str(tmp_path / "o")).count() == 4
    assert "ক" in "".join(f.read_text(encoding="utf-8") for f in (tmp_path / "o").glob("*.json"))


def test_transcripts_and_reports(spark, tmp_path):
    t = tmp_path / "t.json"
    t.write_text(json.dumps({"metadata": {"audio_file": "a"}, "segments": [{"raw_text": " r1 ", "corrected_text": "c1"}, {"raw_text": "r2", "corrected_text": " "}, {"raw_text": ""}]}))
    r = texts.transcripts(spark, str(t)).first()
    assert (r["raw"], r["text"]) == ("r1 r2", "c1 r2")
    m = tmp_path / "m.json"
    m.write_text(json.dumps({"mic_summaries": [{"mic_name": "A", "files": [{"file_path": "x", "snr_db": 1.5}, {"file_path": "y"}]}]}))
    assert texts.mic_report(spark, str(m)).count() == 2


def test_line_formats(spark, tmp_path):
    (tmp_path / "p.tsv").write_text("a\tb c\nnone\nd\te\tf\n")
    assert [tuple(r) for r in texts.tsv_pairs(spark, str(tmp_path / "p.tsv")).collect()] == [("a", "b c"), ("d", "e\tf")]
    (tmp_path / "e.tsv").write_text("1\tx\ty\tone\nbad\tx\ty\tz\n1\tx\ty\tuno \n2\tx\n")
    assert [tuple(r) for r in texts.english_index(spark, str(tmp_path / "e.tsv")).collect()] == [(1, "uno")]
    (tmp_path / "x.rttm").write_text("SPEAKER f 1 0.5 1.5 <NA> <NA> spk <NA> <NA>\nSPEAKER f 1 3 0.2 <NA> <NA> spk\nSPKR-INFO f\nSPEAKER f 1\n")
    t = texts.turn_files(spark, str(tmp_path / "x.rttm"))
    assert [tuple(r) for r in t.collect()] == [("f", "spk", 0.5, 2.0)]
    lines = [r["value"] for r in out.turn_lines(spark.createDataFrame([("f", 0.5, 2.0), ("f", 2.0, 2.0)], "recording_id string, start_s double, end_s double")).collect()]
    assert lines == ["SPEAKER f 1 0.500 1.500 <NA> <NA> speech <NA> <NA>"]


def test_three_decimals_round_as_c_does(spark):
    values = [0.0625, 54321.0625, 54321.1875, 1.0005, 0.0005, 0.9995, 2.6875, 86399.9996, 1e-9, 7.0, 123456789.0005, 0.00050000000001, -1.5]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select("x", times.three_decimals(F.col("x")).alias("s")).collect()
    assert {r["x"]: r["s"] for r in rows} == {v: f"{v:.3f}" for v in values}
    lines = [r["value"] for r in out.turn_lines(spark.createDataFrame([("f", 54321.0625, 54322.625)], "recording_id string, start_s double, end_s double")).collect()]
    assert lines == ["SPEAKER f 1 54321.062 1.562 <NA> <NA> speech <NA> <NA>"]


def test_word_processor_files(spark, tmp_path):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("word/document.xml", "<w:p><w:t>a &amp; b</w:t></w:p><w:p>c</w:p>")
    (tmp_path / "a.docx").write_bytes(buffer.getvalue())
    (tmp_path / "b.docx").write_bytes(b"bad")
    got = {r["path"][-6:]: r for r in texts.documents(spark, str(tmp_path)).collect()}
    assert got["a.docx"]["text"] == "a & b\nc\n" and got["b.docx"]["error"]


def test_sources_in_one_shape(spark):
    s = {"a": lambda sp: sp.createDataFrame([(1, "x")], "id int, transcription string"), "b": lambda sp: sp.createDataFrame([("q", "e")], "transcription string, english string")}
    rows = texts.load_sources(spark, s).orderBy("src").collect()
    assert [(r["src"], r["id"], r["transcription"], r["english"]) for r in rows] == [("a", "1", "x", ""), ("b", None, "q", "e")]


def test_training_shards(spark, tmp_path):
    df = spark.createDataFrame([("t", bytearray(b"\xff\x01"), "c", "train", "ben")], "text string, audio_bytes binary, corpus string, split string, language string")
    out.training_shards(df, str(tmp_path / "o"))
    assert list((tmp_path / "o/version=0/corpus=c/split=train/language=ben").glob("*.parquet"))
    assert spark.read.parquet(str(tmp_path / "o")).first()["audio_size"] == 2


@pytest.fixture
def recording(spark):
    rows = [("r", 0, 0, 0.0, 5.0, "S0", "hin", "raw", "fixed", "english", "", 1.0, None, None, None, None), ("r", 1, 1, 12.0, 20.5, "S1", "eng", "same", "same", "same", "same", 1.0, None, None, None, None)]
    speech = spark.createDataFrame(rows, schemas.PROCESSED)
    gaps = spark.createDataFrame([("r", 5.0, 12.0, "non_speech", 5.0)], schemas.NON_SPEECH)
    meta = spark.createDataFrame([("r", 20.5, ["Hindi", "English"], 2, ["whisper"], ["asr"], 0.75, 5.0)], "recording_id string, total_s double, languages array<string>, num_speakers int, engines array<string>, stages array<string>, speech_ratio double, longest_silence_s double")
    return meta, speech, gaps


def test_text_transcript(recording):
    t = transcripts.text(*recording).first()["value"]
    assert "75% speech" in t and "[NON-SPEECH — 5.0s]" in t and "Duration:       00:00:20" in t
    body = t.split("=" * 72)[3]
    assert "[00:00:00] S0:\n[hi-raw] raw\n[hi] fixed\n[en] english\n" in body and "[00:00:12] S1:\n[en] same\n" in body
    assert body.index("S0:") < body.index("NON-SPEECH") < body.index("S1:") and t.endswith("END OF TRANSCRIPT\n" + "=" * 72)
    assert "raw" not in transcripts.text(*recording, include_raw=False).first()["value"].replace("raw text", "")


def test_subtitles_and_json(recording, tmp_path):
    meta, speech, gaps = recording
    s = transcripts.srt(speech).first()["value"]
    assert s == "1\n00:00:00,000 --> 00:00:05,000\n[S0] fixed\n\n2\n00:00:12,000 --> 00:00:20,500\n[S1] same\n"
    j = json.loads(transcripts.json(meta, speech, gaps).first()["value"])
    assert [x["speaker_id"] for x in j["segments"]] == ["S0", "S1"] and j["non_speech_segments"][0]["duration_s"] == 5.0
    assert transcripts.write(str(tmp_path / "o"), meta, speech, gaps) == ["txt", "json", "srt"] and transcripts.write(str(tmp_path / "p"), meta, speech, gaps, "odd") == []
    assert list((tmp_path / "o/format=srt").rglob("*.txt"))


def test_reports(spark, tmp_path):
    runs = spark.createDataFrame([("m", "f", "text", 1.236, None, None, None, 0), ("n", "f", None, 0.0, "boom", None, None, 1)], schemas.MODEL_RUNS + ", pos int")
    assert out.comparison_text(runs).first()["value"] == "f\n  [OK] m (1.2s): text\n  [FAIL] n (-): boom"
    out.runs_report(runs, str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).filter("model_id = 'm'").first()["elapsed_s"] == 1.24
    out.csv_report(runs.select("model_id", "pos"), str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["model_id", "pos"]
    out.reference_files(spark.createDataFrame([("f", "t")], "file string, transcript string"), str(tmp_path / "refs"))
    assert texts.references(spark, str(tmp_path / "refs/json")).count() == 1
    out.write_manifest(spark.createDataFrame([("p", 1.0)], "path string, duration_s double"), str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).first()["duration"] == 1.0


def test_region_fallback(spark):
    r = spark.createDataFrame([("a", 0, 1.0, 2.0)], schemas.REGIONS)
    t = spark.createDataFrame([("a", 5.0), ("b", 3.0)], "recording_id string, total_s double")
    assert [(x["recording_id"], x["end_s"]) for x in region_fallback(r, t).orderBy("recording_id").collect()] == [("a", 2.0), ("b", 3.0)]
