import time
import datetime
import random

import pytest
from pyspark.sql import functions as F

from parlance.functions import distances, languages, scores, text, times


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v string").select(column).first()[0]


@pytest.mark.parametrize(("s", "want"), [("  ab,  c. ", "ab c"), ("ক।  খ", "ক খ"), ("é!", "é"), ("", "")])
def test_base_norm_deletes(spark, s, want):
    assert one(spark, s, text.base_norm(F.col("v"))) == want


def test_norms_and_numbers(spark):
    assert one(spark, "(a)-b; 'c'", text.base_norm(F.col("v"), "space")) == "a b c"
    assert one(spark, "একশ টাকা ১২৩  x", text.num_norm(F.col("v"))) == "100 টাকা 123 x"
    assert one(spark, "প্র: কেমন? উ: ভালো", text.strip_speakers(F.col("v"))) == " কেমন?  ভালো"
    assert one(spark, "hello\n ক খ \nx", text.first_line_of_script(F.col("v"))) == "ক খ"
    assert one(spark, "hello", text.first_line_of_script(F.col("v"))) == "hello"


def test_script(spark):
    assert one(spark, "কখab", text.script_ratio(F.col("v"))) == 0.5
    assert one(spark, "কখab", text.is_script(F.col("v"))) is True
    assert one(spark, "123", text.is_script(F.col("v"))) is False
    assert one(spark, None, text.is_script(F.col("v"))) is False


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def test_distances(spark, monkeypatch):
    random.seed(5)
    rows = [(" ".join(random.choices(["a", "bb", "é", "🙂", "d"], k=random.randint(0, 9))), " ".join(random.choices(["a", "bb", "é", "x"], k=random.randint(0, 9)))) for _ in range(60)]
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select("a", "b", scores.char_distance(F.col("a"), F.col("b")), scores.word_distance(F.col("a"), F.col("b")), distances.list_edits(text.tokens(F.col("a")), text.tokens(F.col("b")))).collect()
    for a, b, c, w, long in got:
        assert c == distance(a, b)
        assert w == long == distance(a.split(), b.split())


@pytest.mark.parametrize("band", [1, 2, 5, 64])
def test_banded_distances(monkeypatch, band):
    monkeypatch.setattr(distances, "FIRST_BAND", band)
    rng = random.Random(band)
    for _ in range(600):
        a, b = ([rng.randint(0, 3) for _ in range(rng.randint(0, 40))] for _ in range(2))
        b = a[:] if rng.random() < 0.6 else b
        for _ in range(rng.randint(0, 8)):
            if b and rng.random() < 0.5:
                del b[rng.randrange(len(b))]
            else:
                b.insert(rng.randint(0, len(b)), rng.randint(0, 3))
        assert distances.edits(a, b) == distance(a, b)


def test_long_distances(spark):
    rng = random.Random(1)
    a = [rng.choice("abcdefg é🙂") for _ in range(60_000)]
    b = a[:]
    for k in range(0, 60_000, 600):
        b[k] = "ß"
    texts = spark.createDataFrame([("".join(a), "".join(b)), ("".join(a[:900]), "".join(a[:900])[::-1]), (None, "x"), ("x", None)], "a string, b string")
    far = distance(a[:900], a[:900][::-1])
    assert [r[0] for r in texts.select(scores.char_distance(F.col("a"), F.col("b"))).collect()] == [100, far, None, None]
    words = spark.createDataFrame([(" ".join(map(str, range(30_000))), " ".join(map(str, range(1, 30_001)))), (None, "x")], "a string, b string")
    assert [r[0] for r in words.select(scores.word_distance(F.col("a"), F.col("b"))).collect()] == [2, None]


def test_rates_of_empty_references(spark):
    df = spark.createDataFrame([("", ""), ("x", "")], "p string, r string")
    assert [r[0] for r in df.select(scores.cer(F.col("p"), F.col("r"))).collect()] == [0.0, 1.0]
    assert [r[0] for r in df.select(scores.wer(F.col("p"), F.col("r"), "unit")).collect()] == [0.0, 1.0]


@pytest.mark.parametrize(("s", "hms", "ms", "srt"), [(0.0, "00:00:00", "00:00:00.000", "00:00:00,000"), (3661.5, "01:01:01", "01:01:01.500", "01:01:01,500"), (59.9996, "00:00:59", "00:00:60.000", "00:00:59,999")])
def test_timestamps(spark, s, hms, ms, srt):
    df = spark.createDataFrame([(s,)], "s double")
    assert tuple(df.select(times.format_timestamp(F.col("s")), times.format_timestamp(F.col("s"), "HH:MM:SS.mmm"), times.format_srt(F.col("s"))).first()) == (hms, ms, srt)


def test_absolute_time_is_cut_to_milliseconds(spark):
    df = spark.createDataFrame([(datetime.datetime(2023, 10, 14, 14, 14, 50, 489000), 1.2349)], "t timestamp_ntz, s double")
    assert df.select(times.iso_ms(times.absolute(F.col("t"), F.col("s")))).first()[0] == "2023-10-14T14:14:51.723"


def test_registry(spark):
    r = languages.registry(spark)
    assert r.count() == 33 and r.filter("tier = 'high'").count() == 18
    df = spark.createDataFrame([("eng",), ("hin",), ("xyz",)], "language string")
    got = {x["language"]: x for x in languages.with_language(df, r).withColumn("e", languages.engine_for(F.col("tier"))).collect()}
    assert got["eng"]["e"] == "whisper" and got["eng"]["is_english"] and got["hin"]["e"] == "omnilingual"
    assert got["xyz"]["language_name"] == "Unknown (xyz)" and got["xyz"]["nllb_code"] == "xyz_Latn" and got["xyz"]["bcp47"] == "xyz"


def test_code_maps(spark):
    df = spark.createDataFrame([("hin", "hi")], "a string, b string")
    assert tuple(df.select(languages.tag(F.col("a")), languages.iso3(F.col("b")), languages.whisper_code(F.col("a")), languages.with_default_script(F.col("a")), languages.without_script(F.lit("hin_Deva"))).first()) == ("hi", "hin", "hin", "hin_Latn", "hin")


def test_language_mix_and_confidence(spark):
    df = spark.sql("SELECT array(named_struct('language','ben','probability',0.5D), named_struct('language','eng','probability',0.3D)) AS p")
    assert tuple(df.select(languages.language_mix(F.col("p")).alias("m")).first()["m"]) == ("ben", 0.5, True)
    none = spark.sql("SELECT cast(array() AS array<struct<language:string,probability:double>>) AS p")
    assert tuple(none.select(languages.language_mix(F.col("p")).alias("m")).first()["m"]) == ("eng", 0.0, False)
    c = spark.createDataFrame([(0.0,), (None,), (-1.0,), (2.0,)], "v double").select(languages.confidence(F.col("v"))).collect()
    assert [round(x[0], 3) for x in c] == [0.0, 0.0, 0.368, 1.0]


def test_replies(spark):
    assert one(spark, "1. one\n\n2) two\n3 three\n2: again\n4.\nnoise", text.parse_numbered(F.col("v"))) == {1: "one", 2: "again", 3: "three"}
    for reply, want in [("3", 2), ("the 2nd is 7", 6), ("none", None), ("99", None)]:
        assert one(spark, reply, text.parse_choice(F.col("v"), F.lit(30))) == want
    assert one(spark, "short", text.guarded(F.lit("x" * 41), F.col("v"))) == "short"
    assert one(spark, "short", text.guarded(F.lit(" ok "), F.col("v"))) == "ok"
    assert one(spark, "  ", text.guarded(F.lit("made up"), F.col("v"))) == "  "


def test_prompts(spark):
    df = spark.sql("SELECT array(named_struct('speaker_id','S0','raw_text','a\nb','translation','t')) AS i, array(named_struct('dist',1.234D,'word','w')) AS c")
    assert df.select(text.numbered_block(F.col("i"), True)).first()[0] == "1. [S0] Source: a b\n   Translation: t"
    assert df.select(text.numbered_block(F.col("i"), False)).first()[0] == "1. [S0] a b"
    assert df.select(text.candidate_block(F.col("c"))).first()[0] == "  1. w  (DTW 1.23)"
    assert one(spark, "z", text.fill("say {x}!", x=F.col("v"))) == "say z!"


def test_sentences_and_alignment_text(spark):
    assert one(spark, "এক। দুই ।  ।", text.sentences(F.col("v"))) == ["এক", "দুই"]
    assert one(spark, " Hello,  World-9 ", text.alignment_text(F.col("v"), "abcdefghijklmnopqrstuvwxyz-")) == "hello|world-"


def test_long_replies_are_parsed_in_one_pass(spark):
    """Lines in the thousands, whose numbers come again; comparing every line with all after it takes minutes."""
    rows = spark.range(4).select(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(19_999)), lambda i: F.concat((i % 7 + 1).cast("string"), F.lit(". x"), i.cast("string"))), "\n").alias("v"))
    began = time.monotonic()
    got = [r["m"] for r in rows.select(text.parse_numbered(F.col("v")).alias("m")).collect()]
    assert got == [{i % 7 + 1: f"x{i}" for i in range(19_993, 20_000)}] * 4 and time.monotonic() - began < 60
