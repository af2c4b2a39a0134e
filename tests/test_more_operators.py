import math
import random
import tracemalloc

from pyspark.sql import functions as F

from parlance import schemas
from parlance.operators import inference, intervals, postprocess, quality, scoring, speakers, words
from parlance.plans import ratings


def _upper():
    return lambda rows: [next(iter(r.values())).upper() for r in rows]


def _lines():
    return lambda rows: ["BN: ক\nEN: a" if next(iter(r.values())) == "x" else "BN: খ" for r in rows]


def test_runs_are_translated_by_sentence(spark):
    rows = [("m", "f", "ab। cd।", 1.0, None, None, None, "ben"), ("m", "g", "yes", 1.0, None, None, None, "eng"), ("m", "h", None, 0.0, "boom", None, None, "ben"), ("m", "i", " ", 0.0, None, None, None, "ben")]
    df = spark.createDataFrame(rows, schemas.MODEL_RUNS + ", language string")
    assert {r["audio_file"]: r["translation"] for r in postprocess.translate_runs(df, _upper).collect()} == {"f": "AB CD", "g": "yes", "h": None, "i": None}


def test_passes(spark):
    df = spark.createDataFrame([("x",), ("y",)], "t string")
    assert [(r["corrected"], r["translated"]) for r in postprocess.two_pass(df, "t", _upper, _upper).collect()] == [("X", "X"), ("Y", "Y")]
    assert {r["t"]: (r["corrected"], r["translated"]) for r in postprocess.combined(df, "t", _lines).collect()} == {"x": ("ক", "a"), "y": ("খ", None)}


def test_legacy_translation(spark):
    df = spark.createDataFrame([("hi", "eng"), ("hola", "spa")], "raw_text string, language string")
    assert {r["language"]: r["english_translation"] for r in postprocess.translate_legacy(df, None).collect()} == {"eng": "hi", "spa": ""}
    assert {r["language"]: r["english_translation"] for r in postprocess.translate_legacy(df, _upper).collect()} == {"eng": "hi", "spa": "HOLA"}


def test_samples_of_chunks_and_frames(spark):
    b = spark.createDataFrame([("r", k, k * 4, 4, [float(4 * k + i) for i in range(4)], None) for k in range(3)], schemas.BLOCKS)
    c = spark.createDataFrame([("r", 0, 0.5, 2.25, 1.75)], schemas.CHUNKS)
    got = intervals.slice_samples(b, c).orderBy("block_no").collect()
    assert [x for r in got for x in r["samples"]] == [2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0]
    f = spark.createDataFrame([("r", t) for t in (0, 500_000, 1_000_000)], "recording_id string, t0 long")
    r = spark.createDataFrame([("r", 0, 0.4, 1.0)], schemas.REGIONS)
    assert [x["in_speech"] for x in intervals.frames_in_regions(f, r).orderBy("t0").collect()] == [False, True, False]


def test_tightening(spark):
    w = [("a", 1.2, 1.5, 1.0), ("b", 1.6, 2.4, 1.0)]
    df = spark.createDataFrame([(1.0, 2.0, "eng", w), (1.0, 2.0, "zho", w), (1.0, 1.05, "eng", w), (1.0, 2.0, "eng", [])], f"start_s double, end_s double, language string, words array<{schemas.WORD}>")
    assert [(r["start_s"], r["end_s"]) for r in words.tighten(df).collect()] == [(1.2, 2.4), (1.0, 2.0), (1.0, 1.05), (1.0, 2.0)]


def test_documents_and_improvements(spark):
    ref = spark.createDataFrame([("d", "ab cd")], "file string, transcript string")
    parts = spark.createDataFrame([("d", "s", 1, "cd"), ("d", "s", 0, "ab"), ("d", "t", 0, "ab xx")], "file string, system string, pos int, text string")
    s = scoring.document_scores(ref, parts).filter("metric = 'M1'")
    assert {r["system"]: r["cer"] for r in s.collect()} == {"s": 0.0, "t": 0.4}
    gain = {r["system"]: round(r["gain_pp"], 6) for r in scoring.improvements(scoring.means(s, ["system"]), "t").collect()}
    assert gain == {"s": 40.0, "t": 0.0}
    assert scoring.examples(s, F.col("cer") > 0, 5, "system").count() == 1
    assert scoring.language_histogram(spark.createDataFrame([("a",), ("b",), ("a",)], "language string")).first()["n"] == 2


def test_speaker_rules(spark):
    p = spark.createDataFrame([("r", "a", 1.0), ("r", "b", 3.0), ("q", "a", 0.0)], "recording_id string, speaker_id string, power double")
    assert {(r["recording_id"], r["speaker_id"]): round(r["crosstalk"], 4) for r in speakers.others_power(p).collect()} == {("r", "a"): 3.0, ("r", "b"): 0.3333, ("q", "a"): 0.0}
    m = spark.createDataFrame([("r", "a", "OTHER", 0.4), ("r", "b", "ENUMERATOR", 3.0), ("r", "c", "RESPONDENT", 9.0)], "recording_id string, speaker_id string, role string, talk_time_s double")
    assert [r["speaker_id"] for r in speakers.by_role(speakers.long_enough(m)).collect()] == ["b", "c"]


def test_usable_rows(spark):
    df = spark.createDataFrame([("a", "BAD"), ("b", "GOOD"), ("c", "FAIR")], "file_path string, quality string")
    assert quality.usable(df).count() == 2 and quality.usable(df, force=True).count() == 3 and quality.usable(df, limit=1).first()["file_path"] == "b"


def test_cosine_search_against_all_pairs(spark):
    rng = random.Random(5)
    rows = [(i, i % 3 if i % 10 else None, [rng.choice([-1.0, 0.0, 1.0, 2.0]) for _ in range(4)]) for i in range(120)] + [(200, 1, None), (201, 1, [1.0, None, 1.0, 1.0]), (202, 1, [0.0] * 4), (203, 2, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "item_id long, label int, vector array<float>")
    got = scoring.top_k_cosine(df.filter("item_id % 4 = 0").withColumnRenamed("item_id", "query_id"), df, "label", 5, slice_rows=7)
    found = sorted((r["query_id"], r["rank"], r["item_id"]) for r in got.collect())
    dot = lambda a, b: sum(u * v for u, v in zip(a, b, strict=True))
    far = lambda a, b: round(1 - dot(a, b) / math.sqrt(dot(a, a) * dot(b, b)), 5) + 0.0 if dot(a, a) * dot(b, b) else math.inf
    good = [r for r in rows if r[1] is not None and r[2] is not None and None not in r[2] and len(r[2]) == 4]
    want = [(q, k + 1, i) for q, label, v in good if q % 4 == 0 for k, (_, i) in enumerate(sorted((far(v, w), i) for i, other, w in good if other == label and i != q)[:5])]
    assert found == sorted(want)


def test_means_round_as_the_sql_does(spark):
    """Scaled and then rounded: a sum of doubles just below a half goes up with it, a half of the shortest text may go down."""
    values = [0.11624999999999999, 1.0005, 19.4815, -38.53125]
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (3, 4):
        want = [math.copysign(math.floor(abs(v * 10.0**digits) + 0.5), v) / 10.0**digits for v in values]
        assert [r["x"] for r in rows.select(ratings.rounded("x", digits)).collect()] == want


def _traced():
    tracemalloc.start()
    return lambda rows: [str(tracemalloc.get_traced_memory()[1]) for _ in rows]


def test_large_batches_become_objects_a_few_rows_at_a_time(spark):
    """One batch of 10,000 rows with 25 MB of text, which are held once as they come (29 MB), not again as objects (54 MB)."""
    df = spark.range(10000).coalesce(1).selectExpr("id", "repeat(lpad(cast(id as string), 5, '0'), 500) AS t")
    got = inference.infer_text(df, ["t"], _traced, "peak").selectExpr("max(cast(peak as long)) AS peak", "count(peak_error) AS failed", "count(distinct id) AS n").first()
    assert got["n"] == 10000 and got["failed"] == 0 and got["peak"] < 40_000_000


def test_columns_beside_the_model_stay_as_they_are(spark):
    rows = [(2**53 + 1, "a"), (None, "b"), (3, None)]
    got = inference.infer_text(spark.createDataFrame(rows, "k long, t string"), ["t"], _both_cases, "u").collect()
    assert [(r["k"], r["t"], r["u"]) for r in got] == [(2**53 + 1, "a", "aA"), (None, "b", "bB"), (3, None, None)]


def _both_cases():
    return lambda rows: [r["t"] and r["t"] + r["t"].upper() for r in rows]
