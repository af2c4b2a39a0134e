import random

import pytest
from pyspark.sql import functions as F

from parlance import schemas
from parlance.operators import dataset, inference, interviews, intervals, postprocess, quality, scoring, speakers, words


def seg(spark, rows):
    full = [("r", i, i, a, b, t, lang, 1.0, None, sp) for i, (a, b, t, lang, sp) in enumerate(rows)]
    return spark.createDataFrame(full, schemas.SEGMENTS.replace("text string", "raw_text string") + ", speaker_id string")


def test_overlap(spark):
    for a, want in [((0, 10, 0, 10), 10), ((0, 10, 5, 15), 5), ((0, 5, 5, 9), 0)]:
        assert spark.range(1).select(intervals.overlap(*map(F.lit, a))).first()[0] == want


def model_assign(segs, turns):
    out = {}
    for pos, (a, b) in enumerate(segs):
        best, who = 0, "SPEAKER_00"
        for x, y, s in turns:
            o = max(0, min(b, y) - max(a, x))
            if o > best:
                best, who = o, s
        out[pos] = who
    return out


@pytest.mark.parametrize("bin_s", [None, 3.0])
def test_assignment_against_a_plain_model(spark, bin_s):
    random.seed(1)
    segs = [(a := random.randint(0, 40), a + random.randint(0, 6)) for _ in range(60)]
    turns = [(a := random.randint(0, 40), a + random.randint(0, 6), f"S{random.randint(0, 3)}") for _ in range(40)]
    s = seg(spark, [(float(a), float(b), "t", "eng", None) for a, b in segs]).drop("speaker_id")
    t = spark.createDataFrame([("r", i, sp, float(a), float(b)) for i, (a, b, sp) in enumerate(turns)], schemas.TURNS)
    got = {r["pos"]: r["speaker_id"] for r in intervals.assign_speakers(s, t, bin_s).collect()}
    assert got == model_assign(segs, turns)


@pytest.mark.parametrize("bin_s", [None, 3.0])
def test_moments_inside_turns(spark, bin_s):
    """With ``empty``, a moment has the first turn around it, a longer overlap comes before a moment, and edges are outside."""
    s = seg(spark, [(5.0, 5.0, "t", "eng", None), (2.0, 2.0, "t", "eng", None), (4.0, 9.0, "t", "eng", None), (8.0, 12.0, "t", "eng", None)]).drop("speaker_id")
    t = spark.createDataFrame([("r", 0, "S0", 2.0, 6.0), ("r", 1, "S1", 1.0, 7.0), ("r", 2, "S2", 11.0, 11.0)], schemas.TURNS)
    found = lambda **k: {r["pos"]: r["speaker_id"] for r in intervals.assign_speakers(s, t, bin_s, **k).collect()}
    assert found(empty=True) == {0: "S0", 1: "S1", 2: "S1", 3: "S2"}
    assert found() == {0: "SPEAKER_00", 1: "SPEAKER_00", 2: "S1", 3: "SPEAKER_00"}


def test_no_turns(spark):
    s = seg(spark, [(0.0, 1.0, "t", "eng", None)]).drop("speaker_id")
    assert intervals.assign_speakers(s, spark.createDataFrame([], schemas.TURNS)).first()["speaker_id"] == "SPEAKER_00"


def test_merge(spark):
    s = seg(spark, [(0.0, 2.0, "Hello", "eng", "A"), (2.1, 4.0, "world", "eng", "A"), (4.5, 5.0, "!", "eng", "A"), (5.0, 6.0, "no", "eng", "B"), (6.0, 7.0, "oui", "fra", "B"), (7.6, 8.0, "far", "fra", "B")])
    m = intervals.merge_consecutive(s).orderBy("pos").collect()
    assert [(r["raw_text"], r["start_s"], r["end_s"], r["n_merged"]) for r in m] == [("Hello world !", 0.0, 5.0, 3), ("no", 5.0, 6.0, 1), ("oui", 6.0, 7.0, 1), ("far", 7.6, 8.0, 1)]


def regions(spark, rows):
    return spark.createDataFrame([("r", i, float(a), float(b)) for i, (a, b) in enumerate(rows)], schemas.REGIONS)


@pytest.mark.parametrize(("rows", "total", "want"), [([(1, 3), (5, 8)], 10.0, [(0, 1), (3, 5), (8, 10)]), ([(0, 3), (3.1, 6)], 6.0, []), ([], 10.0, [(0, 10)])])
def test_complement(spark, rows, total, want):
    t = spark.createDataFrame([("r", total)], "recording_id string, total_s double")
    got = intervals.non_speech_regions(regions(spark, rows), t).orderBy("start_s").collect()
    assert [(r["start_s"], r["end_s"]) for r in got] == want


def model_groups(rows, most, gap):
    out = []
    for a, b in rows:
        if out and b - out[-1][0][0] <= most and a - out[-1][-1][1] < gap:
            out[-1].append((a, b))
        else:
            out.append([(a, b)])
    return [(g[0][0], g[-1][1]) for g in out]


def test_grouping_against_a_plain_model(spark):
    random.seed(2)
    t, rows = 0, []
    for _ in range(80):
        t += random.randint(0, 5)
        rows.append((t, t := t + random.randint(1, 9)))
    got = intervals.vad_groups(regions(spark, rows)).orderBy("g_no").collect()
    assert [(r["g0_s"], r["g1_s"]) for r in got] == model_groups(rows, 30, 3)


def test_split_at_the_largest_gap(spark):
    g = spark.createDataFrame([("r", 0, [(0.0, 10.0), (11.0, 20.0), (23.0, 31.0), (32.0, 40.0)])], "recording_id string, g_no int, regions array<struct<start_s:double,end_s:double>>")
    assert [(r["start_s"], r["end_s"]) for r in intervals.split_long(g, 30.0).orderBy("part").collect()] == [(0.0, 20.0), (23.0, 40.0)]


def test_padding_and_windows(spark):
    t = spark.createDataFrame([("r", 61.0), ("z", 0.0)], "recording_id string, total_s double")
    c = intervals.vad_chunks(regions(spark, [(0.1, 5.0), (50.0, 60.9)]), t).orderBy("chunk_id").collect()
    assert [(round(r["start_s"], 3), round(r["end_s"], 3)) for r in c] == [(0.0, 5.2), (49.8, 61.0)]
    w = intervals.fixed_windows(t).orderBy("chunk_id").collect()
    assert [(r["start_s"], r["end_s"]) for r in w] == [(0.0, 30.0), (28.0, 58.0), (56.0, 61.0)]
    with pytest.raises(ValueError):
        intervals.fixed_windows(t, 2.0, 2.0)


def test_contained_and_limits(spark):
    g = spark.createDataFrame([("r", 0, 0.0, 4.0)], "recording_id string, g_no int, g0_s double, g1_s double")
    assert intervals.contained(regions(spark, [(1, 3), (3, 5)]), g).count() == 1
    c = spark.createDataFrame([("r", 0, 0.0, 30.4, 30.4), ("r", 1, 0.0, 30.0, 30.0)], schemas.CHUNKS)
    assert [x.count() for x in intervals.chunks_within(c, 30.0)] == [1, 1]


def turns(spark, rows):
    return spark.createDataFrame([("r", i, s, float(a), float(b)) for i, (s, a, b) in enumerate(rows)], schemas.TURNS)


def test_roles(spark):
    s = speakers.turn_stats(turns(spark, [("q", 0, 1), ("a", 1, 9), ("q", 9, 10), ("a", 10, 15), ("q", 15, 16), ("x", 16, 16.6)]))
    assert {r["speaker_id"]: r["role"] for r in speakers.label_roles(s).collect()} == {"q": "ENUMERATOR", "a": "RESPONDENT", "x": "OTHER"}
    lone = speakers.label_roles(speakers.turn_stats(turns(spark, [("q", 0, 1)])))
    assert lone.first()["role"] == "UNKNOWN"


def test_renumber_and_union(spark):
    t = turns(spark, [("z", 0, 1), ("b", 1, 2), ("c", 2, 2.4)])
    assert [(r["turn_no"], r["speaker_id"]) for r in speakers.renumber(t).orderBy("turn_no").collect()] == [(0, "SPEAKER_01"), (1, "SPEAKER_00")]
    assert speakers.union_talk_time(turns(spark, [("a", 0, 4), ("a", 1, 2), ("a", 3, 6), ("a", 8, 9)])).first()["talk_time_s"] == 7.0


@pytest.mark.parametrize(("m", "want"), [
    ((30, 60, 0.0, -20, 0.99), ("BROKEN", 0)), ((30, 60, 1.01, -20, 5), ("CLIPPED", 10)), ((30, 60, 1.0, -20, 5), ("CLIPPED", 60)), ((30, 60, 0.1, -20, 5), ("GOOD", 85)),
    ((30, 60, 0.0, -55.1, 5), ("MUTED", 0)), ((30, 60, 0.0, -55, 5), ("BAD", 15)), ((5.9, 60, 0.0, -20, 5), ("BAD", 10)), ((6, 60, 0.0, -20, 5), ("POOR", 25)), ((10, 60, 0.0, -20, 5), ("POOR", 40)),
    ((13, 9.9, 0.0, -20, 5), ("EMPTY", 30)), ((13, 10, 0.0, -20, 5), ("LOW SPEECH", 55)), ((25, 50, 0.049, -20, 5), ("EXCELLENT", 95)), ((20, 35, 0.05, -20, 5), ("GOOD", 85)), ((15, 25, 0.0, -20, 5), ("FAIR", 65)), ((13, 25, 0.0, -20, 5), ("FAIR", 50)),
])
def test_quality_rules(spark, m, want):
    df = spark.createDataFrame([tuple(map(float, m))], "snr double, sp double, clip double, rms double, dur double")
    c = df.select(quality.classify(*map(F.col, ("snr", "sp", "clip", "rms", "dur"))).alias("c")).first()["c"]
    assert (c["flag"], c["score"]) == want


def test_recording_quality(spark):
    t = spark.createDataFrame([("r", 20.0), ("e", 0.0)], "recording_id string, total_s double")
    g = spark.createDataFrame([("r", 7.0, 12.0)], "recording_id string, start_s double, end_s double")
    q = quality.recording_quality(g, t).collect()
    assert len(q) == 1 and (q[0]["speech_ratio"], q[0]["num_speech_regions"], q[0]["longest_silence_s"]) == (0.75, 2, 5.0)


def test_scores_of_equal_mics(spark):
    cols = list(quality.WEIGHTS)
    df = spark.createDataFrame([("a", *[1.0] * 5), ("b", *[1.0] * 5)], "mic_name string, " + ", ".join(f"{c} double" for c in cols))
    assert {r["score"] for r in quality.composite_score(df).collect()} == {1.0}


def test_first_per_group_is_exact(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id"))
    got = dataset.first_per_group(df, ["g"], ["id"], 5).groupBy("g").agg(F.max("id")).collect()
    assert {r[0]: r[1] for r in got} == {0: 12, 1: 13, 2: 14}


def test_split_sizes_and_singletons(spark):
    df = spark.createDataFrame([("a", i) for i in range(30)] + [("b", 100)], "src string, id long")
    s = dataset.stratified_split(df, 4, ["src"], "id").filter("split = 'val'").groupBy("src").count().collect()
    assert {r[0]: r[1] for r in s} == {"a": 4, "b": 1}
    assert dataset.dev_split(df, "id").filter("split = 'dev'").count() == 3


def test_resume_caps_and_projection(spark):
    df = spark.createDataFrame([("a", f"{i}") for i in range(10)], "src string, id string")
    done = df.filter("id < '4'")
    assert dataset.not_done(df, done, ["id"]).count() == 6
    assert dataset.capped(df, 6, ["src"], "id", done).count() == 2
    p = spark.createDataFrame([("s", "t", "1", "i", "n", "b", "e")], schemas.PAIRS)
    assert dataset.project(p, "fst").first()["ipa"] is None and dataset.project(p, "ipa").first()["noisy"] is None
    with pytest.raises(ValueError):
        dataset.project(p, "x")


def test_filters(spark):
    df = spark.createDataFrame([("ক", 1.0, 0.5, None), ("ক", 20.1, 0.5, 5.0), ("x", 5.0, 0.5, 5.0), (" ", 5.0, None, 5.0)], "t string, d double, w double, wps double")
    assert [r[0] for r in df.select(dataset.sample_filter(F.col("t"), F.col("d"))).collect()] == [True, False, False, False]
    assert [r[0] for r in df.select(dataset.quality_filter(F.col("w"), F.col("wps"))).collect()] == [True, True, True, False]


def test_scores_of_files(spark):
    ref = spark.createDataFrame([("1", "এক, দুই"), ("2", "x")], "file string, transcript string")
    hyp = spark.createDataFrame([("1", "s", "এক দুই")], "file string, system string, text string")
    s = scoring.score_pairs(ref, hyp).collect()
    assert len(s) == 2 and all(r["cer"] == 0 for r in s)


def test_comparison_and_matrix(spark):
    runs = spark.createDataFrame([("m1", "f", "t1", 1.234, None, None, 0.0), ("m2", "f", None, 0.0, "boom", None, 0.0)], schemas.MODEL_RUNS)
    row = scoring.comparison(runs, ["m1", "m2"]).first()
    assert (row["m1_time"], row["m2_status"]) == (1.23, "FAIL")
    models = spark.createDataFrame([("b", 0), ("a", 1), ("b", 2)], "model_id string, pos int")
    audio = spark.createDataFrame([("f", 0), ("g", 1), ("f", 2)], "audio_file string, pos int")
    m = scoring.model_matrix(models, audio, "a").orderBy("a_pos", "m_pos").collect()
    assert [(r["model_id"], r["audio_file"]) for r in m] == [("a", "f"), ("b", "f"), ("a", "g"), ("b", "g")]


def test_top_k_and_ranks(spark):
    q = spark.createDataFrame([(0, "k", 1.0)], "query_id int, b string, x double")
    i = spark.createDataFrame([(n, "k", float(n)) for n in range(1, 9)] + [(50, "j", 1.0)], "item_id int, b string, y double")
    assert [r["item_id"] for r in scoring.top_k(q, i, ["b"], F.abs(F.col("x") - F.col("y")), 3).orderBy("rank").collect()] == [1, 2, 3]
    assert spark.range(1).select(scoring.gold_rank(F.lit("z"), F.array(F.lit("a")))).first()[0] == -1


def _model():
    def run(rows):
        if any(r["raw_text"] == "bad" for r in rows):
            raise RuntimeError("no")
        return [r["raw_text"].upper() for r in rows]

    return run


def _numbered():
    return lambda rows: ["\n".join(f"{k}. line {k}" for k in range(1, 12) if k != 2) for _ in rows]


def _explode():
    def run(row):
        if row["text"] == "bad":
            raise ValueError("no")
        return [{"part": c} for c in row["text"]]

    return run


def test_inference_isolates_failures(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "bad"), (3, "")], "id int, text string")
    got = inference.infer_rows(df, _explode, ["id"], ["text"], "part string").collect()
    assert sorted((r["id"], r["part"], r["error"]) for r in got if r["error"] is None) == [(1, "a", None), (1, "b", None)]
    assert [r["error"] for r in got if r["id"] == 2] == ["ValueError: no"]


def test_postprocess(spark):
    s = seg(spark, [(0.0, 1.0, "hola", "spa", "A"), (1.0, 2.0, "bad", "spa", "A"), (2.0, 3.0, "hello", "eng", "B"), (3.0, 4.0, "kya", "mya", "B")])
    c = postprocess.correct(s, _model)
    assert [r["corrected_text"] for r in c.orderBy("pos").collect()] == ["HOLA", "bad", "HELLO", "KYA"]
    t = postprocess.translate(s.withColumn("corrected_text", F.col("raw_text")).drop("raw_text").withColumn("raw_text", F.col("corrected_text")), _model, source="raw_text")
    assert [r["english_translation"] for r in t.orderBy("pos").collect()] == ["HOLA", "bad", "hello", "kya"]
    r = postprocess.refine(t, _numbered).orderBy("pos").collect()
    assert [x["refined_translation"] for x in r] == ["line 1", "bad", "line 1", "line 1"]
    n = postprocess.process(s).orderBy("pos").collect()
    assert [x["refined_translation"] for x in n] == ["hola", "bad", "hello", "kya"]


def test_words(spark):
    v = F.create_map(*[F.lit(x) for kv in {1: "a", 2: "b", 3: ""}.items() for x in kv])
    assert spark.sql("SELECT array(0,1,1,0,1,2,3,2) AS i").select(words.ctc_collapse(F.col("i"), v)).first()[0] == ["a", "a", "b", "b"]
    c = spark.createDataFrame([("s", i, ch, i * 2, 1.2 if i == 0 else 0.5, 10.0) for i, ch in enumerate("hi|yo")], "segment_key string, pos int, char string, frame int, score double, offset_s double")
    w = words.words_from_characters(c, 50.0).orderBy("word_no").collect()
    assert [(r["word"], round(r["start_s"], 3), round(r["end_s"], 3), r["confidence"]) for r in w] == [("hi", 10.0, 10.06, 0.75), ("yo", 10.12, 10.18, 0.5)]


def test_interview_order(spark):
    f = spark.sql("""SELECT * FROM VALUES ('k','b',TIMESTAMP_NTZ '2024-01-01 00:00:05',false),('k','a',TIMESTAMP_NTZ '2024-01-01 00:00:00',false),('k','c',TIMESTAMP_NTZ '2024-01-01 00:00:01',true) AS t(interview_key,path,recording_start,failed)""")
    s = spark.createDataFrame([("a", 0, "SPEAKER_00", 0.0, 1.0), ("a", 1, "SPEAKER_01", 6.0, 7.0), ("b", 0, "SPEAKER_00", 0.0, 1.0)], "path string, pos int, speaker_id string, start_s double, end_s double")
    m = interviews.merge_order(interviews.place(s, interviews.file_index(f))).orderBy("segment_id").collect()
    assert [(r["path"], r["pos"], r["speaker_id"]) for r in m] == [("a", 0, "SPEAKER_F1_00"), ("b", 0, "SPEAKER_F2_00"), ("a", 1, "SPEAKER_F1_01")]


def test_folder_sums_run_in_the_order_of_files(spark):
    """Means on a half of the last digit go by the last bits of sums, so these are taken one by one in order, however rows are dealt."""
    random.seed(5)
    cols = ("duration_s", "snr_db", "speech_ratio", "clipping_ratio", "crosstalk_ratio", "rms_dbfs", "spectral_rolloff_hz", "effective_bandwidth_hz")
    rows = [(f"f{k % 3}", str(k), "m", 1, *[random.randint(0, 400) / 10 for _ in cols]) for k in range(700)]
    random.shuffle(rows)
    files = spark.createDataFrame(rows, "folder_key string, file_path string, mic_name string, plosive_spike_count int, " + ", ".join(f"{c} double" for c in cols))
    want = {}
    for folder, _, _, _, duration, snr, *_ in sorted(rows, key=lambda r: int(r[1])):
        n, total, sum_ = want.get(folder, (0, 0.0, 0.0))
        want[folder] = n + 1, total + duration, sum_ + snr
    for parts in (1, 3, 16):
        got = quality.folder_summary(files.repartition(parts, "file_path"), F.col("file_path").cast("long")).collect()
        assert {r["folder_key"]: (r["n_files"], r["total_s"], r["snr_db"], r["plosives"]) for r in got} == {f: (n, t, s / n, n) for f, (n, t, s) in want.items()}
