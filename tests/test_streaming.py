import random
import time

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from parlance import schemas
from parlance.operators import dataset, intervals
from parlance.plans import streams
from parlance.streaming import live

TURN = "recording_id string, pos int, speaker_id string, language string, start_s double, end_s double, raw_text string"


def split(spark, df, path, key, n):
    for k in range(n):
        df.filter(F.col(key) % n == k).coalesce(1).write.mode("append").parquet(path)


def drain(spark, df, name, mode="append", check=None):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True)
    q = (q.option("checkpointLocation", check) if check else q).start()
    q.awaitTermination(120)
    return spark.table(name)


def test_only_new_files(spark, tmp_path):
    src, dst, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    spark.range(10).write.parquet(src)
    step = lambda b: b.withColumn("twice", F.col("id") * 2)
    live.process_new(live.arriving(spark, src, "id long", files_per_trigger=1), step, dst, check).awaitTermination(120)
    spark.range(10, 15).write.mode("append").parquet(src)
    live.process_new(live.arriving(spark, src, "id long"), step, dst, check).awaitTermination(120)
    assert sorted(r["twice"] for r in spark.read.parquet(dst).collect()) == [2 * i for i in range(15)]


def test_counts_equal_the_batch(spark, tmp_path):
    rows = spark.range(200).select(F.timestamp_seconds(F.col("id") * 60).alias("ts"), (F.col("id") % 40).cast("double").alias("snr"), F.lit(50.0).alias("speech_pct"), F.lit(0.0).alias("clip_pct"), F.lit(-20.0).alias("rms"), "id")
    split(spark, rows, str(tmp_path / "in"), "id", 3)
    stream = live.arriving(spark, str(tmp_path / "in"), "ts timestamp, snr double, speech_pct double, clip_pct double, rms double, id long", files_per_trigger=1)
    got = drain(spark, live.quality_counts(stream, delay="10 days"), "counts", "complete")
    want = live.quality_counts(rows)
    assert sorted(map(tuple, got.select("window.start", "quality", "n").collect())) == sorted(map(tuple, want.select("window.start", "quality", "n").collect()))


def test_no_repeats(spark, tmp_path):
    rows = spark.range(20).select((F.col("id") % 5).alias("k"), F.timestamp_seconds("id").alias("ts"), "id")
    split(spark, rows, str(tmp_path / "in"), "id", 2)
    stream = live.arriving(spark, str(tmp_path / "in"), "k long, ts timestamp, id long", files_per_trigger=1)
    assert drain(spark, live.without_repeats(stream, ["k"], "ts"), "once").count() == 5


def test_exact_merge_equals_the_batch(spark, tmp_path):
    n = 40
    rows = [("r", i, f"S{(i // 3) % 2}", "eng", i * 1.0, i + (0.6 if i % 4 else 0.2), f"t{i}") for i in range(n)]
    df = spark.createDataFrame(rows, TURN)
    for a in range(0, n, 10):
        df.filter((F.col("pos") >= a) & (F.col("pos") < a + 10)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    end = spark.createDataFrame([("r", n, None, None, None, None, None)], TURN)
    end.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = live.arriving(spark, str(tmp_path / "in"), TURN)
    got = drain(spark, live.merge_turns(stream), "merged", "append", str(tmp_path / "c"))
    batch = intervals.merge_consecutive(df.selectExpr("*", "pos AS segment_id", "1.0D AS confidence", "cast(null AS array<struct<word:string,start_s:double,end_s:double,confidence:double>>) AS words"))
    assert sorted((r["pos"], r["raw_text"], r["n_merged"]) for r in got.collect()) == sorted((r["pos"], r["raw_text"], r["n_merged"]) for r in batch.collect())


def test_idle_recordings_are_closed(spark, tmp_path):
    """Without a closing row, a recording's last row comes out once no row has arrived for a while."""
    rows = [("r", 0, "A", "eng", 0.0, 1.0, "x"), ("r", 1, "A", "eng", 1.1, 2.0, "y"), ("r", 2, "B", "eng", 2.1, 3.0, "z")]
    spark.createDataFrame(rows, TURN).coalesce(1).write.parquet(str(tmp_path / "in"))
    merged = live.merge_turns(live.arriving(spark, str(tmp_path / "in"), TURN), idle_s=1.0)
    query = merged.writeStream.format("memory").queryName("idle").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="1 second").start()
    try:
        for _ in range(60):
            if spark.table("idle").count() == 2:
                break
            time.sleep(1)
    finally:
        query.stop()
    assert sorted((r["speaker_id"], r["raw_text"]) for r in spark.table("idle").collect()) == [("A", "x y"), ("B", "z")]


def test_sessions(spark):
    rows = spark.createDataFrame([("r", "A", "eng", 0.0, 1.0), ("r", "A", "eng", 0.3, 1.2), ("r", "A", "eng", 5.0, 6.0)], "recording_id string, speaker_id string, language string, start_s double, end_s double").withColumn("ts", F.timestamp_seconds("start_s"))
    assert sorted(r["n"] for r in live.session_turns(rows).collect()) == [1, 2]
    assert schemas.struct(schemas.CHUNKS).names[0] == "recording_id"


def test_late_rows_merge_as_the_batch(spark, tmp_path):
    """Rows up to five minutes out of order over triggers, cut in three ways; one far row lets the watermark pass all."""
    rng = random.Random(6)
    rows = []
    for rec in ("a", "b", "c"):
        t = 0.0
        for k in range(60):
            t = round(t + rng.choice([0.1, 0.4, 0.5, 0.6, 30.0]), 3)
            rows.append((rec, k, rng.choice(["S0", "S0", "S1", None]) if rec != "b" else "S0", "eng", t, round(t + rng.uniform(0.1, 8.0), 3), f"t{k}"))
            t = rows[-1][5]
    df = spark.createDataFrame(rows, TURN)
    def plain():
        held, out = {}, []
        for r in rows:
            now = held.get(r[0])
            if now and r[2] is not None and now[2] == r[2] and round(r[4] * 1e6) - round(now[4] * 1e6) <= 500_000:
                held[r[0]] = (*now[:3], f"{now[3]} {r[6]}", r[5], now[5] + 1)
                continue
            if now:
                out.append(now)
            held[r[0]] = None if r[2] is None else (r[0], r[1], r[2], r[6], r[5], 1)
        return sorted([(n[0], n[1], n[2], n[3], n[5]) for n in [*out, *held.values()] if n])

    schema = TURN + ", at timestamp"
    for cut in (1, 3, 7):
        path = str(tmp_path / f"in{cut}")
        last = max(r[4] for r in rows)
        parts = [[] for _ in range(cut)]
        for r in rows:
            parts[min(cut - 1, int((r[4] + rng.uniform(0, 300)) * cut / (last + 300)))].append(r)
        for part in [*parts, [("flush", 0, "S0", "eng", 0.0, 0.0, "")]]:
            made = spark.createDataFrame(part, TURN).withColumn("at", F.timestamp_seconds(F.when(F.col("recording_id") == "flush", 1e7).otherwise(F.col("start_s"))))
            made.coalesce(1).write.mode("append").parquet(path)
        stream = live.arriving(spark, path, schema, files_per_trigger=1)
        got = drain(spark, live.merge_late_turns(stream, delay="5 minutes"), f"late{cut}", "append", str(tmp_path / f"c{cut}"))
        assert sorted((r["recording_id"], r["pos"], r["speaker_id"], r["raw_text"], r["n_merged"]) for r in got.collect() if r["recording_id"] != "flush") == plain()


def test_caps_hold_over_triggers(spark, tmp_path):
    rows = spark.range(40).select((F.col("id") % 3).alias("g"), "id")
    for a, b in ((0, 5), (5, 25), (25, 40)):
        rows.filter((F.col("id") >= a) & (F.col("id") < b)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = live.arriving(spark, str(tmp_path / "in"), "g long, id long", files_per_trigger=1)
    got = drain(spark, live.capped(stream, 6, ["g"], "id"), "caps", "append", str(tmp_path / "c"))
    assert sorted((r["g"], r["id"]) for r in got.collect()) == sorted((k % 3, k) for k in range(18))


def test_changed_windows_only(spark, tmp_path):
    rows = spark.range(90).select((F.col("id") % 4).alias("k"), "id")
    split(spark, rows, str(tmp_path / "in"), "id", 3)
    stream = live.arriving(spark, str(tmp_path / "in"), "k long, id long", files_per_trigger=1).groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("last"))
    live.write_changed(stream, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination(120)
    want = {(r["k"], r["n"], r["last"]) for r in rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("last")).collect()}
    assert {tuple(r) for r in live.newest(spark, str(tmp_path / "out"), ["k"]).select("k", "n", "last").collect()} == want


def test_counters_of_an_extraction(spark, tmp_path):
    samples = spark.createDataFrame([(k, None if k == 4 else k / 10) for k in range(10)], "id long, wer double")
    done = spark.createDataFrame([(0,), (0,), (7,)], "id long")
    model = lambda df: df.select("id", F.when(F.col("id") == 2, "bad").alias("error"))
    rows, counters = dataset.extract_observed(samples, done, F.col("wer") < 0.5, model)
    rows.write.parquet(str(tmp_path / "out"))
    assert counters() == {"total": 8, "kept": 3, "filtered": 5, "written": 3, "errors": 1}


@pytest.mark.parametrize("name", ["q_stream_new_documents", "q_stream_quality_counts", "q_stream_first_visits", "q_stream_merged_turns"])
def test_tables_of_many_files_arrive(spark, tmp_path, name):
    """A table that is a folder of files gives the same as one file."""
    for folder, files in (("one", 1), ("many", 3)):
        events = spark.range(60).selectExpr("id AS event_id", "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, int(id)) AS ts", "id % 3 AS user_id", "'e' AS event_type", "id / 7D AS value", "'' AS props")
        documents = spark.range(20).selectExpr("id AS doc_id", "concat('t', id) AS text", "'eng' AS lang", "'s' AS source", "2L AS n_chars")
        for table, df in (("events", events), ("documents", documents)):
            df.repartition(files).write.parquet(f"{tmp_path}/{folder}/{table}.parquet" if files > 1 else f"{tmp_path}/{table}")
            if files == 1:
                (tmp_path / folder).mkdir(exist_ok=True)
                next((tmp_path / table).glob("*.parquet")).rename(tmp_path / folder / f"{table}.parquet")
    one, many = (sorted(map(tuple, streams.QUERIES[name][0](spark, f"{tmp_path}/{f}").collect())) for f in ("one", "many"))
    assert one and one == many


def test_late_rows_cost_few_calls_to_the_state():
    """However many rows and recordings arrive in a trigger, the state is asked a few times a share."""
    calls = []

    class State:
        def __init__(self, name):
            self.name, self.rows = name, []

        def __getattr__(self, what):
            def call(*given):
                calls.append((self.name, what))
                if what in ("appendList", "put"):
                    self.rows = [*(self.rows if what == "appendList" else []), *given[0]]
                elif what == "clear":
                    self.rows = []
                return iter(self.rows)

            return call

    class Handle:
        def getListState(self, name, schema):
            return State(name)

        def listTimers(self):
            return iter(())

        def registerTimer(self, at):
            calls.append(("timer", at))

    class Times:
        def getCurrentWatermarkInMs(self):
            return 10**9

    p = live.MergeLateTurns()
    p.init(Handle())
    rows = [Row(recording_id=str(r), pos=k, speaker_id="S", language="eng", start_s=k * 1.0, end_s=k + 0.9, raw_text="x", at=k * 1000) for k in range(200) for r in range(50)]
    assert list(p.handleInputRows((0,), iter(rows), None)) == []
    out = list(p.handleExpiredTimer((0,), Times(), None))
    assert sorted((r["recording_id"], r["n_merged"]) for r in out) == sorted((str(r), 200) for r in range(50)) and len(calls) < 10
