"""Recordings, turns and metrics as streams.

Every stream has a batch twin whose result on the same rows it must reach.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from parlance.operators.quality import classify


def arriving(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", files_per_trigger: int | None = None) -> DataFrame:
    """Files that keep arriving in a folder; with a checkpoint, a later run sees only new ones."""
    reader = spark.readStream.schema(schema).format(fmt)
    return (reader if files_per_trigger is None else reader.option("maxFilesPerTrigger", files_per_trigger)).load(path)


def process_new(stream: DataFrame, step: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Everything that is new goes through a batch step and is written; then the run ends.

    A batch is written under its number, so that one that is tried again replaces its own files.
    """

    def each(batch: DataFrame, number: int) -> None:
        step(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class CappedRows(StatefulProcessor):
    """Passes rows of a group until it has had cap of them; the count is all that is kept."""

    def __init__(self, cap: int, key: str, columns: list[str]):
        self.cap, self.key, self.columns = cap, key, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.had = handle.getValueState("had", "n long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        had = self.had.get()[0] if self.had.exists() else 0
        room, best = self.cap - had, None
        if room <= 0:
            return
        for batch in rows:  # no more than cap rows are held, however many arrive
            best = (batch if best is None else pd.concat([best, batch])).sort_values(self.key, kind="stable").head(room)
        if best is not None:
            self.had.update((had + len(best),))
            yield best[self.columns]

    def close(self) -> None:
        pass


def capped(stream: DataFrame, cap: int, groups: list[str], key: str) -> DataFrame:
    """At most cap rows of each group over all triggers, of one trigger those with the smallest keys. Needs the RocksDB state store.

    Rows that arrive in order of their keys give the batch's result, however they are cut into triggers.
    """
    return stream.groupBy(*groups).transformWithStateInPandas(CappedRows(cap, key, stream.columns), stream.schema, "Append", "None")


def write_changed(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Only the result rows that a trigger changed, under the trigger's number; windows that the watermark has passed leave the state."""

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/trigger={number}")

    return stream.writeStream.foreachBatch(each).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def newest(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """Each key's row of its last trigger, from what ``write_changed`` wrote."""
    rows = spark.read.parquet(out)
    rest = [c for c in rows.columns if c not in (*keys, "trigger")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "trigger").alias("_r")).select(*keys, "_r.*")


def without_repeats(stream: DataFrame, keys: list[str], at: str, delay: str = "1 hour") -> DataFrame:
    """The first row of each key; state is dropped as the watermark passes."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def quality_counts(stream: DataFrame, at: str = "ts", delay: str = "1 hour", width: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Files of each quality in windows of arrival time. stream: snr, speech_pct, clip_pct, rms and the time."""
    flag = classify(F.col("snr"), F.col("speech_pct"), F.col("clip_pct"), F.col("rms"))["flag"]
    return stream.withWatermark(at, delay).groupBy(F.window(at, width, slide), flag.alias("quality")).agg(F.count("*").alias("n"))


def session_turns(stream: DataFrame, at: str = "ts", gap: str = "500 milliseconds", delay: str = "10 minutes") -> DataFrame:
    """Turns of a speaker and language that follow each other, as sessions of event time.

    Unlike the exact merge, another speaker in between does not end a session.
    """
    s = stream.withWatermark(at, delay).groupBy("recording_id", "speaker_id", "language", F.session_window(at, gap))
    return s.agg(F.count("*").alias("n"), F.min("start_s").alias("start_s"), F.max("end_s").alias("end_s")).drop("session_window")


MERGED = "recording_id string, pos int, speaker_id string, language string, start_s double, end_s double, raw_text string, n_merged int"


class MergeTurns(StatefulProcessor):
    """The exact merge: holds each recording's open row and emits it when the next one doesn't join it.

    Rows of one trigger are ordered by position; a recording's rows must arrive in order across triggers. A row
    with a null speaker closes its recording; with ``idle_s``, so does that much processing time without a row.
    """

    def __init__(self, max_gap_s: float = 0.5, idle_s: float | None = None):
        self.gap = round(max_gap_s * 1_000_000)
        self.idle_ms = None if idle_s is None else int(idle_s * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", MERGED)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
        held = [tuple(self.open.get())] if self.open.exists() else []
        self.open.clear()
        yield pd.DataFrame(held, columns=[c.split()[0] for c in MERGED.split(", ")])

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        held = self.open.get() if self.open.exists() else None
        now = None if held is None else list(held)
        out = []
        for r in pd.concat(list(rows)).sort_values("pos").itertuples(index=False):
            if r.speaker_id is None or pd.isna(r.speaker_id):
                if now is not None:
                    out.append(tuple(now))
                now = None
                continue
            joins = now is not None and now[2] == r.speaker_id and now[3] == r.language and round(r.start_s * 1e6) - round(now[5] * 1e6) <= self.gap
            if joins:
                now[5], now[6], now[7] = r.end_s, f"{now[6]} {r.raw_text}", now[7] + 1
            else:
                if now is not None:
                    out.append(tuple(now))
                now = [key[0], int(r.pos), r.speaker_id, r.language, float(r.start_s), float(r.end_s), r.raw_text, 1]
        if self.idle_ms is not None:
            for at in list(self.handle.listTimers()):
                self.handle.deleteTimer(at)
        if now is None:
            self.open.clear()
        else:
            self.open.update(tuple(now))
            if self.idle_ms is not None:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield pd.DataFrame(out, columns=[c.split()[0] for c in MERGED.split(", ")])

    def close(self) -> None:
        pass


MERGED_ROW = Row(*[c.split()[0] for c in MERGED.split(", ")])
WAITING = "recording_id string, pos int, start long, speaker_id string, language string, start_s double, end_s double, raw_text string, at long"


class MergeLateTurns(StatefulProcessor):
    """The exact merge of rows in any order within the watermark's delay, for many recordings at a time.

    Rows wait in a list until the watermark has passed them; then all that is passed is merged in order. Every call to
    the state is a round trip, so recordings share a list, which is added to once a trigger and written anew once a
    wake-up. One timer wakes all up: for the earliest waiting row, or when nothing can join an open row any more.
    """

    def __init__(self, max_gap_s: float = 0.5):
        self.gap = round(max_gap_s * 1_000_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", WAITING)
        self.open = handle.getListState("open", MERGED + ", until long")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:
        new = [(r.recording_id, r.pos, round(r.start_s * 1e6), r.speaker_id, r.language, r.start_s, r.end_s, r.raw_text, r.at) for r in rows]
        if new:
            self.waiting.appendList(new)
            earliest, times = min(r[-1] for r in new), list(self.handle.listTimers())
            if not times or earliest < min(times):
                for t in times:
                    self.handle.deleteTimer(t)
                self.handle.registerTimer(earliest)
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs()
        held = {tuple(r[:3]): tuple(r) for r in self.waiting.get()}  # the last of one recording, position and start
        due = sorted((r for r in held.values() if r[-1] <= passed), key=lambda r: (r[0] or "", *r[1:3]))
        left = [r for r in held.values() if r[-1] > passed]
        open_rows = {r[0]: list(r) for r in self.open.get()}
        for recording, pos, start, speaker, language, start_s, end_s, text, at in due:
            now = open_rows.get(recording)
            if now is not None and now[2] == speaker and now[3] == language and start - round(now[5] * 1e6) <= self.gap:
                now[5], now[6], now[7] = end_s, f"{now[6]} {text}", now[7] + 1
            else:
                if now is not None:
                    yield MERGED_ROW(*now[:8])
                now = None if speaker is None else [recording, pos, speaker, language, start_s, end_s, text, 1, 0]
            if now is None:
                open_rows.pop(recording, None)
            else:  # rows later than this start too late to join
                now[8] = at + (round(end_s * 1e6) - start + self.gap) // 1000 + 1
                open_rows[recording] = now
        for now in open_rows.values():
            if now[8] <= passed:
                yield MERGED_ROW(*now[:8])
        still = [tuple(now) for now in open_rows.values() if now[8] > passed]
        for state, rows in ((self.waiting, left), (self.open, still)):
            state.put(rows) if rows else state.clear()
        times = [r[-1] for r in (*left, *still)]
        if times:  # the timer that woke this up is dropped by the engine
            self.handle.registerTimer(min(times))

    def close(self) -> None:
        pass


def merge_late_turns(stream: DataFrame, at: str = "at", delay: str = "10 minutes", max_gap_s: float = 0.5, shares: int = 64) -> DataFrame:
    """Merged rows as the watermark passes them; rows may arrive in any order within ``delay`` of event time ``at``, their start.

    However the rows are cut into triggers, the result is that of the batch. Rows of one position and start are one
    row. Recordings are dealt over so many ``shares`` of the state. Needs the RocksDB state store.
    """
    rows = stream.withColumn("_at", F.col(at).cast("timestamp")).withWatermark("_at", delay)
    share = F.pmod(F.xxhash64("recording_id"), F.lit(shares)).cast("int")
    rows = rows.select(share.alias("share"), "recording_id", F.col("pos").cast("int").alias("pos"), "speaker_id", "language", "start_s", "end_s", "raw_text", F.unix_millis("_at").alias("at"), "_at")
    return rows.groupBy("share").transformWithState(MergeLateTurns(max_gap_s), MERGED, "Append", "EventTime")


def merge_turns(stream: DataFrame, max_gap_s: float = 0.5, idle_s: float | None = None) -> DataFrame:
    """Merged rows as they close. Needs the RocksDB state store."""
    mode = "None" if idle_s is None else "ProcessingTime"
    return stream.groupBy("recording_id").transformWithStateInPandas(MergeTurns(max_gap_s, idle_s), MERGED, "Append", mode)
