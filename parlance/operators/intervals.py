"""Interval joins, merging and complements of timed rows, and cutting of media time.

All comparisons use whole microseconds. Tables carry ``recording_id`` and an explicit order (``pos``,
``turn_no``); results that depend on order end their ordering with it.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.functions.times import micros
from parlance.storage import store

NO_SPEAKER = "SPEAKER_00"


def overlap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.greatest(F.lit(0), F.least(a1, b1) - F.greatest(a0, b0))


def bins(start: Column, stop: Column, width_us: int) -> Column:
    """Numbers of the time bins that an interval of microseconds touches; an empty one touches its start's."""
    first = F.floor(start / width_us).cast("long")
    return F.sequence(first, F.greatest(first, F.floor((stop - 1) / width_us).cast("long")))


def interval_pairs(left: DataFrame, right: DataFrame, key: str, bin_s: float | None, empty: bool = False) -> DataFrame:
    """Pairs of rows of one key whose [t0, t1) overlap; right's columns but the key have other names than left's.

    An empty interval overlaps nothing; with ``empty`` it also pairs with those that it lies strictly inside of.

    Without bins, the join is on the key with the ranges as a residual, which suits short recordings. With bins,
    both sides are laid out over time bins and joined on (key, bin), so that neither a long recording nor one
    that holds much of the data meets in one task; a pair counts in the first bin that both touch.
    """
    over = (F.col("t0") < F.col("r1")) & (F.col("r0") < F.col("t1"))
    if not empty:  # the plain range test, and a positive overlap
        over = over & (F.col("t0") < F.col("t1")) & (F.col("r0") < F.col("r1"))
    if bin_s is None:
        return left.join(right, key).filter(over)
    width = int(bin_s * 1_000_000)
    a = left.withColumn("bin", F.explode(bins(F.col("t0"), F.col("t1"), width)))
    b = right.withColumn("bin", F.explode(bins(F.col("r0"), F.col("r1"), width)))
    shared = F.floor(F.greatest("t0", "r0") / width).cast("long")
    return a.join(b, [key, "bin"]).filter(over & (F.col("bin") == shared)).drop("bin")


def assign_speakers(segments: DataFrame, turns: DataFrame, bin_s: float | None = None, empty: bool = False) -> DataFrame:
    """segments with the speaker of the turn that overlaps each most; the first turn among equals.

    A segment is one (recording_id, pos); without any positive overlap its speaker is ``SPEAKER_00``. With ``empty``,
    a segment or turn of no length inside the other counts as an overlap of zero. Only the segments' keys and times take part in the join and the choice; their other columns are joined back by key.
    """
    s = segments.select("recording_id", "pos", micros(F.col("start_s")).alias("t0"), micros(F.col("end_s")).alias("t1"))
    t = turns.select("recording_id", "turn_no", F.col("speaker_id").alias("speaker"), micros(F.col("start_s")).alias("r0"), micros(F.col("end_s")).alias("r1"))
    best = best_overlap(interval_pairs(s, t, "recording_id", bin_s, empty), ["recording_id", "pos"])
    return segments.join(best, ["recording_id", "pos"], "left").withColumn("speaker_id", F.coalesce("speaker", F.lit(NO_SPEAKER))).drop("speaker")


def best_overlap(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """For each key the speaker of the largest overlap, the lowest turn among equals; combined before the shuffle."""
    shared = overlap(F.col("t0"), F.col("t1"), F.col("r0"), F.col("r1"))
    order = F.struct((-shared).alias("less"), F.col("turn_no"), F.col("speaker"))
    return pairs.groupBy(*keys).agg(F.min(order).alias("best")).select(*keys, F.col("best.speaker").alias("speaker"))


def contained(regions: DataFrame, groups: DataFrame, bin_s: float = 60.0) -> DataFrame:
    """Regions that lie wholly inside a group of their recording (group columns: g_no, g0_s, g1_s).

    Groups are laid out over time bins; a region asks the bin of its start.
    """
    width = int(bin_s * 1_000_000)
    laid = groups.withColumn("_bin", F.explode(F.sequence(F.floor(micros(F.col("g0_s")) / width).cast("long"), F.floor(F.greatest(micros(F.col("g1_s")), micros(F.col("g0_s"))) / width).cast("long"))))
    asked = regions.withColumn("_bin", F.floor(micros(F.col("start_s")) / width).cast("long"))
    inside = (micros(F.col("start_s")) >= micros(F.col("g0_s"))) & (micros(F.col("end_s")) <= micros(F.col("g1_s")))
    return asked.join(laid, ["recording_id", "_bin"]).filter(inside).drop("_bin")


def islands(df: DataFrame, keys: list[str], order: list[str], breaks: Column, name: str = "island") -> DataFrame:
    """df with a running number that grows where ``breaks`` (over the previous row, null for the first) holds."""
    w = Window.partitionBy(*keys).orderBy(*order)
    flagged = df.withColumn("_break", F.coalesce(breaks, F.lit(True)).cast("int"))
    return flagged.withColumn(name, F.sum("_break").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_break")


def merge_consecutive(segments: DataFrame, max_gap_s: float = 0.5, text_col: str = "raw_text") -> DataFrame:
    """Neighbours of the same speaker and language within a gap become one row, however long the run.

    The merged row starts with its first, ends with its last, has the least confidence and all words. Negative
    gaps merge. Because a merged end is its last row's, looking one row back at the plain rows is exact.
    """
    w = Window.partitionBy("recording_id").orderBy("pos")
    gap = micros(F.col("start_s")) - F.lag(micros(F.col("end_s"))).over(w)
    same = (F.col("speaker_id").eqNullSafe(F.lag("speaker_id").over(w))) & (F.col("language").eqNullSafe(F.lag("language").over(w)))
    breaks = F.when(F.lag(F.lit(1)).over(w).isNotNull(), ~(same & (gap <= int(max_gap_s * 1_000_000))))
    marked = islands(segments, ["recording_id"], ["pos"], breaks)
    row = F.struct("pos", F.col(text_col).alias("text"), "words")
    merged = marked.groupBy("recording_id", "island").agg(
        F.min("pos").alias("pos"),
        F.min_by("segment_id", "pos").alias("segment_id"),
        F.min_by("start_s", "pos").alias("start_s"),
        F.max_by("end_s", "pos").alias("end_s"),
        F.min_by("speaker_id", "pos").alias("speaker_id"),
        F.min_by("language", "pos").alias("language"),
        F.min("confidence").alias("confidence"),
        F.array_sort(F.collect_list(row)).alias("rows"),
        F.count("*").alias("n_merged"),
    )
    text = F.array_join(F.transform("rows", lambda r: r["text"]), " ")
    words = F.flatten(F.transform("rows", lambda r: F.coalesce(r["words"], F.array().cast(segments.schema["words"].dataType))))
    return merged.withColumn(text_col, text).withColumn("words", words).drop("rows", "island")


def non_speech_regions(regions: DataFrame, totals: DataFrame, min_gap_s: float = 0.3) -> DataFrame:
    """What lies between, before and after a recording's regions and is longer than a gap.

    totals: (recording_id, total_s). A recording without regions is one region of its whole length. The previous
    end is the previous row's, not the largest so far.
    """
    least = int(min_gap_s * 1_000_000)
    w = Window.partitionBy("recording_id").orderBy("pos")
    inner = regions.select("recording_id", F.lag(micros(F.col("end_s")), 1, 0).over(w).alias("a"), micros(F.col("start_s")).alias("b"))
    last = regions.groupBy("recording_id").agg(F.max_by(micros(F.col("end_s")), "pos").alias("a"))
    tail = totals.join(last, "recording_id", "left").select("recording_id", F.coalesce("a", F.lit(0)).alias("a"), micros(F.col("total_s")).alias("b"), F.col("a").isNull().alias("whole"))
    both = inner.withColumn("whole", F.lit(False)).unionByName(tail)
    gaps = both.filter((F.col("b") - F.col("a") > least) | (F.col("whole") & (F.col("b") > F.col("a"))))
    return gaps.select("recording_id", (F.col("a") / 1e6).alias("start_s"), (F.col("b") / 1e6).alias("end_s"))


def vad_groups(regions: DataFrame, max_s: float = 30.0, max_gap_s: float = 3.0, block: int = 4096) -> DataFrame:
    """Greedy grouping of regions: a group grows while it stays within max_s and the gap stays below max_gap_s.

    Where a group that starts at some region ends depends on what follows alone, so every region points to the start of
    the group after its own. Blocks of regions, each with its neighbours, turn these pointers into jumps from block to
    block; the starts that are really met are found from the first regions and those after long gaps by doubling the
    jumps, as many rounds as the number of blocks in a row has bits. No recording and no endless run of close regions
    is gone through in one task; only its narrow rows are put in order. Yields (recording_id, g_no, regions, g0_s, g1_s).
    """
    most, gap = int(max_s * 1_000_000), int(max_gap_s * 1_000_000)
    w = Window.partitionBy("recording_id").orderBy("pos")
    r = regions.select("recording_id", "pos", micros(F.col("start_s")).alias("a"), micros(F.col("end_s")).alias("b"))
    fresh = F.coalesce(F.col("a") - F.lag("b").over(w) >= gap, F.lit(True))
    placed = store(r.select("recording_id", "a", "b", fresh.alias("fresh"), (F.row_number().over(w) - 1).cast("long").alias("i"), F.count("*").over(Window.partitionBy("recording_id")).alias("n")), "regions")
    while True:
        jumps = store(_group_jumps(placed, most, block), "region-jumps")
        if not jumps.filter("i IS NULL").limit(1).count():
            break
        block *= 4  # a group is longer than a block: so many regions lie within max_s
    met = jumps.filter("first").select("recording_id", "i")
    to = jumps.filter("next IS NOT NULL").select("recording_id", "i", "next")
    while True:
        reached = store(met.unionByName(met.join(to, ["recording_id", "i"]).select("recording_id", F.col("next").alias("i"))).distinct(), "region-starts")
        further = store(to.join(to.select("recording_id", F.col("i").alias("next"), F.col("next").alias("after")), ["recording_id", "next"]).select("recording_id", "i", F.col("after").alias("next")), "region-jumps")
        met, to = reached, further
        if not further.limit(1).count():
            break
    grouped = store(_groups_from(placed, met, most, block), "region-groups")
    number = grouped.select("recording_id", "i").withColumn("g_no", F.row_number().over(Window.partitionBy("recording_id").orderBy("i")) - 1)
    return grouped.join(number, ["recording_id", "i"]).select("recording_id", "g_no", "regions", F.element_at("regions", 1)["start_s"].alias("g0_s"), F.element_at("regions", -1)["end_s"].alias("g1_s"))


def _next_starts(rows: pa.Table, most: int) -> tuple[np.ndarray, list[int], list[int], list[int], list[bool]]:
    """Of regions in order: places, starts, ends, for each where the group after one that starts with it starts (an index, or their number), and which
    are after a long gap."""
    i, a, b, fresh = rows["i"].to_numpy(), *(rows[c].to_pylist() for c in ("a", "b", "fresh"))
    n = len(i)
    found = [n] * n
    # the first later end beyond a limit: ends that an earlier one covers never are
    ends: list[int] = []
    for k in range(n - 1, -1, -1):
        lo, hi = 0, len(ends)  # ends holds indices of ever larger ends, the nearest last
        while lo < hi:
            middle = (lo + hi) // 2
            if b[ends[middle]] > a[k] + most:
                lo = middle + 1
            else:
                hi = middle
        found[k] = ends[lo - 1] if lo else n
        while ends and b[ends[-1]] <= b[k]:
            ends.pop()
        ends.append(k)
    following = n
    for k in range(n - 1, -1, -1):
        found[k] = min(found[k], following)
        if fresh[k]:
            following = k
    return i, a, b, found, fresh


def _group_jumps(placed: DataFrame, most: int, block: int) -> DataFrame:
    """(recording_id, i, next, first): starts in a block, by where the chain of starts enters the next block; a null i if blocks are too short."""
    own = F.floor(F.col("i") / block)
    last = F.floor((F.col("n") - 1) / block)
    near = placed.select("*", F.explode(F.filter(F.array(own - 1, own, own + 1), lambda k: (k >= 0) & (k <= last))).alias("block")).drop("n")

    def run(rows: pa.Table) -> pa.Table:
        rid, k = rows["recording_id"][0].as_py(), rows["block"][0].as_py()
        i, _, _, found, fresh = _next_starts(rows, most)
        lo, hi, n = int(np.searchsorted(i, k * block)), int(np.searchsorted(i, (k + 1) * block)), len(i)
        if lo == hi:  # neighbours only
            return out([], [], [])
        # without an end among the rows, a group ends where the recording does, if that is what ends the rows
        if any(found[j] == n for j in range(lo, hi)) and n - hi == block:
            return out([None], [None], [False])
        exits = [n] * n
        for j in range(hi - 1, lo - 1, -1):
            t = found[j]
            exits[j] = n if t == n or fresh[t] else t if t >= hi else exits[t]
        entries = sorted({found[j] for j in range(lo) if lo <= found[j] < hi} | {j for j in range(lo, hi) if fresh[j]})
        return out([int(i[j]) for j in entries], [int(i[exits[j]]) if exits[j] < n else None for j in entries], [bool(fresh[j]) for j in entries], rid)

    def out(starts: list, nexts: list, first: list, rid: str | None = None) -> pa.Table:
        return pa.table({"recording_id": pa.array([rid] * len(starts), pa.string()), "i": pa.array(starts, pa.int64()), "next": pa.array(nexts, pa.int64()), "first": pa.array(first, pa.bool_())})

    return _by_block(near, run, "recording_id string, i long, next long, first boolean")


def _by_block(rows: DataFrame, run: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """run's rows for all rows of each (recording_id, block), in order of i; many small groups pass in one batch."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        done: list[pa.Table] = []
        for b in batches:
            if not b.num_rows:
                continue
            rid, block = b.column("recording_id"), b.column("block")
            new = pc.fill_null(pc.or_(pc.not_equal(rid[1:], rid[:-1]), pc.not_equal(block[1:], block[:-1])), True).to_numpy(zero_copy_only=False)
            at = [0, *(np.flatnonzero(new) + 1).tolist(), b.num_rows]
            for a, z in itertools.pairwise(at):
                if held and (held[-1]["recording_id"][-1] != rid[a] or held[-1]["block"][-1] != block[a]):
                    done.append(run(pa.Table.from_batches(held)))
                    held = []
                held.append(b.slice(a, z - a))
            if done:
                yield from pa.concat_tables(done).combine_chunks().to_batches()
                done = []
        if held:
            yield from run(pa.Table.from_batches(held)).combine_chunks().to_batches()

    return rows.repartition("recording_id", "block").sortWithinPartitions("recording_id", "block", "i").mapInArrow(runs, schema)


def _groups_from(placed: DataFrame, met: DataFrame, most: int, block: int) -> DataFrame:
    """(recording_id, i, regions): all groups, each from the block that its first region is in."""
    own = F.floor(F.col("i") / block)
    flagged = placed.drop("n").join(met.withColumn("entry", F.lit(True)), ["recording_id", "i"], "left")
    near = flagged.select("recording_id", "i", "a", "b", "fresh", F.coalesce("entry", F.lit(False)).alias("entry"), F.explode(F.filter(F.array(own - 1, own), lambda k: k >= 0)).alias("block"))
    kind = pa.list_(pa.struct([("start_s", pa.float64()), ("end_s", pa.float64())]))

    def run(rows: pa.Table) -> pa.Table:
        rid, k = rows["recording_id"][0].as_py(), rows["block"][0].as_py()
        i, a, b, found, fresh = _next_starts(rows, most)
        hi = int(np.searchsorted(i, (k + 1) * block))
        firsts, groups = [], []
        for j in np.flatnonzero(rows["entry"].to_numpy()[:hi]).tolist():
            while j < hi:
                t = found[j]
                firsts.append(int(i[j]))
                groups.append([{"start_s": a[x] / 1e6, "end_s": b[x] / 1e6} for x in range(j, t)])
                if t < len(i) and fresh[t]:
                    break  # a start of its own
                j = t
        return pa.table({"recording_id": pa.array([rid] * len(firsts), pa.string()), "i": pa.array(firsts, pa.int64()), "regions": pa.array(groups, kind)})

    return _by_block(near, run, "recording_id string, i long, regions array<struct<start_s:double,end_s:double>>")


def split_long(groups: DataFrame, max_s: float = 30.0) -> DataFrame:
    """Groups over max_s cut at their largest inner gap, the first among equals, until they fit or are one region.

    groups: (recording_id, g_no, regions). Recursive, so it runs over Arrow batches; each row stands alone.
    """

    def cut(rs: list[dict]) -> Iterator[tuple[float, float]]:
        todo = [rs]
        while todo:
            part = todo.pop()
            if len(part) < 2 or round((part[-1]["end_s"] - part[0]["start_s"]) * 1e6) <= round(max_s * 1e6):
                yield part[0]["start_s"], part[-1]["end_s"]
                continue
            gaps = [round((b["start_s"] - a["end_s"]) * 1e6) for a, b in zip(part, part[1:], strict=False)]
            k = gaps.index(max(gaps)) + 1
            todo += [part[k:], part[:k]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(r.recording_id, r.g_no, i, x, y) for r in b.itertuples() if len(r.regions) for i, (x, y) in enumerate(cut(list(r.regions)))]
            yield pd.DataFrame(out, columns=["recording_id", "g_no", "part", "start_s", "end_s"])

    return groups.select("recording_id", "g_no", "regions").mapInPandas(run, "recording_id string, g_no int, part int, start_s double, end_s double")


def pad_chunks(parts: DataFrame, totals: DataFrame, pad_s: float = 0.2) -> DataFrame:
    """Chunks with padding inside [0, total] and numbers from zero in time order."""
    w = Window.partitionBy("recording_id").orderBy("start_s", "g_no", "part")
    out = parts.join(totals, "recording_id").withColumn("chunk_id", F.row_number().over(w) - 1)
    a, b = F.greatest(F.lit(0.0), F.col("start_s") - pad_s), F.least(F.col("total_s"), F.col("end_s") + pad_s)
    return out.select("recording_id", "chunk_id", a.alias("start_s"), b.alias("end_s"), (b - a).alias("duration_s"))


def vad_chunks(regions: DataFrame, totals: DataFrame, max_s: float = 30.0, max_gap_s: float = 3.0, pad_s: float = 0.2) -> DataFrame:
    return pad_chunks(split_long(vad_groups(regions, max_s, max_gap_s), max_s), totals, pad_s)


def fixed_windows(totals: DataFrame, max_s: float = 30.0, overlap_s: float = 2.0) -> DataFrame:
    """Windows of max_s that overlap by overlap_s, the last cut at the total; none for an empty recording."""
    if overlap_s >= max_s:
        raise ValueError("windows that overlap by their own length never advance")
    most, step = int(max_s * 1_000_000), int((max_s - overlap_s) * 1_000_000)
    total = micros(F.col("total_s"))
    n = F.when(total <= most, 1).otherwise(F.ceil((total - int(overlap_s * 1_000_000)) / step)).cast("int")
    rows = totals.filter(total > 0).select("recording_id", total.alias("t"), F.explode(F.sequence(F.lit(0), n - 1)).alias("chunk_id"))
    a = F.col("chunk_id").cast("long") * step
    b = F.least(a + most, F.col("t"))
    return rows.select("recording_id", "chunk_id", (a / 1e6).alias("start_s"), (b / 1e6).alias("end_s"), ((b - a) / 1e6).alias("duration_s"))


def over_blocks(blocks: DataFrame, ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Blocks with every range (recording_id, start_s, end_s and keys) that they hold samples of: first and last sample cut to the block.

    Ranges are laid out over block numbers, so that they meet their blocks by equality.
    """
    shape = blocks.groupBy("recording_id").agg(F.max(F.size("samples")).alias("_size"), F.max("sample_rate").alias("_rate")).filter("_size > 0")
    r = ranges.select("recording_id", *keys, "start_s", "end_s").join(shape, "recording_id")
    r = r.withColumns({"_a": F.floor(F.col("start_s") * F.col("_rate")).cast("long"), "_b": F.floor(F.col("end_s") * F.col("_rate")).cast("long")}).filter("_b > _a AND _b > 0")
    first, last = F.floor(F.greatest(F.lit(0), F.col("_a")) / F.col("_size")).cast("int"), F.floor((F.col("_b") - 1) / F.col("_size")).cast("int")
    laid = r.withColumn("block_no", F.explode(F.sequence(first, last))).select("recording_id", "block_no", *keys, "_a", "_b")
    j = blocks.join(laid, ["recording_id", "block_no"])
    lo = F.greatest(F.lit(0), F.col("_a") - F.col("start_sample")).cast("int")
    hi = F.least(F.size("samples").cast("long"), F.col("_b") - F.col("start_sample")).cast("int")
    return j.withColumn("samples", F.slice("samples", lo + 1, F.greatest(hi - lo, F.lit(0)))).filter(F.size("samples") > 0).drop("_a", "_b")


def slice_samples(blocks: DataFrame, chunks: DataFrame) -> DataFrame:
    """Samples of each chunk from fixed blocks, in order: (recording_id, chunk_id, block_no, samples)."""
    return over_blocks(blocks, chunks, ["chunk_id"]).select("recording_id", "chunk_id", "block_no", "sample_rate", "samples")


def frames_in_regions(frames: DataFrame, regions: DataFrame, bin_s: float = 60.0) -> DataFrame:
    """frames (recording_id, t0, t1 in microseconds) with ``in_speech``: whether a frame starts inside a region.

    Regions are laid out over time bins and meet the frames of their bins by equality.
    """
    width = int(bin_s * 1_000_000)
    r = regions.select("recording_id", micros(F.col("start_s")).alias("r0"), micros(F.col("end_s")).alias("r1")).filter("r1 > r0")
    r = r.withColumn("bin", F.explode(F.sequence(F.floor(F.col("r0") / width).cast("long"), F.floor((F.col("r1") - 1) / width).cast("long"))))
    keys = frames.select("recording_id", "t0").distinct().withColumn("bin", F.floor(F.col("t0") / width).cast("long"))
    hit = keys.join(r, ["recording_id", "bin"]).filter((F.col("t0") >= F.col("r0")) & (F.col("t0") < F.col("r1"))).select("recording_id", "t0").distinct()
    return frames.join(hit.withColumn("in_speech", F.lit(True)), ["recording_id", "t0"], "left").withColumn("in_speech", F.coalesce("in_speech", F.lit(False)))


def chunks_within(chunks: DataFrame, limit_s: float) -> tuple[DataFrame, DataFrame]:
    """(chunks an engine accepts, chunks that are too long for it, to report)."""
    fits = micros(F.col("duration_s")) <= int(limit_s * 1_000_000)
    return chunks.filter(fits), chunks.filter(~fits)
