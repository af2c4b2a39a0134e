"""Signal metrics over sample blocks.

Blocks are ``(recording_id, block_no, start_sample, sample_rate, samples)`` of a fixed number of samples, which
the frame lengths divide; only a recording's last block is shorter. All level metrics are sums over blocks, so a
recording of any length is spread over tasks. Spectra are made in Arrow batches, block by block, with the first samples
of the blocks behind, and summed after.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlance.functions.times import micros
from parlance.operators.intervals import over_blocks
from parlance.operators.quality import gap_class
from parlance.operators.selection import percentiles
from parlance.storage import store

N_FFT, HOP = 2048, 1024
#: Spectra that a worker makes at a time (8 KB each), and blocks of a recording whose spectra are added up in one task.
SPECTRA, ADDED = 256, 1024
#: What spectra are made from, which recordings are one block, and a mean from a sum.
HALOED = ("recording_id", "start_sample", "samples", "more", "total")
ALONE = "total = size(samples)"
MEAN = "transform(magnitude, m -> m / frames) AS magnitude"


def db(x: Column, floor: float) -> Column:
    return 20 * F.log10(F.greatest(x, F.lit(floor)))


def energy(samples: Column) -> Column:
    return F.aggregate(samples, F.lit(0.0), lambda s, x: s + x.cast("double") * x)


def peak(samples: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(samples, lambda x: F.abs(x).cast("double"))), F.lit(0.0))


def levels(blocks: DataFrame, clip: float = 0.997) -> DataFrame:
    """Per recording: samples, duration, RMS and peak in dBFS (floor 1e-12), the other RMS rule, clipped samples."""
    part = blocks.select("recording_id", "sample_rate", F.size("samples").alias("n"), energy(F.col("samples")).alias("e"), peak(F.col("samples")).alias("p"), F.size(F.filter("samples", lambda x: F.abs(x) >= clip)).alias("c"))
    s = part.groupBy("recording_id").agg(F.max("sample_rate").alias("sample_rate"), F.sum("n").alias("n"), F.sum("e").alias("e"), F.max("p").alias("peak_amplitude"), F.sum("c").alias("clipped_samples"))
    rms = F.sqrt(F.col("e") / F.col("n"))
    soft = F.sqrt(F.col("e") / F.col("n") + 1e-10)
    has = F.col("n") > 0
    return s.select(
        "recording_id", "n", "sample_rate",
        F.when(has, F.col("n") / F.col("sample_rate")).otherwise(0.0).alias("duration_s"),
        F.when(has, db(rms, 1e-12)).otherwise(-120.0).alias("rms_dbfs"),
        F.when(has, db(F.col("peak_amplitude"), 1e-12)).otherwise(-120.0).alias("peak_dbfs"),
        F.when(has, 20 * F.log10(soft + 1e-10)).otherwise(-120.0).alias("rms_dbfs_soft"),
        "peak_amplitude", "clipped_samples",
        F.when(has, 100 * F.col("clipped_samples") / F.col("n")).otherwise(0.0).alias("clip_pct"),
    )


def frames(blocks: DataFrame, frame_s: float) -> DataFrame:
    """Mean square of every whole frame: (recording_id, frame_no, t0 in microseconds, power)."""
    size = F.floor(F.lit(frame_s) * F.col("sample_rate") + 1e-9).cast("int")
    n = F.floor(F.size("samples") / F.col("size")).cast("int")
    rows = blocks.withColumn("size", size).filter("size > 0").withColumn("k", F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))))
    power = energy(F.slice("samples", F.col("k") * F.col("size") + 1, F.col("size"))) / F.col("size")
    first = F.floor(F.col("start_sample") / F.col("size")) + F.col("k")
    return rows.select("recording_id", first.cast("long").alias("frame_no"), F.round((F.col("start_sample") + F.col("k") * F.col("size")) * 1e6 / F.col("sample_rate")).cast("long").alias("t0"), power.alias("power"))


def percentile_snr(fr: DataFrame, least: int = 5, margin_db: float = 15.0) -> DataFrame:
    """Per recording: P75 minus P25 of the frames' level, and the share of frames well above P25."""
    level = fr.select("recording_id", db(F.sqrt("power"), 1e-9).alias("v"))
    floor = percentiles(level, (0.25, 0.75)).select("recording_id", "n", F.col("p")[0].alias("p25"), F.col("p")[1].alias("p75"))
    above = level.join(floor, "recording_id").groupBy("recording_id", "n", "p25", "p75").agg((100 * F.avg((F.col("v") > F.col("p25") + margin_db).cast("int"))).alias("pct"))
    enough = F.col("n") >= least
    return above.select("recording_id", F.when(enough, F.col("p75") - F.col("p25")).otherwise(0.0).alias("snr_db"), F.when(enough, F.col("pct")).otherwise(0.0).alias("speech_pct"), "p25")


def merged_regions(regions: DataFrame, keys: list[str]) -> DataFrame:
    """Regions with overlaps merged, so that a sample is inside once."""
    r = regions.select(*keys, micros(F.col("start_s")).alias("a"), micros(F.col("end_s")).alias("b"))
    w = Window.partitionBy(*keys).orderBy("a", "b")
    fresh = r.withColumn("new", (F.col("a") > F.coalesce(F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))).cast("int"))
    return fresh.withColumn("k", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0))).groupBy(*keys, "k").agg(F.min("a").alias("a"), F.max("b").alias("b")).drop("k")


def inside_power(blocks: DataFrame, regions: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per recording (and further keys): energy and samples inside regions, sample-exact.

    Regions are laid out over block numbers, so the join is an equality on (recording, block).
    """
    keys = keys or ["recording_id"]
    shape = blocks.groupBy("recording_id").agg(F.max(F.size("samples")).alias("block_size"), F.max("sample_rate").alias("rate"))
    r = merged_regions(regions, keys).join(shape, "recording_id")
    a, b = F.floor(F.col("a") * F.col("rate") / 1e6 + 1e-6).cast("long"), F.floor(F.col("b") * F.col("rate") / 1e6 + 1e-6).cast("long")
    r = r.withColumns({"a": a, "b": b}).filter("b > a").withColumn("block_no", F.explode(F.sequence(F.floor(F.col("a") / F.col("block_size")).cast("int"), F.floor((F.col("b") - 1) / F.col("block_size")).cast("int"))))
    j = blocks.select("recording_id", "block_no", "start_sample", "samples").join(r, ["recording_id", "block_no"])
    first = F.greatest(F.lit(0), F.col("a") - F.col("start_sample")).cast("int")
    last = F.least(F.size("samples").cast("long"), F.col("b") - F.col("start_sample")).cast("int")
    piece = F.slice("samples", first + 1, F.greatest(last - first, F.lit(0)))
    return j.select(*keys, energy(piece).alias("e"), F.size(piece).alias("n")).groupBy(*keys).agg(F.sum("e").alias("in_energy"), F.sum("n").alias("in_n"))


def region_metrics(blocks: DataFrame, regions: DataFrame) -> DataFrame:
    """Per recording: SNR of speech against the rest, crosstalk, and the share of speech."""
    total = blocks.groupBy("recording_id").agg(F.sum(energy(F.col("samples"))).alias("e"), F.sum(F.size("samples")).alias("n"))
    t = total.join(inside_power(blocks, regions), "recording_id", "left").fillna({"in_energy": 0.0, "in_n": 0})
    t = t.withColumns({"ps": F.col("in_energy") / F.nullif("in_n", F.lit(0)), "pn": (F.col("e") - F.col("in_energy")) / F.nullif(F.col("n") - F.col("in_n"), F.lit(0))})
    missing = F.col("ps").isNull() | F.col("pn").isNull()
    snr = F.when(missing, 0.0).when(F.col("pn") < 1e-12, 60.0).otherwise(10 * F.log10(F.col("ps") / F.col("pn")))
    cross = F.when(missing | (F.col("ps") < 1e-12), 0.0).otherwise(F.col("pn") / F.col("ps"))
    return t.select("recording_id", snr.alias("snr_db"), cross.alias("crosstalk_ratio"), F.when(F.col("n") > 0, F.col("in_n") / F.col("n")).otherwise(0.0).alias("speech_ratio"), F.col("pn").alias("noise_power"))


def rolling_median(values: np.ndarray, half: int) -> np.ndarray:
    """Median of each value and up to half values on either side.

    A tree of counts over the values' ranks is kept for the window; a value that enters or leaves costs as many steps
    as the number of values has bits, whatever the window's width, and so does finding the middle.
    """
    n = len(values)
    ranked = np.argsort(values, kind="stable")
    rank = np.empty(n, np.int64)
    rank[ranked] = np.arange(1, n + 1)
    rank, in_order = rank.tolist(), values[ranked].tolist()
    counts, top = [0] * (n + 1), 1 << n.bit_length() >> 1

    def change(at: int, by: int) -> None:
        while at <= n:
            counts[at] += by
            at += at & -at

    def ranked_at(k: int) -> float:
        """The value with k smaller ones in the window."""
        at, step = 0, top
        while step:
            if at + step <= n and counts[at + step] <= k:
                at += step
                k -= counts[at]
            step >>= 1
        return in_order[at]

    out = np.empty(n)
    entered = 0
    for i in range(n):
        while entered < min(n, i + half + 1):
            change(rank[entered], 1)
            entered += 1
        if i > half:
            change(rank[i - half - 1], -1)
        size = entered - max(0, i - half)
        middle = ranked_at(size // 2)
        out[i] = middle if size % 2 else (ranked_at(size // 2 - 1) + middle) / 2
    return out


def plosive_spikes(blocks: DataFrame, frame_s: float = 0.005, window_s: float = 0.2, factor: float = 3.0) -> DataFrame:
    """Frames louder than three times the median of those around them, counted per recording.

    Rolling medians are cut into runs of frames with a margin on both sides, so that a long recording is many
    groups; margin frames take part but aren't counted.
    """
    half = int(window_s / frame_s) // 2
    run = max(4096, 2 * half)
    fr = frames(blocks, frame_s)
    near = F.array_distinct(F.transform(F.array(*[F.lit(k) for k in (-half, 0, half)]), lambda k: F.floor((F.col("frame_no") + k) / run).cast("long")))
    dealt = fr.select("recording_id", F.col("frame_no").alias("n"), "power", F.explode(near).alias("run"))

    def count(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("n")
        power = rows["power"].to_numpy()
        middle = rolling_median(power, half)
        spikes = (rows["n"].to_numpy() // run == key[1].as_py()) & (middle > 1e-10) & (power > factor * middle)
        return pa.table({"recording_id": pa.array([key[0].as_py()], pa.string()), "spikes": pa.array([int(spikes.sum())], pa.int64())})

    counted = dealt.groupBy("recording_id", "run").applyInArrow(count, "recording_id string, spikes long")
    return counted.groupBy("recording_id").agg(F.sum("spikes").alias("plosive_spike_count"))


def with_halo(blocks: DataFrame, size: int) -> DataFrame:
    """blocks with ``more``, the size samples that follow each block, as far as there are any, and ``total``, the recording's samples.

    The heads of blocks are a narrow table, laid out to the blocks before them, so samples meet by (recording, block)
    and never pass a window. Blocks of a recording have the same number of samples, but for the last.
    """
    block = F.floor(F.col("start_sample") / F.col("block_no")).cast("int")  # every block before has that many samples
    reach = F.least(F.col("block_no"), F.ceil(F.lit(size) / F.greatest(block, F.lit(1))).cast("int"))
    heads = blocks.filter("block_no > 0 AND size(samples) > 0").select("recording_id", F.col("block_no").alias("from"), F.slice("samples", 1, size).alias("head"), F.explode(F.sequence(F.col("block_no") - reach, F.col("block_no") - 1)).alias("block_no"))
    heads = heads.groupBy("recording_id", "block_no").agg(F.array_sort(F.collect_list(F.struct("from", "head"))).alias("heads"))
    heads = heads.select("recording_id", "block_no", F.slice(F.flatten(F.transform("heads", lambda h: h["head"])), 1, size).alias("more"))
    total = blocks.select("recording_id", "block_no", F.size("samples").alias("n")).withColumn("total", F.sum("n").over(Window.partitionBy("recording_id"))).drop("n")
    both = blocks.join(total, ["recording_id", "block_no"]).join(heads, ["recording_id", "block_no"], "left")
    return both.withColumn("more", F.coalesce("more", F.array().cast("array<float>")))


def flat(column: pa.Array) -> tuple[np.ndarray, list[int]]:
    """All entries of an array column, and where each row's start and end."""
    lengths = np.asarray(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False), np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False), np.concatenate([[0], np.cumsum(lengths)]).tolist()


def spectra(blocks: DataFrame) -> DataFrame:
    """Sum of magnitude spectra of each block's frames (2048 samples, every 1024): (recording_id, magnitude, frames).

    A frame belongs to the block it starts in and takes what it needs of those behind. The last 1024 to 2047 samples
    start no frame, as does a tail shorter than one; a recording shorter than two hops is padded with zeros.
    """
    return _spectra(with_halo(blocks, N_FFT - 1))


def _spectra(haloed: DataFrame) -> DataFrame:
    """spectra() of blocks that have their halo."""
    return haloed.select(*HALOED).mapInArrow(_made, "recording_id string, magnitude array<double>, frames long")


def _made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spectra of blocks with the columns of HALOED, few at a time."""
    for b in (batch.slice(k, SPECTRA) for batch in batches for k in range(0, batch.num_rows, SPECTRA)):
        ids, sums, counts = [], [], []
        (x, at), (more, more_at) = flat(b.column(2)), flat(b.column(3))
        for k, (rid, start, total) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(4).to_pylist(), strict=True)):
            size = at[k + 1] - at[k]
            first, last = -(-start // HOP), min(max(1, (total - N_FFT) // HOP), -(-(start + size) // HOP))
            if first >= last:
                continue
            wave = np.concatenate([x[at[k] : at[k + 1]], more[more_at[k] : more_at[k + 1]]])
            wave = np.pad(wave, (0, max(0, (last - 1) * HOP - start + N_FFT - len(wave))))
            grid = np.lib.stride_tricks.sliding_window_view(wave, N_FFT)[first * HOP - start :: HOP][: last - first]
            ids.append(rid)
            sums.append(np.abs(np.fft.rfft(grid, axis=1)).sum(0))
            counts.append(last - first)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(sums, pa.list_(pa.float64())), pa.array(counts, pa.int64())], names=["recording_id", "magnitude", "frames"])


def _added(spectra: DataFrame, *keys: str) -> DataFrame:
    """Spectra of equal keys, the recording first, added up; a task holds one sum at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total, count = None, None, 0

        def row() -> pa.RecordBatch:
            own = [pa.array([k], f.type) for k, f in zip(key, fields, strict=True)]
            return pa.RecordBatch.from_arrays([*own, pa.array([total], pa.list_(pa.float64())), pa.array([count], pa.int64())], names=[*keys, "magnitude", "frames"])

        for b in batches:
            fields = list(b.schema)[: len(keys)]
            x = b.column(len(keys)).flatten().to_numpy().reshape(b.num_rows, -1)
            for k, (own, n) in enumerate(zip(zip(*[c.to_pylist() for c in b.columns[: len(keys)]], strict=True), b.column(len(keys) + 1).to_pylist(), strict=True)):
                if own == key:
                    total += x[k]
                    count += n
                    continue
                if key is not None:
                    yield row()
                key, total, count = own, x[k].copy(), n
        if key is not None:
            yield row()

    dealt = spectra.select(*keys, "magnitude", "frames").repartition(*keys).sortWithinPartitions(*keys)
    kinds = ", ".join(f"{k} {spectra.schema[k].dataType.simpleString()}" for k in keys)
    return dealt.mapInArrow(run, f"{kinds}, magnitude array<double>, frames long")


def _mean_of_parts(haloed: DataFrame) -> DataFrame:
    """mean_spectrum() of recordings of several blocks: first so many spectra together, so that no recording is one task's work."""
    parts = _added(_spectra(haloed).withColumn("part", F.floor(F.monotonically_increasing_id() / ADDED)), "recording_id", "part")
    return _added(parts.drop("part"), "recording_id").selectExpr("recording_id", MEAN)


def mean_spectrum(blocks: DataFrame) -> DataFrame:
    """(recording_id, magnitude: array): the mean over all frames, one number a bin. Spectra are added up as arrays."""
    haloed = store(with_halo(blocks, N_FFT - 1), "haloed")
    return _spectra(haloed.filter(ALONE)).selectExpr("recording_id", MEAN).unionByName(_mean_of_parts(haloed.filter(f"NOT ({ALONE})")))


def recording_shapes(blocks: DataFrame, rates: DataFrame, share: float = 0.85, below_db: float = 20.0) -> DataFrame:
    """spectrum_shape() of mean_spectrum(); a recording of one block has its shape where its spectrum is made."""
    haloed = store(with_halo(blocks, N_FFT - 1), "haloed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _made(batches):
            (x, at), frames = flat(b.column(1)), b.column(2).to_pylist()
            found = [_shape_of(x[at[k] : at[k + 1]] / n, share, below_db) for k, n in enumerate(frames)]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([f[k] for f in found], pa.float64()) for k in (0, 1)]], names=["recording_id", *SHAPE.names])

    one = haloed.filter(ALONE).select(*HALOED).mapInArrow(run, "recording_id string, roll_off double, width double")
    several = _mean_of_parts(haloed.filter(f"NOT ({ALONE})")).select("recording_id", _spectrum_shape(F.col("magnitude"), F.lit(share), F.lit(below_db)).alias("s"))
    return _in_hz(one.unionByName(several.select("recording_id", "s.roll_off", "s.width")), rates)


def _in_hz(shape: DataFrame, rates: DataFrame) -> DataFrame:
    hz = lambda c: F.col(c) * F.col("sample_rate") / N_FFT
    return shape.join(rates, "recording_id").select("recording_id", hz("roll_off").alias("spectral_rolloff_hz"), hz("width").alias("effective_bandwidth_hz"))


def spectrum_shape(spectrum: DataFrame, rates: DataFrame, share: float = 0.85, below_db: float = 20.0) -> DataFrame:
    """roll_off() and bandwidth() of each recording, from one pass over its spectrum."""
    shape = spectrum.select("recording_id", _spectrum_shape(F.col("magnitude"), F.lit(share), F.lit(below_db)).alias("s"))
    return _in_hz(shape.select("recording_id", "s.roll_off", "s.width"), rates)


def roll_off(spectrum: DataFrame, rates: DataFrame, share: float = 0.85) -> DataFrame:
    """First frequency at which the cumulated energy reaches a share of all; 0 without energy."""
    return spectrum_shape(spectrum, rates, share=share).drop("effective_bandwidth_hz")


def bandwidth(spectrum: DataFrame, rates: DataFrame, below_db: float = 20.0) -> DataFrame:
    """Between the first and last frequency within 20 dB of the spectrum's peak; 0 without energy."""
    return spectrum_shape(spectrum, rates, below_db=below_db).drop("spectral_rolloff_hz")


SHAPE = T.StructType([T.StructField("roll_off", T.DoubleType()), T.StructField("width", T.DoubleType())])


@F.arrow_udf(SHAPE)
def _spectrum_shape(magnitude: pa.Array, share: pa.Array, below_db: pa.Array) -> pa.Array:
    """Bins of the roll-off and of the width, from one spectrum an entry."""
    x, at = flat(magnitude)
    found = [_shape_of(x[at[k] : at[k + 1]], p, d) for k, (p, d) in enumerate(zip(share.to_pylist(), below_db.to_pylist(), strict=True))]
    return pa.StructArray.from_arrays([pa.array([f[k] for f in found], pa.float64()) for k in (0, 1)], SHAPE.names)


def _shape_of(m: np.ndarray, share: float, below_db: float) -> tuple[float, float]:
    """Bins of the roll-off and of the width of one spectrum."""
    m = m if len(m) else np.zeros(1)
    e = np.cumsum(m * m)
    level = 20 * np.log10(m + 1e-10)
    near = np.flatnonzero(level >= level.max() - below_db)
    return 0.0 if e[-1] < 1e-10 else float(np.argmax(e >= share * e[-1])), 0.0 if m.max() < 1e-10 else float(near[-1] - near[0])


@F.arrow_udf(T.DoubleType())
def _flatness(samples: pa.Array) -> pa.Array:
    out = []
    for x in samples.to_pylist():
        x = np.array(x or [], np.float64)
        if len(x) < 64:
            out.append(None)
            continue
        s = np.abs(np.fft.rfft(x[:N_FFT]))[1:]
        mean = s.mean()
        out.append(None if s.max() < 1e-10 or mean < 1e-10 else float(np.exp(np.log(s + 1e-10).mean()) / mean))
    return pa.array(out, pa.float64())


def flatness(samples: Column) -> Column:
    """Geometric over arithmetic mean of a spectrum of at most 2048 samples; 1, which means noise, if there is too little."""
    return F.coalesce(_flatness(F.slice(samples, 1, N_FFT)), F.lit(1.0))


def file_metrics(blocks: DataFrame, regions: DataFrame) -> DataFrame:
    """All microphone metrics of each recording, one row."""
    lv = levels(blocks, 0.99)
    rates = lv.select("recording_id", "sample_rate")
    out = lv.select("recording_id", "duration_s", "clipped_samples", (F.col("clip_pct") / 100).alias("clipping_ratio"), "peak_amplitude", F.col("rms_dbfs_soft").alias("rms_dbfs"))
    for part in (region_metrics(blocks, regions).drop("noise_power"), plosive_spikes(blocks), recording_shapes(blocks, rates)):
        out = out.join(part, "recording_id", "left")
    return out


def report_metrics(blocks: DataFrame, frame_s: float = 0.02, margin_db: float = 15.0) -> DataFrame:
    """Level, clipping, percentile SNR and speech share of each recording, for the quality rules."""
    return levels(blocks).join(percentile_snr(frames(blocks, frame_s), margin_db=margin_db).drop("p25"), "recording_id", "left").fillna({"snr_db": 0.0, "speech_pct": 0.0})


def speaker_metrics(blocks: DataFrame, turns: DataFrame) -> DataFrame:
    """Per speaker: SNR against the recording's own noise, others' power for its own, time under its turns."""
    all_speech = region_metrics(blocks, turns).select("recording_id", F.greatest(F.coalesce("noise_power", F.lit(0.0)), F.lit(1e-12)).alias("noise"))
    rate = blocks.groupBy("recording_id").agg(F.max("sample_rate").alias("rate"))
    own = inside_power(blocks, turns, ["recording_id", "speaker_id"])
    w = Window.partitionBy("recording_id")
    own = own.withColumns({"oe": F.sum("in_energy").over(w) - F.col("in_energy"), "on": F.sum("in_n").over(w) - F.col("in_n")})
    p = F.col("in_energy") / F.col("in_n")
    return own.join(all_speech, "recording_id").join(rate, "recording_id").select(
        "recording_id", "speaker_id", (F.col("in_n") / F.col("rate")).alias("talk_time_s"),
        (10 * F.log10(F.greatest(p, F.lit(1e-12)) / F.col("noise"))).alias("snr_db"),
        F.when((p > 1e-12) & (F.col("on") > 0), (F.col("oe") / F.col("on")) / p).otherwise(0.0).alias("crosstalk"),
    )


def speaker_audio(blocks: DataFrame, turns: DataFrame) -> DataFrame:
    """Blocks of each speaker's own samples, in turn order, renumbered as recordings ``recording/speaker``.

    The order is found on narrow rows; samples are cut and written once and joined to their new places.
    """
    held = over_blocks(blocks, turns, ["speaker_id", "turn_no"])
    cut = held.select(F.concat_ws("/", "recording_id", "speaker_id").alias("recording_id"), "turn_no", "block_no", "sample_rate", "samples")
    cut = store(cut.withColumn("piece", F.monotonically_increasing_id()), "speaker-audio")
    w = Window.partitionBy("recording_id").orderBy("turn_no", "block_no", "piece")
    before = F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = cut.select("recording_id", "turn_no", "block_no", "piece", F.size("samples").alias("n")).select("piece", (F.row_number().over(w) - 1).alias("block_no"), before.alias("start_sample"))
    return cut.drop("turn_no", "block_no").join(places, "piece").select("recording_id", "block_no", "start_sample", "sample_rate", "samples")


def energy_regions(blocks: DataFrame, frame_s: float = 0.02, margin_db: float = 15.0, floor_db: float = -55.0, gap_s: float = 0.3) -> DataFrame:
    """A voice detector without a model: runs of frames well above the quiet quarter, close runs merged."""
    fr = frames(blocks, frame_s)
    noise = percentile_snr(fr, least=1).select("recording_id", "p25")
    loud = fr.join(noise, "recording_id").withColumn("db", db(F.sqrt("power"), 1e-9)).filter((F.col("db") > F.col("p25") + margin_db) & (F.col("db") > floor_db))
    w = Window.partitionBy("recording_id").orderBy("t0")
    step = int(frame_s * 1e6)
    new = (F.col("t0") - F.lag("t0").over(w) > step + int(gap_s * 1e6)) | F.lag("t0").over(w).isNull()
    isle = loud.withColumn("k", F.sum(new.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    r = isle.groupBy("recording_id", "k").agg((F.min("t0") / 1e6).alias("start_s"), ((F.max("t0") + step) / 1e6).alias("end_s"))
    return r.select("recording_id", (F.col("k") - 1).cast("int").alias("pos"), "start_s", "end_s")


def gap_classes(blocks: DataFrame, gaps: DataFrame) -> DataFrame:
    """gaps (recording_id, start_s, end_s) with their level in dBFS, flatness and class, from their own samples.

    A gap without samples is silence. The flatness is that of its first 2048 samples; every block gives that many at most.
    """
    keyed = gaps.select("recording_id", "start_s", "end_s", F.col("start_s").alias("gap_start"), F.col("end_s").alias("gap_end"))
    parts = over_blocks(blocks, keyed, ["gap_start", "gap_end"])
    sums = parts.groupBy("recording_id", F.col("gap_start").alias("start_s"), F.col("gap_end").alias("end_s")).agg(
        F.sum(energy(F.col("samples"))).alias("e"), F.sum(F.size("samples")).alias("n"), F.array_sort(F.collect_list(F.struct("block_no", F.slice("samples", 1, N_FFT).alias("x")))).alias("heads")
    )
    first = F.slice(F.flatten(F.transform("heads", lambda h: h["x"])), 1, N_FFT)
    measured = sums.select("recording_id", "start_s", "end_s", db(F.sqrt(F.col("e") / F.col("n")), 1e-12).alias("rms_dbfs"), flatness(first).alias("flatness"))
    out = gaps.join(measured, ["recording_id", "start_s", "end_s"], "left").withColumns({"rms_dbfs": F.coalesce("rms_dbfs", F.lit(-120.0)), "flatness": F.coalesce("flatness", F.lit(1.0))})
    return out.withColumn("region_type", gap_class(F.col("rms_dbfs"), F.col("flatness"), F.lit(True)))
