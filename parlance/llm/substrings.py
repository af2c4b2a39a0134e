"""Removal of repeated word sequences with FM-indexes of shards.

A window of ``window`` words repeats if the same words also start earlier: in a document of smaller id, or earlier
in the same document. Words that a repeating window covers are removed.

Equal windows have the same least-hashed word group (their anchor) at the same place, so all windows that can be
equal meet where their anchor is sent. Word groups that many texts have come last in that order, so that a frequent
passage gives no anchor to what surrounds it. The windows that choose an anchor form its segment. Blocks of documents ask the partition that owns an anchor's hash range; it answers in the order of the
question whether a segment is an exact copy of an earlier one (all its windows repeat), the only one of its
anchor (nothing repeats), or the first of its kind beside others. Only the last go on, once each, to shards by
anchor. A shard builds an FM-index of its segments: suffix array, Burrows-Wheeler transform and a wavelet matrix
of packed bits with block counts. Segments are streamed against it from right to left by backward search; where
the matching statistics reach the threshold, the suffix interval's earliest occurrence says whether the window
repeats. Anchors with more different segments than ``BUSY`` would make a shard grow: their windows are compared
by hash in a plain aggregation instead, which Spark combines before it shuffles. What is decided by hash (equal
segments, windows of busy anchors) needs two independent 64-bit hashes to agree; words are not compared again.

Defined results: null or empty texts have no words; equal rows are documents of their own, the later ones repeat
the first; null ids come after all others; other columns are left out; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import by_range, discard, store, utf8

#: A block is full at so many words, bytes of text or texts.
BLOCK_WORDS, BLOCK_BYTES, BLOCK_TEXTS = 1_500_000, 64 << 20, 1 << 20
#: Words of an anchor.
GRAM = 5
#: Different segments of one anchor beyond which its windows are compared by hash.
BUSY = 2_000
#: First places of hashed windows are broadcast up to this many rows (about 50 bytes each).
BROADCAST_ROWS = 200_000
PARTITION_ANCHORS = 400_000
#: One in so many texts is looked at for common word groups: those in COMMON of them or more, MOST_COMMON at most.
ASKED = 16
COMMON = 8
MOST_COMMON = 100_000
SHARD_SEGMENTS = 8_000
LAST = np.iinfo(np.int64).max
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: A second hash of everything that is decided by hash, so that 128 bits have to agree.
BASE_2 = np.uint64(0xD6E8FEB86659FD93)
INVERSE_2 = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
ALONE, COPY, FIRST, SHARD, HASH = 0, 1, 2, 3, 4

BLOCK = "block long, n_words long, ids array<long>, sizes array<int>, texts binary"
ASK = "part int, block long, anchors binary, segments binary, checks binary, ids binary, docs binary, starts binary"
REPLY = "part int, block long, states binary"
OUT = "kind int, row long, id long, text binary, spans array<int>, anchor long, start int, n_words long, n_removed long, kept_sha256 string, hash long, check long"
DONE, WAITING, SEGMENT, WINDOW = 0, 1, 2, 3


def planes(values: np.ndarray) -> bytes:
    """Numbers as byte planes, which compress well."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def from_planes(data: bytes, dtype: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def mix(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ x >> np.uint64(shift)) * np.uint64(factor)
    return x ^ x >> np.uint64(31)


def blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Documents packed into rows of bounded size, stored."""
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, total, size = TaskContext.get().partitionId(), 0, 0, 0
        ids, sizes, texts = [], [], []

        def flush() -> pa.RecordBatch:
            nonlocal number, total, size
            row = [task << 36 | number << 24, total, list(ids), list(sizes), zstandard.ZstdCompressor(3).compress(b"".join(texts))]
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
            number, total, size = number + 1, 0, 0
            for x in (ids, sizes, texts):
                x.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names=[c.split()[0] for c in BLOCK.split(", ")])

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                ids.append(i)
                sizes.append(len(t))
                texts.append(t)
                total += len(t.split())
                size += len(t)
                if total >= BLOCK_WORDS or size >= BLOCK_BYTES or len(ids) >= BLOCK_TEXTS:
                    yield flush()
        if ids:
            yield flush()

    return store(rows.mapInArrow(run, BLOCK), "substring-blocks")


class Block:
    """A block's texts, the hashes of its words, its anchors and their segments."""

    def __init__(self, row: dict, window: int, common: np.ndarray):
        data = zstandard.ZstdDecompressor().decompress(row["texts"]) if sum(row["sizes"]) else b""
        ends = np.cumsum(row["sizes"]).tolist()
        self.texts = [data[b - n : b] for b, n in zip(ends, row["sizes"], strict=True)]
        self.ids = np.array([LAST if i is None else i for i in row["ids"]], np.int64)
        numbers: dict[bytes, int] = {}
        parts = []
        for t in self.texts:
            words = t.split()
            for w in {w for w in words if w not in numbers}:
                numbers[w] = len(numbers)
            parts.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        self.n_words = np.array([len(p) for p in parts], np.int64)
        tokens = np.concatenate(parts) if parts else np.empty(0, np.int64)
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in numbers], np.uint64) if numbers else np.empty(0, np.uint64)
        n = len(tokens)
        self.doc = np.repeat(np.arange(len(parts)), self.n_words)
        stop = np.cumsum(self.n_words)
        self.begin, self.stop = np.repeat(stop - self.n_words, self.n_words), np.repeat(stop, self.n_words)
        # prefix sums of hash * BASE**position, so that the hash of any span is one difference
        self.sums, self.back = self.sums_of(hashes[tokens] if n else hashes, BASE, INVERSE)
        at = np.arange(n)
        fits = at + window <= self.stop
        starts = np.flatnonzero(fits)
        self.anchors = self.left = self.right = np.empty(0, np.int64)
        if len(starts):
            grams = self.span(at[: n - GRAM + 1], at[: n - GRAM + 1] + GRAM)
            rank = grams >> np.uint64(1)
            if len(common):  # groups that many texts have come last
                found = common[np.minimum(np.searchsorted(common, grams), len(common) - 1)] == grams
                rank |= found.astype(np.uint64) << np.uint64(63)
            view = np.lib.stride_tricks.sliding_window_view(rank, window - GRAM + 1)
            chosen = np.concatenate([c + view[c].argmin(1) for c in np.array_split(starts, len(starts) // 200_000 + 1)])
            # the windows that choose an anchor follow each other
            self.anchors, first, count = np.unique(chosen, return_index=True, return_counts=True)
            self.left, self.right = starts[first], starts[first + count - 1] + window
        anchors = self.anchors
        # anchors have the least hashes, so they are hashed again to lie evenly over the ranges
        self.keys = mix(self.span(anchors, anchors + GRAM) ^ BASE)
        self.segments = mix(self.span(self.left, self.right) + (anchors - self.left).astype(np.uint64) * np.uint64(64) + (self.right - anchors).astype(np.uint64))
        again = np.array([xxhash.xxh64_intdigest(w, 1) for w in numbers], np.uint64) if numbers else hashes
        self.sums_2, self.back_2 = self.sums_of(again[tokens] if n else again, BASE_2, INVERSE_2)
        self.checks = self.check(self.left, self.right)
        # rows of equal (anchor, segment), the earliest first
        self.order = np.lexsort((self.anchors, self.ids[self.doc[anchors]], self.checks, self.segments, self.keys)) if len(anchors) else anchors
        k, s, c = self.keys[self.order], self.segments[self.order], self.checks[self.order]
        self.new = np.r_[True, (k[1:] != k[:-1]) | (s[1:] != s[:-1]) | (c[1:] != c[:-1])] if len(k) else np.empty(0, bool)

    @staticmethod
    def sums_of(hashes: np.ndarray, base: np.uint64, inverse: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        n = len(hashes)
        power = np.cumprod(np.r_[np.uint64(1), np.full(n, base, np.uint64)])
        back = np.cumprod(np.r_[np.uint64(1), np.full(n, inverse, np.uint64)])
        return np.r_[np.uint64(0), np.cumsum(hashes * power[:n], dtype=np.uint64)], back

    def check(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self.sums_2[b] - self.sums_2[a]) * self.back_2[a])

    def span(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self.sums[b] - self.sums[a]) * self.back[a])


def common_grams(docs: DataFrame, window: int, id_col: str, text_col: str) -> np.ndarray:
    """Sorted hashes of the word groups that many texts have, by a count over a part of the texts.

    They only choose which group is an anchor, never the result.
    """
    stored = blocks(docs.filter(F.pmod(F.xxhash64(F.col(text_col)), F.lit(ASKED)) == 0), id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                b = Block(row, window, np.empty(0, np.uint64))
                at = np.flatnonzero(np.arange(len(b.doc)) + GRAM <= b.stop)
                grams, doc = b.span(at, at + GRAM), b.doc[at]
                order = np.lexsort((grams, doc))
                g, d = grams[order], doc[order]
                once = g[np.r_[True, (g[1:] != g[:-1]) | (d[1:] != d[:-1])]] if len(g) else g
                found, n = np.unique(once, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])

    counted = store(stored.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= COMMON), "substring-common")
    total, least = 0, None
    for r in sorted(counted.groupBy("n").count().collect(), reverse=True):  # one row for each different count
        total += r["count"]
        if total > MOST_COMMON:
            break
        least = r["n"]
    found = [r["h"] for r in counted.filter(F.col("n") >= least).select("h").collect()] if least else []
    discard(stored)
    return np.sort(np.array(found, np.int64).view(np.uint64))


def ask(stored: DataFrame, window: int, bits: int, common: np.ndarray) -> DataFrame:
    names = [c.split()[0] for c in ASK.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                b = Block(row, window, common)
                at = b.order[b.new]
                pos = b.anchors[at]
                columns = [b.keys[at], b.segments[at], b.checks[at], b.ids[b.doc[pos]], b.doc[pos].astype("<u4"), (pos - b.begin[pos]).astype("<u4")]
                parts, cut = by_range(columns[0], bits)
                values = [parts, [row["block"]] * len(parts)] + [[planes(np.ascontiguousarray(c[x])) for x in cut] for c in columns]
                kinds = [pa.int32(), pa.int64()] + [pa.binary()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds, strict=True)], names=names)

    return stored.mapInArrow(run, ASK)


def answer(asked: DataFrame) -> DataFrame:
    """The state of every segment that a block asked about, in the order of the question; stored."""

    def run(group: pa.Table) -> pa.Table:
        get = lambda c, t: [from_planes(x, t) for x in group.column(c).to_pylist()]
        anchors = get("anchors", "<u8")
        sizes = [len(x) for x in anchors]
        keys, segments, checks, ids = np.concatenate(anchors), np.concatenate(get("segments", "<u8")), np.concatenate(get("checks", "<u8")), np.concatenate(get("ids", "<i8"))
        rows = np.repeat(np.array(group.column("block").to_pylist(), np.int64), sizes) + np.concatenate(get("docs", "<u4"))
        order = np.lexsort((np.concatenate(get("starts", "<u4")), rows, ids, checks, segments, keys))
        k, s, c = keys[order], segments[order], checks[order]
        new_key = np.r_[True, k[1:] != k[:-1]]
        first = new_key | np.r_[True, (s[1:] != s[:-1]) | (c[1:] != c[:-1])]
        which = np.cumsum(new_key) - 1
        kinds = np.bincount(which, first)[which]  # different segments of the row's anchor
        states = np.empty(len(order), np.uint8)
        states[order] = np.where(~first, COPY, np.where(kinds == 1, FIRST, np.where(kinds > BUSY, HASH, SHARD)))
        cut = np.split(states, np.cumsum(sizes)[:-1])
        return pa.table([group.column("part"), group.column("block"), pa.array([x.tobytes() for x in cut], pa.binary())], names=["part", "block", "states"])

    return store(asked.groupBy("part").applyInArrow(run, REPLY), "substring-states")


def finish(text: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, str]:
    """(words, removed words, digest of the kept words) of a text without the words of some spans."""
    words = text.split()
    gone = np.zeros(len(words) + 1, np.int64)
    for a, b in spans:
        gone[a] += 1
        gone[b] -= 1
    keep = np.cumsum(gone[:-1]) == 0
    kept = b" ".join([words[i] for i in np.flatnonzero(keep)] if spans else words)
    return len(words), int((~keep).sum()) if len(words) else 0, hashlib.sha256(kept).hexdigest()


def settle(stored: DataFrame, replies: DataFrame, window: int, common: np.ndarray) -> DataFrame:
    """Finished documents; waiting ones with what is known; segments for shards; windows for hashing. Stored."""
    names = [c.split()[0] for c in OUT.split(", ")]
    kinds = dict(zip(names, [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()], strict=True))

    def table(kind: int, size: int, **columns) -> pa.Table:
        return pa.table([pa.array(columns[c], t) if c in columns else pa.array(np.full(size, kind, np.int32)) if c == "kind" else pa.nulls(size, t) for c, t in kinds.items()], names=names)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return table(DONE, 0)
        row = left.to_pylist()[0]
        b = Block(row, window, common)
        told = sorted(zip(right.column("part").to_pylist(), right.column("states").to_pylist(), strict=True))
        entry = np.concatenate([np.frombuffer(x, np.uint8) for _, x in told]) if told else np.empty(0, np.uint8)
        state = np.empty(len(b.anchors), np.uint8)
        if len(entry):
            state[b.order] = np.where(b.new, entry[np.cumsum(b.new) - 1], COPY)
        doc, first = b.doc[b.anchors], b.begin[b.anchors]
        copies = np.flatnonzero(state == COPY)
        spans: dict[int, list[tuple[int, int]]] = {}
        for d, x, y in zip(doc[copies].tolist(), (b.left - first)[copies].tolist(), (b.right - first)[copies].tolist(), strict=True):
            spans.setdefault(d, []).append((x, y))
        waits = np.unique(doc[(state == SHARD) | (state == HASH)])
        is_waiting = np.zeros(len(b.texts), bool)
        is_waiting[waits] = True
        shown = np.where(b.ids == LAST, None, b.ids).tolist() if any(i is None for i in row["ids"]) else b.ids.tolist()
        now = np.flatnonzero(~is_waiting).tolist()
        ends = [finish(b.texts[d], spans.get(d, [])) for d in now]
        done = table(
            DONE, len(now), row=[row["block"] + d for d in now], id=[shown[d] for d in now],
            n_words=[e[0] for e in ends], n_removed=[e[1] for e in ends], kept_sha256=[e[2] for e in ends],
        )
        later = waits.tolist()
        waiting = table(
            WAITING, len(later), row=[row["block"] + d for d in later], id=[shown[d] for d in later], text=[b.texts[d] for d in later],
            spans=[[x for s in spans.get(d, []) for x in s] for d in later],
        )
        at = np.flatnonzero(state == SHARD)
        words = {d: b.texts[d].split() for d in np.unique(doc[at]).tolist()}
        lo, hi = (b.left - first)[at], (b.right - first)[at]
        segments = table(
            SEGMENT, len(at), row=row["block"] + doc[at], id=b.ids[doc[at]], anchor=b.keys[at].view(np.int64), start=lo.astype(np.int32),
            text=[b" ".join(words[d][x:y]) for d, x, y in zip(doc[at].tolist(), lo.tolist(), hi.tolist(), strict=True)],
        )
        busy = np.flatnonzero(state == HASH)
        n = np.maximum(b.right[busy] - b.left[busy] - window + 1, 0)
        starts = np.repeat(b.left[busy] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        starts = np.unique(starts).astype(np.int64)
        windows = table(WINDOW, len(starts), row=row["block"] + b.doc[starts], id=b.ids[b.doc[starts]], start=(starts - b.begin[starts]).astype(np.int32), hash=b.span(starts, starts + window).view(np.int64), check=b.check(starts, starts + window).view(np.int64))
        return pa.concat_tables([done, waiting, segments, windows])

    return store(stored.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, OUT), "substring-parts")


class FMIndex:
    """An FM-index of segments of numbered words (1 and up), each ended by a mark of its own."""

    def __init__(self, segments: list[np.ndarray]):
        sizes = np.array([len(s) for s in segments], np.int64)
        m = len(sizes)
        text = np.zeros(int(sizes.sum()) + m, np.int64)
        stops = np.cumsum(sizes + 1) - 1
        inside = np.ones(len(text), bool)
        inside[stops] = False
        text[inside] = np.concatenate(segments)
        self.n, self.m, self.text = len(text), m, text
        self.segment = np.repeat(np.arange(m), sizes + 1)
        # marks are smaller than words and differ from each other, so no match crosses one
        rank = np.where(inside, text + m, self.segment)
        h = 1
        while True:
            order = np.argsort(rank * (self.n + m + int(text.max()) + 2) + np.r_[rank[h:], np.zeros(min(h, self.n), np.int64)][: self.n], kind="stable")
            key = rank[order] * (self.n + m + int(text.max()) + 2) + np.r_[rank[h:], np.zeros(min(h, self.n), np.int64)][: self.n][order]
            new = np.r_[True, key[1:] != key[:-1]]
            rank = np.empty(self.n, np.int64)
            rank[order] = np.cumsum(new) - 1
            if new.all():
                break
            h *= 2
        self.suffixes = order
        bwt = text[order - 1]  # the mark before a segment's first word; which one does not matter
        self.sigma = int(text.max()) + 1
        counts = np.bincount(text, minlength=self.sigma)
        self.first = np.r_[0, np.cumsum(counts)[:-1]]
        self._wavelet(bwt)

    def _wavelet(self, symbols: np.ndarray) -> None:
        """Bits of the symbols, the highest first, each level ordered by the bits above; packed in 64s with counts before."""
        self.levels = max(1, int(self.sigma - 1).bit_length())
        self.words, self.before, self.zeros = [], [], []
        every = np.arange(self.sigma)
        base = np.zeros(self.sigma, np.int64)
        for level in range(self.levels - 1, -1, -1):
            bit = symbols >> level & 1
            packed = np.packbits(np.r_[bit, np.zeros(64 - len(bit) % 64, np.int64)].astype(bool), bitorder="little").view(np.uint64)
            self.words.append(packed)
            self.before.append(np.r_[0, np.cumsum(np.bitwise_count(packed).astype(np.int64))])
            self.zeros.append(int(len(bit) - bit.sum()))
            k = len(self.words) - 1
            ones = self._ones(k, base)
            base = np.where(every >> level & 1, self.zeros[k] + ones, base - ones)
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])
        self.base = base

    def _ones(self, k: int, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[k][word] + np.bitwise_count(self.words[k][word] & low)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol is among the first at symbols of the transform."""
        for k in range(self.levels):
            ones = self._ones(k, at)
            at = np.where(symbol >> (self.levels - 1 - k) & 1, self.zeros[k] + ones, at - ones)
        return at - self.base[symbol]

    def back(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: the interval of symbol and what [lo, hi) stands for."""
        both = self.rank(np.r_[symbol, symbol], np.r_[lo, hi])
        return self.first[symbol] + both[: len(symbol)], self.first[symbol] + both[len(symbol) :]

    def groups(self, depth: int) -> np.ndarray:
        """Bounds of the suffix intervals that share their first depth symbols: starts, with n at the end."""
        a = self.suffixes
        same = np.ones(self.n - 1, bool)
        for d in range(depth):
            x, y = np.minimum(a[1:] + d, self.n - 1), np.minimum(a[:-1] + d, self.n - 1)
            same &= (self.text[x] == self.text[y]) & (self.text[x] > 0)
        return np.r_[0, np.flatnonzero(~same) + 1, self.n]

    def stream(self, streams: list[np.ndarray], depth: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(stream, start, lo, hi) for each place where matching statistics reach depth: the window's suffix interval.

        All streams advance together, from right to left. After a window is reported, its interval widens to that
        of one word less, so that the next step asks for the next window. Where a step finds nothing, no window
        holds both that word and the last one matched: the search starts again just before the latter. A symbol
        of 0 or beyond the index's is one that the index does not have.
        """
        bounds = self.groups(depth - 1)
        stops = np.cumsum([0, *(len(s) for s in streams)])
        flat = np.concatenate([*streams, np.zeros(1, np.int64)])
        pos = np.array([len(s) - 1 for s in streams], np.int64)
        size = np.zeros(len(streams), np.int64)
        lo, hi = np.zeros(len(streams), np.int64), np.full(len(streams), self.n, np.int64)
        live = np.flatnonzero(pos + 1 >= depth)
        while len(live):
            c = flat[stops[live] + pos[live]]
            ok = (c > 0) & (c < self.sigma)
            a, b = self.back(np.where(ok, c, 0), lo[live], hi[live])
            ok &= a < b
            hit, miss = live[ok], live[~ok]
            lo[hit], hi[hit] = a[ok], b[ok]
            size[hit] += 1
            pos[hit] -= 1
            full = hit[size[hit] == depth]
            if len(full):
                yield full, pos[full] + 1, lo[full].copy(), hi[full].copy()
                g = np.searchsorted(bounds, lo[full], "right") - 1
                lo[full], hi[full] = bounds[g], bounds[g + 1]
                size[full] = depth - 1
            pos[miss] += np.maximum(size[miss] - 1, -1)
            lo[miss], hi[miss], size[miss] = 0, self.n, 0
            live = live[(pos[live] >= 0) & (pos[live] + 1 + size[live] >= depth)]


def shard_windows(texts: list[bytes], ids: np.ndarray, rows: np.ndarray, starts: np.ndarray, window: int) -> Iterator[tuple[int, int]]:
    """(row, start) of the windows of a shard's segments that also start earlier in it."""
    words = [t.split() for t in texts]
    codes = pd.factorize(np.array([w for ws in words for w in ws], object))[0].astype(np.int64) + 1
    segments = np.split(codes, np.cumsum([len(w) for w in words])[:-1])
    index = FMIndex(segments)
    begin = np.cumsum([0, *(len(s) + 1 for s in segments)])[:-1]
    segment = index.segment[index.suffixes]
    place = starts[segment] + index.suffixes - begin[segment]
    # what comes earlier, as one number for each suffix
    earlier = np.empty(index.n, np.int64)
    order = np.lexsort((place, rows[segment], ids[segment]))
    new = np.r_[True, (place[order][1:] != place[order][:-1]) | (rows[segment][order][1:] != rows[segment][order][:-1])]
    earlier[order] = np.cumsum(new) - 1
    bounds = index.groups(window)
    least = np.minimum.reduceat(earlier, bounds[:-1])
    rank_at = np.empty(index.n, np.int64)
    rank_at[index.suffixes] = earlier
    for stream, start, lo, _ in index.stream(segments, window):
        first = least[np.searchsorted(bounds, lo, "right") - 1]
        again = first < rank_at[begin[stream] + start]
        yield from zip(rows[stream[again]].tolist(), (starts[stream] + start)[again].tolist(), strict=True)


def repeated(parts: DataFrame, window: int) -> DataFrame:
    """(row, start) of repeating windows that shards and the busy anchors' hashes find."""
    segments = parts.filter(F.col("kind") == SEGMENT).select("row", "id", "anchor", "start", "text")
    shards = max(1, math.ceil(segments.count() / SHARD_SEGMENTS))

    def run(group: pa.Table) -> pa.Table:
        get = lambda c: group.column(c).to_numpy(zero_copy_only=False)
        found = set(shard_windows(group.column("text").to_pylist(), get("id"), get("row"), get("start").astype(np.int64), window))
        return pa.table([pa.array([x[k] for x in found], t) for k, t in enumerate((pa.int64(), pa.int32()))], names=["row", "start"])

    dealt = segments.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    of_shards = dealt.groupBy("shard").applyInArrow(run, "row long, start int")
    windows = parts.filter(F.col("kind") == WINDOW).select("hash", "check", "id", "row", "start")
    if not windows.limit(1).count():
        return of_shards
    first = windows.groupBy("hash", "check").agg(F.min(F.struct("id", "row", "start")).alias("first"), F.count("*").alias("n")).filter("n > 1").select("hash", "check", "first")
    first = store(first, "substring-first")
    # a frequent window has many rows: without an exchange by hash none of them meet; beyond the limit Spark splits them
    first = F.broadcast(first) if first.count() <= BROADCAST_ROWS else first
    again = windows.join(first, ["hash", "check"]).filter(F.struct("id", "row", "start") > F.col("first")).select("row", "start")
    return of_shards.unionByName(again)


def deduplicate(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_removed and the kept words' digest of every document."""
    stored = blocks(docs, id_col, text_col)
    words = stored.agg(F.sum("n_words")).first()[0] or 0
    bits = max(4, math.ceil(math.log2(max(1, words / 8 / PARTITION_ANCHORS))))
    common = common_grams(docs, window, id_col, text_col)
    replies = answer(ask(stored, window, bits, common))
    parts = settle(stored, replies, window, common)
    discard(stored)
    discard(replies)
    more = store(repeated(parts, window).groupBy("row").agg(F.collect_set("start").alias("starts")), "substring-repeats")
    waiting = parts.filter(F.col("kind") == WAITING).select("row", "id", "text", "spans").join(more, "row", "left").select("id", "text", "spans", "starts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [finish(t, [*zip(s[::2], s[1::2], strict=True), *((a, a + window) for a in x or ())]) for t, s, x in zip(utf8(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([e[k] for e in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string())))], names=["id", "n_words", "n_removed", "kept_sha256"])

    last = waiting.mapInArrow(run, "id long, n_words long, n_removed long, kept_sha256 string")
    return parts.filter(F.col("kind") == DONE).select("id", "n_words", "n_removed", "kept_sha256").unionByName(last)
