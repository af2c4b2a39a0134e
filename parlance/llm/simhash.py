"""SimHash fingerprints, and links between them through covering bit masks.

A fingerprint has 64 bits: bit b is set if it is set in more than half of the hashes of a text's word shingles.
Two fingerprints are linked if they differ in at most ``radius`` bits. For radius r every bit position gets a
nonzero vector of r+1 bits; the mask of a nonzero vector v keeps the positions whose vectors have odd overlap
with v. The vectors of r differing positions never span the space, so some v is orthogonal to all of them and
its mask keeps none: every pair within the radius is equal under one of the 2**(r+1)-1 masks, without exception.

Links are sought between distinct fingerprints only, so copies cost nothing. Fingerprints that share a masked
value are compared in one task; masked values that too many fingerprints share are masked again, by a covering
of the bits that their mask left out, until the fingerprints in one bucket are few because little is left to
differ in. A bucket gives a star for each of its connected parts, never all its pairs. A radius beyond 3, which needs many
masks, first connects what is within 3 and then only seeks links between what is still apart. Components are found by
label propagation with pointer jumping over tables in the shared folder.

Defined results: a null or empty text has fingerprint zero, which is linked like any other; a text of fewer
words than a shingle is one shingle; repeated rows each get their own result; a null id takes part but is never
a component's id unless all are null; other columns are left out; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlance.llm.common import by_range, discard, pieces_of, store, trimmed, utf8

ALL = (1 << 64) - 1
#: Fingerprints under one masked value beyond which it is masked again.
BUCKET = 2048
#: One in so many fingerprints is counted to find such values; the count only chooses the way, not the result.
COUNTED = 8
#: A larger radius is sought among what this one has connected.
NEAR = 3
#: Buckets cannot be large from this level on: their masks leave few bits open.
LAST_LEVEL = 2
#: Masks of larger radii take their vectors in such steps, by which every mask keeps about half of the bits.
STRIDE = {4: 4, 5: 10, 6: 30}
#: Neighbours behind each text that a round proposes, and drawn orders of them.
NEIGHBOURS, DRAWN = 4, 2
#: Texts that ask for one shingle: up to so many are proposed as pairs at once, more as neighbours first.
FEW = 16
#: Of word hashes: an odd number and what undoes it modulo 2**64.
ODD = 0x9E3779B97F4A7C15
BACK = pow(ODD, -1, 1 << 64)
SPACE = re.compile(rb"[\x20\x09-\x0D]")
IN_WORD = bytes(not SPACE.match(bytes([b])) for b in range(256))
#: Bytes as numbers above zero, capital letters as small ones; UTF-8 has no byte 255.
NUMBER = bytes(min(255, bytes([b]).lower()[0] + 1) for b in range(256))
#: Bytes of asked shingles that are put in order at a time.
RANGE = 8 << 20
#: Columns of a parity.
PARITY = ("s0", "s1", "s2", "s3")
#: One in so many texts is looked at for common shingles: those in COMMON of them or more, MOST_COMMON at most.
ASKED = 16
COMMON = 3
MOST_COMMON = 100_000


def shingles(text: bytes, shingle: int) -> np.ndarray:
    """Hashes of a text's word shingles in their order, lower-cased from A to Z; none of a text without words."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1][:n].tolist()
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[i:j], 42) for i, j in zip(starts, stops, strict=True)), np.uint64, n)


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word in order, lower-cased from A to Z, whatever stands around it.

    Bytes are summed up with powers of an odd number, and each sum is taken back to its word's start.
    """
    inside = np.frombuffer((b" " + text + b" ").translate(IN_WORD), np.uint8)
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, stops = edges[::2], edges[1::2]
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(np.frombuffer(text.translate(NUMBER), np.uint8).astype(np.uint64) * powers(ODD, len(text)), out=sums[1:])
    return (sums[stops] - sums[starts]) * powers(BACK, len(text))[starts]


@functools.cache
def power_table(base: int, size: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, base, np.uint64), dtype=np.uint64)])


def powers(base: int, size: int) -> np.ndarray:
    """The first powers of a number modulo 2**64."""
    return power_table(base, 1 << 20)[:size] if size <= 1 << 20 else power_table.__wrapped__(base, size)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ x >> np.uint64(29)


def word_shingles(text: bytes, shingle: int) -> np.ndarray:
    """As shingles(), with hashes that take no call for each of them: those of the words, combined by their places."""
    parts, start = [], 0
    while len(text) - start > 1 << 20:  # a long text in parts, cut between words
        found = SPACE.search(text, start + (1 << 20) - 1)
        stop = found.end() if found else len(text)
        parts.append(word_hashes(text[start:stop]))
        start = stop
    of_words = mixed(np.concatenate([*parts, word_hashes(text[start:])]))
    if not len(of_words):
        return np.empty(0, np.uint64)
    width = min(shingle, len(of_words))
    n = len(of_words) - width + 1
    found = of_words[:n].copy()
    for k in range(1, width):
        found *= np.uint64(ODD)
        found += of_words[k : k + n]
    return mixed(found)


def distinct(hashes: np.ndarray) -> np.ndarray:
    """Sorted, each once."""
    own = np.sort(hashes)
    return own[np.r_[True, own[1:] != own[:-1]]] if len(own) else own


def print_of(hashes: np.ndarray) -> int:
    """64 bits of a text's shingle hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 65536):  # a long text in parts
        ones += np.unpackbits(hashes[a : a + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(text: bytes, shingle: int) -> int:
    """64 bits of a text, lower-cased from A to Z."""
    return print_of(shingles(text, shingle))


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, digest) of every document; fp is the fingerprint as a signed long, digest the text's MD5."""
    rows = docs.select(F.col(id_col).alias("id"), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("digest"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (p for batch in batches for p in pieces_of(batch)):
            fps = np.array([fingerprint(t, shingle) for t in utf8(b.column(2))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps), b.column(1)], names=["id", "fp", "digest"])

    return rows.mapInArrow(trimmed(run), f"id {rows.schema['id'].dataType.simpleString()}, fp long, digest string")


def covering(open_bits: int, radius: int) -> list[int]:
    """Masks over the open bits such that any set of at most radius of them is left out by one of the masks."""
    positions = [b for b in range(64) if open_bits >> b & 1]
    vectors, step = 1 << radius + 1, STRIDE.get(radius, 1)
    masks = []
    for v in range(1, vectors):
        masks.append(sum(1 << b for k, b in enumerate(positions) if ((k * step % (vectors - 1) + 1) & v).bit_count() & 1))
    return masks


def mask_of(table: int, level: int, radius: int) -> int:
    """The bits that a table of a level fixes; table numbers are digits in base 2**(radius+1)-1, the first level first."""
    width = (1 << radius + 1) - 1
    mask = 0
    for k in range(level, -1, -1):
        mask |= covering(ALL & ~mask, radius)[table // width**k % width]
    return mask


def masked(rows: DataFrame, level: int, radius: int) -> DataFrame:
    """(t, key, fp, label) under every mask of a level; from the second level on, rows carry the table t they come from."""
    width = (1 << radius + 1) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks: dict[int, np.uint64] = {}
        for b in batches:
            fps, labels = (b.column(c).to_numpy(zero_copy_only=False) for c in ("fp", "label"))
            froms = b.column("t").to_numpy(zero_copy_only=False) if level else np.zeros(len(fps), np.int32)
            for parent in np.unique(froms).tolist():
                own, marks = fps[froms == parent], pa.array(labels[froms == parent])
                for k in range(width):
                    t = parent * width + k
                    if t not in masks:
                        masks[t] = np.uint64(mask_of(t, level, radius))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), t, np.int32)), pa.array((own.view(np.uint64) & masks[t]).view(np.int64)), pa.array(own), marks], names=["t", "key", "fp", "label"])

    return rows.mapInArrow(run, "t int, key long, fp long, label long")


def parts_of(fps: np.ndarray, radius: int) -> Iterator[np.ndarray]:
    """Connected parts of a bucket of distinct fingerprints that have more than one, as places in it."""
    left = np.arange(len(fps))
    while len(left) > 1:
        front, members, left = [left[0]], [left[:1]], left[1:]
        while front and len(left):
            near = np.bitwise_count(fps[left] ^ fps[front.pop()]) <= radius
            if near.any():
                got = left[near]
                members.append(got)
                front.extend(got)
                left = left[~near]
        if len(members) > 1:
            yield np.concatenate(members)


def whole_runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[np.ndarray]:
    """Sorted rows of whole numbers, cut only where the first columns, so many as keys, change."""
    held: list[np.ndarray] = []
    for batch in batches:
        rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], 1)
        if not len(rows):
            continue
        cut = np.flatnonzero((rows[:, :keys] != rows[-1, :keys]).any(1))
        cut = int(cut[-1]) + 1 if len(cut) else 0
        if held and (cut or (held[-1][-1, :keys] != rows[0, :keys]).any()):
            yield np.concatenate([*held, rows[:cut]])
            held = [rows[cut:]]
        elif held:
            held.append(rows)
        else:
            if cut:
                yield rows[:cut]
            held = [rows[cut:]]
    if held:
        yield np.concatenate(held)


def bucket_links(entries: DataFrame, radius: int) -> DataFrame:
    """(a, b) of labels: a star for each connected part of a bucket, over the labels in it.

    Buckets are runs of equal (t, key) in sorted partitions.
    """

    def links(rows: np.ndarray) -> pa.RecordBatch:
        new = np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(1)]
        at = np.flatnonzero(new)
        size = np.diff(np.r_[at, len(rows)])
        fps, labels = np.ascontiguousarray(rows[:, 2]).view(np.uint64), rows[:, 3]
        twos = at[size == 2]
        near = twos[(np.bitwise_count(fps[twos] ^ fps[twos + 1]) <= radius) & (labels[twos] != labels[twos + 1])]
        a, b = [labels[near]], [labels[near + 1]]
        for s, n in zip(at[size > 2].tolist(), size[size > 2].tolist(), strict=True):
            for members in parts_of(fps[s : s + n], radius):
                own = np.unique(labels[s + members])
                a.append(own[1:])
                b.append(np.full(len(own) - 1, own[0]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b)], names=["a", "b"])

    dealt = entries.repartition("t", "key").sortWithinPartitions("t", "key")
    return dealt.mapInArrow(lambda batches: map(links, whole_runs(batches, 2)), "a long, b long")


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """Edges (a, b) between labels that connect exactly the distinct fingerprints within the radius, stored.

    distinct: (fp, label); fingerprints of one label are taken as connected already.
    """
    found: DataFrame | None = None
    rows = distinct.select("fp", "label")
    for level in range(LAST_LEVEL + 1):
        entries = masked(rows, level, radius)
        hot = None
        if level < LAST_LEVEL:
            counted = masked(rows.filter(F.pmod(F.xxhash64("fp"), F.lit(COUNTED)) == 0), level, radius)
            hot = store(counted.groupBy("t", "key").count().filter(F.col("count") > BUCKET // COUNTED).select("t", "key"), "simhash-hot")
            hot = hot if hot.limit(1).count() else None
        cold = entries if hot is None else entries.join(hot, ["t", "key"], "left_anti")
        got = store(bucket_links(cold.select("t", "key", "fp", "label"), radius).distinct(), "simhash-links")
        found = got if found is None else found.unionByName(got)
        if hot is None:
            break
        rows = store(entries.join(hot, ["t", "key"]).select("t", "fp", "label"), "simhash-again")
    return found


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node with an edge; the label is the smallest node of its component.

    edges: (a, b), a stored table. Each round takes the least label of the neighbours and then the label's label.
    """
    both = store(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = store(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    while True:
        least = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        stepped = store(labels.join(least, "node").select("node", F.least("label", "near").alias("label"), (F.col("near") < F.col("label")).alias("moved")), "labels")
        if not stepped.filter("moved").limit(1).count():
            return labels
        up = stepped.select(F.col("node").alias("label"), F.col("label").alias("above"))
        labels = store(stepped.join(up, "label").select("node", F.col("above").alias("label")), "labels")


def linked(prints: DataFrame, radius: int = 3) -> DataFrame:
    """(fp, component_id) of all distinct fingerprints of a stored table with id and fp, stored."""
    classes = store(prints.groupBy("fp").agg(F.min("id").alias("first")), "simhash-classes")
    edges = links(classes.select("fp", F.col("fp").alias("label")), min(radius, NEAR))
    if radius > NEAR:
        # what few masks connect goes into the many masks under one label, so that a large group gives few edges
        near = components(edges)
        labelled = classes.select("fp").join(near, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("label", "fp").alias("label"))
        edges = store(edges.unionByName(links(store(labelled, "simhash-labelled"), radius)), "simhash-edges")
    labels = components(edges)
    named = store(labels.join(classes, F.col("node") == F.col("fp")).select("fp", "label", "first"), "simhash-named")
    tops = named.groupBy("label").agg(F.min("first").alias("component_id"))
    joined = store(named.join(tops, "label").select("fp", "component_id"), "simhash-joined")
    return store(classes.join(joined, "fp", "left").select("fp", F.coalesce("component_id", "first").alias("component_id")), "simhash-components")


def groups(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digest, fp, component_id) of every document."""
    prints = store(fingerprints(docs, shingle, id_col, text_col), "simhash-prints")
    return prints.join(linked(prints, radius), "fp").select("id", "digest", "fp", "component_id")


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


@F.arrow_udf(T.BooleanType())
def similar(a: pa.Array, b: pa.Array, shingle: pa.Array, least: pa.Array) -> pa.Array:
    """Whether the Jaccard similarity of two texts' word shingles is at least a value."""

    def cut(text: bytes, n: int) -> set[bytes]:
        w = text.lower().split()
        return {b" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))}

    def one(x: bytes, y: bytes, n: int, s: float) -> bool:
        p, q = cut(x, n), cut(y, n)
        both = len(p & q)
        return both >= s * (len(p) + len(q) - both)

    return pa.array([one(x, y, n, s) for x, y, n, s in zip(utf8(a), utf8(b), shingle.to_pylist(), least.to_pylist(), strict=True)], pa.bool_())


def common_shingles(docs: DataFrame, shingle: int, text_col: str) -> np.ndarray:
    """Hashes of the shingles that many texts have, the rarest first, by a count over a part of the texts.

    They only choose the order in which shingles are asked for, never the result.
    """
    rows = docs.select(F.col(text_col).alias("text")).filter(F.pmod(F.xxhash64("text"), F.lit(ASKED)) == 0).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (p for batch in batches for p in pieces_of(batch)):
            found = [distinct(word_shingles(t, shingle)).view(np.int64) for t in utf8(b.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*found, np.empty(0, np.int64)]))], names=["h"])

    counted = store(rows.mapInArrow(trimmed(run), "h long").groupBy("h").count().filter(F.col("count") >= COMMON), "near-common")
    total, least = 0, None
    for r in sorted(counted.groupBy("count").agg(F.count("*").alias("n")).collect(), reverse=True):
        total += r["n"]
        if total > MOST_COMMON:
            break
        least = r["count"]
    found = sorted((r["count"], r["h"]) for r in counted.filter(F.col("count") >= least).collect()) if least else []
    return np.array([h for _, h in found], np.int64).view(np.uint64)


def asked_shingles(hashes: np.ndarray, common: np.ndarray, rank: np.ndarray, similarity: float) -> np.ndarray:
    """The first of a sorted set of shingles in an order that all texts share; similar sets have one of these in common.

    Sets x and y of that similarity share at least ceil(similarity * n) of the n shingles of either, so they cannot
    miss each other within the first n - ceil(similarity * n) + 1. common is sorted, rank is its places in the order.
    """
    n = len(hashes)
    most = n - math.ceil(similarity * n - 1e-9) + 1
    if not len(common):
        return hashes[:most]
    at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
    late = common[at] == hashes
    rare = hashes[~late][:most]
    if len(rare) == most:
        return rare
    return np.concatenate([rare, hashes[late][np.argsort(rank[at[late]], kind="stable")[: most - len(rare)]]])


def parity(hashes: np.ndarray) -> np.ndarray:
    """256 bits of a set of hashes: each flips one. Two sets differ in no fewer hashes than their bits differ."""
    odd = np.bincount((hashes & np.uint64(255)).astype(np.int64), minlength=256) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.int64)


def long_parity(hashes: np.ndarray) -> bytes:
    """parity() in as many bits as there are hashes, or up to twice as many: a power of two, 256 at least."""
    bits = max(256, 1 << (len(hashes) - 1).bit_length())
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


@F.arrow_udf(T.BooleanType())
def may_be_similar(n: pa.Array, odd: pa.Array, m: pa.Array, other: pa.Array, least: pa.Array) -> pa.Array:
    """False where two sets' long parities differ in more bits than similar sets of n and m hashes may differ in hashes."""

    def one(n: int, x: np.ndarray, m: int, y: np.ndarray, s: float) -> bool:
        if len(x) < len(y):
            x, y = y, x
        while len(x) > len(y):  # the longer one in half as many bits
            half = len(x) // 2
            x = x[:half] ^ x[half:]
        return int(np.bitwise_count(x ^ y).sum(dtype=np.int64)) <= (1 - s) / (1 + s) * (n + m) + 1e-9

    words = [[np.frombuffer(v.as_buffer(), np.uint64) for v in c] for c in (odd, other)]
    return pa.array([one(*r) for r in zip(n.to_pylist(), words[0], m.to_pylist(), words[1], least.to_pylist(), strict=True)], pa.bool_())


def near_prints(docs: DataFrame, shingle: int, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """(id, fp, digest, n, bits, odd, asked) of every document: n different shingles, their parities, and those asked for."""
    rows = docs.select(F.col(id_col).alias("id"), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("digest"), F.col(text_col).alias("text"))
    found = common_shingles(docs, shingle, text_col)
    by = np.argsort(found)
    common, nothing = found[by], np.array([xxhash.xxh64_intdigest(b"", 42)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (p for batch in batches for p in pieces_of(batch)):
            fps, sizes, bits, odd, asked = [], [], [], [], []
            for t in utf8(b.column(2)):
                hashes = word_shingles(t, shingle)
                fps.append(print_of(hashes))
                own = distinct(hashes) if len(hashes) else nothing
                sizes.append(len(own))
                bits.append(parity(own))
                odd.append(long_parity(own))
                asked.append(asked_shingles(own, common, by, similarity).view(np.int64))
            fps = np.array(fps, np.uint64).view(np.int64)
            lists = pa.ListArray.from_arrays(np.r_[0, np.cumsum([len(x) for x in asked])].astype(np.int32), pa.array(np.concatenate([*asked, np.empty(0, np.int64)])))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps), b.column(1), pa.array(sizes, pa.int32()), pa.array(bits, pa.list_(pa.int64())), pa.array(odd, pa.binary()), lists], names=["id", "fp", "digest", "n", "bits", "odd", "asked"])

    return rows.mapInArrow(trimmed(run), f"id {rows.schema['id'].dataType.simpleString()}, fp long, digest string, n int, bits array<long>, odd binary, asked array<long>")


def met(texts: DataFrame) -> DataFrame:
    """(h, n, node, pos, many) of the shingles that more than one text asks for, stored; many: more than FEW do.

    texts: (n, node, asked). Asked shingles pass as sorted blocks, one for each range of hashes and batch, not as rows.
    """
    total = texts.agg(F.sum(F.size("asked").cast("long"))).first()[0] or 0
    bits = min(20, (total * 32 // RANGE).bit_length())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (p for batch in batches for p in pieces_of(batch, 1 << 20)):
            lists = b.column("asked")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            h = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            by = np.argsort(h)
            rows = np.empty((len(h), 4), np.int64)
            rows[:, 0] = h[by].view(np.int64)
            for k, c in enumerate(("n", "node"), 1):
                rows[:, k] = np.repeat(b.column(c).to_numpy(zero_copy_only=False), sizes)[by]
            rows[:, 3] = (np.arange(len(h)) - np.repeat(np.cumsum(sizes) - sizes, sizes))[by]
            parts, places = by_range(h[by], bits)
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int64()), pa.array([rows[p].tobytes() for p in places], pa.binary())], names=["part", "rows"])

    def shared(blocks: list[bytes]) -> pa.RecordBatch:
        r = np.concatenate([np.frombuffer(x, np.int64).reshape(-1, 4) for x in blocks])
        r = r[np.argsort(r[:, 0], kind="stable")]
        at = np.flatnonzero(np.r_[True, r[1:, 0] != r[:-1, 0]])
        size = np.diff(np.r_[at, len(r)])
        size = np.repeat(size, size)
        r, many = r[size > 1], size[size > 1] > FEW
        return pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(r[:, k])) for k in range(4)), pa.array(many)], names=["h", "n", "node", "pos", "many"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for b in batches:
            for part, rows in zip(b.column("part").to_pylist(), b.column("rows"), strict=True):
                if part != now and held:
                    yield shared(held)
                    held = []
                now = part
                held.append(rows.as_buffer())
        if held:
            yield shared(held)

    blocks = texts.select("n", "node", "asked").mapInArrow(trimmed(cut), "part long, rows binary")
    return store(blocks.repartition("part").sortWithinPartitions("part").mapInArrow(trimmed(meet), "h long, n long, node long, pos long, many boolean"), "near-met")


def drawn(node: np.ndarray, order: int) -> np.ndarray:
    """A number for each node by which a drawn order puts them."""
    return mixed(mixed((node.view(np.uint64) + np.uint64(1)) * np.uint64(ODD)) + np.uint64(order))


def proposed(rows: DataFrame, similarity: float, orders: tuple[int, ...] = ()) -> DataFrame:
    """(a, b) of texts of different labels that ask for the same shingle and can be similar.

    Texts of a shingle that few ask for are paired all. Others are paired with their neighbours in each of the orders,
    by size for order 0, drawn for another number; without orders all are. rows: (h, n, node, pos, label, and the
    parity's four parts). Sizes too different, too few shingles after the shared ones, or parities that differ in more
    bits than the sets may differ in shingles, rule a pair out.
    """
    most = (1 - similarity) / (1 + similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for every in whole_runs(batches, 1):
            at = np.flatnonzero(np.r_[True, every[1:, 0] != every[:-1, 0]])
            size = np.diff(np.r_[at, len(every)])
            many = np.repeat(size, size) > FEW
            for order in orders or (None,):
                if order:
                    large = every[many]
                    r = large[np.lexsort((drawn(np.ascontiguousarray(large[:, 2]), order), large[:, 0]))]
                else:
                    r = every
                yield from pairs(r, many if order == 0 else None, order)

    def pairs(r: np.ndarray, many: np.ndarray | None, order: int | None) -> Iterator[pa.RecordBatch]:
        h, n, node, pos, label = (np.ascontiguousarray(r[:, k]) for k in range(5))
        bits = np.ascontiguousarray(r[:, 5:]).view(np.uint64)
        at, step = np.arange(max(0, len(r) - 1)), 1
        while len(at):
            to = at + step
            near = np.minimum(n[at], n[to]) >= similarity * np.maximum(n[at], n[to]) - 1e-9
            on = (h[at] == h[to]) & (near | bool(order))  # in order of size, nothing behind is near either
            at, to, near = at[on], to[on], near[on]
            # a pair's first shared shingle leaves room for what they must share; at a later one it may be ruled out
            room = np.minimum(n[at] - pos[at], n[to] - pos[to]) >= similarity / (1 + similarity) * (n[at] + n[to]) - 1e-9
            apart = np.flatnonzero(room & near & (label[at] != label[to]))
            apart = apart[np.bitwise_count(bits[at[apart]] ^ bits[to[apart]]).sum(1, dtype=np.int64) <= most * (n[at[apart]] + n[to[apart]]) + 1e-9]
            pair = np.unique(np.sort(np.stack([node[at[apart]], node[to[apart]]], 1), axis=1), axis=0)
            if len(pair):
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pair[:, k])) for k in (0, 1)], names=["a", "b"])
            step += 1
            if order is not None and step > NEIGHBOURS:
                if many is None:
                    break
                at = at[~many[at]]
            at = at[at + step < len(r)]

    dealt = rows.select("h", "n", "node", "pos", "label", *PARITY).repartition("h").sortWithinPartitions("h", "n", "node")
    return store(dealt.mapInArrow(trimmed(run), "a long, b long").distinct(), "near-proposed")


def keep_one(docs: DataFrame, shingle: int = 5, radius: int = 6, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each group of near copies, that with the smallest id.

    Groups are the components of links, and a link is a pair of texts whose word shingles were compared and are
    similar enough; a group may drift, so that its ends are less similar. Every pair that is similar enough is
    compared or already in one group: fingerprints within the radius gather large groups around one text each,
    then texts of different groups meet at the shingles that they ask for: all texts of a shingle that few ask for;
    of others first neighbours by size and in drawn orders, which leaves most of a large group under one label, then
    all that are still apart. Exact copies always go. A null id comes after all others.
    """
    cols = docs.columns
    prints = store(near_prints(docs, shingle, similarity, id_col, text_col), "near-prints")
    # one row for each text: the smallest id that has it stands for it
    texts = prints.groupBy("digest").agg(F.min("id").alias("id"), F.count("*").alias("rows"), F.first("fp").alias("fp"), F.first("n").alias("n"), F.first("bits").alias("bits"), F.first("odd").alias("odd"), F.first("asked").alias("asked"))
    texts = store(texts.withColumn("node", F.monotonically_increasing_id()), "near-texts")
    key = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))

    def checked(pairs: DataFrame) -> DataFrame:
        # long texts can share many common shingles: their parities are compared before their texts are moved
        sets = [texts.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("odd").alias(f"odd_{c}")) for c in ("a", "b")]
        close = pairs.join(sets[0], "a").join(sets[1], "b").filter(may_be_similar("n_a", "odd_a", "n_b", "odd_b", F.lit(similarity)))
        close = store(close.select("a", "b"), "near-close")
        discard(pairs)
        pairs = close
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().join(texts.select("node", "digest"), "node")
        bodies = docs.select(key.alias("digest"), F.col(text_col).alias("body")).join(store(nodes, "near-nodes"), "digest")
        bodies = store(bodies.dropDuplicates(["node"]).select("node", "body"), "near-bodies")
        both = pairs.join(bodies.select(F.col("node").alias("a"), F.col("body").alias("x")), "a").join(bodies.select(F.col("node").alias("b"), F.col("body").alias("y")), "b")
        alike = store(both.filter(similar("x", "y", F.lit(shingle), F.lit(similarity))).select("a", "b"), "near-links")
        discard(bodies)
        discard(pairs)
        return alike

    placed = store(texts.select("node", "fp").join(linked(prints.select("id", "fp"), radius), "fp").select("node", "component_id"), "near-place")
    discard(prints)
    leads = placed.groupBy("component_id").agg(F.min("node").alias("lead"), F.count("*").alias("texts")).filter("texts > 1")
    edges = checked(store(placed.join(leads, "component_id").filter("node > lead").select(F.col("lead").alias("a"), F.col("node").alias("b")), "near-leads"))
    labels = components(edges)
    rows = met(texts)
    bits = store(rows.select("node").distinct().join(texts.select("node", *[F.col("bits")[k].alias(c) for k, c in enumerate(PARITY)]), "node"), "near-bits")
    for orders in ((0,), tuple(range(1, DRAWN + 1)), ()):
        placed = bits.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        # a shingle that few ask for has had all its pairs in the first round
        apart = (rows if orders == (0,) else rows.filter("many")).join(placed, "node")
        # what is connected already goes on as stars around labels
        stars = labels.filter("node != label").select(F.col("label").alias("a"), F.col("node").alias("b"))
        labels = components(store(stars.unionByName(checked(proposed(apart, similarity, orders))), "near-edges"))
    discard(rows)
    discard(bits)
    grouped = texts.select("digest", "id", "rows", "node").join(labels, "node").select("label", "digest", F.struct(F.col("id").isNull().alias("no"), "id", "digest").alias("at"))
    first = grouped.groupBy("label").agg(F.min("at").alias("first"))
    gone = grouped.join(first, "label").filter(F.col("digest") != F.col("first.digest")).select("digest")
    # exact copies: the row with the smallest id stays; equal rows of that id are one row
    keep = texts.select("digest", F.col("id").alias("__near_id"), F.col("rows").alias("__near_n")).join(store(gone, "near-gone"), "digest", "left_anti")
    keep = store(keep.withColumnRenamed("digest", "__near_digest"), "near-keep")
    discard(texts)
    found = docs.join(keep, (key == F.col("__near_digest")) & F.col(id_col).eqNullSafe(F.col("__near_id")))
    single = found.filter("__near_n = 1").select(*cols)
    # of rows equal in id and text, one
    several = found.filter("__near_n > 1").dropDuplicates(["__near_digest"]).select(*cols)
    return single.unionByName(several)
