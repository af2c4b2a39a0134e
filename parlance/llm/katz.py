"""Katz backoff language model over word pairs, counted and evaluated in partitioned tables.

Texts are kept as blocks of a million tokens or two: the distinct words' 64-bit hashes and the tokens as numbers
into them. Every block asks the count tables once: its distinct words and word pairs go, as packed sorted keys, to
the partition that owns their hash range; that partition adds up what all blocks sent and answers each block in
the order of its question. So a pair crosses the network once for each block and not once for each occurrence,
no partition has more of a frequent pair than one entry for each block, and nothing has to fit in one place.

The model. With Good-Turing discounts d(c) for counts up to ``gt_max`` and c(h) the count of a history,

    p(w | h) = d(c(h,w)) c(h,w) / (c(h) + 1)     if the pair was seen in training
             = alpha(h) p(w)                     else (alpha is 1 for a history never seen)
    p(w)     = d(c(w)) c(w) / (N + 1)            if the word was seen; the rest of the mass is the unknown word's

The extra count leaves mass for the unseen even where every count is too large to be discounted. alpha(h) makes
p(. | h) sum to one exactly: it is the mass that the seen pairs leave over what p leaves them. A text is its words,
lower-cased from A to Z, and one end token; the first token's history is a start mark, which is no token.

Defined results: a null or empty text is the end token alone; a null id is not held out by itself, so its text is learned from; without any training text every token is unknown
with probability one; repeated rows are counted and scored each; other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import by_range, discard, store, utf8

#: A block is full at so many tokens, bytes of text or texts.
BLOCK_TOKENS, BLOCK_BYTES, BLOCK_TEXTS = 1_500_000, 64 << 20, 1 << 20
#: Distinct keys that a partition of the count tables should have, about.
PARTITION_KEYS = 1_000_000
END, START = b" ", b"  "  # no word has a space
WORDS, PAIRS, STATS = 0, 1, 2
DOC, MASS, UNSEEN = 0, 1, 2
BLOCK = "block long, n_tokens long, ids array<long>, held array<boolean>, sizes array<int>, hashes binary, tokens binary"
ASK = "kind int, part int, block long, n int, keys binary, counts binary"
REPLY = "kind int, part int, block long, counts binary, own binary, stats array<long>"
OUT = "kind int, row long, id long, held boolean, n_tokens long, n_known long, h long, n int, x double, y double"


@dataclass(frozen=True)
class Params:
    #: Counts above this are reliable and stay as they are.
    gt_max: int = 5


def planes(values: np.ndarray) -> bytes:
    """Numbers as byte planes, so that bytes alike lie together for the shuffle's and the file's compression."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def from_planes(data: bytes, dtype: str) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(dtype).ravel()


def pack_keys(ordered: np.ndarray) -> bytes:
    return planes(np.diff(ordered, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data, "<u8"), dtype=np.uint64)


def pair_key(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two 64-bit hashes, in order."""
    x = history * np.uint64(0x9E3779B97F4A7C15) ^ (word << np.uint64(31) | word >> np.uint64(33)) * np.uint64(0xC2B2AE3D27D4EB4F)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ x >> np.uint64(shift)) * np.uint64(factor)
    return x ^ x >> np.uint64(31)


def blocks(docs: DataFrame, id_col: str, text_col: str, held_col: str) -> DataFrame:
    """Texts as blocks of numbered words, stored."""
    rows = docs.select(F.col(id_col).cast("long"), F.col(held_col), F.col(text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        numbers: dict[bytes, int] = {END: 0}
        ids, held, sizes, tokens = [], [], [], []
        total = size = 0

        def flush() -> pa.RecordBatch:
            nonlocal number, total, size
            hashes = np.array([xxhash.xxh64_intdigest(w) for w in numbers], "<u8")
            seq = np.concatenate(tokens)
            row = [task << 36 | number << 24, total, list(ids), list(held), list(sizes), hashes.tobytes(), planes(seq)]
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
            number, total, size = number + 1, 0, 0
            numbers.clear()
            numbers[END] = 0
            for x in (ids, held, sizes, tokens):
                x.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names=[c.split()[0] for c in BLOCK.split(", ")])

        for batch in batches:
            for i, out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2)), strict=True):
                words = text.lower().split()
                for w in {w for w in words if w not in numbers}:
                    numbers[w] = len(numbers)
                tokens.append(np.fromiter([*map(numbers.__getitem__, words), 0], "<u4", len(words) + 1))
                ids.append(i)
                held.append(bool(out))
                sizes.append(len(words) + 1)
                total += len(words) + 1
                size += len(text)
                if total >= BLOCK_TOKENS or size >= BLOCK_BYTES or len(ids) >= BLOCK_TEXTS:
                    yield flush()
        if total:
            yield flush()

    return store(rows.mapInArrow(run, BLOCK), "katz-blocks")


class Block:
    """A block's tokens with their histories, and the sorted distinct keys that it asks about."""

    def __init__(self, row: dict):
        hashes = np.frombuffer(row["hashes"], "<u8")
        self.hashes = np.r_[hashes, np.uint64(xxhash.xxh64_intdigest(START))]
        self.tokens = from_planes(row["tokens"], "<u4").astype(np.int32)
        sizes = np.array(row["sizes"], np.int64)
        self.doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        self.history = np.r_[np.int32(0), self.tokens[:-1]]
        self.history[np.cumsum(sizes) - sizes] = len(hashes)
        self.train = ~np.array(row["held"], bool)[self.doc]
        self.word_order = np.argsort(hashes)
        key = pair_key(self.hashes[self.history], self.hashes[self.tokens])
        order = np.argsort(key).astype(np.int32)
        key = key[order]
        new = np.r_[True, key[1:] != key[:-1]]
        self.starts = np.flatnonzero(new).astype(np.int32)
        self.pairs = key[self.starts]
        self.first = order[self.starts]  # a token that has the pair
        self.pair_of = np.empty(len(order), np.int32)
        self.pair_of[order] = np.cumsum(new, dtype=np.int32) - 1
        self.order = order

    def asked(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(kind, sorted keys, their counts in the block's training texts)."""
        counts = np.bincount(self.tokens[self.train], minlength=len(self.hashes) - 1)
        yield WORDS, self.hashes[self.word_order], counts[self.word_order].astype("<u4")
        yield PAIRS, self.pairs, np.add.reduceat(self.train[self.order].astype("<u4"), self.starts).astype("<u4")


def ask(stored: DataFrame, bits: int) -> DataFrame:
    """What every block wants to know, cut by the hash ranges of 2**bits partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for kind, keys, counts in Block(row).asked():
                    parts, cut = by_range(keys, bits)
                    n = len(parts)
                    values = [[kind] * n, parts, [row["block"]] * n, [int(c.stop - c.start) for c in cut], [pack_keys(keys[c]) for c in cut], [planes(counts[c]) for c in cut]]
                    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds, strict=True)], names=[c.split()[0] for c in ASK.split(", ")])

    return stored.mapInArrow(run, ASK)


def answer(asked: DataFrame, gt_max: int) -> DataFrame:
    """The total count of every key for every block that asked, and in which block a pair's mass is added up; stored."""

    def run(group: pa.Table) -> pa.Table:
        keys = [unpack_keys(x) for x in group.column("keys").to_pylist()]
        sizes = np.cumsum([len(k) for k in keys])[:-1]
        counts = np.concatenate([from_planes(x, "<u4") for x in group.column("counts").to_pylist()])
        distinct, first, which = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        total = np.bincount(which, counts, len(distinct)).astype(np.int64)
        own = np.zeros(len(which), bool)
        own[first] = True
        kind, n = group.column("kind")[0].as_py(), len(keys)
        seen = total[total > 0]
        stats = [int(seen.sum()), len(seen), *np.bincount(np.minimum(seen, gt_max + 2), minlength=gt_max + 3)[1 : gt_max + 2].tolist()]
        parts = [np.split(a, sizes) for a in (total[which].astype("<u4"), own)]
        values = [
            [kind] * n + [STATS],
            group.column("part").to_pylist() + [kind],
            group.column("block").to_pylist() + [-1],
            [planes(x) for x in parts[0]] + [None],
            [np.packbits(x).tobytes() for x in parts[1]] + [None],
            [None] * n + [stats],
        ]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
        return pa.table([pa.array(v, t) for v, t in zip(values, kinds, strict=True)], names=[c.split()[0] for c in REPLY.split(", ")])

    return store(asked.groupBy("kind", "part").applyInArrow(run, REPLY), "katz-counts")


def discounts(n: list[int], gt_max: int) -> np.ndarray:
    """d(0..gt_max+1) from the numbers n[r-1] of keys counted r times; one where Good-Turing gives no discount."""
    d = np.ones(gt_max + 2)
    cut = (gt_max + 1) * n[gt_max] / n[0] if n[0] else 1.0
    for r in range(1, gt_max + 1):
        if n[r - 1] and cut < 1:
            value = ((r + 1) * n[r] / (r * n[r - 1]) - cut) / (1 - cut)
            if 0 < value < 1:
                d[r] = value
    return d


@dataclass(frozen=True)
class Model:
    """The numbers that every task needs: sums, discounts, and the unknown word's probability."""

    tokens: int
    types: int
    texts: int
    word_d: np.ndarray
    pair_d: np.ndarray
    unknown: float

    def word_p(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, self.discounted(self.word_d, c) / (self.tokens + 1), self.unknown)

    @staticmethod
    def discounted(d: np.ndarray, c: np.ndarray) -> np.ndarray:
        return d[np.minimum(c, len(d) - 1)] * c


def model_of(replies: DataFrame, texts: int, gt_max: int) -> Model:
    width = gt_max + 3
    sums = [F.sum(F.get("stats", F.lit(k))).alias(f"s{k}") for k in range(width)]
    got = {r["part"]: [r[f"s{k}"] for k in range(width)] for r in replies.filter(F.col("kind") == STATS).groupBy("part").agg(*sums).collect()}
    words, pairs = got.get(WORDS, [0] * width), got.get(PAIRS, [0] * width)
    word_d, pair_d = discounts(words[2:], gt_max), discounts(pairs[2:], gt_max)
    small = sum(r * words[1 + r] for r in range(1, gt_max + 1))
    mass = sum(word_d[r] * r * words[1 + r] for r in range(1, gt_max + 1)) + words[0] - small
    return Model(words[0], words[1], texts, word_d, pair_d, 1 - mass / (words[0] + 1))


def score_blocks(stored: DataFrame, replies: DataFrame, m: Model) -> DataFrame:
    """Rows of three kinds: texts with all but the backoff weights, masses of histories, and unseen pairs' histories."""
    names = [c.split()[0] for c in OUT.split(", ")]
    kinds = dict(zip(names, [pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.float64()], strict=True))

    def table(kind: int, size: int, **columns) -> pa.Table:
        return pa.table([pa.array(columns[c], t) if c in columns else pa.array(np.full(size, kind, np.int32)) if c == "kind" else pa.nulls(size, t) for c, t in kinds.items()], names=names)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return table(DOC, 0)
        row = left.to_pylist()[0]
        b = Block(row)

        def told(kind: int) -> tuple[np.ndarray, np.ndarray]:
            rows = sorted((p, c, o) for k, p, c, o in zip(*(right.column(x).to_pylist() for x in ("kind", "part", "counts", "own")), strict=True) if k == kind)
            counts = [from_planes(c, "<u4") for _, c, _ in rows]
            return np.concatenate(counts).astype(np.int64), np.concatenate([np.unpackbits(np.frombuffer(o, np.uint8), count=len(c)) for (_, _, o), c in zip(rows, counts, strict=True)]).astype(bool)

        in_order, _ = told(WORDS)
        c1 = np.empty(len(b.hashes), np.int64)
        c1[b.word_order] = in_order
        c1[-1] = m.texts  # how often the start mark is a history
        c2, own = told(PAIRS)
        n_docs, n_words = len(row["sizes"]), len(b.hashes)
        p1 = m.word_p(c1)
        h, w = b.history[b.first], b.tokens[b.first]
        p2 = m.discounted(m.pair_d, c2) / (c1[h] + 1)
        seen = c2 > 0
        with np.errstate(divide="ignore"):
            each = np.where(seen, np.log10(p2), np.log10(p1[w]))
        known = c1[b.tokens] > 0
        base = np.log10((c1 + 0.5) / (m.tokens + 0.5 * (m.types + 1)))
        rows = row["block"] + np.arange(n_docs)
        docs = table(
            DOC, n_docs, row=rows, id=row["ids"], held=row["held"], n_tokens=row["sizes"], n_known=np.bincount(b.doc[known], minlength=n_docs),
            x=np.bincount(b.doc, base[b.tokens], n_docs), y=np.bincount(b.doc, each[b.pair_of], n_docs),
        )
        # a pair's mass is added up in one block only
        mine = own & seen
        s1, s2 = np.bincount(h[mine], p2[mine], n_words), np.bincount(h[mine], p1[w[mine]], n_words)
        has = np.flatnonzero(s1)
        masses = table(MASS, len(has), h=b.hashes[has].view(np.int64), x=s1[has], y=s2[has])
        lost = np.flatnonzero(~seen[b.pair_of] & (c1[b.history] > 0))
        code, n = np.unique(b.doc[lost].astype(np.int64) * n_words + b.history[lost], return_counts=True)
        unseen = table(UNSEEN, len(code), row=rows[code // n_words], h=b.hashes[code % n_words].view(np.int64), n=n.astype(np.int32))
        return pa.concat_tables([docs, masses, unseen])

    answers = replies.filter(F.col("kind") != STATS).select("block", "kind", "part", "counts", "own")
    return store(stored.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, OUT), "katz-parts")


def score(docs: DataFrame, held_col: str, id_col: str = "doc_id", text_col: str = "text", params: Params = Params()) -> DataFrame:
    """Train on rows with an id whose held_col is false, score all: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    stored = blocks(docs, id_col, text_col, held_col)
    size = stored.agg(F.sum("n_tokens").alias("n"), F.sum(F.size(F.filter("held", lambda x: ~x))).alias("texts")).first()
    bits = max(4, math.ceil(math.log2(max(1, (size["n"] or 0) / PARTITION_KEYS))))
    replies = answer(ask(stored, bits), params.gt_max)
    m = model_of(replies, size["texts"] or 0, params.gt_max)
    parts = score_blocks(stored, replies, m)
    discard(stored)
    discard(replies)
    masses = parts.filter(F.col("kind") == MASS).groupBy("h").agg(((F.lit(1.0) - F.sum("x")) / (F.lit(1.0) - F.sum("y"))).alias("alpha"))
    weights = store(masses.select("h", F.log10("alpha").alias("weight")), "katz-weights")
    unseen = parts.filter(F.col("kind") == UNSEEN).select("row", "h", "n")
    # a frequent history has a large share of the unseen pairs: both sides are plain scans, so Spark can split it
    added = unseen.join(weights, "h").groupBy("row").agg(F.sum(F.col("n") * F.col("weight")).alias("more"))
    texts = parts.filter(F.col("kind") == DOC)
    return texts.join(added, "row", "left").select(
        F.col("id"), F.col("held").alias("held_out"), "n_tokens", "n_known", F.lit(m.tokens).cast("long").alias("train_tokens"),
        F.col("x").alias("base_score"), (F.col("y") + F.coalesce("more", F.lit(0.0))).alias("score"),
    )
