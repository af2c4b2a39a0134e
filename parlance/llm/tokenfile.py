"""Token-id files compressed by a pair grammar, one binary shard a row, with random access.

``write_tokens`` encodes whole texts, ends each with an end id, and lays documents out in ascending id order in
shards of bounded size. In every shard, frequent neighbouring id pairs are replaced by nonterminals again and
again; a pair never crosses the end of a document, so each document is a slice of the symbols. A round replaces
many pairs at once: where occurrences overlap, the more frequent pair wins.

A shard is one ``binary`` value of a Parquet table (``part``, ``shard``, ``before``, ``n_tokens``, ``data``)::

    magic b"PLT1" | uint32 documents, rules, symbols, base
    int64 ids | uint8 null flags | uint32 tokens, symbols for each document
    uint32 left, right for each rule | uint32 expansion lengths | uint16 low, uint8 high parts of the symbols

Numbers are little-endian. Symbols below ``base`` are ids; symbol base+k is rule k, whose parts are earlier
symbols. Expansion lengths turn a token offset into a symbol offset without decoding.

Defined results: a null or empty text is the end id alone; documents with equal ids are ordered by text, null
ids come first; repeated rows are all written; other columns are left out; an empty table gives no shards.
"""

from __future__ import annotations

import json
import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlance.llm.common import slices, utf8

MAGIC = b"PLT1"
SHARD_TOKENS = 1_000_000
MIN_USES = 6
SLOT_BITS = 18
#: Encodings that a worker keeps: of chunks, and of the parts that chunks are cut into. A full table is emptied.
KEPT_CHUNKS = 800_000
KEPT_PARTS = 500_000
SCHEMA = "part int, shard int, before long, n_tokens long, data binary"


class ChunkEncoder:
    """The tokenizers library's encoding, kept for white-space separated chunks.

    The tokenizer drops white space before it merges, and none of its steps looks across it, so a text's ids are
    those of its chunks. Chunks of plain letters, digits and marks are cut as the file's pattern cuts them and
    merged by the library's model; any other chunk goes through the whole library. A definition that does anything
    else than STEPS says is left to the library for whole texts.
    """

    #: The normalizer and pre-tokenizer that this holds for; part of the format.
    STEPS = (
        {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
        {"type": "Sequence", "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ]},
    )

    PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
    CUT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        spec = json.loads(definition)
        plain = all(a.get("special") and not (a.get("lstrip") or a.get("rstrip") or a.get("single_word") or re.search(r"\s", a["content"])) for a in spec["added_tokens"])
        self.by_chunks = plain and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout") and (spec["normalizer"], spec["pre_tokenizer"]) == self.STEPS
        self.special = re.compile("|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()) or r"(?!)")
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.letter = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in shown)}
        self.chunks: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _packed(self, ids: list[int]) -> bytes:
        return array("I", ids).tobytes()

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        if not self.PLAIN.fullmatch(text) or self.special.search(text):
            return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        cut = self.CUT.findall(text.lower())
        parts = self.parts
        for part in cut:
            if part not in parts:
                if len(parts) >= KEPT_PARTS:
                    parts.clear()
                    return self._chunk(chunk)
                parts[part] = self._packed([t.id for t in self.model.tokenize("".join(map(self.letter.__getitem__, part.encode())))])
        return b"".join(map(parts.__getitem__, cut))

    def encode(self, text: bytes) -> bytes:
        """Ids as little-endian uint32."""
        if not self.by_chunks:
            return self._packed(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids)
        words = text.split()
        chunks = self.chunks
        if len(chunks) > KEPT_CHUNKS:
            chunks.clear()
        for w in {w for w in words if w not in chunks}:
            chunks[w] = self._chunk(w)
        return b"".join(map(chunks.__getitem__, words))


@lru_cache(maxsize=2)
def encoder(definition: str) -> ChunkEncoder:
    return ChunkEncoder(definition)


def compress(seq: np.ndarray, last: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, their document ends, rules as rows of two, expansion lengths) of ids with document ends.

    Rounds go on until no pair has MIN_USES places that don't overlap. A pair of old symbols only gets rarer, and a
    new pair lies at a replaced place, so a round looks only there and at pairs that were frequent before.
    """
    rules, lengths = [np.empty((0, 2), np.int64)], [np.empty(0, np.int64)]
    known, n_rules, size = np.ones(base, np.int64), 0, len(seq)
    seq, last, dead, again = seq.astype(np.uint32), last.copy(), np.zeros(size, bool), np.zeros(size, bool)
    after, before = np.arange(1, size + 1, dtype=np.int32), np.arange(-1, size, dtype=np.int32)  # replaced pairs are skipped, not cut out
    slot = lambda k: (k * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)
    live = np.flatnonzero(~last[:-1])
    while len(live) >= MIN_USES:
        key = (seq[live].astype(np.uint64) << np.uint64(32)) | seq[after[live]].astype(np.uint64)
        touch = after[live[:-1]] == live[1:]
        # of the overlapping places of a pair of equal symbols, every second one counts
        run = np.maximum.accumulate(np.where(np.r_[True, ~touch | (key[1:] != key[:-1])], np.arange(len(live)), 0))
        counted = (np.arange(len(live)) - run) % 2 == 0
        ordered = np.sort(key[counted])
        at = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        counts = np.diff(np.r_[at, len(ordered)])
        often = counts >= MIN_USES
        if not often.any():
            break
        pairs = ordered[at[often]][np.argsort(counts[often], kind="stable")]
        which = np.full(1 << SLOT_BITS, -1, np.int64)
        which[slot(pairs)] = np.arange(len(pairs))  # of pairs that meet in a slot, the most frequent has it this round
        rule = which[slot(key)]
        hope = rule >= 0  # all places of a frequent pair, whether or not it has the slot
        # the place in the order is the rank: the most frequent pair wins wherever it is, so every round gets on
        rank = np.where(hope & counted & (pairs[rule] == key), rule + 1, 0)
        take = (rank > 0) & (rank > np.r_[0, np.where(touch, rank[:-1], 0)]) & (rank > np.r_[np.where(touch, rank[1:], 0), 0])
        uses = np.bincount(rule[take], minlength=len(pairs))
        take &= uses[rule] >= MIN_USES
        kept = np.flatnonzero(uses >= MIN_USES)
        number = np.zeros(len(pairs), np.int64)
        number[kept] = base + n_rules + np.arange(len(kept))
        new = np.stack([(pairs[kept] >> np.uint64(32)).astype(np.int64), (pairs[kept] & np.uint64(0xFFFFFFFF)).astype(np.int64)], 1)
        rules.append(new)
        lengths.append(known[new].sum(1))
        known = np.r_[known, lengths[-1]]
        n_rules += len(kept)
        first = live[take]
        second = after[first]
        seq[first] = number[rule[take]]
        last[first] = last[second]
        dead[second] = True
        after[first] = after[second]
        before[after[first]] = first
        ahead = before[first]
        changed = np.concatenate([ahead[ahead >= 0], first])
        again[live[hope]] = again[changed] = True
        again &= ~dead & ~last
        live = np.flatnonzero(again)
        again[live] = False
    return seq[~dead], last[~dead], np.concatenate(rules), np.concatenate(lengths)


def pack(ids: list[int | None], texts: list[bytes], end_id: int) -> bytes:
    """One shard of documents whose ids are given as little-endian uint32, without their end id."""
    seq = np.frombuffer(b"".join(x + struct.pack("<I", end_id) for x in texts), "<u4").astype(np.int64)
    tokens = np.array([len(x) // 4 + 1 for x in texts], np.int64)
    last = np.zeros(len(seq), bool)
    last[np.cumsum(tokens) - 1] = True
    base = int(seq.max()) + 1
    symbols, ends, rules, lengths = compress(seq, last, base)
    if base + len(rules) >= 1 << 24:
        raise ValueError("a shard has room for 2**24 symbols")
    per_doc = np.diff(np.r_[0, np.flatnonzero(ends) + 1])
    return b"".join(
        [MAGIC, struct.pack("<4I", len(ids), len(rules), len(symbols), base), np.array([i or 0 for i in ids], "<i8").tobytes(), bytes(i is None for i in ids)]
        + [tokens.astype("<u4").tobytes(), per_doc.astype("<u4").tobytes(), rules.astype("<u4").tobytes(), lengths.astype("<u4").tobytes()]
        + [(symbols & 0xFFFF).astype("<u2").tobytes(), (symbols >> 16).astype("u1").tobytes()]
    )


class Shard:
    """A packed shard, open for reading all of it, one document, or one token."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a token shard")
        docs, rules, symbols, self.base = struct.unpack_from("<4I", data, 4)
        at = 20

        def part(kind: str, n: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(data, kind, n, at)
            at += got.nbytes
            return got

        ids, null = part("<i8", docs), part("u1", docs)
        self.ids = [None if x else int(i) for i, x in zip(ids, null, strict=True)]
        self.tokens, self.doc_symbols = part("<u4", docs).astype(np.int64), part("<u4", docs).astype(np.int64)
        self.rules = part("<u4", 2 * rules).reshape(-1, 2).astype(np.int64)
        self.lengths = np.r_[np.ones(self.base, np.int64), part("<u4", rules).astype(np.int64)]
        low = part("<u2", symbols)
        self.symbols = low.astype(np.int64) | part("u1", symbols).astype(np.int64) << 16
        self.starts = np.r_[0, np.cumsum(self.lengths)[:-1]]
        flat = np.arange(self.base)
        done = 0
        while done < len(self.rules):  # all rules whose parts are already spelled out, at once
            ready = np.flatnonzero((self.rules[done:] >= self.base + done).any(1))
            stop = done + (int(ready[0]) if len(ready) else len(self.rules) - done)
            flat = np.r_[flat, self._spell(flat, self.rules[done:stop].ravel())]
            done = stop
        self.flat = flat

    def _spell(self, flat: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        n = self.lengths[symbols]
        out = np.r_[0, np.cumsum(n)]
        return flat[np.repeat(self.starts[symbols] - out[:-1], n) + np.arange(out[-1])]

    def all(self) -> np.ndarray:
        return self._spell(self.flat, self.symbols)

    def document(self, k: int) -> np.ndarray:
        at = int(self.doc_symbols[:k].sum())
        return self._spell(self.flat, self.symbols[at : at + int(self.doc_symbols[k])])

    def token(self, k: int, offset: int) -> int:
        """The id at an offset of document k, spelling out one symbol only."""
        at = int(self.doc_symbols[:k].sum())
        own = self.symbols[at : at + int(self.doc_symbols[k])]
        ends = np.cumsum(self.lengths[own])
        s = int(np.searchsorted(ends, offset, "right"))
        return int(self._spell(self.flat, own[s : s + 1])[offset - int(ends[s] - self.lengths[own[s]])])


def write_tokens(docs: DataFrame, definition: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode and write all documents in ascending id order; texts are shuffled once, by id range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, before = TaskContext.get().partitionId(), 0, 0
        coder = encoder(definition)
        ids: list[int | None] = []
        texts: list[bytes] = []

        def flush() -> pa.RecordBatch:
            nonlocal shard, before
            n = sum(len(x) // 4 + 1 for x in texts)
            row = [part, shard, before, n, pack(ids, texts, end_id)]
            shard, before = shard + 1, before + n
            ids.clear()
            texts.clear()
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names=["part", "shard", "before", "n_tokens", "data"])

        held = 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                x = coder.encode(t)
                if texts and held + len(x) // 4 >= SHARD_TOKENS:
                    yield flush()
                    held = 0
                ids.append(i)
                texts.append(x)
                held += len(x) // 4 + 1
        if texts:
            yield flush()

    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"{id_col} must be a whole number: token files are laid out by it")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # equal ids are told apart by how their texts begin, so that many rows without an id are many tasks
    rows.repartitionByRange("id", F.left("text", F.lit(32))).sortWithinPartitions("id", "text").mapInArrow(run, SCHEMA).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document; ids are little-endian uint32, start counts all ids before."""
    shards = spark.read.schema(SCHEMA).parquet(path)
    # one row for each task that wrote: some 10^5 at most on the largest inputs
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    offsets = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s = Shard(data)
                ids = s.all().astype("<u4")
                ends = np.cumsum(s.tokens)
                starts = ends - s.tokens
                for a, b in slices(s.tokens.tolist(), 4 * SHARD_TOKENS):
                    values = [ids[starts[k] : ends[k]].tobytes() for k in range(a, b)]
                    yield pa.RecordBatch.from_arrays([pa.array(s.ids[a:b], pa.int64()), pa.array(start + starts[a:b]), pa.array(s.tokens[a:b]), pa.array(values, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])

    placed = shards.join(F.broadcast(offsets), "part").select("data", (F.col("offset") + F.col("before")).alias("start"))
    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
