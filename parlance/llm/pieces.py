"""Merge-type piece encoding through a prefix table, and decoding.

The encoder knows nothing of merge order at run time. For every prefix of a chunk it stores the one token that
ends the encoding of that prefix: an Aho-Corasick automaton lists the pieces that end there, and the right one
is the piece whose left neighbour (the stored token of the shorter prefix) forms a compatible pair with it. Two
tokens are compatible if encoding their joined text gives these two tokens back, which is decided from the
merge order of the vocabulary once and kept. The ids are then recovered backwards through the table.

Texts are cut before each run of word marks and around line ends; a check at load time makes sure that no piece
crosses such a cut, so chunks are independent and their encodings can be kept in a bounded table.

Defined results: a null or empty text has no ids and decodes to the empty text; repeated rows each get their
own result; columns besides the text pass through, and one named like the output is replaced.
"""

from __future__ import annotations

import heapq
import re
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from parlance.llm.common import utf8, with_struct

MARK = "▁"
NORMAL, UNKNOWN, BYTE = 1, 2, 6
#: What a worker keeps: bytes of chunk encodings while it has a task, and pairs (130 bytes each). A full table is emptied.
KEPT_BYTES = 64 << 20
KEPT_PAIRS = 400_000


class PieceCodec:
    """Encoder and decoder of one model file of the merge type with byte fallback."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(model)
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only models that leave texts as they are but for the word mark are handled")
        if proto.trainer_spec.model_type != 2 or proto.trainer_spec.treat_whitespace_as_suffix or not proto.trainer_spec.byte_fallback:
            raise ValueError("only models of the merge type with a leading word mark and byte fallback are handled")
        self.prefix = MARK if spec.add_dummy_prefix else ""
        self.piece = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.score = [p.score for p in proto.pieces]
        self.surface = [p.piece.replace(MARK, " ") if p.type == NORMAL else " \u2047 " if p.type == UNKNOWN else "" for p in proto.pieces]
        self.byte_of = {i: int(p.piece[3:5], 16) for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.byte_id = {b: i for i, b in self.byte_of.items()}
        runs = [x for x in self.piece if len(x) > 1 and not x.strip(MARK)]
        words = [x for x in self.piece if x not in runs]
        if any(MARK in x[1:] or ("\n" in x and len(x) > 1) for x in words) or max((self.score[self.piece[x]] for x in runs), default=-1e38) >= min(self.score[self.piece[x]] for x in words if len(x) > 1):
            raise ValueError("a piece crosses the places where texts are cut")
        # single characters are tokens from the start, whether or not they have an id
        self.token = {x: self.piece[x] for x in words}
        for c in {c for x in words for c in x} - set(self.token):
            self.token[c] = -1 - len(self.token)
        self.spelling = {i: x for x, i in self.token.items()}
        self.pairs: dict[int, bool] = {}
        self.chunks: dict[str, bytes] = {}
        self.held = 0
        self.automaton = ahocorasick.Automaton()
        for x, i in self.token.items():
            if len(x) == 1 or self._merged(x) == [x]:  # a piece that merging never makes is left out
                self.automaton.add_word(x, (i, len(x)))
        self.automaton.make_automaton()
        self.cut = re.compile(f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+")

    def _merged(self, text: str) -> list[str]:
        """Parts of a text by best merges, the leftmost first among equals: settles pair tests and runs of marks."""
        parts, n = list(text), len(text)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(k: int) -> None:
            if k >= 0 and after[k] < n and (i := self.piece.get(x := parts[k] + parts[after[k]])) is not None:
                heapq.heappush(heap, (-self.score[i], k, x))

        for k in range(n - 1):
            offer(k)
        while heap:
            _, k, x = heapq.heappop(heap)
            if not parts[k] or after[k] >= n or parts[k] + parts[after[k]] != x:
                continue
            gone = after[k]
            parts[k], parts[gone], after[k] = x, "", after[gone]
            if after[k] < n:
                before[after[k]] = k
            offer(before[k])
            offer(k)
        return [x for x in parts if x]

    def _compatible(self, left: int, right: int) -> bool:
        if len(self.pairs) >= KEPT_PAIRS:
            self.pairs.clear()
        a, b = self.spelling[left], self.spelling[right]
        ok = self.pairs[left << 32 ^ right] = self._merged(a + b) == [a, b]
        return ok

    def _table(self, text: str) -> list[int]:
        """Ids of a chunk with one mark at most, by its prefixes' last tokens."""
        n = len(text)
        last: list[tuple[int, int] | None] = [None] * (n + 1)
        pairs = self.pairs
        for stop, entry in self.automaton.iter(text):
            stop += 1
            if last[stop] is None:
                token, size = entry
                # None: the chunk's start, or a character of no piece, with which nothing merges
                left = last[stop - size]
                if left is None:
                    last[stop] = entry
                else:
                    ok = pairs.get(left[0] << 32 ^ token)
                    if ok or ok is None and self._compatible(left[0], token):
                        last[stop] = entry
        ids: list[int] = []
        while n:
            token, size = last[n] or (-1, 1)
            ids += [token] if token >= 0 else [self.byte_id[b] for b in reversed(text[n - size : n].encode())]
            n -= size
        return ids[::-1]

    def _chunk(self, text: str) -> list[int]:
        marks = len(text) - len(text.lstrip(MARK))
        if marks < 2:
            return self._table(text)
        # marks merge with each other after all else, so the word takes its own mark first
        ids = self._table(text[marks - 1 :]) if marks < len(text) else [self.piece[MARK]]
        if ids[0] == self.piece[MARK]:
            ids = ids[1:]
        else:
            marks -= 1
        return [self.piece[x] for x in self._merged(MARK * marks)] + ids

    def packed(self, text: str) -> bytes:
        """Ids as 32-bit integers."""
        if not text:
            return b""
        chunks = self.chunks
        cut = self.cut.findall(self.prefix + text.replace(" ", MARK))
        if self.held > KEPT_BYTES:
            chunks.clear()
            self.held = 0
        for x in {x for x in cut if x not in chunks}:
            ids = chunks[x] = array("i", self._chunk(x)).tobytes()
            self.held += 2 * len(x) + len(ids) + 200
        return b"".join(map(chunks.__getitem__, cut))

    def encode(self, text: str) -> list[int]:
        return array("i", self.packed(text)).tolist()

    def release(self) -> None:
        """Forget the texts' chunks, so that an idle worker is small. Pairs stay: they are few, and dear to find again."""
        self.chunks, self.held = {}, 0

    def decode(self, ids: list[int]) -> str:
        out: list[str] = []
        held = bytearray()
        first = bool(self.prefix)
        for i in ids:
            if (b := self.byte_of.get(i)) is not None:
                held.append(b)
                continue
            if held:
                out.append(characters(bytes(held)))
                held.clear()
                first = False
            x = self.surface[i]
            if first and x:
                x, first = x.removeprefix(" ") if i else x, False
            out.append(x)
        out.append(characters(bytes(held)))
        return "".join(out)


def characters(data: bytes) -> str:
    """UTF-8 with one replacement character for each byte that is part of no character."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        out, k = [], 0
        while k < len(data):
            for size in (1, 2, 3, 4):
                try:
                    out.append(data[k : k + size].decode())
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("\ufffd")
                size = 1
            k += size
        return "".join(out)


@lru_cache(maxsize=2)
def codec(model: bytes) -> PieceCodec:
    """One codec for each model and Python worker."""
    return PieceCodec(model)


def read_model(path: str) -> bytes:
    """The model file (under a MB) as read on the driver; tasks get its bytes with their code."""
    with open(path, "rb") as f:
        return f.read()


FIELDS = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])


def encode(docs: DataFrame, model: bytes, text_col: str = "text", out: str = "pieces") -> DataFrame:
    """docs and a struct column: the ids of each whole text, and the text that decoding these ids gives."""

    def run(batch: pa.RecordBatch) -> pa.Array:
        c = codec(model)
        packed = [c.packed(t.decode()) for t in utf8(batch.column(batch.schema.get_field_index(text_col)))]
        ends = np.cumsum([0, *(len(x) // 4 for x in packed)])
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), np.int32)))
        return pa.StructArray.from_arrays([ids, pa.array([c.decode(array("i", x)) for x in packed], pa.string())], FIELDS.names)

    return with_struct(docs, out, FIELDS, run, lambda: codec(model).release())
