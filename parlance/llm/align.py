"""Alignment of two tokenizers' tokens over the same bytes, with corpus-wide counts of linked ids.

Tokenizer A is a byte-level one, read from its JSON definition; B is a piece model that adds a space in front, so A is
given the text with a space in front as well. Inside tasks everything is done on flat Arrow arrays of many texts:
token lists are flattened beside their parents' indices, cumulative sums of token lengths restart with each text and
give the tokens' ends, an Acero hash join on (text, end) finds where both end, which cuts the tokens into groups, and
``Table.group_by`` counts each text's linked id pairs. Spark merges these counts: a block of texts (some MB) sends each
of its pairs once, with the number of its texts that hold it, and gets the corpus-wide count of each pair back.

Where both vocabularies keep merges within words, which is checked when they are loaded, a step aligns its different
words only and puts texts together from them; texts in which white space meets a space are aligned as they are.

Two tokens are linked if their byte ranges overlap. All ends of both tokenizers cut a text into parts that belong to
one token of each, and each linked pair has exactly one such part, so links are counted without comparing ranges.

Defined results: a text that is null, empty, or whose tokens of A or of B don't spell the text with a space in front
has no tokens: zeros, and an empty string in place of the digest. Repeated rows are texts of their own, and so are rows
with equal or null ids. An empty table gives an empty result. Columns other than the id and the text are left out.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import pieces_of, store, trim, utf8

#: How byte-level tokenizers with ``use_regex`` split texts; part of the format.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MARK = "▁"
#: Texts in which a space is last or before other white space, or that begin with some, or hold the mark: only in others
#: words are sure to be independent.
MEETING_SPACES = r"(?:^| )(?:[\s\p{Z}\x{85}\x0b\x1c-\x1f]|$)|▁"
#: Words that are encoded at once.
RUN = 512
#: Bytes of text in one block, unless one text is larger, and in one step within it.
BLOCK, STEP = 4 << 20, 1 << 20


def byte_characters() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones as they are, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteTokens:
    """Tokenizer A: ids of texts, and the bytes of each id.

    Definitions that split by SPLIT, leave texts as they are and rank each merge by the id it makes are encoded by
    ranks, which is the same and several times as fast; all others by the tokenizers library itself.
    """

    def __init__(self, definition: str):
        spec = json.loads(definition)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        vocab = model["vocab"]
        if model["type"] != "BPE" or (spec["decoder"] or {}).get("type") != "ByteLevel":
            raise ValueError("tokenizer A must be a byte-level one")
        code = byte_characters()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes: list[bytes] = [b""] * (1 + max([*vocab.values(), *special.values()]))
        for text, i in [*special.items(), *vocab.items()]:
            self.bytes[i] = text.encode() if text in special else bytes(code[c] for c in text)
        self.definition, self.ranked, self.library = definition, None, None
        single = len(code)
        merges = [m if isinstance(m, str) else "".join(m) for m in model["merges"]]
        in_order = all(vocab.get(m.replace(" ", "")) == single + k for k, m in enumerate(merges))
        plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        if in_order and plain and not spec["normalizer"] and not model.get("ignore_merges") and not model.get("dropout") and all(t.get("special") for t in spec["added_tokens"]):
            import tiktoken

            ranks = {self.bytes[i]: i for t, i in vocab.items() if t not in special}
            self.ranked = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

        self.by_words = self.ranked is not None

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts with a space put in front, none of an empty one."""
        texts = [" " + t if t else "" for t in texts]
        if self.ranked is not None:
            try:
                return [self.ranked.encode_to_numpy(t, disallowed_special=()) for t in texts]
            except ValueError:  # very long white space is too much for its pattern search
                pass
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.definition)
            self.library.encode_special_tokens = True
        return [np.asarray(self.library.encode(t, add_special_tokens=False).ids, np.uint32) for t in texts]


class PieceTokens:
    """Tokenizer B: ids of texts, and the bytes of each id."""

    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(self.library.get_piece_size())
        self.bytes = [bytes([int(p[3:5], 16)]) if self.library.is_byte(i) else p.replace(MARK, " ").encode() for i in ids for p in [self.library.id_to_piece(i)]]
        proto = pb.ModelProto()
        proto.ParseFromString(model)
        kinds, spec = pb.ModelProto.SentencePiece, proto.normalizer_spec
        plain = {kinds.NORMAL, kinds.UNKNOWN, kinds.CONTROL, kinds.BYTE}
        # merges then stay within words: every piece has its mark in front, or is made of marks, and marks don't meet
        self.by_words = (
            proto.trainer_spec.model_type == pb.TrainerSpec.BPE and proto.trainer_spec.byte_fallback and spec.add_dummy_prefix and spec.escape_whitespaces
            and not spec.precompiled_charsmap and not spec.remove_extra_whitespaces
            and not proto.trainer_spec.treat_whitespace_as_suffix
            and all(x.type in plain and (MARK not in x.piece[1:] or not x.piece.strip(MARK)) for x in proto.pieces)
        )

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts; the model puts the space in front."""
        return [np.asarray(x, np.uint32) for x in self.library.encode(texts, num_threads=1)]


class Side:
    """One tokenizer with what alignment looks up by id: bytes, lengths, and decimal ids with either mark behind them."""

    def __init__(self, tokens: ByteTokens | PieceTokens, marks: str):
        self.tokens, self.size, self.marks = tokens, len(tokens.bytes), marks
        self.spelling = pa.array(tokens.bytes, pa.large_binary())
        self.length = pa.array([len(x) for x in tokens.bytes], pa.int64())

    def lists(self, words: list[bytes], whole: list[bytes]) -> pa.ListArray:
        """Tokens of words and of whole texts, each with a space in front. Words are encoded many at a time."""
        runs = [words[k : k + RUN] for k in range(0, len(words), RUN)]
        found = self.tokens.encode([b" ".join(r).decode() for r in runs])
        ids = np.concatenate(found).astype(np.int32, copy=False) if found else np.empty(0, np.int32)
        ends = np.cumsum(self.length.to_numpy()[ids])
        due = np.cumsum([len(w) + 1 for w in words])
        sizes = np.diff(np.searchsorted(ends, due), prepend=-1)
        if len(words) and not (due[-1] == ends[-1] and np.isin(due, ends).all()):
            found = self.tokens.encode([w.decode() for w in words])
            ids, sizes = np.concatenate(found).astype(np.int32, copy=False), np.array([len(x) for x in found])
        found = self.tokens.encode([t.decode() for t in whole])
        return listed(np.concatenate([ids, *found]).astype(np.int32, copy=False), np.concatenate([sizes, [len(x) for x in found]]).astype(np.int64), pa.int32())

    def spelled_alike(self, lists: pa.ListArray, units: list[bytes]) -> np.ndarray:
        """Which units the tokens spell."""
        got, ends = joined(self.spelling, lists.flatten(), lists.offsets.to_numpy())
        return np.array([got[x:y] == t for x, y, t in zip(ends, ends[1:], units, strict=False)], bool)


def joined(values: pa.Array, places: pa.Array, bounds: np.ndarray) -> tuple[memoryview, list[int]]:
    """The values at these places behind each other, as bytes, and where in them each bound falls."""
    taken = pc.take(values, places)
    ends = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1, taken.offset * 8)
    return memoryview(taken.buffers()[2] or b"").cast("B"), ends[bounds].tolist()


@lru_cache(maxsize=1)
def sides(definition: str, model: bytes) -> tuple[Side, Side, pa.Array]:
    """Both tokenizers of a Python worker, and the written ids with their marks: A's, then B's."""
    a, b = Side(ByteTokens(definition), ",|"), Side(PieceTokens(model), ",;")
    return a, b, pa.array([f"{i}{m}" for s in (a, b) for m in s.marks for i in range(s.size)], pa.large_string())


def token_ends(side: Side, lists: pa.ListArray, bases: np.ndarray) -> pa.Table:
    """Flat tokens: their unit's index, id and end, counted from the end of the unit before (sums restart with each unit)."""
    parent, ids = lists.value_parent_indices(), lists.flatten()
    total = pc.cumulative_sum(pc.take(side.length, ids))
    starts = np.concatenate([[0], total.to_numpy()])[lists.offsets.to_numpy()[:-1]]  # what is summed up before each unit
    end = pc.subtract(total, pc.take(pa.array(starts), parent))
    # unit and end as one key: the bytes of all units before, and those of this one up to the end
    key = pc.add(pc.take(pa.array(bases), parent), end)
    return pa.table({"unit": pc.cast(parent, pa.int64()), "id": pc.cast(ids, pa.int64()), "key": key, "at": pa.array(np.arange(len(ids)))})


class Units:
    """Alignments of words or texts: counts, linked pairs and written groups of each, none where ``good`` is false."""

    def __init__(self, a: Side, b: Side, written: pa.Array, words: list[bytes], whole: list[bytes]):
        units = words + whole
        spaced = [b" " + t if t else b"" for t in units]
        la, lb = a.lists(words, whole), b.lists(words, whole)
        self.good = a.spelled_alike(la, spaced) & b.spelled_alike(lb, spaced)
        if not self.good.all():
            spaced = [t if g else b"" for t, g in zip(spaced, self.good.tolist(), strict=True)]
            la, lb = (x.lists([], [t[1:] for t in spaced]) for x in (a, b))
        bases = np.cumsum([0, *map(len, spaced)])
        ta, tb = token_ends(a, la, bases[:-1]), token_ends(b, lb, bases[:-1])
        cuts = ta.select(["key", "at"]).join(tb.select(["key", "at"]).rename_columns(["key", "at_b"]), "key", join_type="inner", use_threads=False)
        cut_a, cut_b = np.zeros(len(ta), bool), np.zeros(len(tb), bool)
        cut_a[cuts["at"].to_numpy()] = True
        cut_b[cuts["at_b"].to_numpy()] = True
        rows = len(units)
        at_a, at_b = la.offsets.to_numpy(), lb.offsets.to_numpy()
        self.n_a, self.n_b = np.diff(at_a).astype(np.int64), np.diff(at_b).astype(np.int64)
        self.n_groups = np.bincount(ta["unit"].to_numpy()[cut_a], minlength=rows)
        # parts that belong to one token of each, in order, and which of the two end there
        marks = np.zeros(int(bases[-1]) + 1, np.uint8)
        marks[ta["key"].to_numpy()] = 1
        marks[tb["key"].to_numpy()] |= 2
        ends = marks[np.flatnonzero(marks)]
        in_a, in_b = ends & 1, ends >> 1
        part_a, part_b = np.cumsum(in_a, dtype=np.int64) - in_a, np.cumsum(in_b, dtype=np.int64) - in_b
        pair = ta["id"].to_numpy()[part_a] * b.size + tb["id"].to_numpy()[part_b]
        self.n_links = np.bincount(ta["unit"].to_numpy()[part_a], minlength=rows)
        self.pairs = listed(pair, self.n_links, pa.int64())
        # a token is written behind all tokens of earlier groups, B's behind A's of its group
        a_before, b_before = np.concatenate([[0], np.flatnonzero(cut_a) + 1]), np.concatenate([[0], np.flatnonzero(cut_b) + 1])
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        entry = np.empty(len(ta) + len(tb), np.int64)
        entry[np.arange(len(ta)) + b_before[group_a]] = ta["id"].to_numpy() + cut_a * a.size
        entry[np.arange(len(tb)) + a_before[group_b + 1]] = 2 * a.size + tb["id"].to_numpy() + cut_b * b.size
        data, bounds = joined(written, pa.array(entry), at_a + at_b)
        self.groups = pa.Array.from_buffers(pa.large_binary(), rows, [None, pa.py_buffer(np.array(bounds, np.int64)), pa.py_buffer(data)])


class Aligned:
    """The alignment of some texts, made of that of their different words where both tokenizers work word by word."""

    def __init__(self, a: Side, b: Side, written: pa.Array, texts: pa.Array, whole: np.ndarray | None = None):
        texts = pc.fill_null(texts, "")
        if whole is None:
            by_words = a.tokens.by_words and b.tokens.by_words
            whole = pc.match_substring_regex(texts, MEETING_SPACES).to_numpy(zero_copy_only=False) if by_words else np.ones(len(texts), bool)
        lists = pc.split_pattern(pc.if_else(pa.array(whole), "", texts), " ")
        words = lists.flatten().dictionary_encode()
        at, code = lists.offsets.to_numpy(), words.indices.to_numpy().copy()
        code[at[:-1][whole]] = (0 if whole.all() else len(words.dictionary)) + np.arange(whole.sum())
        units = Units(a, b, written, utf8(words.dictionary) if not whole.all() else [], utf8(texts.filter(pa.array(whole))))
        doubt = np.logical_or.reduceat(~units.good[code], at[:-1]) & ~whole
        if doubt.any():  # a word that isn't spelled alike is judged within its text
            self.__init__(a, b, written, texts, whole | doubt)
            return
        self.rows = len(texts)
        for k in FACTS:
            setattr(self, k, np.add.reduceat(getattr(units, k)[code], at[:-1]))
        data, ends = joined(units.groups, pa.array(code), at)
        self.groups = [data[x : max(x, y - 1)] for x, y in zip(ends, ends[1:], strict=False)]
        linked = pa.table({"text": np.repeat(np.arange(self.rows), self.n_links), "pair": pc.take(units.pairs, pa.array(code)).flatten()})
        linked = linked.group_by(["text", "pair"], use_threads=False).aggregate([([], "count_all")])
        order = np.argsort(linked["text"].to_numpy(), kind="stable")  # all but in order already
        self.text, self.pair, self.times = (linked[c].to_numpy()[order] for c in ("text", "pair", "count_all"))


FACTS = ("n_a", "n_b", "n_groups", "n_links")
BLOCKS = (
    "block long, id {id}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string{groups}, "
    "linked array<int>, times array<int>, block_pairs array<long>, block_texts array<int>"
)


def listed(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values, kind))


def blocks(docs: DataFrame, definition: str, model: bytes, id_col: str, text_col: str, groups: bool) -> DataFrame:
    """One row for each text with its links as places in its block's list of pairs, and one row for each block with that list."""
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = BLOCKS.format(id=chosen.schema["id"].dataType.simpleString(), groups=", groups string" if groups else "")

    def emit(block: int, ids: list[pa.Array], found: list[Aligned]) -> pa.RecordBatch:
        pairs = pa.array(np.concatenate([f.pair for f in found])).dictionary_encode()
        place = pairs.indices.to_numpy()
        held = np.concatenate([np.bincount(f.text, minlength=f.rows) for f in found])
        n = len(held)
        whole = np.concatenate([f.times for f in found])
        digests = [hashlib.sha256(g).hexdigest() if len(g) else "" for f in found for g in f.groups]
        # the last row is the block's: every other column is null or empty there
        last = lambda values: pa.array([*values, None], pa.int64())
        columns = [pa.array(np.full(n + 1, block), pa.int64()), pa.concat_arrays([*ids, pa.nulls(1, ids[0].type)])]
        columns += [last(np.concatenate([getattr(f, k) for f in found]).tolist()) for k in FACTS]
        columns += [pa.array([*digests, None], pa.string())]
        columns += [pa.array([*(bytes(g).decode() for f in found for g in f.groups), None], pa.string())] if groups else []
        columns += [listed(place, np.append(held, 0), pa.int32()), listed(whole, np.append(held, 0), pa.int32())]
        one = np.append(np.zeros(n, np.int64), len(pairs.dictionary))
        columns += [listed(pairs.dictionary.to_numpy(), one, pa.int64()), listed(np.bincount(place, minlength=len(pairs.dictionary)), one, pa.int32())]
        return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, written = sides(definition, model)
        block, held = TaskContext.get().partitionId() << 32, 0
        ids: list[pa.Array] = []
        found: list[Aligned] = []
        try:
            for batch in batches:
                for part in pieces_of(batch, STEP):
                    ids.append(part.column(0))
                    found.append(Aligned(a, b, written, part.column(1)))
                    held += part.nbytes
                    if held >= BLOCK:
                        made = emit(block, ids, found)
                        block, held, ids, found = block + 1, 0, [], []
                        yield made
                        del made
                        trim()
            if found:
                yield emit(block, ids, found)
        finally:
            trim()

    return chosen.mapInArrow(run, schema)


def pair_counts(made: DataFrame, size_b: int) -> tuple[DataFrame, DataFrame]:
    """Every pair of linked ids with the number of texts that hold it, and the blocks that ask for it."""
    asked = made.filter("size(block_pairs) > 0").select("block", F.posexplode(F.arrays_zip("block_pairs", "block_texts")).alias("place", "x"))
    asked = asked.select("block", "place", F.col("x.block_pairs").alias("pair"), F.col("x.block_texts").alias("texts"))
    counts = store(asked.groupBy("pair").agg(F.sum("texts").alias("count")), "align-counts")
    counts = counts.withColumns({"a": (F.col("pair") / size_b).cast("int"), "b": (F.col("pair") % size_b).cast("int")})
    # one row for each id of A at most, so the vocabulary bounds what is broadcast
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(F.broadcast(most), "a").select("pair", "a", "b", "count", (F.col("count") == F.col("most")).alias("best")), asked.drop("texts")


def align(docs: DataFrame, definition: str, model: bytes, id_col: str = "doc_id", text_col: str = "text", groups: bool = False) -> tuple[DataFrame, DataFrame]:
    """(one row for each text: counts of tokens, groups and links, how the links rank; all linked pairs of ids with counts).

    With groups, the texts' rows hold their groups as text too.
    """
    a_size, b_size = sides(definition, model)[0].size, sides(definition, model)[1].size
    if a_size * b_size >= 1 << 52:
        raise ValueError("the vocabularies are too large for their pairs to be numbers")
    made = store(blocks(docs, definition, model, id_col, text_col, groups), "align-blocks")
    counts, asked = pair_counts(made, b_size)
    answers = asked.join(counts.select("pair", "count", "best"), "pair").select(F.col("block").alias("of_block"), "place", "count", "best")
    cols = ["id", *FACTS, "groups_sha256", *(["groups"] if groups else [])]
    texts = made.filter("n_a IS NOT NULL").select("block", *cols, "linked", "times")
    kinds = {f.name: f.dataType.simpleString() for f in texts.schema.fields}
    schema = ", ".join(f"{c} {kinds[c]}" for c in cols) + ", n_best long, count_sum long"

    def settle(rows: pa.Table, got: pa.Table) -> pa.Table:
        linked, times = (rows[c].combine_chunks() for c in ("linked", "times"))
        count, best = np.zeros(len(got), np.int64), np.zeros(len(got), bool)
        place = got["place"].to_numpy()
        count[place], best[place] = got["count"].to_numpy(), got["best"].to_numpy()
        at, n = linked.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(linked).to_numpy())])
        sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[ends])
        return rows.select(cols).append_column("n_best", pa.array(sums(n * best[at]), pa.int64())).append_column("count_sum", pa.array(sums(n * count[at]), pa.int64()))

    settled = texts.groupBy("block").cogroup(answers.groupBy("of_block")).applyInArrow(settle, schema)
    return settled, counts.drop("pair")
