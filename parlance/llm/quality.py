"""Quality rules with repeats found through suffix arrays.

``assess`` appends one struct per document. Repeats come from a suffix array over the document's words: the
longest common prefixes of neighbouring suffixes bound every maximal repeated word sequence, the union of
those sequences is the covered part, and a document passes when the covered fraction and the longest repeat
stay within limits. Suffix arrays of many documents are built together (prefix doubling in numpy), so the
cost of a short document is that of its words.

Defined results: a null or empty text has no words and fails the rules; repeated rows each get their own
result; columns besides the text pass through, and one named like the output is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlance.llm.common import slices, utf8, with_struct

SYMBOLS = b"#*$%&|<>"
#: Words in one suffix-array build: bounds a worker's memory to some tens of MB (a longer document alone takes more).
CHUNK_WORDS = 200_000


@dataclass(frozen=True)
class Limits:
    min_words: int = 10
    window: int = 5
    max_window_percent: int = 20
    #: Maximal repeats of at least this many words count as covered.
    repeat_words: int = 10
    max_covered: float = 0.2
    #: A repeat longer than this fails a document, whatever its share.
    max_repeat: int = 50


FIELDS = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_words", "longest_repeat")]
    + [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())]
)


def suffix_ranks(ids: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of concatenated documents and, for each power of two, the ranks of prefixes of that length.

    ids: a number for each word, different between documents; end: for each position, where its document ends.
    Two ranks of level l are equal only if 2**l words are equal and lie inside one document.
    """
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    first = np.r_[True, ids[order][1:] != ids[order][:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    levels, h = [rank], 1
    alone = np.empty(n, bool)
    alone[order] = first & np.r_[first[1:], True]
    active = np.flatnonzero(~alone)
    while len(active):
        nxt = active + h
        second = np.where(nxt < end[active], rank[np.minimum(nxt, n - 1)] + 1, 0)
        key = rank[active] * (n + 1) + second
        by = np.argsort(key, kind="stable")
        key, moved = key[by], active[by]
        group = rank[moved]
        at = np.arange(len(by))
        new = np.r_[True, key[1:] != key[:-1]]
        top = np.r_[True, group[1:] != group[:-1]]
        offset = np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(top, at, 0))
        rank = rank.copy()
        rank[moved] = group + offset
        levels.append(rank)
        active = moved[~(new & np.r_[new[1:], True])]
        h *= 2
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    return suffixes, levels


def neighbour_lcp(suffixes: np.ndarray, levels: list[np.ndarray], end: np.ndarray) -> np.ndarray:
    """For each suffix-array row but the first, the common prefix with the row before, in words."""
    n = len(suffixes)
    a, b, got = suffixes[:-1], suffixes[1:], np.zeros(max(0, n - 1), np.int64)
    todo = np.flatnonzero(levels[0][a] == levels[0][b])
    a, b, part = a[todo], b[todo], np.zeros(len(todo), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        x, y = a + part, b + part
        inside = (x < end[a]) & (y < end[b])
        same = inside & (levels[level][np.minimum(x, n - 1)] == levels[level][np.minimum(y, n - 1)])
        part += same * (1 << level)
    got[todo] = part
    return got


def covered(start: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in a span."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, start, 1)
    np.add.at(steps, start + length, -1)
    return np.cumsum(steps[:n]) > 0


def repeats(words: list[list[bytes]], limits: Limits) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each document: words in repeated windows, words in long repeats, words of the longest repeat."""
    sizes = np.array([len(w) for w in words], np.int64)
    n, m = int(sizes.sum()), len(words)
    if not n:
        return (np.zeros(m, np.int64),) * 3
    doc = np.repeat(np.arange(m), sizes)
    end = np.repeat(np.cumsum(sizes), sizes)
    codes = pd.factorize(np.array([x for w in words for x in w], object))[0].astype(np.int64)
    suffixes, levels = suffix_ranks(doc * (int(codes.max()) + 1) + codes, end)
    lcp = neighbour_lcp(suffixes, levels, end)
    longest_at = np.zeros(n, np.int64)
    longest_at[suffixes] = np.maximum(np.r_[0, lcp], np.r_[lcp, 0])

    def total(least: int) -> np.ndarray:
        at = np.flatnonzero(longest_at >= least)
        return np.bincount(doc[covered(at, longest_at[at], n)], minlength=m)

    most = np.zeros(m, np.int64)
    np.maximum.at(most, doc, longest_at)
    return total(limits.window), total(limits.repeat_words), most


def duplicate_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def measure(texts: list[bytes], limits: Limits) -> dict[str, np.ndarray]:
    words = [t.split() for t in texts]
    n_words = np.array([len(w) for w in words], np.int64)
    parts = [repeats(words[a:b], limits) for a, b in slices(n_words.tolist(), CHUNK_WORDS)]
    window, long_, most = (np.concatenate(x) if parts else np.zeros(0, np.int64) for x in (zip(*parts, strict=True) if parts else ((), (), ())))
    failed = (n_words < limits.min_words) | (100 * window > limits.max_window_percent * n_words)
    too_much = (long_ > limits.max_covered * n_words) | (most > limits.max_repeat)
    return {
        "n_words": n_words,
        # code points are the bytes that don't continue a character
        "word_chars": np.array([len(b"".join(w).decode("utf-8", "replace")) for w in words], np.int64),
        "n_symbols": np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in texts], np.int64),
        "n_dup_lines": np.array([duplicate_lines(t) for t in texts], np.int64),
        "n_repeat_words": window,
        "n_covered_words": long_,
        "longest_repeat": most,
        "base_failed": failed,
        "kept": ~failed & ~too_much,
    }


def assess(docs: DataFrame, text_col: str = "text", out: str = "quality", limits: Limits = Limits()) -> DataFrame:
    """docs and a struct column of counts and the verdict ``kept``; one narrow Arrow pass, no shuffle."""

    def run(batch: pa.RecordBatch) -> pa.Array:
        got = measure(utf8(batch.column(batch.schema.get_field_index(text_col))), limits)
        return pa.StructArray.from_arrays([pa.array(got[f]) for f in FIELDS.names], FIELDS.names)

    return with_struct(docs, out, FIELDS, run)


def keep_good(docs: DataFrame, text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """The documents that pass, with their own columns."""
    return assess(docs, text_col, "__quality", limits).filter(F.col("__quality.kept")).drop("__quality")
