"""Alignment of characters to frames: the best path through frame scores that spells a text, with blanks between.

A path is in one of 2n + 1 states at each frame: one for each of the n tokens, and a blank before, between and behind
them. From frame to frame it stays, goes on by one state, or passes over a blank between two different tokens. Scores
of all frames are added up. Going forward, only every so many frames' states are kept; back pointers are made again for
one block of frames at a time, from the last block to the first, so memory is that of a block, not of frames times text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.operators.words import words_from_characters

#: Frames whose back pointers are held at once.
BLOCK = 256


def states_of(tokens: np.ndarray, blank: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbol of each state, and whether it may be entered from two states before."""
    symbol = np.full(2 * len(tokens) + 1, blank, np.int64)
    symbol[1::2] = tokens
    skip = np.zeros(len(symbol), bool)
    skip[3::2] = tokens[1:] != tokens[:-1]
    return symbol, skip


def forward(state: np.ndarray, emitted: np.ndarray, skip: np.ndarray, back: np.ndarray | None = None) -> np.ndarray:
    """Scores of the states a frame later; back gets how many states each came on. Ties go to the fewest."""
    one, two = np.full_like(state, -np.inf), np.full_like(state, -np.inf)
    one[1:] = state[:-1]
    two[2:] = np.where(skip[2:], state[:-2], -np.inf)
    best = np.maximum(np.maximum(state, one), two)
    if back is not None:
        back[:] = np.where(state == best, 0, np.where(one == best, 1, 2))
    return best + emitted


def best_path(scores: np.ndarray, tokens: np.ndarray, blank: int = 0) -> tuple[float, np.ndarray]:
    """(score, state of each frame) of the best path through scores (frames by symbols); -inf if no path spells the tokens."""
    symbol, skip = states_of(tokens, blank)
    n = len(scores)
    state = np.full(len(symbol), -np.inf)
    state[: min(2, len(symbol))] = scores[0, symbol[:2]]
    kept = {0: state}
    for t in range(1, n):
        state = forward(state, scores[t, symbol], skip)
        if t % BLOCK == 0:
            kept[t] = state
    ends = [len(symbol) - 1] if len(symbol) == 1 else [len(symbol) - 1, len(symbol) - 2]
    at = max(ends, key=lambda s: state[s])
    total = float(state[at])
    path = np.empty(n, np.int64)
    if total == -np.inf:
        return total, path[:0]
    for start in sorted(kept, reverse=True):
        stop = min(n, start + BLOCK)
        back, state = np.zeros((stop - start, len(symbol)), np.uint8), kept[start]
        for t in range(start + 1, stop):
            state = forward(state, scores[t, symbol], skip, back[t - start])
        for t in range(stop - 1, start, -1):
            path[t] = at
            at -= back[t - start, at]
        path[start] = at
        if start:  # the step into this block, from the frame before it
            before = kept[start - BLOCK]
            for t in range(start - BLOCK + 1, start):
                before = forward(before, scores[t, symbol], skip)
            step = np.zeros(len(symbol), np.uint8)
            forward(before, scores[start, symbol], skip, step)
            at -= step[at]
    return total, path


def token_spans(frames: DataFrame, targets: DataFrame, key: str = "segment_key", blank: int = 0) -> DataFrame:
    """(key, pos, token, frame, last_frame, score): the frames of each token on the best path, and their mean score.

    frames (key, frame_no, scores) are a segment's, which chunking bounds; targets (key, tokens). Segments without
    frames, with tokens that no symbol of the scores is, or with too few frames for their tokens give no rows, as does
    an empty text.
    """
    f = frames.select(F.col(key).alias("k"), "frame_no", F.col("scores").cast("array<double>").alias("scores"))
    t = targets.select(F.col(key).alias("_k"), F.col("tokens").cast("array<int>").alias("tokens"))
    kind = f.schema["k"].dataType.simpleString()

    def run(rows: pa.Table, wanted: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(rows) and len(wanted):
            rows = rows.sort_by("frame_no")
            scores = np.array(rows["scores"].to_pylist(), np.float64)
            tokens = np.array(wanted["tokens"][0].as_py() or [], np.int64)
            if len(tokens) and scores.ndim == 2 and 0 <= tokens.min() and tokens.max() < scores.shape[1]:
                _, path = best_path(scores, tokens, blank)
                number, name = rows["frame_no"].to_pylist(), rows["k"][0].as_py()
                for k, token in enumerate(tokens.tolist() if len(path) else []):
                    mine = np.flatnonzero(path == 2 * k + 1)
                    out.append((name, k, token, number[mine[0]], number[mine[-1]], float(scores[mine, token].mean())))
        columns = list(zip(*out, strict=True)) or [()] * 6
        kinds = [rows.schema.field("k").type, pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.float64()]
        return pa.table([pa.array(list(c), x) for c, x in zip(columns, kinds, strict=True)], names=["k", "pos", "token", "frame", "last_frame", "score"])

    found = f.groupBy("k").cogroup(t.groupBy("_k")).applyInArrow(run, f"k {kind}, pos int, token int, frame long, last_frame long, score double")
    return found.withColumnRenamed("k", key)


def align_words(frames: DataFrame, targets: DataFrame, vocabulary: dict[str, int], frame_rate: float, key: str = "segment_key", blank: int = 0, bar: str = "|") -> DataFrame:
    """(segment_key, word_no, word, start_s, end_s, confidence) of texts aligned to frames of log scores.

    targets (key, text, offset_s). Words are cut at spaces and joined by bars, if the vocabulary has one; characters
    that it lacks are left out of the alignment, but each word keeps its own characters and times.
    """
    entries = F.create_map(*[F.lit(x) for item in vocabulary.items() for x in item])
    chars = F.filter(F.split(F.regexp_replace(F.trim("text"), r"\s+", bar), ""), lambda c: c != "")
    known = targets.select(F.col(key), "offset_s", F.filter(chars, lambda c: F.map_contains_key(entries, c)).alias("chars"))
    spans = token_spans(frames, known.select(key, F.transform("chars", lambda c: entries[c]).alias("tokens")), key, blank)
    named = spans.join(known, key).select(F.col(key).alias("segment_key"), "pos", F.element_at("chars", F.col("pos") + 1).alias("char"), "frame", F.exp("score").alias("score"), "offset_s", "last_frame")
    firsts = words_from_characters(named.drop("last_frame"), frame_rate).select("segment_key", "word_no", "word", "start_s", "confidence")
    lasts = words_from_characters(named.drop("frame").withColumnRenamed("last_frame", "frame"), frame_rate).select("segment_key", "word_no", "end_s")
    return firsts.join(lasts, ["segment_key", "word_no"])
