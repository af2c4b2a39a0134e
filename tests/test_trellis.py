import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from parlance.operators import trellis


def exhaustive(scores, tokens, blank=0):
    """The best sum over all rows of symbols that collapse to the tokens."""
    best = -np.inf
    for row in itertools.product(range(scores.shape[1]), repeat=len(scores)):
        spelled = [s for k, s in enumerate(row) if s != blank and (not k or s != row[k - 1])]
        if spelled == tokens:
            best = max(best, sum(scores[t, s] for t, s in enumerate(row)))
    return best


@pytest.mark.parametrize("block", [1, 2, 3, 256])
def test_best_paths(monkeypatch, block):
    monkeypatch.setattr(trellis, "BLOCK", block)
    rng = np.random.default_rng(block)
    for frames, tokens in ((1, [1]), (4, [1, 2]), (5, [2, 2]), (6, [1, 1, 2]), (6, [3, 1, 3]), (2, [1, 1]), (3, [])):
        for _ in range(6):
            scores = rng.normal(size=(frames, 4))
            total, path = trellis.best_path(scores, np.array(tokens, int))
            want = exhaustive(scores, tokens)
            assert total == pytest.approx(want)
            if np.isfinite(want):
                symbol, _ = trellis.states_of(np.array(tokens, int), 0)
                row = symbol[path].tolist()
                assert sum(scores[t, s] for t, s in enumerate(row)) == pytest.approx(want)
                assert [s for k, s in enumerate(row) if s and (not k or path[k] != path[k - 1])] == tokens
            else:
                assert len(path) == 0


def test_blocks_do_not_change_paths(monkeypatch):
    rng = np.random.default_rng(8)
    scores, tokens = rng.normal(size=(700, 30)), rng.integers(1, 30, 90)
    paths = []
    for block in (7, 64, 256, 1000):
        monkeypatch.setattr(trellis, "BLOCK", block)
        paths.append(trellis.best_path(scores, tokens)[1].tolist())
    assert all(p == paths[0] for p in paths)


def test_words_of_segments(spark):
    vocabulary = {"-": 0, "|": 1, "a": 2, "b": 3, "c": 4}
    spoken = {"one": "--aab-||cc-", "two": "ab|c|bb", "short": "a"}
    frames = [(k, i, [(0.0 if j == vocabulary[c] else -5.0) for j in range(5)]) for k, row in spoken.items() for i, c in enumerate(row)] + [("no text", 0, [0.0] * 5)]
    targets = [("one", "ab  c", 10.0), ("two", "ab xcx b", 0.0), ("short", "abc", 0.0), ("no frames", "a", 0.0), ("blank", " ", 0.0)]
    f = spark.createDataFrame(frames, "segment_key string, frame_no long, scores array<double>").repartition(3)
    t = spark.createDataFrame(targets, "segment_key string, text string, offset_s double")
    got = trellis.align_words(f, t, vocabulary, 2.0).orderBy("segment_key", "word_no").collect()
    assert [(r["segment_key"], r["word"], r["start_s"], r["end_s"], r["confidence"]) for r in got] == [
        ("one", "ab", 11.0, 12.5, 1.0), ("one", "c", 14.0, 15.0, 1.0), ("two", "ab", 0.0, 1.0, 1.0), ("two", "c", 1.5, 2.0, 1.0), ("two", "b", 2.5, 3.5, 1.0),
    ]
    assert trellis.token_spans(f.limit(0), t.select("segment_key", F.array(F.lit(2)).alias("tokens"))).count() == 0
