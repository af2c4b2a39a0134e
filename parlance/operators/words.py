"""Frames and characters to words, and tightening of segments to their words."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.operators.inference import infer_rows
from parlance.schemas import WORD

UNSPACED = ("zho", "jpn", "kor")


def ctc_collapse(ids: Column, vocabulary: Column, blank: int = 0) -> Column:
    """Frame-wise best ids without repeats and blanks, as tokens; unknown and empty ones are dropped."""
    kept = F.filter(ids, lambda x, i: (x != blank) & ((i == 0) | (x != F.get(ids, i - 1))))
    return F.filter(F.transform(kept, lambda i: vocabulary[i]), lambda t: t.isNotNull() & (t != ""))


def words_from_characters(chars: DataFrame, frame_rate: float) -> DataFrame:
    """chars (segment_key, pos, char, frame, score, offset_s): characters between bars become a word.

    Start of the first, end of the last frame, mean of the scores held between 0 and 1.
    """
    w = Window.partitionBy("segment_key").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    marked = chars.withColumn("word_no", F.sum((F.col("char") == "|").cast("int")).over(w)).filter("char <> '|'")
    return marked.groupBy("segment_key", "word_no").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "char"))), lambda x: x["char"]), "").alias("word"),
        (F.min("offset_s") + F.min("frame") / frame_rate).alias("start_s"),
        (F.min("offset_s") + (F.max("frame") + 1) / frame_rate).alias("end_s"),
        F.avg(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score")))).alias("confidence"),
    )


def tighten(segments: DataFrame) -> DataFrame:
    """A segment starts with its first word and ends no earlier than its last, if it has words and is long enough."""
    n = F.size("words")
    apply = (n > 0) & (F.col("end_s") - F.col("start_s") >= 0.1) & ~F.col("language").isin(*UNSPACED)
    first, last = F.get("words", F.lit(0)), F.get("words", n - 1)
    return segments.withColumns({"start_s": F.when(apply, first["start_s"]).otherwise(F.col("start_s")), "end_s": F.when(apply, F.greatest("end_s", last["end_s"])).otherwise(F.col("end_s"))})


def align(segments: DataFrame, factory: Callable[[], Callable[[dict], list[dict]]], inputs: tuple[str, ...] = ("raw_text", "language")) -> DataFrame:
    """Segments with the words that an aligner finds, drawn in to them; where it fails or finds none, a segment stays.

    The model gets recording_id, pos, start_s, end_s and the inputs, and gives rows of word, start_s, end_s and
    confidence. ``align_error`` says why a segment stayed.
    """
    keys = ["recording_id", "pos"]

    def words_of() -> Callable[[dict], list[dict]]:
        model = factory()
        return lambda row: [{"found": [(w["word"], w["start_s"], w["end_s"], w["confidence"]) for w in model(row)]}]

    words_of.__qualname__ = f"{factory.__module__}.{factory.__qualname__}"  # a worker keeps models by name
    got = infer_rows(segments, words_of, keys, [*keys, "start_s", "end_s", *inputs], f"found array<{WORD}>").select(*keys, "found", F.col("error").alias("align_error"))
    out = segments.join(got, keys, "left")
    return tighten(out.withColumn("words", F.when(F.size("found") > 0, F.col("found")).otherwise(F.col("words"))).drop("found"))
