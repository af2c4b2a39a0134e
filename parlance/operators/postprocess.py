"""Correction, translation and refinement of segments around a text model."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parlance.functions.text import fill, guarded, numbered_block, parse_numbered, sentences
from parlance.operators.inference import infer_text

Factory = Callable[[], Callable[[list[dict]], list[str]]]
UNSUPPORTED = ("mya", "khm")
REFINE = "Refine these {language} interview turns. Answer with one numbered line for each.\n\n{block}"
CLEAN = "Clean up these interview turns. Answer with one numbered line for each.\n\n{block}"


def correct(segments: DataFrame, model: Factory | None) -> DataFrame:
    """``corrected_text``: the model's reply where it is safe, else the raw text, which stays."""
    if model is None:
        return segments.withColumn("corrected_text", F.col("raw_text"))
    out = infer_text(segments, ["raw_text", "language"], model, "_reply")
    return out.withColumn("corrected_text", guarded(F.col("_reply"), F.col("raw_text"))).drop("_reply", "_reply_error")


def translate(segments: DataFrame, model: Factory | None, fallback: Factory | None = None, source: str = "corrected_text") -> DataFrame:
    """``english_translation`` of each segment.

    Blank stays blank; English is copied; a language that the model lacks goes to the fallback; an empty reply,
    and everything without a model, is the source text. Rows of a language are brought together for the model,
    in slices, so that a language of most rows is no single task.
    """
    src = F.coalesce(F.col(source), F.lit(""))
    if model is None:
        return segments.withColumn("english_translation", src)
    foreign = (F.col("language") != "eng") & (F.trim(src) != "")
    plain = segments.filter(~foreign).withColumn("english_translation", F.when(F.trim(src) == "", "").otherwise(src))
    rare = F.col("language").isin(*UNSUPPORTED)

    def through(df: DataFrame, m: Factory | None) -> DataFrame:
        if m is None:
            return df.withColumn("english_translation", src)
        dealt = df.withColumn("_slice", F.pmod(F.xxhash64("recording_id", "pos"), F.lit(64))).repartition("language", "_slice").drop("_slice")
        out = infer_text(dealt, [source, "language"], m, "_reply")
        return out.withColumn("english_translation", F.coalesce(F.nullif(F.trim("_reply"), F.lit("")), src)).drop("_reply", "_reply_error")

    return plain.unionByName(through(segments.filter(foreign & ~rare), model)).unionByName(through(segments.filter(foreign & rare), fallback))


def translate_legacy(segments: DataFrame, model: Factory | None) -> DataFrame:
    """The older rules: English is its raw text; without a model other languages are blank; failures are blank."""
    english = F.col("language") == "eng"
    if model is None:
        return segments.withColumn("english_translation", F.when(english, F.col("raw_text")).otherwise(""))
    out = infer_text(segments, ["raw_text", "language"], model, "_reply")
    return out.withColumn("english_translation", F.when(english, F.col("raw_text")).otherwise(F.coalesce(F.trim("_reply"), F.lit("")))).drop("_reply", "_reply_error")


def context(segments: DataFrame, size: int = 3, mark: str = ">>> CURRENT SEGMENT <<<") -> DataFrame:
    """``context``: the turns before and after each, as ``[speaker] text``, with a mark for the turn itself."""
    text = F.coalesce(F.nullif(F.col("english_translation"), F.lit("")), F.col("raw_text"))
    line = F.concat(F.lit("["), F.col("speaker_id"), F.lit("] "), text)
    w = Window.partitionBy("recording_id").orderBy("pos")
    around = F.concat(F.collect_list(line).over(w.rowsBetween(-size, -1)), F.array(F.lit(mark)), F.collect_list(line).over(w.rowsBetween(1, size)))
    return segments.withColumn("context", F.array_join(around, "\n"))


def batches(segments: DataFrame, size: int = 10) -> DataFrame:
    """segments with text to refine, with their batch and number in it: of one recording and language, in order."""
    w = Window.partitionBy("recording_id", "language").orderBy("pos")
    rows = segments.filter(F.trim(F.coalesce("english_translation", F.lit(""))) != "").withColumn("_k", F.row_number().over(w) - 1)
    return rows.withColumns({"batch": F.floor(F.col("_k") / size).cast("int"), "seq": (F.col("_k") % size + 1).cast("int")}).drop("_k")


def refine(segments: DataFrame, model: Factory | None, size: int = 10, max_tokens: int = 1024, most: int = 4) -> DataFrame:
    """``refined_translation``: one model call for each batch, its numbered lines spread back over the segments.

    The model gets a ``prompt`` and ``max_tokens``, the reply's budget: so many for each segment, for ``most`` at most.
    """
    if model is None:
        return segments.withColumn("refined_translation", F.col("english_translation"))
    b = batches(segments, size)
    item = F.struct("seq", "speaker_id", "raw_text", F.col("english_translation").alias("translation"))
    prompts = b.groupBy("recording_id", "language", "batch").agg(F.array_sort(F.collect_list(item)).alias("items"))
    prompt = F.when(F.col("language") == "eng", fill(CLEAN, block=numbered_block(F.col("items"), False))).otherwise(fill(REFINE, language=F.col("language"), block=numbered_block(F.col("items"), True)))
    asked = infer_text(prompts.select("recording_id", "language", "batch", prompt.alias("prompt"), (F.least(F.size("items"), F.lit(most)) * max_tokens).alias("max_tokens")), ["prompt", "max_tokens"], model, "_reply")
    lines = asked.select("recording_id", "language", "batch", F.explode(parse_numbered(F.col("_reply"))).alias("seq", "line"))
    found = b.select("recording_id", "language", "batch", "seq", "pos").join(lines, ["recording_id", "language", "batch", "seq"]).select("recording_id", "pos", "line")
    return segments.join(found, ["recording_id", "pos"], "left").withColumn("refined_translation", F.coalesce("line", "english_translation")).drop("line")


def process(segments: DataFrame, corrector: Factory | None = None, translator: Factory | None = None, refiner: Factory | None = None, fallback: Factory | None = None) -> DataFrame:
    """All three steps; every column stays on its row."""
    return refine(translate(correct(segments, corrector), translator, fallback), refiner)


def translate_runs(runs: DataFrame, model: Factory) -> DataFrame:
    """Benchmark rows with a translation, made sentence by sentence; failed and blank rows have none, English is copied."""
    ok = F.col("error").isNull() & (F.trim(F.coalesce("transcript", F.lit(""))) != "")
    rows = runs.filter(ok & (F.col("language") != "eng")).select("model_id", "audio_file", F.posexplode(sentences(F.col("transcript"))).alias("k", "sentence"))
    done = infer_text(rows, ["sentence"], model, "_reply")
    joined = done.groupBy("model_id", "audio_file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "_reply"))), lambda x: x["_reply"]), " ").alias("_tr"))
    return runs.drop("translation").join(joined, ["model_id", "audio_file"], "left").withColumn("translation", F.when(ok & (F.col("language") == "eng"), F.col("transcript")).when(ok, F.col("_tr"))).drop("_tr")


def two_pass(df: DataFrame, source: str, corrector: Factory, translator: Factory) -> DataFrame:
    """Corrected text of a source column, then the translation of what was corrected."""
    fixed = infer_text(df, [source], corrector, "corrected").drop("corrected_error")
    return infer_text(fixed, ["corrected"], translator, "translated").drop("translated_error")


def combined(df: DataFrame, source: str, model: Factory) -> DataFrame:
    """Both from one reply of two lines, ``BN: …`` and ``EN: …``; a line that is missing is null."""
    out = infer_text(df, [source], model, "_reply")
    line = lambda mark: F.nullif(F.regexp_extract("_reply", rf"(?m)^{mark}:[ \t]*(.*)$", 1), F.lit(""))
    return out.withColumns({"corrected": line("BN"), "translated": line("EN")}).drop("_reply", "_reply_error")
