"""Steps around models, with models that answer by rule: translation, refinement, failures, prompts, word timing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.functions import languages, text
from parlance.operators import dataset, inference, interviews, postprocess, words
from parlance.plans import fixtures as fx
from parlance.plans.meetings import SEGMENTS, placed
from parlance.storage import store

md5 = lambda c: F.md5(F.col(c).cast("binary"))
LANGUAGE = "CASE segment_id % 3 WHEN 0 THEN 'eng' WHEN 1 THEN 'fra' ELSE 'mya' END"
TRIM = r"'^[\s\x{85}\p{Z}]+|[\s\x{85}\p{Z}]+$', '', 'g'"


def spoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interview segments in three languages, of which one is not supported by the main translator."""
    s = placed(spark, sf_dir)
    lang = F.get(F.array(F.lit("eng"), F.lit("fra"), F.lit("mya")), F.col("segment_id") % 3)
    return s.select(F.col("interview_key").alias("recording_id"), F.col("segment_id").alias("pos"), "speaker_id", lang.alias("language"), "raw_text", F.col("raw_text").alias("corrected_text"))


def _main():
    def model(rows: list[dict]) -> list[str]:
        return ["<m> " + r["corrected_text"] for r in rows]

    return model


def _spare():
    def model(rows: list[dict]) -> list[str]:
        return ["<s> " + r["corrected_text"] for r in rows]

    return model


def _older():
    def model(rows: list[dict]) -> list[str]:
        return ["<o> " + r["raw_text"] for r in rows]

    return model


def _echo():
    def model(rows: list[dict]) -> list[str]:
        """Numbered lines: as many as the prompt's block has, each the line's number."""
        out = []
        for r in rows:
            numbers = [x.split(".", 1)[0] for x in r["prompt"].split("\n") if x.split(".", 1)[0].isdigit() and x.split(".", 1)[1].startswith(" [")]
            out.append("\n".join(f"{k}. refined {k}" for k in numbers))
        return out

    return model


def q_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English is copied, blank stays blank, an unsupported language goes to the spare model."""
    return postprocess.translate(spoken(spark, sf_dir), _main, _spare).select("recording_id", "pos", md5("english_translation").alias("english"))


TRANSLATION_SQL = f"""WITH s AS (SELECT interview_key, segment_id, half, {LANGUAGE} AS language FROM {SEGMENTS})
SELECT interview_key AS recording_id, CAST(segment_id AS INT) AS pos, md5(CASE WHEN trim(half, ' ') = '' THEN '' WHEN language = 'eng' THEN half WHEN language = 'fra' THEN trim('<m> ' || half, ' ') ELSE trim('<s> ' || half, ' ') END) AS english FROM s
"""


def q_older_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postprocess.translate_legacy(spoken(spark, sf_dir), _older).select("recording_id", "pos", md5("english_translation").alias("english"))


OLDER_SQL = f"""SELECT interview_key AS recording_id, CAST(segment_id AS INT) AS pos, md5(CASE WHEN {LANGUAGE} = 'eng' THEN half ELSE trim('<o> ' || half, ' ') END) AS english FROM {SEGMENTS}"""


def q_refinement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One call for each batch of ten of a language, its numbered lines spread back."""
    s = spoken(spark, sf_dir).withColumn("english_translation", F.col("raw_text"))
    return postprocess.refine(s, _echo).select("recording_id", "pos", md5("refined_translation").alias("refined"))


REFINED_SQL = f"""
WITH s AS (SELECT interview_key, segment_id, half, {LANGUAGE} AS language FROM {SEGMENTS}),
k AS (SELECT *, row_number() OVER (PARTITION BY interview_key, language ORDER BY segment_id) - 1 AS k FROM s WHERE trim(half, ' ') <> '')
SELECT s.interview_key AS recording_id, CAST(s.segment_id AS INT) AS pos, md5(CASE WHEN k IS NULL THEN s.half ELSE 'refined ' || (k % 10 + 1) END) AS refined FROM s LEFT JOIN k USING (interview_key, segment_id)
"""


def _spend():
    """A model that answers each numbered line with its budget."""

    def model(rows: list[dict]) -> list[str]:
        return ["\n".join(f"{k}. {r['max_tokens']}" for k in range(1, 11)) for r in rows]

    return model


def q_refine_budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reply's budget of each segment's batch: 50 tokens a segment, for four at most."""
    s = spoken(spark, sf_dir).withColumn("english_translation", F.col("raw_text"))
    return postprocess.refine(s, _spend, max_tokens=50).select("recording_id", "pos", md5("refined_translation").alias("refined"))


BUDGET_SQL = f"""
WITH s AS (SELECT interview_key, segment_id, half, {LANGUAGE} AS language FROM {SEGMENTS}),
k AS (SELECT *, row_number() OVER (PARTITION BY interview_key, language ORDER BY segment_id) - 1 AS k FROM s WHERE trim(half, ' ') <> ''),
n AS (SELECT *, count(*) OVER (PARTITION BY interview_key, language, k // 10) AS n FROM k)
SELECT s.interview_key AS recording_id, CAST(s.segment_id AS INT) AS pos, md5(CASE WHEN k IS NULL THEN s.half ELSE CAST(50 * least(n, 4) AS VARCHAR) END) AS refined FROM s LEFT JOIN n USING (interview_key, segment_id)
"""


def _turns_by_case() -> Callable[[dict], list[dict]]:
    """A rule in a diarizer's place: runs of words that begin alike, in capitals or not, are a speaker's turns of a second a word."""

    def run(row: dict) -> list[dict]:
        out: list[dict] = []
        for k, w in enumerate(row["text"].split(" ")):
            speaker = "SPEAKER_01" if w[:1].isupper() else "SPEAKER_00"
            if out and out[-1]["speaker_id"] == speaker:
                out[-1]["end_s"] = k + 1.0
            else:
                out.append({"turn_no": len(out), "speaker_id": speaker, "start_s": float(k), "end_s": k + 1.0})
        return out

    return run


def q_rule_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of whole documents by a rule model, with what they amount to."""
    d = fx.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    t = inference.infer_rows(d, _turns_by_case, ["id"], ["text"], "turn_no int, speaker_id string, start_s double, end_s double")
    return t.groupBy("id", "speaker_id").agg(F.count("*").alias("turns"), F.sum(F.col("end_s") - F.col("start_s")).alias("talk_s"), F.max(F.col("end_s") - F.col("start_s")).alias("longest_s"), F.count("error").alias("errors"))


TURN_RULE_SQL = r"""
WITH w AS (SELECT doc_id AS id, unnest(string_split(coalesce(text, ''), ' ')) AS w, unnest(range(len(string_split(coalesce(text, ''), ' ')))) AS k FROM documents),
s AS (SELECT id, k, CASE WHEN regexp_matches(w, '^\p{Lu}') THEN 'SPEAKER_01' ELSE 'SPEAKER_00' END AS speaker_id FROM w),
b AS (SELECT *, (lag(speaker_id) OVER (PARTITION BY id ORDER BY k) IS DISTINCT FROM speaker_id)::INT AS new FROM s),
t AS (SELECT id, speaker_id, count(*)::DOUBLE AS n FROM (SELECT *, sum(new) OVER (PARTITION BY id ORDER BY k) AS r FROM b) GROUP BY id, speaker_id, r)
SELECT id, speaker_id, count(*) AS turns, sum(n) AS talk_s, max(n) AS longest_s, 0 AS errors FROM t GROUP BY ALL
"""


def _pitch_marks() -> Callable[[list[dict]], list[list[dict]]]:
    """A rule in a phoneme model's place: a symbol for each word, its first letter, one batch a call."""
    return lambda rows: [[{"phonemes": "".join(w[:1] for w in r["text"].split(" "))}] for r in rows]


def q_rule_phonemes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols of whole conversation turns by a rule model that takes batches."""
    c = fx.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"))
    found = inference.infer_batches(c, _pitch_marks, ["conv_id", "turn"], ["text"], "phonemes string")
    return found.select("conv_id", "turn", md5("phonemes").alias("phonemes"), "error")


PHONEME_SQL = "SELECT conv_id, turn, md5(array_to_string(list_transform(string_split(coalesce(text, ''), ' '), lambda w: left(w, 1)), '')) AS phonemes, NULL AS error FROM conversations"


def q_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three steps without models: every text is what it was."""
    p = postprocess.process(spoken(spark, sf_dir).drop("corrected_text"))
    return p.select("recording_id", "pos", *[md5(c).alias(c) for c in ("corrected_text", "english_translation", "refined_translation")])


PROCESSED_SQL = f"SELECT interview_key AS recording_id, CAST(segment_id AS INT) AS pos, md5(half) AS corrected_text, md5(half) AS english_translation, md5(half) AS refined_translation FROM {SEGMENTS}"


def _loud():
    def model(rows: list[dict]) -> list[str]:
        return [r["sentence"].lower() for r in rows]

    return model


def q_run_translations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark runs translated sentence by sentence; failed runs have none, English is copied."""
    return postprocess.translate_runs(fx.runs(spark, sf_dir), _loud).select("model_id", "audio_file", md5("translation").alias("translation"))


RUN_SQL = f"""SELECT model_id, audio_file, md5(CASE WHEN error IS NULL AND language = 'eng' THEN transcript WHEN error IS NULL THEN lower(regexp_replace(transcript, {TRIM})) END) AS translation FROM {fx.RUNS}"""


def _ends():
    def model(rows: list[dict]) -> list[str]:
        return [next(iter(r.values()))[::-1] for r in rows]

    return model


def _both_lines():
    def model(rows: list[dict]) -> list[str]:
        return [f"BN: {len(r['text'])}\nEN: {r['text'][:3].strip()}x" for r in rows]

    return model


def q_two_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correct then translate, each by turning the text round; and both from one reply."""
    c = fx.table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    two = postprocess.two_pass(c, "text", _ends, _ends).select("conv_id", "turn", md5("corrected").alias("corrected"), md5("translated").alias("translated"))
    one = postprocess.combined(c, "text", _both_lines).select("conv_id", "turn", F.col("corrected").alias("n"), F.col("translated").alias("head"))
    return two.join(one, ["conv_id", "turn"])


TWO_PASS_SQL = r"""SELECT conv_id, turn, md5(array_to_string(list_reverse(string_split(text, '')), '')) AS corrected, md5(text) AS translated, CAST(length(text) AS VARCHAR) AS n,
  regexp_replace(left(text, 3), '^\s+|\s+$', '', 'g') || 'x' AS head FROM conversations"""


def _fragile():
    def model(row: dict) -> list[dict]:
        if row["turn"] % 3 == 2:
            raise ValueError("no")
        return [{"word": w, "n": len(w)} for w in row["text"].split(" ")[:2]]

    return model


def q_failing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model that gives two rows for each turn and fails on every third: a failed row has its error alone."""
    c = fx.table(spark, sf_dir, "conversations")
    return inference.infer_rows(c, _fragile, ["conv_id", "turn"], ["text", "turn"], "word string, n int").select("conv_id", "turn", "word", "n", "error")


FAILING_SQL = """WITH w AS (SELECT conv_id, turn, unnest(string_split(text, ' ')[1:2]) AS word FROM conversations WHERE turn % 3 <> 2)
SELECT conv_id, turn, word, length(word) AS n, CAST(NULL AS VARCHAR) AS error FROM w UNION ALL SELECT conv_id, turn, NULL, NULL, 'ValueError: no' FROM conversations WHERE turn % 3 = 2"""


def _strict_batch():
    def model(rows: list[dict]) -> list[list[dict]]:
        if any(r["turn"] % 5 == 4 for r in rows):
            raise ValueError("bad turn")
        return [[{"n": len(r["text"])}] for r in rows]

    return model


def q_batched_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model that takes batches; one bad row costs only itself."""
    c = fx.table(spark, sf_dir, "conversations")
    return inference.infer_batches(c, _strict_batch, ["conv_id", "turn"], ["text", "turn"], "n int", batch_size=16).select("conv_id", "turn", "n", "error")


BATCHED_SQL = "SELECT conv_id, turn, CASE WHEN turn % 5 <> 4 THEN length(text) END AS n, CASE WHEN turn % 5 = 4 THEN 'ValueError: bad turn' END AS error FROM conversations"


def q_region_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings in which a detector found nothing are one region."""
    r = fx.regions(spark, sf_dir).filter("CAST(recording_id AS LONG) % 4 <> 0")
    f = inference.region_fallback(r, fx.totals(spark, sf_dir))
    return f.select("recording_id", F.col("pos").cast("long").alias("pos"), fx.ticks("start_s"), fx.ticks("end_s"))


FALLBACK_SQL = f"""SELECT recording_id, pos, CAST(floor((t0 / 1e6) * 1e4 + 0.123) AS BIGINT) AS start_s, CAST(floor((t1 / 1e6) * 1e4 + 0.123) AS BIGINT) AS end_s FROM {fx.REGIONS} WHERE CAST(recording_id AS BIGINT) % 4 <> 0
UNION ALL SELECT recording_id, 0, 0, CAST(floor((total / 1e6) * 1e4 + 0.123) AS BIGINT) FROM {fx.TOTALS} WHERE CAST(recording_id AS BIGINT) % 4 = 0"""


def q_text_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences, the first line with a mark, alignment text, speaker marks, labels."""
    c = fx.table(spark, sf_dir, "conversations")
    marked = F.concat(F.lit("উ: "), "text", F.lit(" প্র : x"))
    s = text.sentences(F.col("text"), "\\.")
    return c.select(
        "conv_id", "turn", F.size(s).alias("n_sentences"), F.md5(F.array_join(s, "|").cast("binary")).alias("sentences"),
        F.md5(text.first_line_of_script(F.col("text"), "[x,]").cast("binary")).alias("line"), F.md5(text.alignment_text(F.col("text"), "abcdefghijklmnopqrstuvwxyz'-").cast("binary")).alias("aligned"),
        F.md5(text.strip_speakers(marked).cast("binary")).alias("unmarked"), text.display_label(F.concat(F.col("role"), F.lit("_turn"))).alias("label"), text.unknown(F.col("role")).alias("unknown"),
    )


RULES_SQL = rf"""
WITH t AS (SELECT *, list_filter(list_transform(string_split(text, '.'), lambda x: regexp_replace(x, {TRIM})), lambda x: x <> '') AS s,
  list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, {TRIM})), lambda x: regexp_matches(x, '[x,]')) AS l,
  regexp_replace(regexp_replace(lower(text), '[\s\x{{85}}\p{{Z}}]+', '|', 'g'), '[^abcdefghijklmnopqrstuvwxyz''|-]', '', 'g') AS a FROM conversations)
SELECT conv_id, turn, CAST(greatest(len(s), 1) AS INT) AS n_sentences, md5(CASE WHEN len(s) > 0 THEN array_to_string(s, '|') ELSE text END) AS sentences, md5(coalesce(l[1], text)) AS line,
  md5(regexp_replace(regexp_replace(a, '\|+', '|', 'g'), '^\||\|$', '', 'g')) AS aligned, md5(' ' || text || '  x') AS unmarked, upper(role) || '-TURN' AS label, 'Unknown (' || role || ')' AS unknown FROM t
"""


def q_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts of numbered turns, in one language and in two, and of ranked candidates."""
    c = fx.table(spark, sf_dir, "conversations").withColumn("item", F.struct(F.col("role").alias("speaker_id"), F.col("text").alias("raw_text"), F.col("role").alias("translation")))
    items = c.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "item"))), lambda x: x["item"]).alias("items"))
    ranked = F.transform("items", lambda x, i: F.struct(((i + 1) / 7).alias("dist"), x["speaker_id"].alias("word")))
    digest = lambda c: F.md5(c.cast("binary"))
    return items.select(
        "conv_id", digest(text.fill("Turns in {language}:\n{block}", language=F.lit("French"), block=text.numbered_block(F.col("items"), True))).alias("two"),
        digest(text.numbered_block(F.col("items"), False)).alias("one"), digest(text.candidate_block(ranked)).alias("ranked"),
    )


PROMPT_SQL = """
WITH t AS (SELECT conv_id, turn, role, replace(text, chr(10), ' ') AS x, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations)
SELECT conv_id, md5('Turns in French:' || chr(10) || string_agg(k || '. [' || role || '] Source: ' || x || chr(10) || '   Translation: ' || role, chr(10) ORDER BY k)) AS two,
  md5(string_agg(k || '. [' || role || '] ' || x, chr(10) ORDER BY k)) AS one, md5(string_agg('  ' || k || '. ' || role || '  (DTW ' || printf('%.2f', k / 7::DOUBLE) || ')', chr(10) ORDER BY k)) AS ranked FROM t GROUP BY conv_id
"""


def q_language_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model families, script tags, confidence, and mixed languages, by event number."""
    i = F.col("event_id")
    model = F.get(F.array(*map(F.lit, ("omniASR_CTC_300M", "omniASR_LLM_1B", "whisper", "my_ctc"))), (i % 4).cast("int"))
    p = F.array(*[F.struct(F.lit(x).alias("language"), (i * k % 100 / 100).alias("probability")) for x, k in (("fra", 7), ("deu", 13), ("spa", 31))])
    mix = languages.language_mix(p)
    e = fx.table(spark, sf_dir, "events").withColumn("mix", mix)
    return e.select(
        "event_id", languages.is_prefixed_model(model).alias("prefixed"), languages.is_ctc_model(model).alias("ctc"), languages.with_default_script(F.when(i % 2 == 0, "ben_Beng").otherwise("eng")).alias("tagged"),
        languages.without_script(F.when(i % 2 == 0, "ben_Beng").otherwise("eng")).alias("bare"), F.round(languages.confidence(F.when(i % 5 != 0, -(i % 5) / 3)), 6).alias("confidence"),
        F.col("mix.probability").alias("top"), F.col("mix.mixed").alias("mixed"),
    )


LANGUAGE_RULES_SQL = """
WITH e AS (SELECT event_id AS i, list_reverse_sort([event_id * 7 % 100 / 100::DOUBLE, event_id * 13 % 100 / 100::DOUBLE, event_id * 31 % 100 / 100::DOUBLE]) AS p FROM events)
SELECT i AS event_id, i % 4 < 2 AS prefixed, i % 4 IN (0, 3) AS ctc, CASE WHEN i % 2 = 0 THEN 'ben_Beng' ELSE 'eng_Latn' END AS tagged, CASE WHEN i % 2 = 0 THEN 'ben' ELSE 'eng' END AS bare,
  CASE WHEN i % 5 = 0 THEN 0 ELSE round(exp(-(i % 5) / 3::DOUBLE), 6) END AS confidence, p[1] AS top, p[1] - p[2] < 0.3 AS mixed FROM e
"""


def q_word_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Characters of turns as frames of 50 a second, grouped to words at blanks."""
    c = fx.table(spark, sf_dir, "conversations")
    chars = c.select(F.concat_ws("/", "conv_id", "turn").alias("segment_key"), F.posexplode(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), "")).alias("pos", "ch"))
    rows = chars.select("segment_key", "pos", F.when(F.col("ch") == " ", "|").otherwise(F.col("ch")).alias("char"), F.col("pos").alias("frame"), (F.col("pos") % 7 / 4 - 0.25).alias("score"), F.lit(2.0).alias("offset_s"))
    w = words.words_from_characters(rows, 50.0)
    return w.select("segment_key", F.col("word_no").cast("int").alias("word_no"), "word", F.round("start_s", 6).alias("start_s"), F.round("end_s", 6).alias("end_s"), F.round("confidence", 6).alias("confidence"))


WORD_SQL = """
WITH c AS (SELECT conv_id || '/' || turn AS segment_key, replace(text, chr(10), ' ') AS x FROM conversations),
h AS (SELECT segment_key, unnest(string_split(x, '')) AS ch, unnest(range(length(x))) AS pos FROM c),
w AS (SELECT *, CAST(sum((ch = ' ')::INT) OVER (PARTITION BY segment_key ORDER BY pos) AS INT) AS word_no FROM h)
SELECT segment_key, word_no, string_agg(ch, '' ORDER BY pos) AS word, round(2.0 + min(pos) / 50::DOUBLE, 6) AS start_s, round(2.0 + (max(pos) + 1) / 50::DOUBLE, 6) AS end_s,
  round(avg(greatest(0.0, least(1.0, pos % 7 / 4::DOUBLE - 0.25))), 6) AS confidence FROM w WHERE ch <> ' ' GROUP BY ALL
"""


def q_tightened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments drawn in to their words; those without words or in a script without spaces stay."""
    i = F.col("event_id")
    s = fx.segments(spark, sf_dir).withColumn("event_id", F.col("pos"))
    span = F.col("end_s") - F.col("start_s")
    ws = F.array(F.struct(F.lit("a").alias("word"), (F.col("start_s") + span / 4).alias("start_s"), (F.col("start_s") + span / 2).alias("end_s"), F.lit(1.0).alias("confidence")))
    s = s.withColumns({"words": F.when(i % 6 != 0, ws).otherwise(F.array().cast(fx.WORDS)), "language": F.when(i % 10 == 0, "zho").otherwise("eng")})
    return words.tighten(s).select("pos", fx.ticks("start_s"), fx.ticks("end_s"))


TIGHT_SQL = f"""SELECT pos, CAST(floor((CASE WHEN pos % 6 <> 0 AND pos % 10 <> 0 AND t1 / 1e6 - t0 / 1e6 >= 0.1 THEN t0 / 1e6 + (t1 / 1e6 - t0 / 1e6) / 4 ELSE t0 / 1e6 END) * 1e4 + 0.123) AS BIGINT) AS start_s, CAST(floor((t1 / 1e6) * 1e4 + 0.123) AS BIGINT) AS end_s FROM {fx.SEGMENTS}"""


def q_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A word aligner that fails on every fourth segment: what it cannot align stays as it is."""
    s = fx.segments(spark, sf_dir)
    return words.align(s, _halves).select("pos", fx.ticks("start_s"), fx.ticks("end_s"), F.size(F.coalesce("words", F.array().cast(fx.WORDS))).alias("n_words"), "align_error")


def _halves():
    def model(row: dict) -> list[dict]:
        if row["pos"] % 8 == 0:
            raise RuntimeError("no speech")
        a, b = row["start_s"], row["end_s"]
        return [{"word": row["raw_text"], "start_s": a + (b - a) / 4, "end_s": a + (b - a) / 2, "confidence": 1.0}]

    return model


ALIGN_SQL = f"""SELECT pos, CAST(floor((CASE WHEN pos % 8 <> 0 AND t1 / 1e6 - t0 / 1e6 >= 0.1 THEN t0 / 1e6 + (t1 / 1e6 - t0 / 1e6) / 4 ELSE t0 / 1e6 END) * 1e4 + 0.123) AS BIGINT) AS start_s, CAST(floor((t1 / 1e6) * 1e4 + 0.123) AS BIGINT) AS end_s,
  CAST(pos % 8 <> 0 AS INT) AS n_words, CASE WHEN pos % 8 = 0 THEN 'RuntimeError: no speech' END AS align_error FROM {fx.SEGMENTS}"""


def q_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments and the gaps between all regions in one order, speech first among equals."""
    from parlance.operators.intervals import non_speech_regions

    speech = fx.segments(spark, sf_dir).select("recording_id", "pos", "start_s")
    gaps = non_speech_regions(fx.regions(spark, sf_dir), fx.totals(spark, sf_dir)).select("recording_id", "start_s")
    return interviews.timeline(speech, gaps).select("recording_id", "kind", fx.ticks("start_s"), "line")


TIMELINE_SQL = f"""
WITH r AS (SELECT recording_id, lag(t1, 1, 0) OVER (PARTITION BY recording_id ORDER BY pos) AS a, t0 AS b FROM {fx.REGIONS} UNION ALL
  SELECT t.recording_id, l.a, t.total FROM {fx.TOTALS} t JOIN (SELECT recording_id, arg_max(t1, pos) AS a FROM {fx.REGIONS} GROUP BY ALL) l USING (recording_id)),
b AS (SELECT recording_id, 0 AS kind, pos, t0 AS t FROM {fx.SEGMENTS} UNION ALL SELECT recording_id, 1, NULL, a FROM r WHERE b - a > 300000)
SELECT recording_id, kind, CAST(floor((t / 1e6) * 1e4 + 0.123) AS BIGINT) AS start_s, CAST(row_number() OVER (PARTITION BY recording_id ORDER BY t, kind, pos) AS INT) AS line FROM b
"""


def q_language_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The requested language, then those of a source's documents besides it."""
    d = fx.table(spark, sf_dir, "documents").groupBy("source").agg(F.array_sort(F.collect_set("lang")).alias("seen"))
    return d.select("source", F.array_join(interviews.language_set(F.lit("es"), F.col("seen")), ",").alias("languages"))


SETS_SQL = "SELECT source, array_to_string(list_concat(['es'], list_sort(list_distinct(list(lang) FILTER (lang <> 'es')))), ',') AS languages FROM documents GROUP BY source"


def q_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of two sources in one shape, projected by mode, with keys that a second run gives again."""
    d = fx.table(spark, sf_dir, "documents")
    one = d.filter("lang = 'en'").select(F.col("source").alias("src"), F.col("lang").alias("subsource"), dataset.row_id(F.col("lang"), F.col("doc_id")).alias("id"), F.md5("text").alias("ipa"), F.lit("x").alias("bengali"))
    two = d.filter("NOT lang <=> 'en'").select(F.col("source").alias("src"), F.col("lang").alias("subsource"), dataset.row_id(F.col("lang"), F.col("doc_id")).alias("id"), F.sha1("text").alias("noisy"), F.lit("y").alias("bengali"), F.lit("e").alias("english"))
    both = dataset.concat_sources(one, two)
    return dataset.project(both, "both").unionByName(dataset.project(both, "ipa").withColumn("id", F.concat(F.lit("i/"), "id")))


PROJECTION_SQL = """
WITH b AS (SELECT source AS src, lang AS subsource, concat_ws('_', lang, doc_id) AS id, CASE WHEN lang = 'en' THEN md5(text) END AS ipa, CASE WHEN lang IS DISTINCT FROM 'en' THEN sha1(text) END AS noisy,
  CASE WHEN lang = 'en' THEN 'x' ELSE 'y' END AS bengali, CASE WHEN lang IS DISTINCT FROM 'en' THEN 'e' END AS english FROM documents)
SELECT src, subsource, id, ipa, noisy, bengali, english FROM b UNION ALL SELECT src, subsource, 'i/' || id, ipa, NULL, bengali, english FROM b
"""


def _upper(df: DataFrame) -> DataFrame:
    return df.select("id", "src", F.upper("src").alias("heard"))


def q_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A resumed extraction: what is labelled is left out, the rest filtered and capped by source before the model; the cap is the feature."""
    p = fx.pairs(spark, sf_dir)
    done = p.join(fx.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id")).distinct(), "id").select("id", "src")
    return dataset.extract(p, done, F.col("wer") < 0.5, _upper, cap=40, groups=["src"])


EXTRACT_SQL = f"""
WITH d AS (SELECT DISTINCT doc_id FROM labels), h AS (SELECT src, count(*) AS n FROM {fx.PAIRS} WHERE id IN (SELECT doc_id FROM d) GROUP BY src),
r AS (SELECT src, id, row_number() OVER (PARTITION BY src ORDER BY id) AS k FROM {fx.PAIRS} WHERE wer < 0.5 AND id NOT IN (SELECT doc_id FROM d))
SELECT id, src, upper(src) AS heard FROM r LEFT JOIN h USING (src) WHERE k <= 40 - coalesce(n, 0)
"""


def _picky() -> Callable[[dict], list[dict]]:
    """A model that fails on ids that end in 3."""

    def run(row: dict) -> list[dict]:
        if row["id"] % 10 == 3:
            raise ValueError("cannot be read")
        return [{"heard": row["src"].upper()}]

    return run


def q_extraction_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of a resumed extraction, taken by the job that writes its rows."""
    p = fx.pairs(spark, sf_dir).filter("src IS NOT NULL")
    done = fx.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    rows, counters = dataset.extract_observed(p, done, F.col("wer") < 0.5, lambda df: inference.infer_rows(df, _picky, ["id"], ["id", "src"], "heard string"))
    store(rows, "extracted")
    c = counters()
    return spark.range(1).select(*[F.lit(c[k]).cast("long").alias(k) for k in ("total", "kept", "filtered", "written", "errors")])


COUNTS_SQL = f"""
WITH n AS (SELECT *, coalesce(wer < 0.5, false) AS k FROM {fx.PAIRS} WHERE src IS NOT NULL AND id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL))
SELECT count(*) AS total, count(*) FILTER (k) AS kept, count(*) FILTER (NOT k) AS filtered, count(*) FILTER (k) AS written, count(*) FILTER (k AND id % 10 = 3) AS errors FROM n
"""


def q_listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose file a listing has, and rows whose file is missing."""
    d = fx.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"))
    have, missing = dataset.existing(d, fx.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("path")))
    return have.withColumn("found", F.lit(True)).unionByName(missing.withColumn("found", F.lit(False)))


LISTED_SQL = "SELECT doc_id AS path, doc_id IN (SELECT doc_id FROM labels) AS found FROM documents"

QUERIES = {
    "q_refine_budgets": (q_refine_budgets, BUDGET_SQL),
    "q_rule_turns": (q_rule_turns, TURN_RULE_SQL),
    "q_rule_phonemes": (q_rule_phonemes, PHONEME_SQL),
    "q_extraction_counts": (q_extraction_counts, COUNTS_SQL),
    "q_translation": (q_translation, TRANSLATION_SQL),
    "q_older_translation": (q_older_translation, OLDER_SQL),
    "q_refinement": (q_refinement, REFINED_SQL),
    "q_processed": (q_processed, PROCESSED_SQL),
    "q_run_translations": (q_run_translations, RUN_SQL),
    "q_two_pass": (q_two_pass, TWO_PASS_SQL),
    "q_failing_rows": (q_failing_rows, FAILING_SQL),
    "q_batched_rows": (q_batched_rows, BATCHED_SQL),
    "q_region_fallback": (q_region_fallback, FALLBACK_SQL),
    "q_text_rules": (q_text_rules, RULES_SQL),
    "q_prompts": (q_prompts, PROMPT_SQL),
    "q_language_rules": (q_language_rules, LANGUAGE_RULES_SQL),
    "q_word_confidence": (q_word_confidence, WORD_SQL),
    "q_tightened": (q_tightened, TIGHT_SQL),
    "q_alignment": (q_alignment, ALIGN_SQL),
    "q_timeline": (q_timeline, TIMELINE_SQL),
    "q_language_sets": (q_language_sets, SETS_SQL),
    "q_projections": (q_projections, PROJECTION_SQL),
    "q_extraction": (q_extraction, EXTRACT_SQL),
    "q_listed_files": (q_listed_files, LISTED_SQL),
}
