"""Normalisation, error rates, code maps, parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.functions import languages, text
from parlance.functions.scores import cer, char_distance, wer
from parlance.operators import scoring
from parlance.plans import fixtures as fx
from parlance.storage import store


def q_error_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fx.turn_pairs(spark, sf_dir)
    return p.select("file", char_distance(F.col("hyp"), F.col("ref")).cast("long").alias("edits"), F.round(cer(F.col("hyp"), F.col("ref")), 6).alias("cer"))


RATES_SQL = f"SELECT file, CAST(levenshtein(hyp, ref) AS BIGINT) AS edits, round(levenshtein(hyp, ref) / greatest(length(ref), 1)::DOUBLE, 6) AS cer FROM {fx.TURN_PAIRS}"


def q_word_error_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fx.turn_pairs(spark, sf_dir)
    return p.select("file", F.round(wer(F.col("hyp"), F.col("ref")), 6).alias("wer"))


#: The table of distances row by row: a step takes the row before, then each cell the least of what lies to its left.
WORD_RATES_SQL = r"""
WITH RECURSIVE p AS (SELECT a.conv_id || '/' || a.turn AS file, list_filter(regexp_split_to_array(a.text, '[\s\x{85}\p{Z}]+'), lambda x: x <> '') AS r, list_filter(regexp_split_to_array(b.text, '[\s\x{85}\p{Z}]+'), lambda x: x <> '') AS h
  FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1 WHERE a.text IS NOT NULL AND b.text IS NOT NULL),
t(file, r, h, i, d) AS (
  SELECT file, r, h, 0, range(len(h) + 1) FROM p
  UNION ALL
  SELECT file, r, h, i + 1, list_reduce(
      list_prepend([i + 1], list_transform(range(1, len(h) + 1), lambda j: [least(d[j + 1] + 1, d[j] + CASE WHEN r[i + 1] = h[j] THEN 0 ELSE 1 END)])),
      lambda x, y: list_append(x, least(y[1], x[len(x)] + 1)))
  FROM t WHERE i < len(r))
SELECT file, round(d[len(h) + 1] / greatest(len(r), 1)::DOUBLE, 6) AS wer FROM t WHERE i = len(r)
"""


def q_system_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two systems of hypotheses: the neighbour, and the reference without its last ten characters."""
    p = fx.turn_pairs(spark, sf_dir)
    s = F.array(F.struct(F.lit("neighbour").alias("system"), F.col("hyp").alias("h")), F.struct(F.lit("cut").alias("system"), F.expr("left(ref, greatest(length(ref) - 10, 0))").alias("h")))
    rows = p.select("file", "ref", F.explode(s).alias("s")).select("file", "ref", "s.*")
    scores = rows.select("system", cer(F.col("h"), F.col("ref")).alias("cer"), F.lit(0.0).alias("wer"), char_distance(F.col("h"), F.col("ref")).alias("edits"), F.length("ref").alias("ref_chars"))
    scores = store(scores, "scores")  # four aggregations read them
    m = scoring.means(scores, ["system"]).join(scoring.summary(scores, ["system"]).select("system", "median", "best", "worst"), "system")
    return m.select("system", "n", *[F.round(c, 6).alias(c) for c in ("macro_cer", "micro_cer", "median", "best", "worst")])


MEANS_SQL = f"""
WITH r AS (SELECT file, ref, 'neighbour' AS system, hyp AS h FROM {fx.TURN_PAIRS} UNION ALL SELECT file, ref, 'cut', left(ref, greatest(length(ref) - 10, 0)) FROM {fx.TURN_PAIRS}),
s AS (SELECT system, levenshtein(h, ref) AS e, greatest(length(ref), 1) AS n, levenshtein(h, ref) / greatest(length(ref), 1)::DOUBLE AS c FROM r)
SELECT system, count(*) AS n, round(avg(c), 6) AS macro_cer, round(sum(e) / sum(n)::DOUBLE, 6) AS micro_cer, round(list_sort(list(c))[CAST(count(*) // 2 AS INT) + 1], 6) AS median, round(min(c), 6) AS best, round(max(c), 6) AS worst
FROM s GROUP BY system
"""


def q_better_or_worse(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fx.turn_pairs(spark, sf_dir).select(cer(F.col("hyp"), F.col("ref")).alias("neighbour"), F.lit(0.8).alias("fixed"))
    return scoring.bands(p, "neighbour", "fixed")


BANDS_SQL = f"""WITH d AS (SELECT (levenshtein(hyp, ref) / greatest(length(ref), 1)::DOUBLE - 0.8) * 100 AS d FROM {fx.TURN_PAIRS})
SELECT count(*) FILTER (d < -1) AS better, count(*) FILTER (abs(d) <= 1) AS same, count(*) FILTER (d > 1) AS worse FROM d"""


def q_strategy_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fx.turn_pairs(spark, sf_dir).select(cer(F.col("hyp"), F.col("ref")).alias("A"), F.round(cer(F.col("hyp"), F.col("ref")), 1).alias("B"), F.lit(0.8).alias("C"))
    return scoring.wins(p, ["A", "B", "C"])


WINS_SQL = f"""WITH r AS (SELECT levenshtein(hyp, ref) / greatest(length(ref), 1)::DOUBLE AS a FROM {fx.TURN_PAIRS}), s AS (SELECT a, round(a, 1) AS b, 0.8::DOUBLE AS c FROM r)
SELECT CASE WHEN a <= b AND a <= c THEN 'A' WHEN b <= c THEN 'B' ELSE 'C' END AS system, count(*) AS wins FROM s GROUP BY ALL"""


def q_script_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latin letters without marks as a share of all letters, by language."""
    d = fx.table(spark, sf_dir, "documents")
    r = text.script_ratio(F.col("text"), "[A-Za-z]")
    return d.select("doc_id", F.round(r, 6).alias("ratio"), text.is_script(F.col("text"), 0.97, "[A-Za-z]").alias("valid"))


RATIO_SQL = r"""WITH c AS (SELECT doc_id, length(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')) AS a, length(regexp_replace(coalesce(text, ''), '[^\p{L}]', '', 'g')) AS n FROM documents)
SELECT doc_id, CASE WHEN n > 0 THEN round(a / n::DOUBLE, 6) END AS ratio, n > 0 AND a / n::DOUBLE >= 0.97 AS valid FROM c"""


def q_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both normalisations of conversation turns, as digests."""
    c = fx.table(spark, sf_dir, "conversations").filter("text IS NOT NULL")
    wide = text.base_norm(F.col("text"), "space")
    return c.select("conv_id", "turn", F.md5(text.base_norm(F.col("text")).cast("binary")).alias("deleted"), F.md5(text.num_norm(wide).cast("binary")).alias("spaced"))


NORM_SQL = r"""
WITH t AS (SELECT conv_id, turn, regexp_replace(nfc_normalize(text), '^[\s\x{85}\p{Z}]+|[\s\x{85}\p{Z}]+$', '', 'g') AS t FROM conversations WHERE text IS NOT NULL),
d AS (SELECT conv_id, turn, regexp_replace(regexp_replace(t, '[।,.!?\x{200c}\x{200d}]', '', 'g'), '[\s\x{85}\p{Z}]+', ' ', 'g') AS a,
  trim(regexp_replace(regexp_replace(t, '[।,.!?;:"''()\[\]{}—–\x{200c}\x{200d}-]', ' ', 'g'), '[\s\x{85}\p{Z}]+', ' ', 'g')) AS b FROM t)
SELECT conv_id, turn, md5(a) AS deleted, md5(trim(regexp_replace(translate(replace(replace(replace(replace(b, 'একশ', '100'), 'একশো', '100'), 'এক হাজার', '1000'), 'একহাজার', '1000'), '০১২৩৪৫৬৭৮৯', '0123456789'), '[\s\x{85}\p{Z}]+', ' ', 'g'))) AS spaced FROM d
"""


def q_language_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = fx.table(spark, sf_dir, "documents").select("doc_id", languages.iso3(F.col("lang")).alias("language"))
    w = languages.with_language(d, languages.registry(spark))
    return w.select("doc_id", "language", "language_name", "nllb_code", "is_english", languages.engine_for(F.col("tier")).alias("engine"), languages.model_language(F.col("language"), F.col("script")).alias("model_language"), languages.tag(F.col("language")).alias("tag"))


_MAP = ", ".join(f"('{c}', '{n}', '{t}', '{b}', '{s}', '{m}')" for c, n, t, b, s, m, _ in languages.rows())
LOOKUP_SQL = f"""
WITH r(code, name, tier, short, script, nllb) AS (VALUES {_MAP}),
d AS (SELECT doc_id, coalesce(r.code, lang) AS language, r.* FROM documents LEFT JOIN r ON r.short = lang)
SELECT doc_id, language, coalesce(name, 'Unknown (' || language || ')') AS language_name, coalesce(nllb, language || '_Latn') AS nllb_code, language = 'eng' AS is_english,
  CASE WHEN tier = 'high' THEN 'whisper' ELSE 'omnilingual' END AS engine, language || '_' || coalesce(script, 'Latn') AS model_language, coalesce(short, language) AS tag FROM d
"""


def q_numbered_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document lines numbered as a model would answer, parsed and counted."""
    d = fx.table(spark, sf_dir, "documents").filter("text IS NOT NULL")
    reply = F.array_join(F.transform(F.split("text", "\n"), lambda x, i: F.concat((i % 7 + 1).cast("string"), F.lit(". "), x)), "\n")
    m = text.parse_numbered(reply)
    return d.select("doc_id", F.size(m).alias("n"), F.md5(F.try_element_at(m, F.lit(1)).cast("binary")).alias("first"), F.coalesce(text.parse_choice(F.concat(F.lit("word "), (F.col("doc_id") % 12).cast("string")), F.lit(10)), F.lit(-1)).alias("choice"))


REPLY_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents WHERE text IS NOT NULL),
t AS (SELECT doc_id, i, i % 7 + 1 AS k, regexp_replace(x, '^[\s\x{85}\p{Z}]+|[\s\x{85}\p{Z}]+$', '', 'g') AS x FROM l),
g AS (SELECT doc_id, k, arg_max(x, i) AS x FROM t WHERE x <> '' GROUP BY ALL),
c AS (SELECT doc_id, count(*) AS n, max(CASE WHEN k = 1 THEN md5(x) END) AS f FROM g GROUP BY ALL)
SELECT d.doc_id, CAST(coalesce(n, 0) AS INT) AS n, f AS first, CAST(CASE WHEN d.doc_id % 12 BETWEEN 1 AND 10 THEN d.doc_id % 12 - 1 ELSE -1 END AS INT) AS choice FROM documents d LEFT JOIN c USING (doc_id) WHERE text IS NOT NULL
"""

QUERIES = {
    "q_error_rates": (q_error_rates, RATES_SQL),
    "q_word_error_rates": (q_word_error_rates, WORD_RATES_SQL),
    "q_system_means": (q_system_means, MEANS_SQL),
    "q_better_or_worse": (q_better_or_worse, BANDS_SQL),
    "q_strategy_wins": (q_strategy_wins, WINS_SQL),
    "q_script_ratio": (q_script_ratio, RATIO_SQL),
    "q_normalised": (q_normalised, NORM_SQL),
    "q_language_lookup": (q_language_lookup, LOOKUP_SQL),
    "q_numbered_replies": (q_numbered_replies, REPLY_SQL),
}
