"""Scores of model runs: pairs and documents, comparisons, rankings, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.functions.scores import pct_even
from parlance.operators import scoring
from parlance.plans import fixtures as fx
from parlance.sinks import files as sinks

SPACES = r"'[\s\x{85}\p{Z}]+', ' ', 'g'"


def _m1(c: str) -> str:
    cut = rf"""regexp_replace(nfc_normalize({c}), '[।,.!?;:"''()\[\]{{}}—–\x{{200c}}\x{{200d}}-]', ' ', 'g')"""
    return f"trim(regexp_replace({cut}, {SPACES}))"


def _m2(c: str) -> str:
    return f"trim(regexp_replace(translate({c}, '০১২৩৪৫৬৭৮৯', '0123456789'), {SPACES}))"


def q_pair_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn against the next one, with both normalisations."""
    p = fx.turn_pairs(spark, sf_dir)
    s = scoring.score_pairs(p.select("file", F.col("ref").alias("transcript")), p.select("file", F.lit("next").alias("system"), F.col("hyp").alias("text")))
    return s.select("file", "system", "metric", F.round("cer", 6).alias("cer"), F.col("edits").cast("long").alias("edits"), "ref_chars", "hyp_chars")


PAIR_SQL = f"""
WITH a AS (SELECT file, {_m1("ref")} AS r, {_m1("hyp")} AS h FROM {fx.TURN_PAIRS}), b AS (SELECT file, 'M1' AS metric, r, h FROM a UNION ALL SELECT file, 'M2', {_m2("r")}, {_m2("h")} FROM a)
SELECT file, 'next' AS system, metric, round(levenshtein(h, r) / greatest(length(r), 1)::DOUBLE, 6) AS cer, CAST(levenshtein(h, r) AS BIGINT) AS edits, length(r) AS ref_chars, length(h) AS hyp_chars FROM b
"""


def q_document_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole conversations as references; each role's turns, joined in order, as a system's document."""
    c = fx.table(spark, sf_dir, "conversations").filter("text IS NOT NULL").withColumn("file", F.col("conv_id").cast("string"))
    whole = c.groupBy("file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), " ").alias("transcript"))
    s = scoring.document_scores(whole, c.select("file", F.col("role").alias("system"), F.col("turn").alias("pos"), "text"))
    return s.select("file", "system", "metric", F.round("cer", 6).alias("cer"), "ref_chars", "hyp_chars")


DOCUMENT_SQL = f"""
WITH r AS (SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS t FROM conversations GROUP BY conv_id), h AS (SELECT conv_id, role, string_agg(text, ' ' ORDER BY turn) AS t FROM conversations GROUP BY ALL),
b AS (SELECT CAST(h.conv_id AS VARCHAR) AS file, role AS system, {_m1(fx.narrow("r.t"))} AS r, {_m1(fx.narrow("h.t"))} AS h FROM r JOIN h USING (conv_id)),
m AS (SELECT file, system, 'M1' AS metric, r, h FROM b UNION ALL SELECT file, system, 'M2', {_m2("r")}, {_m2("h")} FROM b)
SELECT file, system, metric, round(levenshtein(h, r) / greatest(length(r), 1)::DOUBLE, 6) AS cer, length(r) AS ref_chars, length(h) AS hyp_chars FROM m
"""


def q_improvements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gains of each role's mean length rate over the user's, in points and as a share."""
    c = fx.table(spark, sf_dir, "conversations").groupBy(F.col("role").alias("system")).agg(F.avg(F.length("text") / 1000).alias("macro_cer"))
    return scoring.improvements(c, "user").select("system", F.round("gain_pp", 6).alias("gain_pp"), F.round("reduction_pct", 6).alias("reduction_pct"))


GAIN_SQL = """WITH m AS (SELECT role AS system, avg(length(text) / 1000::DOUBLE) AS c FROM conversations GROUP BY role), b AS (SELECT c AS base FROM m WHERE system = 'user')
SELECT system, round((base - c) * 100, 6) AS gain_pp, round(100 * (base - c) / base, 6) AS reduction_pct FROM m, b"""


def q_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five wins and three losses of a system; their number is the feature."""
    c = fx.table(spark, sf_dir, "conversations").select((F.col("conv_id") * 100 + F.col("turn")).alias("sample"), F.length("text").alias("n"))
    won, lost = scoring.examples(c, F.col("n") > 500, 5, "sample"), scoring.examples(c, F.col("n") <= 500, 3, "sample")
    return won.withColumn("kind", F.lit("win")).unionByName(lost.withColumn("kind", F.lit("loss")))


EXAMPLES_SQL = """WITH c AS (SELECT conv_id * 100 + turn AS sample, length(text) AS n FROM conversations)
(SELECT sample, n, 'win' AS kind FROM c WHERE n > 500 ORDER BY sample LIMIT 5) UNION ALL (SELECT sample, n, 'loss' FROM c WHERE n <= 500 ORDER BY sample LIMIT 3)"""


def q_gold_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each document's source among ten candidates made of its number."""
    n = F.col("doc_id")
    candidates = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.concat(F.lit("src"), ((n * 7 + i * 3) % 20).cast("string")))
    return fx.table(spark, sf_dir, "documents").select("doc_id", scoring.gold_rank(F.col("source"), candidates).cast("int").alias("gold_rank"))


RANK_SQL = """SELECT doc_id, CAST(coalesce(list_position([ 'src' || ((doc_id * 7 + i * 3) % 20) FOR i IN range(10)], source), 0) - 1 AS INT) AS gold_rank FROM documents"""


def q_model_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every role with every conversation, the system role first, in the order of first appearance."""
    c = fx.table(spark, sf_dir, "conversations").withColumn("pos", F.col("conv_id") * 100 + F.col("turn"))
    m = scoring.model_matrix(c.select(F.col("role").alias("model_id"), "pos"), c.select(F.col("conv_id").cast("string").alias("audio_file"), "pos"), "system")
    return m.select("model_id", F.col("m_pos").cast("long").alias("m_pos"), "audio_file", "a_pos")


MATRIX_SQL = """WITH c AS (SELECT *, conv_id * 100 + turn AS pos FROM conversations), m AS (SELECT role AS model_id, CASE WHEN role = 'system' THEN -1 ELSE min(pos) END AS m_pos FROM c GROUP BY role),
a AS (SELECT CAST(conv_id AS VARCHAR) AS audio_file, min(pos) AS a_pos FROM c GROUP BY conv_id) SELECT model_id, m_pos, audio_file, a_pos FROM m, a"""


def q_model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two models side by side for every file."""
    w = scoring.comparison(fx.runs(spark, sf_dir), ["m0", "m3"])
    return w.select("audio_file", *[F.md5(F.col(f"{m}_transcript").cast("binary")).alias(f"{m}_text") for m in ("m0", "m3")], *[f"{m}_{c}" for m in ("m0", "m3") for c in ("time", "status")])


COMPARISON_SQL = f"""SELECT audio_file, {", ".join(f"max(CASE WHEN model_id = '{m}' THEN md5(transcript) END) AS {m}_text, max(CASE WHEN model_id = '{m}' THEN round(elapsed_s, 2) END) AS {m}_time, max(CASE WHEN model_id = '{m}' THEN CASE WHEN error IS NULL THEN 'OK' ELSE 'FAIL' END END) AS {m}_status" for m in ("m0", "m3"))}
FROM {fx.RUNS} GROUP BY audio_file"""


def q_comparison_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text block for each file with every model's status, time and transcript, as digests."""
    return sinks.comparison_text(fx.runs(spark, sf_dir)).select("audio_file", "pos", F.md5(F.col("value").cast("binary")).alias("block"))


BLOCK_SQL = f"""
WITH l AS (SELECT audio_file, pos, '  [' || CASE WHEN error IS NULL THEN 'OK' ELSE 'FAIL' END || '] ' || model_id || ' (' || CASE WHEN coalesce(elapsed_s, 0) = 0 THEN '-' ELSE printf('%.1fs', elapsed_s) END || '): ' || coalesce(error, transcript, '') AS line FROM {fx.RUNS})
SELECT audio_file, min(pos) AS pos, md5(concat_ws(chr(10), audio_file, string_agg(line, chr(10) ORDER BY pos))) AS block FROM l GROUP BY audio_file
"""


def q_language_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = fx.table(spark, sf_dir, "documents").select(F.col("lang").alias("language"), (F.col("doc_id") % 120 / 100).alias("m1"), (F.col("doc_id") % 70 / 100).alias("m2"))
    h = scoring.language_histogram(d, ("m1", "m2"))
    return h.select("language", "n", F.round("mean_m1", 6).alias("mean_m1"), F.round("mean_m2", 6).alias("mean_m2"))


HISTOGRAM_SQL = "SELECT lang AS language, count(*) AS n, round(avg(doc_id % 120 / 100::DOUBLE), 6) AS mean_m1, round(avg(doc_id % 70 / 100::DOUBLE), 6) AS mean_m2 FROM documents GROUP BY lang"


def q_rounded_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares as per cent to one place, by the binary value's digits."""
    return fx.table(spark, sf_dir, "events").select("event_id", pct_even(F.col("event_id") % 2000 / 4000).alias("pct"))


ROUNDED_SQL = "SELECT event_id, CAST(printf('%.1f', (event_id % 2000) / 4000::DOUBLE * 100) AS DOUBLE) AS pct FROM events"

QUERIES = {
    "q_pair_scores": (q_pair_scores, PAIR_SQL),
    "q_document_scores": (q_document_scores, DOCUMENT_SQL),
    "q_improvements": (q_improvements, GAIN_SQL),
    "q_examples": (q_examples, EXAMPLES_SQL),
    "q_gold_ranks": (q_gold_ranks, RANK_SQL),
    "q_model_matrix": (q_model_matrix, MATRIX_SQL),
    "q_model_comparison": (q_model_comparison, COMPARISON_SQL),
    "q_comparison_text": (q_comparison_text, BLOCK_SQL),
    "q_language_histogram": (q_language_histogram, HISTOGRAM_SQL),
    "q_rounded_rates": (q_rounded_rates, ROUNDED_SQL),
}
