"""Waves of many blocks and conversations, written as wave and word-processor files and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.operators import trellis, warping
from parlance.plans import fixtures as fx
from parlance.plans.waves import JOINED
from parlance.sinks import documents
from parlance.sources import audio, files, pcm, texts
from parlance.storage import fresh_path

RECORDING = r"([^/]+)\.wav$"


def written(spark: SparkSession, sf_dir: str) -> str:
    """A folder of wave files, one a joined wave, in halves so that folders are listed too."""
    path = fresh_path(spark, "waves")
    w = fx.joined_waves(spark, sf_dir)
    for k in range(2):
        pcm.write_waves(w.filter(F.col("recording_id").cast("int") % 2 == k), f"{path}/half{k}")
    return path


def q_wave_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed and scanned recordings with what their headers say, read alone and through whole files."""
    path = written(spark, sf_dir)
    name = F.regexp_extract("path", RECORDING, 1)
    listed = files.audio_files(spark, path).select(name.alias("recording_id"), "parent", "length")
    scanned = files.scan(spark, path).select(name.alias("recording_id"), F.lit(True).alias("scanned"))
    facts = pcm.metadata(spark, path).select(name.alias("recording_id"), "duration_s", "sample_rate", "channels", "format", "file_size_bytes", "error")
    whole = audio.metadata(spark, path, facts=audio.decoded_facts(audio.decode_wave)).select(name.alias("recording_id"), F.col("duration_s").alias("decoded_s"))
    return listed.join(scanned, "recording_id").join(facts, "recording_id").join(whole, "recording_id")


WAVE_FILES_SQL = """
SELECT CAST(vec_id // 64 AS VARCHAR) AS recording_id, 'half' || (vec_id // 64 % 2) AS parent, 44 + 128 * count(*) AS length, true AS scanned, count(*) * 4::DOUBLE AS duration_s, 16 AS sample_rate, 1 AS channels, 'wav' AS format,
  44 + 128 * count(*) AS file_size_bytes, NULL AS error, count(*) * 4::DOUBLE AS decoded_s FROM embeddings GROUP BY vec_id // 64
"""


def summed(blocks: DataFrame) -> DataFrame:
    """Per recording: samples, blocks, the samples' sum weighed by place, and their energy."""
    weighed = F.aggregate(F.transform("samples", lambda x, i: x.cast("double") * (F.col("start_sample") + i + 1)), F.lit(0.0), lambda s, v: s + v)
    energy = F.aggregate("samples", F.lit(0.0), lambda s, v: s + v.cast("double") * v)
    sums = blocks.groupBy(F.regexp_extract("recording_id", RECORDING, 1).alias("recording_id")).agg(F.sum(F.size("samples")).alias("n"), F.count("*").alias("blocks"), F.sum(weighed).alias("w"), F.sum(energy).alias("e"))
    return sums.select("recording_id", "n", "blocks", F.round(F.col("w") / F.col("n"), 4).alias("weighed"), F.round("e", 3).alias("energy"))


def q_decoded_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of 16 bits from byte ranges that cut files in the middle of blocks."""
    return summed(pcm.blocks(spark, written(spark, sf_dir), target=16, block=1000, split_bytes=3001))


#: Samples as 16 bits hold them.
ROUNDED = f"(SELECT recording_id, p, round(v * 32767) / 32768 AS v FROM {JOINED})"
DECODED_SQL = f"""
SELECT recording_id, count(*) AS n, CAST(ceil(count(*) / 1000) AS BIGINT) AS blocks, round(sum(v * (p + 1)) / count(*), 4) AS weighed, round(sum(v * v), 3) AS energy FROM {ROUNDED} GROUP BY ALL
"""


def q_resampled_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same at half the rate: low-passed, in blocks whose filters reach over the samples of their neighbours."""
    return summed(pcm.blocks(spark, written(spark, sf_dir), target=8, block=300, split_bytes=3001))


#: Half the rate has one phase: weights of the 138 samples around each second one.
RESAMPLED_SQL = f"""
WITH c AS (SELECT u, CASE WHEN u = 0 THEN 1 ELSE sin(pi() * 0.47 * u) / (pi() * 0.47 * u) END * (0.5 + 0.5 * cos(pi() * u / 69)) AS h FROM (SELECT unnest(range(-68, 70)) AS u)),
w AS (SELECT u, h / sum(h) OVER () AS h FROM c),
t AS (SELECT recording_id, count(*) // 2 AS n FROM {ROUNDED} GROUP BY ALL),
y AS (SELECT recording_id, (p - u) // 2 AS m, sum(v * h) AS y FROM {ROUNDED} JOIN w ON (p - u) % 2 = 0 AND p >= u GROUP BY ALL)
SELECT recording_id, n, CAST(ceil(n / 300) AS BIGINT) AS blocks, round(sum(y * (m + 1)) / n, 4) AS weighed, round(sum(y * y), 3) AS energy FROM y JOIN t USING (recording_id) WHERE m < n GROUP BY recording_id, n
"""


def q_word_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as word-processor files, a turn a paragraph, beside one file that is none."""
    path = fresh_path(spark, "documents")
    c = fx.table(spark, sf_dir, "conversations").filter("conv_id IS NOT NULL")
    line = F.regexp_replace(F.concat_ws(": ", "role", F.coalesce("text", F.lit(""))), r"\n", " ")
    whole = c.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", line.alias("x")))), lambda x: x["x"]), "\n").alias("text"))
    documents.write_documents(whole, path, "conv_id")
    fx.table(spark, sf_dir, "region").agg(F.max("r_name").alias("value")).write.mode("append").text(path)
    found = texts.documents(spark, path)
    name = F.regexp_extract("path", r"([^/]+)\.docx$", 1)
    return found.select(name.alias("name"), F.md5("text").alias("digest"), F.col("error").isNotNull().alias("broken"))


DOCUMENTS_SQL = r"""
WITH t AS (SELECT conv_id, turn, regexp_replace(replace(concat_ws(': ', role, coalesce(text, '')), chr(10), ' '), '[\x00-\x08\x0b\x0c\x0e-\x1f]', '', 'g') AS x FROM conversations WHERE conv_id IS NOT NULL)
SELECT CAST(conv_id AS VARCHAR) AS name, md5(string_agg(x || chr(10), '' ORDER BY turn, x)) AS digest, false AS broken FROM t GROUP BY conv_id UNION ALL SELECT '', NULL, true
"""

def q_warped_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every twentieth vector as a query: the five nearest of all vectors of its label, by time warping within six samples."""
    e = fx.table(spark, sf_dir, "embeddings")
    items = e.select(F.col("vec_id").alias("item_id"), "label", F.col("embedding").alias("series"))
    found = warping.nearest_warped(items.filter("item_id % 20 = 0").withColumnRenamed("item_id", "query_id"), items, "label", 5, 6)
    return found.select("query_id", "item_id", F.round("distance", 6).alias("distance"), "rank")


#: The table of path costs row by row, each cell the least of what lies below, left and both.
WARPED_SQL = """
WITH RECURSIVE e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE label IS NOT NULL),
t(q, t, x, y, i, d) AS (
  SELECT a.vec_id, b.vec_id, a.x, b.x, 0, list_prepend(0.0::DOUBLE, list_transform(range(64), lambda j: 'inf'::DOUBLE)) FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0
  UNION ALL
  SELECT q, t, x, y, i + 1, list_reduce(
      list_prepend(['inf'::DOUBLE], list_transform(range(1, 65), lambda j: [CASE WHEN abs(j - i - 1) <= 6 THEN pow(x[i + 1] - y[j], 2) ELSE 'inf'::DOUBLE END, least(d[j + 1], d[j])])),
      lambda a, c: list_append(a, c[1] + least(c[2], a[len(a)])))
  FROM t WHERE i < 64)
SELECT q AS query_id, t AS item_id, round(sqrt(d[65]), 6) AS distance, CAST(row_number() OVER (PARTITION BY q ORDER BY d[65], t) AS INT) AS rank FROM t WHERE i = 64 QUALIFY rank <= 5
"""

def q_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight entries of each vector as a frame's scores, 64 frames a segment: where on the best path each of ten tokens lies."""
    e = fx.table(spark, sf_dir, "embeddings")
    segment = F.floor(F.col("vec_id") / 64).cast("string")
    frames = e.select(segment.alias("segment_key"), (F.col("vec_id") % 64).alias("frame_no"), F.slice("embedding", 1, 8).alias("scores"))
    targets = frames.select("segment_key").distinct().select("segment_key", F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.get(F.array(*map(F.lit, (1, 2, 2, 3, 7, 7, 4, 1, 5, 6))), i)).alias("tokens"))
    found = trellis.token_spans(frames, targets)
    return found.select("segment_key", "pos", "token", "frame", "last_frame", F.round("score", 6).alias("score"))


#: States with their best score and path so far, frame by frame; 21 states for ten tokens, blanks in between.
TOKENS_SQL = """
WITH RECURSIVE f AS (SELECT CAST(vec_id // 64 AS VARCHAR) AS k, vec_id % 64 AS t, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
c(sym, skip) AS (SELECT [0, 1, 0, 2, 0, 2, 0, 3, 0, 7, 0, 7, 0, 4, 0, 1, 0, 5, 0, 6, 0], [3, 7, 9, 13, 15, 17, 19]),
p(k, t, s) AS (
  SELECT k, t, list_transform(range(21), lambda j: {'v': CASE WHEN j < 2 THEN x[sym[j + 1] + 1] ELSE '-inf'::DOUBLE END, 'p': [j]}) FROM f, c WHERE t = 0
  UNION ALL
  SELECT p.k, f.t, list_transform(list_transform(range(21), lambda j: {'j': j, 'b':
      CASE WHEN (j < 1 OR s[j + 1].v >= s[j].v) AND (NOT list_contains(skip, j) OR s[j + 1].v >= s[j - 1].v) THEN s[j + 1]
           WHEN NOT list_contains(skip, j) OR s[j].v >= s[j - 1].v THEN s[j] ELSE s[j - 1] END}), lambda z: {'v': z.b.v + f.x[c.sym[z.j + 1] + 1], 'p': list_append(z.b.p, z.j)})
  FROM p JOIN f ON f.k = p.k AND f.t = p.t + 1, c),
w AS (SELECT k, CASE WHEN s[21].v >= s[20].v THEN s[21].p ELSE s[20].p END AS path, greatest(s[21].v, s[20].v) AS v FROM p QUALIFY t = max(t) OVER (PARTITION BY k)),
u AS (SELECT k, unnest(path) AS s, unnest(range(len(path))) AS t FROM w WHERE v > '-inf'::DOUBLE)
SELECT u.k AS segment_key, CAST(s // 2 AS INT) AS pos, CAST(any_value(sym[s + 1]) AS INT) AS token, min(u.t) AS frame, max(u.t) AS last_frame, round(avg(x[sym[s + 1] + 1]), 6) AS score
FROM u JOIN f ON f.k = u.k AND f.t = u.t, c WHERE s % 2 = 1 GROUP BY u.k, s
"""

QUERIES = {
    "q_token_frames": (q_token_frames, TOKENS_SQL),
    "q_warped_search": (q_warped_search, WARPED_SQL),
    "q_wave_files": (q_wave_files, WAVE_FILES_SQL),
    "q_decoded_waves": (q_decoded_waves, DECODED_SQL),
    "q_resampled_waves": (q_resampled_waves, RESAMPLED_SQL),
    "q_word_documents": (q_word_documents, DOCUMENTS_SQL),
}
