"""Training-set building over documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.functions.text import chat_messages
from parlance.operators import dataset, scoring
from parlance.plans import fixtures as fx

KEYS = ["src", "subsource"]


def keep() -> Column:
    return dataset.sample_filter(F.col("text"), script="[A-Za-z]", min_ratio=0.5) & dataset.quality_filter(F.col("wer"), F.col("wps"))


LATIN = "length(regexp_replace(text, '[^A-Za-z]', '', 'g')) / nullif(length(regexp_replace(text, '[^\\p{L}]', '', 'g')), 0)::DOUBLE"
KEEP = f"(trim(text) <> '' AND coalesce({LATIN} >= 0.5, false) AND wer < 1.0 AND coalesce(wps, 5.0) BETWEEN 0.5 AND 8.0)"


def q_sample_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset.counted(fx.pairs(spark, sf_dir), keep(), KEYS)


FILTER_SQL = f"SELECT src, subsource, count(*) AS total, count(*) FILTER ({KEEP}) AS kept, count(*) FILTER (NOT {KEEP}) AS filtered FROM {fx.PAIRS} GROUP BY ALL"


def done(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as those that are written already."""
    return fx.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id")).distinct()


def q_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a second run still has to do."""
    return dataset.not_done(fx.pairs(spark, sf_dir).filter(keep()), done(spark, sf_dir), ["id"]).select("src", "subsource", "id")


RESUME_SQL = f"SELECT src, subsource, id FROM {fx.PAIRS} p WHERE {KEEP} AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = p.id)"


def q_capped_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source up to a cap, counting what is written; the cap is the feature."""
    p = fx.pairs(spark, sf_dir)
    have = p.join(done(spark, sf_dir), "id")
    return dataset.capped(p, 30, ["src"], "id", have).select("src", "id")


CAPPED_SQL = f"""
WITH h AS (SELECT src, count(*) AS n FROM {fx.PAIRS} p WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = p.id) GROUP BY src),
r AS (SELECT src, id, row_number() OVER (PARTITION BY src ORDER BY id) AS k FROM {fx.PAIRS} p WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = p.id))
SELECT r.src, r.id FROM r LEFT JOIN h USING (src) WHERE k <= 30 - coalesce(h.n, 0)
"""


def q_even_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same number of each language; the sample is the feature."""
    return dataset.even_sample(fx.pairs(spark, sf_dir), 100, ["subsource"], "id", order=["id"]).select("subsource", "id")


EVEN_SQL = f"""SELECT subsource, id FROM (SELECT subsource, id, row_number() OVER (PARTITION BY subsource ORDER BY id) AS k FROM {fx.PAIRS})
WHERE k <= greatest(1, 100 // (SELECT count(*) FROM (SELECT DISTINCT subsource FROM {fx.PAIRS})))"""


def q_random_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seeded sample in hash order; the sample is the feature."""
    return dataset.random_sample(fx.pairs(spark, sf_dir), 100, "id").select("id", "src")


ORDER = "md5('42:' || id), id"
SAMPLE_SQL = f"SELECT id, src FROM {fx.PAIRS} ORDER BY {ORDER} LIMIT 100"


def q_stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset.stratified_split(fx.pairs(spark, sf_dir), 10, KEYS, "id", order=["id"]).select("src", "subsource", "id", "split")


SPLIT_SQL = f"""SELECT src, subsource, id, CASE WHEN row_number() OVER (PARTITION BY src, subsource ORDER BY id) <= greatest(1, least(10, floor(count(*) OVER (PARTITION BY src, subsource) * 0.2))) THEN 'val' ELSE 'train' END AS split FROM {fx.PAIRS}"""


def q_dev_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth in hash order."""
    return dataset.dev_split(fx.pairs(spark, sf_dir), "id").select("id", "split")


DEV_SQL = f"SELECT id, CASE WHEN row_number() OVER (ORDER BY {ORDER}) <= greatest(1, floor(count(*) OVER () * 0.1)) THEN 'dev' ELSE 'train' END AS split FROM {fx.PAIRS}"


def q_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset.composition(fx.pairs(spark, sf_dir), KEYS)


def q_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as new values over a default for every document."""
    from parlance.operators.quality import upsert_files

    old = fx.table(spark, sf_dir, "documents").select("doc_id", F.lit(-1).alias("quality"))
    new = fx.table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    return upsert_files(old, new, ["doc_id"])


UPSERT_SQL = """WITH n AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id)
SELECT doc_id, CAST(quality AS INT) AS quality FROM n UNION ALL SELECT doc_id, -1 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM n)"""


def q_chat_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as chat records, taken apart again."""
    p = fx.pairs(spark, sf_dir)
    m = p.select("id", F.explode(chat_messages(F.lit("Transcribe."), F.col("src"), F.col("text"), F.when(F.col("id") % 2 == 0, F.col("subsource")))).alias("m"))
    return m.select("id", "m.role", F.md5(F.col("m.content").cast("binary")).alias("content"))


CHAT_SQL = f"""SELECT id, 'system' AS role, md5('Transcribe.') AS content FROM {fx.PAIRS} UNION ALL SELECT id, 'user', md5(src) FROM {fx.PAIRS}
UNION ALL SELECT id, 'assistant', md5('BN: ' || text || CASE WHEN id % 2 = 0 AND subsource <> '' THEN chr(10) || 'EN: ' || subsource ELSE '' END) FROM {fx.PAIRS}"""


def q_parallel_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parallel text by id, empty where there is none."""
    p = fx.pairs(spark, sf_dir).select("id", "src")
    en = fx.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.md5(F.col("text").cast("binary")).alias("english"))
    return dataset.with_english(p, en)


PARALLEL_SQL = "SELECT d.doc_id AS id, source AS src, coalesce(md5(b.text), '') AS english FROM documents d LEFT JOIN benchmark b ON b.item_id = d.doc_id"


def q_candidate_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every twentieth vector the five nearest of its label by cosine distance, exact."""
    e = fx.table(spark, sf_dir, "embeddings").select("label", "vec_id", F.col("embedding").alias("vector"))
    q, i = e.filter("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id"), e.withColumnRenamed("vec_id", "item_id")
    return scoring.top_k_cosine(q, i, "label", 5).select("query_id", "item_id", "rank")


SEARCH_SQL = """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL),
p AS (SELECT q.vec_id AS query_id, i.vec_id AS item_id, round(1 - list_dot_product(q.v, i.v) / sqrt(list_dot_product(q.v, q.v) * list_dot_product(i.v, i.v)), 5) AS d FROM e q JOIN e i ON q.label = i.label AND q.vec_id <> i.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, item_id) AS k FROM p)
SELECT query_id, item_id, CAST(k AS INT) AS rank FROM r WHERE k <= 5
"""


def q_ranking_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source of each document guessed from a list of candidates made of its number."""
    n = F.col("doc_id")
    d = fx.table(spark, sf_dir, "documents").select(F.col("source").alias("gold"), F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.concat(F.lit("src"), ((n * 7 + i * 3) % 20).cast("string"))).alias("candidates"), F.when(n % 11 != 0, (n % 10).cast("int")).alias("picked"))
    m = scoring.ranking_metrics(d, 8)
    return m.select("n", "unparseable", "wrong", *[F.round(c, 6).alias(c) for c in ("rank1", "picker", "recall_at_k", "lift")], "verdict")


RANKING_SQL = """
WITH d AS (SELECT source AS gold, [ 'src' || ((doc_id * 7 + i * 3) % 20) FOR i IN range(10)] AS c, CASE WHEN doc_id % 11 <> 0 THEN doc_id % 10 END AS p FROM documents),
m AS (SELECT count(*) AS n, avg((c[1] = gold)::INT) AS rank1, avg(coalesce(c[CAST(p + 1 AS INT)] = gold, false)::INT) AS picker, avg(list_contains(c[1:8], gold)::INT) AS recall_at_k,
  count(*) FILTER (p IS NULL) AS unparseable, count(*) FILTER (p IS NOT NULL AND c[CAST(p + 1 AS INT)] IS DISTINCT FROM gold) AS wrong FROM d)
SELECT n, unparseable, wrong, round(rank1, 6) AS rank1, round(picker, 6) AS picker, round(recall_at_k, 6) AS recall_at_k, round(picker - rank1, 6) AS lift,
  CASE WHEN picker - rank1 >= 0.2 THEN 'strong' WHEN picker - rank1 >= 0.05 THEN 'modest' ELSE 'none' END AS verdict FROM m
"""

QUERIES = {
    "q_sample_filter": (q_sample_filter, FILTER_SQL),
    "q_resume": (q_resume, RESUME_SQL),
    "q_capped_sources": (q_capped_sources, CAPPED_SQL),
    "q_even_sample": (q_even_sample, EVEN_SQL),
    "q_random_sample": (q_random_sample, SAMPLE_SQL),
    "q_stratified_split": (q_stratified_split, SPLIT_SQL),
    "q_dev_split": (q_dev_split, DEV_SQL),
    "q_composition": (q_composition, f"SELECT src, subsource, count(*) AS n FROM {fx.PAIRS} GROUP BY ALL"),
    "q_upsert": (q_upsert, UPSERT_SQL),
    "q_chat_records": (q_chat_records, CHAT_SQL),
    "q_parallel_text": (q_parallel_text, PARALLEL_SQL),
    "q_candidate_search": (q_candidate_search, SEARCH_SQL),
    "q_ranking_metrics": (q_ranking_metrics, RANKING_SQL),
}
