"""The registered queries of the corpus operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.llm import align, decontam, katz, langid, pagetext, pieces, quality, secrets, simhash, substrings, tokenfile, warc, whiten
from parlance.llm.common import documents, fresh_path


def public_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(documents(spark, sf_dir))
    return found.select(F.col("id").alias("doc_id"), simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, octet_length(encode(h)) AS n, sha1(h) AS d, max(page_id) OVER (PARTITION BY h) AS m FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> m THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> m THEN m END AS refers_to
FROM q
"""


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_file("word_bpe_49k.json"), encoding="utf-8") as f:
        definition = f.read()
    path = fresh_path(spark, "token-shards")
    tokenfile.write_tokens(documents(spark, sf_dir), definition, path, end_id=2)
    return tokenfile.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.matches(documents(spark, sf_dir), items).select("doc_id", "item_id", "covered_tokens", "item_tokens", "slots_changed")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return warc.round_trip(pages).select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a source is an owner, and its texts of one language are one of its repositories
    docs = documents(spark, sf_dir, "doc_id", "text", "source", "lang").withColumn("repository", F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none"))))
    found = secrets.scan(docs, repo_col="repository")
    of = lambda *kinds: F.filter("secrets", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secrets.listed(of("assign", "access", "hex")), 256).alias("base_sha256"),
        secrets.listed(F.col("secrets")).alias("spans"),
    )


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.read_model(public_file("piece_bpe_32k.model"))
    p = pieces.encode(documents(spark, sf_dir), model)
    listed = F.array_join(F.col("pieces.ids").cast("array<string>"), ",")
    return p.select(
        "doc_id",
        F.size("pieces.ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2(F.col("pieces.decoded"), 256).alias("decoded_sha256"),
    )


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicate(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op8_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", langid.held_out(modulus=5))
    return katz.score(docs, "held_out").withColumnRenamed("id", "doc_id")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(documents(spark, sf_dir)).select("doc_id", "quality.*")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang").withColumn("held_out", langid.held_out())
    model = langid.fit(docs.filter("NOT held_out AND doc_id IS NOT NULL"))
    return langid.predict(docs.drop("lang"), model).select("doc_id", "held_out", "language.*")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    # beyond a long's range, which takes some million vectors, the exact deviation is left to the operator's decimal
    return found.withColumnRenamed("id", "vec_id").withColumn("deviation", F.col("deviation").try_cast("long"))


#: What the supplied pages' articles hold, which are marked as such; the query itself reads any page.
OP12_SQL = r"""
WITH a AS (SELECT page_id, url, regexp_replace(regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '</?(p|h1|br)>', ' ', 'g'), '<[^>]*>', '', 'g') AS x FROM pages),
t AS (SELECT page_id, url, trim(regexp_replace(regexp_replace(replace(replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)), '&amp;?', '&', 'g'), '[\s\x{85}\p{Z}]+', ' ', 'g')) AS text FROM a)
SELECT page_id, url, text, length(text) AS n_chars FROM t
"""


def op12_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagetext.extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_file("byte_bpe_50k.json"), encoding="utf-8") as f:
        definition = f.read()
    texts, _ = align.align(documents(spark, sf_dir), definition, pieces.read_model(public_file("piece_bpe_32k.model")))
    return texts.select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {"op4_warc": OP4_SQL, "op12_page_text": OP12_SQL}
