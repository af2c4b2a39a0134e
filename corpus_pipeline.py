"""A corpus pipeline: quality rules, near copies, benchmark leaks, secrets, piece encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result to the shared folder
and reads it again as the next stage's documents. All stages but the last return the columns of documents. The
stages accept what their operators accept: nulls in any column, empty and very long texts, repeated rows, empty
tables; columns besides those of documents go along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.llm import decontam, pieces, quality, secrets, simhash
from parlance.llm.common import store
from parlance.llm.queries import public_file


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; the others go."""
    return quality.keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: fingerprints of five-word shingles, similarity 0.8 or more."""
    return simhash.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that hold a benchmark item, as it is or with other numbers, names or units."""
    return decontam.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by tags that tell live-looking ones from copied examples."""
    return secrets.redact(docs)


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their number of piece ids (``n_tokens``) and the ``ids``, in place of columns so named."""
    model = pieces.read_model(public_file("piece_bpe_32k.model"))
    kept = [c for c in docs.columns if c.lower() not in ("n_tokens", "ids")]
    return pieces.encode(docs, model, out="__pieces").select(*kept, F.size("__pieces.ids").cast("long").alias("n_tokens"), F.col("__pieces.ids").alias("ids"))


STAGES = [
    ("quality rules", quality_rules),
    ("near copies", near_copies),
    ("benchmark leaks", benchmark_leaks),
    ("secret scans", secret_spans),
    ("piece encoding", piece_ids),
]
#: No stage but the first has a plain SQL form; tests hold the stages against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
