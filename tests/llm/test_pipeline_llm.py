import os
import re
import time

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from parlance.llm import common, queries, simhash

pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the supplied tables aren't here")


def test_stages_on_odd_rows(spark, tmp_path):
    rows = [(1, "only a few"), (2, None), (3, " ".join(f"w{k}" for k in range(40))), (4, " ".join(f"w{k}" for k in range(40))), (3, " ".join(f"w{k}" for k in range(40))), (None, " ".join(f"v{k}" for k in range(20)) + " password=abcdefgh1")]
    clashing = "n id digest fp row hash kept quality pieces secrets spans tokens item_id component_id text_hash body ids".split()
    docs = spark.createDataFrame([(i, t, None, None, None, *["more"] * len(clashing)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in clashing))
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
    out = {r["doc_id"]: r for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()}
    assert set(out) == {3, None} and out[None]["text"].endswith(" <secret:assign>") and out[3]["n_tokens"] == len(out[3]["ids"])
    assert out[3]["pieces"] == out[3]["n"] == "more"


def test_stages_on_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_archive_query_against_sql(spark):
    got = sorted(tuple(r) for r in queries.op4_warc(spark, SF).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    want = sorted(con.execute(f"SELECT page_id, payload_bytes, payload_digest, record_type, refers_to FROM ({queries.OP4_SQL})").fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_queries_return_rows(spark, name):
    assert queries.queries()[name](spark, SF).count() > 0


def test_long_texts_with_common_passages_are_ruled_out_by_parity(spark):
    """256 bits can't tell long sets apart; as many bits as shingles do, and never lose a pair."""
    rng = np.random.default_rng(5)
    rows = []
    for n, share in [(3000, 0.9), (3000, 0.85), (3000, 0.3), (700, 0.81), (700, 0.5), (40, 0.8), (1, 1.0), (2000, 0.1)]:
        a = rng.integers(0, 1 << 63, n, dtype=np.int64).view(np.uint64)
        keep = int(np.ceil(2 * share * n / (1 + share)))  # equal sizes with that similarity, at least
        b = np.concatenate([a[:keep], rng.integers(0, 1 << 63, n - keep, dtype=np.int64).view(np.uint64)])
        a, b = np.unique(a), np.unique(b)
        rows.append((len(a), bytearray(simhash.long_parity(a)), len(b), bytearray(simhash.long_parity(b)), share))
    sizes = {len(r[1]) for r in rows}
    got = spark.createDataFrame(rows, "n int, x binary, m int, y binary, share double").select("share", simhash.may_be_similar("n", "x", "m", "y", F.lit(0.8)).alias("near")).collect()
    assert {r["share"]: r["near"] for r in got} == {s: s >= 0.8 for *_, s in rows} and sizes == {32, 128, 256, 512}
    # sets of different sizes meet at the smaller one's bits
    a = np.unique(rng.integers(0, 1 << 63, 1100, dtype=np.int64).view(np.uint64))
    two = [(len(a), bytearray(simhash.long_parity(a)), 1000, bytearray(simhash.long_parity(a[:1000])))]
    assert spark.createDataFrame(two, "n int, x binary, m int, y binary").select(simhash.may_be_similar("n", "x", "m", "y", F.lit(0.8))).first()[0]


def test_stored_tables_leave_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = lambda: set(re.findall(r"shuffle_\d+_\d+_\d+\.data", disk.getAllFiles().mkString(" ")))
    before, df = names(), spark.range(10000).repartition(3).groupBy("id").count().repartition(2)
    out = common.store(df, "test-shuffles")
    for _ in range(50):
        if not names() - before:
            break
        time.sleep(0.1)
    left = names() - before
    assert out.count() == 10000 and not left and spark.conf.get(common.CLEANUP, None) is None
