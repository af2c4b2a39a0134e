"""Language identification, words first, then progressively shorter character n-grams.

A word that training saw is scored by its log relative frequency in each language, with a fixed penalty where a
language lacks it. A word that no language knows is scored by its longest n-grams that any language knows: all
n-grams of one order are averaged, and the next shorter order is taken only if none of them is known. A text's
cost in a language is the mean over its words; the score is the likeliest language's share of the mean likelihoods.

The model is fitted on a bounded sample of the labelled rows, chosen by a hash of the id: ``docs_per_language``, and
no more than ``sample_docs`` for all languages together (one for each, where there are more languages than that). It
keeps every word and n-gram of the sample, so what the driver collects and the tasks receive does not grow with the
input. Every text is predicted whole.

Defined results: a null text, or one without letters, is ``und`` with score 0, as is every text if no row can
be learned from; ties go to the label that sorts first; repeated rows each get their own result; columns besides
the text pass through, and one named like the output is replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlance.llm.common import bucket_of, slices, store, utf8, with_struct

UND = "und"
LETTERS = regex.compile(r"\p{L}+")
#: Bytes of word scores that a worker keeps.
KEPT_BYTES = 32 << 20


@dataclass(frozen=True)
class Params:
    docs_per_language: int = 1_500
    sample_docs: int = 12_000
    orders: tuple[int, ...] = (4, 3, 2, 1)
    penalty: float = 7.0  # -log10 of what a language lacks


class Gains:
    """For each key, in which languages it was seen and how much it gains there over the penalty."""

    def __init__(self, rows: pa.Table, width: int):
        self.at = {k: i for i, k in enumerate(rows.column("key").to_pylist())}
        lists = rows.column("found").combine_chunks()
        self.starts = lists.offsets.to_numpy()
        found = lists.values
        self.language, self.gain = (found.field(f).to_numpy(zero_copy_only=False) for f in ("language", "gain"))
        self.width = width

    def rows(self, at: list[int]) -> np.ndarray:
        """One line of gains for each key's place."""
        at = np.array(at, np.int64)
        n = self.starts[at + 1] - self.starts[at]
        ends = np.cumsum(n)
        flat = np.repeat(self.starts[at] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
        out = np.zeros((len(at), self.width), np.float32)
        out[np.repeat(np.arange(len(at)), n), self.language[flat]] = self.gain[flat]
        return out


class Model:
    """Words and n-grams with their gains; a worker builds its tables from the Arrow rows that it receives."""

    def __init__(self, languages: list[str], rows: dict[int, pa.Table], penalty: float):
        self.languages, self.rows, self.penalty = languages, rows, penalty
        self.tables: dict[int, Gains] = {}
        self.seen: dict[str, int] = {}
        self.held: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return {"languages": self.languages, "rows": self.rows, "penalty": self.penalty, "tables": {}, "seen": {}, "held": None}

    def gains(self, words: list[str]) -> np.ndarray:
        """A line for each word: its own, else the mean of its longest n-grams that are known, else zero."""
        out = np.zeros((len(words), len(self.languages)), np.float32)
        left = range(len(words))
        for n, table in self.tables.items():
            get, flat, sizes, placed, rest = table.at.get, [], [], [], []
            for k in left:
                padded = f" {words[k]} "
                found = [i for j in range(len(padded) - n + 1) if (i := get(padded[j : j + n])) is not None] if n else [i] if (i := get(words[k])) is not None else []
                if found:
                    flat += found
                    sizes.append(len(found))
                    placed.append(k)
                else:
                    rest.append(k)
            if placed:
                size = np.array(sizes)
                out[placed] = np.add.reduceat(table.rows(flat), np.cumsum(size) - size, axis=0) / size[:, None]
            left = rest
        return out

    def lines(self, words: list[str]) -> np.ndarray:
        """Gains of words that may repeat; what is new is worked out at once and kept while there is room."""
        fresh = [w for w in dict.fromkeys(words) if w not in self.seen]
        room = max(1024, KEPT_BYTES // (4 * len(self.languages) + 150))
        if self.held is None or len(self.seen) + len(fresh) > len(self.held):
            self.seen, fresh = {}, list(dict.fromkeys(words))
            self.held = np.empty((max(room, len(fresh)), len(self.languages)), np.float32)
        if fresh:
            start = len(self.seen)
            self.held[start : start + len(fresh)] = self.gains(fresh)
            self.seen.update(zip(fresh, range(start, start + len(fresh)), strict=True))
        return self.held[[self.seen[w] for w in words]]

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        if not self.languages:
            return [(UND, 0.0)] * len(texts)
        if not self.tables:
            self.tables = {n: Gains(t, len(self.languages)) for n, t in self.rows.items()}
        cut = [LETTERS.findall(t.lower()) for t in texts]
        totals = np.zeros((len(texts), len(self.languages)))
        for a, b in slices([len(w) for w in cut], 100_000):  # a longer text in parts
            words = [w for c in cut[a:b] for w in c]
            doc = np.repeat(np.arange(a, b), [len(c) for c in cut[a:b]])
            for k in range(0, len(words), 100_000):
                d = doc[k : k + 100_000]
                first = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
                totals[d[first]] += np.add.reduceat(self.lines(words[k : k + 100_000]), first, axis=0, dtype=float)
        out = []
        for words, total in zip(cut, totals, strict=True):
            if not words:
                out.append((UND, 0.0))
                continue
            mean = math.log(10) * (total / len(words) - self.penalty)
            best = int(mean.argmax())
            out.append((self.languages[best], float(1 / np.exp(mean - mean[best]).sum())))
        return out


def grams(word: Column, n: int) -> Column:
    padded = F.concat(F.lit(" "), word, F.lit(" "))
    return F.when(F.length(padded) >= n, F.transform(F.sequence(F.lit(1), F.length(padded) - (n - 1)), lambda i: F.substring(padded, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", params: Params = Params()) -> Model:
    """A model from rows with a text and a label; the sample is taken in the scan, and words are counted there."""
    rows = labelled.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = store(rows.groupBy("lang").agg(F.count("*").alias("docs")), "language-sizes")
    n = sizes.count()
    if not n:
        return Model([], {}, params.penalty)
    quota = max(1, min(params.docs_per_language, params.sample_docs // n))
    share = F.ceil(F.lit(quota) / F.col("docs") * 2**20)
    sample = rows.join(sizes, "lang").filter(F.pmod(F.xxhash64("id"), F.lit(2**20)) < share)
    words = sample.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), 1)).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    words = store(words, "language-words")
    languages = sorted(r["lang"] for r in words.select("lang").distinct().collect())
    if not languages:
        return Model([], {}, params.penalty)
    every = F.array(F.struct(F.lit(0).alias("order"), F.array("word").alias("keys")), *[F.struct(F.lit(k).alias("order"), grams(F.col("word"), k).alias("keys")) for k in params.orders])
    counts = words.select("lang", "n", F.explode(every).alias("g")).select("lang", "n", "g.order", F.explode("g.keys").alias("key")).groupBy("lang", "order", "key").agg(F.sum("n").alias("n"))
    counts = store(counts, "language-counts")
    totals = counts.groupBy("lang", "order").agg(F.sum("n").alias("total"))
    number = F.array_position(F.array(*map(F.lit, languages)), F.col("lang")).cast("int") - 1
    gain = F.greatest(F.lit(0.0), F.lit(params.penalty) - F.log10(F.col("total") / F.col("n"))).cast("float")
    table = counts.join(totals, ["lang", "order"]).groupBy("order", "key").agg(F.collect_list(F.struct(number.alias("language"), gain.alias("gain"))).alias("found"))
    table = store(table, "language-gains")
    # at most one list entry a language; as many rows as the bounded sample has different words and n-grams
    found = {k: table.filter(F.col("order") == k).select("key", "found").toArrow() for k in (0, *params.orders)}
    return Model(languages, found, params.penalty)


FIELDS = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def predict(docs: DataFrame, model: Model, text_col: str = "text", out: str = "language") -> DataFrame:
    """docs and a struct column of the predicted language and its share of the likelihood; no shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.Array:
        m = sent.value
        got = m.predict([t.decode() for t in utf8(batch.column(batch.schema.get_field_index(text_col)))])
        return pa.StructArray.from_arrays([pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], FIELDS.names)

    return with_struct(docs, out, FIELDS, run)


def held_out(id_col: str = "doc_id", modulus: int = 3) -> Column:
    """True for ids whose crc32 leaves remainder 1; false for a null id, of which the caller says whether it is learned from."""
    return F.coalesce(bucket_of(F.col(id_col), modulus) == 1, F.lit(False))
