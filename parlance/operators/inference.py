"""One operator for any model: rows go in, rows come out, a failing row is a row with an error.

A factory is called once for each Python worker and its model kept there. Filters aren't pushed below these
operators, so put them before. Nothing else here knows what a model does.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from parlance.llm.common import pieces_of, trimmed

#: Rows of a batch that are made into objects at a time.
ROWS = 512
_MODELS: dict[str, Any] = {}


def loaded(factory: Callable[[], Any]) -> Any:
    """The factory's model, made once in this worker."""
    key = f"{factory.__module__}.{factory.__qualname__}:{hash(factory.__code__)}"
    if key not in _MODELS:
        _MODELS[key] = factory()
    return _MODELS[key]


def few_rows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches in slices, so that what a model returns for one at a time stays small."""
    for batch in batches:
        for k in range(0, len(batch), ROWS):
            yield batch.iloc[k : k + ROWS]


def infer_rows(df: DataFrame, factory: Callable[[], Callable[[dict], Iterable[dict]]], keys: list[str], inputs: list[str], schema: str) -> DataFrame:
    """Zero or more rows of ``schema`` for each row, with its keys, an error and the seconds it took.

    A row whose model call fails gives one row with the error and nothing else.
    """
    own = T.StructType.fromDDL(schema)
    full = T.StructType([*[df.schema[k] for k in keys], *own.fields, T.StructField("error", T.StringType()), T.StructField("elapsed_s", T.DoubleType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = loaded(factory)
        for batch in few_rows(batches):
            out = []
            for row in batch.to_dict("records"):
                base = {k: row[k] for k in keys}
                began = time.perf_counter()
                try:
                    got = [base | r for r in model({c: row[c] for c in inputs})]
                    spent = time.perf_counter() - began
                    out += [r | {"error": None, "elapsed_s": spent / len(got)} for r in got]
                except Exception as e:  # a model may fail in any way; the row says how
                    out.append(base | {"error": f"{type(e).__name__}: {e}", "elapsed_s": 0.0})
            yield pd.DataFrame(out, columns=full.names).astype(object).where(lambda x: x.notna(), None)

    return df.select(*dict.fromkeys([*keys, *inputs])).mapInPandas(run, full)


def infer_batches(df: DataFrame, factory: Callable[[], Callable[[list[dict]], list[list[dict]]]], keys: list[str], inputs: list[str], schema: str, batch_size: int = 8) -> DataFrame:
    """infer_rows for a model that takes batches and gives a list of rows for each row of one.

    If a batch fails, its rows are tried one by one, so that one bad row costs only itself.
    """
    own = T.StructType.fromDDL(schema)
    full = T.StructType([*[df.schema[k] for k in keys], *own.fields, T.StructField("error", T.StringType()), T.StructField("elapsed_s", T.DoubleType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = loaded(factory)

        def tried(rows: list[dict]) -> list[dict]:
            began = time.perf_counter()
            try:
                got = model([{c: r[c] for c in inputs} for r in rows])
            except Exception as e:  # a model may fail in any way; the row says how
                if len(rows) > 1:
                    return [x for r in rows for x in tried([r])]
                return [{k: rows[0][k] for k in keys} | {"error": f"{type(e).__name__}: {e}", "elapsed_s": 0.0}]
            spent = (time.perf_counter() - began) / max(1, sum(map(len, got)))
            return [{k: r[k] for k in keys} | x | {"error": None, "elapsed_s": spent} for r, found in zip(rows, got, strict=True) for x in found]

        for batch in few_rows(batches):
            rows = batch.to_dict("records")
            out = [x for k in range(0, len(rows), batch_size) for x in tried(rows[k : k + batch_size])]
            yield pd.DataFrame(out, columns=full.names).astype(object).where(lambda x: x.notna(), None)

    return df.select(*dict.fromkeys([*keys, *inputs])).mapInPandas(run, full)


def infer_text(df: DataFrame, inputs: list[str], factory: Callable[[], Callable[[list[dict]], list[str]]], out: str, batch_size: int = 8) -> DataFrame:
    """df with the model's text for each row and an error column; the model gets small batches.

    If a batch fails, its rows are tried one by one, so that one bad row costs only itself.
    """
    rest = df.drop(out, f"{out}_error")
    full = T.StructType([*rest.schema.fields, T.StructField(out, T.StringType()), T.StructField(f"{out}_error", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(factory)
        for batch in (p for b in batches for p in pieces_of(b)):
            texts: list[str | None] = []
            errors: list[str | None] = []
            for k in range(0, batch.num_rows, batch_size):
                part = batch.slice(k, batch_size).select(inputs).to_pylist()
                try:
                    got = model(part)
                    texts += got
                    errors += [None] * len(got)
                except Exception:
                    for r in part:
                        try:
                            texts += model([r])
                            errors.append(None)
                        except Exception as e:
                            texts.append(None)
                            errors.append(f"{type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string()), pa.array(errors, pa.string())], names=full.names)

    return rest.mapInArrow(trimmed(run), full)


def region_fallback(regions: DataFrame, totals: DataFrame) -> DataFrame:
    """Regions of a voice detector; a recording without any is one region of its whole length."""
    none = totals.join(regions.select("recording_id").distinct(), "recording_id", "left_anti")
    whole = none.selectExpr("recording_id", "0 AS pos", "0.0D AS start_s", "total_s AS end_s")
    return regions.select("recording_id", "pos", "start_s", "end_s").unionByName(whole)
