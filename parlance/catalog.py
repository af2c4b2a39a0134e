"""Registry of the queries and of the SQL that states the same results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parlance.plans import exchange, meetings, models, ratings, recordings, scores, sounds, speech, streams, texts, training, waves

MODULES = (speech, ratings, texts, training, waves, meetings, streams, scores, models, exchange, sounds, recordings)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for m in MODULES for name, (query, _) in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, (_, sql) in m.QUERIES.items() if sql is not None}
