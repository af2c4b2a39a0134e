"""Speakers: numbering, turn statistics, roles, per-speaker metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.functions.times import micros

ROLE_ORDER = ("ENUMERATOR", "RESPONDENT", "OTHER", "UNKNOWN")


def renumber(turns: DataFrame, min_turn_s: float = 0.5) -> DataFrame:
    """Turns of at least min_turn_s, speakers renamed SPEAKER_nn in the order of their raw names per recording."""
    kept = turns.filter(micros(F.col("end_s")) - micros(F.col("start_s")) >= int(min_turn_s * 1_000_000))
    rank = F.dense_rank().over(Window.partitionBy("recording_id").orderBy("speaker_id")) - 1
    return kept.withColumn("speaker_id", F.format_string("SPEAKER_%02d", rank))


def turn_stats(turns: DataFrame) -> DataFrame:
    """Per recording and speaker: first start, plain talk time, turns, mean turn."""
    d = micros(F.col("end_s")) - micros(F.col("start_s"))
    return turns.groupBy("recording_id", "speaker_id").agg(
        F.min("start_s").alias("first_start_s"), (F.sum(d) / 1e6).alias("talk_time_s"), F.count("*").alias("n_turns"), (F.avg(d) / 1e6).alias("avg_turn_s")
    )


def union_talk_time(turns: DataFrame) -> DataFrame:
    """Per recording and speaker, the time under at least one turn: overlapping turns count once."""
    t = turns.select("recording_id", "speaker_id", micros(F.col("start_s")).alias("a"), micros(F.col("end_s")).alias("b"))
    w = Window.partitionBy("recording_id", "speaker_id").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("b") - F.greatest(F.col("a"), F.coalesce(F.max("b").over(w), F.col("a"))))
    return t.select("recording_id", "speaker_id", fresh.alias("us")).groupBy("recording_id", "speaker_id").agg((F.sum("us") / 1e6).alias("talk_time_s"))


def count_by_speaker(segments: DataFrame) -> DataFrame:
    return segments.groupBy("recording_id", "speaker_id").agg(F.count("*").alias("n_segments"))


def label_roles(stats: DataFrame) -> DataFrame:
    """stats (of turn_stats) with ``role``: of the two who talk most, who leads is the enumerator.

    Speaking first weighs two, more turns and shorter turns one each; equal scores go to who talks more. One
    speaker alone is UNKNOWN, all beyond two are OTHER. Ties in talk time go to who is seen first, then by name.
    """
    w = Window.partitionBy("recording_id")
    ranked = stats.withColumn("_rank", F.row_number().over(w.orderBy(F.desc("talk_time_s"), "first_start_s", "speaker_id"))).withColumn("_n", F.count("*").over(w))

    def of(rank: int, c: str) -> Column:
        return F.max(F.when(F.col("_rank") == rank, F.col(c))).over(w)

    def score(a: int, b: int) -> Column:
        first = F.when(of(a, "first_start_s") < of(b, "first_start_s"), 2).otherwise(0)
        return first + F.when(of(a, "n_turns") > of(b, "n_turns"), 1).otherwise(0) + F.when(of(a, "avg_turn_s") < of(b, "avg_turn_s"), 1).otherwise(0)

    leader = F.when(score(1, 2) >= score(2, 1), 1).otherwise(2)
    role = F.when(F.col("_n") == 1, "UNKNOWN").when(F.col("_rank") > 2, "OTHER").when(F.col("_rank") == leader, "ENUMERATOR").otherwise("RESPONDENT")
    return ranked.withColumn("role", role).drop("_rank", "_n")


def by_role(df: DataFrame) -> DataFrame:
    """Rows in the order of roles, then by talk time."""
    order = F.create_map(*[F.lit(x) for k, r in enumerate(ROLE_ORDER) for x in (r, k)])
    return df.orderBy("recording_id", order[F.col("role")], F.desc("talk_time_s"), "speaker_id")


def long_enough(metrics: DataFrame, least_s: float = 0.5) -> DataFrame:
    """Speakers with enough audio; to be applied after roles are given."""
    return metrics.filter(F.col("talk_time_s") >= least_s)


def quality_of(snr: Column, talk_s: Column) -> Column:
    return F.when(talk_s < 1, "BAD").when(snr < 8, "BAD").when(snr < 12, "POOR").when(snr >= 20, "GOOD").otherwise("OK")


def others_power(powers: DataFrame) -> DataFrame:
    """Per recording and speaker the power of the other speakers for its own: total minus own, no self-join."""
    w = Window.partitionBy("recording_id")
    others = F.sum("power").over(w) - F.col("power")
    return powers.withColumn("crosstalk", F.when(F.col("power") > 1e-12, others / F.col("power")).otherwise(0.0))
