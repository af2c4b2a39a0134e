"""Exact percentiles of huge groups by radix selection.

Doubles become whole numbers of the same order. The digit of a wanted rank is found from counts by digit, 16 bits a
round, and the next round counts only values that share the digits found so far. So a group of any size is spread over
tasks, never sorted and never in one buffer; what meets is at most 65,536 counts for each wanted rank.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlance.storage import store

BITS, ROUNDS = 16, 4
LOW = (1 << 63) - 1


@F.arrow_udf(T.LongType())
def _ordered(v: pa.Array) -> pa.Array:
    """The bits of doubles as signed numbers that sort as the doubles do; both zeros are one."""
    bits = (v.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0).view(np.int64)
    return pa.array(np.where(bits < 0, bits ^ LOW, bits))


@F.arrow_udf(T.DoubleType())
def _double(key: pa.Array) -> pa.Array:
    bits = key.to_numpy(zero_copy_only=False).astype(np.int64)
    return pa.array(np.where(bits < 0, bits ^ LOW, bits).view(np.float64))


def percentiles(values: DataFrame, shares: tuple[float, ...], group: str = "recording_id") -> DataFrame:
    """(group, p: array, n): percentiles of ``v``, between the two nearest ranks in proportion. Nulls and NaN don't count.

    Groups are told apart as equality does, null being one; a group without values is left out.
    """
    keys = store(values.select(F.col(group).alias("g"), F.col("v").cast("double").alias("v")).filter("v IS NOT NULL AND NOT isnan(v)").select("g", _ordered("v").alias("key")), "ordered-values")
    # signed digits first, so that the order of digits is the order of values
    digit = lambda k: F.shiftright("key", 64 - BITS) if k == 0 else F.shiftright("key", 64 - BITS * (k + 1)).bitwiseAND((1 << BITS) - 1)
    counts = keys.groupBy("g", digit(0).alias("digit")).agg(F.count("*").alias("k"))
    w = Window.partitionBy("g").orderBy("digit")
    first = counts.select("g", "digit", "k", (F.sum("k").over(w) - F.col("k")).alias("before"), F.sum("k").over(Window.partitionBy("g")).alias("n"))
    # the ranks below and above each share, found among the digits of the first round
    place = [F.lit(s) * (F.col("n") - 1) for s in shares]
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"), f(x).cast("long").alias("rank")) for i, x in enumerate(place) for side, f in ((0, F.floor), (1, F.ceil))])
    found = first.select("g", "n", "digit", "k", "before", F.explode(wanted).alias("x")).select("g", "n", "digit", "k", "before", "x.*")
    found = found.filter("before <= rank AND rank < before + k").select("g", "n", "i", "side", (F.col("rank") - F.col("before")).alias("rank"), F.col("digit").alias("prefix"))
    for k in range(1, ROUNDS):
        high = keys.select(F.col("g").alias("_g"), F.shiftright("key", 64 - BITS * k).alias("_prefix"), digit(k).alias("digit"))
        target = ["g", "n", "i", "side", "rank", "prefix"]
        near = high.join(found, F.col("_g").eqNullSafe(F.col("g")) & (F.col("_prefix") == F.col("prefix"))).groupBy(*target, "digit").agg(F.count("*").alias("k"))
        upto = F.sum("k").over(Window.partitionBy(*target).orderBy("digit"))
        near = near.withColumn("before", upto - F.col("k")).filter("before <= rank AND rank < before + k")
        found = near.select("g", "n", "i", "side", (F.col("rank") - F.col("before")).alias("rank"), (F.shiftleft("prefix", BITS) + F.col("digit")).alias("prefix"))
    v = found.select("g", "n", "i", "side", _double("prefix").alias("v"))
    pairs = v.groupBy("g", "n", "i").agg(F.min(F.when(F.col("side") == 0, F.col("v"))).alias("lo"), F.min(F.when(F.col("side") == 1, F.col("v"))).alias("hi"))
    share = F.array(*map(F.lit, shares))[F.col("i")] * (F.col("n") - 1)
    between = F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.col("lo") + (F.col("hi") - F.col("lo")) * (share - F.floor(share)))
    p = pairs.select("g", "n", "i", between.alias("p")).groupBy("g").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("i", "p"))).alias("ps"))
    return p.select(F.col("g").alias(group), F.transform("ps", lambda x: x["p"]).alias("p"), "n")
