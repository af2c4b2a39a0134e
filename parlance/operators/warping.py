"""Nearest series by banded dynamic time warping, hopeless ones given up early.

Items are dealt over slices of their block; each query meets every slice of its block once. In a slice, paths are
followed in single precision, a diagonal of the table at a time for thousands of items: first to some that are near
point by point, whose k best give a limit, then to all, which are given up once their paths have passed the limit. With
room for the rounding, what may be among the k best then takes an exact distance, many queries' at a time. The slices' k
best are cut to k. Nothing below the limit is given up, so the result is that of comparing everything.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parlance.operators.dataset import first_per_group
from parlance.storage import store

#: Most pairs whose distances are taken at once: a step costs about the same for one as for hundreds.
STEP = 4096
#: Queries that are taken at a time, and near items that give a query its limit.
QUERIES, FIRST = 64, 64
#: Items of a query that are no longer followed apart from the other queries'.
REST = 64
#: Diagonals after which paths are compared with the limit.
LOOK = 16


def envelope(x: np.ndarray, size: int, band: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest value of x within band of each of size places; empty ranges are unreachable."""
    low, high = np.full(size, np.inf), np.full(size, -np.inf)
    for d in range(-band, band + 1):
        a, b = max(0, -d), min(size, len(x) - d)
        if a < b:
            low[a:b], high[a:b] = np.minimum(low[a:b], x[a + d : b + d]), np.maximum(high[a:b], x[a + d : b + d])
    return low, high


def bounds(x: np.ndarray, items: np.ndarray, band: int) -> np.ndarray:
    """For each row of items, what a warped path costs at least: how far its values lie outside x's envelope."""
    low, high = envelope(x, items.shape[1], band)
    with np.errstate(invalid="ignore"):
        return (np.maximum(np.maximum(items - high, low - items), 0.0) ** 2).sum(axis=1)


def path_costs(x: np.ndarray, y: np.ndarray, band: int, limit: np.ndarray, rest: int = 0) -> tuple[np.ndarray, np.ndarray, bool]:
    """Costs of the best paths for columns of y, which columns these are, and True: without those above the limit throughout.

    x: one column, or one for each of y. Each cell takes the least of those below, left and both. A path meets one of
    any two diagonals in a row and costs never fall, so columns above ``limit`` on both are given up. Stops where no
    more than ``rest`` columns are left: their costs are lower bounds then, and the last value is False.
    """
    n, m, kept = len(x), len(y), np.arange(y.shape[1])
    if abs(n - m) > band or not len(kept):
        return np.empty(0, y.dtype), kept[:0], True
    bounded, x = bool(np.isfinite(limit).any()), x[::-1]
    older, old, now = (np.empty((m + 2, len(kept)), y.dtype) for _ in range(3))
    older[:3] = old[:3] = np.inf  # cells are read only next to those of the diagonals before, where what lies beside them is set
    cost = np.empty((band + 2, len(kept)), y.dtype)
    first = last = 0
    for s in range(n + m - 1):
        before = first, last
        low, high = max(0, s - m + 1, (s - band + 1) // 2), min(n - 1, s, (s + band) // 2)  # of x
        first, last = s - high, s - low + 1  # of y
        if low > high:
            now[:] = np.inf
        else:
            c, here = cost[: last - first], now[first + 1 : last + 1]
            np.subtract(y[first:last], x[n - 1 - high : n - low], out=c)
            np.multiply(c, c, out=c)
            if s:
                np.minimum(old[first + 1 : last + 1], old[first:last], out=here)
                np.minimum(here, older[first:last], out=here)
                np.add(here, c, out=here)
            else:
                here[:] = c
            now[first], now[last + 1] = np.inf, np.inf
        older, old, now = old, now, older
        if bounded and s % LOOK == LOOK - 1:
            least = np.minimum(old[first + 1 : last + 1].min(0, initial=np.inf), older[before[0] + 1 : before[1] + 1].min(0, initial=np.inf))
            at = np.flatnonzero(least <= limit)
            if len(at) <= rest:
                return least[at], kept[at], False
            if 2 * len(at) < len(kept):
                y, kept, limit = y.take(at, 1), kept[at], limit[at]
                x = x.take(at, 1) if x.shape[1] > 1 else x
                older, old, now = older.take(at, 1), old.take(at, 1), np.empty((m + 2, len(at)), y.dtype)
                cost = np.empty((len(cost), len(at)), y.dtype)
    at = np.flatnonzero(old[m] <= limit)
    return old[m][at], kept[at], True


def warped(x: np.ndarray, items: np.ndarray, band: int, limit: float | np.ndarray = np.inf) -> np.ndarray:
    """Squared differences along the best path from both starts to both ends, at most band off the diagonal; for each row of items.

    x: a series, or one for each of items. What is above ``limit`` is given up as infinite.
    """
    out = np.full(len(items), np.inf)
    found, at, _ = path_costs(np.ascontiguousarray(np.atleast_2d(x).T), np.ascontiguousarray(items.T), band, np.broadcast_to(np.asarray(limit, np.float64), len(items)))
    out[at] = found
    return out


def single(xs: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Both in single precision, times a power of two that leaves no value above one, and that power."""
    power = -int(np.frexp(max(np.abs(xs).max(initial=0.0), np.abs(items).max(initial=0.0)))[1])
    return np.ldexp(xs, power).astype(np.float32), np.ldexp(items, power).astype(np.float32), power


def roomy(cost: float, steps: int) -> float:
    """What a path of that cost and so many steps doesn't pass in single precision, or the other way round: values up to one, differences and sums are rounded."""
    return (np.sqrt(cost) + np.sqrt(steps) * 2.0**-22) ** 2 * (1 + (steps + 8) * 2.0**-22)


def first_limits(xs: np.ndarray, items: np.ndarray, k: int, band: int, near: np.ndarray, skip: np.ndarray) -> np.ndarray:
    """For each row of xs what k items' paths don't pass, in single precision; of items that come first in near's order."""
    size = min(max(FIRST, k), len(items))
    first = np.argpartition(np.where(skip, np.inf, near), size - 1, axis=1)[:, :size]
    query, row = np.repeat(np.arange(len(xs)), size), first.reshape(-1)
    costs = np.full(len(row), np.inf, np.float32)
    for a in range(0, len(row), STEP):
        x, y = np.ascontiguousarray(xs[query[a : a + STEP]].T), np.ascontiguousarray(items[row[a : a + STEP]].T)
        found, at, _ = path_costs(x, y, band, np.full(y.shape[1], np.inf, np.float32))
        costs[a + at] = found
    costs[skip[query, row]] = np.inf
    costs = costs.reshape(first.shape)
    return np.partition(costs, k - 1, axis=1)[:, k - 1].astype(np.float64) if size >= k else np.full(len(xs), np.inf)


def hopeful(x: np.ndarray, columns: np.ndarray, k: int, band: int, limit: float, skip: np.ndarray) -> np.ndarray:
    """Columns, all of them but skip, that may be among the k nearest of x, of which k are known to be within the limit."""
    if not np.isfinite(limit):
        return np.flatnonzero(~skip)
    steps, found = len(x) + len(columns), []
    limit = roomy(roomy(limit, steps), steps)
    for a in range(0, columns.shape[1], STEP):
        part = columns[:, a : a + STEP]
        costs, at, whole = path_costs(x[:, None], part, band, np.full(part.shape[1], limit, np.float32), REST)
        mine = ~skip[a + at]
        costs, at = costs[mine], a + at[mine]
        if whole and len(costs) >= k:
            limit = min(limit, roomy(roomy(float(np.partition(costs, k - 1)[k - 1]), steps), steps))
            at = at[costs <= np.float32(limit)]
        found.append(at)
    return np.concatenate(found)


def nearest_of(xs: np.ndarray, items: np.ndarray, k: int, band: int, skip: np.ndarray) -> tuple[list[list[tuple[float, int]]], list[int]]:
    """For each row of xs the k nearest rows of items with their distances, ties by row, and how many took an exact one.

    skip: for each row of xs, which items are left out.
    """
    if abs(xs.shape[1] - items.shape[1]) > band:
        return [[] for _ in xs], [0] * len(xs)
    small_x, small, _ = single(xs, items)
    columns = np.ascontiguousarray(small.T)
    if xs.shape[1] == items.shape[1]:  # whichever items come first, the result is the same
        near = (small**2).sum(1) - 2 * small_x @ columns
    else:
        near = np.stack([bounds(x, small.astype(np.float64), band) for x in small_x.astype(np.float64)])
    limits = first_limits(small_x, small, k, band, near, skip)
    rows = [hopeful(x, columns, k, band, limit, s) for x, limit, s in zip(small_x, limits, skip, strict=True)]
    query, row = np.repeat(np.arange(len(xs)), [len(r) for r in rows]), np.concatenate(rows)
    parts = [slice(a, a + STEP) for a in range(0, len(query), STEP)]
    found = np.concatenate([np.empty(0), *(warped(xs[query[p]], items[row[p]], band) for p in parts)])
    compared = np.bincount(query, minlength=len(xs)).tolist()
    good = np.isfinite(found)
    query, row, found = query[good], row[good], found[good]
    by = np.lexsort((row, found, query))
    query, row, found = query[by], row[by].tolist(), found[by].tolist()
    at = np.searchsorted(query, np.arange(len(xs) + 1)).tolist()
    return [list(zip(found[a:b][:k], row[a:b][:k], strict=True)) for a, b in zip(at[:-1], at[1:], strict=True)], compared


def nearest_in(x: np.ndarray, items: np.ndarray, k: int, band: int) -> tuple[list[tuple[float, int]], int]:
    """The k nearest rows of items with their distances, ties by row, and how many rows were compared exactly."""
    best, compared = nearest_of(x[None, :], items, k, band, np.zeros((1, len(items)), bool))
    return best[0], compared[0]


def nearest_warped(queries: DataFrame, items: DataFrame, block: str, k: int, band: int, query_id: str = "query_id", item_id: str = "item_id", series: str = "series", slice_rows: int = 4096) -> DataFrame:
    """(query_id, item_id, distance, rank, compared, candidates): the k nearest items of each query among its block's.

    An item of the query's own id is left out. ``compared`` of the query's ``candidates`` took an exact distance. Series
    that are null, empty or hold null or non-finite values are left out, as are null blocks and items whose length no path within the
    band reaches. Ties go to the smaller item id.
    """
    good = F.forall(series, lambda v: v.isNotNull() & (F.abs(v.cast("double")) < float("inf"))) & (F.size(series) > 0) & F.col(block).isNotNull()
    q = queries.filter(good).select(F.col(query_id).alias("q"), F.col(block).alias("block"), F.col(series).cast("array<double>").alias("x"))
    t = items.filter(good).select(F.col(item_id).alias("t"), F.col(block).alias("block"), F.col(series).cast("array<double>").alias("y"))
    # slices by counts, so that a block of a third of all items is many groups
    counts = t.groupBy("block").agg(F.ceil(F.count("*") / slice_rows).cast("int").alias("slices"))
    t = t.join(counts, "block").withColumn("slice", F.pmod(F.xxhash64("t"), F.col("slices")).cast("int")).drop("slices")
    q = q.join(counts.withColumnRenamed("block", "_b"), F.col("block") == F.col("_b")).select("q", "x", F.col("block").alias("_block"), F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("_slice"))
    kinds = {c: d.schema[c].dataType.simpleString() for c, d in (("q", q), ("t", t))}

    def by_length(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        lengths = pc.list_value_length(column).to_numpy()
        groups = [(np.flatnonzero(lengths == n), n) for n in np.unique(lengths).tolist()]
        return [(rows, pc.take(column, pa.array(rows)).flatten().to_numpy().reshape(-1, n)) for rows, n in groups]

    def search(asked: pa.Table, held: pa.Table) -> pa.Table:
        held = held.sort_by("t")
        plain, own = held["t"].to_pylist(), asked["q"].to_pylist()
        places: dict[object, list[int]] = {}
        for r, t in enumerate(plain):
            places.setdefault(t, []).append(r)
        groups, out = by_length(held["y"].combine_chunks()), []
        for queries, xs in by_length(asked["x"].combine_chunks()):
            for a in range(0, len(queries), QUERIES):
                some = queries[a : a + QUERIES].tolist()
                same = np.zeros((len(some), len(plain)), bool)
                for i, q in enumerate(some):
                    same[i, places.get(own[q], [])] = True
                best: list[list[tuple[float, int]]] = [[] for _ in some]
                compared, candidates = np.zeros(len(some), np.int64), (~same).sum(1)
                for rows, values in groups:
                    found, n = nearest_of(xs[a : a + QUERIES], values, k, band, same[:, rows])
                    compared += n
                    for nearest, more in zip(best, found, strict=True):
                        nearest += [(d, int(rows[r])) for d, r in more]
                for q, f, c, n in zip(some, best, compared.tolist(), candidates.tolist(), strict=True):
                    out.append((own[q], None, None, c, n))
                    out += [(own[q], plain[r], d, 0, 0) for d, r in sorted(f)[:k]]
        columns = list(zip(*out, strict=True)) or [()] * 5
        types = [asked.schema.field("q").type, held.schema.field("t").type, pa.float64(), pa.int64(), pa.int64()]
        return pa.table([pa.array(list(c), kind) for c, kind in zip(columns, types, strict=True)], names=["q", "t", "d", "compared", "candidates"])

    met = q.groupBy("_block", "_slice").cogroup(t.groupBy("block", "slice")).applyInArrow(search, f"q {kinds['q']}, t {kinds['t']}, d double, compared long, candidates long")
    met = store(met, "warped")
    work = met.groupBy("q").agg(F.sum("compared").alias("compared"), F.sum("candidates").alias("candidates"))
    best = first_per_group(met.filter("t IS NOT NULL"), ["q"], ["d", "t"], k)
    rank = F.row_number().over(Window.partitionBy("q").orderBy("d", "t"))
    return best.select("q", "t", "d", rank.alias("rank")).join(work, "q").select(F.col("q").alias(query_id), F.col("t").alias(item_id), F.sqrt("d").alias("distance"), "rank", "compared", "candidates")
