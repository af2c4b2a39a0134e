"""Exact percentiles by radix selection, and splits of repeated rows."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parlance.operators import dataset, intervals, selection


def test_percentiles_against_numpy(spark):
    rng = np.random.default_rng(3)
    groups = {
        "normal": rng.normal(size=3001),
        "wide": rng.normal(size=500) * 10.0 ** rng.integers(-300, 300, 500),
        "ties": rng.integers(-2, 3, 800).astype(float),
        "close": 1.0 + np.arange(700) * 2.0**-52,
        "one": np.array([-7.25]),
        "two": np.array([-1.0, 3.0]),
        "zeros": np.array([0.0, -0.0, 0.0]),
        None: np.array([5.0, 1.0]),
        "endless": np.array([float("-inf"), 0.0, 1.0, 2.0, float("inf")]),
    }
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("one", None), ("one", float("nan")), ("none", None)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "recording_id string, v double").repartition(7)
    shares = (0.0, 0.25, 0.5, 0.75, 1.0)
    got = {r["recording_id"]: r for r in selection.percentiles(df, shares).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert got[g]["n"] == len(vs)
        v = np.sort(vs)
        if g == "endless":
            assert got[g]["p"] == [float("-inf"), 0.0, 1.0, 2.0, float("inf")]
            continue
        at = np.array(shares) * (len(v) - 1)
        lo, hi = v[np.floor(at).astype(int)], v[np.ceil(at).astype(int)]
        assert got[g]["p"] == (lo + (hi - lo) * (at - np.floor(at))).tolist()
    assert selection.percentiles(df.limit(0), shares).count() == 0


def test_percentiles_of_one_large_group(spark):
    df = spark.range(2_000_000).select(F.lit("all").alias("recording_id"), ((F.col("id") * 7919) % 2_000_003).cast("double").alias("v"))
    values = np.sort(np.arange(2_000_000) * 7919 % 2_000_003).astype(float)
    got = selection.percentiles(df, (0.1, 0.9)).first()
    assert got["n"] == 2_000_000 and np.allclose(got["p"], np.percentile(values, [10, 90]), rtol=1e-15)


@pytest.fixture(scope="module")
def repeated(spark):
    rows = [(f"k{k}", "a", k) for k in range(20)] + [("k3", "a", 99), ("k3", "a", 98)] + [("same", "b", k) for k in range(10)] + [("z", "b", 1), (None, "b", 2), (None, "b", 3), ("n", None, 4)]
    return spark.createDataFrame(rows, "id string, src string, x int")


def test_splits_keep_every_row_once(repeated):
    want = collections.Counter(tuple(r) for r in repeated.collect())
    for out in (dataset.dev_split(repeated, "id", 0.9), dataset.dev_split(repeated, "id"), dataset.stratified_split(repeated, 3, ["src"], "id"), dataset.stratified_split(repeated, 100, ["src"], "id", rule="floor")):
        assert out.columns == [*repeated.columns, "split"]
        rows = out.collect()
        assert collections.Counter(tuple(r)[:3] for r in rows) == want
        sides = collections.defaultdict(set)
        for r in rows:
            sides[r["src"], r["id"]].add(r["split"])
        assert all(len(s) == 1 for s in sides.values())


def test_split_sizes_count_keys(repeated):
    rows = dataset.stratified_split(repeated, 3, ["src"], "id").collect()
    keys = collections.Counter(s for s, _ in {(r["src"], r["id"]) for r in rows if r["split"] == "val"})
    assert keys == {"a": 3, "b": 1, None: 1}
    dev = {r["id"] for r in dataset.dev_split(repeated, "id", 0.5).collect() if r["split"] == "dev"}
    assert len(dev) == 12


def greedy(rows, most, gap):
    """Groups of one recording's regions (start, end in seconds), gone through in order."""
    groups = []
    for k, (a, b) in enumerate(rows):
        if not k or a - rows[k - 1][1] >= gap or b - groups[-1][0][0] > most:
            groups.append([])
        groups[-1].append((a, b))
    return groups


@pytest.mark.parametrize("block", [1, 4, 64])
def test_greedy_groups_by_pointers(spark, block):
    rng = random.Random(block)
    recordings = {}
    for name, pause, length in (("close", 0.4, 2.0), ("gaps", 5.0, 3.0), ("tiny", 0.01, 0.05), ("long", 1.0, 40.0), ("wild", -3.0, 20.0)):
        t, rows = 0.0, []
        for _ in range(rng.randint(150, 260)):
            a = t + rng.uniform(0, abs(pause)) * (1 if pause > 0 else rng.choice([-1, 1]))
            t = a + rng.uniform(0.01, length)
            rows.append((round(a, 3), round(t, 3)))
        recordings[name] = rows
    recordings["one"] = [(1.0, 2.0)]
    rows = [(n, k, a, b) for n, rs in recordings.items() for k, (a, b) in enumerate(rs)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "recording_id string, pos int, start_s double, end_s double").repartition(3)
    got = collections.defaultdict(dict)
    for r in intervals.vad_groups(df, 30.0, 3.0, block).collect():
        got[r["recording_id"]][r["g_no"]] = r
    for name, rs in recordings.items():
        want = greedy([(round(a * 1e6), round(b * 1e6)) for a, b in rs], 30_000_000, 3_000_000)
        mine = [got[name][k] for k in range(len(want))]
        assert len(got[name]) == len(want)
        assert [[(round(x["start_s"] * 1e6), round(x["end_s"] * 1e6)) for x in r["regions"]] for r in mine] == want
        assert [(r["g0_s"], r["g1_s"]) for r in mine] == [(r["regions"][0]["start_s"], r["regions"][-1]["end_s"]) for r in mine]
    assert intervals.vad_groups(df.limit(0)).count() == 0


def test_many_small_recordings_are_no_group_each_for_python(spark):
    """Short recordings pass together in one batch; blocks of one row give the same as one block, across batches too."""
    df = spark.range(300).selectExpr("cast(floor(id / 3) as string) AS recording_id", "id % 3 AS pos", "cast(id % 3 * 20 as double) AS start_s", "id % 3 * 20 + 18.0D AS end_s")
    placed = df.selectExpr("recording_id", "pos AS i", "cast(start_s * 1e6 as long) AS a", "cast(end_s * 1e6 as long) AS b", "pos = 0 AS fresh", "3L AS n")
    jumps = intervals._group_jumps(placed, 40_000_000, 4096)
    plan = jumps._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapGroups" not in plan
    assert sorted((int(r["recording_id"]), r["i"], r["next"], r["first"]) for r in jumps.collect()) == [(k, 0, None, True) for k in range(100)]
