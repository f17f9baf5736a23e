"""Results do not depend on where series are cut: tiny chunks, gaps in the order and missing values."""

import inspect
import math
import random

import numpy as np
import pytest

from tallyrig.operators.ordered import over_rows, with_halo, with_previous
from tallyrig.operators.trajectory import pchip, repair_masked
from tallyrig.plans import audits, series

FRAMES = "episode_path string, modality string, row_idx long, timestamp_ms double, is_new string"
AXES = [f"{s}_{a}" for s in ("left", "right") for a in "xyz"]
SIX = [f"{s}_r{i}" for s in ("left", "right") for i in range(1, 7)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Streams with missing row numbers, nulls, NaN, standstill, jumps and silences, one with far more rows."""
    rng = random.Random(11)
    path = str(tmp_path_factory.mktemp("chunks"))
    holes = lambda n: [i for i in range(n) if rng.random() < 0.8 and not 40 <= i < 60]
    some = lambda v, p=0.08: rng.choice([None, math.nan]) if rng.random() < p else v
    frames, poses, joints = [], [], []
    for e, n in (("e1", 260), ("e2", 70)):
        for m in ("left", "right"):
            t = 0.0
            for i in holes(n):
                t += rng.choice([33.0, 33.0, 34.0, 0.0, -5.0, 700.0])
                frames.append((e, m, i, some(t), rng.choice(["1", "1", "1", "true", "0", None])))
        j, t = [0.0] * 7, 0.0
        for i in holes(n):
            t += rng.choice([20.0, 20.0, 900.0, 0.0, -3.0])
            if rng.random() < 0.25:
                j = [v + rng.uniform(-0.2, 0.2) for v in j]
            joints.append((e, i, some(t, 0.03), *[some(v, 0.02) for v in j], 0.04))
        p, t = [0.0] * 6, 0.0
        for i in holes(n):
            t += rng.choice([50.0, 50.0, 650.0])
            k = rng.randrange(6)
            p[k] = p[k] + rng.uniform(-0.02, 0.02) if rng.random() < 0.85 else rng.uniform(-0.6, 0.6)
            poses.append((e, i, some(t, 0.03), *[some(v, 0.02) for v in p], *[rng.uniform(-1, 1) for _ in SIX]))
    double = lambda names: ", ".join(f"{c} double" for c in names)
    head = "episode_path string, row_idx long, "
    spark.createDataFrame(frames, FRAMES).write.parquet(f"{path}/frame_times.parquet")
    spark.createDataFrame(joints, head + double(["timestamp_ms", *series.JOINTS, "gripper"])).write.parquet(f"{path}/state_joint_position.parquet")
    spark.createDataFrame(poses, head + double(["timestamp_ms", *AXES, *SIX])).write.parquet(f"{path}/actions_eef_pose.parquet")
    schema = """episode_path string, task string, date string, operator string, robot string, controller string, phases_completed array<int>,
    phase_status map<int,string>, metrics string, final_status string, training_ready boolean, last_updated timestamp"""
    episodes = [(f"{rng.choice('ab')}/episode_{i:04d}", rng.choice(["a", None]), None, None, None, None, None, None, None, rng.choice(["fail", "pass", "needs_review"]), None, None) for i in range(120)]
    spark.createDataFrame(episodes, schema).write.parquet(f"{path}/episodes.parquet")
    return path


QUERIES = series.queries() | {n: audits.queries()[n] for n in ("motion_findings", "standstill_in_state", "frame_delta", "streak_warnings")}
CHUNKED = [(n, [p for p in inspect.signature(q).parameters if p.startswith("chunk")]) for n, q in QUERIES.items()]


@pytest.mark.parametrize(("name", "chunks"), [(n, c) for n, c in CHUNKED if c])
def test_equal_in_chunks_of_any_size(spark, folder, name, chunks):
    query, sizes = QUERIES[name], {"chunk_rows": (8, 8192), "chunk_ms": (600, 10**9)}
    shown = lambda df: sorted(repr([None if v is None else round(v, 5) if isinstance(v, float) else v for v in r]) for r in df.collect())
    results = [shown(query(spark, folder, **{c: sizes[c][k] for c in chunks})) for k in range(2)]
    assert results[0] == results[1]
    assert results[0]


def test_rows_before_and_after(spark):
    rng = random.Random(2)
    places = [i for i in range(300) if rng.random() < 0.3]
    data = [(k, i, float(rng.randrange(9))) for k in "ab" for i in places]
    df = spark.createDataFrame(data, "k string, i long, v double")
    make = lambda rows, by: rows.selectExpr("*").withColumn("s", series.F.sum("v").over(by.rowsBetween(-3, 2)))
    for chunk in (4, 50, 8192):
        got = {(r.k, r.i): r.s for r in over_rows(df, ["k"], "i", make, 3, 2, chunk).collect()}
        line = {k: [v for x, _, v in data if x == k] for k in "ab"}
        assert got == {(k, i): sum(line[k][max(0, n - 3) : n + 3]) for k in "ab" for n, i in enumerate(places)}
    pairs = {(r.k, r.i): r.prev_v for r in with_previous(df, ["k"], "i", ["v"], 4).collect()}
    assert all(pairs[k, i] == (line[k][n - 1] if n else None) for k in "ab" for n, i in enumerate(places))
    with pytest.raises(ValueError):
        with_halo(df, ["k"], "i", halo=9, chunk=8)


def test_repair_is_that_of_the_whole_series(spark):
    rng = random.Random(9)
    data = []
    for i in range(200):
        hole = 20 <= i < 75 or 100 <= i < 103 or i < 3 or i > 190 or rng.random() < 0.2
        data.append(("s", i, math.sin(i / 9), None if rng.random() < 0.1 else float(i % 7), None if hole and i % 5 == 0 else hole))
    data += [("none", i, 1.0, 2.0, True) for i in range(12)] + [("one", i, float(i), 2.0, i != 5) for i in range(12)]
    df = spark.createDataFrame(data, "k string, i long, a double, b double, bad boolean")
    for chunk in (8, 64, 8192):
        got = {(r.k, r.i): (r.a, r.b) for r in repair_masked(df, ["k"], "i", ["a", "b"], "bad", chunk).collect()}
        assert len(got) == len(data)
        for k in ("s", "none", "one"):
            lines = [r for r in data if r[0] == k]
            x = np.array([r[1] for r in lines], float)
            mask = np.array([r[4] is not False for r in lines])
            for c in (0, 1):
                y = np.array([math.nan if r[2 + c] is None else r[2 + c] for r in lines])
                take = ~mask & np.isfinite(y)
                want = np.where(mask, pchip(x[take], y[take], x), y)
                have = np.array([math.nan if got[k, r[1]][c] is None else got[k, r[1]][c] for r in lines])
                np.testing.assert_allclose(have, want, atol=1e-12)
