import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrig.functions import rotation as Q
from tallyrig.operators import kinematics as K
from tallyrig.operators.trajectory import jump_events, pchip, repair_masked, trajectory_labels


def brute_events(ms, pos, jump=0.35):
    n, k, fast = len(ms), 0, []
    for i in range(n):
        while ms[i] - ms[k] > 500:
            k += 1
        if math.dist(pos[i], pos[k]) > jump:
            fast.append(i)
    runs = []
    for i in fast:
        if runs and ms[i] - ms[runs[-1][1]] < 500:
            runs[-1][1] = i
        else:
            runs.append([i, i])
    out = []
    for a, b in runs:
        anchor = pos[max(a - 1, 0)]
        peak = max(range(a, b + 1), key=lambda j: (math.dist(pos[j], anchor), -j))
        back = any(math.dist(pos[j], anchor) <= jump and ms[j] - ms[a] <= 1000 for j in range(peak + 1, n))
        out.append((ms[a], ms[b], back))
    return out


def test_jump_events_equal_brute_force(spark):
    rng = random.Random(9)
    data, want, labels = [], set(), {}
    for e in range(8):
        t, x, line = 0, [0.0, 0.0, 0.0], []
        for i in range(300):
            t += rng.randint(20, 60)
            x = [c + rng.uniform(-0.01, 0.01) for c in x]
            line.append((t, tuple(x)))
        for _ in range(e):
            a, n = rng.randint(0, 280), rng.randint(1, 30)
            far = e % 2
            for i in range(a, 300 if far and rng.random() < 0.3 else min(300, a + n)):
                line[i] = (line[i][0], (line[i][1][0] + 0.6, *line[i][1][1:]))
        data += [(f"e{e}", i, float(ms), *p, 0.0, 0.0, 0.0) for i, (ms, p) in enumerate(line)]
        events = brute_events([m for m, _ in line], [p for _, p in line])
        want |= {(f"e{e}", a, b, r) for a, b, r in events}
        labels[f"e{e}"] = bool(events)
    data += data[:40] + [("e0", 900, float("nan"), *[0.0] * 6), (None, 1, 5.0, *[0.0] * 6)]
    schema = "episode_path string, row_idx long, timestamp_ms double, left_x double, left_y double, left_z double, right_x double, right_y double, right_z double"
    df = spark.createDataFrame(data, schema)
    got = {(r.episode_path, r.start_ms, r.end_ms, r.recovered) for r in jump_events(df).collect()}
    assert got == want and want
    named = {r.episode_path: r for r in trajectory_labels(df).collect()}
    assert named.keys() == labels.keys()
    assert all((named[e].label != "smooth") == has for e, has in labels.items())
    assert named["e0"].action == "passthrough"


def test_pchip_keeps_shape():
    x, y = np.array([0.0, 1, 2, 4, 5]), np.array([0.0, 1, 1, 3, 2])
    at = np.linspace(-1, 6, 200)
    v = pchip(x, y, at)
    assert np.allclose(pchip(x, y, x), y)
    assert v[0] == 0 and v[-1] == 2 and v.min() >= 0 and v.max() <= 3
    assert np.all(np.diff(v[(at >= 0) & (at <= 4)]) >= -1e-12)
    assert np.isnan(pchip(x[:0], y[:0], at)).all()


def test_repair_in_chunks(spark):
    data = [("a", i, math.sin(i / 20), i % 7 == 3) for i in range(300)]
    df = spark.createDataFrame([(k, i, 99.0 if bad else v, bad) for k, i, v, bad in data], "k string, i long, v double, bad boolean")
    got = {r.i: r.v for r in repair_masked(df, ["k"], "i", ["v"], "bad", chunk_rows=64).collect()}
    assert len(got) == 300
    assert max(abs(got[i] - v) for _, i, v, _ in data) < 0.01


def test_rotations(spark):
    rng = random.Random(1)
    data = [tuple(rng.gauss(0, 1) for _ in range(6)) for _ in range(60)] + [(1.0, 0, 0, 2.0, 0, 0), (0.0,) * 6]
    df = spark.createDataFrame([tuple(map(float, d)) for d in data], "a double, b double, c double, d double, e double, f double")
    df = df.withColumn("m", F.array(*Q.gram_schmidt([F.col(c) for c in "abcdef"])))
    df = df.withColumn("q", F.array(*Q.quaternion(Q.elements("m", 9))))
    q = Q.elements("q", 4)
    turned = Q.rotate(Q.intrinsic([("z", 90), ("x", 90)]), [F.lit(1.0), F.lit(2.0), F.lit(3.0)])
    rows = df.select("m", "q", F.array(*turned).alias("v"), Q.angle_between(q, q).alias("same")).collect()
    for r in rows[:60]:
        mat = np.array(r.m).reshape(3, 3).T
        assert np.allclose(mat @ mat.T, np.eye(3)) and np.linalg.det(mat) == pytest.approx(1)
        w, x, y, z = r.q
        back = np.array([[1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)], [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)], [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]])
        assert np.allclose(back, mat, atol=1e-7)
        assert r.same == pytest.approx(0, abs=1e-6)
    assert rows[60].m[3] is None and rows[61].m[0] is None
    assert np.allclose(rows[0].v, [3, 1, 2])


def test_gripper_distance(spark):
    df = spark.createDataFrame([(10.0,), (55.0,), (100.0,), (120.0,), (250.0,), (5.0,)], "a double")
    got = [r[0] for r in df.select(Q.gripper_distance(F.col("a"), F.lit(10.0), F.lit(100.0), F.lit(False))).collect()]
    assert got == pytest.approx([0, 0.0425, 0.085, 0.085, 0, 0])
    back = df.select(Q.gripper_distance(F.col("a"), F.lit(100.0), F.lit(10.0), F.lit(True)), Q.gripper_distance(F.col("a"), F.lit(1.0), F.lit(1.0), F.lit(True))).collect()
    assert back[1][0] == pytest.approx(0.0425) and back[0][1] is None


ARM = K.Arm("planar", ((0.3, 0.0, 0.0, 0.0), (0.3, 1.57, 0.0, 0.0), (0.2, 0.0, 0.0, 0.0)), (-3.0,) * 3, (3.0,) * 3, (3.0,) * 3)


def test_reachability(spark):
    rng = np.random.default_rng(2)
    data = []
    for i in range(30):
        p = K.position(ARM, rng.uniform(-1.5, 1.5, 3))
        data.append(("e", i, i * 1000.0, *map(float, p)))
    data += [("e", 30, 30_000.0, 5.0, 5.0, 5.0), ("e", 31, 31_000.0, None, 0.0, 0.0)]
    df = spark.createDataFrame(data, "episode_path string, row_idx long, timestamp_ms double, x double, y double, z double")
    got = {r.row_idx: r for r in K.evaluate_points(df, ARM, ["x", "y", "z"]).collect()}
    assert sum(got[i].error_m < 0.005 for i in range(30)) >= 24
    assert got[30].reason == "position_error" and not got[30].reachable
    assert got[31].reason == "not_finite" and got[31].quality == 0
    points = K.workspace(spark, ARM, 400)
    assert points.count() == 400 and sorted(points.collect()) == sorted(K.workspace(spark, ARM, 400, batch=50).collect())
    bounds = K.workspace_bounds(points)
    assert bounds.count() == 3
    assert K.best_offset(points, bounds).first().inside > 350
