"""Plans over series against brute force: every joint and both sides count."""

import math
import random

import pytest

from tallyrig.operators.ordered import with_last_known
from tallyrig.checks import robot_state, run, timestamps
from tallyrig.plans import series

JOINT_SCHEMA = "episode_path string, row_idx long, timestamp_ms double, " + ", ".join(f"j{i} double" for i in range(1, 8)) + ", gripper double"
POSES = "episode_path string, row_idx long, timestamp_ms double, " + ", ".join(f"{s}_{a} double" for s in ("left", "right") for a in "xyz")
EPISODES = """episode_path string, last_updated timestamp, robot string, task string, date string, operator string, controller string, phases_completed array<int>,
phase_status map<int,string>, metrics string, final_status string, training_ready boolean"""


@pytest.fixture
def joint_folder(spark, tmp_path):
    """Writes joint rows as a data folder."""

    def write(lines):
        spark.createDataFrame(lines, JOINT_SCHEMA).write.parquet(f"{tmp_path}/state_joint_position.parquet")
        spark.createDataFrame([], POSES).write.parquet(f"{tmp_path}/actions_eef_pose.parquet")
        robots = [(e, None, r, "t", *[None] * 8) for e, r in (("e", "ARX5 "), ("wide", "flexiv"), ("other", "franka"))]
        spark.createDataFrame(robots, EPISODES).write.parquet(f"{tmp_path}/episodes.parquet")
        return str(tmp_path)

    return write


def test_last_known_crosses_chunks(spark):
    rng = random.Random(3)
    lines = [("e", i, None if rng.random() < 0.6 else float(i), 1.0 if i == 0 else None) for i in range(90)]
    out = with_last_known(spark.createDataFrame(lines, "k string, i long, a double, b double"), ["k"], "i", ["a", "b"], chunk_rows=7)
    a = b = None
    expected = []
    for k, i, x, y in lines:
        expected.append((k, i, a, b))
        a, b = x if x is not None else a, y if y is not None else b
    assert sorted(out.select("k", "i", "prev_a", "prev_b").collect()) == expected


def test_phase5_judges_every_joint_by_its_robot(spark, joint_folder):
    # j3 lacks a reading and steps across it, j7 steps; 0.2 is too far for one robot and not for the other.
    lines = []
    for e in ("e", "wide", "other", "unknown"):
        for i in range(8):
            j = [0.0] * 7
            j[2] = None if i == 4 else (0.0 if i < 4 else 0.5)
            j[6] = 0.0 if i < 6 else 0.2
            lines.append((e, i, i * 1000.0, *j, 0.09 if i == 3 else 0.08))
    folder = joint_folder(lines)
    for chunk in (3, 8192):
        found = robot_state.check_phase5(spark, folder, chunk_rows=chunk).collect()
        steps = {(r.episode_path, r.subject, r.measured) for r in found if r.check_name == "joint_step_too_large"}
        narrow = {(e, j, v) for e in ("e", "other", "unknown") for j, v in (("j3", 0.5), ("j7", 0.2))}
        assert steps == narrow | {("wide", "j3", 0.5)}
        assert {(r.episode_path, r.subject, r.measured) for r in found if r.check_name == "joint_nan_inf"} == {(e, "j3", 1.0) for e in ("e", "wide", "other", "unknown")}
        assert {(r.episode_path, r.measured) for r in found if r.check_name == "gripper_out_of_limits"} == {(e, 0.008) for e in ("e", "other", "unknown")}
        assert {(r.episode_path, r.subject) for r in found if r.check_name == "robot_config_fallback"} == {("other", "franka"), ("unknown", None)}
        assert {r.check_name for r in found if r.check_name.startswith("joint_v")} == set()


def test_phase5_speeds(spark, joint_folder):
    # A joint at 3 rad a second: too fast for the wide robot, not for the other; and a sudden stop.
    lines = [(e, i, i * 10.0, *[0.03 * min(i, 60)] * 7, 0.05) for e in ("e", "wide") for i in range(64)]
    found = robot_state.check_phase5(spark, joint_folder(lines), chunk_rows=5).collect()
    assert {(r.episode_path, r.subject) for r in found if r.check_name == "joint_velocity_exceeded"} == {("wide", f"j{k}") for k in range(1, 8)}
    assert {r.check_name for r in found} >= {"joint_acceleration_high"}
    assert all(r.measured == pytest.approx(300 * 0.39, abs=0.5) for r in found if r.check_name == "joint_acceleration_high")


def test_phases_and_their_needs():
    assert [p.number for p in run.ordered_phases()] == [1, 2, 3, 5, 7]
    assert [p.number for p in run.ordered_phases([3, 1])] == [1, 3]
    for wrong in ([2], [1, 9]):
        with pytest.raises(ValueError):
            run.ordered_phases(wrong)


def test_long_drop_runs_against_their_group(spark, tmp_path):
    frames, names = [], []
    for e, longest in (("a", 1), ("b", 2), ("c", 3), ("d", 4), ("e", 5), ("f", 60)):
        marks = ["1"] * 5 + ["0"] * longest + ["1"]
        frames += [(e, "left_tactile", i, 33.0 * i, m) for i, m in enumerate(marks)]
        names.append((e, None, "ur", "t", *[None] * 8))
    frames += [("lone", "m", i, 33.0 * i, "0" if i < 12 else "1") for i in range(20)]
    names.append(("lone", None, "ur", "other", *[None] * 8))
    spark.createDataFrame(frames, "episode_path string, modality string, row_idx long, timestamp_ms double, is_new string").write.parquet(f"{tmp_path}/frame_times.parquet")
    spark.createDataFrame(names, EPISODES).write.parquet(f"{tmp_path}/episodes.parquet")
    out = {(r.episode_path, r.status) for r in timestamps.consecutive_drops_outlier(spark, str(tmp_path)).collect()}
    assert out == {("f", "needs_review"), ("lone", "warning")}
    found = {(r.episode_path, r.check_name) for r in timestamps.check_phase3(spark, str(tmp_path), chunk_rows=8).collect()}
    assert {("f", "frame_drop_consecutive"), ("f", "frame_drop_ratio"), ("lone", "consecutive_drops_outlier")} <= found


@pytest.fixture
def pose_folder(spark, tmp_path):
    """Writes pose rows as a data folder."""

    def write(lines):
        spark.createDataFrame(lines, POSES).write.parquet(f"{tmp_path}/actions_eef_pose.parquet")
        return str(tmp_path)

    return write


def test_path_of_each_side(spark, pose_folder):
    rng = random.Random(8)
    lines = []
    for i in range(60):
        right = [rng.uniform(0, 0.06) for _ in range(3)]
        if rng.random() < 0.2:
            right[2] = rng.choice([None, math.nan])
        lines.append(("e", i, i * 50.0, 0.0, 0.0, 0.001 * i, *right))
    out = {r["side"]: r for r in series.path_and_steps(spark, pose_folder(lines)).collect()}
    assert set(out) == {"left", "right"}
    for side, at in (("left", 3), ("right", 6)):
        line = [x[at : at + 3] for x in lines if all(v is not None and not math.isnan(v) for v in x[at : at + 3])]
        steps = [math.dist(a, b) for a, b in zip(line, line[1:])]
        r = out[side]
        assert r["rows"] == len(line) and r["large_steps"] == sum(d > 0.05 for d in steps)
        assert r["path_length"] == pytest.approx(sum(steps), abs=1e-4) and r["largest_step"] == pytest.approx(max(steps), abs=1e-6)
        assert r["extent"] == pytest.approx(sum(max(c) - min(c) for c in zip(*line)), abs=1e-4)
    assert out["left"]["large_steps"] == 0 < out["right"]["large_steps"]


def test_every_joint_has_its_jitter_speed_and_turn(spark, joint_folder):
    # Chunks of 16 rows, so that missing readings lie about their borders.
    rng = random.Random(6)
    lines = []
    for i in range(100):
        j = [0.0, *[None if rng.random() < 0.3 else rng.uniform(-1, 1) * (0.01 if k < 4 else 1) for k in range(6)]]
        lines.append(("e", i, 20.0 * i, *j, 0.05))
    folder = joint_folder(lines)
    read = {f"j{k}": [(r[2], r[2 + k]) for r in lines if r[2 + k] is not None] for k in range(1, 8)}
    jitter = {r["joint"]: r for r in series.jitter_score(spark, folder, chunk_rows=16).collect()}
    speeds = {r["joint"]: r for r in series.velocity_p99(spark, folder, chunk_rows=16).collect()}
    turns = {r["joint"]: r for r in series.unwrap_degrees(spark, folder, chunk_rows=16).collect()}
    assert set(jitter) == set(speeds) == set(turns) == set(read)
    for j, line in read.items():
        v = [x for _, x in line]
        off = [abs(x - sum(w) / len(w)) for k, x in enumerate(v) for w in [v[max(0, k - 2) : k + 3]]]
        assert jitter[j]["jitter"] == pytest.approx(sum(off) / len(off), abs=1e-6)
        s = sorted(abs(b - a) / ((u - t) / 1000) for (t, a), (u, b) in zip(line, line[1:]))
        at = 0.99 * (len(s) - 1)
        p99 = s[int(at)] + (at - int(at)) * (s[min(int(at) + 1, len(s) - 1)] - s[int(at)])
        assert speeds[j]["steps"] == len(s) and speeds[j]["p99_velocity"] == pytest.approx(p99, abs=1e-4)
        assert speeds[j]["exceeded"] == (p99 > 4.5)
        angle, c = math.degrees(v[0]) * 4, [math.degrees(v[0]) * 4]
        for a, b in zip(v, v[1:]):
            angle += (math.degrees(b) * 4 - math.degrees(a) * 4 + 180) % 360 - 180
            c.append(angle)
        assert turns[j]["swept_degrees"] == pytest.approx(max(c) - min(c), abs=1e-3) and turns[j]["last_angle"] == pytest.approx(c[-1], abs=1e-3)
    assert not speeds["j1"]["exceeded"] and speeds["j7"]["exceeded"]
    assert jitter["j1"]["status"] == "pass" and jitter["j7"]["status"] == "fail"


def test_displacement_and_sessions_of_both_hands(spark, pose_folder):
    # The left hand moves along z, the right one slantwise; x alone never passes a bound.
    rng = random.Random(4)
    lines, left, right = [], [0.0] * 3, [0.0] * 3
    for i in range(120):
        if rng.random() < 0.1:
            left[2] += rng.choice([-0.4, 0.4])
        if rng.random() < 0.1:
            right = [v + rng.choice([-0.009, 0.009, 0.25]) for v in right]
            right[0] = 0.0
        lines.append(("e", i, 100.0 * i, *left, *(right if i % 17 else (None, *right[1:]))))
    folder = pose_folder(lines)
    moved = {r["side"]: r for r in series.trailing_displacement(spark, folder).collect()}
    found = sorted((r["side"], r["start_ms"], r["end_ms"], r["fast_rows"]) for r in series.session_merge(spark, folder).collect())
    sessions = []
    for side, at in (("left", 3), ("right", 6)):
        line = [(x[2], x[at : at + 3]) for x in lines if x[at] is not None]
        far = [math.dist(p, next(q for u, q in line if t - u <= 500)) for t, p in line]
        r = moved[side]
        assert r["moments"] == len(line) and r["jumps"] == sum(d > 0.35 for d in far) > 0
        assert r["largest"] == pytest.approx(max(far), abs=1e-6)
        runs = []
        for t in [t for (_, a), (t, b) in zip(line, line[1:]) if math.dist(a, b) > 0.01]:
            if runs and t - runs[-1][1] < 500:
                runs[-1][1:] = [t, runs[-1][2] + 1]
            else:
                runs.append([t, t, 1])
        sessions += [(side, *x) for x in runs]
    assert found == sorted(sessions)


def test_long_outages_count_as_missing(spark, tmp_path):
    times = [50.0 * i for i in range(20)] + [950.0 + 40_000.0 + 50.0 * i for i in range(20)]
    lines = [("e", "wrist", i, t, "1") for i, t in enumerate(times)]
    spark.createDataFrame(lines, "episode_path string, modality string, row_idx long, timestamp_ms double, is_new string").write.parquet(f"{tmp_path}/frame_times.parquet")
    r = series.missing_inferred(spark, str(tmp_path)).collect()[0]
    assert (r["gaps"], r["missing_frames"], r["longest"]) == (1, 799, 799)
