"""Percentiles of every number that metrics hold."""

import json

from tallyrig.llm.queries import QUANTILES, p5_combined_days, p5_percentiles

SCHEMA = """episode_path string, task string, date string, operator string, robot string, controller string, phases_completed array<int>,
phase_status map<int,string>, metrics string, final_status string, training_ready boolean, last_updated timestamp"""


def test_every_numeric_key_has_percentiles(spark, tmp_path):
    metrics = [json.dumps({"p2_fps": 30, "p5_standstill_segment_count": i % 3, "p9_new": f"{i}", "note": "n/a", "p2_total_frames": None}) for i in range(40)]
    metrics += ['{"p2_fps": 15, "p9_', None, "[]", "{}"]
    lines = [(f"e{i}", "t", "20260101", "o", "ur", None, None, None, m, "pass", True, None) for i, m in enumerate(metrics)]
    spark.createDataFrame(lines, SCHEMA).write.parquet(f"{tmp_path}/episodes.parquet")
    expected = {"p2_fps": [30.0] * 40, "p5_standstill_segment_count": sorted(i % 3 for i in range(40)), "p9_new": list(range(40))}

    def at(v, q):
        pos = q * (len(v) - 1)
        lo = int(pos)
        return v[lo] + (v[min(lo + 1, len(v) - 1)] - v[lo]) * (pos - lo)

    exact = {(r["metric"], r["quantile"]): (r["n"], r["value"]) for r in p5_percentiles(spark, str(tmp_path)).collect()}
    assert exact == {(m, q): (40, round(at(v, q), 6)) for m, v in expected.items() for q in QUANTILES}
    days = {(r["metric"], r["quantile"]): r["value"] for r in p5_combined_days(spark, str(tmp_path)).collect()}
    assert days.keys() == exact.keys()
    assert all(abs(v - exact[k][1]) <= 0.005 * exact[k][1] + 1e-6 for k, v in days.items())
