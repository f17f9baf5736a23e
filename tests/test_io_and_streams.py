import json
import time
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrig import config
from tallyrig.functions import exprs as X
from tallyrig.operators import store as S
from tallyrig.plans.series import bad_streaks
from tallyrig.sources import files as FS
from tallyrig.sources import reports as RP
from tallyrig.streaming import jobs as J


@pytest.fixture
def tree(tmp_path):
    def put(path, text):
        file = tmp_path / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(text)

    put("t/20260101/ann/episode_0001/metadata.json", '{"task_key": "t", "duration_seconds": 6.5, "quality": {"labels": ["ok"]}}')
    put("t/20260101/ann/episode_0001/actions.eef_pose/data.csv", "timestamp_ms,left_x\n1.5,0.25\n2.5,abc\n3.5\n4.5,nan\n")
    put("t/20260101/ann/episode_0001/.checksum_manifest", "{}")
    put("t/20260101/ann/episode_0002/metadata.json", "[1]")
    put("t/20260101/ann/episode_0003/metadata.json", "{broken")
    put("t/20260101/ann/episode_0004/empty.txt", "")
    put("t/_quarantine/episode_0009/metadata.json", "{}")
    put("t/.trash/episode_0008/metadata.json", "{}")
    return tmp_path


def test_episode_folders(spark, tree):
    found, hidden = FS.discover_episodes(spark, [str(tree)])
    assert [r[0][-12:] for r in found.collect()] == [f"episode_000{i}" for i in (1, 2, 3, 4)]
    assert all("/." in r[0] for r in hidden.collect())
    got = {r.episode_path[-1]: r for r in FS.read_metadata(spark, [str(tree)]).collect()}
    assert {k: r.error for k, r in got.items()} == {"1": None, "2": "not_an_object", "3": "invalid_json", "4": "missing"}
    assert got["1"].document.duration_seconds == 6.5 and got["1"].document.quality.labels == ["ok"]


def test_streams(spark, tree):
    cells = {(r.row_idx, r.column): r.value for r in FS.read_streams(spark, [str(tree)]).collect()}
    assert cells[0, "left_x"] == 0.25 and cells[1, "left_x"] is None and cells[2, "left_x"] is None
    assert np.isnan(cells[3, "left_x"]) and cells[3, "timestamp_ms"] == 4.5


def test_lists_and_references(spark, tmp_path):
    (tmp_path / "l.txt").write_text("# no\n\n /a/episode_1 \n")
    assert [r[0] for r in FS.episode_list(spark, str(tmp_path / "l.txt")).collect()] == ["/a/episode_1"]
    (tmp_path / "r.json").write_text('[{"task": "t", "device": "umi"}, {"task": "", "device": "x"}]')
    (tmp_path / "r.csv").write_text("task,device\nt,umi\n")
    for name in ("r.json", "r.csv"):
        assert [tuple(r) for r in FS.device_reference(spark, str(tmp_path / name)).collect()] == [("t", "umi")]


def test_manifests(spark, tree):
    e = str(tree / "t/20260101/ann/episode_0001")
    good = {"metadata.json": "0" * 32, "gone.csv": "1" * 64}
    rows = [(e, json.dumps(good)), ("/x/episode_2", '{"../up": "' + "0" * 32 + '"}'), ("/x/episode_3", "no"), ("/x/episode_4", '{"a": "zz"}')]
    manifests = spark.createDataFrame(rows, "episode_path string, raw string")
    got = sorted((r.episode_path[-1], r.check_name[18:]) for r in FS.manifest_findings(FS.listing(spark, [str(tree)]), manifests).collect())
    assert got == [("1", "file_missing"), ("2", "invalid"), ("3", "invalid"), ("4", "invalid")]
    assert [r.path[-13:] for r in FS.hash_mismatches(spark, manifests.limit(1), [str(tree)]).collect()] == ["metadata.json"]


def test_video_numbers(spark):
    def decode(content):
        if content == b"bad":
            raise ValueError
        level = content[0]
        return 30.0, [(i, np.full((8, 8, 3), level, "uint8")) for i in range(4)]

    videos = spark.createDataFrame([("black", bytearray([0])), ("gray", bytearray([120])), ("broken", bytearray(b"bad"))], "path string, content binary")
    found = {(r.path, r.check_name) for r in FS.video_findings(FS.frame_stats(videos, decode), config.DEFAULTS["phase4"]).collect()}
    assert ("black", "video_black_frames") in found and ("gray", "video_frozen") in found and ("broken", "video_not_openable") in found
    assert ("gray", "video_black_frames") not in found


def test_config():
    assert config.merged({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}}) == {"a": {"b": 3, "c": 2}}
    assert config.lookup(config.load(), "phase3.drop_run_fail") == 25 and config.lookup({}, "a.b", 7) == 7


def test_store(spark, tmp_path):
    store = S.Store(spark, str(tmp_path / "s"))
    df = lambda rows: spark.createDataFrame(rows, "k string, p int, v int")
    store.upsert("t", df([("a", 0, 1), ("b", 1, 1), ("b", 1, 2)]), ["k"], "v")
    store.upsert("t", df([("a", 1, 5)]), ["k"], "v")
    assert sorted(map(tuple, store.read("t").collect())) == [("a", 1, 5), ("b", 1, 2)]
    store.replace("t", df([]), df([("a", 1, 0)]), ["k", "p"])
    assert [r.k for r in store.read("t").collect()] == ["b"]
    store.upsert("t", df([("c", 0, 1), ("d", 2, 1)]), ["k"], "v")
    store.prune("t", df([("d", 0, 0)]), "k", always="p = 0")
    assert sorted(r.k for r in store.read("t").collect()) == ["c", "d"]


def test_jobs_and_ingest(spark, tmp_path):
    store, at = S.Store(spark, str(tmp_path / "s")), datetime(2026, 1, 1)
    folder = tmp_path / "in"
    folder.mkdir()

    def send(name, *events):
        rows = [{"event": "v", "version": 1, "event_id": i, "try_count": 0, "payload": json.dumps(p), "received_at": (at + timedelta(seconds=n)).isoformat()} for n, (i, p) in enumerate(events)]
        (folder / name).write_text("\n".join(map(json.dumps, rows)))

    send("1.json", ("e1", {"path": "/nas/a"}), ("e1", {"path": "/nas/a"}), ("e2", {"verified_paths": ["/nas/b", "/nas/../etc"]}), ("e3", {}), ("e4", {"path": "/tmp/x"}))
    run = lambda: J.ingest(J.event_stream(spark, str(folder)), store, str(tmp_path / "c"), "/nas/").awaitTermination()
    run()
    jobs = {r.mounted_path: r for r in store.read("jobs").collect()}
    assert set(jobs) == {"/nas/a", "/nas/b"} and jobs["/nas/a"].status == "pending"
    step = lambda o, n: S.transition(store, spark.createDataFrame([("/nas/a", o, None, at + timedelta(hours=n))], "mounted_path string, outcome string, error string, at timestamp"), retries=2)
    for n, (outcome, want, tries) in enumerate([("started", "running", 1), ("failed", "retry", 1), ("done", "retry", 1), ("started", "running", 2), ("failed", "failed", 2)]):
        step(outcome, n)
        job = store.read("jobs").filter("mounted_path = '/nas/a'").first()
        assert (job.status, job.attempts) == (want, tries)
    send("2.json", ("e9", {"path": "/nas/a", "record_id": "new"}))
    run()
    job = store.read("jobs").filter("mounted_path = '/nas/a'").first()
    assert job.status == "failed" and "new" in job.payload_json and store.read("jobs").count() == 2


@pytest.mark.parametrize(
    "bad,want",
    [
        ([*range(1, 6)], [(1, 5)]),
        ([*range(9, 32)], [(9, 31)]),
        ([*range(1, 6), *range(9, 14)], [(1, 5), (9, 13)]),
        ([1, 2, 3, 5, 6, 7], []),
        ([1, 2, 3], []),
        ([*range(1, 5), *range(6, 11)], [(6, 10)]),
    ],
)
def test_streaks(spark, bad, want):
    df = spark.createDataFrame([("t", n) for n in bad + bad[:1]], "task string, number int")
    assert sorted((r.episode_start, r.episode_end) for r in bad_streaks(df, ["task"]).collect()) == want


def test_streak_history(spark):
    h = "task string, robot string, operator string, episode_start int, episode_end int, resolved boolean"
    d = h.rsplit(",", 1)[0]
    merge = lambda old, new: sorted((r.episode_start, r.episode_end, r.resolved) for r in J.merge_streaks(spark.createDataFrame([("t", "r", None, *x) for x in old], h), spark.createDataFrame([("t", "r", None, *x) for x in new], d)).collect())
    assert merge([(1, 5, True)], [(1, 5)]) == [(1, 5, True)]
    assert merge([(1, 5, True)], [(1, 5), (9, 31)]) == [(1, 5, True), (9, 31, False)]
    assert merge([(9, 13, True)], [(9, 31)]) == [(9, 13, True), (14, 31, False)]
    assert merge([(9, 13, False)], [(9, 31)]) == [(9, 31, False)]
    assert merge([], [(1, 3)]) == []


def test_streaming_states(spark, tmp_path):
    def stream(rows, schema, build, mode):
        folder = tmp_path / f"{build.__name__}"
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(str(folder))
        out = build(spark.readStream.schema(schema).parquet(str(folder)))
        name = f"q{abs(hash(build.__name__))}"
        query = out.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / f"c{build.__name__}")).start()
        # A processing-time timeout keeps a query busy for ever, so it is given some seconds.
        until = time.time() + 40
        while not spark.table(name).count() and time.time() < until:
            query.awaitTermination(1)
        query.stop()
        return sorted(map(tuple, spark.table(name).collect()))

    results = [("t", "r", "o", n, n != 7) for n in range(1, 14)]
    got = stream(results, "task string, robot string, operator string, number int, bad boolean", J.streak_alerts, "append")
    assert got == [("t", "r", "o", 8, 13, 6)]
    snaps = [("a", 1, 10, 5, 1), ("a", 1, 10, 5, 2), ("b", 1, 10, 5, 1), ("b", 2, 20, 6, 2)]
    assert stream(snaps, "path string, files long, bytes long, newest long, at long", J.stable_paths, "append") == [("a", "stable")]


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([(1, "e", 2, "x|y", '{"a": 1}'), (2, "d", 1, None, "no json")], "id long, episode_path string, phase int, check_name string, details string")
    assert "| 1 | e | 2 | x\\|y |" in RP.markdown("T", {"S": df})
    RP.write_jsonl(df, str(tmp_path / "j"))
    lines = [json.loads(r[0]) for r in spark.read.text(str(tmp_path / "j")).collect()]
    assert {x["id"]: x["details"] for x in lines}[1] == {"a": 1}
    RP.write_sheets({"one": df}, str(tmp_path / "w"))
    assert spark.read.csv(str(tmp_path / "w/one"), header=True).count() == 2
    assert json.loads(RP.dashboard({"f": df}))["f"][0]["id"] == 1
    with pytest.raises(ValueError):
        RP.bounded(df, 1)
    plan = spark.createDataFrame([(1.5, "a")], "x double, y string")
    assert RP.plan_text(plan).first().x == "1.500000"


def test_retention(spark):
    at = datetime(2026, 1, 31, 12)
    rows = [(f"f{i}", 10, at - timedelta(days=i)) for i in range(40)]
    df = spark.createDataFrame(rows, "path string, length long, modified timestamp")
    got = {r.path: r.reason for r in S.retention(df, days=30, count=10, size=70).collect()}
    assert [got[f"f{i}"] for i in (0, 6, 7, 10, 31)] == ["keep", "keep", "size", "count", "age"]


def test_expressions(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    lit = F.lit
    assert one(X.first_present(lit(None).cast("string"), lit(""), lit("x"))) == "x"
    assert [one(X.number(lit(t))) for t in (" 1.5 ", "1d", "1e3", "", "x")] == [1.5, None, 1000.0, None, None]
    assert one(X.duration_text(lit(3661.5))) == "1:01:02" and one(X.duration_text(lit(2.5))) == "0:00:02"
    assert one(X.short_number(lit(1.5))) == "1.5" and one(X.short_number(lit(2.0))) == "2"
    assert one(X.redact(lit('{"a": {"api_token": "s\\"x"}, "n": 1, "Password": 12}'))) == '{"a": {"api_token": "***"}, "n": 1, "Password": "***"}'
    for values, want in (([1.0], 0.0), ([1.0, 3.0], 2.0), ([1.0, 2.0, 9.0], 8.0), ([1.0, 2.0, 3.0, 4.0], 2.0), ([1.0, 2.0, 3.0, 4.0, 5.0], 3.0)):
        assert one(X.tukey_iqr(F.array(*map(lit, values)))) == want
    assert one(X.evidence(lit('{"violation_ratio": 0.2, "threshold": 3}'))) == "ratio=20.0%" and one(X.evidence(lit("broken"))) == "" and one(X.device_category(lit("fold_UMI"), lit(None).cast("string"))) == "umi"
    assert one(X.error_ratio(lit(9.0), lit(10.0))) == pytest.approx(0.1) and one(X.error_ratio(lit(9.0), lit(0.0))) == 0
