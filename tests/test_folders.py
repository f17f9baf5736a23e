"""Phase 1 on episode folders written for the test."""

import hashlib
import json

from tallyrig.checks import folders
from tallyrig.sources import files as FS

GOOD = {
    "task_key": "fold", "episode_index": 0, "duration_seconds": 9.5, "total_frames": 285, "fps_config": 30, "robot": "ur", "quality": {"labels": ["完全正常", "b"]},
    "modalities": {"observation.image.wrist_view": {"type": "image"}, "actions": {"type": "csv"}, "observation.image.flow_a": {}, "observation.sound": {}},
}


def tree(tmp_path):
    def put(name, text):
        path = tmp_path / "task" / "20260101" / "op" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
        return str(path)

    put("episode_1/metadata.json", json.dumps(GOOD))
    put("episode_1/observation.image.wrist_view/video.mp4", "x")
    put("episode_1/observation.image.wrist_view/timestamps.csv", "")
    put("episode_1/action.eef_pose/data.csv", "a\n1\n")
    put("episode_2/metadata.json", json.dumps({"task_key": "", "fps_actual": 0, "total_frames": 3, "quality": {"labels": ["b", "a"]}, "modalities": {"observation.state.joint": {}}}))
    put("episode_3/metadata.json", "{broken")
    put(".hidden/episode_9/metadata.json", "{}")
    (tmp_path / "task" / "20260101" / "op" / "episode_4").mkdir()
    return str(tmp_path / "task" / "20260101" / "op")


def test_findings_of_folders(spark, tmp_path):
    root = tree(tmp_path)
    found, skipped = FS.discover_episodes(spark, [root])
    assert [r.episode_path[-1] for r in found.collect()] == ["1", "2", "3", "4"]  # an empty folder too
    assert [r.check_name for r in folders.hidden_findings(skipped).collect()] == ["hidden_directory_skipped"]
    metadata, entries = FS.read_metadata(spark, [root]), FS.entries(spark, [root])
    short = lambda df: {(r.episode_path[-1], r.check_name, r.subject) for r in df.collect()}
    assert short(folders.document_findings(metadata)) == {
        *(("2", "required_metadata_field", f) for f in ("task_key", "episode_index", "duration_seconds", "fps_actual_or_fps_config")),
        ("3", "metadata_valid_json", "invalid_json"), ("4", "metadata_exists", None),
    }
    view = "observation.image.wrist_view"
    assert short(folders.modality_findings(metadata, entries)) == {
        ("1", "required_modality_file_empty", f"{view}/timestamps.csv"), ("1", "action_modality_singular_name", "action.eef_pose"),
        ("1", "unknown_modality_detected", "observation.sound"), ("2", "modality_folder_missing", "observation.state.joint"),
    }
    assert [r.episode_path[-1] for r in folders.with_label(metadata).collect()] == ["1"]
    assert {(r.labels, r.episodes) for r in folders.label_skips(metadata).collect()} == {("a+b", 1), ("(none)", 2)}
    counts = {r.episode_path[-1]: tuple(r)[1:] for r in folders.modality_metrics(metadata, entries).collect()}
    assert counts["1"] == (5, 1, 2, 1) and counts["2"] == (1, 0, 1, 0)


def test_only_listed_files_are_hashed(spark, tmp_path):
    root = tree(tmp_path)
    episode = f"{root}/episode_1"
    right = hashlib.sha256(b"x").hexdigest()
    lines = {"observation.image.wrist_view/video.mp4": right, "action.eef_pose/data.csv": "0" * 32, "absent.csv": "1" * 32, "action.eef_pose": "2" * 32}
    manifests = spark.createDataFrame([(episode, json.dumps(lines))], "episode_path string, raw string")
    wrong = {(r.path[len(episode) + 1 :], r.actual is None) for r in FS.hash_mismatches(spark, manifests, [root]).collect()}
    assert wrong == {("action.eef_pose/data.csv", False), ("action.eef_pose", True)}
