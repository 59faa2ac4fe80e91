from __future__ import annotations

import json

import pytest

from tests.test_sources import folder, log  # noqa: F401
from trackloom import cli
from trackloom.config import Config


def test_commands(spark, folder, tmp_path, capsys):  # noqa: F811
    cfg = tmp_path / "config.json"
    assert cli.main(["init-config", str(cfg)]) == 0 and Config.from_json(cfg.read_text()) == Config()
    cfg.write_text(Config(team_size=2, min_sequence_frames=5).to_json())
    team = ["--config", str(cfg), "--team-name", "Us"]
    assert cli.main(["audit", str(folder / "2024.game.log"), *team]) == 0
    row = json.loads(capsys.readouterr().out.splitlines()[0])
    assert row["tracker_frames_seen"] == 240 and row["duplicate_frames"] == 120 and row["total_messages"] == 243 and row["notes"][0] == "dropped 120 duplicate tracker frames"
    assert row["target_team_resolved"] == "Us"
    (folder / "bad.log").write_bytes(b"no")
    (folder / "none.log").write_bytes(log([]))
    with pytest.raises(SystemExit, match="no team has the name Nobody"):
        cli.main(["audit", str(folder / "2024.game.log"), "--config", str(cfg), "--team-name", "Nobody"])
    with pytest.raises(SystemExit, match="no tracker frames"):
        cli.main(["preprocess", str(folder / "none.log"), "--output", str(tmp_path / "x"), *team])
    out = str(tmp_path / "out")
    assert cli.main(["auto", str(folder), "--output", out, "--min-quality", "0.1", "--verbose", *team]) == 0
    said = capsys.readouterr().out.splitlines()
    assert {x.split("/")[-1].split(":")[0] for x in said if x.startswith("skipped")} == {"bad.log", "none.log", "2023.b.log.gz"}
    report = json.loads(said[-1])
    assert report["games"] == 1 and set(report["seconds"]) == {"check", "run"}
    game = spark.read.parquet(f"{out}/games").collect()
    assert [(g["game_id"], g["year"], g["phase"], g["target_team"], g["opponent_team"], g["target_score"], g["opponent_score"], g["tracker_source"]) for g in game] == [("2024_game_log", 2024, "Elimination", "Us", "Them", 3, 1, "src")]
    assert game[0]["source_log"].endswith("2024.game.log") and abs(game[0]["duration_s"] - 119 * 0.03) < 1e-6 and abs(game[0]["sample_rate_hz"] - 1 / 0.03) < 1e-3
    assert cli.main(["samples", out]) == 0
