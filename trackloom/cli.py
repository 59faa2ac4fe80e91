"""Command line: audit, preprocess, auto, samples and init-config, thin over the plans."""

from __future__ import annotations

import argparse
import time
from collections.abc import Sequence
from dataclasses import replace
from pathlib import Path

from pyspark.sql import SparkSession

from .config import Config
from .plans import pipelines
from .scratch import written
from .shipping import ship
from .sources import datasets, logs


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="trackloom")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("audit", "preprocess", "auto"):
        s = sub.add_parser(name)
        s.add_argument("inputs", nargs="+", help="logs, folders or globs")
        s.add_argument("--config")
        s.add_argument("--team-name")
        s.add_argument("--team-color", choices=("Yellow", "Blue"))
        s.add_argument("--tracker-source")
        if name != "audit":
            s.add_argument("--output", required=True)
        if name == "preprocess":
            s.add_argument("--reviews")
        if name == "auto":
            s.add_argument("--min-quality", type=float)
            s.add_argument("--verbose", action="store_true", help="tell each game's frames and samples")
    s = sub.add_parser("samples")
    s.add_argument("dataset")
    s.add_argument("--limit", type=int, default=3)
    sub.add_parser("init-config").add_argument("output")
    return p


def _config(a: argparse.Namespace) -> Config:
    text = Path(a.config).read_text() if a.config else ""
    cfg = datasets.config_with_source(text, a.tracker_source, a.team_name, a.team_color)
    least = getattr(a, "min_quality", None)
    return cfg if least is None else replace(cfg, clean=replace(cfg.clean, min_quality=least))


def main(argv: Sequence[str] | None = None) -> int:
    a = parser().parse_args(argv)
    if a.command == "init-config":
        Path(a.output).write_text(Config().to_json() + "\n")
        return 0
    spark = SparkSession.builder.appName("trackloom").getOrCreate()
    ship(spark)
    if a.command == "samples":
        n, files = datasets.sample_files(spark, a.dataset, a.limit)
        print(n, *files, sep="\n")
        return 0
    cfg = _config(a)
    # The automatic run skips logs that can't be read and tells about them; the others stop.
    began = time.perf_counter()
    log = written(logs.read_logs(spark, *a.inputs, mode="permissive" if a.command == "auto" else "failfast"), "messages")
    logs.check_unique_games(log)
    wrong = pipelines.problems(log, cfg)
    failed = 0
    if a.command == "auto":
        for failed, r in enumerate(wrong.toLocalIterator(), 1):
            print(f"skipped {r['path']}: {r['error']}")
    elif r := wrong.first():
        raise SystemExit(f"{r['path']}: {r['error']}")
    packets = logs.packets(log)
    checked = time.perf_counter()
    if a.command == "audit":
        rows = pipelines.audits(log, cfg)
        for line in rows.toJSON().toLocalIterator():
            print(line)
        return 0
    if packets.isEmpty():
        raise SystemExit("no tracker frames")
    # Decoded once, tracked once: both tables are read several times below.
    frames, games = (written(t, name) for t, name in zip(pipelines.frames_from_logs(packets, logs.referee_messages(log), cfg), ("frames", "games")))
    reviews = datasets.reviews_from_json(spark, a.reviews) if getattr(a, "reviews", None) else None
    out = pipelines.build(frames, games, cfg, reviews, automatic=a.command == "auto")
    told = datasets.write_dataset(
        out.samples, out.splits, None, a.output, games=pipelines.game_table(log, cfg, (frames, games)), sequences=out.sequences, pooled=cfg.pooled_stats
    )
    spark.createDataFrame([(cfg.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{a.output}/config")
    if getattr(a, "verbose", False):
        for r in datasets.read_manifest(spark, a.output).orderBy("game_id").toLocalIterator():
            print(f"{r['game_id']}: {r['samples']} samples for {r['split']}")
    auto = a.command == "auto"
    seconds = {"check": checked - began, "run": time.perf_counter() - checked} if auto else None
    found = {"logs_found": log.select("path").distinct().count(), "failed": failed} if auto else {}
    print(datasets.report(told, games, out.splits, seconds, path=a.output, **found))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
