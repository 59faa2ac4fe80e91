"""Identity tracking across frames: the one sequential operator.

Frames of a game are sorted on disk where need be and streamed through a small state machine,
so a task holds one batch and the tracks of one game, not a game.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..config import Config, IdentityConfig
from ..schemas import ROBOT
from .matching import UNIT, cheapest


@dataclass
class Track:
    stable_id: int
    state: dict
    role: str = "Unknown"
    missing: int = 0


@dataclass
class Tracker:
    next_id: int = 0
    tracks: list[Track] = field(default_factory=list)


def motion_cost(a: dict, b: dict) -> float:
    return math.hypot(a["x"] - b["x"], a["y"] - b["y"]) + 0.05 * abs(a["theta"] - b["theta"])


def assign(tracks: list[Track], seen: list[dict], gate: float, penalty: float) -> list[tuple[int, int]]:
    """The cheapest matching of tracks to observations, as (track, observation) pairs.

    A track without a match costs ``penalty``; matches above ``gate`` are not allowed.  Among
    equal costs the first in depth-first order wins, where leaving a track unmatched comes
    before its observations in order.  Costs are equal when they are so to a billionth of a metre.
    """
    costs = [{o: round(c * UNIT) for o, b in enumerate(seen) if (c := motion_cost(t.state, b)) <= gate} for t in tracks]
    return [(t, o) for t, o in enumerate(cheapest(costs, round(penalty * UNIT))) if o is not None]


def label_roles(tracks: list[Track]) -> None:
    """By order: the smallest x keeps the goal; then up to the third, the fifth and the rest."""
    keeper = min(range(len(tracks)), key=lambda k: tracks[k].state["x"], default=None)
    for k, t in enumerate(tracks):
        t.role = "Goalkeeper" if k == keeper else "Defender" if k <= 2 else "Midfielder" if k <= 4 else "Forward"
        t.state = {**t.state, "role": t.role}


def advance(tracker: Tracker, seen: list[dict], size: int, cfg: IdentityConfig) -> tuple[list[dict | None], bool]:
    """Take one frame's observations of a team: its slots, and whether a track changed its raw id."""

    def spawn(observed: dict) -> None:
        tracker.tracks.append(Track(tracker.next_id, {**observed, "stable_id": tracker.next_id}))
        tracker.next_id += 1

    swapped = False
    if not tracker.tracks:
        for observed in seen[:size]:
            spawn(observed)
    else:
        matched = assign(tracker.tracks, seen, cfg.max_match_distance_m, cfg.jump_penalty_m)
        hit = dict(matched)
        for k, t in enumerate(tracker.tracks):
            if k in hit:
                old, new = t.state["raw_id"], seen[hit[k]]["raw_id"]
                swapped |= old is not None and new is not None and old != new
                t.state, t.missing = {**seen[hit[k]], "stable_id": t.stable_id}, 0
            else:
                t.missing += 1
        tracker.tracks = [t for t in tracker.tracks if t.missing <= cfg.max_unmatched_frames]
        taken = set(hit.values())
        for o, observed in enumerate(seen):
            if o not in taken:
                spawn(observed)
        tracker.tracks.sort(key=lambda t: t.state["x"])
    label_roles(tracker.tracks)
    slots: list[dict | None] = [t.state for t in tracker.tracks[:size]]
    return slots + [None] * (size - len(slots)), swapped


def track(raw: DataFrame, cfg: Config) -> DataFrame:
    """Replace ``yellow`` and ``blue`` observations by slots of ``team_size``; add ``yellow_swap`` and ``blue_swap``.

    Null observations and null team lists are no observations.
    """
    sides = ("yellow", "blue")
    keep = [c for c in raw.columns if c not in (*sides, "yellow_swap", "blue_swap")]
    typed = raw.select(*keep, *[F.col(s).cast(f"array<{ROBOT}>") for s in sides])
    out_schema = typed.withColumns({f"{s}_swap": F.lit(False) for s in sides}).schema
    arrow = to_arrow_schema(out_schema)
    game = keep.index("game_id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, trackers = object(), {}
        for b in batches:
            teams = {s: b.column(len(keep) + k).to_pylist() for k, s in enumerate(sides)}
            slots: dict[str, list] = {s: [] for s in sides}
            swaps: dict[str, list] = {s: [] for s in sides}
            for k, g in enumerate(b.column(game).to_pylist()):
                if g != now:
                    now, trackers = g, {s: Tracker() for s in sides}
                for s in sides:
                    found, swapped = advance(trackers[s], [r for r in teams[s][k] or [] if r], cfg.team_size, cfg.identity)
                    slots[s].append(found)
                    swaps[s].append(swapped)
            columns = [pa.array(slots[s], arrow.field(s).type) for s in sides] + [pa.array(swaps[s], pa.bool_()) for s in sides]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], *columns], names=arrow.names)

    return typed.repartition("game_id").sortWithinPartitions("game_id", "frame_pos").mapInArrow(work, out_schema)
