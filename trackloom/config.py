"""Configuration of the pipelines, with the reference semantics as defaults."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, fields, is_dataclass


@dataclass(frozen=True)
class WindowConfig:
    length: int = 16
    stride: int = 2


@dataclass(frozen=True)
class AugmentConfig:
    mirror_y: bool = True
    mirror_x: bool = False
    noise_m: float = 0.01
    stretch_factors: tuple[float, ...] = ()
    occupancy_grid: bool = False
    seed: int = 17


@dataclass(frozen=True)
class SplitConfig:
    train: float = 0.7
    validation: float = 0.15
    test: float = 0.15
    elimination_weight: float = 1.5


@dataclass(frozen=True)
class IdentityConfig:
    max_match_distance_m: float = 0.9
    max_unmatched_frames: int = 8
    jump_penalty_m: float = 1.2


@dataclass(frozen=True)
class LiveConfig:
    commands: tuple[int, ...] = (2, 3)
    ball_speed_m_s: float = 0.05
    robot_speed_m_s: float = 0.05


@dataclass(frozen=True)
class CleanConfig:
    min_visibility: float = 0.5
    min_target_robots: int = 3
    min_opponent_robots: int = 2
    min_quality: float = 0.55
    teleport_m: float = 0.5
    smooth: bool = True
    smoothing_window: int = 3
    drop_duplicate_timestamps: bool = True
    spike_m: float = 6.0
    min_ball_visibility: float = 0.3


@dataclass(frozen=True)
class Config:
    target_name: str | None = None
    target_color: str = "Blue"
    tracker_source: str | None = None
    half_length_m: float = 4.5
    half_width_m: float = 3.0
    margin_m: float = 0.2
    team_size: int = 6
    max_speed: float = 4.0
    max_acceleration: float = 3.0
    max_angular_speed: float = 12.0
    min_sequence_frames: int = 50
    max_sequence_frames: int = 300
    max_gap_s: float = 0.25
    possession_radius_m: float = 0.6
    carried_ball_frames: int = 3
    grid_width: int = 40
    grid_height: int = 28
    window: WindowConfig = field(default_factory=WindowConfig)
    augment: AugmentConfig = field(default_factory=AugmentConfig)
    split: SplitConfig = field(default_factory=SplitConfig)
    identity: IdentityConfig = field(default_factory=IdentityConfig)
    live: LiveConfig = field(default_factory=LiveConfig)
    clean: CleanConfig = field(default_factory=CleanConfig)
    # Corrected behaviour, each off by default.
    drop_cascades: bool = True  # a dropped sequence drops the game's later ones too
    augment_all_splits: bool = True
    pooled_stats: bool = True  # one mean and deviation for speeds and accelerations together

    @property
    def step_features(self) -> int:
        return 8 + 10 + 4 + 7 + (2 * self.team_size - 1) * 14

    @property
    def sample_features(self) -> int:
        return self.step_features * self.window.length

    def to_json(self) -> str:
        return json.dumps(asdict(self), indent=2)

    @classmethod
    def from_json(cls, text: str) -> Config:
        """Every field must be there, but for those that may be null; an unknown field is an error."""
        return _build(cls, json.loads(text), "config")


def _build(cls: type, data: dict, where: str):
    known = {f.name: f for f in fields(cls)}
    if extra := set(data) - set(known):
        raise ValueError(f"{where}: unknown {sorted(extra)}")
    blank, out = cls(), {}
    for name in known:
        default = getattr(blank, name)
        if name not in data:
            if default is not None:
                raise ValueError(f"{where}: {name} is missing")
            continue
        x = data[name]
        out[name] = _build(type(default), x, name) if is_dataclass(default) else tuple(x) if isinstance(default, tuple) else x
    return cls(**out)
