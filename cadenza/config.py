"""Parameters of the operators, with their defaults."""

from dataclasses import dataclass


@dataclass(frozen=True)
class ContactConfig:
    on_t: float = 0.09  # torso lengths a second
    off_t: float = 0.45
    on_frames: int = 4
    off_frames: int = 3
    speed_reach: int = 5


@dataclass(frozen=True)
class EpisodeConfig:
    """Break and renewed contact of a limb."""

    pre: int
    pre_on: int  # of ``pre`` frames before the break
    land: int
    land_on: int  # of ``land`` frames from the landing
    gap_s: float = 4.0
    least_s: float = 0.25


TRANSFER = EpisodeConfig(pre=8, pre_on=6, land=5, land_on=4)
TECHNIQUE = EpisodeConfig(pre=6, pre_on=5, land=4, land_on=3)


@dataclass(frozen=True)
class PoseConfig:
    min_conf: float = 0.30
    smooth_window: int = 9
    climb_rise: float = 0.6
    climb_quantile: float = 0.9
    track_reach: float = 250.0


@dataclass(frozen=True)
class ScheduleConfig:
    cap: int = 60
    min_cap_dur: float = 0.5
    hand_off: float = 1.65
    longest: float = 5.0
    title_end: float = 4.6


@dataclass(frozen=True)
class SegmentConfig:
    max_w: float = 20.0
    gap_s: float = 0.9
    dur_max: float = 7.0
    sentence_gap: float = 0.55


@dataclass(frozen=True)
class CorrectionConfig:
    min_ratio: float = 0.8
    min_length: float = 0.8
    min_kept: float = 0.75
    max_cps: float = 12.0


@dataclass(frozen=True)
class GateConfig:
    min_detect: float = 0.75
    min_com: float = 0.85
    w: float | None = None
    h: float | None = None
    edge: float = 5.0
