"""Parameter sets of the location pipeline."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Preset:
    """Window size, watermark bound, per-partition event-time skew and idle
    timeout, all in milliseconds."""
    window_ms: int
    out_of_orderness_ms: int
    skew_ms: int
    idle_timeout_ms: int


# 1 s windows, 250 ms bound, 50 ms skew per partition, 1 s idle
# timeout; DAY scales every one of them by 86,400 to suit the sparse fixture.
REF = Preset(1_000, 250, 50, 1_000)
DAY = Preset(86_400_000, 21_600_000, 4_320_000, 86_400_000)
