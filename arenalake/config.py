"""Parameters of the pipeline. Everything a deployment may want to change is a field here."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from decimal import Decimal


@dataclass(frozen=True)
class Window:
    """A labelled span of event time, in epoch seconds, closed at both ends."""

    label: str
    start: int
    end: int | None  # None: open-ended


# Window labels and bounds (UTC), stream names, thresholds, quotas, size bound.
WINDOWS = (
    Window("2023_2024", 1672531200, 1735689599),
    Window("2025_2026", 1735689600, None),
)
OUTSIDE_LABEL = "outside_target_windows"
STREAMS_BY_PREFERENCE = ("pro_matches", "public_matches")
UNKNOWN_STREAM = "unknown"
STABLE_BELOW = Decimal("0.01")
VOLATILE_FROM = Decimal("0.03")
DIRE_FROM_SLOT = 128
MAX_RESOURCE_BYTES = 250 * 1024 * 1024


@dataclass(frozen=True)
class Settings:
    windows: tuple[Window, ...] = WINDOWS
    outside_label: str = OUTSIDE_LABEL
    previous_window: str = "2023_2024"
    current_window: str = "2025_2026"
    streams: tuple[str, ...] = STREAMS_BY_PREFERENCE
    unknown_stream: str = UNKNOWN_STREAM
    stable_below: Decimal = STABLE_BELOW
    volatile_from: Decimal = VOLATILE_FROM
    dire_from_slot: int = DIRE_FROM_SLOT
    max_resource_bytes: int = MAX_RESOURCE_BYTES
    quotas: Mapping[str, int] = field(
        default_factory=lambda: {"2023_2024": 300, "2025_2026": 300}
    )
    # The newest window is filled first.
    fill_order: tuple[str, ...] = ("2025_2026", "2023_2024")

    @property
    def labels(self) -> list[str]:
        return [w.label for w in self.windows]


DEFAULTS = Settings()
