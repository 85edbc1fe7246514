"""Event time: epoch seconds to timestamps and window labels."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, functions as F

from arenalake.config import DEFAULTS, Settings


def recency_window(epoch: Column, settings: Settings = DEFAULTS) -> Column:
    """Label of the window that holds ``epoch``; the outside label also covers null."""
    label = F.lit(settings.outside_label)
    for window in reversed(settings.windows):
        inside = epoch >= window.start
        if window.end is not None:
            inside = inside & (epoch <= window.end)
        label = F.when(inside, window.label).otherwise(label)
    return label


def calendar_window(epoch: Column, settings: Settings = DEFAULTS) -> Column:
    """Same labels from the calendar year alone: the latest window that starts in the year or before."""
    year = F.year(epoch_to_ntz(epoch))
    label = F.lit(settings.outside_label)
    for window in sorted(settings.windows, key=lambda w: w.start):
        first_year = datetime.fromtimestamp(window.start, UTC).year
        label = F.when(year >= first_year, window.label).otherwise(label)
    return label


def is_target_window(label: Column, settings: Settings = DEFAULTS) -> Column:
    return label.isin(settings.labels)


def epoch_to_ntz(epoch: Column) -> Column:
    """Epoch seconds as a zoneless UTC timestamp, whatever the session time zone is."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return origin + F.make_dt_interval(secs=epoch.cast("decimal(18,6)"))


def window_start(label: Column, settings: Settings = DEFAULTS) -> Column:
    """Zoneless start of the window with this label; null for any other label."""
    start = F.lit(None).cast("timestamp_ntz")
    for window in settings.windows:
        start = F.when(label == window.label, epoch_to_ntz(F.lit(window.start))).otherwise(start)
    return start
