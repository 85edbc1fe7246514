"""Bounded backfill: pick new matches from landed pages until each window has its quota.

The rule is sequential: entries are taken in page order, a match once, a window only while it is
below its quota. Distributed, it needs just the entry at which each window fills up. That entry
is the k-th of a window (k is the open quota), found by refining histograms of places, in as many
rounds as there are windows, because a match that is seen under two windows can move to the other
once the first is full.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from arenalake.config import DEFAULTS, Settings
from arenalake.operators.manifest import manifest_rows, page_place
from arenalake.operators.selection import first_per_key
from arenalake.sources.json_files import explode_pages, typed_pages
from arenalake.sources.schemas import MANIFEST_COLUMNS
from arenalake.storage import fresh_path

_NEVER = 2**63 - 1


def page_bounds(pages: DataFrame) -> DataFrame:
    """Per page: entries, smallest id (the next cursor), oldest and newest start. Row-local."""
    ids = F.transform("entries", lambda entry: entry["match_id"].cast("bigint"))
    starts = F.transform("entries", lambda entry: entry["start_time"].cast("bigint"))
    return typed_pages(pages).select(
        "page_no",
        F.coalesce(F.array_size("entries"), F.lit(0)).cast("bigint").alias("entry_count"),
        F.array_min(ids).alias("next_less_than_match_id"),
        F.array_min(starts).alias("oldest_start_time"),
        F.array_max(starts).alias("newest_start_time"),
    )


def selected_index(manifest: DataFrame) -> DataFrame:
    """One row per match; the later row wins where ``seen_at`` tells the order."""
    order = [F.col(c).desc() for c in ("seen_at", "start_time", "source_stream", "recency_window")
             if c in manifest.columns]
    rows = manifest.where(F.col("match_id").isNotNull())
    return first_per_key(rows, ["match_id"], order).select(*MANIFEST_COLUMNS)


def _window_counts(selected: DataFrame, settings: Settings, label: str = "recency_window") -> Column:
    here = F.col(label)
    return F.struct(*[F.count_if(here == label).alias(label) for label in settings.labels])


def selected_counts(selected: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Selected matches per target window, zero included; other labels are ignored."""
    one = selected.agg(_window_counts(selected, settings).alias("counts"))
    spans = [
        F.struct(F.lit(label).alias("recency_window"), F.col("counts")[label].alias("selected_count"))
        for label in settings.labels
    ]
    return one.select(F.inline(F.array(*spans)))


def active_window(counts: Mapping[str, Column], quotas: Mapping[str, int], settings: Settings) -> Column:
    """The first window in fill order that is below its quota; null when all are full."""
    return F.coalesce(
        *[F.when(counts[w] < quotas.get(w, 0), w) for w in settings.fill_order], F.lit(None)
    )


@dataclass(frozen=True)
class Backfill:
    """What a run selects and reports.

    ``selected``: old and new manifest rows. ``added``: new rows. ``read_entries``: entries of the
    pages that were read, repeated ones included, for the raw snapshot. ``progress``: one row.
    """

    selected: DataFrame
    added: DataFrame
    read_entries: DataFrame
    progress: DataFrame


def _stored(rows: DataFrame, name: str) -> DataFrame:
    spark = rows.sparkSession
    path = fresh_path(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _first_pages(pages: DataFrame, max_pages: int | None) -> DataFrame:
    return pages if max_pages is None else pages.orderBy("page_no").limit(max_pages)


def sightings(entries: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row per match: first place and start time under each window."""
    rows = manifest_rows(entries, "pro_matches", settings=settings)
    place = page_place()
    firsts = []
    for label in settings.labels:
        at = F.when(F.col("recency_window") == label, place)
        firsts.append(F.min(at).alias(f"at {label}"))
        firsts.append(F.min_by("start_time", at).alias(f"start {label}"))
    return rows.groupBy("match_id").agg(*firsts)


def joined_sightings(parts: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Sightings of several sets of pages as one."""
    firsts = []
    for label in settings.labels:
        at = F.col(f"`at {label}`")
        firsts += [F.min(at).alias(f"at {label}"), F.min_by(F.col(f"`start {label}`"), at).alias(f"start {label}")]
    return parts.groupBy("match_id").agg(*firsts)


def candidates(seen: DataFrame, known: DataFrame, quotas: Mapping[str, int], settings: Settings = DEFAULTS) -> DataFrame:
    """The sightings that can still be selected, whatever pages come later: a bounded number.

    What a run takes under a window has only taken matches before it there, so its rank under the window is at most the sum
    of all quotas. Places of the first so many free matches of each window are kept; more pages only add to the rows
    before a place. Selecting out of what is kept gives the rows of selecting out of all.
    """
    most = sum(max(quotas.get(w, 0), 0) for w in settings.labels)
    free = seen.join(known.select("match_id"), "match_id", "left_anti")
    if most == 0:
        return free.where(F.lit(False))
    places = [F.struct(F.lit(w).alias("label"), F.col(f"`at {w}`").alias("at")) for w in settings.labels]
    last = nth_places(free.select(F.inline(F.array(*places))).where("at IS NOT NULL"), dict.fromkeys(settings.labels, most))
    early = [F.coalesce(F.col(f"`at {w}`") <= last.get(w, _NEVER), F.lit(False)) for w in settings.labels]
    return free.where(reduce(lambda a, b: a | b, early))


def _label_at(settings: Settings) -> Column:
    """The window whose first sighting is at ``at``; places are unique."""
    return F.coalesce(
        *[F.when(F.col("at") == F.col(f"`at {w}`"), w) for w in settings.labels], F.lit(None)
    )


def nth_places(rows: DataFrame, ranks: Mapping[str, int], bins: int = 4096) -> dict[str, int]:
    """For each label, the place ``at`` of its n-th row, counted from 1 in order of places; labels with fewer rows are left out.

    Histograms of the places are refined around the n-th one until its bin holds a single place, so a rank of any size
    needs no sort and no task that holds the rows before it. A round brings ``bins`` counts per label to the driver,
    with the smallest and greatest place of each bin, between which the next round looks.
    """
    place, label = F.col("at"), F.col("label")
    ends = rows.where(label.isin(list(ranks))).groupBy("label").agg(
        F.min("at").alias("low"), F.max("at").alias("high"), F.count("at").alias("n")
    )
    # Where to look, from place to place, and which rank among the rows there.
    spans = {
        r["label"]: (r["low"], r["high"], ranks[r["label"]]) for r in ends.collect() if r["n"] >= ranks[r["label"]]
    }
    found: dict[str, int] = {}
    while spans:
        bin_of, inside = F.lit(None).cast("bigint"), F.lit(False)
        for name, (low, high, _) in spans.items():
            width = -(-(high - low + 1) // bins)
            here = (label == name) & place.between(low, high)
            bin_of = F.when(here, F.expr(f"(at - {low}L) div {width}L")).otherwise(bin_of)
            inside = inside | here
        counts = rows.where(inside).groupBy("label", bin_of.alias("bin")).agg(
            F.count("*").alias("n"), F.min("at").alias("low"), F.max("at").alias("high")
        )
        by_label: dict[str, list] = {}
        for r in counts.collect():
            by_label.setdefault(r["label"], []).append(r)
        finer = {}
        for name, (_, _, n) in spans.items():
            for r in sorted(by_label[name], key=lambda r: r["bin"]):
                if n <= r["n"]:
                    break
                n -= r["n"]
            if r["low"] == r["high"]:
                found[name] = r["low"]
            else:
                finer[name] = (r["low"], r["high"], n)
        spans = finer
    return found


def _take_round(free: DataFrame, left: dict[str, int], settings: Settings):
    """Free matches with the place ``at`` where an open window sees them first, up to the place
    where the next window fills up, and the quotas left after that place.

    Only counts and places come to the driver, one row per window.
    """
    open_windows = [w for w in settings.labels if left[w] > 0]
    at = F.array_min(F.array(*[F.col(f"`at {w}`") for w in open_windows]))
    rows = free.withColumn("at", at).withColumn("label", _label_at(settings))
    reached = nth_places(rows, {w: left[w] for w in open_windows})
    limit = min(reached.values(), default=_NEVER)
    counts = rows.where(F.col("at") <= limit).agg(_window_counts(rows, settings, "label").alias("n"))
    used = counts.first()["n"]
    taken = rows.where(F.col("at") <= limit)
    rest = free.where(~F.coalesce(at <= limit, F.lit(False)))
    return taken, rest, {w: left[w] - used[w] for w in settings.labels}


def _open_quotas(
    known: DataFrame, quotas: Mapping[str, int] | None, settings: Settings
) -> tuple[dict[str, int], dict[str, int]]:
    """The quota of each window, and what the known matches leave of it."""
    full = {w: (settings.quotas if quotas is None else quotas).get(w, 0) for w in settings.labels}
    counts = known.agg(_window_counts(known, settings).alias("counts")).first()["counts"]
    return full, {w: full[w] - counts[w] for w in settings.labels}


@dataclass(frozen=True)
class Choice:
    """New manifest rows, the progress row, the last page that counts, and whether all quotas are met."""

    added: DataFrame
    progress: DataFrame
    until: int
    full: bool


def choose(
    bounds: DataFrame,
    seen: DataFrame,
    known: DataFrame,
    *,
    quotas: Mapping[str, int] | None = None,
    settings: Settings = DEFAULTS,
    cursor: int | None = None,
) -> Choice:
    """Select matches for the open quotas out of the bounds and sightings of a run's pages.

    ``known`` has one row per match that was selected before. Pages count up to the one that fills
    the last quota, up to an empty page, and up to a page without ids.
    """
    quotas, left = _open_quotas(known, quotas, settings)
    ends = (F.col("entry_count") <= 0) | F.col("next_less_than_match_id").isNull()
    stop = bounds.where(ends).agg(F.min("page_no")).first()[0]
    stop = _NEVER if stop is None else stop
    idle = all(n <= 0 for n in left.values())
    last_place = _NEVER if stop >= _NEVER >> 32 else ((stop + 1) << 32) - 1
    in_reach = {
        f"at {w}": F.when(F.col(f"`at {w}`") <= last_place, F.col(f"`at {w}`")) for w in settings.labels
    }
    free = seen.withColumns(in_reach).join(known.select("match_id"), "match_id", "left_anti")
    nothing = free.withColumn("at", F.lit(None).cast("bigint")).where(F.lit(False))
    parts = [nothing.withColumn("label", F.lit(None).cast("string"))]
    for _ in settings.labels:
        if any(n > 0 for n in left.values()):
            taken, free, left = _take_round(free, left, settings)
            parts.append(taken)
    start = F.coalesce(*[F.when(F.col("label") == w, F.col(f"`start {w}`")) for w in settings.labels])
    added = reduce(DataFrame.unionByName, parts).select(
        "match_id",
        start.alias("start_time"),
        F.lit("pro_matches").alias("source_stream"),
        F.col("label").alias("recency_window"),
        F.col("at").alias("place"),
    )
    full = all(n <= 0 for n in left.values())
    until = stop
    if idle:
        until = -1
    elif full:
        until = added.agg(F.shiftright(F.max("place"), 32)).first()[0]
    now_selected = {w: quotas[w] - left[w] for w in settings.labels}
    progress = _progress(bounds, now_selected, quotas, until, full, cursor, settings)
    return Choice(added.drop("place"), progress, until, full)


def plan_backfill(
    pages: DataFrame,
    existing: DataFrame,
    *,
    quotas: Mapping[str, int] | None = None,
    settings: Settings = DEFAULTS,
    max_pages: int | None = None,
    cursor: int | None = None,
) -> Backfill:
    """Select matches for the open quotas out of ``pages`` and report the progress.

    ``existing`` is the manifest so far and ``cursor`` the saved one. Page bounds and sightings are
    written to the shared folder, so stop, rounds and progress do not read the pages again; when
    all quotas are met before, nothing is read or written.
    """
    known = selected_index(existing)
    pages = _first_pages(pages, max_pages)
    bounds, entries = page_bounds(pages), explode_pages(pages)
    seen = sightings(entries, settings)
    _, left = _open_quotas(known, quotas, settings)
    if any(n > 0 for n in left.values()):
        bounds, seen = _stored(bounds, "bounds"), _stored(seen, "sightings")
    else:
        bounds, seen = bounds.limit(0), seen.limit(0)
    chosen = choose(bounds, seen, known, quotas=quotas, settings=settings, cursor=cursor)
    read_entries = entries.where(F.col("page_no") <= chosen.until)
    return Backfill(known.unionByName(chosen.added), chosen.added, read_entries, chosen.progress)


def _progress(
    bounds: DataFrame,
    selected: Mapping[str, int],
    quotas: Mapping[str, int],
    until: int,
    full: bool,
    cursor: int | None,
    settings: Settings,
) -> DataFrame:
    """One row over the pages that were read, those up to ``until``."""
    page, low = F.col("page_no"), F.col("next_less_than_match_id")
    oldest, newest = F.col("oldest_start_time"), F.col("newest_start_time")
    # The cursor moves past a page only while a quota is open after it.
    passed = low.isNotNull() & ((page < until) if full else F.lit(True))
    lost = F.coalesce(F.bool_or(low.isNull() & (F.col("entry_count") > 0)), F.lit(False))
    read = bounds.where(page <= until).agg(
        F.count("*").alias("request_count"),
        F.max_by(oldest, F.when(oldest.isNotNull(), page)).alias("oldest_page_start_time"),
        F.min_by(newest, F.when(newest.isNotNull(), page)).alias("newest_page_start_time"),
        F.coalesce(F.max_by(low, F.when(passed, page)), F.lit(cursor).cast("bigint")).alias("next"),
        lost.alias("lost"),
    )
    counts = {w: F.lit(selected[w]).cast("bigint") for w in settings.labels}
    targets = {w: F.lit(quotas[w]).cast("bigint") for w in settings.labels}
    return read.select(
        _as_map(counts).alias("selected_counts_by_window"),
        _as_map(targets).alias("target_counts_by_window"),
        active_window(counts, quotas, settings).alias("active_backfill_window"),
        # A page without ids ends the paging and leaves no cursor.
        F.when(~F.col("lost") | F.lit(full), F.col("next")).alias("next_less_than_match_id"),
        "request_count",
        "oldest_page_start_time",
        "newest_page_start_time",
        F.lit(full).alias("completed_all_targets"),
    )


def _as_map(values: Mapping[str, Column]) -> Column:
    return F.create_map(*[part for w, value in values.items() for part in (F.lit(w), value)])


def backfill_order(selected: DataFrame) -> DataFrame:
    """Manifest order of a backfill: by window, newest first."""
    return selected.orderBy(
        F.col("recency_window").asc_nulls_last(), F.col("start_time").desc(), F.col("match_id").asc()
    )
