"""All models over two raw tables, lazily or as tables."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import cached_property

from pyspark.sql import DataFrame

from arenalake.config import DEFAULTS, Settings
from arenalake.plans import core, marts, staging
from arenalake.sources.sinks import save_model


@dataclass(frozen=True)
class Models:
    """Each attribute is a lazy DataFrame; nothing runs before an action.

    Marts read ``match_fact`` and ``player_rows``; ``with_core`` puts stored tables below them.
    """

    raw_matches: DataFrame
    raw_hero_stats: DataFrame
    settings: Settings = field(default=DEFAULTS)
    stored_heroes: DataFrame | None = None
    stored_matches: DataFrame | None = None
    stored_players: DataFrame | None = None

    @cached_property
    def stg_matches(self) -> DataFrame:
        return staging.stg_matches(self.raw_matches)

    @cached_property
    def stg_hero_stats(self) -> DataFrame:
        return staging.stg_hero_stats(self.raw_hero_stats)

    @cached_property
    def dim_heroes(self) -> DataFrame:
        if self.stored_heroes is not None:
            return self.stored_heroes
        return core.dim_heroes(self.stg_hero_stats)

    @cached_property
    def fct_match(self) -> DataFrame:
        if self.stored_matches is not None:
            return self.stored_matches
        return core.fct_match(self.stg_matches, self.settings)

    @cached_property
    def fct_player_match(self) -> DataFrame:
        if self.stored_players is not None:
            return self.stored_players
        return core.fct_player_match(self.raw_matches, self.settings)

    def match_fact(self, *columns: str) -> DataFrame:
        """The match fact for a consumer of a few attributes.

        Without a stored fact, only these payload keys are read, ranked and shuffled.
        """
        if self.stored_matches is not None:
            return self.stored_matches
        keys = ("match_id", "source_stream", "recency_window")
        narrow = self.stg_matches.select(*keys, *columns, "loaded_at")
        return core.fct_match(narrow, self.settings)

    def player_rows(
        self, *columns: str, matches: DataFrame | None = None, own_window: bool = False
    ) -> DataFrame:
        """Player columns with window and start time of their match, target windows only.

        From the stored facts, or from the raw table with only these keys of the players read: a
        cast to an array of structs is not pruned by itself.
        """
        matches = self.match_fact("start_time") if matches is None else matches
        if self.stored_players is None:
            return marts.player_rows_from_raw(
                self.raw_matches, matches, columns, own_window=own_window, settings=self.settings
            )
        players = self.stored_players
        if own_window:
            players = marts.in_target_windows(players, self.settings)
        return marts.player_match_rows(players, matches, columns, self.settings)

    @cached_property
    def mart_liveops_summary(self) -> DataFrame:
        matches = self.match_fact(
            "start_time", "duration_seconds", "radiant_win", "patch", "league_id"
        )
        rows = self.player_rows("account_id", "hero_id", matches=matches, own_window=True)
        return marts.mart_liveops_summary(rows, matches, self.settings)

    @cached_property
    def mart_hero_meta_shift(self) -> DataFrame:
        rows = self.player_rows("hero_id", "win")
        return marts.mart_hero_meta_shift(rows, self.dim_heroes, self.settings)

    @cached_property
    def mart_returning_player_proxy(self) -> DataFrame:
        rows = self.player_rows("account_id")
        return marts.mart_returning_player_proxy(rows, self.settings)

    def named(self) -> dict[str, DataFrame]:
        names = (
            "stg_matches",
            "stg_hero_stats",
            "dim_heroes",
            "fct_match",
            "fct_player_match",
            "mart_liveops_summary",
            "mart_hero_meta_shift",
            "mart_returning_player_proxy",
        )
        return {name: getattr(self, name) for name in names}

    def register_views(self) -> None:
        """Every model as a lazy temp view for ``spark.sql``."""
        for name, model in self.named().items():
            model.createOrReplaceTempView(name)

    def with_core(
        self, dim_heroes: DataFrame, fct_match: DataFrame, fct_player_match: DataFrame
    ) -> Models:
        """The same models on top of a stored dimension and stored facts."""
        return replace(
            self,
            stored_heroes=dim_heroes,
            stored_matches=fct_match,
            stored_players=fct_player_match,
        )

    def materialize_core(self, schema: str, buckets: int = 200) -> Models:
        """Save dimension and facts as tables and return models that read them.

        Both facts are bucketed by match, so the marts join them without a shuffle, and
        partitioned by window.
        """
        self.raw_matches.sparkSession.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
        by_match = {
            "bucket_by": "match_id",
            "buckets": buckets,
            "partition_by": "recency_window",
        }
        return self.with_core(
            save_model(self.dim_heroes, f"{schema}.dim_heroes"),
            save_model(self.fct_match, f"{schema}.fct_match", **by_match),
            save_model(self.fct_player_match, f"{schema}.fct_player_match", **by_match),
        )
