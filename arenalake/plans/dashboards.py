"""Datasets behind the dashboard sheets, built from the marts only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from arenalake.functions.rules import action_focus, recommended_action
from arenalake.operators.ranking import global_rank


def _only(rows: DataFrame, column: str, values: Sequence[str] | None) -> DataFrame:
    return rows if values is None else rows.where(F.col(column).isin(list(values)))


def filter_heroes(
    hero_mart: DataFrame,
    *,
    windows: Sequence[str] | None = None,
    attributes: Sequence[str] | None = None,
    attack_types: Sequence[str] | None = None,
    segments: Sequence[str] | None = None,
) -> DataFrame:
    rows = _only(hero_mart, "recency_window", windows)
    rows = _only(rows, "primary_attribute", attributes)
    rows = _only(rows, "attack_type", attack_types)
    return _only(rows, "stability_segment", segments)


def kpi_cards(summary: DataFrame, windows: Sequence[str] | None = None) -> DataFrame:
    """One row of totals over the chosen windows."""
    return _only(summary, "recency_window", windows).agg(
        F.sum("match_count").alias("match_count"),
        F.sum("player_row_count").alias("player_row_count"),
        F.sum("known_account_count").alias("known_account_count"),
        F.avg(F.col("avg_match_duration_minutes").cast("double")).alias(
            "avg_match_duration_minutes"
        ),
    )


def window_summary(summary: DataFrame, returning: DataFrame) -> DataFrame:
    """Summary and returning players side by side, related on the window (one row each)."""
    return summary.join(returning.drop("known_account_count"), "recency_window")


def delta_scatter(hero_mart: DataFrame, **filters) -> DataFrame:
    return filter_heroes(hero_mart, **filters).select(
        "hero_id",
        "hero_name",
        "recency_window",
        "pick_rate_delta_vs_prior_window",
        "win_rate_delta_vs_prior_window",
        "stability_segment",
    )


def volatility_ranked(hero_mart: DataFrame, **filters) -> DataFrame:
    """Heroes from the most volatile down; heroes without a score last."""
    rows = filter_heroes(hero_mart, **filters)
    return rows.select(
        "hero_id", "hero_name", "recency_window", "volatility_score", "stability_segment"
    ).orderBy(F.col("volatility_score").desc_nulls_last(), "hero_id", "recency_window")


def volatility_ranks(hero_mart: DataFrame, **filters) -> DataFrame:
    """The rows of ``volatility_ranked`` with their rank and dense rank; ties share a rank, no score is last."""
    order = {"volatility_score": F.col("volatility_score").desc_nulls_last()}
    rows = volatility_ranked(hero_mart, **filters)
    return global_rank(rows, order, rank="volatility_rank", dense="volatility_dense_rank")


def segment_topk(hero_mart: DataFrame, k: int, **filters) -> DataFrame:
    """The ``k`` most volatile heroes of each segment; each task keeps its own k first."""
    order = Window.partitionBy("stability_segment").orderBy(
        F.col("volatility_score").desc(), F.col("hero_id"), F.col("recency_window")
    )
    rows = filter_heroes(hero_mart, **filters).where(F.col("stability_segment").isNotNull())
    return (
        rows.withColumn("segment_rank", F.row_number().over(order))
        .where(F.col("segment_rank") <= k)
        .select(
            "stability_segment",
            "segment_rank",
            "hero_id",
            "hero_name",
            "current_window_pick_rate",
            "current_window_win_rate",
        )
    )


def action_quadrant(hero_mart: DataFrame, **filters) -> DataFrame:
    return filter_heroes(hero_mart, **filters).select(
        "hero_id",
        "hero_name",
        "recency_window",
        "volatility_score",
        "current_window_win_rate",
        "stability_segment",
    )


def action_board(hero_mart: DataFrame, high_usage_from: float, **filters) -> DataFrame:
    """Recommended action per hero. ``high_usage_from`` is the pick rate that counts as high."""
    segment = F.col("stability_segment")
    focus = action_focus(
        segment,
        F.col("pick_rate_delta_vs_prior_window"),
        F.col("current_window_pick_rate"),
        F.lit(str(high_usage_from)).cast("decimal(38,6)"),
    )
    return filter_heroes(hero_mart, **filters).select(
        "hero_id",
        "hero_name",
        "stability_segment",
        recommended_action(segment).alias("recommended_action"),
        focus.alias("action_focus"),
    ).where(segment.isNotNull())
