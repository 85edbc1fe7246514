from decimal import Decimal

import pytest

from arenalake.plans import dashboards

COLUMNS = """hero_id bigint, hero_name string, recency_window string, primary_attribute string,
 attack_type string, volatility_score decimal(38,6), stability_segment string,
 current_window_pick_rate decimal(38,6), current_window_win_rate decimal(38,6),
 pick_rate_delta_vs_prior_window decimal(38,6), win_rate_delta_vs_prior_window decimal(38,6)"""


@pytest.fixture(scope="module")
def heroes(spark):
    def row(key, score, segment, rate, delta, attack="Melee"):
        d = Decimal
        return (key, f"h{key}", "2025_2026", "agi", attack, score and d(score), segment, d(rate), d("0.5"), d(delta), d("0"))

    rows = [
        row(1, "0.05", "volatile", "0.1", "0.05"),
        row(2, "0.09", "volatile", "0.1", "-0.09"),
        row(3, "0.02", "watchlist", "0.1", "0.02"),
        row(4, "0.001", "stable", "0.2", "0.001", "Ranged"),
        row(5, "0.002", "stable", "0.01", "0.002"),
        row(6, None, None, "0.01", "0"),
    ]
    return spark.createDataFrame(rows, COLUMNS)


def test_ranked_by_volatility(heroes):
    ranked = dashboards.volatility_ranked(heroes)
    assert [r.hero_id for r in ranked.collect()] == [2, 1, 3, 5, 4, 6]


def test_top_of_each_segment(heroes):
    top = dashboards.segment_topk(heroes, 1)
    assert sorted((r.stability_segment, r.hero_id) for r in top.collect()) == [
        ("stable", 5),
        ("volatile", 2),
        ("watchlist", 3),
    ]


def test_filters(heroes):
    rows = dashboards.delta_scatter(heroes, attack_types=["Ranged"], segments=["stable"])
    assert [r.hero_id for r in rows.collect()] == [4]
    assert dashboards.action_quadrant(heroes, windows=["2023_2024"]).count() == 0


def test_actions(heroes):
    board = dashboards.action_board(heroes, 0.1)
    got = {r.hero_id: (r.recommended_action, r.action_focus) for r in board.collect()}
    assert got == {
        1: ("balance review", "rising: overperformance"),
        2: ("balance review", "declining: underuse"),
        3: ("targeted investigation", None),
        4: ("monitor", "centralization risk"),
        5: ("monitor", None),
    }
