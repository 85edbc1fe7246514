import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from arenalake.functions.numeric import flag, mean, minutes, ratio
from arenalake.functions.rules import (
    is_radiant,
    recommended_action,
    stability_segment,
    stream_rank,
)
from arenalake.functions.windows import (
    calendar_window,
    epoch_to_ntz,
    is_target_window,
    recency_window,
    window_start,
)


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in df.select(expression(F.col("v"))).collect()]


EPOCHS = {
    1609459200: "outside_target_windows",
    1672531199: "outside_target_windows",
    1672531200: "2023_2024",
    1704067200: "2023_2024",
    1735689599: "2023_2024",
    1735689600: "2025_2026",
    1893456000: "2025_2026",
    0: "outside_target_windows",
}


@pytest.mark.parametrize("label", [recency_window, calendar_window])
def test_window_labels(spark, label):
    assert column(spark, EPOCHS, "bigint", label) == list(EPOCHS.values())


def test_null_start_is_outside(spark):
    assert column(spark, [None], "bigint", recency_window) == ["outside_target_windows"]


def test_target_windows(spark):
    labels = ["2023_2024", "2025_2026", "outside_target_windows"]
    assert column(spark, labels, "string", is_target_window) == [True, True, False]


def test_epoch_does_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        text = column(spark, [1735689600], "bigint", lambda c: epoch_to_ntz(c).cast("string"))
        start = column(spark, ["2025_2026", "x"], "string", lambda c: window_start(c).cast("string"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert text == ["2025-01-01 00:00:00"]
    assert start == ["2025-01-01 00:00:00", None]


def test_stream_rank(spark):
    streams = ["pro_matches", "public_matches", "unknown", "other", None]
    assert column(spark, streams, "string", stream_rank) == [1, 2, 3, 3, 3]


def test_radiant_slots(spark):
    assert column(spark, [0, 127, 128, None], "bigint", is_radiant) == [True, True, False, False]


def test_ratio_rounds_half_up_at_six_places(spark):
    rows = spark.createDataFrame([(23, 3910), (11, 23), (1, 2000000), (1, 0)], "a bigint, b bigint")
    got = [r[0] for r in rows.select(ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [Decimal("0.005882"), Decimal("0.478261"), Decimal("0.000001"), None]


def test_ratio_against_exact_rounding(spark):
    dice = random.Random(7)
    pairs = [(dice.randint(0, 10**k), dice.randint(1, 10**k)) for k in range(1, 12) for _ in range(40)]
    pairs += [(2 * n + 1, 2 * 10**6) for n in range(50)]  # exactly half way
    rows = spark.createDataFrame(pairs, "a bigint, b bigint")
    unit = Decimal("0.000001")
    for a, b, got in rows.select("a", "b", ratio(F.col("a"), F.col("b"))).collect():
        exact = Decimal((2 * 10**6 * a + b) // (2 * b)) * unit
        assert got == exact, (a, b)


def test_mean_minutes(spark):
    rows = spark.createDataFrame([(1802,), (1802,), (1803,)], "s bigint")
    assert rows.agg(minutes(mean(F.col("s")))).first()[0] == Decimal("30.038888883333")


def test_unknown_result_is_a_loss(spark):
    assert column(spark, [1, 0, None], "int", lambda c: flag(c == 1)) == [1, 0, 0]


SEGMENTS = [
    ("0.009999", "0.009999", "stable"),
    ("0.01", "0", "watchlist"),
    ("0", "-0.01", "watchlist"),
    ("0.029999", "0.029999", "watchlist"),
    ("0", "0.03", "volatile"),
    ("-0.03", "0", "volatile"),
    (None, "0.05", None),
]


@pytest.mark.parametrize("pick,win,segment", SEGMENTS)
def test_segments(spark, pick, win, segment):
    deltas = [F.lit(v).cast("decimal(38,6)") for v in (pick, win)]
    assert spark.range(1).select(stability_segment(*deltas)).first()[0] == segment


def test_exact_limit_on_decimals(spark):
    """0.48 - 0.45 is exactly 0.03, which doubles would miss."""
    a, b = (F.lit(v).cast("decimal(38,6)") for v in ("0.48", "0.45"))
    zero = F.lit("0").cast("decimal(38,6)")
    assert spark.range(1).select(stability_segment(zero, a - b)).first()[0] == "volatile"


def test_actions(spark):
    got = column(spark, ["stable", "watchlist", "volatile", None], "string", recommended_action)
    assert got == ["monitor", "targeted investigation", "balance review", None]
