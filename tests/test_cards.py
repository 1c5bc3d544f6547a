import itertools
import random

import pytest
from pyspark.sql import functions as F

from cardlens.functions import cards
from cardlens.operators.features import stateless_features
from conftest import CARD_COLS, by_id, with_id

HOLE = [(1, 7, 2, 7), (1, 2, 1, 5), (3, 9, 2, 10), (1, 1, 2, 13), (1, 1, 4, 2)]
FIVE = [
    (1, 10, 1, 11, 1, 12, 1, 13, 1, 1),
    (2, 2, 2, 3, 2, 4, 2, 5, 1, 9),
    (3, 5, 3, 6, 2, 7, 2, 8, 2, 2),
    (2, 2, 2, 3, 1, 5, 1, 5, 1, 9),
    (1, 2, 2, 7, 3, 9, 4, 11, 1, 13),
]


@pytest.fixture(scope="module")
def hole(spark):
    df = with_id(spark, HOLE, ["S1", "C1", "S2", "C2"])
    return df.select("*", cards.hand_is_pair().alias("pair"), cards.hand_is_suited().alias("suited"),
                     cards.hand_is_connected().alias("connected"), cards.highest_hand_card().alias("highest"),
                     cards.hand_rank_diff().alias("diff"))


def test_hole_card_features(hole):
    assert by_id(hole, "pair") == {0: 1, 1: 0, 2: 0, 3: 0, 4: 0}
    assert by_id(hole, "suited")[0] == 0 and by_id(hole, "suited")[1] == 1
    assert by_id(hole, "connected") == {0: 0, 1: 0, 2: 1, 3: 1, 4: 1}
    assert by_id(hole, "highest")[0] == 7 and by_id(hole, "highest")[3] == 14
    assert by_id(hole, "diff")[0] == 0 and by_id(hole, "diff")[2] == 1 and by_id(hole, "diff")[3] == 12


@pytest.fixture(scope="module")
def five(spark):
    return stateless_features(with_id(spark, FIVE, CARD_COLS))


def test_five_card_features(five):
    assert by_id(five, "current_hand_rank_value") == {0: 1, 1: 7444, 2: 7446, 3: 5505, 4: 6836}
    assert by_id(five, "current_hand_class_value") == {0: 0, 1: 9, 2: 9, 3: 8, 4: 9}
    assert by_id(five, "is_straight_hand")[0] == 1 and by_id(five, "is_straight_hand")[2] == 0
    assert by_id(five, "is_flush_hand")[0] == 1 and by_id(five, "is_flush_hand")[1] == 0
    assert by_id(five, "is_flush_draw")[0] == 0 and by_id(five, "is_flush_draw")[1] == 1
    assert by_id(five, "is_straight_draw")[2] == 1 and by_id(five, "is_straight_draw")[4] == 0
    assert by_id(five, "board_is_monotone")[3] == 1 and by_id(five, "board_is_monotone")[4] == 0
    assert by_id(five, "board_is_paired")[3] == 1 and by_id(five, "board_is_paired")[4] == 0
    assert by_id(five, "current_hand_rank_value")[4] > 6000


def _straight_draw_by_definition(ranks):
    """Distinct ranks, ace also as 14, sorted; some 4 consecutive entries span <= 4."""
    rs = sorted(set(ranks) | ({14} if 1 in ranks else set()))
    return int(any(rs[i + 3] - rs[i] <= 4 for i in range(len(rs) - 3)))


def test_straight_draw_matches_definition_on_all_rank_multisets(spark):
    combos = [c for c in itertools.combinations_with_replacement(range(1, 14), 5)
              if max(c.count(x) for x in c) <= 4]
    rows = [(1, a, 2, b, 3, c, 4, d, 1, e) for a, b, c, d, e in combos]
    df = with_id(spark, rows, CARD_COLS).select("row_id", cards.is_straight_draw().alias("sd"))
    got = by_id(df, "sd")
    for i, c in enumerate(combos):
        assert got[i] == _straight_draw_by_definition(c), c


def test_flush_draw_exactly_four(spark):
    rows = [(1, 2, 1, 3, 1, 4, 1, 5, 2, 9), (1, 2, 1, 3, 1, 4, 1, 5, 1, 9), (1, 2, 1, 3, 1, 4, 2, 5, 2, 9)]
    df = with_id(spark, rows, CARD_COLS).select("row_id", cards.is_flush_draw().alias("fd"))
    assert by_id(df, "fd") == {0: 1, 1: 0, 2: 0}


def test_card_text(spark):
    df = with_id(spark, [(1, 1), (2, 10), (4, 9), (3, 13)], ["s", "r"])
    out = df.select("row_id", cards.card_text(F.col("s"), F.col("r")).alias("t"))
    assert by_id(out, "t") == {0: "Ah", 1: "Ts", 2: "9c", 3: "Kd"}


def test_card_text_bad_suit_raises_or_nulls(spark):
    df = with_id(spark, [(99, 1)], ["s", "r"])
    with pytest.raises(Exception, match="suit of 1 to 4"):
        df.select(cards.card_text(F.col("s"), F.col("r"))).collect()
    assert df.select(cards.card_text(F.col("s"), F.col("r"), strict=False).alias("t")).first()["t"] is None


def test_validation_flags(spark):
    rows = [
        (1, 1, 2, 2, 3, 3, 4, 4, 1, 5),      # valid
        (0, 1, 2, 2, 3, 3, 4, 4, 1, 5),      # suit 0
        (5, 1, 2, 2, 3, 3, 4, 4, 1, 5),      # suit 5
        (1, 0, 2, 2, 3, 3, 4, 4, 1, 5),      # rank 0
        (1, 14, 2, 2, 3, 3, 4, 4, 1, 5),     # rank 14
        (None, 1, 2, 2, 3, 3, 4, 4, 1, 5),   # null
        (1, 1, 1, 1, 3, 3, 4, 4, 1, 5),      # repeated card: valid but flagged
    ]
    df = with_id(spark, rows, CARD_COLS)
    valid, rejected = cards.validate_hands(df)
    assert sorted(r["row_id"] for r in valid.collect()) == [0, 6]
    assert by_id(valid, "has_repeated_card") == {0: False, 6: True}
    bad = {r["row_id"]: r["invalid_columns"] for r in rejected.collect()}
    assert bad == {1: ["S1"], 2: ["S1"], 3: ["C1"], 4: ["C1"], 5: ["S1"]}


@pytest.mark.parametrize("value,label", [
    (0.0, "0.0-0.2"), (0.199, "0.0-0.2"), (0.2, "0.2-0.4"), (0.5, "0.4-0.6"),
    (0.8, "0.8-1.0"), (1.0, "0.8-1.0"), (-0.1, "0.8-1.0"), (1.5, "0.8-1.0"),
    (float("nan"), "0.8-1.0"), (None, "0.8-1.0"),
])
def test_equity_bins(spark, value, label):
    df = spark.createDataFrame([(value,)], "equity double")
    assert df.select(cards.equity_bin(F.col("equity")).alias("b")).first()["b"] == label


def test_equity_bin_added_only_when_absent(spark):
    df = spark.createDataFrame([(0.5,)], "equity double")
    assert "equity_bin" in cards.with_equity_bin(df).columns
    pre = df.withColumn("equity_bin", F.lit("given"))
    assert cards.with_equity_bin(pre).first()["equity_bin"] == "given"
    assert cards.with_equity_bin(spark.createDataFrame([(1,)], "x int")).columns == ["x"]


def test_feature_projection_is_one_scan_with_broadcast(spark):
    df = stateless_features(with_id(spark, FIVE, CARD_COLS))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_random_hands_permutation_invariant_rank(spark):
    """The rank value depends on the set of cards, not on their order."""
    rnd = random.Random(7)
    rows, perms = [], []
    for _ in range(200):
        cards5 = rnd.sample(range(52), 5)
        order = cards5[:]
        rnd.shuffle(order)
        rows.append(tuple(x for k in cards5 for x in (k // 13 + 1, k % 13 + 1)))
        perms.append(tuple(x for k in order for x in (k // 13 + 1, k % 13 + 1)))
    a = stateless_features(with_id(spark, rows, CARD_COLS))
    b = stateless_features(with_id(spark, perms, CARD_COLS))
    assert by_id(a, "current_hand_rank_value") == by_id(b, "current_hand_rank_value")
