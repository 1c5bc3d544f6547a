"""Row features (B12), model input selection (B18) and the label-column drop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import MODEL_FEATURES, RANK_CLASS, RANK_VALUE
from ..functions import cards
from .ranks import with_rank_value


def stateless_features(df: DataFrame) -> DataFrame:
    """The 13 row features, in order, as one projection plus one broadcast join.

    hand_is_pair, hand_is_suited, hand_is_connected, highest_hand_card,
    hand_rank_diff, current_hand_rank_value, current_hand_class_value,
    is_straight_hand, is_flush_hand, is_flush_draw, is_straight_draw,
    board_is_monotone, board_is_paired.
    """
    hole = df.select("*",
                     cards.hand_is_pair().alias("hand_is_pair"),
                     cards.hand_is_suited().alias("hand_is_suited"),
                     cards.hand_is_connected().alias("hand_is_connected"),
                     cards.highest_hand_card().alias("highest_hand_card"),
                     cards.hand_rank_diff().alias("hand_rank_diff"))
    ranked = with_rank_value(hole, RANK_VALUE, RANK_CLASS)
    return ranked.select("*",
                         cards.is_straight_hand().alias("is_straight_hand"),
                         cards.is_flush_hand().alias("is_flush_hand"),
                         cards.is_flush_draw().alias("is_flush_draw"),
                         cards.is_straight_draw().alias("is_straight_draw"),
                         cards.board_is_monotone().alias("board_is_monotone"),
                         cards.board_is_paired().alias("board_is_paired"))


def drop_label(df: DataFrame, label: str = "CLASS") -> DataFrame:
    """Drop the original class label (name matched case-insensitively)."""
    return df.drop(*[c for c in df.columns if c.lower() == label.lower()])


def model_inputs(df: DataFrame, features=MODEL_FEATURES, keep: tuple = ()) -> DataFrame:
    """The model inputs in fixed order (optionally keeping key columns first)."""
    return df.select(*keep, *[F.col(c) for c in features])
