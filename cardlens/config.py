"""Parameters and fixed values of the hand-analytics engine.

Everything a caller may want to change lives in :class:`EngineConfig`; the
module-level constants below are values that must stay exactly as they are
for results to agree with the behaviour this engine reproduces.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reproduced behaviour; keep in natural order)
# ---------------------------------------------------------------------------
# Card encoding: suit 1..4 and rank 1..13 (1 = ace, 10 = ten, 11 = jack,
# 12 = queen, 13 = king). Card text is rank letter followed by suit letter.
SUIT_LETTERS = {1: "h", 2: "s", 3: "d", 4: "c"}
RANK_LETTERS = {1: "A", 10: "T", 11: "J", 12: "Q", 13: "K"}

# Hand classes, best first.
CLASS_NAMES = {
    0: "royal flush",
    1: "straight flush",
    2: "four of a kind",
    3: "full house",
    4: "flush",
    5: "straight",
    6: "three of a kind",
    7: "two pair",
    8: "pair",
    9: "high card",
}
# Inclusive rank-value bounds of each class (rank 1 = best, 7462 = worst).
CLASS_UPPER_BOUNDS = (1, 10, 166, 322, 1599, 1609, 2467, 3325, 6185, 7462)
NUM_RANK_VALUES = 7462

# Row features, in the order the feature builder adds them.
STATELESS_FEATURES = (
    "hand_is_pair",
    "hand_is_suited",
    "hand_is_connected",
    "highest_hand_card",
    "hand_rank_diff",
    "current_hand_rank_value",
    "current_hand_class_value",
    "is_straight_hand",
    "is_flush_hand",
    "is_flush_draw",
    "is_straight_draw",
    "board_is_monotone",
    "board_is_paired",
)
# Dataset-relative features; the misspelling of the last one is part of the
# output contract.
STATEFUL_FEATURES = ("relative_rank_z", "relative_rank_cdf", "global_rank_strenght")
RANK_VALUE = "current_hand_rank_value"
RANK_CLASS = "current_hand_class_value"
Z_SCORE_EPSILON = 1e-9

CARD_COLUMNS = ("S1", "C1", "S2", "C2", "S3", "C3", "S4", "C4", "S5", "C5")

# Model inputs, in order.
MODEL_FEATURES = (
    "S1", "C1", "S2", "C2", "S3", "C3", "S4", "C4", "S5", "C5",
    "hand_is_pair", "hand_is_suited", "hand_is_connected", "highest_hand_card",
    "current_hand_class_value", "current_hand_rank_value",
    "is_flush_hand", "is_straight_hand",
    "is_straight_draw", "is_flush_draw",
    "board_is_paired", "board_is_monotone",
)
TARGET = "equity"

# Drift: features compared and equity bin edges.
BINARY_DRIFT_FEATURES = ("hand_is_pair", "hand_is_suited", "board_is_paired")
CATEGORICAL_DRIFT_FEATURES = ("equity_bin", "current_hand_class_value")
EQUITY_BIN_EDGES = (0.0, 0.2, 0.4, 0.6, 0.8, 1.0)
PSI_EPSILON = 1 / 1e100
PSI_ALERT_THRESHOLD = 0.2

# Monitoring: histogram bucket upper edges.
EQUITY_HISTOGRAM_EDGES = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
LATENCY_BUCKET_EDGES = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)
ERROR_RATE_ALERT = 0.1
P95_LATENCY_ALERT_SECONDS = 2.0
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class EngineConfig:
    """Run parameters. Defaults follow the reproduced application."""

    simulation_count: int = 10
    equity_seed: int = 0
    sample_rate: float = 0.2
    split_seed: int = 42
    test_size: float = 0.2
    max_depth: int = 10
    num_trees: int = 100
    max_bins: int = 128
    live_window_rows: int = 5
    psi_epsilon: float = PSI_EPSILON
    psi_alert_threshold: float = PSI_ALERT_THRESHOLD
    model_features: tuple = field(default=MODEL_FEATURES)
    # Number of partitions for the heavy simulation stage; None = session's
    # spark.sql.shuffle.partitions (AQE coalesces small ones).
    simulation_partitions: int | None = None


DEFAULT_CONFIG = EngineConfig()


def equity_bin_labels(edges=EQUITY_BIN_EDGES) -> list[str]:
    """Labels of the equity bins: ``"<low>-<high>"`` with Python float text."""
    return [f"{lo}-{hi}" for lo, hi in zip(edges[:-1], edges[1:])]
