"""Declared schemas of the engine's tables (no schema inference at the sources)."""

from __future__ import annotations

from pyspark.sql import types as T

from .config import CARD_COLUMNS, MODEL_FEATURES, STATEFUL_FEATURES

# raw hand table: five cards (suit 1..4, rank 1..13), optionally an old class label
RAW_HANDS = T.StructType([T.StructField(c, T.IntegerType()) for c in CARD_COLUMNS]
                         + [T.StructField("CLASS", T.IntegerType())])

# one row per served prediction
PREDICTION_LOG = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("inference_seconds", T.DoubleType()),
    T.StructField("load_seconds", T.DoubleType()),
    T.StructField("payload_bytes", T.LongType()),
    T.StructField("equity", T.DoubleType()),
    T.StructField("current_hand_rank_value", T.IntegerType()),
])

# live telemetry rows compared with the baseline
LIVE = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("hand_is_pair", T.BooleanType()),
    T.StructField("hand_is_suited", T.BooleanType()),
    T.StructField("board_is_paired", T.BooleanType()),
    T.StructField("equity", T.DoubleType()),
    T.StructField("current_hand_class_value", T.StringType()),
])

# baseline distribution in long form
BASELINE = T.StructType([
    T.StructField("feature", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("n", T.LongType()),
])

# per-rank lookup written by the feature job
STATEFUL_LOOKUP = T.StructType([T.StructField("current_hand_rank_value", T.IntegerType())]
                               + [T.StructField(c, T.DoubleType()) for c in STATEFUL_FEATURES])

# run log entries
RUN_LOG = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("run_name", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("attempt", T.IntegerType()),
])

MODEL_INPUTS = tuple(MODEL_FEATURES)
