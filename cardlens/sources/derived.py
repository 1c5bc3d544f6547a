"""Tables derived from the given Parquet inputs (see FIXTURES.md part 1).

``hands`` turns each lineitem row into five distinct cards, ``prediction_log``
turns events into one row per served prediction, ``counter_samples`` turns
events into a counter that falls back and ``run_log`` turns orders into
a run history. All are plain projections of the inputs, so their
size grows with the inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import compile_long_stages
from .tables import read_table, spread

KEY_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
DECK_SIZE = 52
# 52 * 51 * 50 * 49 * 48 ordered five-card draws
ORDERED_DRAWS = 311875200


def hands_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Five cards per lineitem row from a mixed-radix decode of a key hash."""
    return hands_from_code(with_deal_code(lineitem))


def with_deal_code(lineitem: DataFrame) -> DataFrame:
    """Keys, time and the number of the ordered five-card draw of each lineitem row."""
    code = ((F.col("l_orderkey") * 7919 + F.col("l_linenumber").cast("long") * 104729
             + F.col("l_partkey") * 1299709 + F.col("l_suppkey") * 15485863) % ORDERED_DRAWS)
    return lineitem.select(*KEY_COLUMNS, F.col("l_shipdate").cast("timestamp").alias("ship_ts"),
                           code.cast("long").alias("code"))


def hands_from_code(df: DataFrame) -> DataFrame:
    """Decode the draw number into five distinct cards.

    The i-th digit is a place in the deck without the cards before it. Going back one draw at a time, a place at or beyond
    the one taken there stands one further on: a few integer steps on columns without nulls and no array per row. A negative
    digit (of a negative or unknown code) is no place: that card and all after it are null.
    """
    compile_long_stages(df.sparkSession)
    keep = [*KEY_COLUMNS, "ship_ts", "code"]
    digits = [f"_d{i}" for i in range(1, 6)]
    number = F.coalesce("code", F.lit(-1))
    div, cols = 1, []
    for base, name in zip([52, 51, 50, 49, 48], digits):
        cols.append((F.floor(number / div) % base).cast("int").alias(name))
        div *= base
    df = df.select(*keep, *cols)
    df = df.select("*", *[F.col(d).alias(f"_k{i}") for i, d in enumerate(digits, start=1)])
    for back in range(1, 5):
        moved = [F.when(F.col(f"_k{i}") >= F.col(f"_d{i - back}"), F.col(f"_k{i}") + 1).otherwise(F.col(f"_k{i}")).alias(f"_k{i}")
                 for i in range(back + 1, 6)]
        df = df.select(*keep, *digits, *[f"_k{i}" for i in range(1, back + 1)], *moved)
    cards, known = [], F.lit(0)
    for i, digit in enumerate(digits, start=1):
        known = known.bitwiseOR(F.col(digit))  # negative if one of the digits up to here is
        k = F.when(known >= 0, F.col(f"_k{i}"))
        cards += [(F.floor(k / 13) + 1).cast("int").alias(f"S{i}"), (k % 13 + 1).cast("int").alias(f"C{i}")]
    return df.select(*keep, *cards)


def hands(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(*KEY_COLUMNS, "l_shipdate")
    # the four key columns tell nearly all rows apart (two orderkey / linenumber pairs in three are unique)
    return hands_from_lineitem(spread(li, KEY_COLUMNS))


def prediction_log_from_events(ev: DataFrame) -> DataFrame:
    """One row per served prediction (request id, time, status, timings, size, output)."""
    status = (F.when(F.col("event_type") != "error", 200)
              .when(F.col("event_id") % 3 == 0, 422)
              .when(F.col("event_id") % 3 == 1, 404)
              .otherwise(500))
    return ev.select(
        F.col("event_id").alias("request_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        status.cast("int").alias("status"),
        (F.col("value") / 50.0).alias("inference_seconds"),
        (F.col("value") / 1000.0).alias("load_seconds"),
        F.length("props").cast("long").alias("payload_bytes"),
        (((F.col("event_id") * 37) % 101).cast("double") / 100.0).alias("equity"),
        (1 + (F.col("event_id") * 7919) % 7462).cast("int").alias("current_hand_rank_value"),
    )


def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prediction_log_from_events(read_table(spark, sf_dir, "events"))


def counter_samples(spark: SparkSession, sf_dir: str, reset_every: int = 100) -> DataFrame:
    """Samples of a per-series counter that falls back every ``reset_every`` events.

    The sample is a row expression of the event's number, so nothing is ranked and no
    series is brought together.
    """
    return read_table(spark, sf_dir, "events").select(
        F.col("event_type").alias("series"), F.col("ts").cast("timestamp").alias("ts"),
        (F.col("event_id") % reset_every).cast("long").alias("cum"))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run history: one row per order; every 5000th-ish order is unfinished."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("run_id"),
        F.col("o_orderpriority").alias("run_name"),
        F.when(F.col("o_orderkey") % 5000 == 17, F.lit(None).cast("timestamp"))
         .otherwise(F.col("o_orderdate").cast("timestamp")).alias("end_time"),
    )


def seven_cards(hands_df: DataFrame) -> DataFrame:
    """Hands with card numbers ``_k1.._k5`` and two more cards of the rest of the deck, ``turn_card`` and
    ``river_card``, picked by the part and supplier keys."""
    cards = [f"_k{i}" for i in range(1, 6)]
    df = hands_df.select("*", *[((F.col(f"S{i}") - 1) * 13 + F.col(f"C{i}") - 1).cast("int").alias(f"_k{i}") for i in range(1, 6)])
    rest = F.array_except(F.sequence(F.lit(0), F.lit(DECK_SIZE - 1)), F.array(*cards))
    df = df.withColumn("_rest", rest)
    df = df.withColumn("turn_card", F.get("_rest", (F.col("l_partkey") % 47).cast("int")))
    df = df.withColumn("_rest", F.array_remove("_rest", F.col("turn_card")))
    return df.withColumn("river_card", F.get("_rest", (F.col("l_suppkey") % 46).cast("int"))).drop("_rest")


def with_table_label(ranked: DataFrame, out_col: str = "equity") -> DataFrame:
    """A label from the table's own columns: seven parts the hand's place among all ranks, three parts the deal's code."""
    place = 1.0 - (F.col("current_hand_rank_value") - 1) / 7461.0
    return ranked.withColumn(out_col, F.round(0.7 * place + 0.3 * (F.col("code") % 101) / 100.0, 6))


def live_from_hands(hands_df: DataFrame) -> DataFrame:
    """Live telemetry rows: time, keys, three flags, a stand-in equity and the class label."""
    from ..functions import cards
    from ..operators.ranks import with_rank_value
    ranked = with_rank_value(hands_df)
    return ranked.select(
        F.col("ship_ts").alias("ts"), *KEY_COLUMNS, "code",
        (cards.hand_is_pair() == 1).alias("hand_is_pair"),
        (cards.hand_is_suited() == 1).alias("hand_is_suited"),
        (cards.board_is_paired() == 1).alias("board_is_paired"),
        ((F.col("code") % 101).cast("double") / 100.0).alias("equity"),
        F.col("current_hand_class_value").cast("string").alias("current_hand_class_value"),
    )


def live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live_from_hands(hands(spark, sf_dir))
