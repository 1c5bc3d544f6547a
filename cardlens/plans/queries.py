"""Registered queries: one per operator of the inventory, each over whole tables.

Every query takes ``(spark, sf_dir)``, reads the input Parquet files (or
tables Spark derives from them) and returns a DataFrame whose column names
match its SQL twin in :mod:`cardlens.plans.oracle_sql` /
:func:`oracle_queries`. Doubles that come out of floating-point aggregation
are rounded to 6 places on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RANK_CLASS, RANK_VALUE
from ..functions import cards
from ..operators import equity as eq
from ..operators import features as feat
from ..operators import ranks
from ..sources import derived
from . import oracle_sql as osql

KEYS = list(derived.KEY_COLUMNS)
ROW_ID = KEYS + ["code"]

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def all_queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_queries() -> dict[str, str]:
    return dict(_SQL)


H = osql.hands_cte()
R5 = osql.rank_table_cte()
R7 = osql.seven_table_cte()
RH = osql.ranked_hands_cte()
KEYS_SQL = osql.KEYS + ", code"


# ---------------------------------------------------------------------------
# B: row features
# ---------------------------------------------------------------------------

def _hands(spark, sf_dir):
    return derived.hands(spark, sf_dir)


_B_SIMPLE = {
    "b01_hand_is_pair": ("hand_is_pair", cards.hand_is_pair, "CAST(C1 = C2 AS INTEGER)"),
    "b02_hand_is_suited": ("hand_is_suited", cards.hand_is_suited, "CAST(S1 = S2 AS INTEGER)"),
    "b03_hand_is_connected": ("hand_is_connected", cards.hand_is_connected, "CAST(abs(C1 - C2) IN (1, 12) AS INTEGER)"),
    "b04_highest_hand_card": ("highest_hand_card", cards.highest_hand_card,
                              "CAST(greatest(CASE WHEN C1 = 1 THEN 14 ELSE C1 END, CASE WHEN C2 = 1 THEN 14 ELSE C2 END) AS INTEGER)"),
    "b05_hand_rank_diff": ("hand_rank_diff", cards.hand_rank_diff, "CAST(abs(C1 - C2) AS INTEGER)"),
    "b08_is_flush_draw": ("is_flush_draw", cards.is_flush_draw,
                          "CAST(len(list_filter([S1, S2, S3, S4, S5], lambda s: s = 1)) = 4 OR "
                          "len(list_filter([S1, S2, S3, S4, S5], lambda s: s = 2)) = 4 OR "
                          "len(list_filter([S1, S2, S3, S4, S5], lambda s: s = 3)) = 4 OR "
                          "len(list_filter([S1, S2, S3, S4, S5], lambda s: s = 4)) = 4 AS INTEGER)"),
    "b10_board_is_monotone": ("board_is_monotone", cards.board_is_monotone, "CAST(S3 = S4 AND S4 = S5 AS INTEGER)"),
    "b11_board_is_paired": ("board_is_paired", cards.board_is_paired, "CAST(C3 = C4 OR C4 = C5 OR C3 = C5 AS INTEGER)"),
}


def _make_simple(name, col, fn, sql):
    @register(name, osql.with_ctes(H, body=f"SELECT {KEYS_SQL}, {sql} AS {col} FROM hands"))
    def q(spark, sf_dir, _fn=fn, _col=col):
        return _hands(spark, sf_dir).select(*ROW_ID, _fn().alias(_col))
    return q


for _name, (_col, _fn, _sql) in _B_SIMPLE.items():
    _make_simple(_name, _col, _fn, _sql)

# straight draw, spelled the way it is defined: distinct ranks, ace also 14,
# sorted; some four consecutive entries span at most four
_SD_SQL = """SELECT {keys}, CAST(coalesce(
    (rs[4] - rs[1] <= 4) OR (rs[5] - rs[2] <= 4) OR (rs[6] - rs[3] <= 4), FALSE) AS INTEGER) AS is_straight_draw
FROM (SELECT *, list_sort(CASE WHEN list_contains(d, 1) THEN list_distinct(d || [14]) ELSE d END) AS rs
      FROM (SELECT *, list_distinct([C1, C2, C3, C4, C5]) AS d FROM hands))""".format(keys=KEYS_SQL)


@register("b09_is_straight_draw", osql.with_ctes(H, body=_SD_SQL))
def b09_is_straight_draw(spark, sf_dir):
    return _hands(spark, sf_dir).select(*ROW_ID, cards.is_straight_draw().alias("is_straight_draw"))


@register("b06_is_straight_hand", osql.with_ctes(H, R5, RH, body=f"""
SELECT {KEYS_SQL}, CAST(current_hand_class_value IN (0, 1, 5) AS INTEGER) AS is_straight_hand FROM ranked"""))
def b06_is_straight_hand(spark, sf_dir):
    return ranks.with_rank_value(_hands(spark, sf_dir)).select(*ROW_ID, cards.is_straight_hand().alias("is_straight_hand"))


@register("b07_is_flush_hand", osql.with_ctes(H, R5, RH, body=f"""
SELECT {KEYS_SQL}, CAST(current_hand_class_value IN (0, 1, 4) AS INTEGER) AS is_flush_hand FROM ranked"""))
def b07_is_flush_hand(spark, sf_dir):
    return ranks.with_rank_value(_hands(spark, sf_dir)).select(*ROW_ID, cards.is_flush_hand().alias("is_flush_hand"))


_B12_COLS = ["hand_is_pair", "hand_is_suited", "hand_is_connected", "highest_hand_card", "hand_rank_diff",
             "current_hand_rank_value", "current_hand_class_value", "is_straight_hand", "is_flush_hand",
             "is_flush_draw", "is_straight_draw", "board_is_monotone", "board_is_paired"]


def _b12_sql_select(src: str = "ranked") -> str:
    by_col = {col: sql for (col, _f, sql) in _B_SIMPLE.values()}
    by_col["current_hand_rank_value"] = "current_hand_rank_value"
    by_col["current_hand_class_value"] = "current_hand_class_value"
    by_col["is_straight_hand"] = "CAST(current_hand_class_value IN (0, 1, 5) AS INTEGER)"
    by_col["is_flush_hand"] = "CAST(current_hand_class_value IN (0, 1, 4) AS INTEGER)"
    by_col["is_straight_draw"] = ("CAST(coalesce((rs[4] - rs[1] <= 4) OR (rs[5] - rs[2] <= 4) OR "
                                  "(rs[6] - rs[3] <= 4), FALSE) AS INTEGER)")
    return ", ".join(f"{by_col[c]} AS {c}" for c in _B12_COLS)


FEATURES_CTE = f"""feats AS (
  SELECT *, {_b12_sql_select()}
  FROM (SELECT *, list_sort(CASE WHEN list_contains(d, 1) THEN list_distinct(d || [14]) ELSE d END) AS rs
        FROM (SELECT *, list_distinct([C1, C2, C3, C4, C5]) AS d FROM ranked)))"""


@register("b12_stateless_features", osql.with_ctes(H, R5, RH, FEATURES_CTE, body=f"""
SELECT {KEYS_SQL}, {', '.join(_B12_COLS)} FROM feats"""))
def b12_stateless_features(spark, sf_dir):
    return feat.stateless_features(_hands(spark, sf_dir)).select(*ROW_ID, *_B12_COLS)


@register("b13_card_text", osql.with_ctes(H, body=f"""
SELECT {KEYS_SQL}, concat_ws(' ', {', '.join(
    f"(CASE C{i} WHEN 1 THEN 'A' WHEN 10 THEN 'T' WHEN 11 THEN 'J' WHEN 12 THEN 'Q' WHEN 13 THEN 'K' ELSE CAST(C{i} AS VARCHAR) END)"
    f" || (CASE S{i} WHEN 1 THEN 'h' WHEN 2 THEN 's' WHEN 3 THEN 'd' WHEN 4 THEN 'c' END)" for i in range(1, 6))}) AS hand_text
FROM hands"""))
def b13_card_text(spark, sf_dir):
    return _hands(spark, sf_dir).select(*ROW_ID, cards.hand_text().alias("hand_text"))


@register("b14_drop_label", osql.with_ctes(H, body=f"""
SELECT {KEYS_SQL}, S1, C1, S2, C2, S3, C3, S4, C4, S5, C5
FROM (SELECT *, CAST(code % 10 AS INTEGER) AS "CLASS" FROM hands)"""))
def b14_drop_label(spark, sf_dir):
    """The raw table carries a class label; preprocessing drops it (here a stand-in label)."""
    raw = _hands(spark, sf_dir).withColumn("CLASS", (F.col("code") % 10).cast("int"))
    return feat.drop_label(raw.select(*ROW_ID, *[f"{p}{i}" for i in range(1, 6) for p in "SC"], "CLASS"))


# requests made from hands: every third code breaks a suit, every fifth a rank, every seventh repeats a card, every eleventh
# leaves a card out
_BROKEN = {
    "S2": "CASE WHEN code % 3 = 0 THEN S2 + 4 ELSE S2 END",
    "C4": "CASE WHEN code % 5 = 0 THEN 0 ELSE C4 END",
    "S5": "CASE WHEN code % 7 = 0 THEN S1 ELSE S5 END",
    "C5": "CASE WHEN code % 11 = 0 THEN NULL WHEN code % 7 = 0 THEN C1 ELSE C5 END",
}
_CARD_COLS = [f"{p}{i}" for i in range(1, 6) for p in "SC"]
_BAD_SQL = [f"CASE WHEN {c} BETWEEN 1 AND {4 if c[0] == 'S' else 13} THEN NULL ELSE '{c}' END" for c in _CARD_COLS]


@register("b15_validate", osql.with_ctes(H, f"""
requests AS (SELECT {KEYS_SQL}, {', '.join(f"{_BROKEN.get(c, c)} AS {c}" for c in _CARD_COLS)} FROM hands),
checked AS (
  SELECT *, list_filter([{', '.join(_BAD_SQL)}], lambda c: c IS NOT NULL) AS bad,
         list_filter([{', '.join(f'(S{i} - 1) * 13 + C{i} - 1' for i in range(1, 6))}], lambda k: k IS NOT NULL) AS k
  FROM requests)""", body=f"""
SELECT {KEYS_SQL}, len(bad) = 0 AS is_valid, array_to_string(bad, ',') AS invalid_columns,
       len(list_distinct(k)) < len(k) AS has_repeated_card
FROM checked"""))
def b15_validate(spark, sf_dir):
    """Validity of requests, good and bad, with the failing columns and repeated cards, in one pass."""
    requests = _hands(spark, sf_dir).selectExpr(*ROW_ID, *[f"CAST({_BROKEN.get(c, c)} AS INT) AS {c}" for c in _CARD_COLS])
    return cards.with_validation(requests).select(*ROW_ID, "is_valid", F.array_join("invalid_columns", ",").alias("invalid_columns"),
                                                  "has_repeated_card")


@register("b16_equity_bin", osql.with_ctes(H, body=f"""
SELECT {KEYS_SQL}, CAST(code % 101 AS DOUBLE) / 100.0 AS equity,
       {osql.equity_bin_sql('CAST(code % 101 AS DOUBLE) / 100.0')} AS equity_bin
FROM hands"""))
def b16_equity_bin(spark, sf_dir):
    h = _hands(spark, sf_dir).select(*ROW_ID, ((F.col("code") % 101).cast("double") / 100.0).alias("equity"))
    return h.withColumn("equity_bin", cards.equity_bin(F.col("equity")))


@register("b18_model_inputs", osql.with_ctes(H, R5, RH, FEATURES_CTE, body=f"""
SELECT {KEYS_SQL}, S1, C1, S2, C2, S3, C3, S4, C4, S5, C5, hand_is_pair, hand_is_suited, hand_is_connected,
       highest_hand_card, current_hand_class_value, current_hand_rank_value, is_flush_hand, is_straight_hand,
       is_straight_draw, is_flush_draw, board_is_paired, board_is_monotone
FROM feats"""))
def b18_model_inputs(spark, sf_dir):
    return feat.model_inputs(feat.stateless_features(_hands(spark, sf_dir)), keep=tuple(ROW_ID))


# ---------------------------------------------------------------------------
# C: ranking and win share
# ---------------------------------------------------------------------------

@register("c1_rank_table", osql.with_ctes(H, R5, RH, body="""
SELECT r.rank_value, r.rank_class, r.is_flush, r.r1, r.r2, r.r3, r.r4, r.r5,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n_hands
FROM rank5 r LEFT JOIN (SELECT current_hand_rank_value AS v, count(*) AS n FROM ranked GROUP BY 1) c
  ON c.v = r.rank_value"""))
def c1_rank_table(spark, sf_dir):
    """The 7,462-row rank table with how many hands fall on each rank value."""
    table = ranks.cached_rank_table(spark)
    counts = ranks.with_rank_value(_hands(spark, sf_dir), class_col=None) \
        .groupBy(F.col(RANK_VALUE).alias("rank_value")).agg(F.count(F.lit(1)).alias("n_hands"))
    return table.join(counts, "rank_value", "left").select(
        "rank_value", "rank_class", "is_flush", *[f"r{i}" for i in range(1, 6)],
        F.coalesce("n_hands", F.lit(0)).cast("long").alias("n_hands"))


@register("c2_rank_value", osql.with_ctes(H, R5, RH, body=f"SELECT {KEYS_SQL}, current_hand_rank_value FROM ranked"))
def c2_rank_value(spark, sf_dir):
    return ranks.with_rank_value(_hands(spark, sf_dir), class_col=None).select(*ROW_ID, RANK_VALUE)


@register("c3_rank_class", osql.with_ctes(H, R5, RH, body=f"SELECT {KEYS_SQL}, current_hand_class_value FROM ranked"))
def c3_rank_class(spark, sf_dir):
    return ranks.with_rank_value(_hands(spark, sf_dir)).select(*ROW_ID, RANK_CLASS)


@register("c4_best_of_seven", osql.with_ctes(H, R5, R7, osql.seven_cards_ctes(), body=f"""
SELECT {KEYS_SQL}, CAST(b1 AS INTEGER) AS turn_card, CAST(b2 AS INTEGER) AS river_card, best_rank,
       {osql.class_case('best_rank')} AS best_class
FROM seven"""))
def c4_best_of_seven(spark, sf_dir):
    """Best five of seven: the hand plus two more cards decoded from the row's keys."""
    seven = derived.seven_cards(_hands(spark, sf_dir))
    ranked = ranks.best_of_seven(seven, ["_k1", "_k2", "_k3", "_k4", "_k5", "turn_card", "river_card"], "best_rank")
    return ranked.select(*ROW_ID, "turn_card", "river_card", "best_rank", ranks.rank_class_of(F.col("best_rank")).alias("best_class"))


@register("c5_win_share", osql.with_ctes(H, R5, R7, osql.showdown_ctes(10, 0), body=f"""
SELECT {KEYS_SQL}, round_even(sum(CASE WHEN player_rank < opponent_rank THEN 1.0
                                       WHEN player_rank = opponent_rank THEN 0.5 ELSE 0.0 END) / 10.0, 2) AS equity
FROM trials GROUP BY rid, {KEYS_SQL}"""))
def c5_win_share(spark, sf_dir):
    return eq.with_win_share(_hands(spark, sf_dir).select(*ROW_ID, *[f"{p}{i}" for i in range(1, 6) for p in "SC"]),
                             n=10, seed=0).select(*ROW_ID, "equity")
