"""Win-share label ("equity") of a hand against one opponent.

For each hand and each of ``n`` trials, four cards are drawn from the 47
unseen ones — two for the opponent, then two more board cards — and both
seven-card hands are ranked with one broadcast lookup each. A win scores 1,
a tie 0.5; the label is ``round_half_even(wins / n, 2)``.

The draw is seeded and reproducible: trial ``t`` of the hand with code
``h`` uses ``x = int(md5("h|t|seed")[:8], 16) mod 47*46*45*44`` and takes the
mixed-radix digits of ``x`` (47, 46, 45, 44) as indexes into the ascending
list of remaining cards, removing each drawn card before the next draw.

Plan shape: trials are exploded where the rows are, ranked with two
broadcast hash joins (fixed-size tables), and summed back per row by a
partial aggregation keyed on (input partition, row); at most one shuffle of one small
row per input row. Identical hands are only grouped within an input
partition, so a hand that makes up a third of the data stays spread evenly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cards import card_index, has_repeated_card, invalid_columns
from .ranks import best_of_seven, best_of_seven_from_sums, card_sums

DRAW_SPACE = 47 * 46 * 45 * 44


def hand_code(cards: list[Column]) -> Column:
    """Base-52 fold of the five 0..51 card numbers, hole cards first."""
    return reduce(lambda acc, k: acc * 52 + k, [c.cast("long") for c in cards])


def draw_number(code: Column, trial: Column, seed: int) -> Column:
    digest = F.md5(F.concat_ws("|", code.cast("string"), trial.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % DRAW_SPACE


def with_seen_offsets(df: DataFrame) -> DataFrame:
    """Adds ``_t0.._t4``: the seen cards sorted ascending, minus their position.

    The ``i``-th card (0-based) of the ascending unseen deck is then
    ``i + #{j : _tj <= i}``: exactly ``_tj`` unseen cards lie below the j-th
    seen card. Computed once per hand, before trials are exploded.
    """
    srt = F.sort_array(F.array(*[F.col(f"_k{i}") for i in range(1, 6)]))
    df = df.withColumn("_seen", srt)
    return df.select("*", *[(F.get(F.col("_seen"), j) - j).alias(f"_t{j}") for j in range(5)]).drop("_seen")


def _unseen_card(idx: Column) -> Column:
    return idx + sum((F.col(f"_t{j}") <= idx).cast("int") for j in range(5))


def _nth_free(d: Column, taken: list[Column]) -> Column:
    """The d-th smallest of 0..46 once the ``taken`` indexes (ascending) are removed."""
    r = d
    for t in taken:
        r = r + (r >= t).cast("int")
    return r


def _draw_cards(df: DataFrame) -> DataFrame:
    """Adds _o1, _o2 (opponent) and _b1, _b2 (turn, river) from ``_x`` and ``_t0.._t4``.

    Mixed-radix digits of ``_x`` (47, 46, 45, 44) index the unseen deck with
    each drawn card removed before the next draw; the index arithmetic and the
    index -> card map are plain integer expressions (no per-trial arrays).
    Call it on exploded trial rows (as :func:`showdowns` does): the explode
    keeps the optimizer from inlining these columns into the join keys above.
    """
    x = F.col("_x")
    d = [(x % 47).cast("int"), (F.floor(x / 47) % 46).cast("int"),
         (F.floor(x / (47 * 46)) % 45).cast("int"), (F.floor(x / (47 * 46 * 45)) % 44).cast("int")]
    df = df.withColumn("_i1", d[0])
    df = df.withColumn("_i2", _nth_free(d[1], [F.col("_i1")]))
    lo, hi = F.least("_i1", "_i2"), F.greatest("_i1", "_i2")
    df = df.withColumn("_i3", _nth_free(d[2], [lo, hi]))
    a, c = F.least("_i1", "_i2", "_i3"), F.greatest("_i1", "_i2", "_i3")
    b = F.col("_i1") + F.col("_i2") + F.col("_i3") - a - c
    df = df.withColumn("_i4", _nth_free(d[3], [a, b, c]))
    df = df.select("*", *[_unseen_card(F.col(f"_i{i}")).alias(name)
                          for i, name in zip(range(1, 5), ["_o1", "_o2", "_b1", "_b2"])])
    return df.drop("_i1", "_i2", "_i3", "_i4")


def showdowns(df: DataFrame, n: int, seed: int, valid: Column | None = None, opponent: bool = True) -> DataFrame:
    """Adds one row per trial (``_t``) with both rank values and ``_score``.

    ``df`` needs card-number columns ``_k1.._k5`` and ``_code``; rows where
    ``valid`` is false keep one row with null trial and score.
    """
    seq = F.sequence(F.lit(1), F.lit(n))
    if valid is not None:
        seq = F.when(valid, seq)
    # card sums of the hand and of the flop are per hand: computed once, before the explode
    hole_p, hole_m = card_sums([F.col("_k1"), F.col("_k2")])
    flop_p, flop_m = card_sums([F.col(f"_k{i}") for i in (3, 4, 5)])
    df = df.select("*", hole_p.alias("_hole_p"), hole_m.alias("_hole_m"),
                   flop_p.alias("_flop_p"), flop_m.alias("_flop_m"))
    trials = df.select("*", F.explode_outer(seq).alias("_t"))
    trials = trials.withColumn("_x", draw_number(F.col("_code"), F.col("_t"), seed))
    trials = _draw_cards(trials)
    turn_p, turn_m = card_sums([F.col("_b1"), F.col("_b2")])
    opp_p, opp_m = card_sums([F.col("_o1"), F.col("_o2")])
    trials = trials.select("*", (F.col("_flop_p") + turn_p).alias("_board_p"),
                           (F.col("_flop_m") + turn_m).alias("_board_m"),
                           opp_p.alias("_opp_p"), opp_m.alias("_opp_m"))
    trials = trials.withColumn("_pl_p", F.col("_hole_p") + F.col("_board_p")) \
                   .withColumn("_pl_m", F.col("_hole_m") + F.col("_board_m"))
    trials = best_of_seven_from_sums(trials, "_pl_p", "_pl_m", "_player_rank")
    if not opponent:
        return trials
    trials = trials.withColumn("_op_p", F.col("_opp_p") + F.col("_board_p")) \
                   .withColumn("_op_m", F.col("_opp_m") + F.col("_board_m"))
    trials = best_of_seven_from_sums(trials, "_op_p", "_op_m", "_opponent_rank")
    score = (F.when(F.col("_player_rank") < F.col("_opponent_rank"), 1.0)
             .when(F.col("_player_rank") == F.col("_opponent_rank"), 0.5).otherwise(0.0))
    return trials.withColumn("_score", F.when(F.col("_t").isNotNull(), score))


def _regroup(trials: DataFrame, cols: list[str], per_row: Column, out_col: str, value: Column) -> DataFrame:
    """Collect the trials of each input row back into that row.

    Rows are grouped by (input partition id, the row's own columns): every
    trial of a row carries both, and identical rows of one input partition
    share their draws, so they can share a group; the group's row count
    divided by the trials per row restores how many copies there were. The
    key is stable when a task is recomputed (partition ids and partition
    contents are), unlike a generated row id, and a hand repeated across the
    whole data set still forms one small group per input partition.
    """
    agg = trials.groupBy("_pid", "_valid", *cols).agg(value.alias("_value"), F.count(F.lit(1)).alias("_rows"))
    copies = (F.col("_rows") / F.when(F.col("_valid"), F.lit(per_row)).otherwise(F.lit(1))).cast("long")
    return agg.select(*cols, F.col("_value").alias(out_col), F.explode(F.sequence(F.lit(1), copies)).alias("_copy")) \
              .drop("_copy")


def _prepare(df: DataFrame, partitions: int | None) -> DataFrame:
    base = df.repartition(partitions) if partitions else df
    valid = (F.size(invalid_columns()) == 0) & ~F.coalesce(has_repeated_card(), F.lit(False))
    base = base.select("*", F.spark_partition_id().alias("_pid"), valid.alias("_valid"),
                       *[F.when(valid, card_index(i)).cast("int").alias(f"_k{i}") for i in range(1, 6)])
    base = base.withColumn("_code", hand_code([F.col(f"_k{i}") for i in range(1, 6)]))
    return with_seen_offsets(base)


def with_win_share(df: DataFrame, n: int = 10, seed: int = 0, out_col: str = "equity",
                   partitions: int | None = None) -> DataFrame:
    """Add the simulated win share of the five cards S1,C1..S5,C5.

    Rows with an out-of-range or repeated card get null. Trials are exploded
    and ranked where the rows are (broadcast lookups, no shuffle) and summed
    back per row with one partial aggregation, so the only shuffle carries
    one small row per input row. ``partitions`` optionally spreads the input
    round-robin first (for inputs arriving in too few partitions).
    Run :func:`cardlens.session.apply_runtime_conf` on the session first: the
    stage is wide enough to need ``spark.sql.codegen.hugeMethodLimit=8000``.
    """
    cols = df.columns
    trials = showdowns(_prepare(df, partitions), n, seed, F.col("_valid"))
    share = F.bround(F.sum("_score") / F.count(F.lit(1)), 2)
    return _regroup(trials, cols, n, out_col, share)


def exact_win_share(df: DataFrame, out_col: str = "exact_equity") -> DataFrame:
    """The seedless limit of C5 — every run-out, for a small set of hands.

    Enumerates all C(47,2) = 1,081 turn/river pairs and, for each, all
    C(45,2) = 990 opponent hands: 1,070,190 showdowns per input row. Meant
    for a handful of rows (a reference value for C5's sampling error).
    """
    spark = df.sparkSession
    cols = df.columns
    nparts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = _prepare(df, nparts)
    seen = F.array(*[F.col(f"_k{i}") for i in range(1, 6)])
    base = base.withColumn("_rem", F.array_except(F.sequence(F.lit(0), F.lit(51)), seen))
    # turn/river pair (i < j) over the 47 unseen cards; a row with bad cards keeps one null row
    b = base.select("*", F.explode_outer(F.when(F.col("_valid"), F.sequence(F.lit(0), F.lit(45)))).alias("_i"))
    b = b.select("*", F.explode_outer(F.sequence(F.col("_i") + 1, F.lit(46))).alias("_j"))
    b = b.withColumn("_b1", F.get("_rem", "_i")).withColumn("_b2", F.get("_rem", "_j"))
    b = best_of_seven(b, ["_k1", "_k2", "_k3", "_k4", "_k5", "_b1", "_b2"], "_player_rank")
    b = b.withColumn("_rest", F.array_except("_rem", F.array("_b1", "_b2")))
    # opponent pair (u < v) over the 45 cards left
    o = b.select("*", F.explode_outer(F.when(F.col("_valid"), F.sequence(F.lit(0), F.lit(43)))).alias("_u"))
    o = o.select("*", F.explode_outer(F.sequence(F.col("_u") + 1, F.lit(44))).alias("_v"))
    o = o.withColumn("_o1", F.get("_rest", "_u")).withColumn("_o2", F.get("_rest", "_v"))
    o = best_of_seven(o, ["_o1", "_o2", "_k3", "_k4", "_k5", "_b1", "_b2"], "_opponent_rank")
    score = (F.when(F.col("_player_rank") < F.col("_opponent_rank"), 1.0)
             .when(F.col("_player_rank") == F.col("_opponent_rank"), 0.5).otherwise(0.0))
    return _regroup(o, cols, 1081 * 990, out_col, F.avg(F.when(F.col("_valid"), score)))
