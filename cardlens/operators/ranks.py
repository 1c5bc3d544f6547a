"""Hand ranking as table joins.

Every five-card poker hand falls in one of 7,462 equivalence classes, ranked
1 (royal flush) to 7,462 (seven-high). Instead of evaluating hands row by row
in Python, the engine builds two small, fixed-size lookup tables once per
session with DataFrame operations and joins hands to them:

* the **rank table** (7,462 rows, C1): one row per five-card class;
* the **seven-card table** (53,924 rows, C4): best five-of-seven rank for every
  7-rank multiset (49,205 rows) and every suited rank set of 5..7 cards
  (4,719 rows).

Both tables are keyed by one ``lookup_key``:

* no flush: ``sum(5 ** (r - 2))`` over the cards, ``r`` = 2..14 with the ace
  high (a base-5 count vector; no rank appears more than four times);
* flush: ``5 ** 13 + sum(2 ** (r - 2))`` over the cards of the flush suit.

With seven cards a flush beats every non-flush combination that can occur
alongside it (five suited cards have distinct ranks, so the two others make at
most trips or two pair), so a seven-card hand needs exactly one lookup.

Their size is set by the rules of the game, not by the data, so broadcasting
them is safe at any input size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import CLASS_UPPER_BOUNDS, RANK_CLASS, RANK_VALUE
from ..session import write_shared

FLUSH_OFFSET = 5 ** 13
WHEEL_MASK = (1 << 12) | 0b1111  # A, 5, 4, 3, 2

_TABLE_CACHE: dict = {}


def _sum(cols) -> Column:
    return reduce(lambda a, b: a + b, cols)


def _pow5(r: Column) -> Column:
    return F.pow(F.lit(5), r - 2).cast("long")


def _pow2(n: Column) -> Column:
    return F.pow(F.lit(2), n).cast("long")


def _bit(r: Column) -> Column:
    return _pow2(r - 2)


def _non_increasing(spark: SparkSession, n: int, strict: bool) -> DataFrame:
    """All rank tuples r1 >= r2 >= .. >= rn (or > when strict), ranks 2..14."""
    df = spark.range(2, 15).select(F.col("id").cast("int").alias("r1"))
    for i in range(2, n + 1):
        prev = F.col(f"r{i-1}")
        upper = prev - 1 if strict else prev
        df = df.filter(upper >= 2).select("*", F.explode(F.sequence(F.lit(2), upper)).alias(f"r{i}"))
    return df


def rank_class_of(rank_value: Column) -> Column:
    """Class 0..9 of a rank value from the class bounds."""
    expr = None
    for cls, upper in enumerate(CLASS_UPPER_BOUNDS):
        cond = rank_value <= upper
        expr = F.when(cond, F.lit(cls)) if expr is None else expr.when(cond, F.lit(cls))
    return expr.otherwise(F.lit(None).cast("int"))


def _five_card_classes(df: DataFrame, flush: bool) -> DataFrame:
    r = [F.col(f"r{i}") for i in range(1, 6)]
    # occurrences of each card's rank among the five
    cnt = [_sum([(r[i] == r[j]).cast("int") for j in range(5)]) for i in range(5)]
    equal_pairs = _sum([(r[i] == r[j]).cast("int") for i in range(5) for j in range(i + 1, 5)])
    first = [F.lit(True)] + [r[i] != r[i - 1] for i in range(1, 5)]
    # groups ordered by (count desc, rank desc) compare like this bit key
    group_key = _sum([F.when(first[i], _pow2((cnt[i] - 1) * 13 + r[i] - 2))
                      .otherwise(F.lit(0).cast("long")) for i in range(5)])
    mask = _sum([_bit(x) for x in r])
    straight = (equal_pairs == 0) & ((r[0] - r[4] == 4) | (mask == WHEEL_MASK))
    straight_high = F.when(mask == WHEEL_MASK, F.lit(5)).otherwise(r[0])
    if flush:
        cls = F.when(straight & (straight_high == 14), 0).when(straight, 1).otherwise(4)
        key = F.lit(FLUSH_OFFSET) + mask
    else:
        cls = (F.when(equal_pairs == 6, 2).when(equal_pairs == 4, 3).when(equal_pairs == 3, 6)
               .when(equal_pairs == 2, 7).when(equal_pairs == 1, 8)
               .when(straight, 5).otherwise(9))
        key = _sum([_pow5(x) for x in r])
    order_key = F.when(straight, straight_high.cast("long")).otherwise(group_key)
    return df.select(key.alias("lookup_key"), cls.alias("rank_class"), order_key.alias("order_key"),
                     F.lit(flush).alias("is_flush"), *r)


def build_rank_table(spark: SparkSession) -> DataFrame:
    """The 7,462 five-card classes, best first.

    Columns: lookup_key, rank_value (1..7462), rank_class (0..9), is_flush,
    r1..r5 (ranks 2..14, descending).
    """
    multisets = _non_increasing(spark, 5, strict=False).filter(F.col("r1") != F.col("r5"))
    suited = _non_increasing(spark, 5, strict=True)
    classes = _five_card_classes(multisets, flush=False).unionByName(_five_card_classes(suited, flush=True))
    # a fixed 7,462-row table: one ordered window over it is cheap at any data size
    w = Window.orderBy(F.col("rank_class"), F.col("order_key").desc())
    return classes.select("lookup_key", F.row_number().over(w).cast("int").alias("rank_value"),
                          "rank_class", "is_flush", *[f"r{i}" for i in range(1, 6)])


def build_seven_card_table(spark: SparkSession, rank_table: DataFrame | None = None) -> DataFrame:
    """C4: best five-card rank value for each seven-card lookup key.

    Non-flush keys: 7-rank multisets (each rank at most 4 times) -> minimum
    over the 21 five-card sub-multisets. Flush keys: suited rank sets of 5..7
    cards -> minimum over their five-card subsets as flushes.
    """
    rank_table = rank_table if rank_table is not None else cached_rank_table(spark)
    ranks5 = rank_table.select(F.col("lookup_key").alias("sub_key"), "rank_value", "is_flush")

    seven = _non_increasing(spark, 7, strict=False)
    seven = seven.filter(~((F.col("r1") == F.col("r5")) | (F.col("r2") == F.col("r6")) | (F.col("r3") == F.col("r7"))))
    pows = [_pow5(F.col(f"r{i}")) for i in range(1, 8)]
    key7 = _sum(pows)
    subsets = F.array(*[key7 - pows[i] - pows[j] for i in range(7) for j in range(i + 1, 7)])
    nonflush = (seven.select(key7.alias("lookup_key"), F.explode(F.array_distinct(subsets)).alias("sub_key"))
                .join(F.broadcast(ranks5.filter(~F.col("is_flush"))), "sub_key")
                .groupBy("lookup_key").agg(F.min("rank_value").alias("rank_value")))

    # suited rank sets of 5..7 cards; their five-card subsets come from dropping 0, 1 or 2 bits
    masks = (spark.range(0, 1 << 13).select(F.col("id").alias("mask"))
             .filter(F.bit_count("mask").between(5, 7)))
    bits = F.filter(F.sequence(F.lit(0), F.lit(12)),
                    lambda b: F.floor(F.col("mask") / F.pow(F.lit(2), b)) % 2 == 1)
    masks = masks.withColumn("_bits", bits)
    drop_one = F.transform("_bits", lambda b: F.col("mask") - F.pow(F.lit(2), b).cast("long"))
    drop_two = F.flatten(F.transform("_bits", lambda b1: F.transform(
        F.filter("_bits", lambda b2: b2 > b1),
        lambda b2: F.col("mask") - F.pow(F.lit(2), b1).cast("long") - F.pow(F.lit(2), b2).cast("long"))))
    subsets = (F.when(F.size("_bits") == 5, F.array(F.col("mask")))
               .when(F.size("_bits") == 6, drop_one).otherwise(drop_two))
    flush5 = ranks5.filter(F.col("is_flush")).select((F.col("sub_key") - FLUSH_OFFSET).alias("sub_mask"), "rank_value")
    flush = (masks.select("mask", F.explode(subsets).alias("sub_mask"))
             .join(flush5, "sub_mask")
             .groupBy("mask").agg(F.min("rank_value").alias("rank_value"))
             .select((F.col("mask") + FLUSH_OFFSET).alias("lookup_key"), "rank_value"))
    return nonflush.unionByName(flush).select("lookup_key", "rank_value", rank_class_of(F.col("rank_value")).alias("rank_class"))


def _cached(spark: SparkSession, name: str, build) -> DataFrame:
    key = (name, spark.sparkContext.applicationId)
    df = _TABLE_CACHE.get(key)
    if df is None:
        df = write_shared(build(), name)
        _TABLE_CACHE[key] = df
    return df


def cached_rank_table(spark: SparkSession) -> DataFrame:
    return _cached(spark, "rank5", lambda: build_rank_table(spark))


def cached_seven_card_table(spark: SparkSession) -> DataFrame:
    return _cached(spark, "rank7", lambda: build_seven_card_table(spark, cached_rank_table(spark)))


# ---- lookup keys of hands ------------------------------------------------
# Per-card constants indexed by card number k = 13 * (suit - 1) + (rank - 1):
# the base-5 digit weight of its rank and its bit in a 52-bit hand mask
# (13 bits per suit, ace highest). Both follow from the key definitions above.

def _ace_high_index(k: int) -> int:
    return (k % 13 + 12) % 13


CARD_POW5 = [5 ** _ace_high_index(k) for k in range(52)]
CARD_BIT = [1 << (13 * (k // 13) + _ace_high_index(k)) for k in range(52)]


def _card_array(values) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def card_sums(cards: list[Column]) -> tuple[Column, Column]:
    """(rank-digit sum, hand bit mask) of card-number columns; sums of disjoint cards add up."""
    pow5, bits = _card_array(CARD_POW5), _card_array(CARD_BIT)
    return _sum([F.get(pow5, c) for c in cards]), _sum([F.get(bits, c) for c in cards])


def lookup_key_from_sums(p: Column, m: Column) -> Column:
    """Lookup key from the two card sums; the flush test reads each suit's 13-bit slice of the mask.
    Only one suit can hold five of seven cards."""
    slices = [F.shiftright(m, 13 * s).bitwiseAND(F.lit(8191)) for s in range(4)]
    flush = F.coalesce(*[F.when(F.bit_count(x) >= 5, x) for x in slices])
    return F.when(flush.isNotNull(), F.lit(FLUSH_OFFSET).cast("long") + flush).otherwise(p)


def lookup_key_from_cards(df: DataFrame, cards: list[str], out_col: str) -> DataFrame:
    """Adds the lookup key of 5 or 7 cards given as 0..51 card-number columns.

    The key is built from two sums of per-card constants (rank digit weight and
    hand bit mask), see :func:`card_sums` and :func:`lookup_key_from_sums`.
    """
    p, m = card_sums([F.col(c) for c in cards])
    df = df.withColumn(f"{out_col}_p", p).withColumn(f"{out_col}_m", m)
    key = lookup_key_from_sums(F.col(f"{out_col}_p"), F.col(f"{out_col}_m"))
    return df.withColumn(out_col, key).drop(f"{out_col}_p", f"{out_col}_m")


def card_number(suit_col: Column, rank_col: Column) -> Column:
    """0..51 card number; null for a suit outside 1..4 or a rank outside 1..13 (no rank then)."""
    ok = suit_col.between(1, 4) & rank_col.between(1, 13)
    return F.when(ok, (suit_col - 1) * 13 + rank_col - 1).cast("int")


def with_rank_value(df: DataFrame, value_col: str = RANK_VALUE, class_col: str | None = RANK_CLASS) -> DataFrame:
    """C2 (+ C3): rank value of the five cards S1,C1..S5,C5 via a broadcast join.

    The rank table has 7,462 rows whatever the input size, so it is always
    broadcast; hands are never shuffled for this.
    """
    spark = df.sparkSession
    table = F.broadcast(cached_rank_table(spark).select(F.col("lookup_key").alias("_rk"),
                                                        F.col("rank_value").alias(value_col)))
    cards = [f"_c{i}" for i in range(1, 6)]
    keyed = df.select("*", *[card_number(F.col(f"S{i}"), F.col(f"C{i}")).alias(f"_c{i}") for i in range(1, 6)])
    keyed = lookup_key_from_cards(keyed, cards, "_rk").drop(*cards)
    out = keyed.join(table, "_rk", "left").drop("_rk")
    if class_col:
        out = out.withColumn(class_col, rank_class_of(F.col(value_col)))
    return out


def _seven_table(spark: SparkSession, key_col: str, out_col: str) -> DataFrame:
    return F.broadcast(cached_seven_card_table(spark).select(F.col("lookup_key").alias(key_col),
                                                             F.col("rank_value").alias(out_col)))


def best_of_seven(df: DataFrame, cards: list[str], out_col: str) -> DataFrame:
    """C4: rank value of the best five of seven cards (0..51 card-number columns)."""
    key_col = f"_k_{out_col}"
    return lookup_key_from_cards(df, cards, key_col).join(_seven_table(df.sparkSession, key_col, out_col),
                                                          key_col, "left").drop(key_col)


def best_of_seven_from_sums(df: DataFrame, p_col: str, m_col: str, out_col: str) -> DataFrame:
    """C4 from precomputed card sums of the seven cards (see :func:`card_sums`)."""
    key_col = f"_k_{out_col}"
    keyed = df.withColumn(key_col, lookup_key_from_sums(F.col(p_col), F.col(m_col)))
    return keyed.join(_seven_table(df.sparkSession, key_col, out_col), key_col, "left").drop(key_col)
