import itertools
import random

import pytest
from pyspark.sql import functions as F

from cardlens.config import CLASS_UPPER_BOUNDS
from cardlens.operators import ranks
from conftest import CARD_COLS, with_id


def _strength(rs, flush):
    """Plain-Python hand strength: (category, tiebreak) with smaller category = better."""
    counts = {r: rs.count(r) for r in set(rs)}
    groups = sorted(counts.items(), key=lambda kv: (-kv[1], -kv[0]))
    shape = tuple(c for _, c in groups)
    distinct = sorted(set(rs), reverse=True)
    straight_high = None
    if len(distinct) == 5:
        if distinct[0] - distinct[4] == 4:
            straight_high = distinct[0]
        elif distinct == [14, 5, 4, 3, 2]:
            straight_high = 5
    if flush and straight_high:
        return (0, (straight_high,))
    if shape == (4, 1):
        return (1, tuple(r for r, _ in groups))
    if shape == (3, 2):
        return (2, tuple(r for r, _ in groups))
    if flush:
        return (3, tuple(distinct))
    if straight_high:
        return (4, (straight_high,))
    cat = {(3, 1, 1): 5, (2, 2, 1): 6, (2, 1, 1, 1): 7, (1, 1, 1, 1, 1): 8}[shape]
    return (cat, tuple(r for r, _ in groups))


@pytest.fixture(scope="module")
def table(spark):
    return ranks.cached_rank_table(spark).collect()


def test_rank_table_size_and_class_bounds(table):
    assert len(table) == 7462
    assert sorted(r["rank_value"] for r in table) == list(range(1, 7463))
    lo = 1
    for cls, hi in enumerate(CLASS_UPPER_BOUNDS):
        in_class = [r["rank_value"] for r in table if r["rank_class"] == cls]
        assert min(in_class) == lo and max(in_class) == hi
        lo = hi + 1


def test_rank_table_order_matches_plain_python(table):
    classes = []
    for rs in itertools.combinations_with_replacement(range(2, 15), 5):
        if len(set(rs)) == 1:
            continue
        classes.append((list(rs), False))
        if len(set(rs)) == 5:
            classes.append((list(rs), True))
    assert len(classes) == 7462
    expected = sorted(classes, key=lambda c: (_strength(c[0], c[1])[0], tuple(-x for x in _strength(c[0], c[1])[1])))
    expected_rank = {(tuple(sorted(rs, reverse=True)), fl): i + 1 for i, (rs, fl) in enumerate(expected)}
    for r in table:
        key = (tuple(r[f"r{i}"] for i in range(1, 6)), r["is_flush"])
        assert expected_rank[key] == r["rank_value"], key


def test_rank_class_of_bounds(spark):
    df = spark.createDataFrame([(v,) for v in [1, 2, 10, 11, 166, 167, 1599, 1600, 1609, 1610, 6185, 6186, 7462]], "v int")
    got = [r["c"] for r in df.select(ranks.rank_class_of(F.col("v")).alias("c")).collect()]
    assert got == [0, 1, 1, 2, 2, 3, 4, 5, 5, 6, 8, 9, 9]


def test_seven_card_table_sizes(spark):
    t = ranks.cached_seven_card_table(spark)
    counts = {r["f"]: r["n"] for r in t.groupBy((F.col("lookup_key") >= ranks.FLUSH_OFFSET).alias("f"))
              .agg(F.count("*").alias("n")).collect()}
    assert counts == {False: 49205, True: 4719}


def test_best_of_seven_matches_brute_force(spark, table):
    """Seven-card lookup equals the best of the 21 five-card subsets ranked by the rank table."""
    five = {}
    for r in table:
        rs = [r[f"r{i}"] for i in range(1, 6)]
        five[(tuple(rs), r["is_flush"])] = r["rank_value"]

    def rank5(cards):
        hi = sorted(((k % 13 + 12) % 13 + 2 for k in cards), reverse=True)
        flush = len({k // 13 for k in cards}) == 1
        return five[(tuple(hi), flush)]

    rnd = random.Random(11)
    draws = []
    for i in range(3000):
        if i % 3 == 0:   # force many flushes
            suit = rnd.randrange(4)
            suited = rnd.sample(range(13 * suit, 13 * suit + 13), 5 + rnd.randrange(3))
            rest = rnd.sample([k for k in range(52) if k not in suited], 7 - len(suited))
            draws.append(suited + rest)
        else:
            draws.append(rnd.sample(range(52), 7))
    cols = [f"k{i}" for i in range(7)]
    df = with_id(spark, draws, cols)
    got = {r["row_id"]: r["best"] for r in ranks.best_of_seven(df, cols, "best").collect()}
    for i, d in enumerate(draws):
        expected = min(rank5(c) for c in itertools.combinations(d, 5))
        assert got[i] == expected, d


def test_rank_join_is_broadcast(spark):
    df = with_id(spark, [(1, 10, 1, 11, 1, 12, 1, 13, 1, 1)], CARD_COLS)
    plan = ranks.with_rank_value(df)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_out_of_range_cards_get_no_rank(spark):
    rows = [(1, 14, 2, 2, 3, 3, 4, 4, 1, 5), (0, 1, 2, 2, 3, 3, 4, 4, 1, 5), (None, 1, 2, 2, 3, 3, 4, 4, 1, 5),
            (1, 1, 2, 2, 3, 3, 4, 4, 1, 5)]
    out = ranks.with_rank_value(with_id(spark, rows, CARD_COLS))
    got = {r["row_id"]: r["current_hand_rank_value"] for r in out.collect()}
    assert got[0] is None and got[1] is None and got[2] is None and got[3] is not None
