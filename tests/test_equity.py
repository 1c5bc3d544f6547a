import hashlib

import pytest
from pyspark.sql import functions as F

from cardlens.operators import equity
from cardlens.sources import derived
from conftest import CARD_COLS, SF_MID, SF_SMALL, by_id, with_id

ROYAL = (1, 10, 1, 11, 1, 12, 1, 13, 1, 1)
REPEATED = (2, 2, 2, 3, 1, 5, 1, 5, 1, 9)


def test_royal_flush_always_wins_and_repeated_cards_are_rejected(spark):
    df = with_id(spark, [ROYAL, REPEATED, ROYAL], CARD_COLS)
    out = equity.with_win_share(df, n=10, seed=0)
    eq = by_id(out, "equity")
    assert eq[0] == 1.0 and eq[2] == 1.0
    assert eq[1] is None


def test_duplicate_rows_are_kept(spark):
    df = spark.createDataFrame([ROYAL, ROYAL, (2, 2, 3, 7, 1, 9, 4, 11, 1, 13)], CARD_COLS)
    out = equity.with_win_share(df, n=10, seed=3)
    assert out.count() == 3
    assert out.filter(F.col("C5") == 1).select("equity").distinct().count() == 1


def _draw_python(code, trial, seed, seen):
    x = int(hashlib.md5(f"{code}|{trial}|{seed}".encode()).hexdigest()[:8], 16) % (47 * 46 * 45 * 44)
    rem = [k for k in range(52) if k not in seen]
    out = []
    for base in (47, 46, 45, 44):
        k = rem[x % base]
        x //= base
        out.append(k)
        rem.remove(k)
    return out


def test_draws_match_the_documented_rule(spark):
    h = derived.hands(spark, SF_SMALL).limit(50)
    k = h.select("l_orderkey", "l_linenumber", "code", *[((F.col(f"S{i}") - 1) * 13 + F.col(f"C{i}") - 1).cast("int")
                                                         .alias(f"_k{i}") for i in range(1, 6)])
    k = k.withColumn("_code", equity.hand_code([F.col(f"_k{i}") for i in range(1, 6)])) \
         .withColumn("_t", F.lit(2)).withColumn("_x", equity.draw_number(F.col("_code"), F.col("_t"), 5))
    rows = equity._draw_cards(equity.with_seen_offsets(k)).collect()
    assert rows
    for r in rows:
        seen = [r[f"_k{i}"] for i in range(1, 6)]
        code = 0
        for c in seen:
            code = code * 52 + c
        assert code == r["_code"]
        assert [r["_o1"], r["_o2"], r["_b1"], r["_b2"]] == _draw_python(code, 2, 5, seen)


def test_mean_equity_is_one_half(spark):
    out = equity.with_win_share(derived.hands(spark, SF_MID), n=10, seed=0)
    row = out.agg(F.avg("equity").alias("m"), F.count("equity").alias("n"), F.count("*").alias("rows")).first()
    assert row["n"] == row["rows"] == 60000
    assert abs(row["m"] - 0.5) < 0.01


def test_simulation_is_single_shuffle(spark):
    out = equity.with_win_share(derived.hands(spark, SF_SMALL), n=10, seed=0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # at most one shuffle brings each row's trials together (none when the input is
    # already hash-partitioned on some of its columns); the lookups are broadcast
    assert plan.count("Exchange hashpartitioning(_pid") <= 1
    assert "SortAggregate" not in plan
    assert plan.count("BroadcastHashJoin") >= 2


@pytest.mark.slow
def test_exact_win_share_close_to_simulation(spark):
    hand = (3, 1, 4, 1, 1, 9, 2, 5, 3, 12)   # pair of aces, rag flop
    df = with_id(spark, [hand], CARD_COLS)
    exact = equity.exact_win_share(df).first()["exact_equity"]
    sim = equity.with_win_share(df, n=400, seed=1).first()["equity"]
    assert 0.0 < exact < 1.0
    assert abs(exact - sim) < 0.1


@pytest.mark.slow
def test_exact_win_share_equals_plain_enumeration(spark):
    """C6 against a plain-Python enumeration of every run-out (same seven-card table)."""
    import itertools

    from cardlens.operators import ranks
    table = {r["lookup_key"]: r["rank_value"] for r in ranks.cached_seven_card_table(spark).collect()}
    pow5 = ranks.CARD_POW5
    bits = ranks.CARD_BIT

    def rank7(cards):
        p = sum(pow5[c] for c in cards)
        m = sum(bits[c] for c in cards)
        for s in range(4):
            sl = (m >> (13 * s)) & 8191
            if bin(sl).count("1") >= 5:
                return table[ranks.FLUSH_OFFSET + sl]
        return table[p]

    hand = (2, 13, 2, 12, 3, 2, 2, 7, 4, 9)   # suited K-Q of spades, one spade on the flop
    ks = [(hand[2 * i] - 1) * 13 + hand[2 * i + 1] - 1 for i in range(5)]
    rest = [k for k in range(52) if k not in ks]
    total = wins = 0.0
    for b1, b2 in itertools.combinations(rest, 2):
        board = ks[2:] + [b1, b2]
        mine = rank7(ks[:2] + board)
        left = [k for k in rest if k not in (b1, b2)]
        for o1, o2 in itertools.combinations(left, 2):
            theirs = rank7([o1, o2] + board)
            wins += 1.0 if mine < theirs else 0.5 if mine == theirs else 0.0
            total += 1
    got = equity.exact_win_share(with_id(spark, [hand], CARD_COLS)).first()["exact_equity"]
    assert total == 1081 * 990
    assert got == pytest.approx(wins / total, abs=1e-12)


def test_partitions_option_and_bad_rows_kept(spark):
    hands = derived.hands(spark, SF_SMALL).limit(300)
    a = {r["code"]: r["equity"] for r in equity.with_win_share(hands, n=6, seed=2).collect()}
    b = {r["code"]: r["equity"] for r in equity.with_win_share(hands, n=6, seed=2, partitions=3).collect()}
    assert a == b
    df = with_id(spark, [REPEATED], CARD_COLS)
    out = equity.exact_win_share(df).collect()
    assert len(out) == 1 and out[0]["exact_equity"] is None


def test_hot_hand_a_third_of_rows_stays_whole(spark):
    """A hand repeated across many partitions: every copy is returned, all with the same label."""
    hot = (3, 1, 4, 1, 1, 9, 2, 5, 3, 12)
    others = derived.hands(spark, SF_SMALL).select(*CARD_COLS).limit(2000)
    hot_rows = spark.createDataFrame([hot] * 1000, CARD_COLS)
    df = others.unionByName(hot_rows).repartition(8)
    out = equity.with_win_share(df, n=5, seed=1)
    assert out.count() == 3000
    hot_out = out.filter((F.col("S1") == 3) & (F.col("C1") == 1) & (F.col("S2") == 4) & (F.col("C2") == 1)
                         & (F.col("S3") == 1) & (F.col("C3") == 9) & (F.col("S4") == 2) & (F.col("C4") == 5)
                         & (F.col("S5") == 3) & (F.col("C5") == 12))
    assert hot_out.count() >= 1000
    assert hot_out.select("equity").distinct().count() == 1
