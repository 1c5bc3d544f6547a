import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cardlens.operators import ranks, relative
from cardlens.sources import derived
from conftest import SF_SMALL, by_id, with_id

COLS = ["current_hand_class_value", "current_hand_rank_value"]


@pytest.fixture(scope="module")
def fixture_df(spark):
    return with_id(spark, [(1, 10), (1, 20), (1, 30), (2, 500), (2, 600), (3, 42), (4, 7), (4, 7), (4, 9)], COLS)


def test_z_cdf_percent_rank_on_fixture(fixture_df):
    out = relative.with_relative_features(fixture_df)
    z = by_id(out, "relative_rank_z")
    assert z[0] == pytest.approx(-1.0, abs=1e-6) and z[1] == pytest.approx(0.0, abs=1e-9)
    assert z[2] == pytest.approx(1.0, abs=1e-6)
    assert z[5] is None  # one-row class: stddev undefined
    cdf = by_id(out, "relative_rank_cdf")
    assert cdf[0] == pytest.approx(1 / 3) and cdf[1] == pytest.approx(2 / 3) and cdf[2] == 1.0
    assert cdf[6] == pytest.approx(2 / 3) and cdf[7] == pytest.approx(2 / 3) and cdf[8] == 1.0  # ties
    g = by_id(out, "global_rank_strenght")
    assert g[4] == 0.0            # worst (largest) rank value
    assert g[6] == g[7] == pytest.approx(7 / 8)  # best rank value, tied: 7 rows rank worse


def test_single_row_gives_zero(spark):
    out = relative.global_rank_strength(with_id(spark, [(1, 5)], COLS))
    assert out.first()["global_rank_strenght"] == 0.0


def test_count_form_equals_window_functions(spark):
    r = ranks.with_rank_value(derived.hands(spark, SF_SMALL)).withColumn("rid", F.monotonically_increasing_id())
    r = r.cache()
    cls = Window.partitionBy("current_hand_class_value")
    ref = r.select(
        "rid",
        ((F.col("current_hand_rank_value") - F.avg("current_hand_rank_value").over(cls))
         / (F.stddev("current_hand_rank_value").over(cls) + 1e-9)).alias("z"),
        F.cume_dist().over(cls.orderBy("current_hand_rank_value")).alias("cdf"),
        F.percent_rank().over(Window.orderBy(F.desc("current_hand_rank_value"))).alias("g"))
    got = relative.with_relative_features(r).select("rid", "relative_rank_z", "relative_rank_cdf", "global_rank_strenght")
    joined = ref.join(got, "rid").collect()
    assert len(joined) == r.count()
    for row in joined:
        if row["z"] is None:
            assert row["relative_rank_z"] is None
        else:
            assert row["relative_rank_z"] == pytest.approx(row["z"], abs=1e-9)
        assert row["relative_rank_cdf"] == pytest.approx(row["cdf"], abs=1e-12)
        assert row["global_rank_strenght"] == pytest.approx(row["g"], abs=1e-12)


def test_no_window_over_full_input(spark):
    r = ranks.with_rank_value(derived.hands(spark, SF_SMALL))
    plan = relative.with_relative_features(r)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Window" not in plan


def test_a_large_lookup_is_not_broadcast(spark):
    df = spark.range(2000).select(F.col("id").alias("v"), (F.col("id") % 3).alias("c"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        plan = relative.with_relative_features(df, "v", "c")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_any_values_and_classes_equal_window_functions(spark):
    """Values beyond the rank table that repeat across classes, nulls in both columns, one-row classes."""
    rows = [(i, (i * 7919) % 23 * 1000 - 5000 if i % 11 else None, i % 4 if i % 13 else None) for i in range(300)]
    rows += [(900, 5, 77), (901, None, 78), (902, 8000, 1), (903, 8000, 2)]
    df = spark.createDataFrame(rows, "rid int, v int, c int")
    cls = Window.partitionBy("c")
    ref = {r["rid"]: r for r in df.select(
        "rid", ((F.col("v") - F.avg("v").over(cls)) / (F.stddev("v").over(cls) + 1e-9)).alias("z"),
        F.cume_dist().over(cls.orderBy(F.col("v").asc_nulls_first())).alias("cdf"),
        F.percent_rank().over(Window.orderBy(F.col("v").desc_nulls_last())).alias("g")).collect()}
    got = relative.with_relative_features(df, "v", "c").collect()
    assert sorted(r["rid"] for r in got) == sorted(ref)
    for r in got:
        e = ref[r["rid"]]
        assert (r["relative_rank_z"] is None) == (e["z"] is None)
        if e["z"] is not None:
            assert r["relative_rank_z"] == pytest.approx(e["z"], abs=1e-9)
        assert r["relative_rank_cdf"] == pytest.approx(e["cdf"]) and r["global_rank_strenght"] == pytest.approx(e["g"])
    assert relative.with_relative_features(df.limit(0), "v", "c").count() == 0


def test_a_lookup_with_two_values_for_a_key_is_an_error(spark, fixture_df):
    twice = spark.createDataFrame([(10, 0.5), (10, 0.6)], "current_hand_rank_value long, relative_rank_cdf double")
    with pytest.raises(Exception, match="more than one"):
        relative.with_relative_features(fixture_df, lookup=twice).collect()
    same = spark.createDataFrame([(10, 0.5), (10, 0.5)], "current_hand_rank_value long, relative_rank_cdf double")
    assert relative.with_relative_features(fixture_df, lookup=same).count() == fixture_df.count()


def test_lookup_join_takes_every_key_and_fills_all_columns(spark):
    feats = spark.createDataFrame([(1, 8000, None, None), (2, 5, True, "t"), (3, None, False, "u")],
                                  "row_id int, current_hand_rank_value int, flag boolean, name string")
    lookup = spark.createDataFrame([(8000, 1.5, 0.5, 0.25)], "current_hand_rank_value int, relative_rank_z double, "
                                   "relative_rank_cdf double, global_rank_strenght double")
    got = {r["row_id"]: tuple(r)[1:] for r in relative.join_lookup(feats, lookup).select(
        "row_id", "current_hand_rank_value", "flag", "name", "relative_rank_z").collect()}
    assert got == {1: (8000, False, "0", 1.5), 2: (5, True, "t", 0.0), 3: (0, False, "u", 0.0)}


def test_lookup_join_fills_misses_with_zero(spark, fixture_df):
    lookup = relative.relative_lookup(fixture_df.filter(F.col("current_hand_class_value") == 1))
    out = relative.join_lookup(fixture_df, lookup)
    z = by_id(out, "relative_rank_z")
    assert z[3] == 0.0 and z[4] == 0.0
    assert z[0] == pytest.approx(-1.0, abs=1e-6)


def test_stateful_lookup_one_row_per_rank(fixture_df):
    feats = relative.with_relative_features(fixture_df)
    lk = relative.stateful_lookup(feats.filter("current_hand_class_value < 9"))
    assert lk.count() == feats.select("current_hand_rank_value").distinct().count()


def test_given_lookup_is_reused(spark, fixture_df):
    lookup = relative.relative_lookup(fixture_df)
    a = relative.with_relative_features(fixture_df).select("row_id", "relative_rank_cdf")
    b = relative.with_relative_features(fixture_df, lookup=lookup).select("row_id", "relative_rank_cdf")
    assert by_id(a, "relative_rank_cdf") == by_id(b, "relative_rank_cdf")
    written = spark.createDataFrame(lookup.collect(), lookup.schema)   # a lookup from elsewhere
    c = relative.with_relative_features(fixture_df, lookup=written).select("row_id", "relative_rank_cdf")
    assert by_id(c, "relative_rank_cdf") == by_id(a, "relative_rank_cdf")
