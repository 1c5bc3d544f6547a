"""What keeps the queries in proportion to their input."""

import importlib

from pyspark.sql import functions as F

from cardlens.session import RUNTIME_CONF
from cardlens.sources import derived

E = importlib.import_module("__spark_entry__")
LIMIT = "spark.sql.codegen.hugeMethodLimit"


def dealt(code):
    """Five cards by taking them out of a list, as the deal is defined; a negative digit ends the hand."""
    deck, cards, rest = list(range(52)), [], code
    for base in (52, 51, 50, 49, 48):
        digit = None if rest is None or rest < 0 else rest % base
        if digit is None or None in cards:
            cards.append(None)
            continue
        cards.append(deck.pop(digit))
        rest //= base
    return [x for k in cards for x in ((None, None) if k is None else (k // 13 + 1, k % 13 + 1))]


def test_decoded_hands_equal_brute_force(spark):
    codes = [0, 1, 51, 52, 2651, 2652, 311875199, None, -1, -53, *range(7, 311875200, 1234567)]
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "l_orderkey long, code long") \
        .select("l_orderkey", F.lit(1).alias("l_linenumber"), F.lit(2).alias("l_partkey"), F.lit(3).alias("l_suppkey"),
                F.lit(None).cast("timestamp").alias("ship_ts"), "code")
    got = {r["l_orderkey"]: [r[f"{p}{i}"] for i in range(1, 6) for p in "SC"] for r in derived.hands_from_code(rows).collect()}
    assert got == {i: dealt(c) for i, c in enumerate(codes)}


def test_decoding_needs_no_deck_per_row_and_is_compiled_on_any_session(spark, tmp_path):
    """A session made by a launcher has Spark's own limit; the decoding stage ran interpreted there."""
    spark.createDataFrame([(1, 2, 3, 4)], "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long") \
        .withColumn("l_shipdate", F.lit("2020-01-01").cast("timestamp")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.conf.set(LIMIT, "65535")
    try:
        plan = E.queries()["c3_rank_class"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
        assert "array_remove" not in plan
        assert int(spark.conf.get(LIMIT)) <= 8000
    finally:
        spark.conf.set(LIMIT, RUNTIME_CONF[LIMIT])


def test_guard_counts_the_whole_table(spark, tmp_path):
    """Two windows of the newest rows and the table: every row of it is found."""
    from cardlens.plans.queries_stats import SHORT_OF

    spark.range(1500).select(F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.lit(2).cast("long").alias("l_partkey"),
                             F.lit(3).cast("long").alias("l_suppkey"), F.lit("2020-01-01").cast("timestamp").alias("l_shipdate")) \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = E.queries()["e8_min_rows_guard"](spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in rows) == [(999, 1000, False), (1000, 1000, True), (1500, SHORT_OF, False)]


def test_forest_keeps_no_node_per_row_and_tree_and_small_groups():
    from cardlens.operators.model import build_pipeline

    forest = build_pipeline().getStages()[1]
    assert not forest.getCacheNodeIds() and forest.getMaxMemoryInMB() <= 64
    assert forest.getNumTrees() == 100 and forest.getMaxDepth() == 10 and forest.getFeatureSubsetStrategy() == "all"


def test_groups_of_nodes_fit_a_cache_and_leave_the_model_as_it_is(spark):
    """Groups of 32 MB were added to from memory, not from cache, in every pass over the rows."""
    from dataclasses import replace

    from cardlens.config import DEFAULT_CONFIG
    from cardlens.operators.model import build_pipeline

    rows = spark.range(3000).select((F.col("id") % 53).alias("a"), (F.col("id") * 7919 % 101).alias("b"),
                                    ((F.col("id") * 31 % 97) / 97).alias("equity")).coalesce(1)
    pipeline, shapes = build_pipeline(replace(DEFAULT_CONFIG, max_depth=4), ("a", "b"), num_trees=3), []
    assert pipeline.getStages()[1].getMaxMemoryInMB() <= 8
    for size in (pipeline.getStages()[1].getMaxMemoryInMB(), 0):
        pipeline.getStages()[1].setMaxMemoryInMB(size)
        shapes.append([t._call_java("toDebugString").split("\n", 1)[1] for t in pipeline.fit(rows).stages[1].trees])
    assert len(shapes[0]) == 3 and shapes[0] == shapes[1]


def test_refreshed_batches_are_written_by_many_tasks(spark, monkeypatch):
    import os

    from conftest import SF_SMALL
    from cardlens.plans import queries_more

    roots, path = [], queries_more.scratch_path
    monkeypatch.setattr(queries_more, "scratch_path", lambda *a: roots.append(path(*a)) or roots[-1])
    rows = E.queries()["j1_refresh_stream"](spark, SF_SMALL)
    assert {r["version"] for r in rows.select("version").distinct().collect()} == set(queries_more._GIVEN)
    assert len([f for f in os.listdir(f"{roots[0]}/in") if f.endswith(".parquet")]) > len(queries_more._GIVEN)


def test_a_file_of_one_row_group_is_dealt_over_all_tasks(spark, tmp_path):
    """Spark cuts a large file into enough parts, but one row group is read by one task, which did the whole work."""
    spark.range(5000).select(F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), (F.col("id") % 7).alias("l_partkey"),
                             (F.col("id") % 3).alias("l_suppkey"), F.lit("2020-01-01").cast("timestamp").alias("l_shipdate")) \
        .coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    keys, tasks = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"], spark.sparkContext.defaultParallelism
    before = [spark.conf.get(k) for k in keys]
    for k in keys:
        spark.conf.set(k, "256")
    try:
        assert spark.read.parquet(f"{tmp_path}/lineitem.parquet").rdd.getNumPartitions() > tasks
        by_part = derived.hands(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)
    assert sum(r["count"] for r in by_part) == 5000
    assert len(by_part) >= tasks and max(r["count"] for r in by_part) < 2 * 5000 / tasks


def test_passes_over_the_training_rows_hash_no_keys(spark, tmp_path):
    """A fit reads its rows in several passes, each of which told the train part by an md5 of the row keys again."""
    from cardlens.config import DEFAULT_CONFIG
    from cardlens.operators import sampling
    from cardlens.plans import queries_ops

    spark.range(600).select((F.col("id") % 599).alias("l_orderkey"), F.when(F.col("id") % 5 != 0, 1).alias("l_linenumber"), (F.col("id") % 7).alias("l_partkey"),
                            (F.col("id") % 3).alias("l_suppkey"), F.lit("2020-01-01").cast("timestamp").alias("l_shipdate")) \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    parts = queries_ops.training_parts(spark, str(tmp_path))
    table = parts[0].unionByName(parts[1])
    hashed = sampling.train_test_split(table, DEFAULT_CONFIG.test_size, queries_ops.SAMPLE_KEYS, DEFAULT_CONFIG.split_seed)
    assert sum(p.count() for p in parts) == 600 and all(p.count() for p in parts)
    for part, again in zip(parts, hashed):
        assert part.columns == again.columns and part.exceptAll(again).isEmpty() and again.exceptAll(part).isEmpty()
        assert "md5" not in part._jdf.queryExecution().executedPlan().toString()
