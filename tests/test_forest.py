"""The forest over packed rows against Spark ML's own, and scores against Spark ML's transform."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardlens.config import DEFAULT_CONFIG
from cardlens.operators import forest, runlog
from cardlens.operators import model as mdl
from cardlens.session import scratch_path

INPUTS = ("rank", "flag", "part", "suit")


def _rows(spark, n=20000, parts=5):
    noise = (F.pmod(F.xxhash64("id", F.lit(9)), F.lit(1000))) / 1000
    rows = spark.range(0, n, 1, parts).select(
        "id", *[F.pmod(F.xxhash64("id", F.lit(k)), F.lit(v)).cast("int").alias(c) for k, (c, v) in enumerate(zip(INPUTS, (400, 2, 11, 4)))])
    return rows.withColumn("part", F.col("part") / 4).withColumn(
        "equity", F.round(F.col("rank") / 400 + 0.3 * F.col("flag") * F.col("suit") + F.col("part") * F.col("rank") / 900 + noise / 2, 6))


def _shape(model):
    return [line.split("Predict")[0] for line in model.stages[1].toDebugString.split("\n")[1:]]


@pytest.fixture
def packed(monkeypatch):
    monkeypatch.setattr(mdl, "PACKED_ROWS", 0)
    monkeypatch.setattr(forest, "BLOCK_ROWS", 1500)


def test_packed_rows_give_the_trees_of_spark_ml(spark, packed, tmp_path):
    """Without a bootstrap there is one right forest: same splits, same means; bins, sisters and several parts of a level included."""
    cfg = replace(DEFAULT_CONFIG, max_depth=9, max_bins=32)
    _rows(spark, 10000).write.parquet(f"{tmp_path}/rows")  # as many rows as Spark ML finds its bins on, so both take all
    rows = spark.read.parquet(f"{tmp_path}/rows")
    known = mdl.build_pipeline(cfg, INPUTS, num_trees=2, bootstrap=False).fit(rows)
    grown = mdl.train(rows.unionByName(rows.limit(50).withColumn("equity", F.lit(None).cast("double"))), cfg, INPUTS, num_trees=2, bootstrap=False)
    assert _shape(grown) == _shape(known) and len(_shape(known)) > 600
    assert grown.stages[1].featureImportances.toArray() == pytest.approx(known.stages[1].featureImportances.toArray())
    both = mdl.predict(known, rows).withColumnRenamed("prediction", "p").select("id", "p").join(mdl.predict(grown, rows), "id")
    assert both.filter(F.abs(F.col("p") - F.col("prediction")) > 1e-12).count() == 0


def test_bootstrap_takes_every_row_and_does_not_depend_on_the_tasks(spark, packed, monkeypatch, tmp_path):
    cfg = replace(DEFAULT_CONFIG, max_depth=6)
    _rows(spark).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    model = mdl.train(rows, cfg, INPUTS, num_trees=4)
    monkeypatch.setattr(forest, "TASK_BLOCKS", 1)
    again = mdl.train(rows, cfg, INPUTS, num_trees=4)
    both = mdl.predict(again, rows).withColumnRenamed("prediction", "p").select("id", "p").join(mdl.predict(model, rows), "id")
    assert _shape(again) == _shape(model) and both.filter(F.abs(F.col("p") - F.col("prediction")) > 1e-12).count() == 0
    assert len({tuple(t.toDebugString.split("\n")[1:]) for t in model.stages[1].trees}) == 4
    known = mdl.build_pipeline(cfg, INPUTS, num_trees=4).fit(rows)
    mse = [mdl.evaluate(mdl.predict(m, rows)).first()["mse"] for m in (model, known)]
    assert mse[0] == pytest.approx(mse[1], rel=0.02)
    path = scratch_path(spark, "roots")
    model.stages[1].save(path)
    roots = [r.rawCount for r in spark.read.parquet(f"{path}/data").filter("nodeData.id = 0").select("nodeData.rawCount").collect()]
    assert len(roots) == 4 and all(abs(n - 20000) < 5 * 20000 ** 0.5 for n in roots)


def test_draws_are_poisson():
    table, n = forest._draw_table(), 400000
    counts = np.concatenate([forest._draws(table, 42, 1, b, n) for b in range(3)])
    assert (forest._draws(table, 42, 1, 2, n) == counts[2 * n:]).all()
    for k, p in enumerate((0.36788, 0.36788, 0.18394, 0.06131, 0.01533, 0.00307)):
        assert abs((counts == k).mean() - p) < 5 * (p / len(counts)) ** 0.5
    assert counts.max() < 20


def test_scores_are_those_of_transform(spark):
    """Bit by bit, with nulls and values beyond those of the training, for a model that was loaded too."""
    rows = _rows(spark, 3000)
    model = mdl.build_pipeline(replace(DEFAULT_CONFIG, max_depth=7), INPUTS, num_trees=5).fit(rows)
    odd = rows.withColumn("rank", F.when(F.col("id") % 7 > 0, F.col("rank") * 2 - 100)).withColumn("part", F.when(F.col("id") % 11 > 0, F.col("part")))
    for m in (model, runlog.load_model(runlog.save_model(model, scratch_path(spark, "model")))):
        want, got = m.transform(odd).drop("_features"), mdl.predict(m, odd)
        assert got.columns == want.columns and got.count() == 3000
        assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()
        assert "ArrowEvalPython" in got._jdf.queryExecution().toString()


def test_odd_training_rows(spark, packed):
    cfg, rows = replace(DEFAULT_CONFIG, max_depth=3), _rows(spark, 200)
    with pytest.raises(Exception, match="null, NaN or infinite"):
        mdl.train(rows.withColumn("part", F.when(F.col("id") > 3, F.col("part"))), cfg, INPUTS, num_trees=2)
    flat = mdl.train(rows.withColumn("equity", F.lit(0.25)), cfg, INPUTS, num_trees=2)
    assert {r.prediction for r in mdl.predict(flat, rows).collect()} == {0.25} and flat.stages[1].totalNumNodes == 2
    same = mdl.train(rows.withColumn("rank", F.lit(3)).withColumn("part", F.lit(0.5)).withColumn("suit", F.lit(1)), cfg, INPUTS, num_trees=2)
    assert 2 < same.stages[1].totalNumNodes <= 6
