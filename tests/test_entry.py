import importlib

import duckdb
import pytest

from cardlens.sources.tables import TABLES
from conftest import SF_SMALL

E = importlib.import_module("__spark_entry__")
LIBRARY = {n: f for n, f in E.queries().items() if not n.startswith("op") and n != "pipeline"}
# the full forest has no twin: its numbers are compared with a saved model below
NO_SQL = {"g1_train_metrics", "g3_predict", "g4_batch_score", "j1_stream_score"}


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = {r["current_hand_class_value"]: r["n_hands"] for r in df.collect()}
    assert sum(rows.values()) == 6000
    assert set(df.columns) == {"current_hand_class_value", "n_hands"}


def test_every_library_query_has_sql():
    assert set(LIBRARY) - NO_SQL <= set(E.oracle_sql()) <= set(E.queries()) and not NO_SQL & set(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(rows):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(set(LIBRARY) - NO_SQL))
def test_query_equals_sql_on_small_tables(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL)
    rel = con.sql(E.oracle_sql()[name])
    cols = sorted(rel.columns)
    assert sorted(got.columns) == cols
    want = con.sql(f"SELECT {', '.join(chr(34) + c + chr(34) for c in cols)} FROM ({E.oracle_sql()[name]})").fetchall()
    assert _norm(tuple(r[c] for c in cols) for r in got.collect()) == _norm(want)


def test_scores_are_those_of_the_saved_model(spark):
    """g1, g3, g4 and j1 with the full forest: what they return is what a saved and loaded copy of the model says."""
    from pyspark.sql import functions as F

    from cardlens.config import DEFAULT_CONFIG
    from cardlens.operators import runlog
    from cardlens.plans.queries_ops import trained_model, training_parts
    from cardlens.session import scratch_path

    q, inputs = E.queries(), list(DEFAULT_CONFIG.model_features)
    predicted = q["g3_predict"](spark, SF_SMALL)
    saved = runlog.load_model(runlog.save_model(trained_model(spark, SF_SMALL), scratch_path(spark, "model")))
    for rows, column in ((predicted, "prediction"), (q["g4_batch_score"](spark, SF_SMALL), "equity"), (q["j1_stream_score"](spark, SF_SMALL), "equity")):
        again = saved.transform(rows.withColumnRenamed(column, "_returned").select(*[F.col(c) for c in inputs], "_returned"))
        assert again.filter(F.abs(F.col("prediction") - F.col("_returned")) > 1e-12).count() == 0
        assert rows.select(column).distinct().count() > 500
    assert q["g4_batch_score"](spark, SF_SMALL).exceptAll(q["j1_stream_score"](spark, SF_SMALL)).count() == 0
    metrics = q["g1_train_metrics"](spark, SF_SMALL).first()
    told = predicted.join(training_parts(spark, SF_SMALL)[1].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "code", F.col("equity").alias("y")).distinct(),
                          ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "code"]).collect()
    error = [(r.y - r.prediction) ** 2 for r in told]
    mean = sum(r.y for r in told) / len(told)
    assert metrics["n"] == len(told) and metrics["mse"] == pytest.approx(sum(error) / len(told), abs=2e-6)
    assert metrics["r2"] == pytest.approx(1 - sum(error) / sum((r.y - mean) ** 2 for r in told), abs=1e-4) and metrics["r2"] > 0.5
