"""Feature drift by population stability index (E6, E7, E9, H1 - H5; readers A6, A7).

PSI = sum over labels of (live - train) * ln(live / train), where each share
is count / total + epsilon. Binary features have the labels 'true'/'false';
categorical features are compared over the baseline's labels only — a live
label the baseline never saw is not a term, but its rows stay in the live
total.

Everything runs as one plan: the live window is unpivoted to
(feature, label), counted, left-joined to the baseline counts and summed per
feature — no per-feature loop, no driver round trip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import (BINARY_DRIFT_FEATURES, CATEGORICAL_DRIFT_FEATURES, PSI_ALERT_THRESHOLD, PSI_EPSILON)
from ..functions.cards import with_equity_bin

DRIFT_FEATURES = BINARY_DRIFT_FEATURES + CATEGORICAL_DRIFT_FEATURES


def psi_term(train_share: Column, live_share: Column) -> Column:
    """H1: one PSI term."""
    return (live_share - train_share) * F.log(live_share / train_share)


def label_of(col: str, binary: bool) -> Column:
    """Label text: 'true'/'false' for binary features, the value as text otherwise."""
    c = F.col(col)
    return F.lower(c.cast("boolean").cast("string")) if binary else c.cast("string")


def long_labels(df: DataFrame, binary=BINARY_DRIFT_FEATURES, categorical=CATEGORICAL_DRIFT_FEATURES,
                keep: tuple = ()) -> DataFrame:
    """Unpivot the drift features into (feature, label) rows (one row per input row and feature)."""
    df = with_equity_bin(df)
    flags = F.array(*[F.lit(f) for f in binary]) if binary else F.array().cast("array<string>")
    pairs = [F.struct(F.lit(f).alias("feature"), label_of(f, True).alias("label")) for f in binary] + \
            [F.struct(F.lit(f).alias("feature"), label_of(f, False).alias("label")) for f in categorical]
    # a null flag is no observation of its feature: it is rejected, so it is in no total (see true_counts for how many)
    return df.select(*keep, F.inline(F.array(*pairs))).filter(F.col("label").isNotNull() | ~F.array_contains(flags, F.col("feature")))


def baseline_counts(features_df: DataFrame, binary=BINARY_DRIFT_FEATURES,
                    categorical=CATEGORICAL_DRIFT_FEATURES) -> DataFrame:
    """(feature, label, n) over a whole feature table (partial aggregation, tiny output)."""
    return long_labels(features_df, binary, categorical).groupBy("feature", "label") \
        .agg(F.count(F.lit(1)).alias("n"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per label (value as text)."""
    return df.groupBy(F.col(col).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("n"))


def true_counts(df: DataFrame, cols=BINARY_DRIFT_FEATURES) -> DataFrame:
    """(feature, n_true, n) per boolean column; nulls are counted apart in n_null."""
    parts = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("boolean").alias("v")) for c in cols]
    return df.select(F.inline(F.array(*parts))).groupBy("feature").agg(
        F.sum(F.col("v").cast("int")).cast("long").alias("n_true"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("v").isNull().cast("int")).cast("long").alias("n_null"))


def psi_report(baseline: DataFrame, live_window: DataFrame, binary=BINARY_DRIFT_FEATURES,
               categorical=CATEGORICAL_DRIFT_FEATURES, epsilon: float = PSI_EPSILON) -> DataFrame:
    """H2 + H3 + H4: (target, psi) for every drift feature.

    ``baseline`` is (feature, label, n); ``live_window`` has one column per
    feature (typed booleans for binary features). Also returns the share of
    live rows whose label the baseline does not know (``unknown_share``).
    """
    feats = list(binary) + list(categorical)
    base = baseline.filter(F.col("feature").isin(feats)).select("feature", "label", "n")
    live_counts = long_labels(live_window, binary, categorical).groupBy("feature", "label") \
        .agg(F.count(F.lit(1)).alias("n_live"))
    # one full join of two small count tables: baseline labels give the terms, every live label
    # (also those the baseline lacks) counts in the live total; the live window is read once
    j = base.join(live_counts, ["feature", "label"], "full")
    by_feature = Window.partitionBy("feature")
    j = j.withColumn("_train_total", F.sum("n").over(by_feature)) \
         .withColumn("_live_total", F.sum("n_live").over(by_feature))
    in_base = F.col("n").isNotNull()
    train_share = F.col("n") / F.col("_train_total") + F.lit(epsilon)
    live_share = F.coalesce(F.col("n_live"), F.lit(0)) / F.col("_live_total") + F.lit(epsilon)
    known = F.when(in_base, F.coalesce(F.col("n_live"), F.lit(0)))
    out = j.groupBy(F.col("feature").alias("target")).agg(
        F.sum(F.when(in_base, psi_term(train_share, live_share))).alias("psi"),
        (1.0 - F.sum(known) / F.max("_live_total")).alias("unknown_share"),
        F.max(in_base.cast("int")).alias("_in_base"), F.max("_live_total").alias("_seen"))
    # an empty window (the guard's, for one) is no report, not a report of nulls
    return out.filter((F.col("_in_base") == 1) & (F.col("_seen") > 0)).drop("_in_base", "_seen")


def psi_by_window(baseline: DataFrame, live_counts: DataFrame, window_col: str, epsilon: float = PSI_EPSILON) -> DataFrame:
    """H4 for many live windows at once: (target, window, psi) from baseline (feature, label, n) and live counts
    (window, feature, label, n_live). Same terms as :func:`psi_report`, one plan for all windows."""
    totals = live_counts.groupBy(window_col, "feature").agg(F.sum("n_live").alias("_live_total"))
    base = baseline.withColumn("_train_total", F.sum("n").over(Window.partitionBy("feature")))
    terms = totals.join(base, "feature").join(live_counts, [window_col, "feature", "label"], "left")
    train = F.col("n") / F.col("_train_total") + F.lit(epsilon)
    live = F.coalesce(F.col("n_live"), F.lit(0)) / F.col("_live_total") + F.lit(epsilon)
    return terms.groupBy(F.col("feature").alias("target"), window_col).agg(F.sum(psi_term(train, live)).alias("psi"))


def drift_alerts(report: DataFrame, threshold: float = PSI_ALERT_THRESHOLD) -> DataFrame:
    """H5: targets whose PSI is above the threshold."""
    return report.filter(F.col("psi") > threshold)


def distribution_psi(expected: DataFrame, actual: DataFrame, epsilon: float = PSI_EPSILON) -> DataFrame:
    """H1 over two label-count tables (feature, label, n): labels of either side, missing counts 0."""
    e = expected.withColumnRenamed("n", "n_e")
    a = actual.withColumnRenamed("n", "n_a")
    j = e.join(a, ["feature", "label"], "full")
    j = j.withColumn("n_e", F.coalesce("n_e", F.lit(0))).withColumn("n_a", F.coalesce("n_a", F.lit(0)))
    w = Window.partitionBy("feature")
    t = F.col("n_e") / F.sum("n_e").over(w) + F.lit(epsilon)
    l = F.col("n_a") / F.sum("n_a").over(w) + F.lit(epsilon)
    return j.withColumn("_term", psi_term(t, l)).groupBy(F.col("feature").alias("target")) \
        .agg(F.sum("_term").alias("psi"))


# ---- A6 / A7: the JSON files of the drift job -----------------------------

def read_baseline_json(spark: SparkSession, path: str, features=DRIFT_FEATURES) -> DataFrame:
    """Feature -> label -> count JSON into (feature, label, n)."""
    schema = T.StructType([T.StructField(f, T.MapType(T.StringType(), T.LongType())) for f in features])
    raw = spark.read.schema(schema).json(path, multiLine=True)
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("m")) for f in features])
    return raw.select(F.inline(pairs)).select("feature", F.explode("m").alias("label", "n"))


def write_baseline_json(counts: DataFrame, path: str) -> None:
    """Inverse of :func:`read_baseline_json` for (feature, label, n): one JSON object (a row per label only, so small)."""
    maps = counts.groupBy("feature").agg(F.map_from_entries(F.collect_list(F.struct("label", "n"))).alias("m"))
    whole = maps.agg(F.map_from_entries(F.collect_list(F.struct("feature", "m"))).alias("x"))
    whole.select(F.to_json("x").alias("value")).coalesce(1).write.text(path)


def write_live_json(window: DataFrame, path: str, ts_col: str = "ts") -> None:
    """Inverse of :func:`read_live_json` for a bounded window: one object, column -> {row number -> value}."""
    cols = [c for c in LIVE_JSON_TYPES if c != "timestamp"]
    rows = window.select(*cols, F.unix_millis(ts_col).alias("timestamp"))
    listed = rows.agg(F.collect_list(F.struct(*rows.columns)).alias("r"))
    columns = [F.map_from_entries(F.transform("r", lambda x, i: F.struct(i.cast("string"), x[c]))).alias(c) for c in rows.columns]
    listed.select(F.to_json(F.struct(*columns)).alias("value")).write.text(path)


LIVE_JSON_TYPES = {
    "hand_is_pair": T.BooleanType(), "hand_is_suited": T.BooleanType(), "board_is_paired": T.BooleanType(),
    "equity": T.DoubleType(), "current_hand_class_value": T.StringType(), "equity_bin": T.StringType(),
    "timestamp": T.LongType(),
}


def read_live_json(spark: SparkSession, path: str, types: dict = LIVE_JSON_TYPES) -> DataFrame:
    """Column-oriented JSON (column -> {row index -> value}) into rows.

    The row index set is taken from ``timestamp``; ``timestamp`` is epoch
    milliseconds and becomes a TIMESTAMP column ``ts``.
    """
    schema = T.StructType([T.StructField(c, T.MapType(T.StringType(), t)) for c, t in types.items()])
    raw = spark.read.schema(schema).json(path, multiLine=True)
    rows = raw.select("*", F.explode(F.map_keys("timestamp")).alias("_row"))
    cols = [F.try_element_at(F.col(c), F.col("_row")).alias(c) for c in types if c != "timestamp"]
    return rows.select(F.col("_row").cast("int").alias("row_index"), *cols,
                       F.timestamp_millis(F.try_element_at(F.col("timestamp"), F.col("_row"))).alias("ts"))
