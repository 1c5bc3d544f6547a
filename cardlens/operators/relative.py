"""Dataset-relative features (D1 - D5), the per-rank lookup (E2) and its join (F1).

The three features depend on a row's (value, class) only, so they are computed
on the table of counts per (value, class) and joined back. No window ever runs
over the input. The written count table is counted: up to ``SMALL_COUNTS`` rows it is
sorted as it is; beyond that no window runs over all distinct values either: it is cut
into ranges of (class, value) and of value, running totals inside a range start at
the sum of the ranges before it.

The count table and the lookup are written to the shared folder. Spark then knows
the lookup's size and broadcasts it below ``spark.sql.autoBroadcastJoinThreshold``,
else joins by shuffle; nothing is broadcast by hint.

* relative_rank_z: (value - class mean) / (class sample stddev + 1e-9); null for
  a one-row class (stddev undefined) and for a null value
* relative_rank_cdf: cume_dist of the value within its class, ascending, nulls first
* global_rank_strenght: percent_rank of the value, descending, nulls last, over all
  rows (worst hand 0.0, best 1.0; a single row gives 0.0)

All values count, whatever their range; a null class is a class of its own, as in a
window partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import RANK_CLASS, RANK_VALUE, STATEFUL_FEATURES, Z_SCORE_EPSILON
from ..session import write_shared
from .features import stateless_features

Z, CDF, GLOBAL = STATEFUL_FEATURES
_BEFORE = (Window.unboundedPreceding, -1)


def null_safe_left_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Left join on columns of the same name in which null equals null."""
    side = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
    cond: Column = F.lit(True)
    for c in on:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return left.join(side, cond, "left").drop(*[f"_r_{c}" for c in on])


def rank_counts(df: DataFrame, value_col: str = RANK_VALUE, class_col: str = RANK_CLASS) -> DataFrame:
    """Rows per (value, class): partial aggregation, so no value is heavy."""
    return df.groupBy(value_col, class_col).agg(F.count(F.lit(1)).alias("_n"))


def _running(counts: DataFrame, group: list[str], value_col: str, out: str) -> DataFrame:
    """Add the sum of ``_n`` over the rows of the same group with smaller values (nulls first).

    The rows are cut into ranges once, written with their range's number; a group's
    sums per range (at most one row per range) give the start of each range.
    """
    spark = counts.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(c).asc_nulls_first() for c in [*group, value_col]]
    ranged = write_shared(counts.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    per_range = ranged.groupBy(*group, "_range").agg(F.sum("_n").alias("_rn"))
    earlier = F.coalesce(F.sum("_rn").over(Window.partitionBy(*group).orderBy("_range").rowsBetween(*_BEFORE)), F.lit(0))
    starts = per_range.withColumn("_start", earlier).drop("_rn")
    inside = Window.partitionBy(*group, "_range").orderBy(F.col(value_col).asc_nulls_first()).rowsBetween(*_BEFORE)
    ranged = ranged.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    return null_safe_left_join(ranged, starts, [*group, "_range"]) \
        .withColumn(out, F.col("_start") + F.col("_in")).drop("_range", "_start", "_in")


SMALL_COUNTS = 1_000_000


def relative_lookup(df: DataFrame, value_col: str = RANK_VALUE, class_col: str = RANK_CLASS,
                    features=STATEFUL_FEATURES) -> DataFrame:
    """One row per (value, class) with the requested relative features.

    Rank values belong to one class each, so for them that is one row per rank value.
    """
    return lookup_from_counts(write_shared(rank_counts(df, value_col, class_col), "rank-counts"), value_col, class_col, features)


def lookup_from_counts(counts: DataFrame, value_col: str = RANK_VALUE, class_col: str = RANK_CLASS,
                       features=STATEFUL_FEATURES, small: int = SMALL_COUNTS) -> DataFrame:
    """E2 from a written table of counts (value, class, _n).

    The formulas are the same at any size; how the running totals are made depends on the
    measured number of rows: up to ``small`` rows one sort does, beyond that they come from ranges.
    """
    v, n = F.col(value_col).cast("double"), F.col("_n")
    known = F.when(v.isNotNull(), n)
    is_small = counts.count() <= small
    if is_small:  # bounded by the count above
        counts = counts.coalesce(1)
        by_class, all_rows = Window.partitionBy(class_col), Window.partitionBy()
        out = counts.withColumn("_nc", F.sum(n).over(by_class)).withColumn("_nv", F.sum(known).over(by_class)) \
            .withColumn("_mean", F.sum(n * v).over(by_class) / F.col("_nv"))
        if Z in features:
            out = out.withColumn("_ss", F.sum(n * (v - F.col("_mean")) * (v - F.col("_mean"))).over(by_class))
        if CDF in features:
            before = by_class.orderBy(F.col(value_col).asc_nulls_first()).rowsBetween(*_BEFORE)
            out = out.withColumn("_lt", F.coalesce(F.sum(n).over(before), F.lit(0)))
        if GLOBAL in features:
            upto = all_rows.orderBy(F.col(value_col).asc_nulls_first()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
            out = out.withColumn("_upto", F.sum(n).over(upto)).withColumn("_rows", F.sum(n).over(all_rows)) \
                .withColumn("_nulls", F.coalesce(F.sum(F.when(v.isNull(), n)).over(all_rows), F.lit(0)))
    else:  # two passes over the counts, as a variance from sums of squares loses digits
        totals = counts.groupBy(class_col).agg(F.sum(n).alias("_nc"), F.sum(known).alias("_nv"),
                                               (F.sum(n * v) / F.sum(known)).alias("_mean"))
        out = null_safe_left_join(counts, totals, [class_col])
        if Z in features:
            squares = out.groupBy(class_col).agg(F.sum(n * (v - F.col("_mean")) * (v - F.col("_mean"))).alias("_ss"))
            out = null_safe_left_join(out, squares, [class_col])
        if CDF in features:
            out = _running(out, [class_col], value_col, "_lt")
        if GLOBAL in features:
            by_value = counts.groupBy(value_col).agg(F.sum("_n").alias("_n"))
            by_value = _running(by_value, [], value_col, "_below")
            ends = counts.agg(F.sum("_n").alias("_rows"), F.coalesce(F.sum(F.when(v.isNull(), n)), F.lit(0)).alias("_nulls")).first()
            out = null_safe_left_join(out, by_value.select(value_col, (F.col("_below") + F.col("_n")).alias("_upto")), [value_col]) \
                .withColumn("_rows", F.lit(ends["_rows"] or 0)).withColumn("_nulls", F.lit(ends["_nulls"] or 0))
    if Z in features:
        std = F.when(F.col("_nv") > 1, F.sqrt(F.col("_ss") / (F.col("_nv") - 1)))
        out = out.withColumn(Z, (v - F.col("_mean")) / (std + F.lit(Z_SCORE_EPSILON)))
    if CDF in features:
        out = out.withColumn(CDF, (F.col("_lt") + n) / F.col("_nc"))
    if GLOBAL in features:
        # nulls stand first in the running total and last in the ranking: before a value stand the larger values
        before = F.when(v.isNull(), F.col("_rows") - F.col("_nulls")).otherwise(F.col("_rows") - F.col("_upto"))
        out = out.withColumn(GLOBAL, F.when(F.col("_rows") > 1, before / F.nullif(F.col("_rows") - 1, F.lit(0))).otherwise(F.lit(0.0)))
    return out.select(value_col, class_col, *[f for f in STATEFUL_FEATURES if f in features])


def with_relative_features(df: DataFrame, value_col: str = RANK_VALUE, class_col: str = RANK_CLASS,
                           features=STATEFUL_FEATURES, lookup: DataFrame | None = None) -> DataFrame:
    """Add the requested features by joining the lookup on (value, class).

    Building the lookup reads ``df`` once more; pass ``lookup`` (e.g. the table a
    feature job wrote) to reuse one. One without the class column is joined on the
    value alone and must have each value once (checked: repeats are an error).
    """
    if lookup is None:
        lookup = write_shared(relative_lookup(df, value_col, class_col, features), "relative-lookup")
        return null_safe_left_join(df, lookup, [value_col, class_col])
    keys = [c for c in (value_col, class_col) if c in lookup.columns]
    lookup = _unique(lookup.select(*keys, *[c for c in features if c in lookup.columns]), keys)
    return null_safe_left_join(df, lookup, keys)


def _unique(lookup: DataFrame, keys: list[str]) -> DataFrame:
    """The lookup with equal rows merged; different rows for one key are an error when the plan runs."""
    rest = [c for c in lookup.columns if c not in keys]
    merged = lookup.groupBy(*keys).agg(F.countDistinct(F.struct(*rest)).alias("_kinds"), *[F.first(c).alias(c) for c in rest])
    one = F.when(F.col("_kinds") > 1, F.raise_error(F.lit("lookup key with more than one set of values")))
    return merged.filter(F.coalesce(one.cast("boolean"), F.lit(True))).select(*lookup.columns)


def class_z_score(df: DataFrame, value_col: str = RANK_VALUE, class_col: str = RANK_CLASS) -> DataFrame:
    return with_relative_features(df, value_col, class_col, (Z,))


def class_cdf(df: DataFrame, value_col: str = RANK_VALUE, class_col: str = RANK_CLASS) -> DataFrame:
    return with_relative_features(df, value_col, class_col, (CDF,))


def global_rank_strength(df: DataFrame, value_col: str = RANK_VALUE, class_col: str = RANK_CLASS) -> DataFrame:
    return with_relative_features(df, value_col, class_col, (GLOBAL,))


def all_features(df: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """Row features (B12) followed by the three relative features."""
    return with_relative_features(stateless_features(df), lookup=lookup)


def stateful_lookup(features_df: DataFrame) -> DataFrame:
    """Distinct rows per rank value of (rank, z, cdf, strength) from a feature table.

    All three are functions of the rank value, so any row per value is the
    row; taking the first keeps it a partial aggregation of bounded size.
    """
    return features_df.groupBy(RANK_VALUE).agg(*[F.first(c).alias(c) for c in STATEFUL_FEATURES])


def _zero_fill(df: DataFrame) -> DataFrame:
    """Nulls to 0 in every column that has a zero: numbers 0, booleans false, strings '0'."""
    cols = []
    for f in df.schema:
        kind = f.dataType.typeName()
        zero = {"boolean": F.lit(False), "string": F.lit("0")}.get(kind)
        if zero is None and (kind in ("byte", "short", "integer", "long", "float", "double") or kind.startswith("decimal")):
            zero = F.lit(0).cast(f.dataType)
        cols.append(F.col(f.name) if zero is None else F.coalesce(F.col(f.name), zero).alias(f.name))
    return df.select(*cols)


def join_lookup(features_df: DataFrame, lookup: DataFrame, key: str = RANK_VALUE) -> DataFrame:
    """left join of features to the per-rank lookup, then nulls -> 0 in all columns (see :func:`_zero_fill`).

    Every key of the lookup takes part; each key once. How the join runs is left to
    Spark, which broadcasts the lookup only if its size is below the threshold.
    """
    own = [c for c in lookup.columns if c == key or c in STATEFUL_FEATURES or c not in features_df.columns]
    lookup = lookup.select(*own).dropDuplicates([key])
    drop = [c for c in lookup.columns if c != key and c in features_df.columns]
    return _zero_fill(features_df.drop(*drop).join(lookup, key, "left"))
