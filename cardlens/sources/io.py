"""Sources, sinks and materialisation.

* JDBC tables (A1 - A3): partitioned reads when bounds are known, so a large
  table is read by many tasks instead of one connection.
* Parquet (A4, A5): column pruning and filter pushdown come from the scan.
* JSON files of the drift job (A6, A7): see :mod:`cardlens.operators.drift`.
* Attach a target by key (A8), post-write audit (A9), lineage cut (A10),
  explicit repartition (A11).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.drift import read_baseline_json, read_live_json  # noqa: F401  (A6, A7)
from ..session import delete_folder, ensure_checkpoint_dir, scratch_path, scratch_root


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """A1: read a SQL table. With a numeric partition column and bounds the
    read is split into ``num_partitions`` range queries run in parallel."""
    props = dict(properties or {})
    if partition_column is not None:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                               upperBound=upper_bound, numPartitions=num_partitions, properties=props)
    return spark.read.jdbc(url, table, properties=props)


def read_sampled(spark: SparkSession, url: str, table: str, fraction: float, seed: int | None = None,
                 properties: dict | None = None, **partitioning) -> DataFrame:
    """A2: read a SQL table, then keep a Bernoulli sample."""
    return read_jdbc(spark, url, table, properties, **partitioning).sample(False, fraction, seed)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               mode: str = "overwrite") -> None:
    """A3: write a table (default: overwrite); each partition writes over its own connection."""
    df.write.jdbc(url, table, mode=mode, properties=dict(properties or {}))


def read_parquet(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A4: lazy Parquet scan (with a declared schema when given, e.g. ``schema.RAW_HANDS``)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: tuple = ()) -> None:
    """A5: write Parquet (overwrite by default), optionally partitioned by columns."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def attach_target(features: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Put a target next to its features, one to one.

    Spark rows have no order, so the pairing is a join on an explicit key (a shuffle
    join; both sides are full tables). A key that repeats on either side, is null, or
    is missing on one side is an error when the plan runs; so the output has exactly
    as many rows as either input.
    """
    def once(df: DataFrame, name: str) -> DataFrame:
        rest = [c for c in df.columns if c != key]
        rows = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"), F.first(F.struct(*rest)).alias(f"_{name}"))
        message = F.concat(F.lit(f"{name}: {key} is null or repeated: "), F.coalesce(F.col(key).cast("string"), F.lit("null")))
        bad = F.col(key).isNull() | (F.col("_rows") > 1)
        return rows.select(key, F.when(bad, F.raise_error(message).cast(rows.schema[f"_{name}"].dataType)).otherwise(F.col(f"_{name}")).alias(f"_{name}"))

    def present(name: str, kind) -> Column:
        message = F.concat(F.lit(f"{name}: no row for {key} "), F.col(key).cast("string"))
        return F.when(F.col(f"_{name}").isNull(), F.raise_error(message).cast(kind)).otherwise(F.col(f"_{name}")).alias(f"_{name}")

    left, right = once(features, "features"), once(target, "target")
    both = left.join(right, key, "full")
    both = both.select(key, present("features", left.schema["_features"].dataType), present("target", right.schema["_target"].dataType))
    return both.select(*[F.col(key) if c == key else F.col(f"_features.{c}") for c in features.columns],
                       *[F.col(f"_target.{c}") for c in target.columns if c != key])


def write_and_audit(df: DataFrame, path: str, name: str, order: tuple = ()) -> DataFrame:
    """Write (overwrite), re-read, and return (table_name, rows_written, rows_read, ok, first_row).

    The rows are counted while they are written, so the plan runs once. ``first_row`` is the
    smallest row by ``order`` (default: all columns) of the table read back, as JSON.
    """
    spark = df.sparkSession
    seen = Observation(name)
    write_parquet(df.observe(seen, F.count(F.lit(1)).alias("rows")), path)
    back = spark.read.parquet(path)
    row = F.min(F.struct(*(order or back.columns), F.to_json(F.struct(*back.columns), {"timeZone": "UTC"}).alias("_json"))).getField("_json")
    read = back.agg(F.count(F.lit(1)).alias("n"), row.alias("first")).first()
    written = seen.get["rows"]
    return spark.createDataFrame([(name, written, read["n"], written == read["n"], read["first"])],
                                 "table_name string, rows_written bigint, rows_read bigint, ok boolean, first_row string")


def materialize(df: DataFrame, path: str | None = None, use_checkpoint: bool = False) -> DataFrame:
    """A10: compute once and cut the lineage.

    Default: write the rows as Parquet to a fresh folder under the session's
    shared ``spark.checkpoint.dir`` (or to ``path``) and read them back — one
    pass over the plan, columnar and compressed, readable by every executor, so
    a lost executor never forces the expensive plan to run again. Pass ``path`` to
    replace an earlier copy; :func:`drop_materialized` removes one that is done with.
    With ``use_checkpoint`` the DataFrame's reliable ``checkpoint()`` is used
    instead (that writes in a second job, so the plan runs twice unless the
    caller persisted it).
    """
    spark = df.sparkSession
    if use_checkpoint:
        ensure_checkpoint_dir(spark)
        return df.checkpoint(eager=True)
    target = path or scratch_path(spark, "materialized")
    df.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def drop_materialized(df: DataFrame) -> None:
    """Delete the folder a :func:`materialize` result was read from, if it is one of the shared scratch folders."""
    spark = df.sparkSession
    root = scratch_root(spark)
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if folder.split(":", 1)[-1].lstrip("/").startswith(root.split(":", 1)[-1].lstrip("/") + "/materialized-"):
            delete_folder(spark, folder)


def repartition_by_cores(df: DataFrame, factor: int = 4, cols: tuple = ()) -> DataFrame:
    """Repartition to ``factor`` x the default parallelism (optionally by columns)."""
    n = df.sparkSession.sparkContext.defaultParallelism * factor
    return df.repartition(n, *[F.col(c) for c in cols]) if cols else df.repartition(n)
