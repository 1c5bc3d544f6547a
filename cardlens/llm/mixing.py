"""Mixing sources to target weights by systematic sampling (DataFrame functions only).

Every source has a target number of words. A document's expected number of
copies is its source's rate, target / size of the source. Documents of a source
stand in a fixed order; the prefix sum of their expected copies, plus one random
offset per source, crosses integers, and a document is emitted once for each
integer it crosses. The order is by size, so the copies are spread evenly over
short and long documents and the words taken stay within about one longest
document of the target.

No window ever holds a source: the prefix sum is put together from counts per
(source, size), counts per hash cell of a (source, size) group, and a rank
inside one cell of about ``CELL_ROWS`` rows. A source, or a group of equal
documents, with a third of all rows is therefore spread over many tasks. The table
of sources (one row each) is counted: up to ``SMALL_SOURCES`` it is one window, more
are cut into ranges.

Edge cases: a null text has size 0; a null source is a source of its own and
sorts last; a source without words has target 0 and is never taken; repeated
rows stand next to each other in the order and are sampled one by one; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_shared
from .columns import fresh, named, null_safe_join

CELL_ROWS = 512
ARRAY_ROWS = 1 << 16
SMALL_SOURCES = 100_000
MAX_REPEATS = 3
_BEFORE = (Window.unboundedPreceding, -1)


def _hex_number(digest: Column, digits: int) -> Column:
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")


def _sums_before(rows: DataFrame, order: Sequence, values: dict, wide: bool) -> DataFrame:
    """``rows`` with the sums of ``values`` (name: column) over all rows before each in ``order``.

    One window if the rows are few; if they are ``wide``, they are cut into ranges of the order (written once with the
    range's number), and a sum is the sum of the ranges before, of which there is one row each, plus that inside the range."""
    before = lambda window, n, v: F.coalesce(F.sum(v).over(window.rowsBetween(*_BEFORE)), F.lit(0)).alias(n)
    if not wide:
        return rows.select("*", *[before(Window.orderBy(*order), n, v) for n, v in values.items()])
    ranged = write_shared(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "mix-ranges")
    starts = ranged.groupBy("_range").agg(*[F.sum(v).alias(n) for n, v in values.items()])
    starts = starts.select("_range", *[before(Window.orderBy("_range"), f"{n}_start", F.col(n)) for n in values])
    inside = ranged.select("*", *[before(Window.partitionBy("_range").orderBy(*order), f"{n}_in", v) for n, v in values.items()])
    return inside.join(starts, "_range").select(*rows.columns, *[(F.col(f"{n}_start") + F.col(f"{n}_in")).alias(n) for n in values])


def cyclic_weights(sources: DataFrame, source_col: str, weights: Sequence[int], wide: bool = False) -> DataFrame:
    """Give the sources, in code-point order with null last, the weights in turn (one row per source)."""
    placed = _sums_before(sources, [F.col(source_col).asc_nulls_last()], {"_place": F.lit(1)}, wide)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_place") % len(weights) + 1).cast("int"))
    return placed.withColumn("weight", weight).drop("_place")


def capped_targets(sources: DataFrame, max_repeats: int = MAX_REPEATS, source_col: str = "source", wide: bool = False) -> DataFrame:
    """Share the whole size by weight with a cap of ``max_repeats`` times each source's size.

    ``sources`` has one row per source (source_size, weight). What a cap cuts
    off is shared again by weight until no source is above its cap; the result
    is the level L with sum(least(cap, L * weight)) = total. Sources ordered by
    cap / weight fill up in that order, so L is the first level that does not
    reach the next source's cap.
    """
    rows = sources.withColumn("_cap", (F.col("source_size") * max_repeats).cast("long")).withColumn("_full_at", F.col("_cap") / F.col("weight"))
    order = [F.col("_full_at"), F.col("source_size"), F.col(source_col).asc_nulls_last()]
    rows = _sums_before(rows, order, {"_filled": F.col("_cap"), "_weighed": F.col("weight")}, wide)
    level = lambda size, weight: (size - F.col("_filled")) / (weight - F.col("_weighed"))
    first = F.min(F.when(F.col("_level") <= F.col("_full_at"), F.struct("_full_at", "_level")))
    if wide:  # three numbers reach the driver
        rows = write_shared(rows, "mix-levels")
        rows = rows.withColumn("_level", level(*map(F.lit, rows.agg(F.sum("source_size"), F.sum("weight")).first())))
        found = rows.agg(first["_level"]).first()[0]
        found = F.lit(found).cast("double")
    else:
        whole = Window.partitionBy()
        rows = rows.withColumn("_level", level(F.sum("source_size").over(whole), F.sum("weight").over(whole)))
        found = first.over(whole)["_level"]
    target = F.least(F.col("_cap").cast("double"), found * F.col("weight"))
    return rows.withColumn("target", F.coalesce(target, F.lit(0.0))).drop("_cap", "_full_at", "_filled", "_weighed", "_level")


def plan_copies(docs: DataFrame, id_col: str, source_col: str, size_col: str, weights: Sequence[int] = (5, 2, 1),
                max_repeats: int = MAX_REPEATS, seed: int = 0, content: Sequence[str] = ()) -> DataFrame:
    """One row per distinct (id, source, size) and ``content``, columns that tell rows of one id apart: ``n`` rows of ``docs``,
    their first ``position`` in the source's order, and the source's source_size, target, rate and offset."""
    key = [id_col, source_col, size_col, *content]
    keyed = write_shared(docs.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
                         .withColumn("_h", F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))), "mix-keys")
    groups = keyed.groupBy(source_col, size_col).agg(F.sum("n").alias("_gn"))
    sources = groups.groupBy(source_col).agg(F.sum(F.col("_gn") * F.col(size_col)).cast("long").alias("source_size"))
    sources = write_shared(sources, "mix-sources")
    wide = sources.count() > SMALL_SOURCES  # changes the path only
    sources = capped_targets(cyclic_weights(sources, source_col, weights, wide), max_repeats, source_col, wide)
    offset_hash = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(source_col), F.lit(""))))
    sources = sources.select(source_col, "source_size", "target",
                             F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                             .otherwise(0.0).alias("rate"),
                             (_hex_number(offset_hash, 5) / F.lit(1 << 20)).alias("offset"))
    by_size = Window.partitionBy(source_col).orderBy(size_col).rowsBetween(*_BEFORE)
    groups = groups.withColumn("_gstart", F.coalesce(F.sum("_gn").over(by_size), F.lit(0)))
    groups = null_safe_join(groups, sources, [source_col])
    cells = F.ceil(F.col("_gn") / CELL_ROWS).cast("long")
    cell = F.shiftrightunsigned(_hex_number(F.col("_h"), 7) * cells, 28)
    keyed = null_safe_join(keyed, groups, [source_col, size_col]).withColumn("_cell", cell)
    counts = keyed.groupBy(source_col, size_col, "_cell").agg(F.sum("n").alias("_cn"))
    by_cell = Window.partitionBy(source_col, size_col).orderBy("_cell").rowsBetween(*_BEFORE)
    counts = counts.withColumn("_cstart", F.coalesce(F.sum("_cn").over(by_cell), F.lit(0))).drop("_cn")
    keyed = null_safe_join(keyed, counts, [source_col, size_col, "_cell"])
    in_cell = Window.partitionBy(source_col, size_col, "_cell").orderBy("_h", F.col(id_col).asc_nulls_first(), *content) \
        .rowsBetween(*_BEFORE)
    position = F.col("_gstart") + F.col("_cstart") + F.coalesce(F.sum("n").over(in_cell), F.lit(0))
    return keyed.select(*key, "n", position.alias("position"), "source_size", "target", "rate", "offset")


def copies_at(position: Column, rate: Column, offset: Column) -> Column:
    """Integers crossed by the document at ``position`` (0-based) of its source's order."""
    return (F.floor((position + 1) * rate + offset) - F.floor(position * rate + offset)).cast("long")


def _numbered(plan: DataFrame, n: str, j: str) -> DataFrame:
    """The rows of ``plan`` once for each ``j`` from 0 to ``n`` - 1; no array has more than ``ARRAY_ROWS`` entries."""
    high = fresh(plan.columns, "_high")
    count = named(n)
    rows = plan.withColumn(high, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((count - 1) / ARRAY_ROWS)))) \
        .withColumn(j, F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.lit(ARRAY_ROWS - 1), count - 1 - F.col(high) * ARRAY_ROWS))))
    return rows.withColumn(j, F.col(high) * ARRAY_ROWS + F.col(j)).drop(high)


def copy_counts(docs: DataFrame, id_col: str, source_col: str, size_col: str, **options) -> DataFrame:
    """(id, source, size) of every row of ``docs`` with source_size, target and its number of ``copies``."""
    keys = docs.select(named(id_col).alias("_id"), named(source_col).alias("_source"), named(size_col).alias("_size"))
    rows = _numbered(plan_copies(keys, "_id", "_source", "_size", **options), "n", "_j")
    return rows.select(F.col("_id").alias(id_col), F.col("_source").alias(source_col), F.col("_size").alias(size_col), "source_size", "target",
                       copies_at(F.col("position") + F.col("_j"), F.col("rate"), F.col("offset")).alias("copies"))


def mix(docs: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source", **options) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as it is drawn, with a ``copy`` number from 1.

    All columns of ``docs`` are kept; ``size`` is an expression over them. The plan is made on (id, source, size) and a
    checksum of the row. Rows are brought together by that checksum, equal rows as one, so whole
    rows are shuffled once and rows without id, or of one id, stand apart.
    """
    names = {c: fresh(docs.columns, f"_mix_{c}") for c in ("id", "source", "size", "one", "two")}
    cells = [named(c) for c in docs.columns]
    keyed = docs.select("*", named(id_col).alias(names["id"]), named(source_col).alias(names["source"]), size.alias(names["size"]),
                        F.xxhash64(*cells).alias(names["one"]), F.xxhash64(F.lit(1), *cells).alias(names["two"]))  # 128 bits, never null
    row = [names["one"], names["two"]]
    plan = plan_copies(keyed.select(*names.values()), names["id"], names["source"], names["size"], content=row, **options)
    plan = plan.select(*row, *[F.col(c).alias(fresh(docs.columns, f"_mix_{c}")) for c in ("n", "position", "rate", "offset")])
    n, position, rate, offset = plan.columns[2:]
    rows = keyed.dropDuplicates(row).select(*cells, *row).join(plan, row)
    nth, copies, copy = (fresh([*rows.columns, *docs.columns], c) for c in ("_mix_nth", "_mix_copies", "copy"))
    rows = _numbered(rows, n, nth).withColumn(copies, copies_at(F.col(position) + F.col(nth), F.col(rate), F.col(offset)))
    rows = rows.filter(F.col(copies) > 0).select(*cells, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))).alias(copy))
    return rows
