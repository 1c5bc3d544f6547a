"""SimHash near-duplicates by multi-index hashing.

Fingerprint: 64 bits over the word shingles of a text; a bit is set if it is set
in over half of the shingles' XXH64 (seed 42). Fingerprints at ``max_distance`` or
fewer differing bits are linked, and documents are grouped by reachability.

Search (on distinct fingerprints, so exact copies cost one row): a fingerprint is
cut into two halves. Two fingerprints at distance 3 or less differ in at most one
bit of one half, so each half is looked up in a table of halves over its Hamming
ball of radius 1, and every match is verified over all 64 bits. Of two halves
that differ in one bit only the one with the bit set probes, which finds each pair
once with half the probes.

Crowded table entries: where few fingerprints share a half (``LIGHT_BUCKET``), the
matches are a plain join. A more crowded entry goes to groups of its own fingerprints and at most about
``DENSE_BUCKET`` of those that probe it (its own come again in each group; they are no more than that
either), so a group has at most about twice ``DENSE_BUCKET`` rows of 8 bytes. A group links its
fingerprints by breadth-first search and emits a spanning forest, never all pairs. An
entry beyond ``DENSE_BUCKET`` fingerprints is not brought together at all: its
fingerprints are spread over their 64-bit balls of radius 1 and 2, and two that
meet in a point (one by 1, one by 2 flips) are within 3 bits; each point links its
fingerprints to the smallest one of radius 1. All three ways find every link.

Edge cases: texts without words (null, empty, white space) have fingerprint 0 and
are linked like any other; fewer words than a shingle form one shingle; null
doc_ids take part, and a group's id is its smallest doc_id that is not null; an
empty table gives an empty result; repeated rows are exact copies.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package, write_shared
from .columns import fresh, named
from .components import connected_components

SHINGLE_WORDS = 3
MAX_DISTANCE = 3
SEED = 42
LIGHT_BUCKET = 16
DENSE_BUCKET = 20_000


def _fingerprint_batches(text_at: int, width: int, seed: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        digest = xxhash.xxh64_intdigest
        per_slice = 1 << 15

        def bit_counts(hashes):
            total = np.zeros(64, np.int64)
            for low in range(0, len(hashes), per_slice):
                part = np.array(hashes[low:low + per_slice], dtype="<u8")
                total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
            return total

        def one(text):
            found = text.lower().split() if text else ()  # bytes: ASCII case and ASCII white space only
            if not found:
                return 0
            joined = b" ".join(found)
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            ends = np.cumsum(lengths + 1) - 1
            last = ends[min(width, len(found)) - 1:].tolist()
            first = (ends - lengths)[:len(last)].tolist()
            hashes = [digest(joined[a:b], seed) for a, b in zip(first, last)]
            bits = (2 * bit_counts(hashes) > len(hashes)).astype(np.uint8)
            return int(np.packbits(bits, bitorder="little").view("<i8")[0])

        for batch in batches:
            texts = batch.column(text_at).cast(pa.binary())
            prints = pa.array([one(t.as_py()) for t in texts], pa.int64())
            columns = [c for i, c in enumerate(batch.columns) if i != text_at]
            names = [n for i, n in enumerate(batch.schema.names) if i != text_at]
            yield pa.RecordBatch.from_arrays([*columns, prints], [*names, "fingerprint"])
    return run


def fingerprints(docs: DataFrame, text_col: str = "text", width: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """``docs`` with the text replaced by its ``fingerprint`` (bigint, the 64 bits as they are)."""
    ship_package(docs.sparkSession)
    rest = [c for c in docs.columns if c != text_col]
    sent = docs.select(*[named(c).alias(f"c{i}") for i, c in enumerate([*rest, text_col])])
    schema = ", ".join([*(f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(rest)), "fingerprint bigint"])
    out = sent.mapInArrow(_fingerprint_batches(len(rest), width, seed), schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(rest)], "fingerprint")


def _half(value: Column, which: int) -> Column:
    return F.shiftrightunsigned(value, 32) if which == 0 else value.bitwiseAND((1 << 32) - 1)


def _entries(prints: DataFrame) -> DataFrame:
    """The table: (part, value, fp), two rows per fingerprint."""
    rows = F.array(*[F.struct(F.lit(i).alias("part"), _half(F.col("fp"), i).alias("value")) for i in (0, 1)])
    return prints.select("fp", F.inline(rows))


def _probes(entries: DataFrame) -> DataFrame:
    """The ball of radius 1 around each half, as far as a set bit is cleared, and the half itself (``flip`` 0)."""
    flips = F.filter(F.array(*[F.lit(1 << i).cast("bigint") for i in range(32)]),
                     lambda m: F.col("value").bitwiseAND(m) != 0)
    balls = entries.select("fp", "part", "value", F.explode(F.concat(F.array(F.lit(0).cast("bigint")), flips)).alias("flip"))
    return balls.select("fp", "part", F.col("value").bitwiseXOR(F.col("flip")).alias("value"), (F.col("flip") == 0).alias("own"))


def _close(a: Column, b: Column, distance: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= distance


def _forest(distance: int):
    """Links of one table entry: own fingerprints with one another and with those that probe it; a spanning forest."""
    def run(key, table):
        import numpy as np
        import pyarrow as pa

        fp = table.column("fp").to_numpy().astype(np.uint64)
        own = table.column("own").to_numpy(zero_copy_only=False)
        mine, others = np.unique(fp[own]), np.unique(fp[~own])
        left, right = [], []

        def take(pool, x):
            near = np.bitwise_count(pool ^ x) <= distance
            return pool[near], pool[~near]

        # breadth first: whatever is near the next fingerprint joins its tree and is not looked at again, so each
        # own fingerprint is compared once with those left over, and a tree has as many links as it needs
        while len(mine):
            queue, mine = [(mine[0], True)], mine[1:]
            while queue:
                x, is_mine = queue.pop()
                near, mine = take(mine, x)
                queue += [(y, True) for y in near]
                more, others = take(others, x) if is_mine else (near[:0], others)
                queue += [(y, False) for y in more]
                left += [x] * (len(near) + len(more))
                right += [*near, *more]
        edge = lambda x: pa.array(np.array(x, dtype=np.uint64).view(np.int64), pa.int64())
        return pa.Table.from_arrays([edge(left), edge(right)], ["a", "b"])
    return run


def _in_groups(middle: DataFrame, size: int) -> DataFrame:
    """(part, value, nth, fp, own): the probing fingerprints of each entry dealt to groups of about ``size``, its own ones in each."""
    groups = middle.groupBy("part", "value").agg(F.sum((~F.col("own")).cast("long")).alias("probing")) \
        .select("part", "value", F.greatest(F.ceil(F.col("probing") / size), F.lit(1)).cast("int").alias("groups"))
    rows = middle.join(groups, ["part", "value"])
    dealt = F.array(F.pmod(F.xxhash64("fp"), F.col("groups")).cast("int"))
    every = F.sequence(F.lit(0), F.col("groups") - 1)
    return rows.select("part", "value", F.explode(F.when(F.col("own"), every).otherwise(dealt)).alias("nth"), "fp", "own")


def _ball_links(prints: DataFrame) -> DataFrame:
    """Links among ``prints`` at distance 3 or less through shared points, a star per point."""
    bit = [1 << i if i < 63 else -(1 << 63) for i in range(64)]
    masks = [(0, 0)] + [(m, 1) for m in bit] + [(a ^ b, 2) for a, b in combinations(bit, 2)]
    flips = F.from_json(F.lit("[" + ",".join(f'{{"m":{m},"n":{n}}}' for m, n in masks) + "]"), "array<struct<m:bigint,n:int>>")
    points = prints.select("fp", F.inline(flips)).select("fp", "n", F.col("fp").bitwiseXOR(F.col("m")).alias("point"))
    centre = points.filter("n < 2").groupBy("point").agg(F.min("fp").alias("centre"))
    return points.join(centre, "point").filter(F.col("fp") != F.col("centre")) \
        .select(F.col("fp").alias("a"), F.col("centre").alias("b")).distinct()


def links(prints: DataFrame, distance: int = MAX_DISTANCE, light: int = LIGHT_BUCKET, dense: int = DENSE_BUCKET) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) that connect all pairs within ``distance`` (3 at most)."""
    if not 0 <= distance <= 3:
        raise ValueError("two halves with balls of radius 1 cover distances up to 3")
    entries = _entries(prints)
    # Spark takes an exploded table to be as small as its source and would broadcast it, so these joins are told to merge
    probes = _probes(entries).hint("merge")
    counts = entries.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"))
    sized = entries.hint("merge").join(counts, ["part", "value"])
    few = sized.filter(F.col("n") <= light).select("part", "value", F.col("fp").alias("b"))
    pairs = probes.join(few, ["part", "value"]).filter(_close(F.col("fp"), F.col("b"), distance)) \
        .filter(~F.col("own") | (F.col("fp") < F.col("b"))).select(F.col("fp").alias("a"), "b")
    crowded = counts.filter(F.col("n") > light)
    middle = write_shared(probes.join(crowded.filter(F.col("n") <= dense), ["part", "value"]).select("part", "value", "fp", "own"), "crowded")
    forest = _in_groups(middle, dense).groupBy("part", "value", "nth").applyInArrow(_forest(distance), "a bigint, b bigint")
    out = pairs.union(forest)
    huge = crowded.filter(F.col("n") > dense)
    if huge.limit(1).count():
        if distance != 3:
            raise ValueError("balls of radius 1 and 2 verify distance 3 only")
        out = out.union(_ball_links(probes.join(huge, ["part", "value"]).select("fp").distinct()))
    return out


def _classes(rows: DataFrame, id_col: str, distance: int) -> DataFrame:
    """(fp, root, component_id): the group of every fingerprint of ``rows``, and its smallest id."""
    prints = write_shared(rows.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(id_col).alias("first")), "prints")
    roots = connected_components(links(prints.select("fp"), distance))
    grouped = prints.join(roots, prints["fp"] == roots["node"], "left") \
        .select("fp", "first", F.coalesce("root", "fp").alias("root"))
    ids = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    return grouped.join(ids, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS,
                    distance: int = MAX_DISTANCE) -> DataFrame:
    """(id, fingerprint bigint, component_id) of every row of ``docs``."""
    sent = docs.select(named(id_col).alias("id"), named(text_col).alias("text"))
    rows = write_shared(fingerprints(sent, "text", width), "fingerprints")
    classes = _classes(rows, "id", distance)
    return rows.join(classes, rows["fingerprint"] == classes["fp"]).select(F.col("id").alias(id_col), "fingerprint", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS,
                         distance: int = MAX_DISTANCE) -> DataFrame:
    """One row of ``docs`` per group, that of the smallest id (rows without id come last and take part); rows of one id
    with different texts are judged row by row."""
    cells = [named(c) for c in docs.columns]
    one, two = fresh(docs.columns, "row"), fresh(docs.columns, "check")
    keyed = docs.withColumn(one, F.xxhash64(*cells)).withColumn(two, F.xxhash64(F.lit(1), *cells))  # 128 bits, never null
    rows = write_shared(fingerprints(keyed.select(named(id_col).alias("id"), F.col(one).alias("one"), F.col(two).alias("two"),
                                                  named(text_col).alias("text")), "text", width), "fingerprints")
    classes = _classes(rows, "id", distance)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "one", "two")).alias("first")
    kept = rows.join(classes, rows["fingerprint"] == classes["fp"]).groupBy("root").agg(first)
    kept = kept.select(F.col("first.one").alias(one), F.col("first.two").alias(two))
    return keyed.join(kept, [one, two], "left_semi").dropDuplicates([one, two]).select(*cells)
