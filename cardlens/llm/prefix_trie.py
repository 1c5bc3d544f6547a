"""Conversation prefix trie: every distinct sequence of first turns of rebuilt conversations, with its statistics.

A plan rebuilds conversations: (conversation, base conversation, head): the first ``head`` turns of the
base (all if it has fewer, none if it is absent), then the conversation's own turns after its first ``head``.
Turns stand by turn number (null first; ties in the fixed order of their fingerprints).

Composable monoid fingerprints: a sequence of turns has (length, hash), and
(n, a) * (m, b) = (n + m, a + B^n b) in a prime field. One running sum per original conversation gives
the product of every prefix; a rebuilt prefix is base head * own suffix, and the own suffix is the
quotient of two prefixes moved to its new place, so no rebuilt text is ever made. The hash is a pair over
two primes below 2^31, about 62 bits, of 64-bit turn hashes.

Prefix groups (depth, hash) verify equality through stored turn references: every group must have one
parent hash, and the last turns of its members, reached by their row in the written table of turns, must
have one role and text. Only turns of groups with more than one reference are looked up. If two different
sequences ever share a hash, the check finds it and all is done again with other bases.

Subtrees without loops over the depth: a node belongs to its smallest member, so a conversation's own nodes
are the lowest part of its path, and what a subtree adds up to is the sum over its members of what they
own below. Leaves: the same with the smallest members of childless nodes.

Skew: positions and running sums come from ranges of the sorted turns (range-partitioned, so one long
conversation is spread), put together by the ranges' totals; groups are partial aggregates of counts,
sums and minima. The list of conversations that end at a node is hashed as a sorted stream.

Edge cases: null roles and texts are empty; rows with a null id form one conversation without base
that comes after all others (as id 2^63 - 1, which is shown as null and may not be used); a conversation
without turns cannot be in the table, but a rebuilt one may have none and is a member of the root
alone; an empty table gives an empty trie; other columns play no part, whatever their names.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package, write_shared

PRIMES = (2_147_483_647, 2_147_483_629)
BASES = ((1_103_515_245, 1_220_703_125), (1_597_334_677, 1_977_654_935), (1_289_706_101, 1_583_458_089), (1_664_525_007, 1_406_938_949))
NO_ID = (1 << 63) - 1
CELL = 4096
_POWER_BITS = 10


def _times(a: Column, b: Column, prime: int) -> Column:
    return (a * b) % F.lit(prime)


def _power(base: int, exponent: Column, prime: int) -> Column:
    """base^exponent for exponents from 0 to 2^30 by three tables of 1024 entries."""
    out = None
    for k in range(3):
        step = pow(base, 1 << _POWER_BITS * k, prime)
        table, value = [], 1
        for _ in range(1 << _POWER_BITS):
            table.append(value)
            value = value * step % prime
        digit = F.shiftright(exponent.cast("int"), _POWER_BITS * k).bitwiseAND((1 << _POWER_BITS) - 1)
        one = F.get(F.array(*map(F.lit, table)).cast("array<bigint>"), digit)
        out = one if out is None else _times(out, one, prime)
    return out


def _numbered(turns: DataFrame) -> DataFrame:
    """Written turns (c, row, f, chars) with part, pos: position in the conversation from 1.

    The turns are sorted over ranges, so the rows of a window are one range's share of a conversation."""
    order = ["c", F.asc_nulls_first("turn"), "f", "row"]
    ranged = turns.select("c", "turn", "f", "row", "chars").repartitionByRange(*order)
    ranged = write_shared(ranged.withColumn("part", F.spark_partition_id()), "trie-ranges")
    local = ranged.withColumn("local", F.row_number().over(Window.partitionBy("c", "part").orderBy(*order)))
    shares = ranged.groupBy("c", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range and conversation
    shares = shares.select("c", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return local.join(shares, ["c", "part"]).select("c", "part", "row", "f", "chars", (F.col("local") + F.col("before")).alias("pos"))


def _running(rows: DataFrame, key: str, cell: str, order: str, values: dict, inclusive: bool = True) -> DataFrame:
    """``rows`` with running sums of ``values`` (name: column) per key, by cells that ascend with ``order``: no window holds
    more than a cell's rows or a key's cells."""
    totals = rows.groupBy(key, cell).agg(*[F.sum(v).alias(f"{n}_cell") for n, v in values.items()])
    before = Window.partitionBy(key).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(key, cell, *[F.coalesce(F.sum(f"{n}_cell").over(before), F.lit(0)).alias(f"{n}_cell") for n in values])
    inside = Window.partitionBy(key, cell).orderBy(order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    found = rows.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"{n}_in") for n, v in values.items()])
    kept = [c for c in rows.columns if c not in (key, cell)]
    return found.join(totals, [key, cell]).select(key, cell, *kept, *[(F.col(f"{n}_cell") + F.col(f"{n}_in")).alias(n) for n in values])


def _prefixes(numbered: DataFrame, bases: tuple, primes: tuple) -> DataFrame:
    """(c, pos, row, chars, g0, g1): hash of the first ``pos`` turns of every original conversation."""
    terms = {f"g{k}": _times(F.pmod(F.xxhash64("f", F.lit(k)), F.lit(p)), _power(b, F.col("pos") - 1, p), p)
             for k, (b, p) in enumerate(zip(bases, primes))}
    sums = _running(numbered, "c", "part", "pos", terms)
    return sums.select("c", "pos", "row", "chars", *[F.pmod(f"g{k}", F.lit(p)).alias(f"g{k}") for k, p in enumerate(primes)])


def _entries(prefixes: DataFrame, plan: DataFrame, bases: tuple, primes: tuple) -> DataFrame:
    """(c, depth, g0, g1, p0, p1, row, chars, ends) of every prefix of every rebuilt conversation, the root included;
    p0, p1 is the hash of the prefix one turn shorter."""
    lengths = prefixes.groupBy("c").agg(F.max("pos").alias("own"))
    plan = plan.join(lengths, "c").join(lengths.select(F.col("c").alias("base"), F.col("own").alias("base_length")), "base", "left")
    plan = plan.withColumn("taken", F.least("head", F.coalesce("base_length", F.lit(0)))) \
        .withColumn("length", F.col("taken") + F.greatest(F.col("own") - F.col("head"), F.lit(0)))
    hashes = ["g0", "g1"]
    at = lambda c, pos: prefixes.select(F.col("c").alias(c), F.col("pos").alias(pos), *[F.col(g).alias(f"{c}_{g}") for g in hashes])
    plan = plan.join(at("base", "taken"), ["base", "taken"], "left").join(at("c", "head"), ["c", "head"], "left")
    plan = plan.select("c", "base", "head", "taken", "length", *[F.coalesce(f"base_{g}", F.lit(0)).alias(f"base_{g}") for g in hashes],
                       *[F.coalesce(f"c_{g}", F.lit(0)).alias(f"own_{g}") for g in hashes])
    plan = write_shared(plan, "trie-plan")
    root = plan.select("c", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("g0"), F.lit(0).cast("long").alias("g1"),
                       F.lit(None).cast("long").alias("row"), F.lit(0).cast("long").alias("chars"), "length")
    places = plan.filter("taken > 0").select("c", "base", "length", F.explode(F.sequence(F.lit(1).cast("long"), F.col("taken"))).alias("pos"))
    heads = prefixes.select(F.col("c").alias("base"), "pos", "row", "chars", *hashes).join(places, ["base", "pos"])
    heads = heads.select("c", F.col("pos").alias("depth"), *hashes, "row", "chars", "length")
    tails = prefixes.join(plan.drop("base"), "c").filter(F.col("pos") > F.col("head"))
    moved = F.col("head") - F.col("taken")  # turns that the base lacks: the suffix stands that much further to the front
    joined = []
    for k, (b, p) in enumerate(zip(bases, primes)):
        suffix = F.pmod(F.col(f"g{k}") - F.col(f"own_g{k}"), F.lit(p))
        joined.append(F.pmod(F.col(f"base_g{k}") + _times(suffix, _power(pow(b, -1, p), moved, p), p), F.lit(p)).alias(f"g{k}"))
    tails = tails.select("c", (F.col("pos") - moved).alias("depth"), *joined, "row", "chars", "length")
    return root.unionByName(heads).unionByName(tails)


def _with_parents(entries: DataFrame) -> DataFrame:
    """Entries with the hash one turn shorter, by an equi-join on (conversation, depth)."""
    above = entries.select("c", (F.col("depth") + 1).alias("depth"), F.col("g0").alias("p0"), F.col("g1").alias("p1"))
    return entries.join(above, ["c", "depth"], "left")


def _same_turns(turns: DataFrame, entries: DataFrame) -> bool:
    """Whether every group has one parent, and one role and text of its last turn."""
    group = ["depth", "g0", "g1"]
    seen = entries.groupBy(*group).agg(F.min("row").alias("first"), F.max("row").alias("last"), F.min("p0").alias("p0"), F.max("p0").alias("q0"),
                                       F.min("p1").alias("p1"), F.max("p1").alias("q1"))
    if not seen.filter((F.col("p0") != F.col("q0")) | (F.col("p1") != F.col("q1"))).isEmpty():
        return False
    doubtful = seen.filter(F.col("first") < F.col("last")).select(*group, "first")
    pairs = entries.join(doubtful, group).select("row", "first").distinct()
    texts = pairs.join(turns.select("row", "role", "text"), "row").groupBy("first", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    return texts.groupBy("first").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()


def _hash_ends(batches):
    """Rows (depth, g0, g1, c) sorted by group and c to one hash of the comma-joined ids per group."""
    import pyarrow as pa

    names = ["depth", "g0", "g1", "ends_sha256"]
    kinds = [pa.int64()] * 3 + [pa.string()]
    last, digest, done = None, None, []

    def out():
        found = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)
        done.clear()
        return found

    for batch in batches:
        for depth, g0, g1, c in zip(*(batch.column(n).to_pylist() for n in ("depth", "g0", "g1", "c"))):
            key, text = (depth, g0, g1), b"" if c == NO_ID else str(c).encode()
            if key != last:
                if last is not None:
                    done.append((*last, digest.hexdigest()))
                last, digest = key, hashlib.sha256(text)
            elif text:
                digest.update(b"," + text)
        if len(done) >= 1000:
            yield out()
    if last is not None:
        done.append((*last, digest.hexdigest()))
        yield out()


def _statistics(entries: DataFrame) -> DataFrame:
    """One row per group of verified entries."""
    group = ["depth", "g0", "g1"]
    nodes = entries.groupBy(*group).agg(F.min("c").alias("owner"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"),
                                        F.min("p0").alias("p0"), F.min("p1").alias("p1"))
    nodes = write_shared(nodes, "trie-nodes")
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p0").alias("g0"), F.col("p1").alias("g1")) \
        .agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, group, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("g0").alias("p0"), F.col("g1").alias("p1"), F.col("owner").alias("parent"))
    nodes = nodes.join(parents, ["depth", "p0", "p1"], "left").withColumn("cell", F.floor(F.col("depth") / CELL)) \
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("chars"))
    nodes = write_shared(_running(nodes, "owner", "cell", "depth", {"above": F.col("saved")}, inclusive=False), "trie-owned")
    own = nodes.groupBy(F.col("owner").alias("c")).agg(F.sum("saved").alias("total"), F.max((F.col("n_children") == 0).cast("int")).alias("leaf"))
    below = entries.select("c", *group).join(own, "c").groupBy(*group).agg(F.sum("total").alias("totals"), F.sum("leaf").alias("n_leaves"))
    at = ["c", *group]
    ends = entries.filter(F.col("depth") == F.col("length")).select(*at).repartition(*group).sortWithinPartitions(*group, "c") \
        .mapInArrow(_hash_ends, "depth long, g0 long, g1 long, ends_sha256 string")
    rows = nodes.join(below, group, "left").join(ends, group, "left")  # a node's owner is a member that owns it, so it has sums
    own_total = rows.join(own.select(F.col("c").alias("owner"), "total"), "owner")
    show = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    saved = F.col("totals") - F.col("total") + (F.col("total") - F.col("above"))  # the owner adds what it owns from here on only
    return own_total.select(show("owner").alias("conv_id"), "depth", show("parent").alias("parent_conv_id"), "n_convs", "n_children",
                            F.col("n_leaves").cast("long").alias("n_leaves"), saved.cast("long").alias("saved_tokens"),
                            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def prefix_trie(turns: DataFrame, base: Column | None = None, head: Column | None = None, id_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text", bases: tuple = BASES, primes: tuple = PRIMES) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    (characters that members after the first share, over the subtree), ends_sha256.

    ``base`` and ``head`` are expressions of the column ``c`` (the conversation's id) that give its base conversation and the
    number of turns taken from there; without them every conversation stands for itself.
    """
    ship_package(turns.sparkSession)
    q = lambda c: F.col(f"`{c}`")
    own = turns.select(F.coalesce(q(id_col).cast("long"), F.lit(NO_ID)).alias("c"), q(turn_col).alias("turn"),
                       F.coalesce(q(role_col), F.lit("")).alias("role"), F.coalesce(q(text_col), F.lit("")).alias("text"))
    own = own.withColumn("f", F.xxhash64("role", "text")).withColumn("chars", F.length("text").cast("long")) \
        .withColumn("row", F.monotonically_increasing_id())
    own = write_shared(own, "trie-turns")
    numbered = write_shared(_numbered(own), "trie-numbered")
    is_id = F.col("c") != NO_ID
    plan = numbered.select("c").distinct().select(
        "c", (F.when(is_id, base) if base is not None else F.lit(None)).cast("long").alias("base"),
        F.coalesce(F.when(is_id, head) if head is not None else F.lit(0), F.lit(0)).cast("long").alias("head"))
    for pair in bases:
        prefixes = write_shared(_prefixes(numbered, pair, primes), "trie-prefixes")
        entries = write_shared(_with_parents(_entries(prefixes, plan, pair, primes)), "trie-entries")
        if _same_turns(own, entries):
            return _statistics(entries)
    raise RuntimeError("different turns share a hash under every pair of bases")
