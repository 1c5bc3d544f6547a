"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingles.

Texts are cut into lower-case words (runs of ASCII letters, digits and characters
beyond ASCII) and five-word shingles. An item is contained in a document if at
least ``CONTAINMENT`` of its distinct shingles occur in it. An item of one to four words is one
shingle, its whole sequence, and is looked up among the documents' shingles of that width.

Items are partitioned by size (powers of two of their number of shingles). A
partition with largest size u keeps of each item the m = u - ceil(t * u) + 1
shingles of smallest hash (its bottom-m MinHash). A document that lacks fewer than
m of an item's shingles has one of these, so looking the sketches up in the
documents' shingles loses no pair whatever a document's length. (Sketches of
fixed length for the documents would: an item of 40 shingles wholly inside a text of
20,000 words has a Jaccard similarity of 0.002, which 256 minimum hashes miss
in 60 of 100 cases.)

The documents are read once. A bitmap of fixed size (``2**BITS`` bits, 2 MB) of the
items' shingle hashes goes to the tasks and lets through the shingles that may be
an item's; only these, as text, leave the task. Candidates are an equi-join of
sketch shingles; each candidate pair is then verified by intersecting the two sets of
shingle texts. If the items outgrow the bitmap it lets more through, which costs
time and changes no result.

Edge cases: null and empty texts have no shingles, so such items are in no pair; repeated rows give one result row per
(doc, item); rows of one id are searched one by one and the largest containment
counts; a null id is kept as it is; empty tables give an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship_package, write_shared
from .columns import fresh, named, null_safe_join

WIDTH = 5
CONTAINMENT = 0.8
BITS = 24
_ALL, _SKETCH = 0, 1


def _shingles(data, bounds, width):
    """Hash, first byte and end byte of every shingle, and each text's first one."""
    from .textarrays import ALNUM_WORDS, mix64, word_hashes, words

    starts, stops, first = words(data, bounds, ALNUM_WORDS)
    hashes = word_hashes(data, starts, stops)
    n = np.maximum(np.diff(first) - width + 1, 0)
    if len(hashes) < width:
        return np.empty(0, np.uint64), starts[:0], stops[:0], np.zeros(len(n) + 1, np.int64)
    with np.errstate(over="ignore"):
        rolled = np.zeros(len(hashes) - width + 1, np.uint64)
        for k in range(width):
            rolled = rolled * np.uint64(0xD6E8FEB86659FD93) + hashes[k:len(hashes) - width + 1 + k]
    text_of = np.repeat(np.arange(len(n)), np.diff(first))
    whole = np.flatnonzero(text_of[:len(rolled)] == text_of[width - 1:])
    edges = np.concatenate([[0], np.cumsum(n)])
    return mix64(rolled[whole]), starts[whole], stops[whole + width - 1], edges


def _spelled(data, start, stop) -> str:
    """A shingle's words, lower-case, one space between them."""
    from .textarrays import ALNUM_WORDS

    part = data[start:stop]
    return b" ".join(np.where(ALNUM_WORDS[part], part, 32).astype(np.uint8).tobytes().lower().split()).decode("utf-8", "replace")


def _item_batches(width: int):
    def run(batches):
        import pyarrow as pa

        from .textarrays import slices, text_bytes

        for batch in batches:
            data, bounds = text_bytes(batch.column(1))
            for low, high in slices(bounds):
                for w in range(width, 0, -1):
                    hashes, starts, stops, edges = _shingles(data, bounds[low:high + 1], w)
                    n = np.diff(edges)
                    owner = np.repeat(np.arange(low, high), n)
                    if w < width:  # the whole of a text of so few words
                        whole = np.repeat(n == 1, n)
                        hashes, starts, stops, owner = hashes[whole], starts[whole], stops[whole], owner[whole]
                    texts = [_spelled(data, a, b) for a, b in zip(starts, stops)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner, pa.int64())), pa.array(hashes.view(np.int64)),
                                                      pa.array(texts, pa.string()), pa.array([w] * len(texts), pa.int32())],
                                                     ["item", "hash", "shingle", "width"])
    return run


def item_shingles(items: DataFrame, id_col: str = "item_id", text_col: str = "text", width: int = WIDTH,
                  containment: float = CONTAINMENT) -> DataFrame:
    """(item, hash, shingle, width, n_shingles, in_sketch): the distinct shingles of every item, those of its sketch marked."""
    ship_package(items.sparkSession)
    kind = items.schema[id_col].dataType.simpleString()
    rows = items.select(named(id_col), named(text_col)).mapInArrow(_item_batches(width), f"item {kind}, hash bigint, shingle string, width int").distinct()
    sizes = rows.groupBy("item").agg(F.count(F.lit(1)).alias("n_shingles"))
    rows = null_safe_join(rows, sizes, ["item"], "inner")
    upper = F.expr("shiftleft(1L, cast(ceil(log2(n_shingles)) as int))")  # largest size of the partition
    keep = upper - F.ceil(containment * upper - 1e-9) + 1
    by_hash = Window.partitionBy("item").orderBy("hash", "shingle")
    return rows.withColumn("in_sketch", F.row_number().over(by_hash) <= keep)


def _bitmap(shingles: DataFrame, bits: int) -> np.ndarray:
    """Bit i is set if a hash starts with the bits of i; at most 2**(bits - 6) rows reach the driver."""
    cell = F.shiftrightunsigned("hash", 64 - bits)
    one = F.expr("shiftleft(1L, cast(cell & 63 as int))")
    found = shingles.select(cell.alias("cell")).groupBy(F.shiftright("cell", 6).alias("word")).agg(F.bit_or(one).alias("bits")).collect()
    out = np.zeros(1 << (bits - 6), np.int64)
    for r in found:
        out[r["word"]] = r["bits"]
    return out


def _hit_batches(widths: list, bits: int, bitmaps):
    def run(batches):
        import pyarrow as pa

        from .textarrays import slices, text_bytes

        every, sketch = bitmaps.value

        def listed(bitmap, hashes):
            cell = hashes >> np.uint64(64 - bits)
            return (bitmap[(cell >> np.uint64(6)).astype(np.int64)] >> (cell & np.uint64(63)).astype(np.int64)) & 1 == 1

        for batch in batches:
            data, bounds = text_bytes(batch.column(2))
            owners, hits, firsts = [], [], []
            for low, high in slices(bounds):
                found: dict = {}
                for width in widths:
                    hashes, starts, stops, edges = _shingles(data, bounds[low:high + 1], width)
                    some = np.flatnonzero(listed(every, hashes))
                    first = listed(sketch, hashes[some])
                    owner = np.searchsorted(edges, some, side="right") - 1 + low
                    for i, o, s in zip(some, owner, first):
                        found.setdefault(int(o), {}).setdefault(_spelled(data, starts[i], stops[i]), bool(s))
                for o, texts in found.items():
                    if any(texts.values()):
                        owners.append(o)
                        hits.append(list(texts))
                        firsts.append([t for t, s in texts.items() if s])
            pick = pa.array(owners, pa.int64())
            lists = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pick), batch.column(1).take(pick), pa.array(hits, lists), pa.array(firsts, lists)],
                                             ["doc", "text_key", "hits", "sketch_hits"])
    return run


def _leaking(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text",
             width: int = WIDTH, containment: float = CONTAINMENT, bits: int = BITS) -> DataFrame:
    """(doc, text_key, item, n_shared, n_shingles, width) of every different row, by id and text, that contains an item;
    ``width`` is that of its shingles, below five for an item of so few words."""
    spark: SparkSession = docs.sparkSession
    listed = write_shared(item_shingles(items, item_col, text_col, width, containment), "item-shingles")
    bitmaps = spark.sparkContext.broadcast((_bitmap(listed, bits), _bitmap(listed.filter("in_sketch"), bits)))
    widths = sorted(r["width"] for r in listed.select("width").distinct().collect())  # at most five
    kind = docs.schema[id_col].dataType.simpleString()
    text = named(text_col)
    sent = docs.select(named(id_col).alias("doc"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    hits = sent.mapInArrow(_hit_batches(widths, bits, bitmaps),
                           f"doc {kind}, text_key bigint, hits array<string>, sketch_hits array<string>")
    hits = write_shared(hits, "shingle-hits")
    probe = hits.select("doc", "text_key", F.explode("sketch_hits").alias("shingle"))
    candidates = probe.join(listed.filter("in_sketch").select("shingle", "item"), "shingle").select("doc", "text_key", "item").distinct()
    whole = listed.groupBy("item", "n_shingles", "width").agg(F.collect_list("shingle").alias("shingles"))
    pairs = null_safe_join(candidates, hits.select("doc", "text_key", "hits").dropDuplicates(["doc", "text_key"]), ["doc", "text_key"], "inner")
    pairs = null_safe_join(pairs, whole, ["item"], "inner")
    pairs = pairs.select("doc", "text_key", "item", F.size(F.array_intersect("hits", "shingles")).cast("long").alias("n_shared"), "n_shingles", "width")
    return pairs.filter(F.col("n_shared") >= containment * F.col("n_shingles") - 1e-9)


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text",
               width: int = WIDTH, containment: float = CONTAINMENT, bits: int = BITS) -> DataFrame:
    """(doc id, item id, n_shared, n_shingles, containment, shingle_words) of every document that contains an item."""
    best = _leaking(docs, items, id_col, item_col, text_col, width, containment, bits).groupBy("doc", "item", "n_shingles", "width") \
        .agg(F.max("n_shared").alias("n_shared"))
    return best.select(F.col("doc").alias(id_col), F.col("item").alias(item_col), "n_shared", "n_shingles",
                       (F.col("n_shared") / F.col("n_shingles")).alias("containment"), F.col("width").alias("shingle_words"))


def drop_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 1, **options) -> DataFrame:
    """``docs`` without exactly the rows whose text contains an item of ``min_words`` words or more (``WIDTH`` at most counts:
    longer items are never left out), whatever other rows share their id or have none."""
    one, two = fresh(docs.columns, "leak_id"), fresh(docs.columns, "text_key")
    leaked = _leaking(docs, items, id_col, text_col=text_col, **options).filter(F.col("width") >= min(min_words, WIDTH)) \
        .select(F.col("doc").alias(one), F.col("text_key").alias(two)).distinct()
    keyed = docs.withColumn(one, named(id_col)).withColumn(two, F.xxhash64(named(text_col)))
    return null_safe_join(keyed, leaked, [one, two], "left_anti").select(*[named(c) for c in docs.columns])
