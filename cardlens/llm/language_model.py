"""Language-model scores by deleted interpolation.

P(w | v) = L2(b) c(v w) / c(v) + L1(b) c(w) / N + L0(b) / (V + 1), with b the frequency
bucket of the context (0, or 1 + log2 of its count). c are maximum-likelihood counts
over the texts that may be learnt from. The mixture weights of each bucket are learnt
by expectation-maximisation on deleted counts: every learning token is taken out of
its own counts, so its estimates come from all other tokens.

How counts meet tokens. Texts go in blocks of about ``BLOCK_BYTES``, which are written once to the
shared folder; all later steps read them from there, so they agree whatever order the input
comes in. A block asks for
each of its different words and word pairs once: sorted 64-bit keys, with its own
learning counts, packed into one row per key range. The rows of a key range meet in one
group, which sums up and answers each block with the totals in the order asked; the
answers meet the block's texts again, and the tokens have their counts. A frequent
word costs one entry per block, so no key is heavy. There is a key range for every
``RANGE_BYTES`` of text, so a group holds the different keys of about that much text whatever the corpus;
a block has at most one row per key. What is shuffled and written grows with the corpus.
The driver gets N, V and the deleted counts' histogram on a fixed logarithmic grid.

Words are told apart by a 64-bit hash. Edge cases: null and empty texts are one end
token; ids may be null or repeated, each row is scored on its own; without any
learning text the score is that of the uniform distribution over V + 1 = 1; an
empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package, write_shared
from .columns import named

BLOCK_BYTES = 6 << 20
RANGE_BYTES = 12 << 20
MIN_RANGES = 64
TEXT_LEVEL = 6  # of compression, for texts that are written and sent once each
STEPS = 4  # histogram cells per doubling
ROUNDS = 60
_END, _START = np.uint64(0x9AE16A3B2F90404F), np.uint64(0xC3A5C85C97CB3127)
_NEVER = -1000  # grid place of a zero count


def learns_from(id_col: str = "doc_id", folds: int = 7, fold: int = 2) -> Column:
    """Rows that the model is learnt from, by the checksum of their id; a null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds != fold


class _Tokens:
    """Tokens of a block: words, and an end after each text."""

    def __init__(self, data, bounds):
        from .textarrays import mix64, slices, word_hashes, words

        parts, counts = [], []
        for low, high in slices(bounds):
            starts, stops, first = words(data, bounds[low:high + 1])
            parts.append(word_hashes(data, starts, stops))
            counts.append(np.diff(first))
        n = np.concatenate(counts) if counts else np.empty(0, np.int64)
        found = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        self.lengths = n + 1
        self.first = np.concatenate([[0], np.cumsum(self.lengths)])
        tokens = np.full(int(self.first[-1]), _END, np.uint64)
        is_word = np.ones(len(tokens), bool)
        is_word[self.first[1:] - 1] = False
        tokens[is_word] = found
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[self.first[:-1]] = _START
        with np.errstate(over="ignore"):
            pairs = mix64(before * np.uint64(0x9E3779B97F4A7C15) + tokens)
        self.word_keys, self.word_at = np.unique(tokens, return_inverse=True)
        self.pair_keys, self.pair_at = np.unique(pairs, return_inverse=True)


def _blocks(batches, columns: int):
    """(block id, other columns, text bytes, bounds) of about BLOCK_BYTES."""
    import pyarrow as pa
    from pyspark import TaskContext

    from .textarrays import slices, text_bytes

    number = TaskContext.get().partitionId() << 32
    rest, texts, lengths, size = [], [], [], 0

    def done():
        joined = [pa.concat_arrays([r[i] for r in rest]) for i in range(columns)]
        bounds = np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
        return number, joined, np.concatenate(texts), bounds

    for batch in batches:
        data, bounds = text_bytes(batch.column(columns))
        for low, high in slices(bounds):
            rest.append([c.slice(low, high - low) for c in batch.columns[:columns]])
            texts.append(data[bounds[low]:bounds[high]])
            lengths.append(np.diff(bounds[low:high + 1]))
            size += int(bounds[high] - bounds[low])
            if size >= BLOCK_BYTES:
                yield done()
                rest, texts, lengths, size = [], [], [], 0
                number += 1
    if rest:
        yield done()


def _stored(batches):
    """(block id, learn flags, text bytes, bounds) of written blocks, one at a time."""
    from .packing import unpack_bytes

    for batch in batches:
        for i in range(batch.num_rows):
            learn, lengths = (batch.column(c).slice(i, 1).flatten() for c in ("learn", "lengths"))
            data = np.frombuffer(unpack_bytes(batch.column("data")[i].as_py()), np.uint8)
            yield batch.column("block")[i].as_py(), learn, data, np.concatenate([[0], np.cumsum(lengths.to_numpy())])


def _ask(ranges: int):
    """Rows (kind, key range, block, keys, counts): what a block asks for."""
    def run(batches):
        import pyarrow as pa

        from .packing import pack_ints

        edges = (np.arange(1, ranges).astype(object) * (1 << 64) // ranges).astype(np.uint64)
        for block, learn, data, bounds in _stored(batches):
            tokens = _Tokens(data, bounds)
            learn = np.repeat(learn.to_numpy(zero_copy_only=False).astype(bool), tokens.lengths)
            out = []
            for kind, keys, at in ((1, tokens.word_keys, tokens.word_at), (2, tokens.pair_keys, tokens.pair_at)):
                counts = np.bincount(at, weights=learn, minlength=len(keys)).astype(np.uint64)
                cuts = [0, *np.searchsorted(keys, edges), len(keys)]
                out += [(kind, r, block, pack_ints(keys[a:b], True), pack_ints(counts[a:b]))
                        for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
            yield pa.RecordBatch.from_pylist([dict(zip(("kind", "range", "block", "keys", "counts"), x)) for x in out],
                                             pa.schema([("kind", pa.int32()), ("range", pa.int32()), ("block", pa.int64()),
                                                        ("keys", pa.binary()), ("counts", pa.binary())]))
    return run


_ANSWER = "block bigint, kind int, range int, totals binary"


def _answer(key, table):
    """Totals of one key range for each block that asked; block -1 gets the number of learnt keys and tokens."""
    import pyarrow as pa

    from .packing import pack_ints, unpack_ints

    keys = [unpack_ints(k.as_py(), True) for k in table.column("keys")]
    counts = [unpack_ints(c.as_py()) for c in table.column("counts")]
    each, at = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(at, weights=np.concatenate(counts).astype(float), minlength=len(each)).astype(np.uint64)
    cuts = np.cumsum([0, *map(len, keys)])
    cells = [pack_ints(totals[at[a:b]]) for a, b in zip(cuts[:-1], cuts[1:])]
    cells.append(pack_ints(np.array([(totals > 0).sum(), totals.sum()])))
    n = len(cells)
    kind, place = key[0].as_py(), key[1].as_py()
    return pa.table({"block": pa.array([*table.column("block").to_pylist(), -1], pa.int64()), "kind": pa.array([kind] * n, pa.int32()),
                     "range": pa.array([place] * n, pa.int32()), "totals": pa.array(cells, pa.binary())})


def _send(batches):
    """Rows (block, ids, learn, lengths, data): the texts of a block."""
    import pyarrow as pa

    from .packing import pack_bytes

    for block, (ids, learn), data, bounds in _blocks(batches, 2):
        whole = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), whole(ids), whole(learn), whole(pa.array(np.diff(bounds), pa.int64())),
             pa.array([pack_bytes(data.tobytes(), TEXT_LEVEL)], pa.binary())], ["block", "ids", "learn", "lengths", "data"])


def bucket(counts: np.ndarray) -> np.ndarray:
    """Frequency bucket of a context: 0 if unseen, else 1 + the integer part of log2."""
    return np.where(counts > 0, 1 + np.floor(np.log2(np.maximum(counts, 1))), 0).astype(np.int64)


def _grid(values: np.ndarray) -> np.ndarray:
    return np.where(values > 0, np.round(STEPS * np.log2(np.where(values > 0, values, 1))), _NEVER).astype(np.int64)


def _counted(kind: str):
    """Join texts and answers of a block: rows with every token's counts and the block's deleted-count histogram."""
    schema = f"ids array<{kind}>, learn array<boolean>, tokens array<bigint>, words binary, pairs binary, cells array<bigint>, " \
             "times array<bigint>, distinct bigint, total bigint"

    def run(key, texts, answers):
        import pyarrow as pa

        from .packing import pack_ints, unpack_bytes, unpack_ints

        rows = sorted(zip(answers.column("kind").to_pylist(), answers.column("range").to_pylist(), answers.column("totals").to_pylist()))
        if key[0].as_py() < 0:
            stats = [unpack_ints(t) for k, _, t in rows if k == 1]
            lists = [pa.array([None], f.type) for f in _arrow_schema(texts)]
            return pa.Table.from_arrays([*lists, pa.array([int(sum(s[0] for s in stats))], pa.int64()),
                                         pa.array([int(sum(s[1] for s in stats))], pa.int64())], names=_NAMES)
        ids, learn, lengths = (texts.column(c).chunk(0).values if texts.column(c).num_chunks == 1 else texts.column(c).combine_chunks().values
                               for c in ("ids", "learn", "lengths"))
        data = np.frombuffer(unpack_bytes(texts.column("data")[0].as_py()), np.uint8)
        tokens = _Tokens(data, np.concatenate([[0], np.cumsum(lengths.to_numpy())]))
        totals = {k: np.concatenate([unpack_ints(t) for kk, _, t in rows if kk == k]).astype(np.int64) for k in (1, 2)}
        if len(totals[1]) != len(tokens.word_keys) or len(totals[2]) != len(tokens.pair_keys):
            raise RuntimeError("a block's answers do not fit its texts")
        word, pair = totals[1][tokens.word_at], totals[2][tokens.pair_at]
        context = np.empty_like(word)
        context[1:] = word[:-1]
        context[tokens.first[:-1]] = word[tokens.first[1:] - 1]  # as many starts as ends
        own = np.repeat(learn.to_numpy(zero_copy_only=False).astype(bool), tokens.lengths)
        c, p, w = context[own] - 1, pair[own] - 1, word[own] - 1
        ratio = np.where(c > 0, p / np.maximum(c, 1), 0.0)
        cells, times = np.unique((bucket(c) << 40) | ((_grid(ratio) + 2048) << 20) | (_grid(w.astype(float)) + 2048), return_counts=True)
        one = lambda a, t: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), pa.array(a, t))
        whole = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
        return pa.Table.from_arrays(
            [whole(ids), whole(learn), one(tokens.lengths, pa.int64()), pa.array([pack_ints(word)], pa.binary()),
             pa.array([pack_ints(pair)], pa.binary()), one(cells, pa.int64()), one(times, pa.int64()),
             pa.array([None], pa.int64()), pa.array([None], pa.int64())], names=_NAMES)
    return run, schema


_NAMES = ["ids", "learn", "tokens", "words", "pairs", "cells", "times", "distinct", "total"]


def _arrow_schema(texts):
    import pyarrow as pa

    numbers = pa.list_(pa.int64())
    ids = texts.schema.field("ids").type
    return pa.schema([("ids", ids), ("learn", pa.list_(pa.bool_())), ("tokens", numbers), ("words", pa.binary()), ("pairs", pa.binary()),
                      ("cells", numbers), ("times", numbers)])


@dataclass(frozen=True)
class Model:
    """N, V and the mixture weights (pair, word, uniform) of every context bucket."""

    total: int
    distinct: int
    weights: np.ndarray


def learn_weights(cells: np.ndarray, times: np.ndarray, total: int, distinct: int, rounds: int = ROUNDS) -> np.ndarray:
    """Expectation-maximisation on the deleted-count histogram, each bucket on its own. A bucket that has no
    token takes the weights of the next smaller one."""
    buckets = 64
    weights = np.tile([0.0, 0.5, 0.5] if total else [0.0, 0.0, 1.0], (buckets, 1))
    where = cells >> 40
    back = lambda g: np.where(g == _NEVER, 0.0, 2.0 ** (np.where(g == _NEVER, 0, g) / STEPS))
    ratio = np.minimum(back(((cells >> 20) & 0xFFFFF) - 2048), 1.0)
    word = np.minimum(back((cells & 0xFFFFF) - 2048) / max(total - 1, 1), 1.0)
    parts = np.column_stack([ratio, word, np.full(len(cells), 1.0 / (distinct + 1))])
    for b in range(buckets):
        mine = where == b
        if not mine.any():
            weights[b] = weights[b - 1] if b else weights[b]
            continue
        p, n, lam = parts[mine], times[mine].astype(float), np.array([0.4, 0.4, 0.2])
        for _ in range(rounds):
            mixed = p * lam
            lam = (n[:, None] * mixed / mixed.sum(1, keepdims=True)).sum(0) / n.sum()
            lam = np.maximum(lam, [0.0, 0.0, 1e-9])  # an unseen word keeps a probability
            lam /= lam.sum()
        weights[b] = lam
    return weights


def probabilities(model: Model, word: np.ndarray, pair: np.ndarray, context: np.ndarray) -> np.ndarray:
    """P of each token from its own, its pair's and its context's count."""
    lam = model.weights[bucket(context)]
    direct = np.where(context > 0, pair / np.maximum(context, 1), 0.0)
    return lam[:, 0] * direct + lam[:, 1] * (word / max(model.total, 1)) + lam[:, 2] / (model.distinct + 1)


def _score_batches(model: Model):
    def run(batches):
        import pyarrow as pa

        from .packing import unpack_ints

        for batch in batches:
            for i in range(batch.num_rows):
                ids, learn, lengths = (batch.column(c).slice(i, 1).flatten() for c in ("ids", "learn", "tokens"))
                n = lengths.to_numpy()
                first = np.concatenate([[0], np.cumsum(n)])
                word, pair = (unpack_ints(batch.column(c)[i].as_py()).astype(np.int64) for c in ("words", "pairs"))
                context = np.empty_like(word)
                context[1:] = word[:-1]
                context[first[:-1]] = word[first[1:] - 1]
                sums = lambda v: np.add.reduceat(v, first[:-1])
                base = sums(np.log10((word + 1.0) / (model.total + model.distinct + 1.0)))
                score = sums(np.log10(probabilities(model, word, pair, context)))
                yield pa.RecordBatch.from_arrays([ids, learn, lengths, pa.array(sums((word > 0).astype(np.int64))), pa.array(base), pa.array(score)],
                                                 ["id", "learn", "n_tokens", "n_known", "base_score", "score"])
    return run


def score_texts(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Model]:
    """(id, learn, n_tokens, n_known, base_score, score) of every row, and the model learnt from the rows where ``learn``.

    base_score is the unigram model with one added to every count, over V + 1 types.
    """
    spark = docs.sparkSession
    ship_package(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(named(id_col).alias("id"), F.coalesce(learn, F.lit(False)).alias("learn"), named(text_col).alias("text"))
    texts = write_shared(rows.mapInArrow(_send, f"block bigint, ids array<{kind}>, learn array<boolean>, lengths array<bigint>, data binary"), "text-blocks")
    size = texts.select(F.explode("lengths").alias("n")).agg(F.sum("n")).first()[0] or 0
    ranges = max(MIN_RANGES, -(-size // RANGE_BYTES))
    asked = texts.select("block", "learn", "lengths", "data").mapInArrow(_ask(ranges), "kind int, range int, block bigint, keys binary, counts binary")
    answers = asked.groupBy("kind", "range").applyInArrow(_answer, _ANSWER)
    join, schema = _counted(kind)
    counted = write_shared(texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(join, schema), "token-counts")
    stats = counted.agg(F.sum("total"), F.sum("distinct")).first()
    total, distinct = stats[0] or 0, stats[1] or 0
    grid = counted.select(F.explode(F.arrays_zip("cells", "times")).alias("x")).groupBy(F.col("x.cells").alias("cell")) \
        .agg(F.sum("x.times").alias("n")).orderBy("cell").collect()  # at most one row per cell of the grid
    cells, times = (np.array([r[i] for r in grid], np.int64) for i in (0, 1))
    model = Model(total, distinct, learn_weights(cells, times, total, distinct))
    scored = counted.filter(F.col("ids").isNotNull()).select("ids", "learn", "tokens", "words", "pairs") \
        .mapInArrow(_score_batches(model), f"id {kind}, learn boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    return scored.withColumnRenamed("id", id_col), model
