"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum_j w_j x_j + sum_{i<j} <v_i, v_j> x_i x_j). The pairwise term is
taken in linear time by the sum-of-squares identity, 1/2 sum_f ((sum_j v_jf x_j)^2
- sum_j v_jf^2 x_j^2). Inputs are the text's words hashed into ``2**WORD_BITS``
columns (counts scaled to length 1), statistics of its characters, lines and
repetition, and its length as metadata; ids, sources, languages and labels are
never inputs of a score.

Training takes a bounded sample: of the rows that may be learnt from, the
``TRAIN_ROWS`` whose id hashes lowest; their features (not their texts) go to the
driver, where Adagrad runs ``EPOCHS`` passes. The model has a fixed size (about 2.4 MB)
and goes to the tasks as is. Scoring is one pass over the text, no shuffle.

Edge cases: null and empty texts have no words, and a score of their structure
alone; a missing or one-sided set of labels gives the constant score of its share
(0.5 without any); null labels and labels without a document are not learnt from;
repeated rows are scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .columns import fresh, named

WORD_BITS = 16
FACTORS = 8
TRAIN_ROWS = 4000
EPOCHS = 30
BATCH = 128
RATE = 0.1
WORD_DECAY, STRUCTURE_DECAY = 1e-3, 1e-5
CLIP = 4.0
STRUCTURE = ("log_words", "log_chars", "word_length", "upper", "digits", "symbols", "exclamations", "punctuation",
             "non_ascii", "lines_per_word", "distinct_words", "same_as_before", "top_word")


def held_out(id_col: str = "doc_id", folds: int = 3, fold: int = 1) -> Column:
    """Rows that are never learnt from, by the checksum of their id; a null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold


def _byte_classes() -> np.ndarray:
    classes = np.zeros((256, 7), bool)
    classes[65:91, 0] = True  # upper
    classes[48:58, 1] = True  # digits
    classes[list(b"#*$%&|<>"), 2] = True
    classes[ord("!"), 3] = True
    classes[list(b".,;:?'\"()-"), 4] = True
    classes[192:, 5] = True  # first byte of a character beyond ASCII
    classes[10, 6] = True
    return classes


def features(data: np.ndarray, bounds: np.ndarray):
    """Structure matrix (texts x len(STRUCTURE)) and the word part as (text, column, value) arrays."""
    from .textarrays import word_hashes, words

    part, at = data[bounds[0]:bounds[-1]], bounds - bounds[0]
    starts, stops, first = words(data, bounds)
    n = len(bounds) - 1
    n_words = np.diff(first)
    some = np.maximum(n_words, 1)

    def sums(values, edges):
        total = np.concatenate([[0], np.cumsum(values)])
        return total[edges[1:]] - total[edges[:-1]]

    table = _byte_classes()
    upper, digits, symbols, bangs, points, wide, lines = (sums(table[:, i][part], at) for i in range(7))
    chars = sums((part & 0xC0) != 0x80, at)
    letters = np.maximum(chars, 1)
    hashes = word_hashes(data, starts, stops)
    column = (hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    text_of = np.repeat(np.arange(n), n_words)
    keys, counts = np.unique((text_of << WORD_BITS) | column, return_counts=True)
    row, column = keys >> WORD_BITS, keys & ((1 << WORD_BITS) - 1)
    distinct = np.bincount(row, minlength=n)
    norm = np.sqrt(np.bincount(row, weights=counts.astype(float) ** 2, minlength=n))
    top = np.zeros(n)
    np.maximum.at(top, row, counts)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (text_of[1:] == text_of[:-1])
    structure = np.column_stack([
        np.log1p(n_words), np.log1p(chars), sums(stops - starts, first) / some, upper / letters, digits / letters, symbols / letters,
        bangs / letters, points / letters, wide / letters, np.log1p(lines) - np.log1p(n_words), distinct / some,
        sums(same, first) / some, top / some])
    return structure, row, column, counts / norm[row] if len(row) else counts.astype(float)


@dataclass(frozen=True)
class Model:
    """w0, linear weights and factors (words first, then structure), and the structure columns' scaling."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    def structure(self, raw: np.ndarray) -> np.ndarray:
        return np.clip((raw - self.mean) / self.spread, -CLIP, CLIP) / np.sqrt(len(STRUCTURE))

    def score(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        raw, row, column, value = features(data, bounds)
        return _sigmoid(_forward(self.bias, self.linear, self.factors, self.structure(raw), row, column, value)[0])


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def _per_row(values, row, n):
    """Sums of rows of ``values`` by the sorted row numbers ``row``."""
    out = np.zeros((n, *values.shape[1:]))
    if len(row):
        at = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        out[row[at]] = np.add.reduceat(values, at, axis=0)
    return out


def _forward(bias, linear, factors, structure, row, column, value):
    """The margin, and the factor sums that its gradient needs."""
    n, words = len(structure), 1 << WORD_BITS
    vx = factors[column] * value[:, None]
    total = _per_row(vx, row, n) + structure @ factors[words:]
    squares = _per_row((vx * vx).sum(1), row, n) + (structure ** 2) @ (factors[words:] ** 2).sum(1)
    z = bias + _per_row(linear[column] * value, row, n) + structure @ linear[words:] + 0.5 * ((total ** 2).sum(1) - squares)
    return z, total


def fit_rows(rows: list, seed: int = 0) -> Model:
    """Fit on (structure, columns, values, label) rows by Adagrad on the log loss."""
    words, width = 1 << WORD_BITS, len(STRUCTURE)
    labels = np.array([r[3] for r in rows], float)
    share = float(labels.mean()) if len(rows) else 0.5
    zero = Model(0.0, np.zeros(words + width), np.zeros((words + width, FACTORS)), np.zeros(width), np.ones(width))
    if not len(rows) or not 0 < share < 1:
        return Model(float(np.log((share + 1e-9) / (1 - share + 1e-9))), zero.linear, zero.factors, zero.mean, zero.spread)
    raw = np.array([r[0] for r in rows], float)
    spread = raw.std(0)
    model = Model(0.0, zero.linear, zero.factors, raw.mean(0), np.where(spread > 1e-9, spread, 1.0))
    structure = model.structure(raw)
    random = np.random.default_rng(seed)
    linear, factors = model.linear, random.normal(0, 0.01, (words + width, FACTORS))
    bias, seen_bias, seen_linear, seen_factors = 0.0, 1e-8, np.full(words + width, 1e-8), np.full((words + width, FACTORS), 1e-8)
    weight = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share))  # both classes count alike
    for _ in range(EPOCHS):
        order = random.permutation(len(rows))
        for low in range(0, len(rows), BATCH):
            pick = order[low:low + BATCH]
            row = np.repeat(np.arange(len(pick)), [len(rows[i][1]) for i in pick])
            column = np.concatenate([rows[i][1] for i in pick]).astype(np.int64)
            value = np.concatenate([rows[i][2] for i in pick]).astype(float)
            x = structure[pick]
            z, total = _forward(bias, linear, factors, x, row, column, value)
            g = (_sigmoid(z) - labels[pick]) * weight[pick] / len(pick)
            used, place = np.unique(column, return_inverse=True)
            sum_up = lambda v: np.bincount(place, weights=v, minlength=len(used))
            at = np.concatenate([used, np.arange(words, words + width)])
            decay = np.concatenate([np.full(len(used), WORD_DECAY), np.full(width, STRUCTURE_DECAY)])
            grad = np.concatenate([sum_up(g[row] * value), g @ x]) + decay * linear[at]
            own = np.concatenate([sum_up(g[row] * value ** 2), g @ (x ** 2)])
            pull = np.vstack([np.column_stack([sum_up(g[row] * value * total[row, f]) for f in range(FACTORS)]),
                              x.T @ (g[:, None] * total)])
            pull += (decay - own)[:, None] * factors[at]
            seen_bias += g.sum() ** 2
            bias -= RATE * g.sum() / np.sqrt(seen_bias)
            seen_linear[at] += grad ** 2
            linear[at] -= RATE * grad / np.sqrt(seen_linear[at])
            seen_factors[at] += pull ** 2
            factors[at] -= RATE * pull / np.sqrt(seen_factors[at])
    return Model(float(bias), linear.astype(np.float32), factors.astype(np.float32), model.mean, model.spread)


def _feature_batches(batches):
    import pyarrow as pa

    from .textarrays import slices, text_bytes

    for batch in batches:
        data, bounds = text_bytes(batch.column(1))
        for low, high in slices(bounds):
            raw, row, column, value = features(data, bounds[low:high + 1])
            edges = np.searchsorted(row, np.arange(high - low + 1)).astype(np.int32)
            lists = lambda v, t: pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(v, t))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(high - low + 1, dtype=np.int32) * len(STRUCTURE)), pa.array(raw.ravel(), pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), flat, lists(column, pa.int32()), lists(value, pa.float32())],
                                             ["label", "structure", "columns", "values"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        max_rows: int = TRAIN_ROWS, seed: int = 0) -> Model:
    """Fit on the ``max_rows`` labelled rows, not held out, whose id hashes lowest (all of them if there are fewer)."""
    spark = docs.sparkSession
    ship_package(spark)
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col)) \
        .groupBy(id_col).agg(F.min(label_col).cast("double").alias("__label"))
    chosen = known.orderBy(F.xxhash64(id_col), id_col).limit(max_rows)
    texts = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col)  # at most max_rows rows
    texts = texts.orderBy(F.xxhash64(id_col), id_col, F.xxhash64(text_col)).limit(max_rows)
    table = texts.select("__label", text_col) \
        .mapInArrow(_feature_batches, "label double, structure array<double>, columns array<int>, values array<float>").toArrow()
    table = table.combine_chunks()
    lists = [[cell.values.to_numpy(zero_copy_only=False) for cell in table.column(c)] for c in ("structure", "columns", "values")]
    return fit_rows(list(zip(*lists, table.column("label").to_pylist())), seed)


def _score_batches(model: Model, text_at: int, keep_text: bool):
    def run(batches):
        import pyarrow as pa

        from .textarrays import slices, text_bytes

        for batch in batches:
            data, bounds = text_bytes(batch.column(text_at))
            scores = [model.score(data, bounds[a:b + 1]) for a, b in slices(bounds)]
            rest = [(n, c) for i, (n, c) in enumerate(zip(batch.schema.names, batch.columns)) if keep_text or i != text_at]
            yield pa.RecordBatch.from_arrays([c for _, c in rest] + [pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                                             [n for n, _ in rest] + ["score"])
    return run


def score(docs: DataFrame, model: Model, text_col: str = "text", keep_text: bool = True, name: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text (underscores in front of a name that clashes)."""
    ship_package(docs.sparkSession)
    rest = [c for c in docs.columns if keep_text or c != text_col]
    columns = rest if keep_text else [*rest, text_col]
    sent = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    schema = ", ".join([*(f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(rest)), "score double"])
    out = sent.mapInArrow(_score_batches(model, columns.index(text_col), keep_text), schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(rest)], F.col("score").alias(fresh(docs.columns, name)))


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows whose score reaches ``threshold``, all columns kept."""
    name = fresh(docs.columns, "score")
    return score(docs, model, text_col).filter(F.col(name) >= threshold).select(*[named(c) for c in docs.columns])
