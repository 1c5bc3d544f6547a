"""The forest of G1 over large tables, and the scores of any forest (G3, G4, J1), with numpy inside Arrow batches.

Spark ML keeps a training row as an object with a count per tree (some 600 bytes) and reads all of them in a hundred passes or
more. Here rows are packed into blocks of bin numbers, and one Spark job grows a level of all trees: tasks add up the labels of
their blocks per tree, node and bin, the sums meet by tree and part of the level, and the best splits come back. Of two sister
nodes only the one with fewer rows is summed; the other is the parent without it. Bins, split rule, depth and Poisson bootstrap
are those of Spark ML (with draws of its own), and the result is a Spark ML model.

Splits are chosen by sums of labels on a grid of whole numbers, so fine that no sum leaves the whole numbers a double holds:
they do not depend on the order in which parts arrive. Predictions are means of the labels as they are.
"""

from __future__ import annotations

import math
import weakref

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, NumericType

from ..session import child_folders, scratch_path, ship_package, write_shared

BLOCK_ROWS = 131072   # rows of a block: some 4 MB with 22 inputs
TASK_BLOCKS = 16      # most blocks a task holds
JOINT = 64            # small inputs are summed together while their values are no more
NODES = 64            # nodes of a level whose sums meet in one group
DEEPEST = 12          # trees are kept as complete levels up to this depth
SAMPLE_ROWS = 10000   # bins come from max(this, bins squared) rows, as in Spark ML


# ---------------------------------------------------------------------------
# Trees as levels
# ---------------------------------------------------------------------------
# A level of 2^d nodes is two arrays: the input tested and the last code that goes left. What ended above goes left.

def _descend(levels: list, codes: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Place of every row on the level below ``levels``; ``base`` is where a row starts in the flat ``codes``."""
    n = len(base)
    node, at, right = np.zeros(n, np.intp), np.empty(n, np.intp), np.empty(n, bool)
    code, place = np.empty(n, codes.dtype), np.empty(n, codes.dtype)
    for inputs, places in levels:  # into the same few arrays; "clip" is the mode without a check and a copy
        inputs.take(node, out=at, mode="clip")
        at += base
        codes.take(at, out=code, mode="clip")
        places.take(node, out=place, mode="clip")
        np.greater(code, place, out=right)
        node += node
        node += right
    return node


def _code_type(cuts: list) -> type:
    return np.uint8 if max(map(len, cuts), default=0) < 255 else np.uint16


def _codes(columns: list, cuts: list) -> np.ndarray:
    """Row by row, the number of cuts of each input below its value: x <= cuts[k] exactly if the code is <= k (NaN: none)."""
    codes = np.empty((len(columns[0]), len(cuts)), _code_type(cuts))
    for i, (values, cut) in enumerate(zip(columns, cuts)):
        codes[:, i] = np.searchsorted(cut, values)
    return codes


# ---------------------------------------------------------------------------
# Scores
# ---------------------------------------------------------------------------

_levels: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def _read_levels(model: PipelineModel, spark) -> tuple | None:
    """(cuts, trees, sums of leaf values) of an assembler and a forest, from the model's own stored form; None for others."""
    if [type(s) for s in model.stages] != [VectorAssembler, RandomForestRegressionModel]:
        return None
    if model.stages[0].getHandleInvalid() != "keep" or model.stages[1].getLeafCol():
        return None  # other columns or errors than a prediction
    path = scratch_path(spark, "forest")
    model.stages[1].save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.leftChild", "nodeData.rightChild", "nodeData.split.featureIndex",
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("cut"), "nodeData.split.numCategories").toPandas()
    nodes = nodes.sort_values(["treeID", "id"], ignore_index=True)
    inner = nodes[nodes.leftChild >= 0]
    if (inner.numCategories >= 0).any():
        return None
    cuts = [np.unique(inner.cut[inner.featureIndex == i].to_numpy(float)) for i in range(len(model.stages[0].getInputCols()))]
    if max(map(len, cuts), default=0) >= 65535:
        return None
    kind, trees = _code_type(cuts), []
    for _, tree in nodes.groupby("treeID", sort=True):
        left, right, cut = tree.leftChild.to_numpy(), tree.rightChild.to_numpy(), tree.cut.to_numpy(float)
        tested, value = tree.featureIndex.to_numpy(), tree.prediction.to_numpy()
        levels, here = [], np.zeros(1, np.intp)
        while (left[here] >= 0).any():
            if len(levels) == DEEPEST:
                return None
            split = left[here] >= 0
            places = np.full(len(here), np.iinfo(kind).max, kind)
            for k in np.flatnonzero(split):
                places[k] = np.searchsorted(cuts[tested[here[k]]], cut[here[k]])
            levels.append((np.where(split, tested[here], 0).astype(np.intp), places))
            here = np.stack([np.where(split, left[here], here), np.where(split, right[here], here)], axis=1).ravel()
        trees.append((levels, value[here]))
    return cuts, trees


def plain(df: DataFrame, inputs: list) -> bool:
    """Whether every input is one number or flag (an assembler takes vectors too)."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return all(isinstance(kinds.get(c), NumericType | BooleanType) for c in inputs)


def scores(model: PipelineModel, df: DataFrame) -> Column | None:
    """The prediction of a forest as a column over its inputs, bit by bit that of ``model.transform``; None if ``model`` or its
    inputs are something else, or a column of its output is there already.

    A row goes down a tree in a Spark ML object per node; here a batch of rows goes down a level at a time.
    """
    spark = df.sparkSession
    if model not in _levels:
        _levels[model] = _read_levels(model, spark)
    if _levels[model] is None:
        return None
    assembler, forest = model.stages
    if not plain(df, assembler.getInputCols()) or {assembler.getOutputCol(), forest.getPredictionCol()} & set(df.columns):
        return None
    ship_package(spark)
    cuts, trees = _levels[model]

    @F.pandas_udf("double")
    def prediction(*columns: pd.Series) -> pd.Series:
        codes = _codes([c.to_numpy(float, na_value=np.nan) for c in columns], cuts)
        base = np.arange(len(codes)) * codes.shape[1]
        codes, total = codes.ravel(), np.zeros(len(base))
        for levels, values in trees:
            total += values.take(_descend(levels, codes, base))
        return pd.Series(total / len(trees))

    return prediction(*[F.col(c).cast("double") for c in assembler.getInputCols()]).alias(forest.getPredictionCol())


# ---------------------------------------------------------------------------
# Training
# ---------------------------------------------------------------------------

def _cuts(values: np.ndarray, max_bins: int) -> np.ndarray:
    """Candidate cuts of one input, by Spark ML's rule: between all values, or at equal strides of rows if those are too many."""
    found, counts = np.unique(values[~np.isnan(values)], return_counts=True)
    between = (found[:-1] + found[1:]) / 2
    if len(between) <= max_bins - 1:
        return between
    stride, cuts, upto = len(values) / max_bins, [], np.cumsum(counts)
    target = stride
    for k in range(1, len(found)):
        if abs(upto[k - 1] - target) < abs(upto[k] - target):
            cuts.append(between[k - 1])
            target += stride
    return np.array(cuts)


def _pack(cuts: list, rows: int):
    """Arrow batches of inputs and label to blocks: number, codes row by row, labels."""
    def pack(batches):
        from pyspark import TaskContext

        first, parts, held = TaskContext.get().partitionId() << 32, [], 0

        def block(codes, labels):
            nonlocal first
            first += 1
            return pa.RecordBatch.from_arrays([pa.array([first - 1]), pa.array([codes.tobytes()]), pa.array([labels.tobytes()])],
                                              names=["block", "codes", "labels"])

        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]
            if not all(np.isfinite(c).all() for c in columns):
                raise ValueError("training rows must not have null, NaN or infinite inputs")  # as Spark ML
            parts.append((_codes(columns[:-1], cuts), columns[-1]))
            held += batch.num_rows
            while held >= rows:
                codes, labels = (np.concatenate(p) for p in zip(*parts))
                yield block(codes[:rows], labels[:rows])
                parts, held = [(codes[rows:], labels[rows:])], held - rows
        if held:
            yield block(*(np.concatenate(p) for p in zip(*parts)))

    return pack


def _groups(bins: list) -> list:
    """Inputs in groups that are summed together: (inputs, strides, values)."""
    groups: list = []
    for i in sorted(range(len(bins)), key=lambda i: (-bins[i], i)):
        for g in groups:
            if g[2] * bins[i] <= JOINT:
                g[0].append(i)
                g[1].append(g[2])
                g[2] *= bins[i]
                break
        else:
            groups.append([[i], [1], bins[i]])
    return groups


_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])


def _draw_table() -> np.ndarray:
    """Count of a Poisson draw by its first 16 bits; 255 where they leave it open."""
    edges = np.arange(65537) / 65536
    low, high = np.searchsorted(_POISSON, edges[:-1], "right"), np.searchsorted(_POISSON, edges[1:], "left")
    return np.where(low == high, low, 255).astype(np.uint8)


def _draws(table: np.ndarray, seed: int, tree: int, block: int, n: int) -> np.ndarray:
    """How often each row of a block is in a tree's sample; the same whenever it is asked."""
    bits = np.random.SFC64(np.random.SeedSequence([seed & (2 ** 63 - 1), tree, block]))
    first = bits.random_raw((n + 3) // 4).view(np.uint16)[:n]
    counts = table.take(first)
    open_ = np.flatnonzero(counts == 255)
    counts[open_] = np.searchsorted(_POISSON, (first[open_] + np.random.Generator(bits).random(len(open_))) / 65536, "right")
    return counts


class _Blocks:
    """The blocks of a task, and the rows of each with their counts in a tree's sample."""

    def __init__(self, batches, cuts: list, seed: int | None):
        self.width, self.seed, self.table = len(cuts), seed, _draw_table()
        self.blocks = []
        for batch in batches:
            for number, codes, labels in zip(*(c.to_pylist() for c in batch.columns)):
                self.blocks.append((number, np.frombuffer(codes, _code_type(cuts)), np.frombuffer(labels)))
        self.blocks.sort(key=lambda b: b[0])

    def sample(self, tree: int):
        """(block's place, rows, their codes' starts, counts) of each block."""
        for k, (number, codes, labels) in enumerate(self.blocks):
            if self.seed is None:
                rows, counts = np.arange(len(labels)), np.ones(len(labels))
            else:
                counts = _draws(self.table, self.seed, tree, number, len(labels))
                rows = np.flatnonzero(counts != 0)
                counts = counts.take(rows).astype(float)
            yield k, rows, rows * self.width, counts


def _level_sums(cuts: list, trees: list, slots: list, seed: int | None, low: float, scale: float, shift: float):
    """Sums of counts and labels per tree, summed node and bin of every input, in parts of ``NODES`` / 2 nodes."""
    bins = [len(c) + 1 for c in cuts]
    groups, starts = _groups(bins), np.cumsum([0, *bins])

    def level_sums(batches):
        held = _Blocks(batches, cuts, seed)
        joint = [[sum(codes.reshape(-1, len(cuts))[:, i].astype(np.int64) * s for i, s in zip(g[0], g[1])).astype(np.uint16)
                  for g in groups] for _, codes, _ in held.blocks]
        labels = [np.rint((y - low) * scale) - shift for _, _, y in held.blocks]
        part = held.blocks[0][0] if held.blocks else 0
        for tree, (levels, slot) in enumerate(zip(trees, slots)):
            if not held.blocks or slot.max() < 0:
                continue
            used = int(slot.max()) + 1
            sums = [np.zeros((2, used * g[2])) for g in groups]
            for k, rows, base, counts in held.sample(tree):
                if levels:
                    at = slot.take(_descend(levels, held.blocks[k][1], base))
                    kept = np.flatnonzero(at >= 0)
                    at, rows, counts = at.take(kept), rows.take(kept), counts.take(kept)
                else:
                    at = np.zeros(len(rows), np.intp)
                weighted = counts * labels[k].take(rows)
                for g, (group, places) in enumerate(zip(groups, joint[k])):
                    cell = at * group[2]
                    cell += places.take(rows)
                    sums[g][0] += np.bincount(cell, counts, used * group[2])
                    sums[g][1] += np.bincount(cell, weighted, used * group[2])
            whole = np.zeros((-(-used // (NODES // 2)) * (NODES // 2), starts[-1], 2))
            for group, both in zip(groups, sums):
                shaped = both.reshape(2, used, *[bins[i] for i in reversed(group[0])])
                for n, i in enumerate(reversed(group[0])):
                    axes = tuple(2 + a for a in range(len(group[0])) if a != n)
                    whole[:used, starts[i]:starts[i + 1]] = np.moveaxis(shaped.sum(axis=axes), 0, 2)
            for chunk in range(len(whole) // (NODES // 2)):
                piece = whole[chunk * NODES // 2:(chunk + 1) * NODES // 2]
                if piece[:, :, 0].any():
                    yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([chunk], pa.int32()), pa.array([part], pa.int64()),
                                                      pa.array([piece.tobytes()])], names=["tree", "chunk", "part", "sums"])

    return level_sums


def _best(sums: np.ndarray, bins: list) -> np.ndarray:
    """Per node: gain, input, last bin on the left, counts on the left and in all; of equal gains the first input and bin."""
    best, start = np.zeros((len(sums), 5)), 0
    for i, b in enumerate(bins):
        upto = np.cumsum(sums[:, start:start + b], axis=1)
        start += b
        n, s = upto[:, -1, 0], upto[:, -1, 1]
        if i == 0:
            best[:, 4] = n
        if b == 1:
            continue
        left, left_sum = upto[:, :-1, 0], upto[:, :-1, 1]
        right, right_sum = n[:, None] - left, s[:, None] - left_sum
        apart = left_sum / np.maximum(left, 1) - right_sum / np.maximum(right, 1)
        gain = np.where((left > 0) & (right > 0), apart * apart * left * right, 0) / np.maximum(n * n, 1)[:, None]
        at = gain.argmax(axis=1)
        nodes = np.arange(len(sums))
        top = gain[nodes, at]
        better = top > best[:, 0]
        found = np.stack([top, np.full(len(sums), i), at, left[nodes, at], n], axis=1)
        best[better] = found[better]
    return best


def _level_splits(bins: list, level: int, smaller: list, last: bool):
    """The sums of one part of a tree's level to its nodes' best splits, and to the sums of its nodes if a level follows."""
    half, cells = NODES // 2, sum(bins)

    def level_splits(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        tree, chunk = int(key[0]), int(key[1])
        rows = rows.sort_values("part")
        own, above = np.zeros((half, cells, 2)), np.zeros((half, cells, 2))
        for part, sums in zip(rows.part, rows.sums):
            (above if part < 0 else own).__iadd__(np.frombuffer(sums).reshape(own.shape))
        nodes = np.zeros((NODES, cells, 2))
        if level == 0:
            nodes[0] = own[0]
        else:
            small = smaller[tree][chunk * half:(chunk + 1) * half]  # 0 or 1: the sister that was summed; -1: no split above
            for i in np.flatnonzero(small >= 0):
                nodes[2 * i + small[i]], nodes[2 * i + 1 - small[i]] = own[i], above[i] - own[i]
        best = _best(nodes, bins)
        out = [(tree, 2 * chunk + h, b"" if last else nodes[h * half:(h + 1) * half].tobytes(), best[h * half:(h + 1) * half].tobytes()) for h in (0, 1)
               if best[h * half:(h + 1) * half, 0].any()]
        return pd.DataFrame(out, columns=["tree", "chunk", "sums", "best"])

    return level_splits


def _leaf_sums(cuts: list, trees: list, seed: int | None, depth: int):
    """Per tree and place below the last level: count, sum and sum of squares of the labels."""
    def leaf_sums(batches):
        held = _Blocks(batches, cuts, seed)
        part = held.blocks[0][0] if held.blocks else 0
        for tree, levels in enumerate(trees if held.blocks else []):
            sums = np.zeros((3, 2 ** depth))
            for k, rows, base, counts in held.sample(tree):
                at, y = _descend(levels, held.blocks[k][1], base), held.blocks[k][2].take(rows)
                for power in range(3):
                    sums[power] += np.bincount(at, counts * y ** power, 2 ** depth)
            yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([part], pa.int64()), pa.array([sums.tobytes()])],
                                             names=["tree", "part", "sums"])

    return leaf_sums


def _add_parts(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("part")
    total = sum(np.frombuffer(s) for s in rows.sums)
    return pd.DataFrame([(rows.tree.iloc[0], total.tobytes())], columns=["tree", "sums"])


def _nodes(levels: list, splits: list, leaf: np.ndarray, cuts: list, tree: int) -> list:
    """A tree as rows of Spark ML's stored form, in preorder; sisters without a split that predict the same are one leaf."""
    stats = [leaf]
    for _ in levels:
        stats.append(stats[-1][:, 0::2] + stats[-1][:, 1::2])
    stats.reverse()

    def grow(depth: int, at: int) -> list:
        n, s, q = map(float, stats[depth][:, at])
        mean = s / n
        own = [mean, q / n - mean * mean, [n, s, q], int(n)]
        if depth < len(levels) and splits[depth][at]:
            left, right = grow(depth + 1, 2 * at), grow(depth + 1, 2 * at + 1)
            if not (len(left) == len(right) == 1 and left[0][0] == right[0][0]):
                (ln, ls), (rn, rs) = stats[depth + 1][:2, 2 * at], stats[depth + 1][:2, 2 * at + 1]
                gain = (ls / ln - rs / rn) ** 2 * ln * rn / (n * n)
                inputs, places = levels[depth]
                return [[*own, float(gain), (int(inputs[at]), [float(cuts[inputs[at]][places[at]])], -1), len(left)], *left, *right]
        return [[*own, -1.0, (-1, [], -1), 0]]

    rows = grow(0, 0)
    return [{"treeID": tree, "nodeData": {
        "id": i, "prediction": p, "impurity": v, "impurityStats": st, "rawCount": n, "gain": gain, "leftChild": i + 1 if size else -1,
        "rightChild": i + 1 + size if size else -1,
        "split": {"featureIndex": split[0], "leftCategoriesOrThreshold": split[1], "numCategories": split[2]}}}
        for i, (p, v, st, n, gain, split, size) in enumerate(rows)]


def _as_model(spark, pipeline: Pipeline, few: DataFrame, nodes: list) -> PipelineModel:
    """A fitted pipeline with the given trees: the stored form of one fitted on ``few`` rows, its nodes replaced."""
    path = scratch_path(spark, "forest")
    pipeline.fit(few).write().save(path)
    stage = next(f"{path}/stages/{s}" for s in child_folders(spark, f"{path}/stages") if s.startswith("1_"))
    schema = spark.read.parquet(f"{stage}/data").schema
    spark.createDataFrame(pa.Table.from_pylist(nodes, to_arrow_schema(schema)), schema).write.mode("overwrite").parquet(f"{stage}/data")
    return PipelineModel.load(path)


def grow_forest(pipeline: Pipeline, df: DataFrame, rows: int, low: float, high: float) -> PipelineModel:
    """Fit an assembler and forest (all inputs at every split) on ``rows`` labelled rows, labels from ``low`` to ``high``."""
    spark = df.sparkSession
    assembler, forest = pipeline.getStages()
    inputs, label, depth, count = assembler.getInputCols(), forest.getLabelCol(), forest.getMaxDepth(), forest.getNumTrees()
    seed = forest.getSeed() if forest.getBootstrap() else None
    ship_package(spark)

    sent = df.select(*[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(inputs)], F.col(label).cast("double").alias("_y"))
    share = max(forest.getMaxBins() ** 2, SAMPLE_ROWS) / rows
    found = (sent if share >= 1 else sent.sample(False, share, forest.getSeed())).toPandas()
    cuts = [_cuts(found[f"_x{i}"].to_numpy(float), min(forest.getMaxBins(), rows)) for i in range(len(inputs))]
    bins = [len(c) + 1 for c in cuts]

    blocks = write_shared(sent.mapInArrow(_pack(cuts, BLOCK_ROWS), "block bigint, codes binary, labels binary"), "forest-blocks")
    tasks = max(2 * spark.sparkContext.defaultParallelism, -(-rows // (BLOCK_ROWS * TASK_BLOCKS)))
    blocks = blocks.repartitionByRange(tasks, "block").persist(StorageLevel.MEMORY_AND_DISK)
    # whole numbers up to 2^52 for the sum of all labels of a sample (which has about as many rows as there are)
    grid = 2.0 ** (51 - math.ceil(math.log2(2 * rows + 128)))
    scale = 2 * grid / (high - low) if high > low else 0.0
    kind, none = _code_type(cuts), np.iinfo(_code_type(cuts)).max

    trees: list = [[] for _ in range(count)]
    splits: list = [[] for _ in range(count)]
    slots = [np.zeros(1, np.intp) for _ in range(count)]
    smaller: list = [np.zeros(0, np.intp)] * count
    above = None
    for level in range(depth):
        parts = blocks.mapInArrow(_level_sums(cuts, trees, slots, seed, low, scale, grid), "tree int, chunk int, part bigint, sums binary")
        if above is not None:
            parts = parts.unionByName(above.select("tree", "chunk", F.lit(-1).cast("bigint").alias("part"), "sums"))
        above = write_shared(parts.groupBy("tree", "chunk").applyInPandas(
            _level_splits(bins, level, smaller, level == depth - 1), "tree int, chunk int, sums binary, best binary"), "forest-level")
        size = 2 ** level
        best = np.zeros((count, max(size, NODES // 2), 5))
        for r in above.select("tree", "chunk", "best").collect():
            best[r.tree, r.chunk * NODES // 2:(r.chunk + 1) * NODES // 2] = np.frombuffer(r.best).reshape(-1, 5)
        best = best[:, :size]
        if not best[:, :, 0].any():
            break
        slots, smaller = [], []
        for t in range(count):
            split = best[t, :, 0] > 0
            splits[t].append(split)
            trees[t].append((np.where(split, best[t, :, 1], 0).astype(np.intp), np.where(split, best[t, :, 2], none).astype(kind)))
            fewer = (2 * best[t, :, 3] > best[t, :, 4]).astype(np.intp)
            slot = np.full(2 * size, -1, np.intp)
            nodes = np.flatnonzero(split)
            slot[2 * nodes + fewer[nodes]] = nodes
            slots.append(slot)
            smaller.append(np.where(split, fewer, -1))

    grown = len(trees[0])
    sums = blocks.mapInArrow(_leaf_sums(cuts, trees, seed, grown), "tree int, part bigint, sums binary") \
        .groupBy("tree").applyInPandas(_add_parts, "tree int, sums binary").collect()
    blocks.unpersist()
    leaves = {r.tree: np.frombuffer(r.sums).reshape(3, -1) for r in sums}
    rows_of = [row for t in range(count) for row in _nodes(trees[t], splits[t], leaves[t], cuts, t)]
    few = spark.createDataFrame([(*[0.0] * len(inputs), float(y)) for y in (0, 1)], ", ".join(f"`{c}` double" for c in [*inputs, label]))
    return _as_model(spark, pipeline, few, rows_of)
