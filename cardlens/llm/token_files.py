"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding with separate control bytes.

``write_token_files`` encodes every text, appends the end id, and writes a folder:

* ``ids/part-*``: blocks of whole documents, in ascending order of the document id
  (null first; equal ids by a hash of the text). A block is a header (magic, version,
  documents, ids, and the bytes of the three parts), the documents' ids and lengths as an
  Arrow stream, the control bytes, the data bytes, and a line feed.
* ``ranks``: rank, token id, occurrences. The files hold ranks: the more frequent an id is in
  the whole corpus, the fewer bytes it takes.
* ``index``: per file its documents, its ids and the ids of all files before it.
* ``format``: version, type of the document id, end id.

``read_token_files`` gives the documents back from these files alone.

How it runs: texts are encoded once (Arrow batches), and their ids written with one row of
counts per task. Counts are added up by Spark; the ranking has as many rows as the vocabulary,
so it is collected and sent to the tasks. The ids are range-partitioned and sorted by document
(equal ids and texts are spread by a row number), coded, and written by Spark's text writer,
which copies bytes as they are and commits whole tasks only, so a lost executor leaves no
half-written file. Files hold at most ``FILE_BLOCKS`` blocks of about ``BLOCK_IDS`` ids and are read
with Spark's binary reader; running starts are added up per task's files, then over tasks.

Edge cases: null and empty texts are the end id alone; rows without id and repeated rows are
documents of their own; other columns are not written, whatever their names; an empty
table gives an empty index and no documents. Special strings of the vocabulary in a text are
read as the library reads them by default.
"""

from __future__ import annotations

import struct

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package, write_shared

BLOCK_IDS = 1 << 20
FILE_BLOCKS = 16
END_ID = 0
MAGIC = b"FRID"
VERSION = 1
_HEADER = struct.Struct("<4sHIQQQQ")  # magic, version, documents, ids, bytes of: documents, control, data
SLICE_BYTES = 2 << 20


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


# ---- texts to ids ----------------------------------------------------------

_encoders: dict = {}  # one per vocabulary, kept by the Python worker from task to task


def _encoder(vocabulary: str):
    from .token_encoder import TokenEncoder

    key = hash(vocabulary)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = TokenEncoder(vocabulary)
    return _encoders[key]


def _encode_batches(vocabulary, end_id: int):
    """(id, tie, text) rows to (id, tie, ids) rows, and one row of id counts per task."""
    def run(batches):
        import os

        import numpy as np
        import pyarrow as pa

        from .packing import pack_ints
        from .textarrays import slices, text_bytes

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        encoder = _encoder(vocabulary.value)
        times = np.zeros(max(encoder.size, end_id + 1), np.int64)
        for batch in batches:
            data, bounds = text_bytes(batch.column("text"))
            for low, high in slices(bounds, SLICE_BYTES):
                ids, counts = encoder.encode(data, bounds[low:high + 1])
                times += np.bincount(ids, minlength=len(times))
                times[end_id] += high - low
                stops = np.cumsum(counts)
                cells = [pack_ints(np.append(ids[b - n:b], np.uint32(end_id))) for b, n in zip(stops, counts)]
                rows = high - low
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(low, rows), batch.column("tie").slice(low, rows), pa.array(cells, pa.binary()),
                     pa.nulls(rows, pa.list_(pa.int32())), pa.nulls(rows, pa.list_(pa.int64()))], ["id", "tie", "ids", "seen", "times"])
        seen = np.flatnonzero(times)
        if len(seen):
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, batch.schema.field("id").type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                 pa.array([seen], pa.list_(pa.int32())), pa.array([times[seen]], pa.list_(pa.int64()))], ["id", "tie", "ids", "seen", "times"])
    return run


def _rank_ids(coded: DataFrame, size: int) -> DataFrame:
    """(rank, token_id, occurrences) of every id of the vocabulary: the more frequent, the lower the rank."""
    counts = coded.filter(F.col("seen").isNotNull()).select(F.explode(F.arrays_zip("seen", "times")).alias("c")) \
        .groupBy(F.col("c.seen").alias("token_id")).agg(F.sum("c.times").alias("occurrences"))
    every = coded.sparkSession.range(size).select(F.col("id").cast("int").alias("token_id"))
    rows = every.join(counts, "token_id", "left").select("token_id", F.coalesce("occurrences", F.lit(0)).cast("long").alias("occurrences"))
    order = Window.partitionBy().orderBy(F.desc("occurrences"), "token_id")  # as many rows as the vocabulary
    return rows.select((F.row_number().over(order) - 1).cast("int").alias("rank"), "token_id", "occurrences")


# ---- blocks ----------------------------------------------------------------

def _block(ids_column, counts, ranks) -> bytes:
    """One block of the file format."""
    import pyarrow as pa

    from .byte_codes import encode

    sink = pa.BufferOutputStream()
    table = pa.RecordBatch.from_arrays([ids_column, pa.array(counts, pa.int64())], ["id", "n"])
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(table)
    documents = sink.getvalue().to_pybytes()
    control, data = encode(ranks)
    return _HEADER.pack(MAGIC, VERSION, len(counts), len(ranks), len(documents), len(control), len(data)) + documents + control + data


def _block_batches(rank_of, block_ids: int):
    """Sorted (id, ids) rows to blocks of about ``block_ids`` ids, one row each; documents stay whole."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        from .packing import unpack_ints

        def done(keys, parts):
            block = _block(pa.chunked_array(keys).combine_chunks(), [len(p) for p in parts], rank_of.value[np.concatenate(parts)])
            return pa.RecordBatch.from_arrays([pa.array([block], pa.binary())], ["value"])

        keys, parts, n = [], [], 0
        for batch in batches:
            cells, column = batch.column("ids"), batch.column("id")
            for i in range(batch.num_rows):
                ids = unpack_ints(cells[i].as_py())
                if n and n + len(ids) > block_ids:
                    yield done(keys, parts)
                    keys, parts, n = [], [], 0
                keys.append(column.slice(i, 1))
                parts.append(ids.astype(np.int64))
                n += len(ids)
        if n:
            yield done(keys, parts)
    return run


def parse_blocks(content: bytes):
    """(documents, number of ids, control bytes, data bytes) of every block of a file, as views; a damaged file is an error."""
    view, at = memoryview(content), 0
    while at < len(view):
        magic, version, n_docs, n_ids, *sizes = _HEADER.unpack_from(view, at)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token-id file of this version")
        at += _HEADER.size
        parts = []
        for size in sizes:
            parts.append(view[at:at + size])
            at += size
        if view[at:at + 1] != b"\n":
            raise ValueError("token-id file cut short")
        at += 1
        yield n_docs, n_ids, *parts


def _index_batches(batches):
    """Documents and ids of each file, from its headers."""
    import pyarrow as pa

    for batch in batches:
        totals = [[(b[0], b[1]) for b in parse_blocks(content.as_buffer())] for content in batch.column("content")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("path"), pa.array([sum(d for d, _ in t) for t in totals], pa.int64()),
             pa.array([sum(n for _, n in t) for t in totals], pa.int64())], ["path", "n_docs", "n_ids"])


def _read_batches(id_of):
    """Every document of each file: (path, id, ids before it in its file, number of ids, ids as little-endian 32-bit integers)."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        from .byte_codes import decode

        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                start = 0
                for n_docs, n_ids, documents, control, data in parse_blocks(content.as_buffer()):
                    table = pa.ipc.open_stream(documents).read_all()
                    counts = table.column("n").to_numpy()
                    ids = id_of.value[decode(bytes(control), bytes(data), n_ids)].astype("<u4")
                    ends = np.cumsum(counts)
                    raw = ids.tobytes()
                    cells = [raw[4 * (b - n):4 * b] for b, n in zip(ends.tolist(), counts.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path.as_py()] * n_docs, pa.string()), table.column("id").combine_chunks(),
                         pa.array(start + ends - counts, pa.int64()), pa.array(counts, pa.int64()), pa.array(cells, pa.binary())],
                        ["path", "id", "first", "n_tokens", "ids"])
                    start += n_ids
    return run


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/ids").select("path", "content")


# ---- write and read --------------------------------------------------------

def write_token_files(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
                      end_id: int = END_ID) -> None:
    """Write the texts of ``docs`` as token-id files into the new folder ``path`` (one that all executors share)."""
    import numpy as np

    spark = docs.sparkSession
    ship_package(spark)
    with open(vocabulary or tokenizer_file(), encoding="utf-8") as source:
        content = source.read()
    size = max(_encoder(content).size, end_id + 1)
    id_type = docs.schema[id_col].dataType.simpleString()
    text = F.col(f"`{text_col}`")
    sent = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    coded = sent.mapInArrow(_encode_batches(spark.sparkContext.broadcast(content), end_id),
                            f"id {id_type}, tie long, ids binary, seen array<int>, times array<long>")
    coded = write_shared(coded.withColumn("row", F.monotonically_increasing_id()), "token-ids")

    _rank_ids(coded, size).write.parquet(f"{path}/ranks")
    rows = spark.read.parquet(f"{path}/ranks").select("rank", "token_id").toPandas()  # as many rows as the vocabulary
    rank_of = np.zeros(size, np.uint32)
    rank_of[rows["token_id"]] = rows["rank"]

    order = [F.asc_nulls_first("id"), F.asc("tie"), F.asc("row")]
    texts = coded.filter(F.col("ids").isNotNull()).select("id", "tie", "row", "ids")
    blocks = texts.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "ids") \
        .mapInArrow(_block_batches(spark.sparkContext.broadcast(rank_of), BLOCK_IDS), "value binary")
    blocks.select(F.col("value").cast("string").alias("value")) \
        .write.option("compression", "none").option("maxRecordsPerFile", FILE_BLOCKS).text(f"{path}/ids")

    totals = write_shared(_files(spark, path).mapInArrow(_index_batches, "path string, n_docs long, n_ids long"), "token-files")
    totals = totals.select(F.element_at(F.split("path", "/"), -1).alias("file"), "n_docs", "n_ids") \
        .withColumn("task", F.regexp_extract("file", r"^part-(\d+)", 1).cast("long")) \
        .withColumn("nth", F.regexp_extract("file", r"-c(\d+)\.[^-]*$", 1).cast("long"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    tasks = totals.groupBy("task").agg(F.sum("n_ids").alias("task_ids")) \
        .withColumn("start", F.coalesce(F.sum("task_ids").over(before(Window.partitionBy().orderBy("task"))), F.lit(0)))  # one row per write task
    own = F.coalesce(F.sum("n_ids").over(before(Window.partitionBy("task").orderBy("nth"))), F.lit(0))
    totals.join(tasks, "task").select("file", "n_docs", "n_ids", (F.col("start") + own).alias("start")).write.parquet(f"{path}/index")
    about = f"SELECT {VERSION} AS version, '{id_type}' AS id_type, {end_id} AS end_id"
    spark.sql(about).write.parquet(f"{path}/format")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, n_tokens, ids) of every document of the files in ``path``: ``start`` counts the ids of all documents
    before it, ``ids`` are little-endian unsigned 32-bit integers, the end id included."""
    import numpy as np

    ship_package(spark)
    about = spark.read.parquet(f"{path}/format").first()
    if about["version"] != VERSION:
        raise ValueError(f"token-id files of version {about['version']}")
    rows = spark.read.parquet(f"{path}/ranks").select("rank", "token_id").toPandas()  # as many rows as the vocabulary
    id_of = np.zeros(len(rows), np.uint32)
    id_of[rows["rank"]] = rows["token_id"]
    found = _files(spark, path).mapInArrow(_read_batches(spark.sparkContext.broadcast(id_of)),
                                           f"path string, id {about['id_type']}, first long, n_tokens long, ids binary")
    starts = spark.read.parquet(f"{path}/index").select("file", "start")
    found = found.withColumn("file", F.element_at(F.split("path", "/"), -1)).join(starts, "file")
    return found.select("id", (F.col("start") + F.col("first")).alias("start"), "n_tokens", "ids")


def scratch_folder(spark: SparkSession) -> str:
    """A new folder for token-id files among the shared ones."""
    return scratch_path(spark, "token-files")
