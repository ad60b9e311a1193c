"""Token counts of documents in flat token files, by a separator scan.

The files are nothing but token ids, one after another, with an end-of-document id after
each text; no index says where documents begin. Files are read by ranges of bytes, each
searched for the id on its own with vectorised comparisons; what runs across borders is
stitched by a prefix scan over block summaries, in two levels so that one huge file is no
single task.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinfold.llm.common import materialize, new_path, table

BLOCK_BYTES, SUPER = 1 << 22, 1024
_FOUND = ["file", "block", "n", "ends", "first", "after", "inner"]


def _opened(uri: str):
    """(file system, path) of a URI, for readers and writers outside Spark: local or mounted files, HDFS, S3."""
    from pyarrow import fs

    uri = re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/+", "/", uri))
    return fs.FileSystem.from_uri(uri)


def _searched(ids: np.ndarray, eod: int) -> tuple:
    """Of a block: ids, separators, place of the first, the place after the last, and the lengths between."""
    ends = np.flatnonzero(ids == eod)
    if not len(ends):
        return len(ids), 0, None, None, []
    return len(ids), len(ends), int(ends[0]), int(ends[-1]) + 1, (np.diff(ends) - 1).astype(np.int64)


def _found(keys: list, rows: list):
    import pyarrow as pa

    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([*keys, *(pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds))], _FOUND)


def count_in_files(spark: SparkSession, path: str, eod: int, dtype: str = "<u2", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file, ordinal, n_tokens) of each document of the flat files at a path; see ``count_documents``.

    Spark lists the files; each is read by ranges, wherever Arrow's file systems reach, so
    a file of any size is dealt to as many tasks as it has ranges.
    """
    size = np.dtype(dtype).itemsize
    step = max(1, block_bytes // size) * size
    # without ``content`` nothing of the files is read here
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    odd = files.where(F.col("length") % size != 0).first()
    if odd:
        raise ValueError(f"{odd['path']}: {odd['length']} bytes are no whole number of {size}-byte ids")
    last = F.expr(f"greatest(cast(0 as bigint), (length - 1) div {step})")
    ranges = files.select(F.col("path").alias("file"), "length", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
    ranges = ranges.repartition(F.xxhash64("file", "block"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            rows = []
            for file, length, block in zip(*[c.to_pylist() for c in b.columns], strict=True):
                system, at = _opened(file)
                with system.open_input_file(at) as f:
                    data = f.read_at(min(step, length - block * step), block * step)
                rows.append(_searched(np.frombuffer(data, dtype), eod))
            yield _found([b.column(0), b.column(2).cast(pa.int64())], rows)

    return _stitched(ranges.mapInArrow(run, "file string, block long, n long, ends long, first long, after long, inner array<long>"))


def count_documents(blocks: DataFrame, eod: int, dtype: str = "<u2") -> DataFrame:
    """(file, ordinal, n_tokens) of each document, the end-of-document id not counted.

    ``blocks`` has file, block (ascending along the file) and data (whole ids). Two ids in
    a row enclose an empty document; ids after the last separator are a document too,
    unless there are none. Null data are empty; a file without ids has no documents; an
    empty table gives no rows. Other columns are not read.
    """

    def run(batches):
        for b in batches:
            yield _found([b.column(0), b.column(1)], [_searched(np.frombuffer(d.as_py() or b"", dtype), eod) for d in b.column(2)])

    blocks = blocks.select("file", F.col("block").cast("long").alias("block"), "data")
    kind = blocks.schema["file"].dataType.simpleString()
    return _stitched(blocks.mapInArrow(run, f"file {kind}, block long, n long, ends long, first long, after long, inner array<long>"))


def _stitched(found: DataFrame) -> DataFrame:
    """Documents from block summaries, by sums within runs of ``SUPER`` blocks and over such runs."""
    found = materialize(found.select("*", F.expr(f"block div {SUPER}").alias("super")), "blocks")
    whole = Window.partitionBy("file").orderBy("super")
    before = whole.rowsBetween(Window.unboundedPreceding, -1)
    # the place where the last document of a span ended, from the span's own start
    sums = found.groupBy("file", "super").agg(F.sum("n").alias("n"), F.sum("ends").alias("ends"))
    sums = sums.select("file", "super", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"),
                       F.coalesce(F.sum("ends").over(before), F.lit(0)).alias("base_ends"), F.sum("n").over(Window.partitionBy("file")).alias("total"))
    near = Window.partitionBy("file", "super").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = found.join(sums, ["file", "super"]).select(
        "file", "super", "block", "n", "ends", "first", "after", "inner", "total",
        (F.col("base") + F.coalesce(F.sum("n").over(near), F.lit(0))).alias("start"),
        (F.col("base_ends") + F.coalesce(F.sum("ends").over(near), F.lit(0))).alias("ordinal"),
    )
    placed = placed.select("*", (F.col("start") + F.col("after")).alias("cut"))
    far = placed.groupBy("file", "super").agg(F.max("cut").alias("cut"))
    far = far.select("file", "super", F.coalesce(F.max("cut").over(before), F.lit(0)).alias("far"))
    known = placed.join(far, ["file", "super"]).select(
        "*", F.greatest("far", F.coalesce(F.max("cut").over(near), F.lit(0))).alias("open"),
    )
    first = F.when(F.col("ends") > 0, F.array(F.col("start") + F.col("first") - F.col("open"))).otherwise(F.array().cast("array<bigint>"))
    closed = known.select("file", "ordinal", F.posexplode(F.concat(first, F.coalesce("inner", F.array().cast("array<bigint>")))).alias("k", "n_tokens"))
    closed = closed.select("file", (F.col("ordinal") + F.col("k")).alias("ordinal"), "n_tokens")
    rest = placed.groupBy("file").agg(F.max("total").alias("total"), F.coalesce(F.max("cut"), F.lit(0)).alias("cut"), F.sum("ends").alias("ordinal"))
    rest = rest.where("total > cut").select("file", "ordinal", (F.col("total") - F.col("cut")).alias("n_tokens"))
    return closed.unionByName(rest)


def write_token_files(docs: DataFrame, encoder, eod: int, path: str, dtype: str = "<u2", id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Writes ``docs`` as flat token files, one a task, and returns (file, ordinal, doc_id): which document stands where.

    ``encoder``: makes, in a worker, the function from a text to its ids. A file is written
    beside its name and moved there when it is whole, so tasks that are run again do no
    harm. Null and empty texts are empty documents, repeated rows repeat, an empty table
    gives no files. Ids may be of any type. Texts are encoded one by one, however long.
    """
    import pyarrow as pa

    spark = docs.sparkSession
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(at)

    def run(batches):
        from pyspark import TaskContext

        encode, out, first = encoder(), None, 0  # sent with the function, which Spark broadcasts where it is large
        name = f"tokens-{TaskContext.get().partitionId():06d}.bin"
        system, folder = _opened(path)
        partly = f"{folder}/_{name}.{uuid.uuid4().hex}"
        for b in batches:
            if not b.num_rows:
                continue
            out = out or system.open_output_stream(partly)
            for text in b.column(1):
                out.write(np.array([*encode(text.as_py() or ""), eod], dtype).tobytes())
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([pa.array([name] * n), pa.array(range(first, first + n), pa.int64()), b.column(0)], ["file", "ordinal", "doc_id"])
            first += n
        if out:
            out.close()
            system.move(partly, f"{folder}/{name}")

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    made = rows.mapInArrow(run, f"file string, ordinal long, doc_id {rows.schema['doc_id'].dataType.simpleString()}")
    return materialize(made, "order")


class TiktokenEncoder:
    """Makes the encoding function of a rank file's vocabulary."""

    def __init__(self, path: str, pattern: str):
        import base64

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(t): int(i) for t, i in map(bytes.split, f)}
        self.pattern = pattern

    def __call__(self):
        import tiktoken

        return tiktoken.Encoding("flat", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={}).encode_ordinary


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` as flat token files, counted without an index, beside their ids."""
    import public_tokenizers as tokenizers

    encoder = TiktokenEncoder(tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN)
    eod = 50256  # free in this vocabulary
    path = new_path(spark, "tokens")
    order = write_token_files(table(spark, sf_dir, "documents"), encoder, eod, path)
    counted = count_in_files(spark, path, eod).withColumn("file", F.substring_index("file", "/", -1))
    return counted.join(order, ["file", "ordinal"]).select("doc_id", "n_tokens", "file", "ordinal")
