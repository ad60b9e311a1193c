"""Helpers shared by the text operators: table access, the shared folder, joins with hot keys."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word contracts; a word is a run of anything else.
SPACE = r"[\x20\x09-\x0D]+"
#: A key with more than one in so many rows is joined by broadcast; there are fewer than so many of them.
HEAVY = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named input table; any path that Spark's readers open."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Where the session names none, a session on one machine gets a temporary folder, as in
    tests; on a cluster that is an error, since no folder of the driver's is shared.
    """
    known = spark.conf.get("spark.checkpoint.dir", None)
    if known:
        return known.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if context.applicationId not in _own:
        _own[context.applicationId] = tempfile.mkdtemp(prefix="shared-")
    return _own[context.applicationId]


#: Tables written within each open ``scratch``, innermost last.
_written: list[list[str]] = []


def new_path(spark: SparkSession, tag: str, keep: bool = False) -> str:
    """A path in the shared folder that nothing else uses; unless kept, it goes when the ``scratch`` round it ends."""
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    if _written and not keep:
        _written[-1].append(path)
    return path


def materialize(df: DataFrame, tag: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, tag, keep)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``materialize`` wrote and nothing reads any more."""
    for t in tables:
        _delete(t.sparkSession, t._written_at)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what ``materialize`` wrote inside, but for what it was told to keep: the written result."""
    _written.append([])
    try:
        yield
    finally:
        for path in _written.pop():
            _delete(spark, path)


def join_dealt(rows: DataFrame, small: DataFrame, on: list[str], count: str) -> DataFrame:
    """Inner join of ``rows`` to ``small``, which has one row per key and in ``count`` how many of ``rows`` have it.

    Keys with more than one in ``HEAVY`` of the rows are joined by broadcast (there are
    fewer than ``HEAVY`` such keys, whatever the size), all others by a shuffle in which no
    key is hot. Both sides are parted by one filter over the hashes of those keys, so no row
    passes a join for it; a key that shares such a hash is broadcast too. Both sides are
    read twice.
    """
    total, most = small.agg(F.sum(count), F.max(count)).first()
    if not total or most * HEAVY <= total:
        return rows.join(small, on)
    number = F.xxhash64(*[F.col(c).cast(small.schema[c].dataType) for c in on])
    hot = number.isin([r[0] for r in small.where(F.col(count) * HEAVY > total).select(number).collect()])
    return rows.where(hot).join(F.broadcast(small.where(hot)), on).unionByName(rows.where(~hot).join(small.where(~hot), on))


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves 1 modulo 3; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def words_of(text: Column) -> Column:
    """Words between white space, in order; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def ascii_lower(text: Column) -> Column:
    """A-Z lowered, every other character unchanged."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(text.rlike(r"\A[\x00-\x7F]*+\z"), F.lower(text)).otherwise(F.translate(text, upper, lower))


def text_key(text: Column) -> list[Column]:
    """128 bits of a text in two columns ``t1`` and ``t2``; null counts as empty."""
    t = F.coalesce(text, F.lit(""))
    return [F.xxhash64(t).alias("t1"), F.xxhash64(F.lit(1), t).alias("t2")]


def slices(batch, column: int, size: int = 1 << 20) -> Iterator:
    """An Arrow batch in pieces of so many bytes of text, or single rows: what is made of long texts never piles up."""
    import pyarrow.compute as pc

    start, held = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()):
        held += n + 100
        if held > size:
            yield batch.slice(start, i + 1 - start)
            start, held = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, limit: int, id_col: str = "doc_id") -> DataFrame:
    """Training rows: the columns of ``docs`` and ``label``, about ``limit`` rows and never more.

    Only ids that are not held out; ids are taken by hash, so the sample is the same on
    every run, and one row of each, the least text of equal ids, since one id may have any
    number of rows. An id with several labels takes the largest; null ids and labels are
    left out. The sampled ids are broadcast: at most ``limit`` rows of two numbers.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(column).cast("int").alias("label"))
    n = known.count()
    if n > limit:
        share = int(0.95 * limit / n * (1 << 32))
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) < share)
        known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    known = known.withColumnRenamed("doc_id", "_labelled")
    found = docs.join(F.broadcast(known), docs[id_col] == known["_labelled"])
    # per id one value, kept while rows are summed up map-side: the group itself is never gathered
    one = found.groupBy("_labelled").agg(F.min(F.struct(*docs.columns, "label")).alias("x"))
    return one.select("x.*")
