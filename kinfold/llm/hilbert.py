"""Sharding along a Hilbert curve (native).

Metadata dimensions are quantised to a few bits each, by the share of rows below a value,
so neighbouring cells hold neighbouring values and all cells are about equally full. Rows
are sorted by their cell's place on the Hilbert curve and the order is cut into runs of
equal row counts. Shards then cover compact boxes of all dimensions; ``write_shards``
writes one file each with the range of every dimension beside it, by which ``shards_for``
tells a reader what to skip.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.llm.common import materialize, table

BITS = 5
SHARDS = 40


def curve_table(dims: int) -> list[tuple[int, int]]:
    """(digit on the curve, next state) by ``state * 2**dims + corner``.

    A state is an entry corner ``e`` and a direction ``d``; with Gray codes the corner
    ``c`` is reached at the step whose code is ``rotr(c ^ e, d + 1)``.
    """
    size = 1 << dims
    rotl = lambda x, k: ((x << k % dims) | (x >> (dims - k % dims))) & (size - 1) if k % dims else x
    rotr = lambda x, k: rotl(x, dims - k % dims)
    gray = lambda i: i ^ (i >> 1)
    step_of = {gray(i): i for i in range(size)}
    trailing = lambda i: (~i & (i + 1)).bit_length() - 1  # noqa: E731  ones at the end
    entry = lambda i: 0 if i == 0 else gray(2 * ((i - 1) // 2))
    turn = lambda i: 0 if i == 0 else trailing(i - 1 if i % 2 == 0 else i) % dims
    out = []
    for e in range(size):
        for d in range(dims):
            for c in range(size):
                i = step_of[rotr(c ^ e, d + 1)]
                out.append((i, (e ^ rotl(entry(i), d + 1)) * dims + (d + turn(i) + 1) % dims))
    return out


def curve_index(columns: list[Column], bits: int = BITS) -> Column:
    """Place on the Hilbert curve of a cell; each column holds 0 to ``2**bits - 1``."""
    dims = len(columns)
    rows = curve_table(dims)
    digit, then = (F.array(*[F.lit(r[k]) for r in rows]) for k in (0, 1))

    def step(acc: Column, b: Column) -> Column:
        corner = F.lit(0)
        for k, c in enumerate(columns):
            corner = corner + F.when(c.bitwiseAND(b) != 0, F.lit(1 << k)).otherwise(F.lit(0))
        at = acc["state"] * (1 << dims) + corner
        return F.struct(F.get(then, at).alias("state"), (acc["h"] * (1 << dims) + F.get(digit, at)).alias("h"))

    masks = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    zero = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("h"))
    return F.aggregate(masks, zero, lambda a, b: step(a, b), lambda a: a["h"])


def cells(rows: DataFrame, column: str, count: int = 1 << BITS) -> list[tuple[object, int]]:
    """(least value, cell) of each cell that is used, ascending: at most ``count`` entries.

    A value's cell is ``count`` times the share of rows with lesser values. Values are
    counted first, then summed up over range partitions, so neither the rows of one value
    nor all values meet in one task. Nulls are left out.
    """
    counted = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    local = counted.repartitionByRange("value").sortWithinPartitions("value").select("*", F.monotonically_increasing_id().alias("_at"))
    local = materialize(local, "values").select("*", F.shiftright("_at", 33).alias("_part"))
    sums = local.groupBy("_part").agg(F.sum("n").alias("_n"))
    sums = sums.select("_part", F.expr("sum(_n) OVER (ORDER BY _part) - _n").alias("_before"), F.expr("sum(_n) OVER ()").alias("_all"))
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    placed = local.join(F.broadcast(sums), "_part")  # as many rows as there are range partitions
    below = F.col("_before") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    placed = placed.select("value", "_all", below.alias("_below")).select("value", F.expr(f"cast(_below * {count} div _all as int)").alias("cell"))
    return [(r["value"], r["cell"]) for r in placed.groupBy("cell").agg(F.min("value").alias("value")).orderBy("cell").collect()]


def cell_of(value: Column, known: list[tuple[object, int]]) -> Column:
    """The cell of a value; nulls, and values below all, are in cell 0."""
    return reduce(lambda rest, x: F.when(value >= F.lit(x[0]), F.lit(x[1])).otherwise(rest), known, F.lit(0)) if known else F.lit(0)


def ranked(rows: DataFrame, order: list[str], tag: str) -> DataFrame:
    """``rows`` with ``rank`` (0, 1, ... in the given order) and ``total``.

    Range partitions are sorted and written with their own numbering; only the number of
    rows of each partition is then summed up, so no task sees more than one partition. Rows
    that tie are told apart by where they came from, so not even a row that repeats very
    often makes a range large.
    """
    order = [*order, "_tie"]
    local = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    local = materialize(local.drop("_tie").select("*", F.monotonically_increasing_id().alias("_at")), tag)
    part = F.shiftright("_at", 33)
    sizes = local.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # as many rows as there are range partitions
    ends = sizes.select("_part", "_n", F.expr("sum(_n) OVER (ORDER BY _part)").alias("_end"), F.expr("sum(_n) OVER ()").alias("total"))
    ends = ends.select("_part", (F.col("_end") - F.col("_n")).alias("_before"), "total")
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    joined = local.select("*", part.alias("_part")).join(F.broadcast(ends), "_part")
    return joined.select("*", (F.col("_before") + inside).alias("rank")).drop("_at", "_part", "_before")


def cut(rows: DataFrame, shards: int) -> DataFrame:
    """Ranked rows in runs whose counts differ by one at most: ``shard`` and ``slot`` in it."""
    base, extra = F.expr(f"total div {shards}"), F.expr(f"total % {shards}")
    wide = extra * (base + 1)
    first = F.col("rank") < wide
    shard = F.when(first, F.expr(f"rank div (total div {shards} + 1)")).otherwise(
        F.expr(f"total % {shards} + (rank - (total % {shards}) * (total div {shards} + 1)) div greatest(total div {shards}, 1)")
    )
    out = rows.select("*", shard.cast("int").alias("shard"))
    start = F.col("shard") * base + F.least(F.col("shard"), extra)
    return out.select("*", (F.col("rank") - start).alias("slot"))


def assign(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
           keys: tuple[str, ...] = ("source", "lang"), keep: list[str] | None = None) -> DataFrame:
    """(row, size, text_crc32, cell, shard, slot): each row's place; ``row`` holds its columns, or those to ``keep``.

    Dimensions: the size in bytes and the key columns, each in 32 cells. Nulls count as
    empty texts and as the least keys; fewer rows than shards leave the last shards empty;
    repeated rows keep their own slots; an empty table gives no rows; a very long text is
    only measured and hashed. Columns of any name are safe inside ``row``. Ties on the
    curve go by text, size and id, so equal texts with equal keys lie together, and equal
    texts with different keys as far apart as their keys.
    """
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 16
    thin = docs.select(size.alias("d0"), *[F.col(k).cast("string").alias(f"d{i}") for i, k in enumerate(keys, 1)])
    dims = [size, *[F.col(k).cast("string") for k in keys]]
    known = [cells(thin, f"d{i}") for i in range(len(dims))]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"), size.alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"), F.col(id_col).alias("_id"),
        *[cell_of(d, k).alias(f"d{i}") for i, (d, k) in enumerate(zip(dims, known, strict=True))],
    )
    place = curve_index([F.col(f"d{i}") for i in range(len(dims))])
    rows = rows.select("row", "size", "text_crc32", "_id", place.alias("cell"))
    out = cut(ranked(rows, ["cell", "text_crc32", "size", "_id"], "hilbert"), shards)
    return out.select("row", "size", "text_crc32", "cell", "shard", "slot")


def hilbert_shards(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
                   keys: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and the curve index ``cell``; awkward rows as in ``assign``."""
    return assign(docs, shards, id_col, text_col, keys, keep=[id_col]).select(
        F.col(f"row.`{id_col}`").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "cell",
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
                 keys: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """Writes one Parquet file per shard under ``path/data/shard=<n>``, in slot order with all columns of ``docs``.

    Returns the ranges, also written to ``path/ranges``: per shard its rows, and per
    dimension (``size`` and the keys as texts) the least and the greatest value and whether
    it has nulls. A shard is one task's work; take more shards for larger tables.
    """
    placed = materialize(assign(docs, shards, id_col, text_col, keys), "placed")
    data = placed.repartition(shards, "shard").sortWithinPartitions("shard", "slot")
    data.select("row", "slot", "shard").write.partitionBy("shard").parquet(f"{path}/data")
    dims = [F.col("size").alias("d0"), *[F.col(f"row.`{k}`").cast("string").alias(f"d{i}") for i, k in enumerate(keys, 1)]]
    names = F.array(*[F.lit(n) for n in ("size", *keys)])
    values = [F.struct(F.element_at(names, i + 1).alias("dimension"), F.min(f"d{i}").cast("string").alias("least"),
                       F.max(f"d{i}").cast("string").alias("greatest"), (F.count(f"d{i}") < F.count(F.lit(1))).alias("nulls"))
              for i in range(len(dims))]
    ranges = placed.select("shard", *dims).groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.array(*values).alias("x"))
    ranges.select("shard", "rows", F.explode("x").alias("x")).select("shard", "rows", "x.*").coalesce(1).write.parquet(f"{path}/ranges")
    return docs.sparkSession.read.parquet(f"{path}/ranges")


def shards_for(ranges: DataFrame, dimension: str, least, greatest) -> list[int]:
    """The shards that may hold values from ``least`` to ``greatest`` of a dimension; the ranges have one row a shard."""
    kind = "long" if dimension == "size" else "string"
    mine = ranges.where((F.col("dimension") == dimension) & (F.col("least").cast(kind) <= F.lit(greatest)) & (F.col("greatest").cast(kind) >= F.lit(least)))
    return sorted(r["shard"] for r in mine.select("shard").collect())


def read_shards(spark, path: str, dimension: str, least, greatest, text_col: str = "text") -> DataFrame:
    """The rows with values from ``least`` to ``greatest`` of a dimension, out of the shards that may have them."""
    wanted = shards_for(spark.read.parquet(f"{path}/ranges"), dimension, least, greatest)
    rows = spark.read.parquet(f"{path}/data").where(F.col("shard").isin(wanted)).select("row.*")
    value = F.coalesce(F.octet_length(text_col), F.lit(0)) + 16 if dimension == "size" else F.col(dimension).cast("string")
    return rows.where(value.between(least, greatest))


def op9_hilbert(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` in 40 shards of equal row counts."""
    return hilbert_shards(table(spark, sf_dir, "documents"))
