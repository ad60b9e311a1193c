"""Candidate pairs: equal blocking keys, and MinHash bands for near-equal names."""

from __future__ import annotations

import hashlib
import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

#: Blocking keys and the least length of a key that counts.
KEYS = {"bk_name_prefix": 4, "bk_country_postcode": 3, "bk_country_city": 3, "bk_name_translit": 3, "name_sorted": 3}
HASHES, BANDS = 128, 16
#: Ids of a class in one row while pairs of classes are written out.
CHUNK = 1000
#: Lists of either side that meet in one cell of a hot key, and pairs that one task writes out.
CELL, TASK = 3, 8_000_000
#: Of a cell of the grid in which classes are written out: pairs, ids of either side, ids of lists put together; and pairs that are not worth a task of their own.
CELLS, IDS, COPIED, FEW = 64_000_000, 250_000, 2_000_000, 500_000
#: Candidates written out again and again, one first-source id after the other; so few, and a multiple of 8, compress well as codes of whole bits.
CYCLE = 128
#: Pairs of records of a bucket that one task compares; a larger bucket is dealt by its first-source records.
BUCKET = 20_000_000


def keyed(df: DataFrame, keys: dict[str, int], skip_empty_keys: bool = False) -> DataFrame:
    """(entity_id, kind, key): one row per record and usable key.

    A country key with nothing after the bar still counts, as in the plain reading of the
    rule; ``skip_empty_keys`` leaves such keys out.
    """
    rows = [F.struct(F.lit(k).alias("kind"), F.col(k).alias("key"), F.lit(n).alias("least")) for k, n in keys.items()]
    t = df.select("entity_id", F.explode(F.array(*rows)).alias("x")).select("entity_id", "x.kind", "x.key", "x.least")
    t = t.where((F.length("key") >= F.col("least")) & (F.col("key") != ""))
    if skip_empty_keys:
        t = t.where(~(F.col("kind").startswith("bk_country_") & F.col("key").endswith("|")))
    return t.drop("least")


def exact_block(s1: DataFrame, others: DataFrame, key: str, min_key_len: int = 1) -> DataFrame:
    """Distinct (s1_id, candidate_id) with the same value of one key."""
    return block_union(s1, others, {key: min_key_len})


def block_union(s1: DataFrame, others: DataFrame, keys: dict[str, int] = KEYS, skip_empty_keys: bool = False) -> DataFrame:
    """Distinct pairs with the same value of any key: one join over (kind, key), not one per key.

    Keys that the first source lacks are passed over. A pair is written out under the first
    key that it has in common, keys with most pairs first, from lists of ids that agree in
    that key and those before it: pairs are neither shuffled nor made distinct, unless an id
    has several records with different keys. A hot key is dealt to tasks by cells of lists.
    """
    keys = {k: n for k, n in keys.items() if k in s1.columns}
    side = lambda df, k: df.select("entity_id", F.lit(k).alias("side"), _usable(keys, skip_empty_keys).alias("keys"))
    rows = side(s1, 0).unionByName(side(others, 1)).persist()
    each = F.posexplode("keys").alias("kind", "key")
    counts = rows.select("side", each).where("key is not null").groupBy("kind", "key").agg(F.sum("side").alias("n2"), F.sum(1 - F.col("side")).alias("n1"))
    counts = counts.where("n1 > 0 and n2 > 0").persist()
    sums = {r["kind"]: r["n"] for r in counts.groupBy("kind").agg(F.sum(F.col("n1") * F.col("n2")).alias("n")).collect()}
    order = sorted(sums, key=lambda k: (-sums[k], k))
    if not order:
        return rows.where(F.lit(False)).select(F.col("entity_id").alias("s1_id"), F.col("entity_id").alias("candidate_id"))
    left, right = _listed(rows, counts, order)
    parts = max(sum(sums.values()) // TASK, s1.sparkSession.sparkContext.defaultParallelism)
    at = ["kind", "key", "x", "y"]
    met = left.repartition(parts, *at).join(right.repartition(parts, *at), at)
    for i in range(len(order) - 1):
        met = met.where(~F.coalesce(F.col(f"before1.k{i}") == F.col(f"before2.k{i}"), F.lit(False)))
    out = met.select("ids1", F.explode(_cycles("ids2")).alias("ids2")).select(F.explode("ids1").alias("s1_id"), "ids2")
    out = out.select("s1_id", F.explode("ids2").alias("candidate_id"))
    return out.distinct() if _several_keys(rows, len(keys)) else out


def _usable(keys: dict[str, int], skip_empty_keys: bool) -> Column:
    """The record's keys that count, as ``keyed`` has them; null for others."""
    each = []
    for k, n in keys.items():
        ok = (F.length(k) >= n) & (F.col(k) != "")
        each.append(F.when(ok & ~F.col(k).endswith("|") if skip_empty_keys and k.startswith("bk_country_") else ok, F.col(k).cast("string")))
    return F.array(*each)


def _listed(rows: DataFrame, counts: DataFrame, order: list[int]) -> tuple[DataFrame, DataFrame]:
    """(kind, key, x, y, before, ids) of both sides: lists of ids with equal keys up to ``kind``; x and y are the cell of a hot key."""
    before = lambda i: F.struct(*[(F.col("keys")[order[j]] if j < i else F.lit(None).cast("string")).alias(f"k{j}") for j in range(len(order) - 1)] or [F.lit(0).alias("none")])
    kinds = [F.struct(F.lit(k).alias("kind"), F.col("keys")[k].alias("key"), before(i).alias("before")) for i, k in enumerate(order)]
    hot = counts.where(f"n1 > {CHUNK} or n2 > {CHUNK}").select("kind", "key", *[F.ceil(F.col(n) / CHUNK).alias(p) for n, p in (("n1", "p1"), ("n2", "p2"))])
    dealt = rows.select("entity_id", "side", F.explode(F.array(*kinds)).alias("x")).select("entity_id", "side", "x.*").where("key is not null")
    dealt = dealt.join(F.broadcast(hot), ["kind", "key"], "left").fillna(1, ["p1", "p2"])
    cells = lambda p: F.explode(F.sequence(F.lit(0), F.ceil(F.col(p) / CELL).cast("int") - 1))

    def of(k: int, own: str, other: str) -> DataFrame:
        part = F.pmod(F.xxhash64("entity_id"), F.col(own)).cast("int").alias("part")
        lists = dealt.where(F.col("side") == k).groupBy("kind", "key", "before", part, "p1", "p2").agg(F.collect_set("entity_id").alias(f"ids{k + 1}"))
        own_cell, other_cell = F.floor(F.col("part") / CELL).cast("int"), cells(other)
        return lists.select("kind", "key", F.col("before").alias(f"before{k + 1}"), own_cell.alias("xy"[k]), other_cell.alias("yx"[k]), f"ids{k + 1}")

    return of(0, "p1", "p2"), of(1, "p2", "p1")


def _several_keys(rows: DataFrame, width: int) -> bool:
    """Whether an id of one side has records with different keys."""
    of = F.xxhash64(*[F.coalesce(F.concat(F.lit("="), F.element_at("keys", i + 1)), F.lit("")) for i in range(width)])
    ids = rows.select("side", F.xxhash64("entity_id").alias("id"), of.alias("of")).groupBy("side", "id").agg(F.min("of").alias("x"), F.max("of").alias("y"))
    return not ids.where("x <> y").isEmpty()


def _classed(df: DataFrame, cols: list[str]) -> DataFrame:
    """(entity_id, class, cols): records with equal values of ``cols``, nulls included, have one class (128 bits of them)."""
    values = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in cols]
    return df.select("entity_id", F.struct(F.xxhash64(*values), F.xxhash64(F.lit(1), *values)).alias("class"), *cols)


def _class_rows(classed: DataFrame, cols: list[str]) -> DataFrame:
    """One row per class, its class as entity_id."""
    return classed.groupBy("class").agg(*[F.min(c).alias(c) for c in cols]).withColumnRenamed("class", "entity_id")


def _class_pairs(a: DataFrame, b: DataFrame, keys: dict[str, int], skip_empty_keys: bool) -> DataFrame:
    """(c1, c2): distinct pairs of classes with a key in common."""
    left = keyed(_class_rows(a, list(keys)), keys, skip_empty_keys).withColumnRenamed("entity_id", "c1")
    right = keyed(_class_rows(b, list(keys)), keys, skip_empty_keys).withColumnRenamed("entity_id", "c2")
    return left.join(right, ["kind", "key"]).select("c1", "c2").distinct()


def _lists(classed: DataFrame) -> DataFrame:
    """(class, list, n, ids, source): the ids of each class and source, each once, in lists of about ``CHUNK``; ``list`` is 128 bits of where they are from."""
    source = F.substring_index("entity_id", "-", 1).alias("source")
    rows = classed.where("entity_id is not null").select("class", source, "entity_id")
    sizes = rows.groupBy("class", "source").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("parts"))
    of = ["class", "source", F.pmod(F.xxhash64("entity_id"), F.col("parts")).alias("part")]
    lists = rows.join(sizes, ["class", "source"]).groupBy(*of).agg(F.collect_set("entity_id").alias("ids"))
    at = F.struct(F.xxhash64("class", "source", "part").alias("x"), F.xxhash64(F.lit(1), "class", "source", "part").alias("y"))
    return lists.select("class", at.alias("list"), F.size("ids").cast("long").alias("n"), "ids", "source")


def _written_out(pairs: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """(s1_id, candidate_id, candidate_source) of distinct pairs of classes.

    Classes have no record in common, so the pairs of records need no shuffle to be
    distinct, unless an id has several classes. Lists of ids meet in the cells of a grid, as
    many as the number of pairs asks for; where lists have few others to meet, they are joined.
    """
    left, right = _lists(a).persist(), _lists(b).persist()
    side = lambda df, k: df.select(F.col("class").alias(f"c{k}"), F.col("list").alias(f"l{k}"), F.col("n").alias(f"n{k}"))
    links = pairs.join(side(left, 1), "c1").join(side(right, 2), "c2").select("l1", "l2", "n1", "n2").persist()
    of1, ids1, of2, ids2, found, sent, copied = _totals(left, a, right, b, links)
    tasks = max(found / CELLS, min(4 * a.sparkSession.sparkContext.defaultParallelism, found / FEW))
    width, height = _grid(max(tasks, copied / COPIED), of1, of2)
    if of1 * height + of2 * width < sent:
        met = _in_cells(links, left, right, width, height)
    else:
        met = links.join(left.select(F.col("list").alias("l1"), F.col("ids").alias("ids1")), "l1")
        to, parts = right.select(F.col("list").alias("l2"), F.col("ids").alias("ids2"), "source"), math.ceil(max(tasks, sent / IDS, 1))
        met = met.repartition(parts, "l2").join(to.repartition(parts, "l2"), "l2")
    out = met.select("ids1", "source", F.explode(_cycles("ids2")).alias("ids2"))
    out = _one_by_one(out.select(F.explode("ids1").alias("s1_id"), "ids2", "source"))
    out = out.select("s1_id", F.explode("ids2").alias("candidate_id"), F.col("source").alias("candidate_source"))
    return out.distinct() if of1 > ids1 or of2 > ids2 else out  # some id has several classes


def _totals(left: DataFrame, a: DataFrame, right: DataFrame, b: DataFrame, links: DataFrame) -> list[float]:
    """Ids in lists and different ids of either side; of the linked lists the pairs of ids, the ids, and those of the second side. One job, as each takes memory of the driver."""
    total = lambda df, **cols: df.agg(*[F.coalesce(F.sum(c.cast("double")), F.lit(0.0)).alias(k) for k, c in cols.items()])
    ids = lambda df, k: df.agg(F.countDistinct("entity_id").cast("double").alias(k))
    n1, n2 = F.col("n1").cast("double"), F.col("n2")
    each = [total(left, t0=F.col("n")), ids(a, "t1"), total(right, t2=F.col("n")), ids(b, "t3"), total(links, t4=n1 * n2, t5=n1 + n2, t6=n2)]
    found = {k: v for r in reduce(lambda x, y: x.unionByName(y, True), each).collect() for k, v in r.asDict().items() if v is not None}
    return [found[f"t{k}"] for k in range(7)]


def _grid(cells: float, n1: float, n2: float) -> tuple[int, int]:
    """Width and height of a grid of so many cells, shaped so that the fewest ids are sent; a cell has some ``IDS`` of a side at most."""
    width = min(max(math.sqrt(cells * n1 / max(n2, 1)), n1 / IDS, 1), max(cells, n1 / IDS, 1))
    return math.ceil(width), math.ceil(max(cells / math.ceil(width), n2 / IDS, 1))


def _in_cells(links: DataFrame, left: DataFrame, right: DataFrame, width: int, height: int) -> DataFrame:
    """(ids1, ids2, source): each list with the ids of all others that it meets in a cell. A cell gets a list once."""

    def placed(df, n, at):
        df = df.select("list", "ids", "source", F.pmod(F.xxhash64("list"), F.lit(n)).cast("int").alias(at))
        return df.withColumn("pos", F.row_number().over(Window.partitionBy(at).orderBy("list")))

    left, right = placed(left, width, "x"), placed(right, height, "y")
    links = links.join(left.select(F.col("list").alias("l1"), "x", F.col("pos").alias("p1")), "l1")
    links = links.join(right.select(F.col("list").alias("l2"), "y", F.col("pos").alias("p2"), "source"), "l2")
    links = links.groupBy("x", "y", "p1", "source").agg(F.collect_list("p2").alias("p2"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = left.select("x", every(height).alias("y"), F.struct("pos", "ids").alias("of1"))
    rows = rows.unionByName(right.select(every(width).alias("x"), "y", F.struct("pos", "ids").alias("of2")), True)
    rows = rows.unionByName(links.select("x", "y", F.struct("p1", "p2", "source").alias("link")), True)
    lists = lambda c: F.sort_array(F.collect_list(c))["ids"].alias(c)
    cells = rows.repartition(width * height, "x", "y").groupBy("x", "y").agg(lists("of1"), lists("of2"), F.collect_list("link").alias("links"))
    ids2 = lambda k: F.flatten(F.transform(k["p2"], lambda p: F.col("of2")[p - 1]))
    met = F.transform("links", lambda k: F.struct(F.col("of1")[k["p1"] - 1].alias("ids1"), ids2(k).alias("ids2"), k["source"].alias("source")))
    return cells.select(F.explode(met).alias("met")).select("met.*")


def _cycles(ids: str) -> Column:
    """The list in pieces of ``CYCLE``."""
    return F.transform(F.sequence(F.lit(0), F.ceil(F.size(ids) / CYCLE).cast("int") - 1), lambda i: F.slice(ids, i * CYCLE + 1, CYCLE))


def _one_by_one(df: DataFrame) -> DataFrame:
    """The same rows of (s1_id, ids2), handed on one by one.

    Spark compiles explodes in a row to one loop, which holds all that a row of the first
    gives; an operator with a higher-order function is not compiled and parts them. The
    condition always holds, since lists have no nulls.
    """
    return df.where(F.exists("ids2", lambda i: i.isNotNull() & F.col("s1_id").isNotNull()))


def minhash(c: Column, hashes: int = HASHES, seed: int = 0) -> Column:
    """Signature as array<bigint>: per slot the least of the trigrams' hashes XOR the slot's constant.

    A trigram's hash is the first 32 bits of its MD5. All slots of a text are one array
    operation in an Arrow function; nested lambdas are slower, because Spark interprets
    them element by element. The trigrams of the text with two blanks round it (the empty
    text has one, '') are taken in the function too: Spark's substring walks a text from its start, which makes long texts quadratic.
    """
    run = lambda texts: pd.Series(list(_least(texts, hashes, seed).astype(np.int64)), dtype=object)
    return F.pandas_udf(_series(run), ArrayType(LongType()))(c)


def _series(f):
    def run(texts: pd.Series) -> pd.Series:
        return f(texts)

    return run


_known: dict[int, dict[int, int]] = {}


def _least(texts, hashes: int, seed: int = 0) -> np.ndarray:
    """Signatures of the texts, a row each. A trigram is a number of three times 21 bits while it is looked up."""
    known, slots = _known.setdefault(seed, {}), np.array([(i * 2654435761) & 0xFFFFFFFF for i in range(hashes)], np.uint32)
    if len(known) > 1 << 20:
        known.clear()
    out = np.empty((len(texts), hashes), np.uint32)
    for row, t in enumerate(texts):
        if t:
            at = np.frombuffer(f"  {t}  ".encode("utf-32-le"), np.uint32).astype(np.int64)
            grams = np.unique(at[:-2] << 42 | at[1:-1] << 21 | at[2:]).tolist()
        else:
            grams = [-1]
        hashed = [known.get(g) for g in grams]
        if None in hashed:
            for i, g in enumerate(grams):
                if hashed[i] is None:
                    text = "" if g < 0 else chr(g >> 42) + chr(g >> 21 & 0x1FFFFF) + chr(g & 0x1FFFFF)
                    hashed[i] = known[g] = int.from_bytes(hashlib.md5(text.encode()).digest()[:4], "big") ^ seed
        hashed = np.array(hashed, np.uint32)
        out[row] = np.min([(slots[:, None] ^ hashed[i : i + 8192]).min(axis=1) for i in range(0, len(hashed), 8192)], axis=0)
    return out


def signatures(df: DataFrame, text_col: str = "name_nospace", hashes: int = HASHES, *more: str) -> DataFrame:
    """(entity_id, sig, and the columns ``more``)."""
    return df.select("entity_id", minhash(F.coalesce(F.col(text_col), F.lit("")), hashes).alias("sig"), *more)


def bands(sigs: DataFrame, hashes: int = HASHES, count: int = BANDS) -> DataFrame:
    """(entity_id, band, band_key, and other columns but the signature): the slots of each band as one text."""
    if hashes % count:
        raise ValueError(f"{hashes} hashes do not divide into {count} bands")
    rows = hashes // count
    part = lambda b: F.array_join(F.slice("sig", b * rows + 1, rows), "-")
    each = F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda b: F.struct(b.alias("band"), part(b).alias("band_key")))
    more = [c for c in sigs.columns if c not in ("entity_id", "sig")]
    return sigs.select("entity_id", *more, F.explode(each).alias("x")).select("entity_id", "x.band", "x.band_key", *more)


def jaccard_estimate(a: Column, b: Column) -> Column:
    """Share of equal slots."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / F.size(a)


def lsh_block(s1: DataFrame, others: DataFrame, text_col: str = "name_nospace", hashes: int = HASHES, count: int = BANDS,
              threshold: float = 0.25, cap: int | None = 500) -> DataFrame:
    """(s1_id, candidate_id) that share a band and whose estimate reaches the threshold.

    ``cap``: of one record's candidates only the first so many are verified, in the order of
    their first common band and then of the rows of ``others``; None verifies them all.

    Records meet in buckets, one per value of a band, and bring their signatures along: a
    pair counts in its first common band only and is verified there, so pairs are never
    shuffled. Buckets without records of both sides are left out before. With a cap, the
    first of two passes counts each record's new candidates by band, the second verifies
    so many of them as the cap leaves.
    """
    if hashes % count:
        raise ValueError(f"{hashes} hashes do not divide into {count} bands")
    side = lambda df, k: df.select("entity_id", F.lit(k).alias("side"), _packed(F.coalesce(F.col(text_col), F.lit("")), hashes).alias("sig"))
    rows = side(s1, 0).unionByName(side(others, 1)).withColumn("pos", F.monotonically_increasing_id()).persist(StorageLevel.DISK_ONLY)
    width = hashes // count * 4
    keys = [F.struct(F.lit(k).alias("band"), F.xxhash64(F.lit(k), F.substring("sig", k * width + 1, width)).alias("key")) for k in range(count)]
    thin = rows.select("side", "pos", F.explode(F.array(*keys)).alias("x")).select("side", "pos", "x.band", "x.key")
    n = thin.groupBy("band", "key").agg(F.sum("side").alias("n2"), F.sum(1 - F.col("side")).alias("n1")).where("n1 > 0 and n2 > 0")
    parts = n.select("band", "key", F.least(F.ceil(F.col("n1") * F.col("n2") / BUCKET), F.col("n1")).cast("int").alias("parts"))
    wanted = thin.join(parts, ["band", "key"]).groupBy("pos").agg(F.collect_list(F.struct("band", "key", "parts")).alias("at"))
    met = rows.join(wanted, "pos").select("entity_id", "side", "sig", "pos", "at").persist(StorageLevel.DISK_ONLY)
    each = lambda df, *more: df.select("entity_id", "side", "sig", "pos", F.explode("at").alias("x"), *more).select("entity_id", "side", "sig", "pos", "x.*", *more)
    if cap is None:
        return _in_buckets(each(met).withColumn("quota", F.lit(-1)), hashes, count, threshold)
    # what is new needs no slots, only 64 bits of each band
    short = F.concat(*[F.unhex(F.lpad(F.hex(F.xxhash64(F.lit(k), F.substring("sig", k * width + 1, width))), 16, "0")) for k in range(count)])
    new = _in_buckets(each(met.withColumn("sig", short)).withColumn("quota", F.lit(0)), 2 * count, count, None)
    before = F.sum("n").over(Window.partitionBy("pos").orderBy("band").rowsBetween(Window.unboundedPreceding, -1))
    left = new.withColumn("quota", F.lit(cap) - F.coalesce(before, F.lit(0))).where("quota > 0")
    left = left.groupBy("pos").agg(F.map_from_entries(F.collect_list(F.struct("band", "quota"))).alias("left"))
    first = each(met.where("side = 0").join(left, "pos"), "left").withColumn("quota", F.col("left")[F.col("band")]).drop("left").where("quota is not null")
    return _in_buckets(first.unionByName(each(met.where("side = 1")).withColumn("quota", F.lit(0).cast("long"))), hashes, count, threshold)


def _packed(text: Column, hashes: int) -> Column:
    """The signature as bytes, four a slot."""
    run = lambda texts: pd.Series([r.tobytes() for r in _least(texts, hashes)], dtype=object)
    return F.pandas_udf(_series(run), "binary")(text)


def _in_buckets(met: DataFrame, hashes: int, count: int, threshold: float | None) -> DataFrame:
    """Compares the records of each bucket whose first common band it is.

    With a threshold (s1_id, candidate_id) of those that reach it, for each record of the
    first source the first ``quota`` only unless that is below 0; without one (pos, band,
    n), how many there are.
    """
    import pyarrow as pa

    own = F.array(F.pmod(F.xxhash64("pos"), F.col("parts")).cast("int"))
    part = F.when(F.col("side") == 0, own).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = met.select("band", "key", F.explode(part).alias("part"), "side", "pos", "entity_id", "sig", F.col("quota").cast("long").alias("quota"))
    order = ["band", "key", "part", "side", "pos"]
    dealt = dealt.repartition("band", "key", "part").sortWithinPartitions(*order)
    size = hashes // count
    names, kinds = (["pos", "band", "n"], [pa.int64(), pa.int32(), pa.int64()]) if threshold is None else (["s1_id", "candidate_id"], [pa.string()] * 2)

    def classes(rows):
        """Slots by class of equal signatures (a column each), class of each row; rows that repeat with their id are left out."""
        seen, kept, of, sigs = set(), [], [], {}
        for r in rows:
            if (r[1], r[2]) not in seen:
                seen.add((r[1], r[2]))
                kept.append(r)
                of.append(sigs.setdefault(r[2], len(sigs)))
        flat = np.frombuffer(b"".join(sigs), np.uint32).reshape(-1, hashes)
        return kept, np.array(of), flat, np.ascontiguousarray(flat.T)

    def compare(band, first, second):
        """Yields lists of columns."""
        first, of1, sigs1, _ = classes(first)
        second, of2, _, slots2 = classes(second)
        ids2, rows1 = np.array([r[1] for r in second], object), [[] for _ in sigs1]
        for i, c in enumerate(of1.tolist()):
            rows1[c].append(first[i])
        out, held = [], 0
        for sig, group in zip(sigs1, rows1, strict=True):
            same = slots2 == sig[:, None]
            new = np.logical_and.reduce(same[band * size : (band + 1) * size], axis=0)  # else only the key's hash is the same
            if band:
                new &= ~np.logical_and.reduce(same[: band * size].reshape(band, size, -1), axis=1).any(axis=0)
            if threshold is None:
                out += [(r[0], band, n) for n in [int(new[of2].sum())] for r in group if n]
                continue
            good = new & (np.add.reduce(same, axis=0, dtype=np.int32) / hashes >= threshold)
            if group[0][3] < 0:
                found = ids2[good[of2]]
                take = lambda r, found=found: found
            else:
                at = np.flatnonzero(new[of2])
                reached = good[of2][at]
                take = lambda r, at=at, reached=reached: ids2[at[: r[3]][reached[: r[3]]]]
            for r in group:
                got = take(r)
                if len(got):
                    out.append((r[1], got))
                    held += len(got)
                if held > 200_000:
                    yield columns(out)
                    out, held = [], 0
        if out:
            yield columns(out)

    def columns(out):
        if threshold is None:
            return list(zip(*out, strict=True))
        return [np.repeat(np.array([x for x, _ in out], object), [len(y) for _, y in out]), np.concatenate([y for _, y in out])]

    def run(batches):
        bucket, sides = None, ([], [])
        finish = lambda: (pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names) for cols in compare(bucket[0], *sides))
        for b in batches:
            cols = [b.column(k).to_pylist() for k in range(8)]
            for band, key, part, side, *row in zip(*cols, strict=True):
                if (band, key, part) != bucket:
                    if sides[0] and sides[1]:
                        yield from finish()
                    bucket, sides = (band, key, part), ([], [])
                sides[side].append(row)
        if sides[0] and sides[1]:
            yield from finish()

    return dealt.mapInArrow(run, "pos long, band int, n long" if threshold is None else "s1_id string, candidate_id string")


def generate_candidates(s1: DataFrame, s2: DataFrame, s3: DataFrame, lsh_enabled: bool = True, lsh_threshold: float = 0.25,
                        skip_empty_keys: bool = False, lsh_cap: int | None = 500) -> DataFrame:
    """s1_id, candidate_id, candidate_source: the union of all blocks, each pair once.

    Pairs are found between classes of records that agree in all keys and the name; so are
    those of MinHash, unless their cap counts single records.
    """
    others = s2.unionByName(s3)
    keys = {k: n for k, n in KEYS.items() if k in s1.columns}
    cols = list(dict.fromkeys([*keys, *["name_nospace"] * lsh_enabled]))
    a, b = _classed(s1, cols), _classed(others, cols)
    known = _class_pairs(a, b, keys, skip_empty_keys)
    if lsh_enabled and lsh_cap is None:
        known = known.unionByName(_alike(a, b, lsh_threshold)).distinct()
    pairs = _written_out(known, a, b)
    if lsh_enabled and lsh_cap is not None:
        alike = lsh_block(s1, others, threshold=lsh_threshold, cap=lsh_cap)
        pairs = pairs.unionByName(alike.withColumn("candidate_source", F.substring_index("candidate_id", "-", 1))).distinct()
    return pairs


def _alike(a: DataFrame, b: DataFrame, threshold: float) -> DataFrame:
    """(c1, c2): classes whose names MinHash finds alike; every distinct name is compared once."""
    name = F.coalesce("name_nospace", F.lit("")).alias("entity_id")
    x, y = (df.select(name).distinct().withColumn("name_nospace", F.col("entity_id")) for df in (a, b))
    found = lsh_block(x, y, threshold=threshold, cap=None)
    of = lambda df, c, n: df.select(F.col("class").alias(c), F.coalesce("name_nospace", F.lit("")).alias(n)).distinct()
    return found.join(of(a, "c1", "s1_id"), "s1_id").join(of(b, "c2", "candidate_id"), "candidate_id").select("c1", "c2")


def candidate_recall(candidates: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: found, total, candidate_recall over the true pairs (s1_id, match_id); 1 without any."""
    known = candidates.select("s1_id", F.col("candidate_id").alias("match_id")).distinct().withColumn("hit", F.lit(1))
    t = truth.join(known, ["s1_id", "match_id"], "left").agg(F.count("hit").alias("found"), F.count(F.lit(1)).alias("total"))
    return t.select("*", F.when(F.col("total") > 0, F.col("found") / F.col("total")).otherwise(1.0).alias("candidate_recall"))


def reduction_ratio(n_pairs: int, n1: int, n2: int, n3: int) -> float:
    """Share of all possible pairs that blocking saves."""
    return round(1 - n_pairs / max(n1 * (n2 + n3), 1), 6)
