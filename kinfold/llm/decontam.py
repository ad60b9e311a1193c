"""Benchmark decontamination (native): a broadcast hash set of the test windows.

Every window of a document is hashed, its hash built up from hashes of half as many words,
and looked up in the set of test hashes: a byte per slot, two slots a hash, which travels
inside the plan and is at most 16 MB. What is found is verified by its text against the
tests themselves, and the covered words are marked. A benchmark with more windows than one
set takes is cut into several sets with a pass over the documents each; every size goes the
same way.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.llm.common import ascii_lower, join_dealt, materialize, table, text_key

SIZE = 13
#: Windows of one set, and the slots of the largest one.
SET_LIMIT, SLOTS = 4_000_000, 1 << 24
#: Test windows whose texts may be broadcast to verify what was found; some 10 MB.
TEXT_LIMIT = 50_000
_KEY = ["doc_id", "t1", "t2"]


def words_of(text: Column) -> Column:
    """Runs of digits, letters a-z after lowering A-Z, and characters beyond ASCII; null has none."""
    return F.array_remove(
        F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), ""
    )


def _pairs(hashes: str, step: int):
    return F.transform(hashes, lambda x, i: F.xxhash64(x, F.get(hashes, i + step)))


def hashed(t: DataFrame) -> DataFrame:
    """Adds ``_1``, ``_2``, ``_4``, ``_8``: per place of ``w`` the hash of so many words from there on."""
    t = t.select("*", F.transform("w", lambda x: F.xxhash64(x)).alias("_1"))
    for k in (1, 2, 4):
        t = t.select("*", _pairs(f"_{k}", k).alias(f"_{2 * k}"))
    return t


def _hash(at: Column, size: int) -> Column:
    """Hash of the window at a place: of the hashes of its first and last 1, 2, 4 or 8 words, which cover it."""
    half = 1 << (size.bit_length() - 1)
    return F.xxhash64(F.get(f"_{half}", at), F.get(f"_{half}", at + (size - half)))


def _hash_by_size(i: Column) -> Column:
    out = _hash(i, SIZE)
    for k in range(1, SIZE):
        out = F.when(F.col("n") == k, _hash(i, k)).otherwise(out)
    return out


def windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, size, hash, window) of each window of each item; a short item is one window."""
    t = items.select(F.col(id_col).alias("item_id"), words_of(F.col(text_col)).alias("w"))
    t = hashed(t.select("item_id", "w", F.size("w").alias("n")).where("n > 0"))
    at = F.sequence(F.lit(0), F.greatest(F.col("n") - SIZE, F.lit(0)))
    size = F.least(F.col("n"), F.lit(SIZE))
    each = F.transform(at, lambda i: F.struct(_hash_by_size(i).alias("hash"), F.array_join(F.slice("w", i + 1, size), " ").alias("window")))
    return t.select("item_id", size.alias("size"), F.explode(each).alias("x")).select("item_id", "size", "x.hash", "x.window").distinct()


class _Set:
    """The hashes of windows of one size: a byte per slot; a hash is in if both its slots are taken."""

    def __init__(self, hashes: np.ndarray, slots: int):
        self.slots = slots
        taken = np.zeros(slots, np.uint8)
        taken[hashes & (slots - 1)] = 1
        taken[(hashes >> 32) & (slots - 1)] = 1
        self.taken = F.lit(taken.tobytes())

    def has(self, h: Column) -> Column:
        one = lambda at: F.substring(self.taken, at.bitwiseAND(F.lit(self.slots - 1)).cast("int") + 1, F.lit(1)) == F.lit(b"\x01")
        return one(h) & one(F.shiftright(h, 32))


def _in_set(known: _Set, size: int):
    return lambda i: known.has(_hash(i, size))


def _window(size: int):
    return lambda i: F.struct(i.alias("start"), F.lit(size).alias("size"), F.array_join(F.slice("w", i + 1, size), " ").alias("window"))


def _candidates(docs: DataFrame, tests: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row per row of ``docs``: its key, n_words, and in ``f`` the windows (start, size, window) whose hash is in the set."""
    found = tests.select("size", "hash").distinct().toArrow()  # at most ``SET_LIMIT`` rows of two numbers
    sizes, hashes = (found.column(k).to_numpy() for k in (0, 1))
    d = docs.select(F.col(id_col).alias("doc_id"), *text_key(F.col(text_col)), words_of(F.col(text_col)).alias("w"))
    d = hashed(d.select(*_KEY, "w", F.size("w").alias("n")))
    hits = []
    for size in sorted(set(sizes.tolist())):
        mine = hashes[sizes == size]
        known = _Set(mine, min(SLOTS, 1 << (64 * len(mine)).bit_length()))
        places = F.when(F.col("n") >= size, F.sequence(F.lit(0), F.col("n") - size)).otherwise(F.array().cast("array<int>"))
        hits.append(F.transform(F.filter(places, _in_set(known, size)), _window(size)))
    none = F.array().cast("array<struct<start:int,size:int,window:string>>")
    return d.select(*_KEY, F.col("n").cast("long").alias("n_words"), (F.concat(*hits) if hits else none).alias("f"))


def hits(docs: DataFrame, tests: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         set_limit: int = SET_LIMIT, text_limit: int = TEXT_LIMIT) -> DataFrame:
    """Per document: doc_id, t1, t2, n_words, spans (start, size of each hit window), items (ids, sorted as strings).

    Null and empty texts have no words, hence no hit; so has an item. Repeated rows give
    repeated rows with the same hits. Empty tables work on either side. A very long text
    is one row of arrays in one task, in linear time. Other columns are not read.
    """
    tests = materialize(tests.select("size", "hash", "window", F.col("item_id").cast("string").alias("item")), "tests")
    n = tests.count()
    passes = max(1, -(-n // max(1, set_limit)))
    rows, verified = None, []
    for k in range(passes):
        part = tests.where(F.pmod(F.xxhash64("hash", F.lit(7)), F.lit(passes)) == k) if passes > 1 else tests
        got = materialize(_candidates(docs, part, id_col, text_col), "candidates")
        rows = got.drop("f") if rows is None else rows
        each = got.where(F.size("f") > 0).select(*_KEY, F.explode("f").alias("x")).select(*_KEY, "x.start", "x.size", "x.window")
        known = part.groupBy("window").agg(F.collect_set("item").alias("items"))
        if n <= text_limit:
            verified.append(each.join(F.broadcast(known), "window"))
        else:  # a passage that very many documents have is not one task
            often = each.groupBy("window").agg(F.count(F.lit(1)).alias("_n"))
            known = materialize(known.join(often, "window"), "known")
            verified.append(join_dealt(each, known, ["window"], "_n").drop("_n"))
    found = reduce(DataFrame.unionByName, verified).groupBy(*_KEY).agg(
        F.array_sort(F.collect_set(F.struct("start", "size"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    same = rows["doc_id"].eqNullSafe(found["doc_id"]) & (rows["t1"] == found["t1"]) & (rows["t2"] == found["t2"])
    none = F.array().cast("array<struct<start:int,size:int>>")
    return rows.join(found, same, "left").select(
        *[rows[c] for c in rows.columns], F.coalesce(found["spans"], none).alias("spans"),
        F.coalesce(found["items"], F.array().cast("array<string>")).alias("items"),
    )


def n_covered(spans: Column) -> Column:
    """Words that the sorted spans cover."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    step = lambda a, s: F.struct(
        F.greatest(a["end"], s["start"] + s["size"]).alias("end"),
        (a["n"] + F.greatest(F.lit(0), s["start"] + s["size"] - F.greatest(a["end"], s["start"]))).alias("n"),
    )
    return F.aggregate(spans, zero, step, lambda a: a["n"]).cast("long")


def report(found: DataFrame) -> DataFrame:
    """Counts, digest and verdict of ``hits``: contaminated if a twentieth of the words are hit."""
    t = found.select(*_KEY, "n_words", n_covered(F.col("spans")).alias("n_hit"), "items")
    return t.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), "t1", "t2",
    )


def op2_decontaminate(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` against all of ``benchmark``."""
    tests = windows(table(spark, sf_dir, "benchmark"))
    return report(hits(table(spark, sf_dir, "documents"), tests)).drop("t1", "t2")


#: Contaminated rows whose keys (three numbers each) may be broadcast.
KEY_LIMIT = 300_000


def clean(docs: DataFrame, tests: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns as they were; awkward rows as in ``hits``."""
    bad = report(hits(docs, tests, id_col, text_col)).where("contaminated").select(*_KEY).distinct()
    bad = materialize(bad, "contaminated").toDF("_bad", "_t1", "_t2")
    if bad.count() <= KEY_LIMIT:
        bad = F.broadcast(bad)
    t1, t2 = text_key(docs[text_col])
    return docs.join(bad, docs[id_col].eqNullSafe(bad["_bad"]) & (t1 == bad["_t1"]) & (t2 == bad["_t2"]), "left_anti")


def _sql_words(column: str) -> str:
    letters = "".join(chr(65 + k) for k in range(26))
    low = f"translate(coalesce({column}, ''), '{letters}', '{letters.lower()}')"
    return rf"list_filter(regexp_split_to_array({low}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"


SQL = f"""
WITH b AS (SELECT item_id, {_sql_words('text')} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS x
  FROM b, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS s(i) WHERE len(w) > 0),
d AS (SELECT doc_id, {_sql_words('text')} AS w FROM documents),
sz AS (SELECT DISTINCT size FROM bw),
dw AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS x
  FROM d, sz, unnest(generate_series(1, len(w) - size + 1)) AS s(i)),
hit AS (SELECT doc_id, i, dw.size, item_id FROM dw JOIN bw USING (x)),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(generate_series(i, i + size - 1)) AS u(p) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cov ON d.doc_id = cov.doc_id LEFT JOIN its ON d.doc_id = its.doc_id
"""
