"""Quality rules as a bitmask ledger (native).

Every rule is evaluated once per document. The ledger keeps its measurements and one
bit per failed rule; a policy is a named, versioned mask over those bits, so changing a
policy or asking what one rule costs never touches the texts again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.llm.common import words_of

WINDOW = 8
#: A rule's place in this tuple is its bit. The first two are the base rules.
RULES: tuple[tuple[str, Column | str], ...] = (
    ("few_words", "n_words < 20"),
    ("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "10 * n_symbols > word_chars"),
    ("duplicate_lines", "10 * n_dup_lines > 3 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
)
BASE = ("few_words", "repeated_words")


@dataclass(frozen=True)
class Policy:
    """Documents fail if any of ``reject`` failed. The version names a set of rules for good."""

    version: str
    reject: tuple[str, ...]

    @property
    def mask(self) -> int:
        names = [n for n, _ in RULES]
        return sum(1 << names.index(r) for r in self.reject)


POLICIES = {
    "base": Policy("base", BASE),
    "v1": Policy("v1", (*BASE, "symbols", "duplicate_lines", "short_words", "long_words")),
}


def _covered(starts: Column, width: int) -> Column:
    """How many positions the windows of ``width`` at the sorted ``starts`` cover."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    step = lambda acc, s: F.struct(
        (s + width).alias("end"), (acc["n"] + width - F.greatest(F.lit(0), acc["end"] - s)).alias("n")
    )
    return F.aggregate(starts, zero, step, lambda acc: acc["n"])


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, measurements, ``bits``.

    Null and empty texts have no words; repeated rows give repeated rows; an empty table
    gives none. Only the two named columns are read, so other columns cannot clash. A very
    long text is one row of arrays in one task, sorted only if a window repeats. One
    pass, no shuffle: windows are compared as hashes to find the few documents that repeat
    any, and only in those as exact texts.
    """
    t = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    t = t.select("doc_id", "t", words_of(F.col("t")).alias("w"))
    t = t.select(
        "doc_id", "w", F.size("w").alias("n"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count(F.col("t"), F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    w = F.col("w")
    places = F.sequence(F.lit(0), F.col("n") - WINDOW)
    t = t.select(
        "*",
        F.when(
            F.col("n") > WINDOW,
            F.transform(places, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])),
        ).alias("h"),
    )
    t = t.select("*", (F.size(F.array_distinct("h")) < F.size("h")).alias("again"))
    as_text = F.transform(
        places, lambda i: F.struct(F.array_join(F.slice(w, i + 1, WINDOW), " ").alias("x"), i.alias("i"))
    )
    t = t.select("*", F.when(F.col("again"), F.array_sort(as_text)).alias("s"))
    s = F.col("s")
    twice = F.filter(
        F.transform(
            s,
            lambda x, j: F.when(
                (F.get(s, j - 1)["x"] == x["x"]) | (F.get(s, j + 1)["x"] == x["x"]), x["i"]
            ),
        ),
        lambda i: i.isNotNull(),
    )
    t = t.select(
        "doc_id",
        F.col("n").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("again"), _covered(F.array_sort(twice), WINDOW)).otherwise(0).cast("long").alias("n_repeat_words"),
    )
    bits = F.lit(0)
    for k, (_, rule) in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)))
    return t.select("*", bits.alias("bits"))


def apply_policy(rows: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with ``base_failed``, ``kept`` and the policy's version."""
    fails = lambda p: F.col("bits").bitwiseAND(F.lit(p.mask)) != 0
    base = fails(POLICIES["base"])
    return rows.select("*", base.alias("base_failed"), (~base & ~fails(policy)).alias("kept"), F.lit(policy.version).alias("policy"))


def ablations(rows: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: documents that fail it, and those that only it rejects.

    Rows are first counted per bit pattern (at most 2 to the number of rules), so what is
    shuffled does not grow with the input.
    """
    patterns = rows.groupBy(F.col("bits").bitwiseAND(F.lit(policy.mask)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    names = [n for n, _ in RULES]
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).alias("bit")) for r in policy.reject])
    each = patterns.select("bits", "n", F.explode(rules).alias("r")).select("bits", "n", "r.rule", "r.bit")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"),
    )


def op3_rules(spark, sf_dir: str) -> DataFrame:
    """Ledger and verdict of policy v1 over all ``documents``."""
    from kinfold.llm.common import table

    out = apply_policy(ledger(table(spark, sf_dir, "documents")), POLICIES["v1"])
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "bits")


SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
m AS (
  SELECT doc_id, w, len(w) AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM w),
g AS (
  SELECT doc_id, i, array_to_string(w[i:i+7], ' ') AS x
  FROM m, unnest(generate_series(1, n_words - 7)) AS s(i)),
d AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS c FROM g),
r AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM d, unnest(generate_series(i, i + 7)) AS u(p) WHERE c > 1 GROUP BY doc_id),
a AS (
  SELECT m.doc_id, n_words, word_chars, n_symbols, len(lines) AS n_lines,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM m LEFT JOIN r ON m.doc_id = r.doc_id),
b AS (
  SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END) | (CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END)
         | (CASE WHEN 10 * n_symbols > word_chars THEN 4 ELSE 0 END) | (CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN 8 ELSE 0 END)
         | (CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END) | (CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END) AS bits
  FROM a)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, (bits & 3) <> 0 AS base_failed, bits = 0 AS kept, bits::INTEGER AS bits
FROM b
"""
