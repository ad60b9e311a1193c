"""Integrity rules of output files; each rule is an aggregate, the result a table of findings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EXAMPLES = 5
SCHEMA = "file string, rule string, severity string, n long, examples array<string>"
HEADERS = {"matching": ("source1_entity_id", "matched_entity_ids"), "candidate": ("source1_entity_id", "candidate_entity_ids")}


def _finding(file: str, rule: str, offenders: DataFrame, severity: str = "error") -> DataFrame:
    """At most one row: how many distinct offenders (column ``x``), and the first few."""
    each = offenders.select("x").distinct()
    few = F.array_agg(F.col("x"))
    first = each.orderBy("x").limit(EXAMPLES).agg(F.array_sort(few).alias("examples"))
    t = each.agg(F.count(F.lit(1)).alias("n")).crossJoin(first)  # one row each
    return t.where("n > 0").select(F.lit(file).alias("file"), F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), "n", "examples")


def note(spark: SparkSession, file: str, rule: str, text: str, severity: str = "error") -> DataFrame:
    return spark.createDataFrame([(file, rule, severity, 1, [text])], SCHEMA)


def numbered(lines: DataFrame, offenders: DataFrame) -> DataFrame:
    """(x): the first few offending lines (pos, value), each behind its line number in its file."""
    few = offenders.orderBy("pos").limit(EXAMPLES).collect()
    if not few:
        return offenders.select(F.col("value").alias("x")).limit(0)
    upto = [F.sum(((F.col("pos.file") == r["pos"]["file"]) & (F.col("pos.n") <= r["pos"]["n"])).cast("int")).alias(f"n{k}") for k, r in enumerate(few)]
    numbers = lines.agg(*upto).first()  # one pass for all of them
    rows = [(f"line {n}: {r['value']}",) for n, r in zip(numbers, few, strict=True)]
    return lines.sparkSession.createDataFrame(rows, "x string")


def not_utf8(spark: SparkSession, path: str, file: str) -> DataFrame:
    """A finding where lines are not UTF-8, of which Spark's reader says nothing; their bytes are given in hex."""
    bad = spark.read.text(path).where(~F.is_valid_utf8("value")).select(F.hex(F.col("value").cast("binary")).alias("x"))
    return _finding(file, "not_utf8", bad)


def parse_rows(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pos, s1_id, ids) of rows with a tab, and (x) of malformed ones; ids are not trimmed."""
    malformed = lines.where(~F.col("value").contains("\t") & (F.trim("value") != "")).select(F.col("value").alias("x"))
    t = lines.where(F.col("value").contains("\t"))
    rest = F.element_at(F.split("value", "\t", 2), 2)
    ids = F.when(F.trim(rest) == "", F.array().cast("array<string>")).otherwise(F.split(rest, ","))
    return t.select("pos", F.get(F.split("value", "\t", 2), F.lit(0)).alias("s1_id"), ids.alias("ids")), malformed


def validate_lists(rows: DataFrame, required: DataFrame, file: str, malformed: DataFrame | None = None,
                   targets: DataFrame | None = None) -> DataFrame:
    """Findings about rows (s1_id, ids) against the required ids (``id``) and, if given, the targets (``id``)."""
    each = rows.select("s1_id", F.explode("ids").alias("id"))
    own, target = F.col("id").startswith("S1-"), F.col("id").startswith("S2-") | F.col("id").startswith("S3-")
    x = lambda c: F.col(c).alias("x")
    need, seen = required.select(F.col("id").alias("x")), rows.select(x("s1_id"))
    found = [
        _finding(file, "duplicate_row", rows.groupBy("s1_id").count().where("count > 1").select(x("s1_id"))),
        _finding(file, "repeated_id", rows.where(F.size("ids") != F.size(F.array_distinct("ids"))).select(x("s1_id"))),
        _finding(file, "self_match", each.where(own).select(x("id"))),
        _finding(file, "wrong_prefix", each.where(~own & ~target).select(x("id"))),
        _finding(file, "missing_row", need.join(seen, "x", "left_anti")),
        _finding(file, "unknown_row", seen.join(need, "x", "left_anti")),
    ]
    if malformed is not None:
        found.append(_finding(file, "malformed_row", malformed))
    if targets is not None:
        found.append(_finding(file, "unknown_id", each.where(target).select(x("id")).join(targets.select(F.col("id").alias("x")), "x", "left_anti")))
    return reduce(DataFrame.unionByName, found)


def outside_candidates(matched: DataFrame, candidates: DataFrame) -> DataFrame:
    """A warning with the records that match ids that were no candidates; the last row of an id counts."""
    pairs = lambda t: t.groupBy("s1_id").agg(F.max_by("ids", "pos").alias("ids")).select("s1_id", F.explode("ids").alias("id"))
    off = pairs(matched).join(pairs(candidates), ["s1_id", "id"], "left_anti")
    return _finding("matching", "outside_candidates", off.select(F.col("s1_id").alias("x")), "warning")


def header_problem(header: str | None, expected: tuple[str, str]) -> str | None:
    """Why a header line is unfit, or None."""
    if not header:
        return "empty file"
    if "\t" not in header and "," in header:
        return "comma-separated"
    names = tuple(c.strip().lower() for c in header.rstrip("\r\n").split("\t"))
    return None if names == expected else f"unexpected header {list(names)}"


def validate_files(spark: SparkSession, matching: str, candidate: str | None, test_dir: str, check_ids: bool = False) -> DataFrame:
    """Findings about the output files; they are fit if none is an error."""
    from kinfold.sources.tsv import _exists, _lines, read_ids

    if not _exists(spark, f"{test_dir}/test_source1.tsv"):
        return note(spark, "test_source1", "file_missing", test_dir)
    required, found, targets = read_ids(spark, f"{test_dir}/test_source1.tsv"), [], None
    others = [f"{test_dir}/test_source{i}.tsv" for i in (2, 3)]
    if not check_ids:
        found.append(note(spark, "targets", "ids_not_checked", "off", "warning"))
    elif all(_exists(spark, p) for p in others):
        targets = read_ids(spark, others[0]).unionByName(read_ids(spark, others[1])).distinct()
    else:
        found.append(note(spark, "targets", "ids_not_checked", "target file missing", "warning"))
    parsed = {}
    for kind, path in (("matching", matching), ("candidate", candidate)):
        if path is None:
            continue
        if not _exists(spark, path):
            found.append(note(spark, kind, "file_missing", path, "error" if kind == "matching" else "warning"))
            continue
        lines = _lines(spark, path)
        head = lines.orderBy("pos").limit(1).collect()
        if problem := header_problem(head[0]["value"] if head else None, HEADERS[kind]):
            found.append(note(spark, kind, "header", problem))
            continue
        first = head[0]["pos"]
        body = lines.where(~((F.col("pos.file") == first["file"]) & (F.col("pos.n") == first["n"])))
        parsed[kind], malformed = parse_rows(body)
        found += [validate_lists(parsed[kind], required, kind, malformed, targets), not_utf8(spark, path, kind)]
        faulty = body.where(~F.col("value").contains("\t") & (F.trim("value") != ""))
        where = numbered(lines, faulty)
        if not where.isEmpty():
            found.append(_finding(kind, "malformed_at", where, "warning"))
    if len(parsed) == 2:
        found.append(outside_candidates(parsed["matching"], parsed["candidate"]))
    return reduce(DataFrame.unionByName, found)


def passed(findings: DataFrame) -> bool:
    return findings.where(F.col("severity") == "error").isEmpty()

