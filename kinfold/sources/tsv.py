"""Tab-separated sources and sinks, with Parquet beside them."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from kinfold.functions.text import BLANK, parse_id_list, squeeze
from kinfold.operators.normalize import preprocess_source
from kinfold.operators.pairs import wide

COLUMNS = ("entity_id", "business_name", "business_address", "country")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(pos, value): lines in file order, without the carriage returns of other systems."""
    t = spark.read.text(path)
    place = F.struct(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("n"))
    return t.select(place.alias("pos"), F.regexp_replace("value", "\r$", "").alias("value"))


def read_tsv(spark: SparkSession, path: str, with_pos: bool = False) -> DataFrame:
    """All-string table: no quoting, names and values trimmed, missing values ''.

    Short rows are filled up, rows with too many fields and blank lines are passed over
    (``long_rows`` counts the former); a header with a single column is an error. The
    header is the first line of each file; an equal line further down is a row.
    ``with_pos`` keeps the place in the file.
    """
    head = spark.read.text(path).limit(1).collect()
    names = [x.strip().lstrip("\ufeff").strip() for x in head[0][0].rstrip("\r").split("\t")] if head else []
    if len(names) < 2:
        raise ValueError(f"{path}: expected tab-separated columns, found {names}")
    lines = _lines(spark, path)
    clean = F.regexp_replace("value", "^\ufeff", "")
    header = F.transform(F.split(clean, "\t"), lambda x: squeeze(x))
    first = lines.groupBy("pos.file").agg(F.min("pos").alias("_first")).select("_first")  # a row a file
    lines = lines.join(F.broadcast(first), F.col("pos") == F.col("_first"), "left")
    is_header = F.col("_first").isNotNull() & (F.array_join(header, "\t") == "\t".join(names))
    rows = lines.where(~is_header & (F.trim("value") != ""))
    parts = rows.select("pos", F.split("value", "\t").alias("v")).where(F.size("v") <= len(names))
    ends = f"^{BLANK}+|{BLANK}+$"
    cols = [F.regexp_replace(F.coalesce(F.get("v", F.lit(k)), F.lit("")), ends, "").alias(n) for k, n in enumerate(names)]
    return parts.select(*cols, *([F.col("pos").alias("_pos")] if with_pos else []))


def long_rows(spark: SparkSession, path: str) -> int:
    """How many lines have more fields than the header; ``read_tsv`` passes over them."""
    head = spark.read.text(path).first()
    fields = len(head[0].rstrip("\r").split("\t")) if head else 0
    return spark.read.text(path).where(F.size(F.split("value", "\t")) > fields).count()


def check_source(df: DataFrame, prefix: str, name: str) -> DataFrame:
    """A source with its four columns; of rows with one id the first in file order stays.

    Missing columns are an error; ids with another prefix, and repeated ids, a warning.
    """
    missing = [c for c in COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"{name}: missing columns {missing}")
    n = df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("entity_id").alias("ids"), F.sum((~F.col("entity_id").startswith(prefix)).cast("int")).alias("odd")).first()
    if n["odd"]:
        warnings.warn(f"{name}: {n['odd']} ids do not start with {prefix}", stacklevel=2)
    if n["n"] != n["ids"]:
        warnings.warn(f"{name}: {n['n'] - n['ids']} repeated ids; the first row of each stays", stacklevel=2)
        df = keep_first(df, "entity_id")
    return df


def keep_first(df: DataFrame, key: str, pos: str = "_pos", last: bool = False) -> DataFrame:
    """The first (or last) row of each key by place."""
    order = F.col(pos).desc() if last else F.col(pos).asc()
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("_n = 1").drop("_n")


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def load_split(spark: SparkSession, data_dir: str, split: str = "train", proc_dir: str | None = None) -> tuple[DataFrame, ...]:
    """The three processed sources of a split: from ``proc_dir`` where they lie there already."""
    out = []
    for i in (1, 2, 3):
        name = f"{split}_source{i}"
        if proc_dir and _exists(spark, f"{proc_dir}/{name}.parquet"):
            out.append(spark.read.parquet(f"{proc_dir}/{name}.parquet"))
            continue
        path = f"{data_dir}/{split}/{name}.tsv"
        if n := long_rows(spark, path):
            warnings.warn(f"{name}: {n} rows with too many fields are passed over", stacklevel=2)
        raw = check_source(read_tsv(spark, path, with_pos=True), f"S{i}-", name)
        out.append(preprocess_source(raw.select(*COLUMNS)))
    return tuple(out)


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """Parquet at ``path.parquet``, or else all-string TSV at ``path.tsv``."""
    return spark.read.parquet(f"{path}.parquet") if _exists(spark, f"{path}.parquet") else read_tsv(spark, f"{path}.tsv")


def write_processed(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(f"{path}.parquet")


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """(s1_id, matches) of a ground-truth file; a later row of the same id replaces an earlier one."""
    t = read_tsv(spark, path, with_pos=True)
    lists = F.col("matched_entity_ids") if "matched_entity_ids" in t.columns else F.lit("")
    t = t.select(F.col("source1_entity_id").alias("s1_id"), parse_id_list(lists).alias("matches"), "_pos")
    return keep_first(t, "s1_id", last=True).drop("_pos")


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """(s1_id, predicted) of a results file: ids trimmed, none dropped as repeated."""
    t = read_tsv(spark, path, with_pos=True)
    parts = F.array_remove(F.transform(F.split("matched_entity_ids", ","), lambda x: squeeze(x)), "")
    t = t.select(F.col("source1_entity_id").alias("s1_id"), parts.alias("predicted"), "_pos")
    return keep_first(t, "s1_id", last=True).drop("_pos")


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """(s1_id, candidate_id), from the long file or from the wide one with a list per row."""
    t = read_tsv(spark, path)
    if "s1_id" in t.columns:
        return t.select("s1_id", "candidate_id")
    return t.select(F.col("source1_entity_id").alias("s1_id"), F.explode(parse_id_list(F.col("candidate_entity_ids"))).alias("candidate_id"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct first fields of a file (``id``), without its header and blank lines."""
    t = _lines(spark, path)
    first = F.trim(F.get(F.split("value", "\t"), F.lit(0))).alias("id")
    header = t.select(F.min("pos").alias("p"))
    return t.join(F.broadcast(header), F.col("pos") == F.col("p"), "left_anti").where(F.trim("value") != "").select(first).distinct()


def write_tsv(df: DataFrame, path: str) -> None:
    """A folder of tab-separated parts; empty values are written as nothing at all."""
    df.write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "").option("quote", "\u0000").csv(path)


def write_lists(s1: DataFrame, pairs: DataFrame, path: str, column: str = "matched_entity_ids", unique: bool = False) -> None:
    """One row per first-source record, in the order of ``_pos`` if there is one, ids sorted and joined."""
    out = wide(s1, pairs, column, unique)
    out = out.orderBy("_pos").drop("_pos") if "_pos" in out.columns else out.orderBy("source1_entity_id")
    write_tsv(out, path)


def read_split_ids(spark: SparkSession, folder: str) -> DataFrame | None:
    """(s1_id, is_val) from the two files of a saved split; None unless both exist."""
    paths = {False: f"{folder}/split_train_ids.tsv", True: f"{folder}/split_val_ids.tsv"}
    if not all(_exists(spark, p) for p in paths.values()):
        return None
    one = StructType([StructField("s1_id", StringType())])
    read = lambda v: spark.read.schema(one).option("header", True).csv(paths[v]).withColumn("is_val", F.lit(v))
    return read(False).unionByName(read(True))
