"""Record views over the star-schema tables, in SQL that Spark and DuckDB both read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Parts as organisation records: a legal suffix or trade name by size, an address style by number.
PART = """
SELECT 'S' || CAST(1 + p_partkey % 3 AS STRING) || '-' || CAST(p_partkey AS STRING) AS entity_id,
       p_name || CASE p_size % 6 WHEN 0 THEN ' Inc' WHEN 1 THEN ' Pvt. Ltd.' WHEN 2 THEN ' LLC' WHEN 3 THEN ' & Co.'
                 WHEN 4 THEN ' dba ' || p_type || ' House' ELSE ' Limited' END AS business_name,
       CAST(p_partkey % 900 + 1 AS STRING) || CASE p_partkey % 5 WHEN 0 THEN ' Main St, Springfield, IL 62704'
                 WHEN 1 THEN ' MG Road, Near SBI ATM, Bombay 400001' WHEN 2 THEN ' Rue de la Paix, 75001 Paris'
                 WHEN 3 THEN ' 5th Ave, New York' ELSE '' END AS business_address,
       CASE p_partkey % 7 % 3 WHEN 0 THEN 'USA' WHEN 1 THEN 'India' ELSE 'Utopia' END AS country,
       p_partkey, p_name, p_brand, p_type, p_size
FROM part
"""

#: Documents as records: the whole text as name.
DOC = """
SELECT 'S' || CAST(1 + doc_id % 3 AS STRING) || '-' || CAST(doc_id AS STRING) AS entity_id,
       text AS business_name, '' AS business_address, lang AS country, doc_id, text, lang, n_chars
FROM documents
"""


def view(spark: SparkSession, sf_dir: str, sql: str, *tables: str) -> DataFrame:
    """The query over the named Parquet tables, without temporary views in the session's catalogue."""
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables}
    for t in tables:
        sql = sql.replace(f"FROM {t}", "FROM {" + t + "}")
    return spark.sql(sql, **frames)


def spread(df: DataFrame) -> DataFrame:
    """A scanned table of fewer partitions than cores (one small file) dealt out; a larger one as it is, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def ent_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(view(spark, sf_dir, PART, "part"))


def ent_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, DOC, "documents")


def of_source(df: DataFrame, *sources: int) -> DataFrame:
    """Rows of the given sources."""
    return df.where(df.entity_id.substr(1, 2).isin([f"S{s}" for s in sources]))
