"""Streamed blocking: new records of the first source against a static index of targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.operators.blocking import KEYS, keyed
from kinfold.operators.normalize import preprocess_source


def target_index(targets: DataFrame, keys: dict[str, int] = KEYS) -> DataFrame:
    """(kind, key, candidate_id) of processed targets; write it bucketed by kind and key for reuse."""
    return keyed(targets, keys).withColumnRenamed("entity_id", "candidate_id")


def stream_candidates(records: DataFrame, index: DataFrame, keys: dict[str, int] = KEYS) -> DataFrame:
    """Candidates of a stream of raw records: a stream-static join without state.

    A pair that meets under several keys comes once for each; ``distinct_sink`` keeps one.
    """
    t = keyed(preprocess_source(records), keys).withColumnRenamed("entity_id", "s1_id")
    return t.join(index, ["kind", "key"]).select("s1_id", "candidate_id", F.substring_index("candidate_id", "-", 1).alias("candidate_source"))


def distinct_sink(path: str):
    """For ``foreachBatch``: each micro-batch's distinct pairs, under a folder of its number, so a retry overwrites itself."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.distinct().write.mode("overwrite").parquet(f"{path}/batch={epoch}")

    return write
