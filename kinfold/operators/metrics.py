"""Scores of matchings: macro F0.5, threshold sweep, reports, profiles."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

STEPS = 91


def f05(p: Column, r: Column) -> Column:
    """F0.5 of precision and recall; 0 where both are 0."""
    return F.when(p + r == 0, 0.0).otherwise(1.25 * p * r / (0.25 * p + r))


def entity_scores(pred: DataFrame, truth: DataFrame) -> DataFrame:
    """(s1_id, f05, precision, recall) per entity of the truth; lists are compared as sets.

    ``pred`` (s1_id, predicted) and ``truth`` (s1_id, matches). Without true matches an
    empty prediction scores 1 and any other 0, with recall 1 either way.
    """
    t = truth.join(pred, "s1_id", "left")
    p, m = (F.array_distinct(F.coalesce(c, F.array().cast("array<string>"))) for c in ("predicted", "matches"))
    t = t.select("s1_id", F.size(p).alias("np"), F.size(m).alias("nt"), F.size(F.array_intersect(p, m)).alias("tp"))
    single, none = F.col("nt") == 0, F.col("np") == 0
    prec, rec = F.col("tp") / F.greatest("np", F.lit(1)), F.col("tp") / F.greatest("nt", F.lit(1))
    alone = none.cast("double")
    return t.select(
        "s1_id", F.when(single, alone).otherwise(f05(prec, rec)).alias("f05"),
        F.when(single, alone).otherwise(prec).alias("precision"), F.when(single, 1.0).otherwise(rec).alias("recall"),
    )


def macro_f05(pred: DataFrame, truth: DataFrame) -> DataFrame:
    """One row of means rounded half to even to 6 digits; null without entities."""
    s = entity_scores(pred, truth)
    return s.agg(*[F.bround(F.avg(c), 6).alias(c) for c in ("f05", "precision", "recall")])


def f05_macro(pred: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: the mean F0.5, not rounded; 0 without entities."""
    return entity_scores(pred, truth).agg(F.coalesce(F.avg("f05"), F.lit(0.0)).alias("f05"))


def thresholds(spark: SparkSession, low: float = 0.05, high: float = 0.95, steps: int = STEPS) -> DataFrame:
    """(k, t): evenly spaced thresholds, ends included."""
    t = F.when(F.col("id") == steps - 1, F.lit(high)).otherwise(F.lit(low) + F.col("id") * F.lit((high - low) / (steps - 1)))
    return spark.range(steps).select(F.col("id").cast("int").alias("k"), t.alias("t"))


def sweep(scored: DataFrame, low: float = 0.05, high: float = 0.95, steps: int = STEPS) -> DataFrame:
    """(k, t, tp, fp, fn, precision, recall, f05) of each threshold with a positive prediction.

    Scores are first counted by the last threshold they reach, then summed from above:
    one pass over the scores, whatever the number of thresholds.
    """
    spark = scored.sparkSession
    ts = thresholds(spark, low, high, steps)
    step = (high - low) / (steps - 1)
    at = lambda k: F.when(k >= steps - 1, F.lit(high)).otherwise(F.lit(low) + k * F.lit(step))
    guess = F.floor((F.col("score") - low) / step).cast("int")
    # rounding can put the guess one off; compare with the thresholds themselves
    k = F.when(F.col("score") >= at(guess + 1), guess + 1).when(F.col("score") >= at(guess), guess).otherwise(guess - 1)
    counted = scored.select(F.least(F.greatest(k, F.lit(-1)), F.lit(steps - 1)).alias("k"), "label").groupBy("k").agg(
        F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg")
    )
    all_k = ts.select("k", "t").unionByName(spark.range(1).select(F.lit(-1).alias("k"), F.lit(None).cast("double").alias("t")))
    t = all_k.join(counted, "k", "left").na.fill(0, ["pos", "neg"])  # steps + 1 rows
    above = Window.orderBy(F.col("k").desc()).rowsBetween(Window.unboundedPreceding, 0)
    t = t.select("k", "t", F.sum("pos").over(above).alias("tp"), F.sum("neg").over(above).alias("fp"), F.sum("pos").over(Window.partitionBy()).alias("all"))
    t = t.where("k >= 0 and tp + fp > 0").select("k", "t", "tp", "fp", (F.col("all") - F.col("tp")).alias("fn"))
    t = t.select("*", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                 F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0).alias("recall"))
    return t.select("*", f05(F.col("precision"), F.col("recall")).alias("f05"))


def best_threshold(swept: DataFrame) -> DataFrame:
    """One row (threshold, f05): the best, the lowest of equals; 0.5 and 0 where none scores."""
    best = swept.where("f05 > 0").orderBy(F.col("f05").desc(), "t").limit(1).select(F.col("t").alias("threshold"), "f05")
    return best.agg(F.coalesce(F.max("threshold"), F.lit(0.5)).alias("threshold"), F.coalesce(F.max("f05"), F.lit(0.0)).alias("f05"))


def full_report(pred: DataFrame, truth: DataFrame, recall: DataFrame | None = None) -> DataFrame:
    """One row: macro scores, counts, share of entities without matches, candidate recall if given."""
    out = macro_f05(pred, truth)
    counts = truth.agg(
        F.count(F.lit(1)).alias("n_s1_entities"), F.coalesce(F.sum(F.size("matches")), F.lit(0)).alias("n_true_matches"),
        F.bround(F.sum((F.size("matches") == 0).cast("int")) / F.greatest(F.count(F.lit(1)), F.lit(1)), 4).alias("singleton_frac"),
    )
    made = pred.agg(F.coalesce(F.sum(F.size("predicted")), F.lit(0)).alias("n_predicted_matches"))
    out = out.crossJoin(counts).crossJoin(made)  # one row each
    return out.crossJoin(recall.select(F.bround("candidate_recall", 6).alias("candidate_recall"))) if recall is not None else out


def report_lines(metrics: dict) -> list[str]:
    """One line a value, names aligned; real numbers to six digits. Features follow by rank, the most important first."""
    plain = {k.replace("_", " "): f"{v:.6g}" if isinstance(v, float) else str(v) for k, v in metrics.items() if not isinstance(v, dict)}
    left = max(map(len, plain), default=0)
    lines = [f"{k:>{left}} = {v}" for k, v in plain.items()]
    ranked = sorted(metrics.get("top_features", {}).items(), key=lambda kv: (-kv[1], kv[0]))
    return lines + [f"#{k} {name} ({weight:.4g})" for k, (name, weight) in enumerate(ranked, 1)]


def print_report(metrics: dict) -> None:
    print("\n".join(report_lines(metrics)))


def write_metrics(metrics: dict, path: str, spark: SparkSession | None = None) -> None:
    """The metrics as one JSON file, on any file system that the session reaches."""
    text = json.dumps(metrics, indent=2)
    if spark is None:
        with open(path, "w") as f:
            f.write(text)
        return
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    out.write(bytearray(text.encode()))
    out.close()


def positive_rate(labelled: DataFrame) -> DataFrame:
    """One row: the share of label 1; 0 without rows."""
    return labelled.agg(F.coalesce(F.avg("label"), F.lit(0.0)).alias("positive_rate"))


def preview(df: DataFrame, key: str, columns: tuple[str, ...], rows: int = 5) -> DataFrame:
    """The rows with the least keys, for a report."""
    return df.orderBy(key).limit(rows).select(key, *columns)


def profile(df: DataFrame, name: str) -> DataFrame:
    """One row of counts and shares of a processed source."""
    share = lambda c: F.avg((F.col(c) != "").cast("int"))
    return df.agg(
        F.lit(name).alias("name"), F.count(F.lit(1)).alias("n_rows"),
        F.sum((F.col("business_name") == "").cast("int")).alias("empty_names"),
        F.sum((F.col("business_address") == "").cast("int")).alias("empty_addresses"),
        share("addr_postcode").alias("postcode_share"), share("addr_landmark").alias("landmark_share"), share("name_dba").alias("trade_name_share"),
    )


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """(value, count), most frequent first, ties by value; the first ``top`` if given."""
    t = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "value")
    return t.limit(top) if top else t
