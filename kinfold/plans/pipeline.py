"""The whole linkage run: sources to matches, metrics and checks; also the command line.

``python -m kinfold.plans.pipeline run|prepare|block|features|evaluate|validate ...``
"""

from __future__ import annotations

import argparse
import json
import os
import time
import uuid
from dataclasses import asdict, dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.operators import learn, metrics, pairs, sampling, validate
from kinfold.operators.blocking import candidate_recall, generate_candidates, reduction_ratio
from kinfold.operators.features import build_feature_matrix
from kinfold.sources import tsv


@dataclass
class Config:
    """Tunables. Any can be set by the environment as ``KINFOLD_<NAME>``; storage paths may be of any kind Spark reads."""

    data_dir: str = "data"
    processed_dir: str = "processed"
    output_dir: str = "output"
    lsh_enabled: bool = True
    lsh_threshold: float = 0.25
    skip_empty_keys: bool = False
    n_estimators: int = 60
    early_stopping: bool = True
    val_frac: float = 0.2
    seed: int = 42
    model: dict = field(default_factory=dict)


def load_config(path: str | None = None) -> Config:
    """Defaults, then the file (JSON, or YAML where a reader is installed), then the environment."""
    values: dict = {}
    if path and os.path.exists(path):
        with open(path) as f:
            text = f.read()
        try:
            values = json.loads(text)
        except ValueError:
            import yaml

            values = yaml.safe_load(text) or {}
    known = {f.name: f for f in fields(Config)}
    cfg = Config(**{k: v for k, v in values.items() if k in known})
    for name in known:
        given = os.environ.get(f"KINFOLD_{name.upper()}")
        if given is not None:
            kind = type(getattr(cfg, name))
            setattr(cfg, name, given.lower() in ("1", "true", "yes") if kind is bool else json.loads(given) if kind is dict else kind(given))
    return cfg


def prepare(spark: SparkSession, cfg: Config) -> dict:
    """Processes all splits, profiles them, and writes the true pairs and the split of the training ids."""
    report: dict = {}
    for split in ("train", "test"):
        if not tsv._exists(spark, f"{cfg.data_dir}/{split}/{split}_source1.tsv"):
            continue
        sources = tsv.load_split(spark, cfg.data_dir, split)
        for i, df in enumerate(sources, 1):
            tsv.write_processed(df, f"{cfg.processed_dir}/{split}_source{i}")
            df = spark.read.parquet(f"{cfg.processed_dir}/{split}_source{i}.parquet")
            report[f"{split}_source{i}"] = metrics.profile(df, f"{split}_source{i}").first().asDict()
            report[f"{split}_source{i}"]["countries"] = [tuple(r) for r in metrics.value_counts(df, "country_norm").collect()]
            report[f"{split}_source{i}"]["first_rows"] = [r.asDict() for r in metrics.preview(df, "entity_id", ("name_core", "addr_clean")).collect()]
            report[f"{split}_source{i}"]["legal_forms"] = [tuple(r) for r in metrics.value_counts(df, "name_legal_form", 8).collect()]
    truth_path = f"{cfg.data_dir}/train/train_ground_truth.tsv"
    if tsv._exists(spark, truth_path):
        s1, s2, s3 = tsv.load_split(spark, cfg.data_dir, "train", cfg.processed_dir)
        truth = tsv.read_truth(spark, truth_path).persist()
        true = pairs.truth_to_pairs(truth)
        split = sampling.split_ids(truth, cfg.val_frac, cfg.seed, sampling.strata_of(s1, truth)).persist()
        tsv.write_tsv(true, f"{cfg.processed_dir}/train_positive_pairs.tsv")
        for val, name in ((False, "train"), (True, "val")):
            tsv.write_tsv(split.where(F.col("is_val") == val).select("s1_id").orderBy("s1_id"), f"{cfg.processed_dir}/split_{name}_ids.tsv")
        held = truth.join(split.where("is_val").select("s1_id"), "s1_id", "left_semi")
        empty = held.select("s1_id").limit(0).select("s1_id", F.array().cast("array<string>").alias("predicted"))
        report["truth"] = {
            "entities": truth.count(), "pairs": true.count(), "singletons": truth.where(F.size("matches") == 0).count(),
            "orphans": pairs.orphans(true, s2.unionByName(s3)).count(), "f05_of_nothing": metrics.f05_macro(empty, held).first()["f05"],
            "matches_per_entity": {r[0]: r[1] for r in truth.groupBy(F.size("matches")).count().orderBy(F.size("matches")).collect()},
        }
    return report


def _matched(spark, cfg: Config, split: str) -> tuple[tuple[DataFrame, ...], DataFrame]:
    sources = tsv.load_split(spark, cfg.data_dir, split, cfg.processed_dir)
    for i, df in enumerate(sources, 1):
        path = f"{cfg.processed_dir}/{split}_source{i}.parquet"
        if not tsv._exists(spark, path):
            df.write.parquet(path)
    sources = tuple(spark.read.parquet(f"{cfg.processed_dir}/{split}_source{i}.parquet") for i in (1, 2, 3))
    found = generate_candidates(*sources, cfg.lsh_enabled, cfg.lsh_threshold, cfg.skip_empty_keys)
    path = f"{cfg.output_dir}/work/{split}_candidates"
    found.write.mode("overwrite").parquet(path)
    return sources, spark.read.parquet(path)


def _features(spark, cfg: Config, split: str, found: DataFrame, sources: tuple[DataFrame, ...]) -> DataFrame:
    path = f"{cfg.output_dir}/work/{split}_features"
    build_feature_matrix(found, *sources).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def run_pipeline(spark: SparkSession, cfg: Config) -> dict:
    """Trains on the training split, matches the test split if there is one, checks and reports."""
    began = time.time()
    sources, found = _matched(spark, cfg, "train")
    blocked = time.time() - began
    truth = tsv.read_truth(spark, f"{cfg.data_dir}/train/train_ground_truth.tsv").persist()
    true = pairs.truth_to_pairs(truth)
    recall = candidate_recall(found, true).first()["candidate_recall"]
    labelled = pairs.assign_labels(_features(spark, cfg, "train", found, sources), true)
    split = tsv.read_split_ids(spark, cfg.processed_dir)
    if split is None:
        split = sampling.split_ids(truth, cfg.val_frac, cfg.seed, sampling.strata_of(sources[0], truth))
    train, val = pairs.split_features(labelled, split.persist())
    fitted = learn.run_training(train, val, truth, f"{cfg.output_dir}/model", rounds=cfg.n_estimators, early_stop=cfg.early_stopping, seed=cfg.seed, **cfg.model)
    sizes = [s.count() for s in sources]
    n = found.count()
    out = fitted["metrics"] | {
        "candidate_recall": round(recall, 6), "positive_rate": round(metrics.positive_rate(labelled).first()["positive_rate"], 6), "block_time_s": round(blocked, 2), "num_candidate_pairs": n,
        "reduction_ratio": reduction_ratio(n, *sizes), "run_id": uuid.uuid4().hex,
    }
    if tsv._exists(spark, f"{cfg.data_dir}/test/test_source1.tsv") or tsv._exists(spark, f"{cfg.processed_dir}/test_source1.parquet"):
        tests, cands = _matched(spark, cfg, "test")
        scored = learn.score(fitted["model"], _features(spark, cfg, "test", cands, tests))
        hits = scored.where(F.col("score") >= fitted["threshold"]).select("s1_id", "candidate_id").persist()
        tsv.write_lists(tests[0], hits, f"{cfg.output_dir}/matching_results.tsv")
        tsv.write_lists(tests[0], cands, f"{cfg.output_dir}/candidate_pairs.tsv", "candidate_entity_ids", unique=True)
        checks = validate.validate_files(spark, f"{cfg.output_dir}/matching_results.tsv", f"{cfg.output_dir}/candidate_pairs.tsv", f"{cfg.data_dir}/test").collect()
        n_s1, with_hits = tests[0].count(), hits.select("s1_id").distinct().count()
        out |= {
            "num_test_candidate_pairs": cands.count(), "final_matches": hits.count(), "singletons": n_s1 - with_hits,
            "submission_valid": not any(c["severity"] == "error" for c in checks),
            "validation_errors": [f"{c['file']}: {c['rule']}" for c in checks if c["severity"] == "error"],
            "validation_warnings": [f"{c['file']}: {c['rule']}" for c in checks if c["severity"] != "error"],
        }
    out["total_runtime_s"] = round(time.time() - began, 2)
    row = spark.createDataFrame([(json.dumps(out), json.dumps(asdict(cfg)))], "metrics string, config string")
    row.write.mode("append").json(f"{cfg.output_dir}/runs")  # the record of all runs
    metrics.write_metrics(out, f"{cfg.output_dir}/metrics.json", spark)
    return out


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description=__doc__)
    sub = ap.add_subparsers(dest="what", required=True)
    for name in ("run", "prepare", "block", "features"):
        sub.add_parser(name).add_argument("--config", default=None)
    p = sub.add_parser("evaluate")
    p.add_argument("--results", default="output/matching_results.tsv")
    p.add_argument("--candidates", default=None)
    p.add_argument("--gt-path", default="data/train/train_ground_truth.tsv")
    p.add_argument("--metrics-json", default=None)
    p = sub.add_parser("validate")
    p.add_argument("--matching", default="output/matching_results.tsv")
    p.add_argument("--candidate", default=None)
    p.add_argument("--test-dir", default="data/test")
    p.add_argument("--check-ids", action="store_true")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("kinfold").getOrCreate()
    if a.what == "evaluate":
        if a.metrics_json:
            with open(a.metrics_json) as f:
                metrics.print_report(json.load(f))
            return 0
        truth = tsv.read_truth(spark, a.gt_path)
        recall = candidate_recall(tsv.read_candidates(spark, a.candidates), pairs.truth_to_pairs(truth)) if a.candidates else None
        metrics.print_report(metrics.full_report(tsv.read_predictions(spark, a.results), truth, recall).first().asDict())
        return 0
    if a.what == "validate":
        findings = validate.validate_files(spark, a.matching, a.candidate, a.test_dir, a.check_ids).collect()
        for f in findings:
            print(f"{f['severity']}: {f['file']}: {f['rule']}: {f['n']} {list(f['examples'])}")
        return int(any(f["severity"] == "error" for f in findings))
    cfg = load_config(a.config)
    if a.what == "prepare":
        print(json.dumps(prepare(spark, cfg), indent=2, default=str))
    elif a.what == "run":
        metrics.print_report(run_pipeline(spark, cfg))
    else:
        sources, found = _matched(spark, cfg, "train")
        if a.what == "features":
            _features(spark, cfg, "train", found, sources)
        else:
            tsv.write_tsv(found, f"{cfg.output_dir}/candidate_pairs_long.tsv")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
