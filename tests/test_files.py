"""Readers, writers, checks, the whole run, and the streamed blocking."""

import json
import os

import pytest

from kinfold.operators import metrics, validate
from kinfold.operators.blocking import block_union
from kinfold.operators.normalize import preprocess_source
from kinfold.plans import pipeline
from kinfold.sources import tsv
from kinfold.streaming.blocking import distinct_sink, stream_candidates, target_index

HEAD = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    path.write_text(text, encoding="utf-8") if hasattr(path, "write_text") else open(path, "w", encoding="utf-8").write(text)
    return str(path)


def test_read_tsv(spark, tmp_path):
    text = '﻿entity_id \tbusiness_name\tbusiness_address\tcountry\nS1-1\t"Quo te, Inc\t a \tUS\nS1-2\tNA\tnull\nS1-3\ta\tb\tc\td\n\nS1-4\t\t\t\n'
    rows = [tuple(r) for r in tsv.read_tsv(spark, put(tmp_path / "a.tsv", text)).collect()]
    assert rows == [("S1-1", '"Quo te, Inc', "a", "US"), ("S1-2", "NA", "null", ""), ("S1-4", "", "", "")]
    with pytest.raises(ValueError, match="tab-separated"):
        tsv.read_tsv(spark, put(tmp_path / "b.tsv", "a,b\n1,2\n"))


def test_only_the_first_line_is_the_header(spark, tmp_path):
    path = put(tmp_path / "h" / "a.tsv", HEAD + "S1-1\ta\tb\tc\n" + HEAD + "S1-2\ta\tb\tc\td\n")
    assert sorted(r.entity_id for r in tsv.read_tsv(spark, path).collect()) == ["S1-1", "entity_id"]
    assert tsv.long_rows(spark, path) == 1
    put(tmp_path / "h" / "b.tsv", HEAD + "S1-3\t\t\t\n")
    assert sorted(r.entity_id for r in tsv.read_tsv(spark, str(tmp_path / "h")).collect()) == ["S1-1", "S1-3", "entity_id"]


def test_check_source(spark, tmp_path):
    path = put(tmp_path / "a.tsv", HEAD + "S1-1\tfirst\t\t\nS1-1\tsecond\t\t\nX-1\tz\t\t\n")
    with pytest.warns(UserWarning):
        out = tsv.check_source(tsv.read_tsv(spark, path, with_pos=True), "S1-", "a")
    assert {(r.entity_id, r.business_name) for r in out.collect()} == {("S1-1", "first"), ("X-1", "z")}
    with pytest.raises(ValueError, match="missing columns"):
        tsv.check_source(spark.createDataFrame([("a",)], "entity_id string"), "S1-", "b")


def test_truth_and_predictions(spark, tmp_path):
    path = put(tmp_path / "t.tsv", "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S2-1\nS1-2\t\nS1-1\tS3-1, S2-2 ,\n")
    assert {r.s1_id: r.matches for r in tsv.read_truth(spark, path).collect()} == {"S1-1": ["S3-1", "S2-2"], "S1-2": []}
    path = put(tmp_path / "p.tsv", "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1, S2-1\n")
    assert tsv.read_predictions(spark, path).first().predicted == ["S2-1", "S2-1"]
    short = put(tmp_path / "s.tsv", "source1_entity_id\tother\nS1-1\t\n")
    assert tsv.read_truth(spark, short).first().matches == []


def test_lists_sink(spark, tmp_path):
    s1 = spark.createDataFrame([("S1-2", 0), ("S1-1", 1), ("S1-3", 2)], "entity_id string, _pos int")
    pairs = spark.createDataFrame([("S1-1", "S3-1"), ("S1-1", "S2-1"), ("S1-1", "S2-1")], "s1_id string, candidate_id string")
    for unique, want in ((False, "S2-1,S2-1,S3-1"), (True, "S2-1,S3-1")):
        tsv.write_lists(s1, pairs, str(tmp_path / "out"), unique=unique)
        lines = [x for f in sorted((tmp_path / "out").glob("part-*.csv")) for x in f.read_text().splitlines()]
        assert [x for x in lines if not x.startswith("source1")] == ["S1-2\t", f"S1-1\t{want}", "S1-3\t"]


def faults(spark, tmp_path, body, header="source1_entity_id\tmatched_entity_ids\n", **more):
    d = tmp_path / "test"
    put(d / "test_source1.tsv", HEAD + "S1-1\t\t\t\nS1-2\t\t\t\n")
    out = validate.validate_files(spark, put(tmp_path / "m.tsv", header + body), None, str(d), **more)
    return {r.rule: list(r.examples) for r in out.collect() if r.severity == "error"}


@pytest.mark.parametrize(
    ("body", "rule", "examples"),
    [
        ("S1-1\tS2-1\nS1-2\t\n", None, None),
        ("S1-1\t\nS1-1\t\nS1-2\t\n", "duplicate_row", ["S1-1"]),
        ("S1-1\tS2-1,S2-1\nS1-2\t\n", "repeated_id", ["S1-1"]),
        ("S1-1\tS1-2\nS1-2\t\n", "self_match", ["S1-2"]),
        ("S1-1\tQ1\nS1-2\t\n", "wrong_prefix", ["Q1"]),
        ("S1-1\tS2-1\n", "missing_row", ["S1-2"]),
        ("S1-1\t\nS1-2\t\nS1-9\t\n", "unknown_row", ["S1-9"]),
        ("S1-1\t\nS1-2\t\nnonsense\n", "malformed_row", ["nonsense"]),
    ],
)
def test_rules(spark, tmp_path, body, rule, examples):
    assert faults(spark, tmp_path, body) == ({rule: examples} if rule else {})


def test_bytes_that_are_no_text_and_line_numbers(spark, tmp_path):
    d = tmp_path / "test"
    put(d / "test_source1.tsv", HEAD + "S1-1\t\t\t\nS1-2\t\t\t\n")
    (tmp_path / "m.tsv").write_bytes(b"source1_entity_id\tmatched_entity_ids\nS1-1\t\nS1-2\t\nodd\nS1-2\xff\t\nbad\n")
    out = {r.rule: (r.severity, list(r.examples)) for r in validate.validate_files(spark, str(tmp_path / "m.tsv"), None, str(d)).collect()}
    assert out["not_utf8"] == ("error", [b"S1-2\xff\t".hex().upper()])
    assert out["malformed_at"] == ("warning", ["line 4: odd", "line 6: bad"])


def test_headers_and_missing_files(spark, tmp_path):
    assert list(faults(spark, tmp_path, "", header="source1_entity_id,matched_entity_ids\n").values()) == [["comma-separated"]]
    assert list(faults(spark, tmp_path, "", header="a\tb\n")) == ["header"]
    assert list(faults(spark, tmp_path, "", header="")) == ["header"]
    gone = validate.validate_files(spark, str(tmp_path / "none"), str(tmp_path / "no"), str(tmp_path / "test")).collect()
    assert {(r.rule, r.severity) for r in gone} >= {("file_missing", "error"), ("file_missing", "warning")}


def test_known_ids_and_candidates(spark, tmp_path):
    d = tmp_path / "test"
    put(d / "test_source2.tsv", HEAD + "S2-1\t\t\t\n")
    put(d / "test_source3.tsv", HEAD)
    assert faults(spark, tmp_path, "S1-1\tS2-1,S3-7\nS1-2\t\n", check_ids=True) == {"unknown_id": ["S3-7"]}
    c = put(tmp_path / "c.tsv", "source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-1\nS1-2\t\n")
    out = validate.validate_files(spark, str(tmp_path / "m.tsv"), c, str(d)).collect()
    assert [list(r.examples) for r in out if r.rule == "outside_candidates"] == [["S1-1"]]


def write_data(root):
    for split in ("train", "test"):
        for i in (1, 2, 3):
            rows = [f"S{i}-{k}\t{'Acme Bolt Cargo Delta Eagle'.split()[k % 5]} Works {k} Ltd\t{k} Main St, Town {k}, NY 1{k:04}\tUS" for k in range(40)]
            put(root / split / f"{split}_source{i}.tsv", HEAD + "\n".join(rows) + "\n")
    put(root / "train" / "train_ground_truth.tsv", "source1_entity_id\tmatched_entity_ids\n" + "".join(f"S1-{k}\t{f'S2-{k},S3-{k}' if k % 4 else ''}\n" for k in range(40)))


def test_whole_run(spark, tmp_path):
    write_data(tmp_path / "data")
    (tmp_path / "out").mkdir()
    cfg = pipeline.Config(str(tmp_path / "data"), str(tmp_path / "proc"), str(tmp_path / "out"), lsh_enabled=False, n_estimators=3, model={"depth": 2})
    report = pipeline.prepare(spark, cfg)
    assert report["truth"]["singletons"] == 10 and report["train_source1"]["n_rows"] == 40
    out = pipeline.run_pipeline(spark, cfg)
    assert out["submission_valid"] and out["candidate_recall"] == 1.0 and out["singletons"] + 0 >= 0
    assert json.load(open(tmp_path / "out" / "metrics.json"))["run_id"] == out["run_id"]
    again = tsv.read_predictions(spark, str(tmp_path / "out" / "matching_results.tsv"))
    assert again.count() == 40


def test_reports(spark, tmp_path, capsys):
    found = {"f05": 0.123456789, "n_s1_entities": 3, "top_features": {"a": 1.0, "b": 2.5}}
    metrics.print_report(found)
    assert capsys.readouterr().out.splitlines() == ["          f05 = 0.123457", "n s1 entities = 3", "#1 b (2.5)", "#2 a (1)"]
    for where in (None, spark):
        metrics.write_metrics(found, str(tmp_path / "m.json"), where)
        assert json.load(open(tmp_path / "m.json")) == found


def test_config(tmp_path, monkeypatch):
    path = put(tmp_path / "c.json", json.dumps({"val_frac": 0.3, "unknown": 1}))
    monkeypatch.setenv("KINFOLD_SEED", "7")
    monkeypatch.setenv("KINFOLD_LSH_ENABLED", "false")
    cfg = pipeline.load_config(path)
    assert (cfg.val_frac, cfg.seed, cfg.lsh_enabled, cfg.n_estimators) == (0.3, 7, False, 60)


def test_streamed_blocking(spark, tmp_path):
    schema = "entity_id string, business_name string, business_address string, country string"
    targets = preprocess_source(spark.createDataFrame([("S2-1", "Acme Corp", "1 Main St, Town, NY 10001", "US"), ("S2-2", "Zed", "", "FR")], schema))
    news = [("S1-1", "Acme Corporation", "1 Main Street, Town 10001", "US")]
    spark.createDataFrame(news, schema).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    q = stream_candidates(stream, target_index(targets)).writeStream.foreachBatch(distinct_sink(str(tmp_path / "out")))
    q = q.option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {(r.s1_id, r.candidate_id) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    static = preprocess_source(spark.createDataFrame(news, schema))
    assert got == {tuple(r) for r in block_union(static, targets).collect()} == {("S1-1", "S2-1")}
