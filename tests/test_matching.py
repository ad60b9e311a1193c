"""Similarities, features, candidates, metrics, splits and learning."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold.functions import similarity as sim
from kinfold.operators import blocking, features, learn, metrics, normalize, pairs, sampling
from kinfold.operators.normalize import preprocess_source
from kinfold.plans.queries import QUERIES
from kinfold.plans.views import of_source

SCHEMA = "entity_id string, business_name string, business_address string, country string"
ROWS = [
    ("S1-001", "Acme Corp", "123 Main St, NY 10001", "US"),
    ("S1-002", "Sharma Enterprises", "Plot 12, Chandigarh 160017", "India"),
    ("S2-001", "Acme Corporation", "123 Main Street, New York 10001", "US"),
    ("S2-002", "Totally Different Biz", "99 Other Rd, Chicago", "US"),
    ("S3-001", "Sharma Enterprises Pvt Ltd", "Plot 12, Sec 17, Chandigarh 160017", "India"),
]


@pytest.fixture(scope="module")
def processed(spark):
    return preprocess_source(spark.createDataFrame(ROWS, SCHEMA)).persist()


def found(df):
    return {tuple(r) for r in df.select("s1_id", "candidate_id").collect()}


def test_lcs_against_table():
    rng = random.Random(1)
    for _ in range(400):
        a, b = ("".join(rng.choices("abcd ", k=rng.randrange(12))) for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert sim.lcs_length(a, b) == t[-1][-1]


def test_fuzzy_cases():
    assert sim.token_set("acme corp", "corp acme") == 1 and sim.token_set("", "x") == 0
    assert sim.token_set("alpha", "zzz") < 0.5
    assert sim.token_set("new york mets", "new york mets vs braves") == 1
    assert sim.token_sort("b a", "a b") == 1 and sim.ratio("", "") == 1
    assert sim.partial("abc", "xxabcxx") == 1 and sim.partial("", "") == 1 and sim.partial("", "a") == 0
    assert sim.jaro_winkler("martha", "marhta") == pytest.approx(0.9611111)
    assert sim.jaro_winkler("", "") == 1 and sim.jaro_winkler("a", "") == 0


def test_fuzzy_from_sql(spark):
    sim.register(spark)
    assert spark.sql("select similarity_token_sort('b a', 'a b')").first()[0] == 1


def test_native_similarities(spark):
    df = spark.createDataFrame([("a b", "b c", "12 x 7", "7 9"), ("", "", "x", "1")], "a string, b string, n string, m string")
    out = df.select(
        sim.set_jaccard(F.col("a"), F.col("b")), sim.levenshtein_norm(F.col("a"), F.col("b")), sim.number_overlap(F.col("n"), F.col("m")),
        sim.exact(F.col("a"), F.col("b")), sim.both_empty(F.col("a"), F.col("b")),
    ).collect()
    assert [tuple(r) for r in out] == [(1 / 3, pytest.approx(1 / 3), 0.5, 0.0, 0), (1.0, 1.0, 1.0, 0.0, 1)]


def test_blocks(processed):
    a, b = of_source(processed, 1), of_source(processed, 2, 3)
    post = found(blocking.exact_block(a, b, "bk_country_postcode", 3))
    assert ("S1-001", "S2-001") in post and ("S1-001", "S3-001") not in post
    assert found(blocking.exact_block(a, b, "bk_country_postcode", 100)) == set()


@pytest.mark.parametrize("lsh", [False, True])
def test_candidates(processed, lsh):
    out = blocking.generate_candidates(of_source(processed, 1), of_source(processed, 2), of_source(processed, 3), lsh)
    rows = out.collect()
    assert {r.candidate_source for r in rows} <= {"S2", "S3"} and len(rows) == len(set(rows))
    assert {("S1-001", "S2-001"), ("S1-002", "S3-001")} <= found(out)


def test_minhash_formula(spark):
    import hashlib

    texts = ["", "a", "acmecorp", "éclair"]
    got = spark.createDataFrame([(t,) for t in texts], "s string").select(blocking.minhash(F.col("s"))).collect()
    for t, r in zip(texts, got, strict=True):
        p = f"  {t}  "
        grams = {p[i : i + 3] for i in range(len(p) - 2)} if t else {""}
        hs = [int(hashlib.md5(g.encode()).hexdigest()[:8], 16) for g in grams]
        assert r[0] == [min(h ^ (i * 2654435761 % 2**32) for h in hs) for i in range(128)]


def test_bands_must_divide(spark):
    with pytest.raises(ValueError, match="do not divide"):
        blocking.bands(spark.createDataFrame([("x", [1])], "entity_id string, sig array<bigint>"), 128, 10)


def test_lsh_cap_keeps_the_first(spark):
    e = spark.createDataFrame([("S1-1", "same name"), *[(f"S2-{i:02}", "same name") for i in range(9)]], "entity_id string, name_nospace string").coalesce(1)
    out = blocking.lsh_block(of_source(e, 1), of_source(e, 2), cap=4)
    assert found(out) == {("S1-1", f"S2-{i:02}") for i in range(4)}
    assert blocking.lsh_block(of_source(e, 1), of_source(e, 2), cap=None).count() == 9


def test_features(spark, processed):
    ids = spark.createDataFrame([("S1-001", "S2-001"), ("S1-002", "S3-001"), ("S1-001", "S9-9")], "s1_id string, candidate_id string")
    out = features.build_feature_matrix(ids, of_source(processed, 1), of_source(processed, 2), of_source(processed, 3))
    assert len(out.columns) == 44 and out.columns[:2] == ["s1_id", "candidate_id"]
    rows = {r.s1_id: r.asDict() for r in out.collect()}
    assert set(rows) == {"S1-001", "S1-002"}  # a pair with an unknown side goes
    assert all(0 <= v <= 1 for r in rows.values() for k, v in r.items() if k not in ("s1_id", "candidate_id"))
    a = rows["S1-001"]
    assert a["name_tok_set"] == a["name_sorted_exact"] == a["same_country"] == a["addr_postcode_exact"] == 1
    assert a["name_addr_max"] == 1 and a["name_addr_mean"] == pytest.approx((1 + a["addr_tok_set"]) / 2)
    assert rows["S1-002"]["legal_form_exact"] == 0 and rows["S1-002"]["legal_form_both_empty"] == 0


def test_third_source_wins(spark, processed):
    s2 = of_source(processed, 2)
    s3 = s2.where("entity_id = 'S2-001'").withColumn("name_clean", F.lit("other"))
    assert {r.name_clean for r in features.keep_last_target(s2, s3).where("entity_id = 'S2-001'").collect()} == {"other"}


def lists(spark, d, name):
    return spark.createDataFrame(list(d.items()) or [("-", [])], f"s1_id string, {name} array<string>").where("s1_id <> '-'")


@pytest.mark.parametrize(
    ("pred", "truth", "want"),
    [
        ({"a": ["x", "y"]}, {"a": ["x", "y"]}, 1.0),
        ({"a": ["z"]}, {"a": ["x"]}, 0.0),
        ({}, {"a": []}, 1.0),
        ({"a": ["x"]}, {"a": []}, 0.0),
        ({"a": ["x"]}, {"a": ["x", "y"]}, 1.25 * 0.5 / (0.25 + 0.5)),
        ({"a": ["x", "x"], "b": ["q"]}, {"a": ["x"]}, 1.0),  # repeats and unknown ids do not count
        ({}, {}, 0.0),
    ],
)
def test_macro(spark, pred, truth, want):
    assert metrics.f05_macro(lists(spark, pred, "predicted"), lists(spark, truth, "matches")).first()[0] == pytest.approx(want)


def test_sweep_against_counting(spark):
    rng = random.Random(3)
    ts = [0.05 + i * ((0.95 - 0.05) / 90) for i in range(90)] + [0.95]
    rows = [(rng.choice([rng.random(), rng.choice(ts)]), rng.randrange(2)) for _ in range(300)]
    got = {r.k: r for r in metrics.sweep(spark.createDataFrame(rows, "score double, label int")).collect()}
    for k, t in enumerate(ts):
        tp, fp = sum(y for s, y in rows if s >= t), sum(1 - y for s, y in rows if s >= t)
        assert (got[k].tp, got[k].fp) == (tp, fp) if tp + fp else k not in got


def test_best_threshold(spark):
    rows = [(0.5, 1), (0.5, 1), (0.2, 0)]
    best = metrics.best_threshold(metrics.sweep(spark.createDataFrame(rows, "score double, label int"))).first()
    assert best.f05 == 1 and 0.2 < best.threshold < 0.22  # the lowest of equals
    none = metrics.best_threshold(metrics.sweep(spark.createDataFrame([(0.5, 0)], "score double, label int"))).first()
    assert tuple(none) == (0.5, 0.0)
    low = metrics.best_threshold(metrics.sweep(spark.createDataFrame([(0.01, 1)], "score double, label int"))).first()
    assert tuple(low) == (0.5, 0.0)


def test_recall(spark):
    c = spark.createDataFrame([("a", "x")], "s1_id string, candidate_id string")
    t = lambda *r: spark.createDataFrame([*r, ("-", "-")], "s1_id string, match_id string").where("s1_id <> '-'")
    value = lambda *r: blocking.candidate_recall(c, t(*r)).first()["candidate_recall"]
    assert (value(("a", "x")), value(("a", "y")), value()) == (1.0, 0.0, 1.0)


def test_split_sizes(spark):
    sizes = {2: 0, 3: 1, 7: 1, 8: 2, 12: 2, 13: 3}
    rows = [(f"{n}-{i}", str(n)) for n in sizes for i in range(n)]
    strata = spark.createDataFrame(rows, "s1_id string, stratum string")
    extra = strata.select("s1_id").unionByName(spark.createDataFrame([("lone",)], "s1_id string"))
    out = sampling.split_ids(extra, 0.2, 42, strata)
    got = {r.stratum: r.n for r in out.groupBy("stratum").agg(F.sum(F.col("is_val").cast("int")).alias("n")).collect()}
    assert got == {**{str(n): k for n, k in sizes.items()}, "na": 0}
    again = sampling.split_ids(extra.repartition(3), 0.2, 42, strata)
    assert out.orderBy("s1_id").collect() == again.orderBy("s1_id").collect()


def test_learning(spark):
    rng = random.Random(5)
    rows = [(f"S1-{i}", f"S2-{i}", rng.random(), rng.random()) for i in range(300)]
    df = spark.createDataFrame([(*r, int(r[2] > 0.6)) for r in rows], "s1_id string, candidate_id string, f1 double, f2 double, label int")
    train, val = df.where("cast(substring(s1_id, 4) as int) % 4 > 0"), df.where("cast(substring(s1_id, 4) as int) % 4 = 0")
    truth = val.select("s1_id", F.when(F.col("label") == 1, F.array("candidate_id")).otherwise(F.array().cast("array<string>")).alias("matches"))
    out = learn.run_training(train, val, truth, rounds=5, depth=2)
    assert out["metrics"]["f05"] > 0.9 and list(out["metrics"]["top_features"])[0] == "f1"
    assert learn.predict(out["model"], val, 2.0).count() == 0


def test_labels_and_lists(spark):
    f = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "s1_id string, candidate_id string")
    true = pairs.truth_to_pairs(lists(spark, {"a": ["x"]}, "matches"))
    assert {tuple(r) for r in pairs.assign_labels(f, true).select("s1_id", "candidate_id", "label").collect()} == {("a", "x", 1), ("a", "y", 0), ("b", "x", 0)}
    s1 = spark.createDataFrame([("a",), ("b",), ("c",)], "entity_id string")
    twice = f.unionByName(f)
    w = {r[0]: r[1] for r in pairs.wide(s1, twice, "ids", unique=True).collect()}
    assert w == {"a": "x,y", "b": "x", "c": ""}
    assert {r[0]: r[1] for r in pairs.wide(s1, twice, "ids").collect()}["b"] == "x,x"


def _documents(spark, folder):
    """Four texts: 1 begins like 2 and is like 3 but for the opening; 4 is 3's words in another order and case."""
    tail = " ".join(f"word{i} of {i * i}" for i in range(60))
    opening = "the very same opening of forty characters "
    rows = [(3, opening + tail), (1, opening + "and nothing in common: " + "zq xk jv " * 60), (4, "another first line " + tail), (7, " ".join(reversed(("another FIRST line " + tail).split())))]
    table = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    table.write.parquet(f"{folder}/documents.parquet")
    return {("S%d-%d" % (1 + i % 3, i)): t for i, t in rows}


def test_whole_texts_are_compared(spark, tmp_path):
    texts = _documents(spark, tmp_path)
    grams = {k: {f"  {t}  "[i : i + 3] for i in range(len(t) + 2)} for k, t in texts.items()}
    near = lambda a, b: len(grams[a] & grams[b]) / len(grams[a] | grams[b])
    assert near("S1-3", "S2-4") > 0.8 > 0.2 > near("S1-3", "S2-1")
    for name in ("lsh_candidates", "lsh_candidates_capped"):
        found = {(r[0], r[1]) for r in QUERIES[name](spark, str(tmp_path)).collect()}
        assert ("S1-3", "S2-4") in found and ("S1-3", "S2-1") not in found, name
    slots = [(i * 2654435761) & 0xFFFFFFFF for i in range(128)]
    for r in QUERIES["minhash_signature"](spark, str(tmp_path)).collect():
        hashes = [int(hashlib.md5(g.encode()).hexdigest()[:8], 16) for g in grams[r["entity_id"]]]
        assert r["signature"] == ",".join(str(min(h ^ x for h in hashes)) for x in slots)
    assert QUERIES["lsh_bands"](spark, str(tmp_path)).count() == 4 * 16


def test_whole_text_keys(spark, tmp_path):
    tail = " ".join(f"w{i}" for i in range(50))
    rows = [(3, f"a start {tail}"), (1, f"a start {tail} and more"), (4, f"{tail} A start"), (2, f"a start {tail}")]
    table = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    run = lambda name: sorted(tuple(r) for r in QUERIES[name](spark, str(tmp_path)).collect())
    assert run("label_join") == [("S1-3", "S2-4", 0), ("S1-3", "S3-2", 1)]
    assert set(run("parse_lists")) == {("S1-3", "S2-4"), ("S1-3", "S3-2")}
    assert run("results_wide") == [("S1-3", "S2-4,S3-2")]
    assert run("candidate_recall") == [(1, 1, 1.0)] and run("reduction_ratio") == [(round(1 - 2 / 3, 6),)]
    assert [r["precision"] for r in QUERIES["macro_f05"](spark, str(tmp_path)).collect()] == [0.5]
    assert [r["n_predicted_matches"] for r in QUERIES["full_report"](spark, str(tmp_path)).collect()] == [2]


@pytest.mark.parametrize("by", ["md5", "hash"])
def test_split_against_a_plain_sort(spark, by):
    ids = spark.range(3000).select(F.concat(F.lit("S1-"), F.col("id")).alias("s1_id"), (F.col("id") % 7).cast("string").alias("stratum"))
    mark = F.md5(F.concat("s1_id", F.lit("|5")).cast("binary")) if by == "md5" else F.xxhash64("s1_id", F.lit(5))
    groups = {}
    for r in ids.select("s1_id", "stratum", mark.alias("m")).collect():
        groups.setdefault(r.stratum, []).append((r.m, r.s1_id))
    want = {x for g in groups.values() for _, x in sorted(g)[: round(0.3 * len(g))]}
    out = sampling.split_ids(ids.select("s1_id"), 0.3, 5, ids.unionByName(ids.withColumn("stratum", F.lit("9"))), by).collect()
    assert {r.s1_id for r in out if r.is_val} == want and len(out) == 3000
    every = sampling.split_ids(ids.select("s1_id"), 0.3, 5, by=by)
    assert every.where("is_val").count() == 900
    assert sampling.split_ids(ids.limit(0).select("s1_id"), 0.3).count() == 0


def _names(spark, n=400):
    rng = random.Random(3)
    base = ["".join(rng.choices("abcdefgh", k=30)) for _ in range(12)]
    rows = [(f"S{1 + i % 3}-{i}", rng.choice(base)[: rng.randrange(24, 31)] + rng.choice(["", "", "x", "yz"])) for i in range(n)]
    return spark.createDataFrame(rows, "entity_id string, name_nospace string").coalesce(1), rows


def _plain_lsh(rows, cap):
    """Band by band and row by row, as the cap counts."""
    from itertools import islice

    sig = {i: blocking._least([t], 128)[0].tolist() for i, t in rows}
    other, out = [i for i, _ in rows if not i.startswith("S1")], set()
    for a in (i for i, _ in rows if i.startswith("S1")):
        order = {c: None for b in range(16) for c in other if sig[a][8 * b : 8 * b + 8] == sig[c][8 * b : 8 * b + 8]}
        out |= {(a, c) for c in islice(order, cap) if sum(x == y for x, y in zip(sig[a], sig[c], strict=True)) / 128 >= 0.6}
    return out


@pytest.mark.parametrize("cap", [7, None])
def test_lsh_in_small_buckets_without_pairs_shuffled(spark, monkeypatch, cap):
    monkeypatch.setattr(blocking, "BUCKET", 50)
    e, rows = _names(spark)
    out = blocking.lsh_block(of_source(e, 1), of_source(e, 2, 3), threshold=0.6, cap=cap)
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got)) and set(got) == _plain_lsh(rows, cap)
    assert out._jdf.queryExecution().optimizedPlan().toString().lstrip().startswith("MapInArrow")  # nothing comes after the comparison


def test_block_union_writes_classes_out_without_a_shuffle_of_pairs(spark, monkeypatch):
    monkeypatch.setattr(blocking, "CHUNK", 3)
    rows = [(f"S{1 + i % 3}-{i}", "kxyz" if i % 2 else None, f"u{i % 5}|") for i in range(60)] + [("S2-1", "kxyz", "u1|")]
    e = spark.createDataFrame(rows, "entity_id string, name_sorted string, bk_country_city string")
    out = blocking.block_union(of_source(e, 1), of_source(e, 2, 3), {"name_sorted": 3, "bk_country_city": 3})
    got = [tuple(r) for r in out.collect()]
    want = {(a, b) for a, x, u in rows for b, y, v in rows if a < "S2" <= b and (x == y == "kxyz" or u == v)}
    assert len(got) == len(set(got)) and set(got) == want
    assert out._jdf.queryExecution().optimizedPlan().toString().lstrip().startswith(("Project", "Generate"))
    both = e.unionByName(spark.createDataFrame([("S1-0", "kxyz", "u3|")], e.schema))  # one id with other keys
    again = blocking.block_union(of_source(both, 1), of_source(both, 2, 3), {"name_sorted": 3, "bk_country_city": 3}).collect()
    assert len(again) == len(set(again)) > len(want)


def test_block_union_joins_lists_once_and_deals_hot_keys(spark, monkeypatch):
    """No pairs of classes are shuffled: one join, and only filters and lists written out above it."""
    for name, n in (("CHUNK", 3), ("CELL", 2), ("CYCLE", 2), ("TASK", 50)):
        monkeypatch.setattr(blocking, name, n)
    rng, keys = random.Random(1), {"name_sorted": 3, "bk_name_translit": 3, "bk_country_city": 3}
    rows = [(f"S{1 + i % 3}-{i}", f"name{rng.randrange(9)}", rng.choice([None, "", "ab", "abc", "abd"]), rng.choice(["us|", "us|x", "fr|"])) for i in range(120)]
    e = spark.createDataFrame(rows + rows[:20], "entity_id string, name_sorted string, bk_name_translit string, bk_country_city string")
    for skip in (False, True):
        out = blocking.block_union(of_source(e, 1), of_source(e, 2, 3), keys, skip)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join Inner") == 1 and "Aggregate" not in plan[: plan.index("Join Inner")]
        got = [tuple(r) for r in out.collect()]
        ok = lambda x, y: x == y and len(x or "") > 2 and not (skip and x.endswith("|"))  # noqa: B023, E731
        want = {(a[0], b[0]) for a in rows for b in rows if a[0] < "S2" <= b[0] and any(ok(x, y) for x, y in zip(a[1:], b[1:], strict=True))}
        assert len(got) == len(set(got)) and set(got) == want


def test_candidates_of_a_query_have_no_cap(spark, processed):
    s1, s2 = (spark.createDataFrame([(f"{s}-{i}", f"abcdefghijklmnopq{s}") for i in range(n)], "entity_id string, name_nospace string") for s, n in (("S1", 2), ("S2", 600)))
    s1, s2 = (e.withColumn("name_sorted", F.col("name_nospace")) for e in (s1, s2))
    run = lambda cap: blocking.generate_candidates(s1, s2, s2.limit(0), lsh_threshold=0.0, lsh_cap=cap).count()
    assert run(None) == 1200 and run(500) == 1000


@pytest.mark.parametrize("joined", [False, True])
def test_candidates_are_dealt_by_their_number(spark, monkeypatch, joined):
    """Few classes make many pairs: no task writes them all out, and each is written once, from cells or from joined lists."""
    for name, n in (("CHUNK", 7), ("CYCLE", 4), ("FEW", 500), ("CELLS", 2000)):
        monkeypatch.setattr(blocking, name, n, raising=False)
    if joined:
        monkeypatch.setattr(blocking, "_grid", lambda *_: (10**6, 10**6), raising=False)
    rows = [(f"S{1 + i % 3}-{i}-{k}", f"name{i % 5}", f"city{i % 7 % 4}", ["x|", "y|z", None][i % 11 % 3]) for i in range(60) for k in range(12)]
    e = spark.createDataFrame([*rows, *rows[:3]], "entity_id string, name_nospace string, bk_country_city string, name_sorted string")
    out = blocking.generate_candidates(*[of_source(e, k) for k in (1, 2, 3)], lsh_threshold=1.0, lsh_cap=None)
    per_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    got = [tuple(r) for r in out.collect()]
    ok = lambda x, y: x == y and len(x or "") > 2
    want = {(a[0], b[0], b[0][:2]) for a in rows for b in rows if a[0] < "S2" <= b[0] and (a[1] == b[1] or any(ok(x, y) for x, y in zip(a[2:], b[2:], strict=True)))}
    assert len(got) == len(set(got)) and set(got) == want
    assert 2 * max(per_task) < len(want)


def test_keys_of_source_are_those_of_all_columns(spark):
    """Each name and each address is normalised once; keys are those of processed records, nulls included."""
    rows = [*ROWS, ("S2-009", None, "1 A St", None), ("S3-009", None, None, "US"), ("S2-010", "", "", ""), *[(f"S3-1{i}", *ROWS[i % 3][1:3], ROWS[i % 2][3]) for i in range(9)], ROWS[0]]
    e = spark.createDataFrame(rows, SCHEMA)
    got = normalize.keys_of_source(e)
    want = preprocess_source(e).select(*got.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and got.count() == len(rows)


def test_features_of_join_by_classes_equal_those_by_pairs(spark, sf, monkeypatch):
    """Records that repeat in names and addresses are put together from classes; the rows are those of the plain join."""
    from kinfold.plans import queries

    p = queries._processed(spark, sf).where("cast(substring(entity_id, 4) as int) < 60")
    part = F.substring_index(F.col("entity_id"), "-", 2).substr(4, 9).cast("int")
    times = F.explode(F.sequence(F.lit(0), F.lit(7)))
    # eight copies of each record, some with the country of their own; every pair of two groups, and a key that is null
    copies = p.withColumn("t", times).withColumn("country_norm", F.when(F.col("t") % 3 == 0, "").otherwise(F.col("country_norm")))
    copies = copies.withColumn("entity_id", F.concat_ws("-", "entity_id", "t")).withColumn("k", F.when(part % 10 < 9, part % 2)).drop("t").persist()
    sides = [of_source(copies, 1).select(F.col("entity_id").alias("s1_id"), "k"), of_source(copies, 2, 3).select(F.col("entity_id").alias("candidate_id"), "k")]
    records = [of_source(copies.drop("k"), i) for i in (1, 2, 3)]
    digits = lambda c: 7 if c == "name_addr_mean" else 9
    monkeypatch.setattr(features, "TASK", 1000)
    built = []
    monkeypatch.setattr(features, "_put_together", lambda *a, real=features._put_together: built.append(a) or real(*a))
    for d in (digits, None):
        got = features.features_of_join(*sides, ["k"], *records, d)
        want = features.rounded(features.build_feature_matrix(sides[0].join(sides[1], ["k"]), *records), d)
        assert built and got.dtypes == want.dtypes
        rows = lambda df: sorted(map(tuple, df.collect()))
        assert rows(got) == rows(want)
        assert want.count() > 10_000
    values = np.array([0.00000005, 0.12345675, 0.12345665, 1.0, 0.0, 0.9999999500000001, 1 / 3])
    assert features.half_up(values, 7).tolist() == [r[0] for r in spark.createDataFrame([(float(v),) for v in values], "x double").select(F.round("x", 7)).collect()]


def test_trees_on_groups_equal_sums_over_rows(spark, sf, monkeypatch):
    """Groups of pairs have the sums of the rows they stand for, and every validation pair its own score."""
    from kinfold.operators import boost
    from kinfold.plans import queries

    p = queries._processed(spark, sf).where("cast(substring(entity_id, 4) as int) < 60")
    number = F.substring_index(F.col("entity_id"), "-", 2).substr(4, 9).cast("int")
    copies = p.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(7)))).withColumn("country_norm", F.when(F.col("t") % 3 == 0, "").otherwise(F.col("country_norm")))
    copies = copies.withColumn("entity_id", F.concat_ws("-", "entity_id", "t")).withColumn("k", F.when(number % 10 < 9, number % 2))
    copies = copies.withColumn("mark", F.when(number % 7 > 0, F.col("name_clean").substr(1, 4).cast("binary"))).withColumn("val", F.crc32("entity_id") % 4 == 0).drop("t").persist()
    left = of_source(copies, 1).select(F.col("entity_id").alias("s1_id"), "k", "mark", "val")
    right = of_source(copies, 2, 3).select(F.col("entity_id").alias("candidate_id"), "k", "mark")
    records = [of_source(copies.drop("k", "mark", "val"), i) for i in (1, 2, 3)]
    tables = features.class_tables(left, right, ["k"], *records, 1000, "mark", "val")
    monkeypatch.setattr(boost, "SHARE", 1.0)
    used = []
    monkeypatch.setattr(boost, "_scorer", lambda *a, real=boost._scorer: used.append(a) or real(*a))
    got = boost.fit_and_score(tables, rounds=4, depth=2).toPandas().set_index(["s1_id", "candidate_id"]).sort_index()
    (n_names, a_names, bounds, trees), order = used[0], ["s1_id", "candidate_id"]
    joined = left.join(right.withColumnRenamed("mark", "other"), ["k"]).select(*order, "val", F.coalesce(F.col("mark") == F.col("other"), F.lit(False)).cast("int").alias("label"))
    rows = features.build_feature_matrix(joined, *records).join(joined, order).toPandas().set_index(order).sort_index()
    bins = [np.searchsorted(b, rows[c].to_numpy(float)) for b, c in zip(bounds, [*n_names, *a_names, *boost.JOINT], strict=True)]
    val, y, train = rows.val.to_numpy(bool), rows.label.to_numpy() * 2.0 - 1, ~rows.val.to_numpy(bool)
    assert len(got) == val.sum() > 1000 and got.index.equals(rows.index[val]) and (got.label == rows.label[val]).all() and 0 < got.label.mean() < 1
    known = np.zeros(len(rows))
    for m, tree in enumerate(trees):
        rest = 4 * y / (1 + np.exp(2 * y * known)) if m else y
        at = boost._walk(tree, lambda f, here: bins[f][here], len(rows))
        assert tree["splits"] and tree["values"][1] == pytest.approx(rest[train].mean())
        for node in set(at.tolist()):
            assert tree["values"][node] == pytest.approx(rest[train & (at == node)].mean())
        known += tree["weight"] * np.array([tree["values"][k] for k in at.tolist()])
    assert np.allclose(got.score, 1 / (1 + np.exp(-2 * known[val])))
    assert got.score[got.label == 1].mean() > got.score[got.label == 0].mean() + 0.1
