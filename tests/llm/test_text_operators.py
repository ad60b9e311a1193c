"""The ten operators against brute force, and on awkward rows."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold.llm import bpe, decontam, graph, hilbert, html, quality, rules, simhash, substring, tokencount, toxicity
from kinfold.llm.common import join_dealt, labelled_sample
from kinfold.llm.queries import QUERIES, SQL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"w{i % 9973}" for i in range(60_000))
PASSAGE = " ".join(f"p{i}" for i in range(60))
#: (doc_id, text) with nulls, blanks, one word, one very long word, repeats, and rows with one id.
AWKWARD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "word"), (5, LONG), (6, "x" * 200_000), (7, f"a {PASSAGE} b"), (8, f"c {PASSAGE} d"),
    (8, f"c {PASSAGE} d"), (9, f"a {PASSAGE} b"), (None, f"e {PASSAGE} f"), (None, None), (9, "another text"), (10, "ünï  co de 日本 'll 😀"),
    (11, "\x00 odd \x01 bytes"),
]
CLASH = ("n_words", "score", "words", "w", "t", "h", "t1", "t2", "doc", "gone", "fp", "root", "predicted", "row", "label", "ids", "_at", "rank", "bits",
         "_id", "_hash", "_labelled", "at", "parts", "crowded", "least", "key", "component_id", "window", "item", "size", "_1", "_2", "f", "n", "_bad", "_t1", "spans", "items")


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return sorted((r.doc_id, r.text) for r in docs.collect())


@pytest.fixture(scope="module")
def awkward(spark):
    rows = spark.createDataFrame([(i, t, "en", None, 3) for i, t in AWKWARD], "doc_id long, text string, lang string, source string, n_chars long")
    return rows.withColumns({c: F.lit(7) for c in CLASH}).repartition(3)


@pytest.fixture(scope="module")
def empty(awkward):
    return awkward.limit(0)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(name, spark, sf, duck, same):
    same(QUERIES[name](spark, sf).toPandas(), duck(SQL[name]))


# 1 ---------------------------------------------------------------------------------------


def test_quality_held_out(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    got = QUERIES["op1_quality"](spark, sf).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert (held.predicted == held.quality).mean() > 0.95 and got.score.between(0, 1).all()


def test_quality_awkward(spark, awkward, empty):
    labels = spark.createDataFrame([(4, 1), (5, 0), (7, 1), (7, 0), (None, 1), (8, None)], "doc_id long, quality int")
    model = quality.train(awkward, labels)
    got = quality.classify(awkward, model).toPandas()
    assert len(got) == len(AWKWARD) and got.score.notna().all()
    assert quality.classify(empty, quality.train(empty, labels)).count() == 0
    kept = quality.keep_good(awkward, model)
    assert kept.columns == awkward.columns and kept.count() == int(got.predicted.sum())
    # without labels every text gets a half
    none = quality.train(awkward, labels.limit(0))
    assert set(quality.classify(awkward, none).toPandas().score) == {0.5}


def test_measurements_do_not_depend_on_neighbours():
    parts = ["One two two.\nOne two two.\n", "", "| a | b", "ÄÖ 12 !!"]
    whole = "".join(parts).encode()
    ends = np.cumsum([0, *(len(p.encode()) for p in parts)])
    together = quality.measure(np.frombuffer(whole, np.uint8), ends)
    for k, p in enumerate(parts):
        alone = quality.measure(np.frombuffer(p.encode(), np.uint8), np.array([0, len(p.encode())]))
        assert np.allclose(together[k], alone[0]), p


def plain_measures(text):
    """FEATURES by plain Python, one text at a time."""
    raw = text.encode()
    words, lines = [w.encode() for w in WORD.findall(text)], re.findall(rb"[^\n]*\n|[^\n]+", raw)
    n, size = max(1, len(words)), max(1, len(raw))
    blanks = sum(c in b"\t\n\x0b\x0c\r " for c in raw)
    share = lambda chars: sum(c in chars for c in raw) / size
    return [
        np.log1p(len(words)), (size - blanks) / n, share(bytes(range(65, 91))), share(b"0123456789"), share(b".,;:?!'\"()-"), share(b"#*$%&|<>"),
        share(b"!"), share(b"|"), share(bytes(range(128, 256))), raw.count(b"\n") / n, len(set(words)) / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n, sum(w[-1:] in (b".", b"!", b"?") for w in words) / n,
        sum(len(w) <= 3 for w in words) / n, len(set(lines)) / max(1, len(lines)),
    ]


def test_measurements_against_plain_python(texts):
    sample = [t for _, t in texts] + ["", " ", "a", "one two two!\nx\nx\n", "ÄÖ|12 ## b. c? "]
    data = [t.encode() for t in sample]
    got = quality.measure(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    for row, t in zip(got, sample, strict=True):
        assert np.allclose(row, plain_measures(t)), t[:80]


def test_sample_of_labelled_rows_is_bounded(spark):
    docs = spark.range(1000).select(F.lit(0).cast("long").alias("doc_id"), F.col("id").cast("string").alias("text"))
    many = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    labels = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    for limit in (1, 10, 500):
        assert labelled_sample(docs.unionByName(many), labels, "quality", limit).count() <= limit
    assert labelled_sample(docs, labels.limit(0), "quality", 10).count() == 0


def test_additive_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 2))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.Additive().fit(x, y)
    assert ((model.score(x) > 0.5) == y).mean() > 0.95


# 2 ---------------------------------------------------------------------------------------


def contamination(doc, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    w, hit, found = words(doc), set(), set()
    for item, text in items:
        v = words(text)
        n = min(13, len(v))
        for i in range(len(v) - n + 1 if n else 0):
            for j in range(len(w) - n + 1):
                if w[j : j + n] == v[i : i + n]:
                    hit |= set(range(j, j + n))
                    found.add(str(item))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


@pytest.mark.parametrize("limit", [{}, {"text_limit": 0}, {"set_limit": 2}])
def test_contamination(spark, awkward, empty, limit):
    items = [(1, PASSAGE[:60]), (10, "Word"), (2, None), (3, ""), (4, "a B  c, d e f g h i j k l m n o"), (5, "another text"), (6, "WORD")]
    tests = decontam.windows(spark.createDataFrame(items, "item_id long, text string"))
    extra = [(20, "x a b c d e f g h i j k l m n o y"), (21, "a b c d e f g h i j k l z"), (22, "Éa É"), (23, "text another word")]
    d = awkward.unionByName(spark.createDataFrame(extra, "doc_id long, text string"), allowMissingColumns=True)
    got = decontam.report(decontam.hits(d, tests, **limit)).collect()
    want = [contamination(t, items) for _, t in [*AWKWARD, *extra]]
    assert sorted((r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in got) == sorted(want)
    assert all(r.contaminated == (r.n_hit > 0 and 20 * r.n_hit >= r.n_words) for r in got)
    assert decontam.report(decontam.hits(empty, tests, **limit)).count() == 0
    none = decontam.report(decontam.hits(awkward, tests.limit(0), **limit)).collect()
    assert len(none) == len(AWKWARD) and not any(r.n_hit for r in none)
    kept = decontam.clean(d, tests)
    assert kept.columns == d.columns and kept.count() == sum(not r.contaminated for r in got)


# 3 ---------------------------------------------------------------------------------------


def measured(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    seen = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    repeat = {p for i, g in enumerate(grams) if seen[g] > 1 for p in range(i, i + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(repeat)


def test_rules(spark, awkward, empty):
    extra = [(30, "a b c d e f g h " * 4), (31, "x\nx\n \nx\ny"), (32, "# # # |")]
    d = awkward.unionByName(spark.createDataFrame(extra, "doc_id long, text string"), allowMissingColumns=True)
    led = rules.ledger(d)
    got = sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in led.collect())
    assert got == sorted(measured(t) for _, t in [*AWKWARD, *extra])
    assert rules.apply_policy(rules.ledger(empty), rules.POLICIES["v1"]).count() == 0


def test_ablations(spark, docs):
    led, policy = rules.ledger(docs), rules.POLICIES["v1"]
    got = {r.rule: (r.n_failed, r.n_only) for r in rules.ablations(led, policy).collect()}
    bits = [r.bits & policy.mask for r in led.collect()]
    for k, (name, _) in enumerate(rules.RULES):
        assert got[name] == (sum(b >> k & 1 for b in bits), sum(b == 1 << k for b in bits))


# 4 ---------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("plain &amp; &lt;b&gt;", "plain & <b>"),
        ("<p>a<p>b", "a\n\nb"), ("<div>a<div>b</div>c</div>d", "a\nb\nc\nd"), ("a<br>b", "a\nb"), ("x <b>y</b>\n z", "x y z"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"), ("<ol start=3><li>a</li><li>b</li></ol>", "3. a\n4. b"),
        ("<table><tr><td>1<td>two<tr><td>three<td>4</table>", "1     | two\nthree | 4"),
        ("<table><thead><tr><th>h<tbody><tr><td>v</table>z", "h\nv\n\nz"),
        ("<script>x<p>y</script>a<style>p{}</style><!-- <p>no -->b", "ab"),
        ("<div hidden>no</div><p style='display: none'>no</p><p style=visibility:hidden>no</p>yes", "yes"),
        ("<head><title>t</title></head><body>b", "b"), ("<title>t</title><p>b", "b"),
        ("<pre>a\n  b\n</pre>c", "a\n  b\n\nc"), ("<select><option>a<option>b</select>", "a\nb"),
        ("<dl><dt>t<dd>d</dl>", "t\n  d"), ("<p title='a>b'>c</p>", "c"), ("<p", "<p"), ("a < b <3", "a < b <3"), ("</div></p>a", "a"),
        ("<b>" * 5000 + "deep", "deep"), ("<div>" * 5000 + "deep", "deep"), ("<script>never closed", ""), ("<![if x]>a<?php b ?>c", "ac"),
    ],
)
def test_rendering(page, text):
    assert html.extract(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<table><tr><td rowspan=2>A<td>b<td>B<tr><td>c<td>d</table>", "A | b | B\n  | c | d"),
        ("<table><tr><td rowspan=0>A<td>b<tr><td>c<tr><td>d</table>", "A | b\n  | c\n  | d"),
        ("<table><tr><td colspan=2>wide cell<td>e<tr><td>1<td>2<td>3</table>", "wide cell | e\n1 | 2     | 3"),
        ("<table><tr><td>日本<td>x<tr><td>abcdef<td>y</table>", "日本   | x\nabcdef | y"),
        ("<table><tr><td><ul><li>p<li>q</ul><td>z</table>", "- p | z\n- q |"),
        ("<table><tr><td><table><tr><td>1<td>2</table><td>z</table>", "1 | 2 | z"),
        ("<textarea>a\n b&amp;</textarea>c", "a\n b&\nc"), ("<svg><title>t</title><text>s</text></svg>", "s"), ("<math><mi>x</mi></math>", "x"),
        ("<details>no<summary>yes</summary>no</details><details open><summary>a</summary>b</details>", "yes\na\nb"),
        ("<style>.a, p.b { display: none } #c{visibility:hidden}</style><p class='x a'>1<p class=b>2<p id=c>3<p>4", "4"),
        ("<style>@media print { .a { display:none } } .b{display:none} .b{display:block}</style><p class=a>1<p class=b>2", "1\n\n2"),
        ("<input value=go><input type=hidden value=no>", "go"), ("<a href=\"x>text", "text"), ("<a title='<b>'>x</a>", "x"),
        ("<table>" * 30 + "<tr><td>deep", "deep"), ("<ul><li>" * 60 + "x", " " * 62 + "- x"),
    ],
)
def test_layout(page, text):
    assert html.extract(page) == text


@pytest.mark.parametrize(
    "page",
    ["<a " * 350_000, "<b>" * 140_000 + "x" + "</b>" * 140_000, "<i>" * 150_000 + "<p>a" * 130_000, "<a \"<b>\"" * 110_000 + "'>",
     "<table><tr><td>x" * 60_000, "<table><tr>" + "<td rowspan=9999>x" * 30_000 + "<tr><td>y" * 40_000, "<ul><li>x" * 100_000,
     "<table>" + "<tr><td colspan=1000>x<td>y" * 30_000, "<table><tr><td>" + "w" * 500_000 + "<td>z" + "<tr><td>a<td>b" * 30_000],
)
def test_time_and_size_grow_with_the_page(page):
    import time

    began = time.process_time()
    out = html.extract(page)
    assert time.process_time() - began < 40 and len(out) < 12 * len(page)


def drawn(rng, depth):
    """A random page: its source, and its lines by plain recursion, where None is a blank line if text stands on both sides."""
    word = lambda: " ".join(rng.choice(["ab", "c&d", "é", "x<y", "12"]) for _ in range(rng.randrange(1, 4)))
    source, lines = "", []
    for _ in range(rng.randrange(1, 4)):
        kind = rng.choice(["div", "p", "ul", "ol", "table", "pre", "hidden", "section"] if depth else ["div", "p", "pre"])
        text = word()
        inline = text.replace("&", "&amp;").replace("<", "&lt;").replace(" ", rng.choice([" ", "\n ", " <b></b>"]))
        if kind in ("div", "section") and depth and rng.random() < 0.5:
            inside, more = drawn(rng, depth - 1)
            source += f"<{kind}>{inside}</{kind}>"
            lines += more
        elif kind in ("div", "section"):
            source += f"<{kind}>{inline}</{kind}>"
            lines.append(text)
        elif kind == "p":
            source += f"<p>{inline}" + rng.choice(["</p>", ""]) + ("<div></div>" if rng.random() < 0.2 else "")
            lines += [None, text, None]
        elif kind == "pre":
            source += "<pre>" + text.replace("&", "&amp;").replace("<", "&lt;") + "\n  z</pre>"
            lines += [None, text, "  z", None]
        elif kind in ("ul", "ol"):
            items = [word() for _ in range(rng.randrange(1, 4))]
            close = rng.choice(["</li>", ""])
            source += f"<{kind}>" + "".join("<li>" + x.replace("&", "&amp;").replace("<", "&lt;") + close for x in items) + f"</{kind}>"
            lines += [None, *(("- " if kind == "ul" else f"{k}. ") + x for k, x in enumerate(items, 1)), None]
        elif kind == "table":
            n = rng.randrange(1, 4)
            rows = [[word() for _ in range(n)] for _ in range(rng.randrange(1, 4))]
            close = rng.choice(["</td>", ""])
            cells = lambda r: "".join("<td>" + x.replace("&", "&amp;").replace("<", "&lt;") + close for x in r)
            source += "<table>" + "".join("<tr>" + cells(r) for r in rows) + "</table>"
            wide = [max(len(r[k]) for r in rows) for k in range(n)]
            lines += [None, *(" | ".join(x.ljust(w) for x, w in zip(r, wide, strict=True)).rstrip() for r in rows), None]
        else:
            source += f"<div style='display:none'>{inline}</div><script>{text}</script><!-- {word()} -->"
    return source, lines


def test_rendering_of_drawn_pages():
    rng = random.Random(11)
    for _ in range(400):
        source, lines = drawn(rng, 2)
        want = []
        for k, x in enumerate(lines):
            if x is not None:
                want += [""] * (bool(want) and None in lines[max(j for j in range(k) if lines[j] is not None) : k]) + [x]
        assert html.extract(f"<html><body>{source}</body></html>") == "\n".join(want), source


def test_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = QUERIES["op4_html"](spark, sf).collect()
    assert len(got) == pages.count() and all(r.text for r in got)
    assert not any("track(" in r.text or "margin:0" in r.text or "<" in r.text for r in got)
    odd = spark.createDataFrame([(1, None, 1), (1, "", 2), (None, "<p>x", 3)], "page_id long, html string, text int")
    assert sorted(r.text for r in html.extract_text(odd).collect()) == ["", "", "x"]
    assert html.extract_text(odd.limit(0)).count() == 0


# 5 ---------------------------------------------------------------------------------------


def test_token_counts(spark, monkeypatch):
    monkeypatch.setattr(tokencount, "SUPER", 3)
    rng = random.Random(2)
    want, rows = {}, []
    for f in range(6):
        stream, counts = [], []
        for _ in range(rng.randrange(0, 40)):
            n = rng.choice([0, 1, 2, 50])
            stream += [rng.randrange(100) for _ in range(n)] + [999]
            counts.append(n)
        if f % 2:
            stream += [5] * 7
            counts.append(7)
        want |= {(f"f{f}", k): n for k, n in enumerate(counts)}
        raw = np.array(stream, "<u2").tobytes()
        size = rng.choice([2, 6, 64, 10_000])
        rows += [(f"f{f}", k, raw[a : a + size]) for k, a in enumerate(range(0, max(len(raw), 1), size))]
    rows.append(("none", 0, None))
    blocks = spark.createDataFrame(rows, "file string, block long, data binary").repartition(4)
    got = tokencount.count_documents(blocks, 999).collect()
    assert {(r.file, r.ordinal): r.n_tokens for r in got} == want and len(got) == len(want)
    assert tokencount.count_documents(blocks.limit(0), 999).count() == 0


@pytest.mark.parametrize("block_bytes", [2, 4, 1 << 20])
def test_token_files(spark, tmp_path, block_bytes):
    np.array([1, 2, 9, 9, 3], "<u2").tofile(tmp_path / "a.bin")
    np.array([9], "<u2").tofile(tmp_path / "b.bin")
    np.array([], "<u2").tofile(tmp_path / "c.bin")
    got = tokencount.count_in_files(spark, str(tmp_path), 9, block_bytes=block_bytes).collect()
    assert sorted((r.file[-5:], r.ordinal, r.n_tokens) for r in got) == [("a.bin", 0, 2), ("a.bin", 1, 0), ("a.bin", 2, 1), ("b.bin", 0, 0)]
    (tmp_path / "d.bin").write_bytes(b"123")
    with pytest.raises(ValueError, match="d.bin"):
        tokencount.count_in_files(spark, str(tmp_path), 9)


def test_token_files_of_awkward_rows(spark, tmp_path, awkward, empty):
    order = tokencount.write_token_files(awkward, lambda: lambda t: [min(ord(c), 9999) for c in t], 10_000, str(tmp_path / "x"))
    counted = tokencount.count_in_files(spark, str(tmp_path / "x"), 10_000, block_bytes=4096).withColumn("file", F.substring_index("file", "/", -1))
    got = sorted((str(r.doc_id), r.n_tokens) for r in counted.join(order, ["file", "ordinal"]).collect())
    assert got == sorted((str(i), len(t or "")) for i, t in AWKWARD)
    assert tokencount.write_token_files(empty, lambda: list, 10_000, str(tmp_path / "y")).count() == 0
    assert tokencount.count_in_files(spark, str(tmp_path / "y"), 10_000).count() == 0


def test_token_counts_of_documents(spark, sf, texts):
    import public_tokenizers as tokenizers
    import tiktoken

    with open(tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(t): int(i) for t, i in map(bytes.split, f)}
    coder = tiktoken.Encoding("x", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r.n_tokens for r in QUERIES["op5_token_counts"](spark, sf).collect()}
    assert got == {i: len(coder.encode_ordinary(t)) for i, t in texts}


# 6 ---------------------------------------------------------------------------------------


def without_repeats(rows, size=50):
    first = {}
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - size + 1):
            g = tuple(w[k : k + size])
            if i is not None:
                first[g] = min(first.get(g, i), i)
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - size + 1):
            d = first.get(tuple(w[k : k + size]))
            if d is not None and (i is None or d < i):
                gone |= set(range(k, k + size))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def planted(n, seed):
    rng = random.Random(seed)
    passages = [[rng.choice("abcdefgh") + str(rng.randrange(30)) for _ in range(rng.randrange(45, 90))] for _ in range(6)]
    rows = []
    for i in range(n):
        w = []
        for _ in range(rng.randrange(1, 5)):
            w += [f"u{rng.randrange(10**9)}" for _ in range(rng.randrange(0, 40))]
            p = rng.choice(passages)
            a = rng.randrange(0, 10)
            w += p[a : len(p) - rng.randrange(0, 10)]
        rows.append((rng.randrange(n), " ".join(w)))
    return rows


@pytest.mark.parametrize("shard", [substring.SHARD, 3, 0])
def test_substrings(spark, shard):
    rows = planted(120, 4)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring.remove_repeats(df, shard=shard).collect())
    assert got == sorted(without_repeats(rows))
    assert sum(r[2] for r in got) > 1000


def test_substrings_awkward(spark, awkward, empty):
    got = substring.remove_repeats(awkward).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=key) == sorted(without_repeats(AWKWARD), key=key)
    assert substring.remove_repeats(empty).count() == 0
    out = substring.strip_repeats(awkward)
    assert out.columns == awkward.columns and out.count() == len(AWKWARD)
    assert {r.text for r in out.where("doc_id = 8").collect()} == {"c d"} and {r.n_chars for r in out.where("doc_id = 8").collect()} == {3}
    assert substring.strip_repeats(empty).count() == 0


def test_substrings_of_words_whose_hashes_collide(spark):
    a, b = "a", "b"
    while len(a) < 2048:  # sequences on which every polynomial hash modulo a power of two agrees
        a, b = a + b, b + a
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"{base} {a}"), (2, f"{base} {b}"), (3, f"{a} {base}"), (4, f"{b} {base} {a}")]
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == without_repeats(rows) and got[1][2] == 60 and got[2][2] == 60


def test_substrings_with_text_ids(spark):
    rows = [(f"d{i}", t) for i, t in planted(40, 5)]
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring.remove_repeats(spark.createDataFrame(rows, "doc_id string, text string")).collect())
    assert got == sorted(without_repeats(rows))


def test_automaton_statistics():
    rng = random.Random(6)
    for _ in range(60):
        known = [[rng.choice("abc") for _ in range(rng.randrange(0, 25))] for _ in range(3)]
        a = substring.Automaton()
        for k in known:
            a.add(k)
        q = [rng.choice("abcd") for _ in range(30)]
        runs = {tuple(k[i:j]) for k in known for i in range(len(k)) for j in range(i + 1, len(k) + 1)} | {()}
        want = [max(n for n in range(e + 2) if tuple(q[e + 1 - n : e + 1]) in runs) for e in range(len(q))]
        assert a.statistics(q) == want


# 7 ---------------------------------------------------------------------------------------


def fingerprint(text):
    import xxhash

    w = WORD.findall((text or "").translate(LOWER))
    grams = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hs) > len(hs)) if hs else 0


def classes(fps, radius=4):
    root = list(range(len(fps)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(fps))]


def test_near_duplicates(spark, sf, texts):
    fps = [fingerprint(t) for _, t in texts]
    want = [texts[c][0] for c in classes(fps)]
    got = sorted((r.doc_id, r.fingerprint, r.component_id) for r in QUERIES["op7_simhash"](spark, sf).collect())
    assert got == [(i, f"{f:016x}", c) for (i, _), f, c in zip(texts, fps, want, strict=True)]


def test_near_duplicates_awkward(spark, awkward, empty):
    got = simhash.near_duplicates(awkward).collect()
    assert len(got) == len(AWKWARD)
    assert {r.component_id for r in got if r.fingerprint == "0" * 16} == {1}
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.keep_first(awkward)
    assert kept.columns == awkward.columns and kept.count() == len({r.root for r in got})
    assert simhash.keep_first(empty).count() == 0


@pytest.mark.parametrize(("blocks", "part"), [((5, 1), simhash.PART), ((6, 2), 3), ((8, 4), 5)])
def test_links_lose_nothing(spark, blocks, part):
    rng = random.Random(8)
    fps = []
    for _ in range(25):
        x = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 15)):
            fps.append(x)
            for _ in range(rng.randrange(0, 6)):
                x ^= 1 << rng.randrange(64)
    fps = sorted(set(fps))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    roots = {r.node: r.root for r in graph.components(simhash.links(df, blocks=blocks, part=part)).collect()}
    got = [roots.get(signed(x), signed(x)) for x in fps]
    assert [got.index(g) for g in got] == [c for c in classes(fps)]


def test_rows_that_tie_are_chosen_by_their_columns(spark):
    rows = [(1, "a b", "z"), (1, "a b", "y"), (1, None, "x"), (1, "", "w"), (None, "c d e f g h", "v")]
    kept = simhash.keep_first(spark.createDataFrame(rows, "doc_id int, text string, source string").repartition(3))
    assert sorted(r.source for r in kept.collect()) == ["v", "x", "y"]  # null before empty


def test_block_plans():
    for n in (0, 10, 10**6, 10**9, 10**12):
        blocks, kept = simhash.plan_blocks(n)
        assert blocks - kept == simhash.RADIUS


@pytest.mark.parametrize("few", [graph.FEW, 0])
def test_long_chains(spark, few):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(500, 500), (601, 600)], "u long, v long")
    got = {r.node: r.root for r in graph.components(edges, few=few).collect()}
    assert got == {**{i: 0 for i in range(301)}, 600: 600, 601: 600}


# 8 ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def coder():
    import public_tokenizers as tokenizers
    import tiktoken

    v = bpe.default_vocabulary()
    return v, tiktoken.Encoding("x", pat_str=tokenizers.PATTERN, mergeable_ranks=dict(zip(v.tokens, v.ids, strict=True)), special_tokens={})


def test_encoding(coder):
    v, other = coder
    codec = v.codec()
    odd = ["", " ", "  a", "a  b ", "a \n b", "don't we'll", "a" * 5000, "½ x²", "日本語 テキスト", "😀 😀", " a  b", "ab́c", "x<|endoftext|>y", " 's", LONG[:5000]]
    rng = random.Random(9)
    odd += ["".join(rng.choice("ab 'sé\n\t1.中") for _ in range(40)) for _ in range(500)]
    for t in odd:
        ids = codec.encode(t)
        assert ids == other.encode_ordinary(t), t
        assert codec.decode(ids) == t.encode()


def test_pieces_of_more_than_two_to_the_24_bytes(coder):
    codec = coder[0].codec()
    rare = next(bytes([b]) for b in range(128, 256) if len(codec.merge(bytes([b]) * 4)) == 4)  # never merges, so the heap stays small
    short = codec.merge(rare * 4 + b"the")
    assert len(short) < 7
    long = codec.merge(rare * (1 << 24) + b"the")
    assert long[-len(short) :] == short and len(long) == len(short) - 4 + (1 << 24)


def test_perfect_hash():
    keys = [f"key{i}".encode() for i in range(3000)]
    h = bpe.PerfectHash(keys)
    assert [h.find(k) for k in keys] == list(range(3000)) and h.find(b"other") == -1
    assert bpe.PerfectHash([]).find(b"x") == -1


def test_digests(spark, sf, coder, texts, awkward, empty):
    v, other = coder
    got = {r.doc_id: r for r in QUERIES["op8_bpe"](spark, sf).collect()}
    for i, t in texts:
        ids = other.encode_ordinary(t)
        assert got[i].n_tokens == len(ids) and got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    back = bpe.decode(bpe.encode(awkward, v), v).collect()
    assert sorted(bytes(r.bytes) for r in back) == sorted((t or "").encode() for _, t in AWKWARD)
    assert bpe.digests(awkward, v, with_ids=True).where("n_tokens <> size(ids)").count() == 0
    assert bpe.digests(empty, v).count() == 0


# 9 ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("dims", [2, 3, 4])
def test_curve(dims):
    from itertools import product

    table, bits = hilbert.curve_table(dims), 3 if dims < 4 else 2

    def place(p):
        state = h = 0
        for b in reversed(range(bits)):
            digit, state = table[state * 2**dims + sum((x >> b & 1) << k for k, x in enumerate(p))]
            h = h * 2**dims + digit
        return h

    cells = sorted(product(range(2**bits), repeat=dims), key=place)
    assert sorted(map(place, cells)) == list(range(2 ** (bits * dims)))
    assert all(sum(abs(a - b) for a, b in zip(x, y, strict=True)) == 1 for x, y in zip(cells, cells[1:], strict=False))


def test_curve_in_spark(spark):
    table = hilbert.curve_table(2)

    def place(p):
        state = h = 0
        for b in reversed(range(5)):
            digit, state = table[state * 4 + (p[0] >> b & 1) + 2 * (p[1] >> b & 1)]
            h = h * 4 + digit
        return h

    df = spark.range(32).crossJoin(spark.range(32).toDF("y")).select("id", "y", hilbert.curve_index([F.col("id").cast("int"), F.col("y").cast("int")]).alias("h"))
    assert all(r.h == place((r.id, r.y)) for r in df.collect())


@pytest.mark.parametrize("shards", [1, 4, 40])
def test_shards(awkward, empty, shards):
    got = hilbert.hilbert_shards(awkward, shards).toPandas()
    counts = got.groupby("shard").size().reindex(range(shards), fill_value=0)
    assert len(got) == len(AWKWARD) and counts.max() - counts.min() <= 1
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    assert sorted(got["size"]) == sorted(len((t or "").encode()) + 16 for _, t in AWKWARD)
    assert sorted(got.text_crc32) == sorted(zlib.crc32((t or "").encode()) for _, t in AWKWARD)
    in_order = got.sort_values(["shard", "slot"]).cell.tolist()
    assert in_order == sorted(in_order)
    assert hilbert.hilbert_shards(empty, shards).count() == 0


def test_shards_against_a_plain_sort(spark, sf):
    docs = [r.asDict() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    table, n = hilbert.curve_table(3), len(docs)
    size = lambda d: len((d["text"] or "").encode()) + 16

    def cell(value, values):
        return 0 if value is None else 32 * sum(v < value for v in values if v is not None) // sum(v is not None for v in values)

    sizes, sources, langs = ([f(d) for d in docs] for f in (size, lambda d: d["source"], lambda d: d["lang"]))

    def place(d):
        at = [cell(size(d), sizes), cell(d["source"], sources), cell(d["lang"], langs)]
        state = h = 0
        for b in reversed(range(5)):
            digit, state = table[state * 8 + sum((x >> b & 1) << k for k, x in enumerate(at))]
            h = h * 8 + digit
        return h

    order = sorted((place(d), zlib.crc32((d["text"] or "").encode()), size(d), d["doc_id"]) for d in docs)
    want = []
    for k in range(40):
        run = n // 40 + (k < n % 40)
        want += [(o[3], k, j) for j, o in enumerate(order[len(want) : len(want) + run])]
    got = QUERIES["op9_hilbert"](spark, sf).collect()
    assert sorted((r.doc_id, r.shard, r.slot) for r in got) == sorted(want)
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}


def test_shard_files_and_their_ranges(spark, sf, tmp_path, awkward, empty):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    ranges = hilbert.write_shards(docs, str(tmp_path / "a"), shards=8)
    assert {r.rows for r in ranges.collect()} == {docs.count() // 8}
    assert len(list((tmp_path / "a" / "data").glob("shard=*/*.parquet"))) == 8
    for dimension, least, greatest in (("lang", "de", "de"), ("size", 16, 400), ("source", "a", "m")):
        got = sorted(r.doc_id for r in hilbert.read_shards(spark, str(tmp_path / "a"), dimension, least, greatest).collect())
        value = F.octet_length("text") + 16 if dimension == "size" else F.col(dimension)
        assert got == sorted(r.doc_id for r in docs.where(value.between(least, greatest)).collect())
    assert len(hilbert.shards_for(ranges, "size", 16, 200)) < 8
    for k, rows in enumerate((awkward, empty)):
        hilbert.write_shards(rows, str(tmp_path / f"x{k}"), shards=3)
        assert k or spark.read.parquet(str(tmp_path / f"x{k}/data")).count() == len(AWKWARD)


# 10 --------------------------------------------------------------------------------------


def test_toxicity_held_out(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    got = QUERIES["op10_toxicity"](spark, sf).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert (held.predicted == held.toxic).mean() > 0.9 and got.score.between(0, 1).all()
    assert held[held.predicted == 1].toxic.mean() > 0.8


def test_deobfuscation(spark, docs):
    channel = toxicity.Channel(toxicity.trigram_counts(docs))
    cases = {"1d10t": "idiot", "idiooot": "idiot", "m0r0n": "moron", "$tupid": "stupid", "tr@sh": "trash", "s t u p i d": "stupid", "s.t.u.p.i.d": "stupid"}
    for hidden, plain in cases.items():
        assert plain in channel.restore(f"of {hidden} is").replace(" ", ""), hidden
    for same in ("ordinary words, here", "2.0.", "ENTIRE!!", "555-5010", "note### this", ""):
        assert channel.restore(same) == same
    assert channel.words(None) == set()


def test_deobfuscation_of_ordinary_disguises(spark):
    plain = "you asshole loser losers garbage worthless idiot stupid clown scum imbécile crétin ass the good coffee and all ends clown$$$ ends*** "
    channel = toxicity.Channel(toxicity.trigram_counts(spark.createDataFrame([(plain,)] * 200, "text string")))
    cases = {
        "assh0l3": "asshole", "l0s3r5": "losers", "garbag3": "garbage", "w0rthle55": "worthless", "idi000t": "idiot", "1d1000t": "idiot",
        "(i d i o t)": "(idiot)", "'s c u m'": "'scum'", "s c u m!": "scum!", "a s s": "ass", "i  d  i  o  t": "idiot", "y o u  i d i o t": "you idiot",
        "cl0wn#": "clown#", "cl0wn###": "clown###", "clownnn5": "clown", "imbécil3": "imbécile", "crét1n": "crétin", "idioot": "idiot", "!d!ot": "idiot",
    }
    for hidden, want in cases.items():
        assert want in channel.restore(f"the {hidden} and"), hidden
    for same in ("the good coffee, all 100 of 1994", "ENDS!!", "clown$$$", plain):
        assert channel.restore(same) == same


def test_decoding_against_all_readings(spark, docs):
    from itertools import product

    channel = toxicity.Channel(toxicity.trigram_counts(docs))

    def cost_of(readings):
        key, total, out = (0, 0), 0.0, ""
        for x, extra in readings:
            if x is None and not key[1]:
                return None
            total += extra
            for c in (x or "").encode():
                at = int(toxicity._CODE[c])
                key, total = (key[1], at), total + float(channel.cost[key[0], key[1], at])
            out += x or ""
        return total + float(channel.cost[key[0], key[1], 0]), out

    for text in ("1d10t", "st0pp", "idioot", "i d i 0 t", "a.b.c", "m0r0n", "$$h1t", "4ll", "b00k!", "a  b c", "3xtr4", "100", "crét1n", "looo0l"):
        found = [c for c in map(cost_of, product(*channel.lattice(text))) if c]
        best = min(c for c, _ in found)
        assert min(c for c, out in found if out == channel.decode(text)) == pytest.approx(best), text


def test_trigrams_count_everything(spark, awkward):
    texts = [(t or "") for _, t in AWKWARD]
    want = sum(len(t.encode()) + 1 for t in texts)
    assert want - 2 * len(texts) <= toxicity.trigram_counts(awkward).sum() <= want


def test_toxicity_of_short_words(spark):
    bad, fine = "the zub here", "the new here"
    rows = [(i, f"{bad if i % 2 else fine} {i}") for i in range(400)] + [(1001, "z u b"), (1002, "zub!"), (1003, "new"), (1004, "zubrowka")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int"))
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, model).collect()}
    assert all(got[i] == i % 2 for i in range(400))
    assert (got[1001], got[1002], got[1003], got[1004]) == (1, 1, 0, 0)


def test_toxicity_awkward(spark, awkward, empty):
    labels = spark.createDataFrame([(4, 1), (5, 0), (7, 1), (7, 0), (None, 1), (8, None)], "doc_id long, toxic int")
    got = toxicity.score(awkward, toxicity.train(awkward, labels)).toPandas()
    assert len(got) == len(AWKWARD) and got.score.between(0, 1).all()
    assert toxicity.score(empty, toxicity.train(empty, labels)).count() == 0


# pipeline --------------------------------------------------------------------------------


def test_pipeline(spark, sf):
    import corpus_pipeline

    from kinfold.llm.common import materialize

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf), name)
        seen.append(docs)
    assert all(d.columns == columns for d in seen[:-1])
    rows = [{r.doc_id: r.text for r in d.collect()} for d in seen[:-1]]
    start, good, single, cut, clean = rows
    fps = [(i, fingerprint(t)) for i, t in sorted(good.items())]
    assert set(single) == {fps[c][0] for c in classes([f for _, f in fps])}
    want = {i: kept for i, _, n, kept in without_repeats(sorted(single.items())) if n}
    assert cut == {i: want.get(i, t) for i, t in single.items()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    bad = {i for i, t in cut.items() if 0 < 20 * contamination(t, items)[1] >= contamination(t, items)[0]}
    assert clean == {i: t for i, t in cut.items() if i not in bad}
    assert {r.doc_id: r.decoded_sha256 for r in docs.collect()} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in clean.items()}
    assert len(start) > len(good) > 0


def test_pipeline_stages_on_awkward_rows(spark, sf, awkward, empty):
    import corpus_pipeline

    for d in (awkward, empty):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, d, sf).count() <= d.count()


def test_hot_keys_are_parted_without_a_join(spark):
    from collections import Counter

    keys = [1] * 3000 + [2] * 50 + list(range(10, 3010)) + [None] * 5
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, i int")
    small = rows.where("k is not null and k % 3 != 0").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    out = join_dealt(rows, small, ["k"], "n")
    n = Counter(keys)
    assert sorted(tuple(r) for r in out.collect()) == sorted((k, i, n[k]) for i, k in enumerate(keys) if k is not None and k % 3)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan and plan.count("Join Inner") == 2
