"""Normalisers on given cases, and properties that hold for any text."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinfold.functions.text import base_normalize, fold, parse_id_list, remove_punct, tokens, translit
from kinfold.operators.normalize import PROCESSED, normalize_addresses, normalize_country, normalize_names, preprocess_source

SCHEMA = "entity_id string, business_name string, business_address string, country string"


def one(spark, f, *values):
    rows = spark.createDataFrame([(v,) for v in values], "s string").select(f(F.col("s"))).collect()
    return [r[0] for r in rows]


def test_base_normalize(spark):
    got = one(spark, base_normalize, "A & B", "café", "McDonald's", "s.c.o.", "", None, "Ｆｕｌｌ　ﬁne", "a+b", "x – y", "a.b.c.d. e.", "प्राइवेट", "Ünïcode  x")
    assert got == ["a and b", "cafe", "mcdonalds", "sco", "", "", "full fine", "a and b", "x - y", "abcd e.", "प्राइवेट", "unicode x"]


def test_long_acronyms(spark):
    assert one(spark, base_normalize, "a.b.", "x.a.b.", "ab.c.", "a.b.c") == ["ab", "xab", "ab.c.", "abc"]


def test_fold_agrees_with_unicode_tables(spark):
    import unicodedata

    chars = [chr(c) for c in range(0x20, 0x2FFF) if unicodedata.category(chr(c)) not in ("Cn", "Cs", "Cc")]
    parts = lambda x: unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", x))
    want = ["".join(c for c in parts(x) if not (0x300 <= ord(c) <= 0x36F and unicodedata.combining(c))).lower() for x in chars]
    got = one(spark, fold, *chars)
    assert [x for x, a, b in zip(chars, got, want, strict=True) if a != b] == []


def test_remove_punct(spark):
    assert one(spark, remove_punct, "a,b.c ltd. (x)", "p.v.t x", "…x®") == ["a b c ltd x", "pvt x", "x"]


def test_translit(spark):
    cases = {"bazaar": "bazar", "galli": "gali", "chowk": "cok", "sharmaah": "sarmah", "12345": "12345", "ab": "ab", "mohalla": "mohala", "phool": "ful", "city": "citi"}
    assert one(spark, translit, *cases) == list(cases.values())


def names(spark, *raw):
    return normalize_names(spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, business_name string")).orderBy("i").collect()


def test_names(spark):
    a, b, c, d, e, f, g, h = names(spark, "Acme Holdings LLC dba Acme Cafe", "Sharma Enterprises Pvt. Ltd.", "M/s Gupta Traders", "ABC Corp",
                                   "The Limited", "Foo Ltd (Bar Foods)", "Foo (LLC)", None)
    assert (a.name_dba, a.name_core, a.name_legal_form) == ("acme cafe", "acme holdings", "llc")
    assert (b.name_legal_form, b.name_core) == ("pvt ltd", "sharma enterprises")
    assert c.name_core == "gupta traders"
    assert (d.name_clean, d.name_core, d.name_legal_form) == ("abc corporation", "abc", "corp")
    assert (e.name_core, e.name_legal_form) == ("limited", "")  # never the whole name
    assert (f.name_core, f.name_dba) == ("foo", "bar foods")
    assert (g.name_core, g.name_dba, g.name_legal_form) == ("foo", "", "llc")  # a legal form is no trade name
    assert (h.name_core, h.name_n_tokens, h.name_first_token) == ("", 0, "")


def test_word_order_does_not_matter(spark):
    a, b = names(spark, "Global Tech Solutions", "Solutions Tech Global")
    assert a.name_sorted == b.name_sorted and a.name_translit == b.name_translit


@pytest.mark.parametrize(
    ("raw", "country", "want"),
    [
        ("123 Main St, San Francisco, CA 94103", "us", {"addr_postcode": "94103", "addr_city_guess": "san francisco"}),
        ("H.No. 12, Sector 17, Chandigarh 160017", "india", {"addr_postcode": "160017", "addr_numbers": "12 17"}),
        ("Plot 5, 160 162 123", "india", {"addr_postcode": "160162"}),
        ("12345 Main St", "us", {"addr_postcode": ""}),
        ("1 Main St, Ames 50010-1234", "us", {"addr_postcode": "50010"}),
        ("Shop 5, Near SBI ATM, MG Road", "india", {"addr_landmark": "sbi atm"}),
        ("MG Road, Bangalore, Karnataka", "india", {"addr_city_guess": "bengaluru"}),
        ("Plot No. 45, Industrial Area", "india", {"addr_numbers": "45"}),
        ("100 Main St, Austin TX", "us", {"addr_clean": "100 main street austin texas"}),
        ("12 St Marks Pl", "us", {"addr_clean": "12 saint marks place"}),
        ("221B Baker St", "", {"addr_clean": "221 b baker street"}),
        ("Delhi Delhi", "india", {"addr_words": "delhi"}),
        ("", "us", {"addr_missing": 1, "addr_n_tokens": 0}),
        (None, "us", {"addr_missing": 1}),
    ],
)
def test_addresses(spark, raw, country, want):
    df = spark.createDataFrame([(raw, country)], "business_address string, country_norm string")
    got = normalize_addresses(df).first().asDict()
    assert {k: got[k] for k in want} == want


def test_countries(spark):
    cases = {"US": "us", "USA": "us", "United States": "us", "U.S.A.": "us", "India": "india", "IN": "india", "France": "france", "FR": "france", "Unknown": "unknown", "": ""}
    assert one(spark, normalize_country, *cases) == list(cases.values())


def test_id_lists(spark):
    got = one(spark, parse_id_list, "S2-001,S3-002", "a,b,a", "", " x , y ,", None)
    assert got == [["S2-001", "S3-002"], ["a", "b"], [], ["x", "y"], []]


def test_processed_source(spark):
    rows = [
        ("S1-00001", "Acme Corp", "123 Main St, New York, NY 10001", "US"),
        ("S1-00002", "M/s Sharma Pvt Ltd", "Plot 12, Sector 17, Chandigarh 160017", "India"),
        ("S1-00003", "Boulangerie Martin SARL", "12 Rue de la Paix, 75001 Paris", "France"),
    ]
    out = preprocess_source(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == list(PROCESSED)
    got = {r.entity_id: r for r in out.collect()}
    assert [got[r[0]].country_norm for r in rows] == ["us", "india", "france"]
    assert (got["S1-00001"].bk_country_postcode, got["S1-00001"].bk_name_prefix) == ("us|10001", "acme")
    assert got["S1-00002"].addr_postcode == "160017" and got["S1-00003"].bk_country_city == "france|paris"
    assert preprocess_source(spark.createDataFrame([], SCHEMA)).count() == 0


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=40), min_size=1, max_size=60))
def test_normalising_twice_changes_nothing(spark, texts):
    texts = [t.encode("utf-8", "ignore").decode().replace("\x00", "") for t in texts]
    once = one(spark, lambda c: remove_punct(base_normalize(c)), *texts)
    assert [" ".join(t.split(" ")) for t in once] == once
    assert one(spark, lambda c: F.array_join(tokens(c), " "), *once) == once
