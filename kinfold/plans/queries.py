"""Registered queries of the linkage operators and their SQL counterparts.

Names follow the operators; every computed column has the same name on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.functions import similarity as sim
from kinfold.functions.text import fold, parse_id_list, tokens, translit
from kinfold.operators import blocking, boost, features, learn, metrics, normalize, pairs, sampling, validate
from kinfold.plans.record_sql import CANDIDATES, FEATURES, PROCESSED, RECORDS, fold_token, fuzzy_sql
from kinfold.plans.views import DOC, PART, ent_doc, ent_part, of_source
from kinfold.sources.tsv import keep_first

NAME_COLUMNS = ("name_clean", "name_core", "name_legal_form", "name_dba", "name_sorted", "name_nospace", "name_translit", "name_acronym", "name_first_token", "name_n_tokens")
ADDRESS_COLUMNS = ("addr_clean", "addr_sorted", "addr_words", "addr_numbers", "addr_translit", "addr_postcode", "addr_landmark", "addr_city_guess", "addr_n_tokens", "addr_missing")

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_P, _D = f"WITH e AS ({PART})", f"WITH e AS ({DOC})"
#: Pairs of first-source and other records with equal name and brand.
_PAIRS = f"""{_P}, pr AS (SELECT a.entity_id AS s1_id, b.entity_id AS candidate_id, a.p_name AS n1, b.p_name AS n2,
  a.business_name AS b1, b.business_name AS b2 FROM e a JOIN e b ON a.p_brand = b.p_brand AND a.p_size = b.p_size
  WHERE a.entity_id LIKE 'S1-%' AND b.entity_id NOT LIKE 'S1-%')"""


def _sides(spark, sf_dir, *more: str) -> tuple[DataFrame, DataFrame]:
    """(s1_id, keys) and (candidate_id, keys)."""
    e = ent_part(spark, sf_dir)
    a = of_source(e, 1).select(F.col("entity_id").alias("s1_id"), "p_brand", "p_size", *more)
    return a, of_source(e, 2, 3).select(F.col("entity_id").alias("candidate_id"), "p_brand", "p_size", *more)


def _pairs(spark, sf_dir) -> DataFrame:
    a, b = _sides(spark, sf_dir)
    return a.join(b, ["p_brand", "p_size"]).drop("p_brand", "p_size")


# normalisation ---------------------------------------------------------------------------


@query(f"{_P} SELECT entity_id, split_part(entity_id, '-', 1) AS source FROM e")
def source_of_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ent_part(spark, sf_dir).select("entity_id", F.substring_index("entity_id", "-", 1).alias("source"))


@query(f"{RECORDS} SELECT entity_id, {', '.join(NAME_COLUMNS)} FROM r")
def normalize_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names: trade name and legal form split off, the core in its several forms."""
    return normalize.normalize_names(ent_part(spark, sf_dir).select("entity_id", "business_name")).select("entity_id", *NAME_COLUMNS)


@query(f"""WITH t AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part),
f AS (SELECT p_partkey, w, {fold_token('w')} AS x FROM t)
SELECT DISTINCT w AS token, CASE WHEN length(w) <= 2 OR regexp_matches(w, '^[0-9]+$') THEN w ELSE
  array_to_string(list_filter(string_split(x, ''), lambda c, i: i = 1 or c <> string_split(x, '')[i - 1]), '') END AS folded FROM f""")
def name_translit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants of all part-name tokens folded."""
    t = _table(spark, sf_dir, "part").select(F.explode(tokens(F.col("p_name"))).alias("token")).distinct()
    return t.select("token", translit(F.col("token")).alias("folded"))


@query(f"{RECORDS} SELECT entity_id, country_norm, {', '.join(ADDRESS_COLUMNS)} FROM r")
def normalize_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses by country, in all their forms, and countries as an open set."""
    e = ent_part(spark, sf_dir).select("entity_id", "business_address", normalize.normalize_country(F.col("country")).alias("country_norm"))
    return normalize.normalize_addresses(e).select("entity_id", "country_norm", *ADDRESS_COLUMNS)


@query("SELECT doc_id, lower(strip_accents(text)) AS folded FROM documents")
def fold_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts in four languages without accents, in lower case."""
    return _table(spark, sf_dir, "documents").select("doc_id", fold(F.col("text")).alias("folded"))


@query(f"{_D} SELECT entity_id, CASE lang WHEN 'fr' THEN 'france' ELSE lang END AS country_norm FROM e")
def country_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ent_doc(spark, sf_dir).select("entity_id", normalize.normalize_country(F.col("country")).alias("country_norm"))


@query(PROCESSED)
def preprocess_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 31 columns of processed records."""
    e = ent_part(spark, sf_dir).select("entity_id", "business_name", "business_address", "country")
    return normalize.preprocess_source(e)


@query(f"{RECORDS} SELECT country_norm AS value, count(*) AS n FROM r GROUP BY 1")
def country_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per country, as in the profile of a source."""
    return metrics.value_counts(_processed(spark, sf_dir), "country_norm")


@query(f"{RECORDS} SELECT entity_id, name_core, addr_clean FROM r ORDER BY entity_id LIMIT 5")
def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first records of a profile, a report of five rows."""
    return metrics.preview(_processed(spark, sf_dir), "entity_id", ("name_core", "addr_clean"))


# keys and candidates ---------------------------------------------------------------------


def _keyed_parts(spark, sf_dir) -> DataFrame:
    k = F.concat_ws("|", "p_brand", F.array_join(F.array_sort(tokens(F.lower("p_name"))), " "))
    return ent_part(spark, sf_dir).select("entity_id", k.alias("name_sorted"), F.concat_ws("|", "p_type", "p_name", "p_size").alias("bk_name_translit"),
                                          F.when(F.col("p_size") % 2 == 0, F.concat("p_brand", F.lit("|"))).otherwise(F.concat_ws("|", "p_brand", "p_name", "p_size")).alias("bk_country_city"))


_K = f"""{_P}, k AS (SELECT entity_id, p_brand || '|' || array_to_string(list_sort(string_split(lower(p_name), ' ')), ' ') AS k1,
  p_type || '|' || p_name || '|' || p_size::VARCHAR AS k2,
  CASE WHEN p_size % 2 = 0 THEN p_brand || '|' ELSE p_brand || '|' || p_name || '|' || p_size::VARCHAR END AS k3 FROM e),
a AS (SELECT * FROM k WHERE entity_id LIKE 'S1-%'), b AS (SELECT * FROM k WHERE entity_id NOT LIKE 'S1-%')"""


@query(f"{_K} SELECT DISTINCT a.entity_id AS s1_id, b.entity_id AS candidate_id FROM a JOIN b USING (k1)")
def block_sorted_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs with the same sorted name: one equi-join."""
    k = _keyed_parts(spark, sf_dir)
    return blocking.exact_block(of_source(k, 1), of_source(k, 2, 3), "name_sorted", 3)


@query(f"{_K} SELECT a.entity_id AS s1_id, b.entity_id AS candidate_id FROM a JOIN b USING (k1) UNION SELECT a.entity_id, b.entity_id FROM a JOIN b USING (k2) "
       "UNION SELECT a.entity_id, b.entity_id FROM a JOIN b USING (k3)")  # fmt: skip
def block_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs with any of three keys in common, keys that end in a bare bar included."""
    k = _keyed_parts(spark, sf_dir)
    return blocking.block_union(of_source(k, 1), of_source(k, 2, 3), {"name_sorted": 3, "bk_name_translit": 3, "bk_country_city": 3})


@query(f"{_K} SELECT a.entity_id AS s1_id, b.entity_id AS candidate_id FROM a JOIN b USING (k1) UNION SELECT a.entity_id, b.entity_id FROM a JOIN b USING (k2) "
       "UNION SELECT a.entity_id, b.entity_id FROM a JOIN b USING (k3) WHERE k3 NOT LIKE '%|'")  # fmt: skip
def block_union_skip_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = _keyed_parts(spark, sf_dir)
    keys = {"name_sorted": 3, "bk_name_translit": 3, "bk_country_city": 3}
    return blocking.block_union(of_source(k, 1), of_source(k, 2, 3), keys, skip_empty_keys=True)


@query(f"{_D} SELECT DISTINCT a.entity_id AS s1_id, b.entity_id AS candidate_id FROM e a JOIN e b ON substring(a.business_name, 1, 4) = substring(b.business_name, 1, 4) "
       "WHERE a.entity_id LIKE 'S1-%' AND b.entity_id NOT LIKE 'S1-%' AND length(substring(a.business_name, 1, 4)) >= 4")  # fmt: skip
def block_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of documents whose names begin alike."""
    e = ent_doc(spark, sf_dir).select("entity_id", F.substring("business_name", 1, 4).alias("bk_name_prefix"))
    return blocking.exact_block(of_source(e, 1), of_source(e, 2, 3), "bk_name_prefix", 4)


#: Trigrams from the list of characters: SQL's substring walks a text from its start.
_SIG = f"""{_D}, ch AS (SELECT entity_id, business_name, list_concat([' ', ' '], string_split(business_name, ''), [' ', ' ']) AS ch FROM e),
g AS (SELECT DISTINCT entity_id, unnest(CASE WHEN business_name = '' THEN [''] ELSE
    list_transform(generate_series(1, len(ch) - 2), lambda i: ch[i] || ch[i + 1] || ch[i + 2]) END) AS g FROM ch),
h AS (SELECT entity_id, ('0x' || substring(md5(g), 1, 8))::BIGINT AS h FROM g),
s AS (SELECT entity_id, i, min(xor(h, (i * 2654435761) & 4294967295)) AS v FROM h, generate_series(0, 127) AS q(i) GROUP BY entity_id, i),
sig AS (SELECT entity_id, list(v ORDER BY i) AS sig FROM s GROUP BY entity_id)"""
_BANDS = f"""{_SIG}, bd AS (SELECT entity_id, b::INTEGER AS band, array_to_string(sig[b * 8 + 1 : b * 8 + 8], '-') AS band_key
  FROM sig, generate_series(0, 15) AS q(b))"""


def _names(spark, sf_dir) -> DataFrame:
    return ent_doc(spark, sf_dir).select("entity_id", F.col("business_name").alias("name_nospace"))


@query(f"{_SIG} SELECT entity_id, array_to_string(sig, ',') AS signature FROM sig")
def minhash_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.signatures(_names(spark, sf_dir)).select("entity_id", F.array_join("sig", ",").alias("signature"))


@query(f"{_BANDS} SELECT * FROM bd")
def lsh_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.bands(blocking.signatures(_names(spark, sf_dir)))


@query(f"""{_BANDS}, c AS (SELECT DISTINCT a.entity_id AS s1_id, b.entity_id AS candidate_id FROM bd a JOIN bd b USING (band, band_key)
  WHERE a.entity_id LIKE 'S1-%' AND b.entity_id NOT LIKE 'S1-%')
SELECT s1_id, candidate_id FROM c JOIN sig x ON x.entity_id = s1_id JOIN sig y ON y.entity_id = candidate_id
WHERE len(list_filter(x.sig, lambda v, i: v = y.sig[i])) / 128.0 >= 0.25""")
def lsh_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MinHash candidates, every one verified."""
    e = _names(spark, sf_dir)
    return blocking.lsh_block(of_source(e, 1), of_source(e, 2, 3), cap=None)


@query()
def lsh_candidates_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates by the whole text, with the first 500 of a record verified."""
    e = _names(spark, sf_dir)
    return blocking.lsh_block(of_source(e, 1), of_source(e, 2, 3))


@query(CANDIDATES)
def generate_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five production keys and MinHash over all processed records."""
    e = ent_part(spark, sf_dir).select("entity_id", "business_name", "business_address", "country")
    p = normalize.keys_of_source(e).persist()
    if spark.sparkContext.getCheckpointDir():  # else each of many plans has those of normalisation in it, which fills the driver's memory
        p = p.checkpoint()
    return blocking.generate_candidates(*[of_source(p, k) for k in (1, 2, 3)], lsh_cap=None)


# sources, sampling -----------------------------------------------------------------------


@query("SELECT o_custkey, arg_min(o_orderkey, o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey")
def keep_first_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_first(_table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey").select("o_custkey", "o_orderkey")


@query("SELECT o_custkey, arg_max(o_orderkey, o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey")
def keep_last_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_first(_table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", last=True).select("o_custkey", "o_orderkey")


@query("""WITH c AS (SELECT c_custkey::VARCHAR AS s1_id, c_mktsegment AS stratum FROM customer),
r AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY md5(s1_id || '|42'), s1_id) AS rn, count(*) OVER (PARTITION BY stratum) AS n FROM c)
SELECT s1_id, stratum, rn <= round_even(0.2 * n, 0) AS is_val FROM r""")
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("s1_id"), F.col("c_mktsegment").alias("stratum"))
    return sampling.split_ids(c.select("s1_id"), 0.2, 42, c)


@query("""SELECT o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, value LIMIT 3""")
def top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent values, a top-k report."""
    return metrics.value_counts(_table(spark, sf_dir, "orders"), "o_orderpriority", 3)


# similarities ----------------------------------------------------------------------------

_NAMES = "WITH n AS (SELECT DISTINCT p_name FROM part), pr AS (SELECT a.p_name AS a, b.p_name AS b FROM n a JOIN n b ON a.p_name[1] = b.p_name[1])"


def _name_pairs(spark, sf_dir) -> DataFrame:
    n = _table(spark, sf_dir, "part").select("p_name", F.substring("p_name", 1, 1).alias("k")).distinct()
    return n.withColumnRenamed("p_name", "a").join(n.withColumnRenamed("p_name", "b"), "k").drop("k")


@query(f"{_NAMES} SELECT a, b, CASE WHEN a = '' AND b = '' THEN 1.0 ELSE 1.0 - levenshtein(a, b)::DOUBLE / greatest(length(a), length(b)) END AS sim FROM pr")
def levenshtein_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _name_pairs(spark, sf_dir).select("a", "b", sim.levenshtein_norm(F.col("a"), F.col("b")).alias("sim"))


@query(f"{_NAMES} SELECT a, b, round(jaro_winkler_similarity(a, b), 9) AS sim FROM pr")
def jaro_winkler(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _name_pairs(spark, sf_dir).select("a", "b", F.round(sim.FUZZY["jaro_winkler"]("a", "b"), 9).alias("sim"))


@query(f"""{_NAMES}, t AS (SELECT a, b, list_distinct(string_split(a, ' ')) AS x, list_distinct(string_split(b, ' ')) AS y FROM pr)
SELECT a, b, len(list_intersect(x, y))::DOUBLE / len(list_distinct(list_concat(x, y))) AS sim FROM t""")
def set_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _name_pairs(spark, sf_dir).select("a", "b", sim.set_jaccard(F.col("a"), F.col("b")).alias("sim"))


@query("""WITH t AS (SELECT o_orderkey, string_split(o_orderkey::VARCHAR || ' ' || o_custkey::VARCHAR || ' x', ' ')[1:2] AS x, [o_orderkey::VARCHAR] AS y FROM orders)
SELECT o_orderkey, len(list_intersect(list_distinct(x), y))::DOUBLE / len(list_distinct(x)) AS sim FROM t""")
def number_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    a = F.concat_ws(" ", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), F.lit("x"))
    return o.select("o_orderkey", sim.number_overlap(a, F.col("o_orderkey").cast("string")).alias("sim"))


_KINDS = (("ratio", "ratio"), ("token_sort", "sort"), ("token_set", "set"), ("partial", "partial"))


@query(f"{_NAMES}, " + fuzzy_sql(" UNION ALL ".join(f"SELECT '{k}' AS kind, a, b FROM pr" for _, k in _KINDS))
       + "SELECT a, b, " + ", ".join(f"round(max(v) FILTER (kind = '{k}'), 9) AS {n}" for n, k in _KINDS) + " FROM fuzzy GROUP BY a, b")
def fuzzy_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four fuzzy ratios of all pairs of part names that begin alike."""
    p = _name_pairs(spark, sf_dir)
    return p.select("a", "b", *[F.round(sim.FUZZY[n]("a", "b"), 9).alias(n) for n, _ in _KINDS])


def _processed(spark, sf_dir) -> DataFrame:
    """Processed part records; queries that read them once per source persist them, as the pipeline writes them."""
    e = ent_part(spark, sf_dir).select("entity_id", "business_name", "business_address", "country")
    return normalize.preprocess_source(e)


@query(f"""{_PAIRS} SELECT s1_id, candidate_id, CASE WHEN lower(n1) = lower(n2) THEN 1.0 ELSE 0.0 END AS name_nospace_exact,
  1.0 - levenshtein(replace(lower(n1), ' ', ''), replace(lower(n2), ' ', ''))::DOUBLE / greatest(length(n1), length(n2), 2) * greatest(length(n1), length(n2), 2)
    / greatest(length(replace(n1, ' ', '')), length(replace(n2, ' ', ''))) AS name_nospace_lev,
  0 AS name_missing_1, 0 AS name_missing_2 FROM pr""")
def pair_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 42 features of pairs with one brand and size; those that SQL has are compared."""
    p, found = _processed(spark, sf_dir).persist(), _pairs(spark, sf_dir).select("s1_id", "candidate_id")
    out = features.build_feature_matrix(found, of_source(p, 1), of_source(p, 2), of_source(p, 3))
    return out.select("s1_id", "candidate_id", "name_nospace_exact", "name_nospace_lev", "name_missing_1", "name_missing_2")


@query(FEATURES)
def pair_features_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 42 features, real numbers rounded to nine digits (their mean to seven)."""
    p = _processed(spark, sf_dir).persist()
    digits = lambda c: 7 if c == "name_addr_mean" else 9
    return features.features_of_join(*_sides(spark, sf_dir), ["p_brand", "p_size"], of_source(p, 1), of_source(p, 2), of_source(p, 3), digits)


# truth, labels, metrics ------------------------------------------------------------------

#: Truth: documents with the same text. Candidates: documents of one language with the same distinct words, in any order and case.
_G = f"""{_D}, gt AS (SELECT a.entity_id AS s1_id, b.entity_id AS match_id FROM e a JOIN e b ON a.text = b.text
  WHERE a.entity_id LIKE 'S1-%' AND b.entity_id NOT LIKE 'S1-%'),
ek AS (SELECT *, array_to_string(list_sort(list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> ''))), ' ') AS key FROM e),
c AS (SELECT DISTINCT a.entity_id AS s1_id, b.entity_id AS candidate_id FROM ek a JOIN ek b ON a.key = b.key AND a.lang = b.lang
  WHERE a.entity_id LIKE 'S1-%' AND b.entity_id NOT LIKE 'S1-%'),
s1 AS (SELECT entity_id AS s1_id FROM e WHERE entity_id LIKE 'S1-%')"""


def _truth_pairs(spark, sf_dir) -> DataFrame:
    e = ent_doc(spark, sf_dir).select("entity_id", "text")
    a, b = of_source(e, 1).toDF("s1_id", "text"), of_source(e, 2, 3).toDF("match_id", "text")
    return a.join(b, "text").drop("text")


def _truth(spark, sf_dir) -> DataFrame:
    ids = of_source(ent_doc(spark, sf_dir), 1).select(F.col("entity_id").alias("s1_id"))
    lists = _truth_pairs(spark, sf_dir).groupBy("s1_id").agg(F.collect_list("match_id").alias("m"))
    return ids.join(lists, "s1_id", "left").select("s1_id", F.coalesce("m", F.array().cast("array<string>")).alias("matches"))


def _candidates(spark, sf_dir) -> DataFrame:
    """Documents of one language whose whole texts have the same distinct words, in any order and case."""
    words = F.array_remove(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), "")
    k = F.concat_ws("|", F.array_join(F.array_sort(F.array_distinct(words)), " "), "lang").alias("name_sorted")
    e = ent_doc(spark, sf_dir).select("entity_id", k)
    return blocking.exact_block(of_source(e, 1), of_source(e, 2, 3), "name_sorted")


@query(f"{_G} SELECT s1_id, match_id, split_part(match_id, '-', 1) AS match_source FROM gt")
def truth_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.truth_to_pairs(_truth(spark, sf_dir))


@query(f"{_G} SELECT c.s1_id, c.candidate_id, (gt.s1_id IS NOT NULL)::INTEGER AS label FROM c LEFT JOIN gt ON c.s1_id = gt.s1_id AND c.candidate_id = gt.match_id")
def label_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.assign_labels(_candidates(spark, sf_dir), _truth_pairs(spark, sf_dir))


@query(f"""{_G}, v AS (SELECT s1_id FROM (SELECT s1_id, row_number() OVER (ORDER BY md5(s1_id || '|42'), s1_id) AS rn, count(*) OVER () AS n FROM s1) WHERE rn <= round_even(0.2 * n, 0))
SELECT s1_id, candidate_id FROM c WHERE s1_id IN (SELECT s1_id FROM v)""")
def semi_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate pairs of the validation ids."""
    ids = of_source(ent_doc(spark, sf_dir), 1).select(F.col("entity_id").alias("s1_id"))
    return pairs.split_features(_candidates(spark, sf_dir), sampling.split_ids(ids))[1]


@query(f"{_G} SELECT s1_id, match_id, split_part(match_id, '-', 1) AS match_source FROM gt WHERE match_id NOT LIKE 'S2-%'")
def anti_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True pairs whose match is not in the second source."""
    true = pairs.truth_to_pairs(_truth(spark, sf_dir))
    return pairs.orphans(true, of_source(ent_doc(spark, sf_dir), 2)).select("s1_id", "match_id", "match_source")


@query(f"""{_G} SELECT s1.s1_id AS source1_entity_id, coalesce(string_agg(candidate_id, ',' ORDER BY candidate_id), '') AS candidate_entity_ids
FROM s1 LEFT JOIN c ON s1.s1_id = c.s1_id GROUP BY 1""")
def results_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per first-source record, its candidates sorted and joined."""
    return pairs.wide(of_source(ent_doc(spark, sf_dir), 1), _candidates(spark, sf_dir), "candidate_entity_ids", unique=True)


@query(f"""{_G} SELECT DISTINCT s1_id, candidate_id FROM c""")
def parse_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists written with repeats and blanks, read back as pairs."""
    w = pairs.wide(of_source(ent_doc(spark, sf_dir), 1), _candidates(spark, sf_dir), "joined", unique=True)
    messy = F.concat(F.lit(" , "), F.replace("joined", F.lit(","), F.lit(" ,, ")), F.lit(","), F.col("joined"))
    return w.select(F.col("source1_entity_id").alias("s1_id"), F.explode(parse_id_list(messy)).alias("candidate_id"))


@query(f"""{_G} SELECT count(candidate_id) AS found, count(*) AS total, CASE WHEN count(*) = 0 THEN 1.0 ELSE count(candidate_id)::DOUBLE / count(*) END AS candidate_recall
FROM gt LEFT JOIN c ON gt.s1_id = c.s1_id AND gt.match_id = c.candidate_id""")
def candidate_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.candidate_recall(_candidates(spark, sf_dir), _truth_pairs(spark, sf_dir))


@query(f"""{_G} SELECT round(1 - (SELECT count(*) FROM c)::DOUBLE / greatest((SELECT count(*) FROM s1) * (SELECT count(*) FROM e WHERE entity_id NOT LIKE 'S1-%'), 1), 6) AS reduction_ratio""")
def reduction_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = ent_doc(spark, sf_dir)
    n = e.agg(*[F.sum(F.col("entity_id").startswith(f"S{k}-").cast("long")).alias(f"n{k}") for k in (1, 2, 3)]).first()
    return spark.createDataFrame([(blocking.reduction_ratio(_candidates(spark, sf_dir).count(), *n),)], "reduction_ratio double")


@query(f"""{_G} SELECT round(avg((gt.s1_id IS NOT NULL)::INTEGER), 6) AS positive_rate FROM c LEFT JOIN gt ON c.s1_id = gt.s1_id AND c.candidate_id = gt.match_id""")
def positive_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of true pairs among the candidates."""
    return metrics.positive_rate(label_join(spark, sf_dir)).select(F.round("positive_rate", 6).alias("positive_rate"))


#: Scores from lengths, labels from quality.
_S = """WITH s AS (SELECT d.doc_id, quality AS label, CAST(n_chars % 1000 AS DOUBLE) / 1000 AS score FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
th AS (SELECT k::INTEGER AS k, CASE WHEN k = 90 THEN 0.95 ELSE 0.05::DOUBLE + k * ((0.95::DOUBLE - 0.05::DOUBLE) / 90) END AS t FROM generate_series(0, 90) AS q(k)),
m AS (SELECT k, t, sum(CASE WHEN score >= t THEN label ELSE 0 END)::BIGINT AS tp, sum(CASE WHEN score >= t THEN 1 - label ELSE 0 END)::BIGINT AS fp,
  sum(CASE WHEN score < t THEN label ELSE 0 END)::BIGINT AS fn FROM s, th GROUP BY k, t),
p AS (SELECT *, tp::DOUBLE / (tp + fp) AS precision, CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0 END AS recall FROM m WHERE tp + fp > 0),
f AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 1.25 * precision * recall / (0.25 * precision + recall) END AS f05 FROM p)"""


def _scored(spark, sf_dir) -> DataFrame:
    d, labels = _table(spark, sf_dir, "documents").select("doc_id", "n_chars"), _table(spark, sf_dir, "labels")
    return d.join(labels, "doc_id").select("doc_id", F.col("quality").alias("label"), ((F.col("n_chars") % 1000).cast("double") / 1000).alias("score"))


@query(f"{_S} SELECT k, tp, fp, fn, round(f05, 9) AS f05 FROM f")
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.sweep(_scored(spark, sf_dir)).select("k", F.col("tp").cast("long"), F.col("fp").cast("long"), F.col("fn").cast("long"), F.round("f05", 9).alias("f05"))


@query(f"{_S} SELECT round(t, 9) AS threshold, round(f05, 9) AS f05 FROM f ORDER BY f.f05 DESC, t LIMIT 1")
def best_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = metrics.best_threshold(metrics.sweep(_scored(spark, sf_dir)))
    return t.select(F.round("threshold", 9).alias("threshold"), F.round("f05", 9).alias("f05"))


_M = f"""{_G}, g AS (SELECT s1.s1_id, list_distinct(list(match_id) FILTER (match_id IS NOT NULL)) AS m FROM s1 LEFT JOIN gt ON s1.s1_id = gt.s1_id GROUP BY 1),
pr AS (SELECT s1_id, list(candidate_id) AS p FROM c GROUP BY 1),
n AS (SELECT g.s1_id, coalesce(len(p), 0) AS np, coalesce(len(m), 0) AS nt, coalesce(len(list_intersect(p, m)), 0) AS tp FROM g LEFT JOIN pr ON g.s1_id = pr.s1_id),
q AS (SELECT s1_id, np, nt, tp, CASE WHEN nt = 0 THEN (np = 0)::INTEGER::DOUBLE ELSE tp::DOUBLE / greatest(np, 1) END AS p,
  CASE WHEN nt = 0 THEN 1.0::DOUBLE ELSE tp::DOUBLE / greatest(nt, 1) END AS r FROM n),
z AS (SELECT *, CASE WHEN nt = 0 THEN p WHEN p + r = 0 THEN 0 ELSE 1.25 * p * r / (0.25 * p + r) END AS f FROM q)"""


@query(f"{_M} SELECT round(avg(f), 6) AS f05, round(avg(p), 6) AS precision, round(avg(r), 6) AS recall FROM z")
def macro_f05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.macro_f05(pairs.grouped(_candidates(spark, sf_dir)), _truth(spark, sf_dir))


@query(f"""{_M} SELECT round(avg(f), 6) AS f05, round(avg(p), 6) AS precision, round(avg(r), 6) AS recall, count(*) AS n_s1_entities, sum(nt)::BIGINT AS n_true_matches,
  round(avg((nt = 0)::INTEGER), 4) AS singleton_frac, (SELECT count(*) FROM c) AS n_predicted_matches FROM z""")
def full_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = metrics.full_report(pairs.grouped(_candidates(spark, sf_dir)), _truth(spark, sf_dir))
    return t.select("*")


@query(f"""{_D}, r AS (SELECT 'S1-' || doc_id AS s1_id, doc_id % 7 AS m FROM documents WHERE doc_id % 5 <> 0),
x AS (SELECT 'missing_row' AS rule, entity_id AS x FROM e WHERE entity_id LIKE 'S1-%' AND doc_id % 5 = 0
  UNION ALL SELECT 'unknown_row', 'S1-' || doc_id FROM e WHERE entity_id NOT LIKE 'S1-%' AND doc_id % 5 <> 0
  UNION ALL SELECT 'repeated_id', 'S1-' || doc_id FROM e WHERE doc_id % 7 = 1 AND doc_id % 5 <> 0
  UNION ALL SELECT 'self_match', 'S1-x' FROM e WHERE doc_id % 7 = 2 AND doc_id % 5 <> 0
  UNION ALL SELECT 'wrong_prefix', 'Q' || (doc_id % 9)::VARCHAR FROM e WHERE doc_id % 7 = 3 AND doc_id % 5 <> 0),
d AS (SELECT DISTINCT rule, x FROM x)
SELECT rule, 'error' AS severity, count(*) AS n, array_to_string(list(x ORDER BY x)[1:5], ',') AS examples FROM d GROUP BY rule""")
def validate_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules over output rows with planted faults."""
    d = ent_doc(spark, sf_dir)
    m = F.col("doc_id") % 7
    ids = F.when(m == 1, F.array(F.lit("S2-1"), F.lit("S2-1"))).when(m == 2, F.array(F.lit("S1-x"))).when(
        m == 3, F.array(F.concat(F.lit("Q"), (F.col("doc_id") % 9).cast("string")))
    ).otherwise(F.array(F.lit("S3-1"), F.lit("S2-2")))
    rows = d.where("doc_id % 5 <> 0").select(F.concat(F.lit("S1-"), F.col("doc_id")).alias("s1_id"), ids.alias("ids"))
    found = validate.validate_lists(rows, of_source(d, 1).select(F.col("entity_id").alias("id")), "matching")
    return found.select("rule", "severity", "n", F.array_join("examples", ",").alias("examples"))


@query(f"""{_P} SELECT 'part' AS name, count(*) AS n_rows, sum((business_name = '')::INTEGER)::BIGINT AS empty_names, sum((business_address = '')::INTEGER)::BIGINT AS empty_addresses,
  avg((p_partkey % 5 = 1 OR (p_partkey % 5 IN (0, 2) AND p_partkey % 7 % 3 <> 1))::INTEGER) AS postcode_share, avg((p_partkey % 5 = 1)::INTEGER) AS landmark_share,
  avg((p_size % 6 = 4)::INTEGER) AS trade_name_share FROM e""")
def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.profile(_processed(spark, sf_dir), "part")


def _labelled_side(spark, sf_dir, name: str, *sources: int) -> DataFrame:
    """Ids with the keys of their pairs; pairs with one name and brand are true."""
    e = of_source(ent_part(spark, sf_dir), *sources)
    mark = F.unhex(F.md5(F.to_json(F.struct("p_name", "p_brand")).cast("binary")))
    return e.select(F.col("entity_id").alias(name), "p_brand", "p_size", F.when(F.col("p_name").isNotNull() & F.col("p_brand").isNotNull(), mark).alias("mark"))


@query()
def gbt_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted trees fitted on one part of labelled pairs and applied to the other; on groups of pairs where records repeat."""
    p = _processed(spark, sf_dir).persist()
    e = ent_part(spark, sf_dir).select("entity_id", "p_name", "p_brand")
    sides = [_labelled_side(spark, sf_dir, name, *sources) for name, *sources in (("s1_id", 1), ("candidate_id", 2, 3))]
    split = sampling.split_ids(of_source(e, 1).select(F.col("entity_id").alias("s1_id")))
    sides[0] = sides[0].join(split.select("s1_id", F.col("is_val").alias("val")), "s1_id")
    tables = features.class_tables(*sides, ["p_brand", "p_size"], *[of_source(p, k) for k in (1, 2, 3)], boost.TASK, "mark", "val")
    if tables:
        return boost.fit_and_score(tables, rounds=10, depth=3)
    a, b = of_source(e, 1).toDF("s1_id", "n", "k"), of_source(e, 2, 3).toDF("match_id", "n", "k")
    true = a.join(b, ["n", "k"]).select("s1_id", "match_id")
    found = _pairs(spark, sf_dir).select("s1_id", "candidate_id")
    labelled = pairs.assign_labels(features.build_feature_matrix(found, of_source(p, 1), of_source(p, 2), of_source(p, 3)), true)
    labelled = labelled.persist()
    train, val = pairs.split_features(labelled, split)
    model = learn.train_model(train, val, rounds=10, depth=3)
    return learn.score(model, val).select("s1_id", "candidate_id", "label", "score")
