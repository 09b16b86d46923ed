"""The registered query of each operator, and the SQL that checks it where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm import chat_format as chat
from reviewloom.llm import quality_rules as quality
from reviewloom.llm import secret_scan as secrets
from reviewloom.llm import url_filters as urls
from reviewloom.llm.brown_lm import class_scores
from reviewloom.llm.decontaminate import contaminated_pairs
from reviewloom.llm.divergence import source_divergence
from reviewloom.llm.embedding_dedup import near_vectors
from reviewloom.llm.near_dedup import near_duplicates
from reviewloom.llm.packing import pack, token_pieces
from reviewloom.llm.resampling import importance_scores
from reviewloom.llm.substring_dedup import substring_dedup
from reviewloom.llm.text import table
from reviewloom.llm.token_counts import token_counts
from reviewloom.session import ship_package

OP3_SQL = r"""WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
low AS (SELECT g, min(doc_id) AS low FROM g GROUP BY g),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM g JOIN low USING (g)
  WHERE low < doc_id),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n
  FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD_LIST = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"
# All links by joining the sets on their shingles, then everything that is reachable.
OP6_SQL = f"""WITH RECURSIVE w AS (
  SELECT doc_id, {_WORD_LIST.format(_LOWER)} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE len(w) WHEN 0 THEN [] WHEN 1 THEN w
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS g FROM w),
n AS (
  SELECT doc_id, count(g) AS n FROM documents LEFT JOIN s USING (doc_id) GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept
FROM c JOIN n USING (doc_id)"""

# All links by comparing all vectors, then everything that is reachable.
OP11_SQL = """WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS i, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (
  SELECT * FROM v WHERE len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x))) = len(e)
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.i AS a, b.i AS b FROM ok a JOIN ok b ON a.i <> b.i AND len(a.e) = len(b.e)
  WHERE CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= 0.95 END),
n AS (SELECT a AS i, count(*) AS n FROM links GROUP BY a),
reach AS (
  SELECT i AS a, i AS b FROM v
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
c AS (
  SELECT r.a AS i, min(v.vec_id) AS component_id FROM reach r JOIN v ON v.i = r.b GROUP BY r.a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN c USING (i) LEFT JOIN n USING (i)"""
# Every cell of group and kept term, then both parts.
OP12_SQL = r"""WITH d AS (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT i, lang, source, unnest(w) AS term FROM d),
k AS (
  SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT i) >= 30),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (
  SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term)
  GROUP BY lang, source, term),
s AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0) + 5 * any_value(v) AS d
  FROM g JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source
  GROUP BY g.lang, g.source),
p AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
    1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 5) // s.d AS p,
    1 + CAST(1000000000 AS HUGEINT) * (k.n + 5) // (v.n + 5 * v.v) AS q
  FROM s JOIN k ON k.lang = s.lang JOIN v ON v.lang = s.lang
  LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
f AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
o AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
r AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM o)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM r WHERE part = 'pair' OR rank <= 50"""

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return contaminated_pairs(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    pieces = token_pieces(table(spark, sf_dir, "documents"), VOCABULARY)
    return pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    out = substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.withColumn("kept_sha256", F.sha2("kept_text", 256)).drop("text", "kept_text")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_format(table(spark, sf_dir, "conversations"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, VOCABULARY).drop("text")


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return near_duplicates(table(spark, sf_dir, "documents"), size=2).drop("_t")


def op7_class_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return class_scores(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.secret_spans(docs)
    rules = [*secrets.BASE, *secrets.EXTRA]
    base = F.filter("secrets", lambda s: s["place"] < len(secrets.BASE))
    counts = {
        f"n_{rule.kind}": secrets.count_of(k)
        for k, rule in enumerate(secrets.BASE)
    }
    return found.withColumns({
        **counts, "base_sha256": F.sha2(secrets.span_string(base, rules), 256),
        "spans": secrets.span_string(F.col("secrets"), rules),
    }).drop("text", "secrets")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = quality.quality_rules(docs, table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality.NEW)


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return urls.url_filters(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


def op10_weighted_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.weighted_url_filters(pages).drop("url")


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return near_vectors(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return source_divergence(table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return importance_scores(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_decontamination": (op1_decontamination, None),
    "op2_best_fit_packing": (op2_best_fit_packing, None),
    "op3_substring_dedup": (op3_substring_dedup, OP3_SQL),
    "op4_chat_format": (op4_chat_format, chat.ORACLE_SQL),
    "op5_token_counts": (op5_token_counts, None),
    "op6_near_dedup": (op6_near_dedup, OP6_SQL),
    "op7_class_scores": (op7_class_scores, None),
    "op8_secret_scan": (op8_secret_scan, secrets.ORACLE_SQL),
    "op9_quality_rules": (op9_quality_rules, None),
    "op10_url_filters": (op10_url_filters, urls.ORACLE_SQL),
    "op10_weighted_url_filters": (op10_weighted_url_filters, urls.WEIGHTED_SQL),
    "op11_embedding_dedup": (op11_embedding_dedup, OP11_SQL),
    "op12_source_divergence": (op12_source_divergence, OP12_SQL),
    "op13_importance_resampling": (op13_importance_resampling, None),
}
