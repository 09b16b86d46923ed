"""Sources, coercions, predicates and text functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.functions import columns as C
from reviewloom.functions.columns import NON_SPACE, SPACE, WORD
from reviewloom.functions.language import AFFIX, MARGIN, PRIOR, SAMPLES, UNIT, detect_language
from reviewloom.operators.audit import portable_fingerprint
from reviewloom.operators.cleaning import (
    clean,
    clean_audit,
    coerce_raw,
    failed_step,
    keep_language,
    min_words,
)
from reviewloom.operators.order_stats import first_per_key
from reviewloom.plans.warehouse import new_ids, normalise_row, validate
from reviewloom.registry import views as V
from reviewloom.registry.views import r6
from reviewloom.schemas import REQUIRED_COLUMNS
from reviewloom.session import shared_dir
from reviewloom.sources.readers import combine_sources, read_clean_reviews, read_raw_reviews
from reviewloom.sources.writers import write_reviews


def trim_sql(col: str) -> str:
    return f"regexp_replace({col}, '^{SPACE}+|{SPACE}+$', '', 'g')"


# --- sources -------------------------------------------------------------------------------


def read_raw(spark, sf):
    """Through JSON lines of store records."""
    base = shared_dir(spark, "json")
    write_reviews(V.records(spark, sf).drop("platform_key", "lang"), base, "json")
    return read_raw_reviews(spark, base, keep=["doc_id long"]).select(
        "doc_id", "review_id", "app_name", "user", "star_rating", "date",
        F.md5("review").alias("review_md5"),
    )


def _through_csv(spark, sf, platform):
    """Through real CSV files with quoted line breaks."""
    base = shared_dir(spark, "csv")
    rows = V.load_rows(spark, sf).filter(F.col("platform_key") == platform)
    write_reviews(rows.drop("doc_id", "platform_key"), base, "csv")
    df = read_clean_reviews(spark, base, platform)
    cols = [c for c in (*REQUIRED_COLUMNS, "title", "word_count", "platform_key")
            if c not in ("review",)]
    return df.select(*cols, F.md5("review").alias("review_md5"))


def read_clean(spark, sf):
    return _through_csv(spark, sf, "apple")


def read_clean_sources(spark, sf):
    """The files of every platform."""
    return reduce(DataFrame.unionByName, [_through_csv(spark, sf, p) for p in V.PLATFORMS])


def ingest_many(spark, sf):
    base = shared_dir(spark, "sources")
    sources = V.load_files(spark, sf, base)
    rows = combine_sources(spark, sources, fmt="parquet")
    return rows.groupBy("_source", "platform_key").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("review_id").alias("ids")
    ).withColumnRenamed("_source", "source_no")


def fingerprint(spark, sf):
    return portable_fingerprint(
        V.reviews(spark, sf), ["review_id", "review_date", "review_text", "star_rating", "title"]
    )


def _md5_parts(*cols):
    return " || '|' || ".join(f"coalesce('=' || CAST({c} AS VARCHAR), '0')" for c in cols)


FINGERPRINT_SQL = f"""SELECT count(*) AS rows,
  CAST(coalesce(sum(CAST('0x' || md5({_md5_parts('review_id', 'review_date', 'review_text',
  'star_rating', 'title')})[1:15] AS BIGINT)), 0) AS VARCHAR) AS sum_hash FROM rv"""


# --- coercions -----------------------------------------------------------------------------


def normalised(spark, sf):
    return normalise_row(validate(V.load_rows(spark, sf).withColumn("_row", F.col("doc_id")))) \
        .withColumn("review_md5", F.md5("review_text")) \
        .select(F.col("_row").alias("doc_id"), "platform_key", "review_id", "app_name", "username",
                "star_rating", "review_date", "review_md5", "review_length", "word_count", "title",
                "sentiment", "reject_reason")


def column_query(view, key, **exprs):
    """Key and derived columns of a view; expressions are functions, as a column needs a session."""
    def run(spark, sf):
        return r6(view(spark, sf).select(key, *[e().alias(n) for n, e in exprs.items()]))
    return run


NUMBER_SQL = """SELECT doc_id, CASE WHEN star_rating IN ('x', '') THEN NULL
  ELSE CAST(star_rating AS DOUBLE) END AS number FROM ld"""


def bins(spark, sf):
    return V.reviews(spark, sf).select(
        "review_id",
        C.cut("word_count", [0, 4, 9, 19, None], ["<5", "5-9", "10-19", "20+"]).alias("tier"),
        C.cut("review_length", [0, 99, 500], ["short", "medium"]).alias("size"),
    )


# --- cleaning ------------------------------------------------------------------------------

_SAMPLE_ROWS = ", ".join(
    "('{}', '{}')".format(k, v.replace("'", "''")) for k, v in sorted(SAMPLES.items()))


def _ends(words: str) -> str:
    """Beginnings and ends of the words of a list."""
    return f"""list_concat(
      list_transform({words}, lambda w: '<' || left(w, {AFFIX})),
      list_transform({words}, lambda w: '>' || right(w, {AFFIX})))"""


def lang_cte(name: str, source: str, key: str, text: str, prefer: str | None = None) -> str:
    """Language label per row. The model is fitted here again, from the sample texts."""
    letters, foreign = (f"length(regexp_replace(lower({text}), '{p}', '', 'g'))"
                        for p in (r"[^\p{L}]", r"[^\p{L}]|\p{Latin}"))
    label = "best.lang"
    if prefer:
        label = f"CASE WHEN best.score - own < {MARGIN} THEN '{prefer}' ELSE best.lang END"
    return f"""{name}_sample(lang, txt) AS (VALUES {_SAMPLE_ROWS}),
{name}_seen AS (
  SELECT lang, unnest({_ends("w")}) AS f
  FROM (SELECT lang, regexp_extract_all(lower(txt), '\\p{{L}}+') AS w FROM {name}_sample)),
{name}_n AS (SELECT lang, f, count(*) AS n FROM {name}_seen GROUP BY lang, f),
{name}_known AS (SELECT DISTINCT f, f[1] AS kind FROM {name}_n),
{name}_kind AS (SELECT kind, count(*) AS k FROM {name}_known GROUP BY kind),
{name}_total AS (SELECT lang, f[1] AS kind, count(*) AS t FROM {name}_seen GROUP BY lang, f[1]),
{name}_log AS (
  SELECT t.lang, g.f, ln((coalesce(n.n, 0) + {PRIOR}::DOUBLE) / (t.t + {PRIOR}::DOUBLE * k.k)) AS p
  FROM {name}_known g JOIN {name}_kind k USING (kind) JOIN {name}_total t USING (kind)
  LEFT JOIN {name}_n n ON n.lang = t.lang AND n.f = g.f),
{name}_model AS (
  SELECT lang, f, CAST(round((p - min(p) OVER (PARTITION BY f)) / {UNIT}::DOUBLE) AS INTEGER) AS score
  FROM {name}_log),
{name}_text AS (
  SELECT {key}, list_distinct(regexp_extract_all(lower({text}), '\\p{{L}}+')) AS w,
    2 * {foreign} > {letters} AS foreign_script FROM {source}),
{name}_shown AS (SELECT {key}, unnest(list_distinct({_ends("w")})) AS f FROM {name}_text),
{name}_score AS (
  SELECT {key}, lang, sum(score) AS score FROM {name}_shown JOIN {name}_model USING (f)
  GROUP BY {key}, lang),
{name}_best AS (
  SELECT {key}, max(score) FILTER (lang = '{prefer}') AS own,
    first(struct_pack(lang := lang, score := score) ORDER BY score DESC, lang) AS best
  FROM {name}_score GROUP BY {key}),
{name} AS (
  SELECT {key}, CASE WHEN foreign_script THEN 'other'
    WHEN coalesce(best.score, 0) = 0 THEN 'und' ELSE {label} END AS found
  FROM {name}_text LEFT JOIN {name}_best USING ({key}))"""


STEP_CTES = (
    lang_cte("lg", "raw", "doc_id", "review", "en"),
    """stepped AS (
  SELECT raw.*, found, CAST(try_strptime(date, '%Y-%m-%d') AS DATE) AS day,
    CASE WHEN star_rating = 'x' THEN NULL ELSE CAST(star_rating AS DOUBLE) END AS star,
    CASE WHEN try_strptime(date, '%Y-%m-%d') IS NULL THEN 'missing_date'
      WHEN review = '' THEN 'null_empty_review' WHEN length(review) < 3 THEN 'too_short'
      WHEN found NOT IN ('en', 'und') THEN 'non_english' END AS step
  FROM raw JOIN lg USING (doc_id))""",
)


def cleaned(spark, sf):
    out = clean(V.raw(spark, sf), ["doc_id"])
    return r6(out.select(
        "doc_id", "review_id", "app_name", "user", "star_rating", "date", "review_length",
        "word_count", "sentiment", F.md5("review").alias("review_md5"),
    ))


CLEAN_SQL = f"""SELECT doc_id, review_id, app_name, "user", round(star, 6) AS star_rating,
  day AS date, length(review) AS review_length, {V.words_sql('review')} AS word_count,
  {V.SENTIMENT_SQL.format('star')} AS sentiment, md5(review) AS review_md5
FROM stepped WHERE step IS NULL
QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY doc_id) = 1"""

AUDIT_SQL = """, s AS (
  SELECT count(*) AS total, count(*) FILTER (step = 'missing_date') AS d1,
    count(*) FILTER (step = 'null_empty_review') AS d2, count(*) FILTER (step = 'too_short') AS d3,
    count(*) FILTER (step = 'non_english') AS d4,
    count(*) FILTER (step IS NULL) - count(DISTINCT review_id) FILTER (step IS NULL) AS d5
  FROM stepped),
c AS (
  SELECT total, unnest([1, 2, 3, 4, 5]) AS step_no,
    unnest(['missing_date', 'null_empty_review', 'too_short', 'non_english', 'duplicate_id'])
      AS step,
    unnest([d1, d2, d3, d4, d5]) AS dropped,
    unnest([d1, d1 + d2, d1 + d2 + d3, d1 + d2 + d3 + d4, d1 + d2 + d3 + d4 + d5]) AS gone
  FROM s)
SELECT step_no, step, dropped, total - gone AS remaining,
  round((total - gone) * 100.0::DOUBLE / total, 6) AS retention_pct FROM c"""


def each_step(spark, sf):
    rows = coerce_raw(V.raw(spark, sf))
    return rows.groupBy(F.coalesce(failed_step(), F.lit("passed")).alias("step")).agg(
        F.count(F.lit(1)).alias("n")
    )


def language_filter(spark, sf):
    return keep_language(V.reviews(spark, sf), "en", "review_text").select("review_id", "lang")


def language(spark, sf):
    return V.reviews(spark, sf).groupBy(
        "lang", detect_language("review_text").alias("found")
    ).agg(F.count(F.lit(1)).alias("n"))


def first_rows(spark, sf):
    out = first_per_key(V.raw(spark, sf), ["review_id"], ["doc_id"])
    return out.select("review_id", "doc_id", "app_name", "user")


def unseen_ids(spark, sf):
    """Ids of the apple rows that no googleplay row has."""
    rows = V.load_rows(spark, sf)
    apple = F.col("platform_key") == "apple"
    return new_ids(rows.filter(apple), rows.filter(~apple))


def reasons(spark, sf):
    return validate(V.load_rows(spark, sf)).groupBy("reject_reason").agg(
        F.count(F.lit(1)).alias("n")
    )


# --- text ----------------------------------------------------------------------------------


def normal_sql(col: str) -> str:
    return (f"trim(regexp_replace(regexp_replace(lower({col}), "
            f"'http{NON_SPACE}+|www\\.{NON_SPACE}+', ' ', 'g'), '{SPACE}+', ' ', 'g'))")


def page_texts(spark, sf):
    """Pages hold addresses, question marks and mark-up."""
    return V.table(spark, sf, "pages")


def _text_measures(spark, sf):
    t = "html"
    return r6(page_texts(spark, sf).select(
        "page_id",
        C.literal_count(t, "!").alias("exclamations"),
        C.literal_count(t, "?").alias("questions"),
        C.literal_count(t, "...").alias("ellipses"),
        C.uppercase_ratio(t).alias("upper"),
        C.mean_word_length(t).alias("mean_word"),
        C.trim_space(t).alias("trimmed"),
        C.is_blank(t).cast("int").alias("blank"),
        F.length(t).alias("chars"),
    )).withColumn("trimmed", F.md5("trimmed"))


MEASURE_SQL = f"""SELECT page_id,
  CAST(length(html) - length(replace(html, '!', '')) AS INTEGER) AS exclamations,
  CAST(length(html) - length(replace(html, '?', '')) AS INTEGER) AS questions,
  CAST((length(html) - length(replace(html, '...', ''))) / 3 AS INTEGER) AS ellipses,
  round(length(regexp_replace(html, '[^\\p{{Lu}}]', '', 'g')) / greatest(length(html), 1)::DOUBLE, 6)
    AS upper,
  round(coalesce(length(regexp_replace(html, '{SPACE}+', '', 'g'))::DOUBLE
    / nullif({V.words_sql('html')}, 0), 0), 6) AS mean_word,
  md5({trim_sql('html')}) AS trimmed,
  CAST({trim_sql('html')} = '' AS INTEGER) AS blank, length(html) AS chars
FROM pages"""


def normal_text(spark, sf):
    return page_texts(spark, sf).select(
        "page_id", F.md5(C.normalise_text("html")).alias("normal_md5")
    )


def tokens(spark, sf):
    return V.reviews(spark, sf).select(
        "review_id",
        F.size(C.word_tokens(F.lower("review_text"))).alias("n"),
        F.md5(F.array_join(C.word_tokens(F.lower("review_text")), " ")).alias("tokens_md5"),
    )


def dates(spark, sf):
    o = V.table(spark, sf, "orders")
    return o.groupBy(C.month("o_orderdate").alias("month")).agg(
        F.max(F.datediff(F.col("o_orderdate"), F.lit("1992-01-01").cast("date"))).alias("days")
    )


def keyword_hits(spark, sf):
    words = ["the", "de la", "und"]
    return V.reviews(spark, sf).select("review_id", C.mentions("review_text", words).alias("hit"))


def class_json(spark, sf):
    by_app = V.reviews(spark, sf).groupBy("app_name").agg(
        F.count_if(F.col("sentiment") == "positive").alias("positive"),
        F.count_if(F.col("sentiment") == "negative").alias("negative"),
    )
    json = F.to_json(C.class_map({"positive": F.col("positive"), "negative": F.col("negative")}))
    return by_app.select("app_name", json.alias("dist"))


def null_flags(spark, sf):
    return V.reviews(spark, sf).groupBy(
        F.col("title").isNotNull().cast("int").alias("has_title"),
        F.coalesce("star_rating", F.lit(0)).alias("star"),
    ).agg(F.count(F.lit(1)).alias("n"),
          F.round(F.avg("review_length"), 1).alias("mean_1"),
          F.round(F.avg("word_count"), 2).alias("mean_2"))


QUERIES = {
    "read_raw_reviews": (read_raw, V.with_raw(
        'SELECT doc_id, review_id, app_name, "user", star_rating, date, md5(review) AS review_md5 '
        "FROM raw")),
    "read_clean_reviews": (read_clean, V.with_load(
        'SELECT review_id, app_name, "user", star_rating, date, review_length, sentiment, title, '
        "word_count, platform_key, md5(review) AS review_md5 FROM ld "
        "WHERE platform_key = 'apple'")),
    "read_clean_sources": (read_clean_sources, V.with_load(
        'SELECT review_id, app_name, "user", star_rating, date, review_length, sentiment, title, '
        "word_count, platform_key, md5(review) AS review_md5 FROM ld")),
    "ingest_many": (ingest_many, V.with_load(
        "SELECT CAST(platform_key = 'apple' AS INTEGER) AS source_no, platform_key, "
        "count(*) AS n, count(DISTINCT review_id) AS ids FROM ld GROUP BY 1, 2")),
    "fingerprint": (fingerprint, V.with_reviews(FINGERPRINT_SQL)),
    "to_number": (column_query(V.load_rows, "doc_id", number=lambda: C.to_number("star_rating")),
                  V.with_load(NUMBER_SQL)),
    "to_review_date": (column_query(V.load_rows, "doc_id", day=lambda: C.to_review_date("date")),
                       V.with_load("SELECT doc_id, CAST(try_strptime(date, '%Y-%m-%d') AS DATE) "
                                   "AS day FROM ld")),
    "to_int_trunc": (
        column_query(V.load_rows, "doc_id", star=lambda: C.to_int_trunc(C.to_number("star_rating"))),
        V.with_load("SELECT doc_id, star_rating AS star FROM typed")),
    "fill_counts": (
        column_query(V.load_rows, "doc_id", words=lambda: C.fill_count("word_count"),
                     length=lambda: C.fill_count("review_length")),
        V.with_load("SELECT doc_id, word_count AS words, review_length AS length FROM typed")),
    "normalise_row": (normalised, V.with_load(
        "SELECT doc_id, platform_key, review_id, app_name, username, star_rating, review_date, "
        "md5(review_text) AS review_md5, review_length, word_count, title, sentiment, "
        "reject_reason FROM typed")),
    "add_lengths": (
        column_query(lambda spark, sf: V.table(spark, sf, "documents"), "doc_id",
                     review_length=lambda: C.review_length("text"),
                     word_count=lambda: C.word_count("text")),
        f"SELECT doc_id, length(text) AS review_length, {V.words_sql('text')} AS word_count "
        "FROM documents"),
    "star_sentiment": (
        column_query(V.joined, "doc_id", sentiment=lambda: C.star_sentiment("star")),
        f"WITH {V.JOINED_SQL} SELECT doc_id, {V.SENTIMENT_SQL.format('star')} AS sentiment FROM j"),
    "month": (column_query(V.reviews, "review_id", month=lambda: C.month("review_date")),
              V.with_reviews("SELECT review_id, strftime(review_date, '%Y-%m') AS month FROM rv")),
    "platform_name": (
        column_query(V.reviews, "review_id",
                     display_name=lambda: C.platform_name("platform_key")),
        V.with_reviews("SELECT review_id, CASE platform_key WHEN 'apple' THEN 'Apple App Store' "
                       "ELSE 'Google Play' END AS display_name FROM rv")),
    "cut_bins": (bins, V.with_reviews(
        """SELECT review_id, CASE WHEN word_count > 0 AND word_count <= 4 THEN '<5'
  WHEN word_count > 4 AND word_count <= 9 THEN '5-9'
  WHEN word_count > 9 AND word_count <= 19 THEN '10-19' WHEN word_count > 19 THEN '20+' END AS tier,
  CASE WHEN review_length BETWEEN 1 AND 99 THEN 'short'
  WHEN review_length BETWEEN 100 AND 500 THEN 'medium' END AS size FROM rv""")),
    "clean": (cleaned, V.with_raw(CLEAN_SQL, *STEP_CTES)),
    "clean_audit": (lambda s, d: r6(clean_audit(V.raw(s, d))),
                    V.with_raw("", *STEP_CTES).rstrip() + AUDIT_SQL),
    "clean_steps": (each_step, V.with_raw(
        "SELECT coalesce(step, 'passed') AS step, count(*) AS n FROM stepped GROUP BY 1",
        *STEP_CTES)),
    "keep_language": (language_filter, V.with_reviews(
        "SELECT review_id, lang FROM rv JOIN lg USING (id) WHERE found IN ('en', 'und')",
        lang_cte("lg", "rv", "id", "review_text", "en"))),
    "detect_language": (language, V.with_reviews(
        "SELECT lang, found, count(*) AS n FROM rv JOIN lg USING (id) GROUP BY 1, 2",
        lang_cte("lg", "rv", "id", "review_text"))),
    "first_per_key": (first_rows, V.with_raw(
        'SELECT review_id, doc_id, app_name, "user" FROM raw '
        "QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY doc_id) = 1")),
    "new_ids": (unseen_ids, V.with_load(
        "SELECT DISTINCT review_id FROM ld WHERE platform_key = 'apple' AND review_id NOT IN "
        "(SELECT review_id FROM ld WHERE platform_key <> 'apple')")),
    "validate": (reasons, V.with_load(
        "SELECT reject_reason, count(*) AS n FROM typed GROUP BY 1")),
    "min_words": (lambda s, d: min_words(V.reviews(s, d)).select("review_id", "word_count"),
                  V.with_reviews("SELECT review_id, word_count FROM rv WHERE word_count >= 10")),
    "text_measures": (_text_measures, MEASURE_SQL),
    "normalise_text": (
        normal_text, f"SELECT page_id, md5({normal_sql('html')}) AS normal_md5 FROM pages"),
    "word_tokens": (tokens, V.with_reviews(
        f"SELECT review_id, len(t) AS n, md5(array_to_string(t, ' ')) AS tokens_md5 FROM "
        f"(SELECT review_id, regexp_extract_all(lower(review_text), '{WORD}{{2,}}') AS t FROM rv)")),
    "whole_word_match": (keyword_hits, V.with_reviews(
        "SELECT review_id, CAST(regexp_matches(lower(review_text), "
        f"'(^|[^\\p{{L}}\\p{{N}}_])(the|de la|und)($|[^\\p{{L}}\\p{{N}}_])') AS INTEGER) AS hit "
        "FROM rv")),
    "date_functions": (dates, """SELECT strftime(o_orderdate, '%Y-%m') AS month,
  CAST(max(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE))) AS INTEGER) AS days
FROM orders GROUP BY 1"""),
    "class_json": (class_json, V.with_reviews(
        """SELECT app_name, '{"positive":' || count(*) FILTER (sentiment = 'positive')
  || ',"negative":' || count(*) FILTER (sentiment = 'negative') || '}' AS dist
FROM rv GROUP BY 1""")),
    "null_handling": (null_flags, V.with_reviews(
        """SELECT CAST(title IS NOT NULL AS INTEGER) AS has_title, coalesce(star_rating, 0) AS star,
  count(*) AS n, round(avg(review_length), 1) AS mean_1, round(avg(word_count), 2) AS mean_2
FROM rv GROUP BY 1, 2""")),
}
