"""Descriptive statistics, trends and tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewloom.operators import describe as D
from reviewloom.operators import hypothesis as H
from reviewloom.operators.order_stats import average_ranks, top_k, value_counts
from reviewloom.operators.sampling import sample_n
from reviewloom.registry import views as V
from reviewloom.registry.views import r6


def on_reviews(operator, *args, **kwargs):
    return lambda spark, sf: r6(operator(V.reviews(spark, sf), *args, **kwargs))


def on_chats(operator, *args, **kwargs):
    return lambda spark, sf: r6(operator(V.chats(spark, sf), *args, **kwargs))


R = V.with_reviews
THREE = "('positive', 'neutral', 'negative')"
PCT = "round(n * 100.0::DOUBLE / sum(n) OVER (), 6) AS pct"


def counts_sql(*names: str) -> str:
    return ", ".join(f"count(*) FILTER (sentiment = '{s}') AS {s}" for s in names)


def bins_sql(source: str, case: str, labels: list[str], with_pct: bool = True) -> str:
    pct = (", round(coalesce(n * 100.0::DOUBLE / (SELECT count(*) FROM {0}), 0), 6) AS pct"
           .format(source) if with_pct else "")
    return f"""SELECT position, l.label, coalesce(n, 0) AS n{pct}
FROM (SELECT unnest(range({len(labels)}))::INTEGER AS position, unnest({labels!r}) AS label) l
LEFT JOIN (SELECT {case} AS label, count(*) AS n FROM {source} GROUP BY 1) c USING (label)"""


WORD_CASE = """CASE WHEN word_count BETWEEN 1 AND 4 THEN '<5' WHEN word_count BETWEEN 5 AND 9
  THEN '5-9' WHEN word_count BETWEEN 10 AND 19 THEN '10-19' WHEN word_count > 19 THEN '20+' END"""
LENGTH_CASE = """CASE WHEN review_length BETWEEN 1 AND 9 THEN '0-9'
  WHEN review_length BETWEEN 10 AND 19 THEN '10-19' WHEN review_length BETWEEN 20 AND 49
  THEN '20-49' WHEN review_length BETWEEN 50 AND 99 THEN '50-99'
  WHEN review_length BETWEEN 100 AND 199 THEN '100-199'
  WHEN review_length BETWEEN 200 AND 500 THEN '200-500' END"""
USER_CASE = """CASE WHEN reviews = 1 THEN '1' WHEN reviews = 2 THEN '2'
  WHEN reviews BETWEEN 3 AND 5 THEN '3-5' WHEN reviews > 5 THEN '6+' END"""
WORDS = ["<5", "5-9", "10-19", "20+"]
LENGTHS = ["0-9", "10-19", "20-49", "50-99", "100-199", "200-500"]
USERS = ["1", "2", "3-5", "6+"]


def users_of_events(spark, sf):
    """Events give users with many rows."""
    events = V.table(spark, sf, "events").withColumnRenamed("user_id", "username")
    return D.user_frequency(events)


def user_groups(spark, sf):
    return D.user_frequency(V.reviews(spark, sf))


def users_per_platform(spark, sf):
    return D.user_frequency(V.reviews(spark, sf), ("username", "platform_key"))


HISTOGRAM_SQL = """, e AS (SELECT min(review_length) AS lo, max(review_length) AS hi FROM rv),
b AS (
  SELECT least(CAST(floor((review_length - lo)::DOUBLE * 50 / (hi - lo)) AS BIGINT) + 1, 50) AS bin
  FROM rv, e),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY 1)
SELECT bin, round(lo + (bin - 1) * ((hi - lo)::DOUBLE / 50), 6) AS low,
  round(lo + bin * ((hi - lo)::DOUBLE / 50), 6) AS high, coalesce(n, 0) AS n
FROM (SELECT unnest(range(1, 51)) AS bin) g LEFT JOIN c USING (bin), e"""

BOX_SQL = f"""SELECT sentiment, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  min(review_length) FILTER (ok) AS whisker_low, max(review_length) FILTER (ok) AS whisker_high,
  count(*) FILTER (NOT ok) AS outliers
FROM (
  SELECT rv.sentiment, review_length, q1, median, q3,
    review_length BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS ok
  FROM rv JOIN (
    SELECT sentiment, quantile_cont(review_length, 0.25) AS q1, median(review_length) AS median,
      quantile_cont(review_length, 0.75) AS q3 FROM rv GROUP BY 1) q USING (sentiment)
  WHERE sentiment IN {THREE})
GROUP BY ALL"""

DESCRIBE_SQL = "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS metric, round(avg({c}), 6) AS mean,
  round(quantile_cont({c}::DOUBLE, 0.5), 6) AS median, round(stddev_samp({c}), 6) AS std,
  CAST(min({c}) AS BIGINT) AS min, CAST(max({c}) AS BIGINT) AS max FROM rv"""
    for c in D.DESCRIBED
)

TREND_SQL = """, dd AS (SELECT review_date AS day, count(*) AS n FROM rv GROUP BY 1),
p AS (SELECT *, CAST(row_number() OVER (ORDER BY day) - 1 AS INTEGER) AS position FROM dd),
f AS (SELECT regr_slope(n, position) AS b, regr_intercept(n, position) AS a FROM p
  HAVING count(*) > 3)
SELECT day, n, position, round(b, 6) AS slope, round(a, 6) AS intercept,
  round(a + b * position, 6) AS fitted FROM p LEFT JOIN f ON true"""


def daily_events(spark, sf):
    events = V.table(spark, sf, "events").withColumn("day_", F.col("ts").cast("date"))
    return r6(D.daily_trend(events, "day_"))


LINE_SQL = """, f AS (
  SELECT regr_slope(review_length, word_count) AS b, regr_intercept(review_length, word_count) AS a,
    min(word_count) AS lo, max(word_count) AS hi FROM rv)
SELECT CAST(point AS INTEGER) AS point, round(lo + point * ((hi - lo) / 99.0::DOUBLE), 6) AS x,
  round(a + b * (lo + point * ((hi - lo) / 99.0::DOUBLE)), 6) AS y
FROM f, (SELECT unnest(range(100)) AS point)"""

CORR_SQL = "\nUNION ALL\n".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM rv"
    for a in D.CORRELATED for b in D.CORRELATED
)

RANK_CTES = """, ok AS (SELECT star_rating AS x, review_length AS y FROM rv
  WHERE star_rating IS NOT NULL),
rk AS (
  SELECT x, y,
    rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0::DOUBLE AS rx,
    rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0::DOUBLE AS ry
  FROM ok),
gs AS (SELECT x, count(*)::DOUBLE AS n, sum(ry) AS s FROM rk GROUP BY 1),
tt AS (SELECT sum(n * n * n - n) AS t FROM (SELECT count(*)::DOUBLE AS n FROM rk GROUP BY y)),
kw AS (
  SELECT sum(n) AS n, (12.0 / (sum(n) * (sum(n) + 1)) * sum(s * s / n) - 3 * (sum(n) + 1))
    / (1 - max(t) / (sum(n) ^ 3 - sum(n))) AS h
  FROM gs, tt HAVING count(*) = 5)"""

# two-sided tail of Student's t by the trapezoid rule, independent of the library's own formula
T_TAIL = """, tv AS (
  SELECT test, n, r, abs(r) * sqrt((n - 2) / (1 - r * r)) AS t, (n - 2)::DOUBLE AS v FROM rs),
dn AS (
  SELECT test, i, t / 20000 * i AS x, t / 20000 AS dx, v,
    exp(lgamma((v + 1) / 2) - lgamma(v / 2)) / sqrt(v * pi()) AS c
  FROM tv, (SELECT unnest(range(20001)) AS i)),
pv AS (
  SELECT test, greatest(1 - 2 * sum(
    CASE WHEN i IN (0, 20000) THEN 0.5 ELSE 1 END * dx * c * (1 + x * x / v) ^ (-(v + 1) / 2)), 0)
    AS p FROM dn GROUP BY 1)"""

P_TEXT = "CASE WHEN p < 0.001 THEN '< 0.001' ELSE '= ' || format('{:.4f}', p) END AS p"
CONCLUDE = "CASE WHEN p < 0.05 THEN 'significant' ELSE 'not significant' END AS conclusion"

REPORT_SQL = f"""{RANK_CTES},
rs AS (
  SELECT 'spearman_star_length' AS test, count(*)::DOUBLE AS n, corr(rx, ry) AS r FROM rk
  UNION ALL SELECT 'pearson_length_words', count(*), corr(review_length, word_count) FROM rv)
{T_TAIL}
SELECT test, round(r, 6) AS statistic, {P_TEXT}, {CONCLUDE} FROM pv JOIN rs USING (test)
UNION ALL
SELECT test, round(h, 6), {P_TEXT}, {CONCLUDE}
FROM (SELECT 'kruskal_length_by_star' AS test, h, exp(-h / 2) * (1 + h / 2) AS p FROM kw)"""


PEARSON_SQL = f""", rs AS (
  SELECT 'one' AS test, count(*)::DOUBLE AS n, corr(review_length, word_count) AS r FROM rv)
{T_TAIL}
SELECT CAST(n AS BIGINT) AS n, round(r, 6) AS statistic, round(p, 6) AS p_value
FROM rs JOIN pv USING (test)"""

SPEARMAN_SQL = f"""{RANK_CTES},
rs AS (SELECT 'one' AS test, count(*)::DOUBLE AS n, corr(rx, ry) AS r FROM rk)
{T_TAIL}
SELECT CAST(n AS BIGINT) AS n, (SELECT count(*) FROM rv WHERE star_rating IS NULL) AS dropped,
  round(r, 6) AS statistic, round(p, 6) AS p_value
FROM rs JOIN pv USING (test)"""

PARTS_SQL = f""", ranked AS (
  SELECT lang, rank() OVER (PARTITION BY lang ORDER BY star_rating)
    + (count(*) OVER (PARTITION BY lang, star_rating) - 1) / 2.0::DOUBLE AS rx,
    rank() OVER (PARTITION BY lang ORDER BY word_count)
    + (count(*) OVER (PARTITION BY lang, word_count) - 1) / 2.0::DOUBLE AS ry
  FROM rv WHERE star_rating IS NOT NULL),
rs AS (
  SELECT lang AS test, count(*)::DOUBLE AS n, corr(rx, ry) AS r FROM ranked GROUP BY lang)
{T_TAIL}
SELECT test AS lang, CAST(n AS BIGINT) AS n, round(r, 6) AS statistic, round(p, 6) AS p_value
FROM rs JOIN pv USING (test)"""


def tested_parts(spark, sf):
    """The rank test within each language: few rows, so p is far from 0."""
    reviews, out = V.reviews(spark, sf), None
    for lang in ("de", "en", "es", "fr"):
        one = H.spearman_test(reviews.filter(F.col("lang") == lang), "star_rating", "word_count")
        one = one.select(F.lit(lang).alias("lang"), "n", "statistic", "p_value")
        out = one if out is None else out.unionAll(one)
    return r6(out)


def ranks(spark, sf):
    counts = value_counts(V.reviews(spark, sf), "review_length")
    return r6(average_ranks(counts).select("value", "n", "rank"))


KDE_SQL = """, ok AS (SELECT star_rating, review_length::DOUBLE AS v FROM rv
  WHERE star_rating IS NOT NULL),
st AS (
  SELECT star_rating, count(*) AS n, min(v) AS lo, max(v) AS hi,
    stddev_samp(v) * count(*) ** (-0.2::DOUBLE) AS bw, quantile_cont(v, 0.25) AS q1,
    quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
  FROM ok GROUP BY 1),
gr AS (
  SELECT *, lo - 2 * bw + point * ((hi - lo + 4 * bw) / 99) AS x
  FROM st, (SELECT unnest(range(100)) AS point) WHERE bw > 0)
SELECT star_rating, CAST(point AS INTEGER) AS point, round(x, 6) AS x,
  round(sum(exp(-0.5 * ((x - v) / bw) ** 2)) / (max(n) * max(bw) * sqrt(2 * pi())), 6) AS density,
  round(max(q1), 6) AS q1, round(max(median), 6) AS median, round(max(q3), 6) AS q3
FROM gr JOIN ok USING (star_rating) GROUP BY star_rating, point, x"""

ECDF_SQL = f"""SELECT DISTINCT sentiment, review_length AS value,
  round(cume_dist() OVER (PARTITION BY sentiment ORDER BY review_length), 6) AS cdf
FROM rv WHERE sentiment IN {THREE}"""

CURVE_SQL = "\nUNION ALL\n".join(
    f"SELECT {p} AS percentile, round(quantile_cont(review_length::DOUBLE, {p / 100}), 6) AS value "
    "FROM rv" for p in D.CURVE
)

CHECKLIST_SQL = """, u AS (SELECT username, count(*) AS n FROM rv GROUP BY 1),
s AS (
  SELECT count(*) AS n, count(*) FILTER (star_rating IS NULL) AS a,
    count(*) FILTER (review_length <= 5) AS b, count(*) FILTER (word_count < 5) AS c,
    count(*) FILTER (review_length = 500) AS d,
    date_diff('day', min(review_date), max(review_date)) AS e FROM rv),
m AS (SELECT count(*) AS users, count(*) FILTER (n > 1) AS multi FROM u)
SELECT unnest(['total_reviews', 'unique_users', 'null_star_rating', 'very_short', 'under_5_words',
    'at_500_chars', 'multi_review_users', 'date_span_days']) AS "check",
  unnest([n, users, a, b, c, d, multi, e]) AS value,
  unnest(['', '', CASE WHEN a = 0 THEN 'none' ELSE 'present' END,
    CASE WHEN b > 0 THEN 'low signal' ELSE '' END,
    format('{:.1f}', c * 100.0::DOUBLE / n) || '%', 'length limit', '', '']) AS note
FROM s, m"""


def gates(spark, sf):
    raw_rows = V.table(spark, sf, "documents").agg(F.count(F.lit(1)).alias("n")).scalar()
    return r6(D.quality_gates(V.reviews(spark, sf), raw_rows))


GATES_SQL = """, s AS (
  SELECT count(*)::DOUBLE AS n, count(*) FILTER (star_rating IS NULL)::DOUBLE AS a,
    count(*) - count(DISTINCT review_id) AS dup, count(*) FILTER (word_count < 5)::DOUBLE AS w,
    count(*) FILTER (sentiment = 'positive')::DOUBLE AS p,
    nullif(count(*) FILTER (sentiment = 'neutral'), 0)::DOUBLE AS u,
    (SELECT count(*) FROM documents) AS r FROM rv)
SELECT 'size' AS metric, n AS value, '>= 10000' AS target, CAST(n >= 10000 AS INTEGER) AS passed
  FROM s
UNION ALL SELECT 'retention_pct', round(n * 100 / r, 6), '>= 80', CAST(n * 100 / r >= 80 AS INTEGER) FROM s
UNION ALL SELECT 'null_star_pct', round(a * 100 / n, 6), '< 5', CAST(a * 100 / n < 5 AS INTEGER) FROM s
UNION ALL SELECT 'duplicate_ids', dup::DOUBLE, '= 0', CAST(dup = 0 AS INTEGER) FROM s
UNION ALL SELECT 'positive_per_neutral', round(p / u, 6), '< 10', CAST(p / u < 10 AS INTEGER) FROM s
UNION ALL SELECT 'under_5_words_pct', round(w * 100 / n, 6), '< 20', CAST(w * 100 / n < 20 AS INTEGER) FROM s"""

LENGTHS_SQL = """SELECT
  round(avg(review_length) FILTER (sentiment = 'positive'), 6) AS mean_length_positive,
  round(avg(review_length) FILTER (sentiment = 'neutral'), 6) AS mean_length_neutral,
  round(avg(review_length) FILTER (sentiment = 'negative'), 6) AS mean_length_negative,
  round(avg(review_length) FILTER (sentiment = 'negative')
    / avg(review_length) FILTER (sentiment = 'positive'), 6) AS negative_per_positive,
  round(count(*) FILTER (star_rating = 5) * 100.0::DOUBLE / count(star_rating), 6) AS pct_5_star,
  round(count(*) FILTER (star_rating = 1) * 100.0::DOUBLE / count(star_rating), 6) AS pct_1_star
FROM rv"""

HASH = "CAST('0x' || md5({0})[1:15] AS BIGINT)"


def sampled(spark, sf):
    """A sampling operator: its size is the feature."""
    return sample_n(V.reviews(spark, sf), 3000, 42, "review_id").select(
        "review_id", "word_count", "review_length", "sentiment"
    )


def most_active(spark, sf):
    events = V.table(spark, sf, "events").withColumn("username", F.col("user_id").cast("string"))
    return D.top_users(events)


QUERIES = {
    "star_distribution": (on_reviews(D.star_distribution), R(
        f"SELECT * FROM (SELECT star_rating, n, {PCT} FROM "
        "(SELECT star_rating, count(*) AS n FROM rv GROUP BY 1)) WHERE star_rating IS NOT NULL")),
    "sentiment_distribution": (on_reviews(D.sentiment_distribution), R(
        f"SELECT sentiment, n, {PCT} FROM "
        "(SELECT sentiment, count(*) AS n FROM rv GROUP BY 1)")),
    "word_count_tiers": (on_reviews(D.word_count_tiers), R(bins_sql("rv", WORD_CASE, WORDS))),
    "length_buckets": (on_reviews(D.length_buckets), R(bins_sql("rv", LENGTH_CASE, LENGTHS))),
    "length_buckets_chats": (on_chats(D.length_buckets),
                             V.with_chats(bins_sql("ch", LENGTH_CASE, LENGTHS))),
    "user_frequency": (user_groups, R(
        bins_sql("u", USER_CASE, USERS, False),
        "u AS (SELECT username, count(*) AS reviews FROM rv GROUP BY 1)")),
    "user_frequency_by_platform": (users_per_platform, R(
        bins_sql("u", USER_CASE, USERS, False),
        "u AS (SELECT username, platform_key, count(*) AS reviews FROM rv GROUP BY 1, 2)")),
    "user_frequency_events": (users_of_events, "WITH u AS (SELECT user_id, count(*) AS reviews "
                              "FROM events GROUP BY 1) " + bins_sql("u", USER_CASE, USERS, False)),
    "histogram": (on_reviews(D.histogram, "review_length", 50), R("").rstrip() + HISTOGRAM_SQL),
    "center": (on_reviews(D.center, "review_length"), R(
        "SELECT round(avg(review_length), 6) AS mean, "
        "round(quantile_cont(review_length::DOUBLE, 0.5), 6) AS median FROM rv")),
    "box_stats": (on_reviews(D.box_stats, "sentiment", "review_length",
                             ["positive", "neutral", "negative"]), R(BOX_SQL)),
    "describe": (on_reviews(D.describe), R(DESCRIBE_SQL)),
    "monthly_sentiment": (on_reviews(D.monthly_sentiment), R(
        f"SELECT strftime(review_date, '%Y-%m') AS month, "
        f"{counts_sql('positive', 'neutral', 'negative')} FROM rv GROUP BY 1")),
    "monthly_share": (on_reviews(D.monthly_share), R(
        f"""SELECT month, round(p * 100.0::DOUBLE / nullif(t, 0), 6) AS pct_positive,
  round(g * 100.0::DOUBLE / nullif(t, 0), 6) AS pct_negative FROM (
  SELECT strftime(review_date, '%Y-%m') AS month, count(*) FILTER (sentiment = 'positive') AS p,
    count(*) FILTER (sentiment = 'negative') AS g, count(*) FILTER (sentiment IN {THREE}) AS t
  FROM rv GROUP BY 1)""")),
    "monthly_star": (on_reviews(D.monthly_star), R(
        """SELECT strftime(review_date, '%Y-%m') AS month, round(avg(star_rating), 6) AS mean_star,
  count(star_rating) AS rated, round(avg(star_rating), 2) AS avg_star, count(*) AS n
FROM rv GROUP BY 1""")),
    "daily_counts": (on_reviews(D.daily_counts), R(
        "SELECT review_date AS day, count(*) AS n FROM rv GROUP BY 1")),
    "daily_trend": (on_reviews(D.daily_trend), R("").rstrip() + TREND_SQL),
    "daily_trend_events": (daily_events, "WITH rv AS (SELECT CAST(ts AS DATE) AS review_date "
                           "FROM events)" + TREND_SQL),
    "ols": (on_reviews(D.ols, "word_count", "review_length"), R(
        """SELECT round(regr_slope(review_length, word_count), 6) AS slope,
  round(regr_intercept(review_length, word_count), 6) AS intercept,
  min(word_count) AS x_min, max(word_count) AS x_max,
  CAST(regr_count(review_length, word_count) AS BIGINT) AS n FROM rv""")),
    "ols_line": (on_reviews(D.ols_line, "word_count", "review_length"),
                 R("").rstrip() + LINE_SQL),
    "corr_matrix": (on_reviews(D.corr_matrix), R(CORR_SQL)),
    "pearson_test": (on_reviews(H.pearson_test), R("").rstrip() + PEARSON_SQL),
    "spearman_test": (on_reviews(H.spearman_test), R("").rstrip() + SPEARMAN_SQL),
    "spearman_test_of_parts": (tested_parts, R("").rstrip() + PARTS_SQL),
    "kruskal_test": (on_reviews(H.kruskal, "star_rating", "review_length"), R(
        "").rstrip() + RANK_CTES + """
SELECT CAST(n AS BIGINT) AS n, round(h, 6) AS statistic,
  round(exp(-h / 2) * (1 + h / 2), 6) AS p_value FROM kw"""),
    "test_report": (on_reviews(H.test_report), R("").rstrip() + REPORT_SQL),
    "average_ranks": (ranks, R(
        """SELECT review_length AS value, count(*) AS n, round(max(rk), 6) AS rank FROM (
  SELECT review_length, rank() OVER (ORDER BY review_length)
    + (count(*) OVER (PARTITION BY review_length) - 1) / 2.0::DOUBLE AS rk FROM rv) GROUP BY 1""")),
    "group_kde": (on_reviews(H.group_kde), R("").rstrip() + KDE_SQL),
    "median_by_star": (on_reviews(D.median_by), R(
        "SELECT star_rating, round(quantile_cont(review_length::DOUBLE, 0.5), 6) AS median FROM rv "
        "WHERE star_rating IS NOT NULL GROUP BY 1")),
    "ecdf": (on_reviews(D.ecdf), R(ECDF_SQL)),
    "crosstab": (on_reviews(D.crosstab), R(
        f"SELECT star_rating, {counts_sql('positive', 'neutral', 'negative')} FROM rv "
        "WHERE star_rating IS NOT NULL GROUP BY 1")),
    "percentile_curve": (on_reviews(D.percentile_curve), R(CURVE_SQL)),
    "top_users": (on_reviews(D.top_users), R(
        """SELECT username, count(*) AS n, CASE WHEN count(*) >= 6 THEN 'high'
  WHEN count(*) >= 3 THEN 'medium' ELSE 'low' END AS tier
FROM rv GROUP BY 1 ORDER BY n DESC, username LIMIT 10""")),
    "top_users_events": (most_active, """SELECT CAST(user_id AS VARCHAR) AS username, count(*) AS n,
  CASE WHEN count(*) >= 6 THEN 'high' WHEN count(*) >= 3 THEN 'medium' ELSE 'low' END AS tier
FROM events GROUP BY 1 ORDER BY n DESC, username LIMIT 10"""),
    "top_k": (on_reviews(top_k, "app_name", 5), R(
        "SELECT app_name, count(*) AS n FROM rv GROUP BY 1 ORDER BY n DESC, app_name LIMIT 5")),
    "summary": (on_reviews(D.summary), R(
        f"""SELECT count(*) AS n, min(review_date) AS first_date, max(review_date) AS last_date,
  count(DISTINCT strftime(review_date, '%Y-%m')) AS months, round(avg(star_rating), 6) AS mean_star,
  round(avg(review_length), 6) AS mean_length, round(avg(word_count), 6) AS mean_words,
  {counts_sql('positive', 'neutral', 'negative', 'unrated')} FROM rv""")),
    "class_dist": (on_reviews(D.class_dist), R(
        """SELECT s.sentiment, count(rv.id) AS n
FROM (SELECT unnest(['positive', 'neutral', 'negative', 'unrated']) AS sentiment) s
LEFT JOIN rv USING (sentiment) GROUP BY 1""")),
    "quality_checklist": (on_reviews(D.quality_checklist), R("").rstrip() + CHECKLIST_SQL),
    "quality_gates": (gates, R("").rstrip() + GATES_SQL),
    "length_by_sentiment": (on_reviews(D.length_by_sentiment), R(LENGTHS_SQL)),
    "sample_n": (sampled, R(
        f"""SELECT review_id, word_count, review_length, sentiment FROM rv
ORDER BY {HASH.format("'42|' || review_id")}, review_id LIMIT 3000""")),
}
