"""Time-ordered splits, balancing and their audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewloom.operators.order_stats import dense_number
from reviewloom.operators.sampling import class_needs
from reviewloom.operators.time_split import cutoffs, time_split
from reviewloom.plans import splits as S
from reviewloom.registry import views as V
from reviewloom.registry.views import r6
from reviewloom.session import shared_dir
from reviewloom.sources.readers import read_splits
from reviewloom.streaming.streams import dedupe_stream, ingest_stream, write_stream
from reviewloom.plans.warehouse import read_warehouse, warehouse_totals

TRAIN, VAL = 0.70, 0.15
BOUNDS = (f"floor(n * {TRAIN}::DOUBLE) AS b1, floor(n * {TRAIN + VAL!r}::DOUBLE) AS b2")


def split_ctes(source: str = "rv", order: str = "review_date, id") -> list[str]:
    return [
        f"""ps AS (
  SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS pos, count(*) OVER () AS n
  FROM {source} WHERE review_date IS NOT NULL)""",
        f"""sp AS (
  SELECT * EXCLUDE (pos, n, b1, b2),
    CASE WHEN pos < b1 THEN 'train' WHEN pos < b2 THEN 'val' ELSE 'test' END AS split
  FROM (SELECT *, {BOUNDS} FROM ps))""",
    ]


BALANCE_CTES = [
    """sz AS (
  SELECT split, sentiment, count(*) AS size,
    max(count(*)) OVER (PARTITION BY split) - count(*) AS need,
    CASE split WHEN 'train' THEN 42 WHEN 'val' THEN 43 ELSE 44 END AS seed
  FROM sp GROUP BY 1, 2)""",
    """dr AS (
  SELECT split, sentiment, CAST('0x' || md5(seed || '|' || sentiment || '|' || k)[1:15] AS BIGINT)
    % size AS ordinal
  FROM (SELECT *, unnest(range(need)) AS k FROM sz WHERE need > 0))""",
    "cp AS (SELECT split, sentiment, ordinal, count(*) AS extra FROM dr GROUP BY ALL)",
    """nr AS (
  SELECT *, row_number() OVER (PARTITION BY split, sentiment ORDER BY id) - 1 AS ordinal FROM sp)""",
    """ov AS (
  SELECT nr.* EXCLUDE (ordinal), unnest(range(coalesce(extra, 0) + 1)) AS copy_no
  FROM nr LEFT JOIN cp USING (split, sentiment, ordinal))""",
]


def S_(sql: str) -> str:
    return V.with_reviews(sql, *split_ctes())


def B_(sql: str) -> str:
    return V.with_reviews(sql, *split_ctes(), *BALANCE_CTES)


def balanced(spark, sf):
    return S.make_splits(V.reviews(spark, sf))


def cut(spark, sf, boundary="row"):
    return time_split(V.reviews(spark, sf), boundary=boundary).select("review_id", "split")


DATE_SQL = """, ct AS (
  SELECT max(review_date) FILTER (split = 'train') AS c1,
    max(review_date) FILTER (split <> 'test') AS c2 FROM sp)
SELECT review_id, CASE WHEN review_date <= c1 THEN 'train' WHEN review_date <= c2 THEN 'val'
  ELSE 'test' END AS split FROM sp, ct"""


def ordinals(spark, sf):
    cols = V.reviews(spark, sf).select("id", "review_id", "sentiment")
    out = dense_number(cols, ["id"], "ordinal", by=["sentiment"])
    return out.select("review_id", "sentiment", "ordinal")


def needs(spark, sf):
    rows = time_split(V.reviews(spark, sf))
    return class_needs(rows, "sentiment", ["split"])


def copies(spark, sf):
    return balanced(spark, sf).select("review_id", "split", "sentiment", "copy_no")


def whole_rows(spark, sf):
    """Copies are whole rows: text and all other columns come along."""
    return balanced(spark, sf).groupBy("split", "sentiment").agg(
        F.count("*").alias("n"), F.count_if(F.col("copy_no") == 0).alias("originals"),
        F.sum("review_length").alias("chars"), F.sum(F.length("review_text")).alias("text_chars"),
    )


def shuffle_keys(spark, sf):
    rows = S.make_splits(V.reviews(spark, sf), stratified=False)
    return S.shuffled(rows).select("sample_id", "shuffle_key")


def summary(spark, sf):
    rows = time_split(V.reviews(spark, sf))
    return r6(S.split_summary(rows, S.balance(rows)))


SUMMARY_SQL = """, rw AS (
  SELECT split, count(*) AS n_raw, min(review_date) AS first_date, max(review_date) AS last_date
  FROM sp GROUP BY 1),
af AS (
  SELECT split, count(*) AS n, count(*) FILTER (sentiment = 'positive') AS positive,
    count(*) FILTER (sentiment = 'neutral') AS neutral,
    count(*) FILTER (sentiment = 'negative') AS negative,
    count(*) FILTER (sentiment = 'unrated') AS unrated FROM ov GROUP BY 1)
SELECT split, n_raw, n, first_date, last_date, positive, neutral, negative, unrated,
  round(n_raw * 100.0::DOUBLE / sum(n_raw) OVER (), 6) AS pct_raw,
  round(n * 100.0::DOUBLE / sum(n_raw) OVER (), 6) AS pct_of_raw_total,
  CAST(sum(n_raw) OVER () < 100 AS INTEGER) AS small
FROM rw JOIN af USING (split)"""


def run_row(spark, sf):
    """The audit row of a split of the warehouse, from written files."""
    out = shared_dir(spark, "splits")
    row = S.split_dataset(spark, V.load_root(spark, sf), out)
    return row.select("label_method", "cutoff_train", "cutoff_val", "train_ratio", "val_ratio",
                      "test_ratio", "n_total", "n_train", "n_val", "n_test", "dist_train",
                      "stratified", "random_seed")


JSON_SQL = """(SELECT '{"positive":' || count(*) FILTER (sentiment = 'positive') || ',"neutral":'
  || count(*) FILTER (sentiment = 'neutral') || ',"negative":'
  || count(*) FILTER (sentiment = 'negative') || ',"unrated":'
  || count(*) FILTER (sentiment = 'unrated') || '}' FROM ov WHERE split = 'train')"""
RUN_SQL = V.with_load(
    f"""SELECT 'star_rule' AS label_method,
  (SELECT max(review_date) FROM sp WHERE split = 'train') AS cutoff_train,
  (SELECT max(review_date) FROM sp WHERE split = 'val') AS cutoff_val,
  0.7::DOUBLE AS train_ratio, 0.15::DOUBLE AS val_ratio, 0.15::DOUBLE AS test_ratio,
  (SELECT count(*) FROM sp) AS n_total, count(*) FILTER (split = 'train') AS n_train,
  count(*) FILTER (split = 'val') AS n_val, count(*) FILTER (split = 'test') AS n_test,
  {JSON_SQL} AS dist_train, 1 AS stratified, 42 AS random_seed
FROM ov""",
    "lb AS (SELECT *, row_number() OVER (ORDER BY platform_key = 'apple', doc_id) AS id "
    "FROM labelled)",
    *split_ctes("lb"), *BALANCE_CTES,
)


def splits_on_disk(spark, sf):
    out = shared_dir(spark, "split-table")
    S.write_splits(S.make_splits(V.reviews(spark, sf), stratified=False), out)
    return read_splits(spark, out).select("review_id", "split", "sentiment",
                                          F.md5("review_text").alias("text_md5"))


# --- streams -------------------------------------------------------------------------------


def stream_of(spark, sf, page, repeat):
    """Two pages in the order of the rows' numbers, the second as a batch of its own."""
    path = shared_dir(spark, "pages")
    page.write.parquet(path)
    first = len(spark.read.schema(page.schema).parquet(path).inputFiles())
    repeat.write.mode("append").parquet(path)
    return spark.readStream.schema(page.schema).option("maxFilesPerTrigger", first).parquet(path)


def deduped_stream(spark, sf):
    """Whole first records; those of the second page have another text and come too late."""
    page = V.raw(spark, sf)
    repeat = page.withColumn("review", F.concat(F.lit("changed "), F.col("review")))
    out, check = shared_dir(spark, "deduped"), shared_dir(spark, "state")
    stream = stream_of(spark, sf, page, repeat)
    write_stream(dedupe_stream(stream, order=["doc_id"]), out, check).awaitTermination()
    return spark.read.parquet(out).withColumn("review_md5", F.md5("review")).drop("review")


def loaded_stream(spark, sf):
    """A stream of cleaned rows into a new warehouse; the repeated page adds nothing."""
    page = V.load_rows(spark, sf).orderBy("doc_id").drop("doc_id", "platform_key")
    root, check = shared_dir(spark, "stream-db"), shared_dir(spark, "state")
    stream = stream_of(spark, sf, page, page)
    ingest_stream(stream, root, "googleplay", check).awaitTermination()
    return warehouse_totals(read_warehouse(spark, root))


STREAM_SQL = """SELECT 'reviews' AS metric, count(DISTINCT review_id) AS n FROM valid
UNION ALL SELECT 'apps', count(DISTINCT app_name) FROM valid
UNION ALL SELECT 'users', count(DISTINCT username) FROM valid
UNION ALL SELECT 'sentiment_labels', count(*) FROM (
  SELECT sentiment FROM valid
  QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY doc_id) = 1)
WHERE sentiment IN ('positive', 'neutral', 'negative', 'unrated')"""


QUERIES = {
    "time_split": (cut, S_("SELECT review_id, split FROM sp")),
    "time_split_by_date": (lambda s, d: cut(s, d, "date"), S_("").rstrip() + DATE_SQL),
    "cutoffs": (lambda s, d: cutoffs(time_split(V.reviews(s, d))), S_(
        "SELECT max(review_date) FILTER (split = 'train') AS cutoff_train, "
        "max(review_date) FILTER (split = 'val') AS cutoff_val FROM sp")),
    "class_ordinals": (ordinals, V.with_reviews(
        "SELECT review_id, sentiment, row_number() OVER (PARTITION BY sentiment ORDER BY id) - 1 "
        "AS ordinal FROM rv")),
    "class_needs": (needs, B_("SELECT split, sentiment, size, need FROM sz")),
    "oversample": (copies, B_("SELECT review_id, split, sentiment, copy_no FROM ov")),
    "oversample_rows": (whole_rows, B_(
        """SELECT split, sentiment, count(*) AS n, count(*) FILTER (copy_no = 0) AS originals,
  CAST(sum(review_length) AS BIGINT) AS chars, CAST(sum(length(review_text)) AS BIGINT) AS text_chars
FROM ov GROUP BY 1, 2""")),
    "shuffle_order": (shuffle_keys, S_(
        """SELECT review_id || '#0' AS sample_id, md5(
  CASE split WHEN 'train' THEN 42 WHEN 'val' THEN 43 ELSE 44 END || '|' || review_id || '#0')
  AS shuffle_key FROM sp""")),
    "split_summary": (summary, B_("").rstrip() + SUMMARY_SQL),
    "split_run": (run_row, RUN_SQL),
    "read_splits": (splits_on_disk, S_(
        "SELECT review_id, split, sentiment, md5(review_text) AS text_md5 FROM sp")),
    "dedupe_stream": (deduped_stream, V.with_raw(
        "SELECT raw.* EXCLUDE (review), md5(review) AS review_md5 FROM raw "
        "QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY doc_id) = 1")),
    "ingest_stream": (loaded_stream, V.with_load(STREAM_SQL)),
}
