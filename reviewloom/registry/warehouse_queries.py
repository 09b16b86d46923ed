"""Load, joins and audits of the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewloom.operators import audit as A
from reviewloom.operators.tables import stored
from reviewloom.plans import warehouse as W
from reviewloom.registry import views as V
from reviewloom.schemas import PLATFORM_NAMES, WAREHOUSE
from reviewloom.session import shared_dir
from reviewloom.sources.readers import POSITION

L = V.with_load
PLATFORM = "googleplay"


def on_warehouse(operator, *args, **kwargs):
    return lambda spark, sf: operator(V.warehouse(spark, sf), *args, **kwargs)


def positioned(spark, sf):
    """Rows to load with their input position, without going through files."""
    return V.load_rows(spark, sf).withColumns({
        "_source": (F.col("platform_key") == "apple").cast("int"),
        "_file": F.lit(""),
        "_row": F.col("doc_id"),
    })


def valid_rows(spark, sf):
    return W.normalise_row(W.validate(positioned(spark, sf))).filter(
        F.col("reject_reason").isNull()
    )


def base_table(wh):
    return W.analysis_base(wh).withColumn("review_text", F.md5("review_text"))


def split_base(wh, **filters):
    return W.load_labelled(wh, **filters).withColumn("review_text", F.md5("review_text")).drop("id")


BASE_COLS = "review_id, star_rating, review_date, md5(review_text) AS review_text, review_length, word_count"
SPLIT_COLS = ("review_id, app_name, platform_key, star_rating, review_date, md5(review_text) AS "
              "review_text, review_length, word_count, title, sentiment, "
              "'star_rule' AS label_method")


def new_users(spark, sf):
    """Users of the apple rows that the googleplay rows do not have, whatever the platform."""
    rows = W.numbered_position(valid_rows(spark, sf))
    google = rows.filter(F.col("platform_key") == "googleplay")
    stored = google.select("username").distinct().withColumn("id", F.lit(0).cast("long"))
    incoming = rows.filter(F.col("platform_key") == "apple")
    return W.upsert_dim(stored, incoming, ["username"], ["_pos"]).select("username")


NEW_USERS_SQL = """SELECT DISTINCT username FROM valid WHERE platform_key = 'apple'
  AND username NOT IN (SELECT username FROM valid WHERE platform_key = 'googleplay')"""


def new_reviews(spark, sf):
    """The apple rows as a second load after the googleplay rows. Their columns besides the text are
    stored first, so that the texts are read, checked and hashed once."""
    valid = valid_rows(spark, sf).select("review_id", "app_name", "username", "star_rating",
                                         "review_date", "platform_key", *POSITION)
    rows = W.numbered_position(stored(valid, "valid"))
    google = F.col("platform_key") == "googleplay"
    return W.insert_new(rows.filter(google), rows.filter(~google), "review_id", ["_pos"]).select(
        "review_id", "app_name", "username", "star_rating", "review_date"
    )


NEW_REVIEWS_SQL = """SELECT review_id, app_name, username, star_rating, review_date FROM valid
WHERE platform_key = 'apple'
  AND review_id NOT IN (SELECT review_id FROM valid WHERE platform_key = 'googleplay')
QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY doc_id) = 1"""


def resolved(wh):
    """Surrogate keys back to names, to show that they were resolved to the right rows."""
    r = wh["reviews"].select("review_id", "app_fk", "user_fk", "platform_fk")
    a = wh["apps"].select(F.col("id").alias("app_fk"), "app_name",
                          F.col("platform_fk").alias("app_platform"))
    u = wh["users"].select(F.col("id").alias("user_fk"), "username",
                           F.col("platform_fk").alias("user_platform"))
    p = wh["platforms"].select(F.col("id").alias("platform_fk"), "platform_key")
    same = (F.col("app_platform") == F.col("platform_fk")) & (
        F.col("user_platform") == F.col("platform_fk"))
    joined = r.join(a, "app_fk").join(u, "user_fk")
    return joined.join(F.broadcast(p), "platform_fk").select(
        "review_id", "app_name", "username", "platform_key", same.cast("int").alias("consistent")
    )


def label_rows(wh):
    r = wh["reviews"].select(F.col("id").alias("review_fk"), "review_id")
    return wh["sentiment_labels"].join(r, "review_fk").select(
        "review_id", "sentiment", "label_method"
    )


def dimensions(wh):
    p = wh["platforms"].select(F.col("id").alias("platform_fk"), "platform_key", "display_name")
    apps = wh["apps"].select(F.lit("app").alias("kind"), F.col("app_name").alias("name"),
                             "platform_fk")
    users = wh["users"].select(F.lit("user").alias("kind"), F.col("username").alias("name"),
                               "platform_fk")
    return apps.unionByName(users).join(F.broadcast(p), "platform_fk").drop("platform_fk")


def ids_are_dense(wh):
    """Surrogate keys start at 1 and have no gaps."""
    out = None
    for table in ("platforms", "apps", "users", "reviews", "sentiment_labels"):
        one = wh[table].agg(
            F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high"),
            F.countDistinct("id").alias("ids"),
        ).select(F.lit(table).alias("metric"),
                 ((F.col("low") == 1) & (F.col("high") == F.col("n"))
                  & (F.col("ids") == F.col("n"))).cast("int").alias("dense"))
        out = one if out is None else out.unionByName(one)
    return out


def outcome(spark, sf):
    none = spark.createDataFrame([], WAREHOUSE["reviews"])
    return W.load_outcome(none, V.load_rows(spark, sf))


OUTCOME_SQL = """SELECT count(*) AS rows_in_file,
  count(DISTINCT review_id) FILTER (reject_reason IS NULL) AS rows_inserted,
  count(*) FILTER (reject_reason IS NULL)
    - count(DISTINCT review_id) FILTER (reject_reason IS NULL) AS rows_skipped,
  count(*) FILTER (reject_reason IS NOT NULL) AS rows_rejected,
  count(*) FILTER (reject_reason = 'no_id') AS empty_id,
  count(*) FILTER (reject_reason = 'no_text') AS empty_text,
  count(*) FILTER (reject_reason = 'bad_star') AS bad_star
FROM typed"""


def after_a_first_load(spark, sf):
    """The ids that a load of the googleplay rows stores, and the apple rows after it."""
    rows = V.load_rows(spark, sf)
    google = F.col("platform_key") == "googleplay"
    stored = W.normalise_row(W.validate(rows.filter(google))).filter("reject_reason IS NULL")
    return stored.select("review_id").distinct(), rows.filter(~google)


_SECOND = """FROM (SELECT *, review_id IN (
    SELECT review_id FROM valid WHERE platform_key = 'googleplay') AS known
  FROM typed WHERE platform_key = 'apple')"""
SECOND_SQL = f"""SELECT count(*) AS rows_in_file,
  count(DISTINCT review_id) FILTER (reject_reason IS NULL AND NOT known) AS rows_inserted,
  count(*) FILTER (reject_reason IS NULL)
    - count(DISTINCT review_id) FILTER (reject_reason IS NULL AND NOT known) AS rows_skipped,
  count(*) FILTER (reject_reason IS NOT NULL) AS rows_rejected,
  count(*) FILTER (reject_reason = 'no_id') AS empty_id,
  count(*) FILTER (reject_reason = 'no_text') AS empty_text,
  count(*) FILTER (reject_reason = 'bad_star') AS bad_star
{_SECOND}"""
SECOND_DRY_SQL = f"""SELECT rows_in_file, rows_in_file - rows_rejected AS rows_valid, rows_rejected,
  rows_skipped AS projected_duplicates FROM ({SECOND_SQL})"""


def dry(spark, sf):
    none = spark.createDataFrame([], WAREHOUSE["reviews"])
    return W.dry_run(none, V.load_rows(spark, sf))


DRY_SQL = """SELECT count(*) AS rows_in_file,
  count(*) FILTER (reject_reason IS NULL) AS rows_valid,
  count(*) FILTER (reject_reason IS NOT NULL) AS rows_rejected,
  count(*) FILTER (reject_reason IS NULL)
    - count(DISTINCT review_id) FILTER (reject_reason IS NULL) AS projected_duplicates
FROM typed"""


def runs(wh):
    return wh["ingestion_runs"].select(
        "platform_key", "rows_in_file", "rows_inserted", "rows_skipped", "rows_rejected",
        "rows_unlabelled", "status",
    )


RUNS_SQL = """SELECT platform_key, count(*) AS rows_in_file, max(s.n) AS rows_inserted,
  count(*) FILTER (reject_reason IS NULL) - max(s.n) AS rows_skipped,
  count(*) FILTER (reject_reason IS NOT NULL) AS rows_rejected,
  max(s.u) AS rows_unlabelled, 'success' AS status
FROM typed JOIN (
  SELECT platform_key, count(*) AS n, count(*) FILTER (sentiment = 'mixed') AS u
  FROM stored GROUP BY 1) s USING (platform_key)
GROUP BY 1"""


def full_load(spark, sf):
    """A load from files into a new warehouse."""
    base = shared_dir(spark, "load")
    sources = V.load_files(spark, sf, f"{base}/in")
    W.ingest(spark, sources, f"{base}/db", fmt="parquet")
    return W.warehouse_totals(W.read_warehouse(spark, f"{base}/db"))


def second_load(spark, sf):
    """The same files once more: everything valid is skipped."""
    base = shared_dir(spark, "reload")
    sources = V.load_files(spark, sf, f"{base}/in")
    for _ in range(2):
        W.ingest(spark, sources, f"{base}/db", fmt="parquet")
    wh = W.read_warehouse(spark, f"{base}/db")
    return runs(wh).groupBy("platform_key").agg(
        F.sum("rows_inserted").alias("inserted"), F.sum("rows_skipped").alias("skipped"),
        F.sum("rows_rejected").alias("rejected"),
    )


TOTALS_SQL = """SELECT 'reviews' AS metric, count(*) AS n FROM stored
UNION ALL SELECT 'apps', count(DISTINCT (app_name, platform_key)) FROM valid
UNION ALL SELECT 'users', count(DISTINCT (username, platform_key)) FROM valid
UNION ALL SELECT 'sentiment_labels', count(*) FROM labelled"""

SENTIMENT_SQL = (f"SELECT sentiment, count(*) AS n FROM labelled "
                 f"WHERE platform_key = '{PLATFORM}' GROUP BY 1")
STARS_SQL = (f"SELECT star_rating, count(*) AS n FROM stored WHERE platform_key = '{PLATFORM}' "
             "AND star_rating IS NOT NULL GROUP BY 1")
TOP_SQL = (f"SELECT app_name, count(*) AS n FROM stored WHERE platform_key = '{PLATFORM}' "
           "GROUP BY 1 ORDER BY n DESC, app_name LIMIT 10")
HEALTH_SQL = f"""SELECT 'totals' AS section, metric AS item, n FROM ({TOTALS_SQL})
UNION ALL SELECT 'sentiment', sentiment, n FROM ({SENTIMENT_SQL})
UNION ALL SELECT 'stars', CAST(star_rating AS VARCHAR), n FROM ({STARS_SQL})
UNION ALL SELECT 'top_apps', app_name, n FROM ({TOP_SQL})"""


def repeated_ids(spark, sf):
    rows = W.normalise_row(W.validate(positioned(spark, sf)))
    return A.unique_violations(rows, ["review_id"])


def unique_audit(wh):
    out = None
    for table, keys in W.UNIQUE_KEYS.items():
        one = A.unique_violations(wh[table], keys).agg(F.count("*").alias("violations")).select(
            F.lit(table).alias("metric"), "violations")
        out = one if out is None else out.unionByName(one)
    return out


def orphan_customers(spark, sf):
    """Customers of orders by nation: only every key that exists has a parent."""
    orders = V.table(spark, sf, "orders")
    customers = V.table(spark, sf, "customer").filter(F.col("c_acctbal") > 0)
    return A.fk_orphans(orders, customers, "o_custkey", "c_custkey")


def fk_audit(wh):
    out = None
    for child, key, parent in W.FOREIGN_KEYS:
        one = A.fk_orphans(wh[child], wh[parent], key).agg(F.count("*").alias("orphans")).select(
            F.lit(f"{child}.{key}").alias("metric"), "orphans")
        out = one if out is None else out.unionByName(one)
    return out


def rule_audit(spark, sf):
    """The rules of the review table over rows that have not been validated."""
    rows = W.normalise_row(W.validate(positioned(spark, sf)))
    rules = {
        "star_rating in 1..5": F.col("star_rating").between(1, 5),
        "review_id not empty": F.col("review_id") != "",
        "review_date present": F.col("review_date").isNotNull(),
        "sentiment allowed": F.col("sentiment").isin(V.ALLOWED),
    }
    return A.check_violations(rows, rules)


RULE_SQL = "\nUNION ALL ".join(
    f"SELECT '{name}' AS rule, count(*) FILTER (NOT coalesce({cond}, true)) AS violations FROM typed"
    for name, cond in {
        "star_rating in 1..5": "star_rating BETWEEN 1 AND 5",
        "review_id not empty": "review_id <> ''",
        "review_date present": "review_date IS NOT NULL",
        "sentiment allowed": "sentiment IN ('positive', 'neutral', 'negative', 'unrated')",
    }.items()
)


def rules_hold(wh):
    out = None
    for table, rules in W.check_rules().items():
        one = A.check_violations(wh[table], rules).select(
            F.concat(F.lit(f"{table}: "), F.col("rule")).alias("rule"), "violations")
        out = one if out is None else out.unionByName(one)
    return out


def broken(wh):
    """The warehouse with faults that follow from its rows: reviews of one star come twice, the
    second time with nine; anonymous users are missing; neutral labels are of an unknown kind; the
    loads of apple rows have an unknown state."""
    nine = wh["reviews"].filter("star_rating = 1").withColumn("star_rating", F.lit(9))
    kind = F.when(F.col("sentiment") == "neutral", "mixed").otherwise(F.col("sentiment"))
    state = F.when(F.col("platform_key") == "apple", "lost").otherwise(F.col("status"))
    return {
        **wh,
        "reviews": wh["reviews"].unionByName(nine),
        "users": wh["users"].filter("username <> 'anonymous'"),
        "sentiment_labels": wh["sentiment_labels"].withColumn("sentiment", kind),
        "ingestion_runs": wh["ingestion_runs"].withColumn("status", state),
    }


def faults(wh):
    """All audits of the broken warehouse, those that find something."""
    bad = broken(wh)
    unique = unique_audit(bad).select(
        F.concat(F.lit("unique "), F.col("metric")).alias("audit"), F.col("violations").alias("n"))
    orphans = fk_audit(bad).select(F.concat(F.lit("orphans "), F.col("metric")), "orphans")
    rules = rules_hold(bad).select("rule", "violations")
    return unique.unionAll(orphans).unionAll(rules).filter("n > 0")


FAULTS_SQL = """SELECT 'unique reviews' AS audit, count(*) AS n FROM stored WHERE star_rating = 1
UNION ALL SELECT 'reviews: star_rating in 1..5', count(*) FROM stored WHERE star_rating = 1
UNION ALL SELECT 'orphans reviews.user_fk', count(DISTINCT platform_key) FROM stored
  WHERE username = 'anonymous'
UNION ALL SELECT 'sentiment_labels: sentiment allowed', count(*) FROM labelled
  WHERE sentiment = 'neutral'
UNION ALL SELECT 'ingestion_runs: status allowed', 1"""


def zero_sql(names: list[str], key: str, value: str) -> str:
    return f"SELECT unnest({names!r}) AS {key}, 0::BIGINT AS {value}"


HOLD_NAMES = [
    "reviews: star_rating in 1..5", "reviews: review_id present", "reviews: review_text present",
    "reviews: review_length present", "reviews: word_count present",
    "sentiment_labels: sentiment allowed", "sentiment_labels: sentiment present",
    "sentiment_labels: label_method present", "ingestion_runs: status allowed",
]
NAMES_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PLATFORM_NAMES.items())

QUERIES = {
    "analysis_base": (on_warehouse(base_table), L(
        f"SELECT {BASE_COLS}, sentiment, username FROM labelled")),
    "load_labelled": (on_warehouse(split_base), L(
        f"SELECT {SPLIT_COLS} FROM labelled WHERE review_date IS NOT NULL")),
    "load_labelled_filtered": (
        on_warehouse(split_base, platform="apple", app="src3", label_method="star_rule"), L(
            f"SELECT {SPLIT_COLS} FROM labelled WHERE review_date IS NOT NULL "
            "AND platform_key = 'apple' AND app_name = 'src3'")),
    "platform_sentiment": (on_warehouse(W.platform_sentiment, PLATFORM), L(SENTIMENT_SQL)),
    "platform_stars": (on_warehouse(W.platform_stars, PLATFORM), L(STARS_SQL)),
    "top_apps": (on_warehouse(W.top_apps, PLATFORM), L(TOP_SQL)),
    "health": (on_warehouse(W.health, PLATFORM), L(HEALTH_SQL)),
    "warehouse_totals": (on_warehouse(W.warehouse_totals), L(TOTALS_SQL)),
    "upsert_dim": (new_users, L(NEW_USERS_SQL)),
    "dimensions": (on_warehouse(dimensions), L(
        f"""SELECT DISTINCT kind, name, platform_key, CASE platform_key {NAMES_CASE} END
  AS display_name FROM (
  SELECT 'app' AS kind, app_name AS name, platform_key FROM valid
  UNION ALL SELECT 'user', username, platform_key FROM valid)""")),
    "insert_new": (new_reviews, L(NEW_REVIEWS_SQL)),
    "resolve_fk": (on_warehouse(resolved), L(
        "SELECT review_id, app_name, username, platform_key, 1 AS consistent FROM stored")),
    "insert_labels": (on_warehouse(label_rows), L(
        "SELECT review_id, sentiment, 'star_rule' AS label_method FROM labelled")),
    "assign_ids": (on_warehouse(ids_are_dense), zero_sql(
        ["platforms", "apps", "users", "reviews", "sentiment_labels"], "metric", "dense"
    ).replace("0::BIGINT", "1")),
    "load_outcome": (outcome, L(OUTCOME_SQL)),
    "load_dry_run": (dry, L(DRY_SQL)),
    "load_outcome_again": (
        lambda s, d: W.load_outcome(*after_a_first_load(s, d)), L(SECOND_SQL)),
    "load_dry_run_again": (lambda s, d: W.dry_run(*after_a_first_load(s, d)), L(SECOND_DRY_SQL)),
    "planted_faults": (on_warehouse(faults), L(FAULTS_SQL)),
    "ingestion_runs": (on_warehouse(runs), L(RUNS_SQL)),
    "ingest": (full_load, L(TOTALS_SQL)),
    "ingest_twice": (second_load, L(
        f"""SELECT platform_key, CAST(rows_inserted AS BIGINT) AS inserted,
  CAST(2 * rows_skipped + rows_inserted AS BIGINT) AS skipped,
  CAST(2 * rows_rejected AS BIGINT) AS rejected FROM ({RUNS_SQL})""")),
    "unique_violations": (repeated_ids, L(
        "SELECT review_id, count(*) AS n FROM typed GROUP BY 1 HAVING count(*) > 1")),
    "unique_audit": (on_warehouse(unique_audit), zero_sql(
        list(W.UNIQUE_KEYS), "metric", "violations")),
    "fk_orphans": (orphan_customers, """SELECT o_custkey AS key, count(*) AS n FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY 1"""),
    "fk_audit": (on_warehouse(fk_audit), zero_sql(
        [f"{c}.{k}" for c, k, _ in W.FOREIGN_KEYS], "metric", "orphans")),
    "check_violations": (rule_audit, L(RULE_SQL)),
    "check_audit": (on_warehouse(rules_hold), zero_sql(HOLD_NAMES, "rule", "violations")),
}
