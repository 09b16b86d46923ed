import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from reviewloom.operators import describe as D
from reviewloom.operators import hypothesis as H
from reviewloom.operators.cleaning import clean, clean_audit
from reviewloom.operators.order_stats import dense_number, first_per_key, quantiles
from reviewloom.operators.tables import stored

RAW = [
    ("a1", "5", "2024-01-05", "Great app, love it!"),
    ("a2", "5", "", "the best of it"),
    ("a3", "4", "2024-01-05", "   "),
    ("a4", "4", "2024-01-06", "ok"),
    ("a5", "4", "2024-01-06", "le chat est dans la maison"),
    ("a1", "1", "2024-01-07", "the app is bad"),
    ("a7", "", "2024-01-08", "it is what it is"),
    ("a8", "3", "2024-01-08", "it is in the middle"),
    ("a9", "2", "2024-01-09", "Why??? the app is slow... see http://x.io/a"),
    ("a10", "5", "2024-01-09", "👍👍👍"),
    ("a1", "5", "2024-01-10", "le la les des"),
    ("a12", "x", "2024-13-40", "the end of it"),
]


@pytest.fixture(scope="module")
def raw(spark):
    data = [(i, r, "App", "u", s, d, t) for i, (r, s, d, t) in enumerate(RAW)]
    return spark.createDataFrame(
        data, "pos int, review_id string, app_name string, user string, star_rating string, "
        "date string, review string").repartition(3)


def test_clean(raw):
    got = rows(clean(raw, ["pos"]).select("review_id", "sentiment", "review_length", "word_count"))
    assert got == sorted([
        ("a1", "positive", 19, 4), ("a7", "unrated", 16, 5), ("a8", "neutral", 19, 5),
        ("a9", "negative", 43, 7), ("a10", "positive", 3, 1),
    ], key=str)


def test_clean_audit(raw):
    got = {r["step"]: (r["dropped"], r["remaining"]) for r in clean_audit(raw).collect()}
    assert got == {"missing_date": (2, 10), "null_empty_review": (1, 9), "too_short": (1, 8),
                   "non_english": (2, 6), "duplicate_id": (1, 5)}
    last = clean_audit(raw).orderBy(F.desc("step_no")).first()
    assert last["retention_pct"] == pytest.approx(5 / 12 * 100)


def test_first_per_key_with_a_hot_key(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") < 700, 0).otherwise(F.col("id")).alias("k"),
        (F.lit(999) - F.col("id")).alias("pos"), F.col("id").alias("v"))
    got = first_per_key(df, ["k"], ["pos"])
    assert got.count() == 301
    assert got.filter("k = 0").first()["v"] == 699


def test_first_per_key_of_nulls_taken_keys_and_places_of_two_columns(spark):
    df = spark.createDataFrame(
        [(None, 1, "b", "x"), (None, 1, "a", "y"), ("p", 2, "a", "z"), ("p", 1, "c", "w"),
         ("q", 0, "a", "v"), ("r", 5, "a", None)], "k string, s int, f string, v string")
    got = first_per_key(df, ["k"], ["s", "f"])
    assert got.columns == df.columns
    assert {r["v"] for r in got.collect()} == {"y", "w", "v", None}
    taken = spark.createDataFrame([("q", 1), (None, 2), ("t", 3)], "k string, other int")
    assert {r["v"] for r in first_per_key(df, ["k"], ["s", "f"], taken).collect()} == {"w", None}
    assert first_per_key(df.limit(0), ["k"], ["s", "f"]).collect() == []


def exchanged(df):
    """Columns of every exchange of a plan, and the plan's text."""
    plan = df._jdf.queryExecution().executedPlan()
    text = plan.toString()
    found, todo = [], [plan.initialPlan() if hasattr(plan, "initialPlan") else plan]
    while todo:
        node = todo.pop()
        if "Exchange" in node.nodeName():
            out = node.output()
            found.append([out.apply(i).name() for i in range(out.size())])
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return found, text


def test_texts_are_not_shuffled_for_first_rows(spark):
    raw = spark.createDataFrame(
        [(k, f"id{k % 40}", "app", "u", "5", "2024-01-05", "a great app " * 9) for k in range(99)],
        "pos long, review_id string, app_name string, user string, star_rating string, "
        "date string, review string")
    for df in (first_per_key(raw, ["review_id"], ["pos"]), clean(raw, ["pos"])):
        columns, text = exchanged(df)
        assert df.count() == 40
        assert not any("review" in c for c in columns)
        assert "SortAggregate" not in text


def test_dense_number(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), (F.col("id") * 7).alias("pos"))
    got = dense_number(df.repartition(5), ["pos"], "n", by=["g"])
    for g in range(3):
        numbers = [r["n"] for r in got.filter(F.col("g") == g).orderBy("pos").collect()]
        assert numbers == list(range(len(numbers)))


def test_dense_number_of_sparse_and_of_crowded_ids(spark):
    far = spark.range(200_000).select((F.col("id") * F.lit(1 << 40)).alias("pos"))
    crowded = spark.range(50_000).select(F.col("id").alias("pos"))
    df = far.unionAll(crowded.filter("pos % 5 > 0")).distinct()
    least = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    spark.conf.set(least, "64k")  # so few rows would be one range
    try:
        ranges = stored(df.repartitionByRange("pos").withColumn("p", F.spark_partition_id()), "t")
        got = dense_number(df, ["pos"], "n", start=F.lit(7))
    finally:
        spark.conf.unset(least)
    sizes = [r["n"] for r in ranges.groupBy("p").agg(F.count("*").alias("n")).collect()]
    assert 1 < len(sizes) <= 64 and max(sizes) < 0.6 * sum(sizes)
    n = df.count()
    ends = got.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first()
    assert tuple(ends) == (7, n + 6, n)
    wrong = got.withColumn("after", F.lead("n").over(Window.orderBy("pos"))).filter("after <> n + 1")
    assert wrong.count() == 0


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(0)
    n = 400
    star = rng.integers(1, 6, n)
    length = (rng.gamma(2, 30, n) + 10 * (5 - star)).astype(int) + 1
    return pd.DataFrame({
        "review_id": [f"r{i}" for i in range(n)], "username": [f"u{i % 90}" for i in range(n)],
        "star_rating": star, "review_length": length, "word_count": length // 6,
        "sentiment": np.where(star >= 4, "positive", np.where(star <= 2, "negative", "neutral")),
        "review_date": pd.to_datetime("2024-01-01") + pd.to_timedelta(rng.integers(0, 60, n), "D"),
    })


@pytest.fixture(scope="module")
def table(spark, sample):
    return spark.createDataFrame(sample).withColumn("review_date", F.to_date("review_date"))


def test_quantiles_match_numpy(table, sample):
    points = {f"p{p}": p / 100 for p in (0, 5, 25, 33, 50, 90, 100)}
    got = quantiles(table, "review_length", points).first().asDict()
    for name, p in points.items():
        assert got[name] == pytest.approx(np.percentile(sample.review_length, p * 100))


def test_histogram_matches_numpy(table, sample):
    want, edges = np.histogram(sample.review_length, bins=50)
    got = D.histogram(table, "review_length").orderBy("bin").collect()
    assert [r["n"] for r in got] == list(want)
    assert [r["low"] for r in got] == pytest.approx(list(edges[:-1]))


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(7,)] * 3, "v int")
    want, _ = np.histogram([7, 7, 7], bins=10)
    got = D.histogram(df, "v", 10).orderBy("bin").collect()
    assert [r["n"] for r in got] == list(want)


def test_spearman_and_kruskal_match_pandas_ranks(table, sample):
    rx, ry = sample.star_rating.rank(), sample.review_length.rank()
    got = H.spearman(table, "star_rating", "review_length").first()
    assert got["statistic"] == pytest.approx(rx.corr(ry)) and got["dropped"] == 0
    n = len(sample)
    h = 12 / (n * (n + 1)) * sum(
        ry[sample.star_rating == s].sum() ** 2 / (sample.star_rating == s).sum() for s in range(1, 6)
    ) - 3 * (n + 1)
    ties = sample.review_length.value_counts()
    h /= 1 - (ties**3 - ties).sum() / (n**3 - n)
    assert H.kruskal(table, "star_rating", "review_length").first()["statistic"] == pytest.approx(h)


def test_kruskal_is_null_for_an_empty_group(table):
    only = table.filter("star_rating <> 3")
    assert H.kruskal(only, "star_rating", "review_length").first()["statistic"] is None


def test_spearman_drops_incomplete_pairs(table):
    holes = table.withColumn("star_rating", F.when(F.col("review_length") > 40, F.col("star_rating")))
    got = H.spearman(holes, "star_rating", "review_length").first()
    assert got["dropped"] == holes.filter("star_rating is null").count() and got["dropped"] > 0
    assert got["statistic"] is not None


def test_kde_integrates_to_one(table):
    got = H.group_kde(table).toPandas()
    for _, g in got.groupby("star_rating"):
        g = g.sort_values("x")
        assert np.trapezoid(g.density, g.x) == pytest.approx(1.0, abs=0.05)


def test_published_shares():
    """The arithmetic of a published run."""
    assert 9386 + 1023 + 434 == 10843
    assert round(9386 / 10843 * 100, 1) == 86.6


def test_bins_never_fail(spark):
    few = spark.createDataFrame([(1, 2), (0, 3)], "word_count int, review_length int")
    got = {r["label"]: r["n"] for r in D.word_count_tiers(few).collect()}
    assert got == {"<5": 1, "5-9": 0, "10-19": 0, "20+": 0}


def test_trend_needs_more_than_three_days(spark):
    df = spark.sql("select date'2024-01-01' + cast(id % 3 as int) as review_date from range(9)")
    assert {r["slope"] for r in D.daily_trend(df).collect()} == {None}


def test_month_with_unrated_rows_only_stays(spark):
    df = spark.createDataFrame([("unrated", "2024-02-01")], "sentiment string, d string")
    df = df.withColumn("review_date", F.to_date("d"))
    assert rows(D.monthly_sentiment(df)) == [("2024-02", 0, 0, 0)]
    assert rows(D.monthly_share(df)) == [("2024-02", None, None)]
