"""Descriptive statistics of a review table.

Input columns: review_id, username, star_rating, review_date, review_length, word_count,
sentiment. Every operator is one aggregation over one scan; order statistics go through the
distinct-value tables of ``order_stats``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewloom.functions.columns import cut, month, share
from reviewloom.operators.order_stats import (
    quantile,
    quantiles,
    running_counts,
    top_k,
    value_counts,
)
from reviewloom.schemas import (
    LENGTH_BUCKETS,
    RATED_SENTIMENTS,
    SENTIMENTS,
    USER_BUCKETS,
    WORD_TIERS,
)



def _distribution(df: DataFrame, key: str) -> DataFrame:
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    return counts.withColumn("pct", share("n", F.sum("n").over(W.partitionBy())))


def _listed(df: DataFrame, counts: DataFrame, key: str, labels: Sequence[str]) -> DataFrame:
    """Counts for a fixed list of labels, absent ones 0."""
    wanted = F.explode(F.create_map(*[F.lit(x) for i, v in enumerate(labels) for x in (i, v)]))
    frame = df.sparkSession.range(1).select(wanted.alias("position", key))
    return frame.join(counts, key, "left").withColumn("n", F.coalesce("n", F.lit(0)))


def star_distribution(df: DataFrame) -> DataFrame:
    """Rows per star; shares are of all rows, unrated ones included."""
    return _distribution(df, "star_rating").filter(F.col("star_rating").isNotNull())


def sentiment_distribution(df: DataFrame) -> DataFrame:
    return _distribution(df, "sentiment")


def class_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One column per allowed class, 0 where absent."""
    return df.groupBy(*by).agg(
        *[F.count_if(F.col("sentiment") == s).alias(s) for s in SENTIMENTS]
    )


def class_dist(df: DataFrame) -> DataFrame:
    """Rows per class, all four classes present."""
    counts = df.groupBy("sentiment").agg(F.count("*").alias("n"))
    return _listed(df, counts, "sentiment", SENTIMENTS).select("sentiment", "n")


def binned_counts(df: DataFrame, col: str, bins) -> DataFrame:
    """Rows per bin, every bin listed, with the share of all rows."""
    edges, labels = bins
    counts = df.groupBy(cut(col, edges, labels).alias("label")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(W.partitionBy())
    shared = counts.withColumn("pct", share("n", total))
    return _listed(df, shared, "label", labels).withColumn(
        "pct", F.coalesce("pct", F.lit(0.0))
    )


def word_count_tiers(df: DataFrame) -> DataFrame:
    return binned_counts(df, "word_count", WORD_TIERS)


def length_buckets(df: DataFrame) -> DataFrame:
    return binned_counts(df, "review_length", LENGTH_BUCKETS)


def user_frequency(df: DataFrame, by: Sequence[str] = ("username",)) -> DataFrame:
    """Users per number of reviews; ``by`` may add the platform."""
    per_user = df.groupBy(*by).agg(F.count("*").alias("reviews"))
    return binned_counts(per_user, "reviews", USER_BUCKETS).drop("pct")


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width bins from the least to the greatest value, the last one closed. Empty bins
    are listed."""
    counts = value_counts(df, col)
    ends = W.partitionBy()
    low, high = F.min("value").over(ends), F.max("value").over(ends)
    # numpy widens a single-valued range by one half on both sides
    flat = low == high
    lo = F.when(flat, low - F.lit(0.5)).otherwise(low).cast("double")
    hi = F.when(flat, high + F.lit(0.5)).otherwise(high).cast("double")
    placed = counts.withColumn("lo", lo).withColumn("hi", hi).withColumn(
        "bin", F.least(F.width_bucket(F.col("value").cast("double"), "lo", "hi", F.lit(bins)),
                       F.lit(bins))
    )
    filled = placed.groupBy("bin").agg(F.sum("n").alias("n"))
    span = counts.agg(F.struct(F.min("value").alias("lo"), F.max("value").alias("hi")).alias("s"))
    s = span.scalar()
    same = s["lo"] == s["hi"]
    lo1 = F.when(same, s["lo"] - 0.5).otherwise(s["lo"]).cast("double")
    width = F.when(same, 1.0).otherwise((s["hi"] - s["lo"]).cast("double")) / F.lit(bins)
    grid = df.sparkSession.range(1, bins + 1).select(F.col("id").alias("bin"))
    return grid.join(filled, "bin", "left").select(
        "bin",
        (lo1 + (F.col("bin") - 1) * width).alias("low"),
        (lo1 + F.col("bin") * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def center(df: DataFrame, col: str) -> DataFrame:
    """Mean and median, both from the value counts."""
    table = running_counts(value_counts(df, col))
    mean = F.sum(F.col("value") * F.col("n")).cast("double") / F.sum("n")
    return table.agg(mean.alias("mean"), quantile(0.5).alias("median"))


def box_stats(df: DataFrame, by: str, col: str, groups: Sequence | None = None) -> DataFrame:
    """Quartiles, whiskers at the furthest value within 1.5 quartile ranges, outlier count."""
    if groups is not None:
        df = df.filter(F.col(by).isin(list(groups)))
    table = running_counts(value_counts(df, col, [by]), [by])
    q = table.groupBy(by).agg(
        *[quantile(p).alias(n) for n, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))]
    )
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        table.join(q, by)
        .groupBy(by, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.sum(F.when(inside, F.lit(0)).otherwise(F.col("n"))).alias("outliers"),
        )
    )


DESCRIBED = ("review_length", "word_count", "star_rating")


def describe(df: DataFrame, cols: Sequence[str] = DESCRIBED) -> DataFrame:
    """Mean, median, sample deviation, least and greatest value, one row per column."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("long").alias("value"))
                  for c in cols])
    ).alias("p")
    long = df.select(pairs).select("p.metric", "p.value")
    moments = long.groupBy("metric").agg(
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    medians = quantiles(long, "value", {"median": 0.5}, ["metric"])
    return moments.join(medians, "metric").select("metric", "mean", "median", "std", "min", "max")


def monthly_sentiment(df: DataFrame) -> DataFrame:
    """Rows per month and rated sentiment. A month with unrated rows only stays, with zeros."""
    return df.groupBy(month("review_date").alias("month")).agg(
        *[F.count_if(F.col("sentiment") == s).alias(s) for s in RATED_SENTIMENTS]
    )


def monthly_share(df: DataFrame) -> DataFrame:
    """Share of positive and negative among the three rated classes; none at all gives null."""
    rated = F.col("positive") + F.col("neutral") + F.col("negative")
    return monthly_sentiment(df).select(
        "month",
        share("positive", rated).alias("pct_positive"),
        share("negative", rated).alias("pct_negative"),
    )


def monthly_star(df: DataFrame) -> DataFrame:
    return df.groupBy(month("review_date").alias("month")).agg(
        F.avg("star_rating").alias("mean_star"),
        F.count("star_rating").alias("rated"),
        F.round(F.avg("star_rating"), 2).alias("avg_star"),
        F.count("*").alias("n"),
    )


def daily_counts(df: DataFrame, date: str = "review_date") -> DataFrame:
    """Rows per day, only days that occur."""
    return (
        df.filter(F.col(date).isNotNull()).groupBy(F.col(date).alias("day"))
        .agg(F.count("*").alias("n"))
    )


def daily_trend(df: DataFrame, date: str = "review_date") -> DataFrame:
    """Line through the daily counts over day positions 0..n-1, for more than three days.

    Only the table of days, at most as long as the calendar, is ordered as a whole.
    """
    days = daily_counts(df, date).withColumn(
        "position", F.row_number().over(W.partitionBy().orderBy("day")) - F.lit(1)
    )
    whole = W.partitionBy()
    enough = F.count("*").over(whole) > 3
    fitted = days.withColumn(
        "slope", F.when(enough, F.regr_slope("n", "position").over(whole))
    ).withColumn("intercept", F.when(enough, F.regr_intercept("n", "position").over(whole)))
    return fitted.withColumn("fitted", F.col("intercept") + F.col("slope") * F.col("position"))


def ols(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line of y on x with the range of x."""
    return df.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.min(x).alias("x_min"),
        F.max(x).alias("x_max"),
        F.regr_count(y, x).alias("n"),
    )


def ols_line(df: DataFrame, x: str, y: str, points: int = 100) -> DataFrame:
    """The same line on evenly spaced x."""
    step = (F.col("x_max") - F.col("x_min")) / F.lit(float(points - 1))
    xs = F.col("x_min") + F.col("point") * step
    return (
        ols(df, x, y)
        .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .select("point", xs.alias("x"), (F.col("intercept") + F.col("slope") * xs).alias("y"))
    )


CORRELATED = ("star_rating", "review_length", "word_count")


def corr_matrix(df: DataFrame, cols: Sequence[str] = CORRELATED) -> DataFrame:
    """Pearson correlations of all column pairs over rows where both are present, one scan."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    # named positionally so a column name cannot clash
    once = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for left, right in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(left).alias("a"), F.lit(right).alias("b"),
                                  F.col(f"c{i}").alias("r")))
    return once.select(F.explode(F.array(*cells)).alias("x")).select("x.a", "x.b", "x.r")


def median_by(df: DataFrame, by: str = "star_rating", col: str = "review_length") -> DataFrame:
    rated = df.filter(F.col(by).isNotNull())
    return quantiles(rated, col, {"median": 0.5}, [by])


def ecdf(df: DataFrame, by: str = "sentiment", col: str = "review_length",
         groups: Sequence = tuple(RATED_SENTIMENTS)) -> DataFrame:
    """Share of a group's rows at or below each of its values."""
    table = running_counts(
        value_counts(df.filter(F.col(by).isin(list(groups))), col, [by]), [by]
    )
    reached = (F.col("before") + F.col("n")) / F.col("total")
    return table.select(by, "value", reached.alias("cdf"))


def crosstab(df: DataFrame) -> DataFrame:
    """Rows per star and rated sentiment."""
    return (
        df.filter(F.col("star_rating").isNotNull())
        .groupBy("star_rating")
        .agg(*[F.count_if(F.col("sentiment") == s).alias(s) for s in RATED_SENTIMENTS])
    )


CURVE = tuple(range(0, 101, 5))


def percentile_curve(df: DataFrame, col: str = "review_length",
                     points: Sequence[int] = CURVE) -> DataFrame:
    """Exact percentiles, one row per point."""
    wide = quantiles(df, col, {f"p{p}": p / 100.0 for p in points})
    cells = [F.struct(F.lit(p).alias("percentile"), F.col(f"p{p}").alias("value"))
             for p in points]
    return wide.select(F.explode(F.array(*cells)).alias("x")).select("x.percentile", "x.value")


def top_users(df: DataFrame, n: int = 10) -> DataFrame:
    """Most active users and how active they are."""
    tier = F.when(F.col("n") >= 6, "high").when(F.col("n") >= 3, "medium").otherwise("low")
    return top_k(df, "username", n).withColumn("tier", tier)


def summary(df: DataFrame) -> DataFrame:
    """Headline numbers, one row."""
    return df.agg(
        F.count("*").alias("n"),
        F.min("review_date").alias("first_date"),
        F.max("review_date").alias("last_date"),
        F.countDistinct(month("review_date")).alias("months"),
        F.avg("star_rating").alias("mean_star"),
        F.avg("review_length").alias("mean_length"),
        F.avg("word_count").alias("mean_words"),
        *[F.count_if(F.col("sentiment") == s).alias(s) for s in SENTIMENTS],
    )


def quality_checklist(df: DataFrame) -> DataFrame:
    """Anomaly counts with notes.

    Rows are first reduced per user (combined map-side), so the user counts need no second pass.
    """
    per_user = df.groupBy("username").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("star_rating").isNull()).alias("null_star"),
        F.count_if(F.col("review_length") <= 5).alias("very_short"),
        F.count_if(F.col("word_count") < 5).alias("few_words"),
        F.count_if(F.col("review_length") == 500).alias("at_limit"),
        F.min("review_date").alias("first"),
        F.max("review_date").alias("last"),
    )
    named = F.col("username").isNotNull()
    t = per_user.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.count_if(named).alias("users"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c)
          for c in ("null_star", "very_short", "few_words", "at_limit")],
        F.count_if(named & (F.col("n") > 1)).alias("multi"),
        F.datediff(F.max("last"), F.min("first")).cast("long").alias("days"),
    )
    few_pct = F.format_number(share("few_words", "total"), 1)
    empty = F.lit("")
    rows = [
        ("total_reviews", "total", empty),
        ("unique_users", "users", empty),
        ("null_star_rating", "null_star",
         F.when(F.col("null_star") == 0, "none").otherwise("present")),
        ("very_short", "very_short",
         F.when(F.col("very_short") > 0, "low signal").otherwise("")),
        ("under_5_words", "few_words", F.concat(few_pct, F.lit("%"))),
        ("at_500_chars", "at_limit", F.lit("length limit")),
        ("multi_review_users", "multi", empty),
        ("date_span_days", "days", empty),
    ]
    cells = [F.struct(F.lit(c).alias("check"), F.col(v).cast("long").alias("value"),
                      n.alias("note")) for c, v, n in rows]
    return t.select(F.explode(F.array(*cells)).alias("x")).select("x.*")


def quality_gates(df: DataFrame, raw_rows: Column) -> DataFrame:
    """Targets for a cleaned table: ``(metric, value, target, passed)``.

    Duplicates are counted over ids combined map-side, so one id may hold any share of the rows.
    """
    per_id = df.groupBy("review_id").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("star_rating").isNull()).alias("null_star"),
        F.count_if(F.col("word_count") < 5).alias("few_words"),
        F.count_if(F.col("sentiment") == "positive").alias("positive"),
        F.count_if(F.col("sentiment") == "neutral").alias("neutral"),
    )
    t = per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c)
          for c in ("null_star", "few_words", "positive", "neutral")],
    )
    rows = [
        ("size", F.col("n").cast("double"), ">= 10000", lambda v: v >= 10000),
        ("retention_pct", share("n", raw_rows), ">= 80", lambda v: v >= 80),
        ("null_star_pct", share("null_star", "n"), "< 5", lambda v: v < 5),
        ("duplicate_ids", F.col("duplicates").cast("double"), "= 0", lambda v: v == 0),
        ("positive_per_neutral", F.try_divide(F.col("positive").cast("double"), "neutral"),
         "< 10", lambda v: v < 10),
        ("under_5_words_pct", share("few_words", "n"), "< 20", lambda v: v < 20),
    ]
    cells = [
        F.struct(F.lit(m).alias("metric"), v.alias("value"), F.lit(t_).alias("target"),
                 ok(v).cast("int").alias("passed"))
        for m, v, t_, ok in rows
    ]
    return t.select(F.explode(F.array(*cells)).alias("x")).select("x.*")


def length_by_sentiment(df: DataFrame) -> DataFrame:
    """Mean length per class, their ratio, and the share of the extreme stars."""
    def mean_of(s):
        return F.avg(F.when(F.col("sentiment") == s, F.col("review_length")))

    stars = F.count("star_rating")
    return df.agg(
        *[mean_of(s).alias(f"mean_length_{s}") for s in RATED_SENTIMENTS],
        F.try_divide(mean_of("negative"), mean_of("positive")).alias("negative_per_positive"),
        share(F.count_if(F.col("star_rating") == 5), stars).alias("pct_5_star"),
        share(F.count_if(F.col("star_rating") == 1), stars).alias("pct_1_star"),
    )
