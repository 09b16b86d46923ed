"""Rank tests, correlation tests and density curves on distinct-value tables."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.tails import correlation_p
from reviewloom.operators.order_stats import (
    average_ranks,
    quantile,
    running_counts,
    value_counts,
)

STARS = (1, 2, 3, 4, 5)
ALPHA = 0.05


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    """``(n, statistic)`` over rows where both are present."""
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    return both.agg(F.count(F.lit(1)).alias("n"), F.corr(x, y).alias("statistic"))


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """``(n, dropped, statistic)``: correlation of average ranks over complete pairs.

    The pair frequencies are all the test needs; ranks come from their margins, and both rank
    columns have mean (n + 1) / 2.
    """
    complete = F.col(x).isNotNull() & F.col(y).isNotNull()
    pairs = (
        df.filter(complete)
        .groupBy(F.col(x).alias("x"), F.col(y).alias("y"))
        .agg(F.count(F.lit(1)).alias("c"))
    )

    def margin(side):
        counts = pairs.groupBy(F.col(side).alias("value")).agg(F.sum("c").alias("n"))
        return average_ranks(counts).select(
            F.col("value").alias(side), F.col("rank").alias(f"r{side}"), F.col("total")
        )

    ranked = pairs.join(margin("x"), "x").join(margin("y").drop("total"), "y")
    mid = (F.col("total") + 1) / F.lit(2.0)
    dx, dy = F.col("rx") - mid, F.col("ry") - mid
    sxy, sxx, syy = (F.sum(F.col("c") * a * b) for a, b in ((dx, dy), (dx, dx), (dy, dy)))
    dropped = df.agg(F.count_if(~complete).alias("d")).scalar()
    return ranked.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"),
        F.try_divide(sxy, F.sqrt(sxx) * F.sqrt(syy)).alias("statistic"),
    ).select("n", dropped.alias("dropped"), "statistic")


def kruskal(df: DataFrame, by: str, col: str, groups: Sequence = STARS) -> DataFrame:
    """``(n, statistic, p_value)``: tie-corrected rank test over the groups; null where a group
    is empty. With an even number of degrees of freedom the chi-square tail is a finite sum."""
    counts = value_counts(df.filter(F.col(by).isin(list(groups))), col, [by])
    pooled = counts.groupBy("value").agg(F.sum("n").alias("n"))
    ranks = average_ranks(pooled).select("value", "rank")
    per_group = (
        counts.join(ranks, "value")
        .groupBy(by)
        .agg(F.sum("n").cast("double").alias("size"), F.sum(F.col("rank") * F.col("n")).alias("s"))
    )
    t = F.col("n").cast("double")
    ties = pooled.agg(F.sum(t * t * t - t).alias("t")).scalar()
    n = F.col("n")
    h = F.lit(12.0) / (n * (n + 1)) * F.col("ss") - 3 * (n + 1)
    out = (
        per_group.agg(
            F.sum("size").alias("n"),
            F.count(F.lit(1)).alias("k"),
            F.sum(F.col("s") * F.col("s") / F.col("size")).alias("ss"),
        )
        .withColumn("ties", ties)
        .withColumn(
            "statistic",
            F.when(
                F.col("k") == len(groups),
                F.try_divide(h, 1 - F.col("ties") / (n * n * n - n)),
            ),
        )
    )
    df_ = len(groups) - 1
    if df_ % 2:
        raise ValueError("the closed tail needs an odd number of groups")
    half = F.col("statistic") / 2
    tail = sum(
        (F.pow(half, F.lit(i)) / F.lit(float(math.factorial(i))) for i in range(1, df_ // 2)),
        F.lit(1.0),
    )
    return out.select(
        F.coalesce(n, F.lit(0.0)).cast("long").alias("n"),
        "statistic",
        (F.exp(-half) * tail).alias("p_value"),
    )


def with_correlation_p(result: DataFrame) -> DataFrame:
    """A correlation result with its two-sided p."""
    return result.withColumn("p_value", correlation_p(F.col("statistic"), F.col("n")))


def pearson_test(df: DataFrame, x: str = "review_length", y: str = "word_count") -> DataFrame:
    return with_correlation_p(pearson(df, x, y))


def spearman_test(df: DataFrame, x: str = "star_rating", y: str = "review_length") -> DataFrame:
    return with_correlation_p(spearman(df, x, y))


def p_text(col: str = "p_value"):
    return F.when(F.col(col) < 0.001, "< 0.001").otherwise(
        F.concat(F.lit("= "), F.format_string("%.4f", F.col(col)))
    )


def conclusion(col: str = "p_value"):
    return F.when(F.col(col) < ALPHA, "significant").otherwise("not significant")


def test_report(df: DataFrame) -> DataFrame:
    """The three tests with their p as text and what follows from it."""
    tests = [
        ("kruskal_length_by_star", kruskal(df, "star_rating", "review_length")),
        ("spearman_star_length", spearman_test(df)),
        ("pearson_length_words", pearson_test(df)),
    ]
    out = None
    for name, one in tests:
        row = one.select(
            F.lit(name).alias("test"), "statistic", p_text().alias("p"),
            conclusion().alias("conclusion"),
        )
        out = row if out is None else out.unionByName(row)
    return out


test_report.__test__ = False  # not a pytest case


def group_kde(
    df: DataFrame, by: str = "star_rating", col: str = "review_length", points: int = 100,
    cut: float = 2.0,
) -> DataFrame:
    """Gaussian density curve per group on an even grid, with the group's quartiles.

    Bandwidth is Scott's rule on the sample deviation; the grid reaches ``cut`` bandwidths past
    the data. Each distinct value meets the fixed grid of its own group, never other rows.
    """
    table = running_counts(value_counts(df.filter(F.col(by).isNotNull()), col, [by]), [by])
    v, n = F.col("value").cast("double"), F.col("n").cast("double")
    stats = table.groupBy(by).agg(
        F.sum("n").alias("size"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        (F.sum(v * n) / F.sum(n)).alias("mean"),
        *[quantile(p).alias(q) for q, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))],
    )
    spread = (
        table.join(stats.select(by, "mean", "size"), by)
        .groupBy(by, "size")
        .agg(F.sum(n * (v - F.col("mean")) * (v - F.col("mean"))).alias("m2"))
        .select(by, (F.sqrt(F.try_divide("m2", F.col("size") - 1))
                     * F.pow(F.col("size").cast("double"), F.lit(-0.2))).alias("bw"))
    )
    shape = stats.join(spread, by).filter(F.col("bw") > 0)
    reach = F.lit(cut) * F.col("bw")
    start, end = F.col("low") - reach, F.col("high") + reach
    x = start + F.col("point") * (end - start) / F.lit(float(points - 1))
    z = (x - v) / F.col("bw")
    weight = n * F.exp(F.lit(-0.5) * z * z)
    scale = F.col("size") * F.col("bw") * F.lit(math.sqrt(2 * math.pi))
    return (
        table.select(by, "value", "n")
        .join(shape, by)
        .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .groupBy(by, "point", x.alias("x"), scale.alias("scale"), "q1", "median", "q3")
        .agg(F.sum(weight).alias("w"))
        .select(by, "point", "x", (F.col("w") / F.col("scale")).alias("density"),
                "q1", "median", "q3")
    )
