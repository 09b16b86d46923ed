"""Cleaning steps and their audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.columns import (
    review_length,
    share,
    star_sentiment,
    to_number,
    to_review_date,
    trim_space,
    word_count,
)
from reviewloom.functions.language import UNDETERMINED, detect_language
from reviewloom.operators.order_stats import first_per_key
from reviewloom.schemas import MIN_CHARS

# Step names of the audit, which its results are compared by.
STEPS = ["missing_date", "null_empty_review", "too_short", "non_english", "duplicate_id"]


def coerce_raw(df: DataFrame) -> DataFrame:
    """Text columns of a raw review table to number and date, bad values null."""
    return df.withColumn("star_rating", to_number("star_rating")).withColumn(
        "date", to_review_date("date")
    )


def failed_step(language: str = "en", min_chars: int = MIN_CHARS) -> Column:
    """First row-level step a row fails, null for none. The language is only looked at where the
    cheaper steps pass."""
    text = trim_space("review")
    lang = detect_language("review", prefer=language)
    return (
        F.when(F.col("date").isNull(), STEPS[0])
        .when(F.coalesce(text, F.lit("")) == "", STEPS[1])
        .when(F.length(text) < min_chars, STEPS[2])
        .when(~lang.isin(language, UNDETERMINED), STEPS[3])
    )


def keep_language(df: DataFrame, language: str = "en", col: str = "review") -> DataFrame:
    """Rows in the language, and rows that show no clear evidence of another one."""
    return df.filter(detect_language(col, prefer=language).isin(language, UNDETERMINED))


def clean(
    raw: DataFrame, order: Sequence[str], language: str = "en", min_chars: int = MIN_CHARS
) -> DataFrame:
    """Rows that pass every step, first row per id, with the derived columns."""
    passed = coerce_raw(raw).filter(failed_step(language, min_chars).isNull())
    return (
        first_per_key(passed, ["review_id"], order)
        .withColumn("review_length", review_length("review"))
        .withColumn("word_count", word_count("review"))
        .withColumn("sentiment", star_sentiment("star_rating"))
    )


def clean_audit(raw: DataFrame, language: str = "en", min_chars: int = MIN_CHARS) -> DataFrame:
    """``(step_no, step, dropped, remaining, retention_pct)``.

    Survivors of the row steps are counted per id; what exceeds one per id is the last step's
    drop. Counting combines map-side, so neither a hot id nor a hot step matters.
    """
    flagged = coerce_raw(raw).select(
        failed_step(language, min_chars).alias("step"), F.col("review_id")
    )
    per_id = flagged.groupBy(
        "step", F.when(F.col("step").isNull(), F.col("review_id")).alias("id")
    ).agg(F.count(F.lit(1)).alias("n"))
    drops = [
        F.coalesce(F.sum(F.when(F.col("step") == s, F.col("n"))), F.lit(0)).alias(s)
        for s in STEPS[:-1]
    ]
    repeats = F.coalesce(F.sum(F.when(F.col("step").isNull(), F.col("n") - 1)), F.lit(0))
    totals = per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"), *drops, repeats.alias(STEPS[-1])
    )
    cells, gone = [], F.lit(0)
    for i, step in enumerate(STEPS, start=1):
        gone = gone + F.col(step)
        remaining = F.col("total") - gone
        cells.append(
            F.struct(
                F.lit(i).alias("step_no"), F.lit(step).alias("step"),
                F.col(step).alias("dropped"), remaining.alias("remaining"),
                share(remaining, "total").alias("retention_pct"),
            )
        )
    return totals.select(F.explode(F.array(*cells)).alias("x")).select("x.*")


def min_words(df: DataFrame, n: int = 10) -> DataFrame:
    """Reviews long enough to train on."""
    return df.filter(F.col("word_count") >= n)
