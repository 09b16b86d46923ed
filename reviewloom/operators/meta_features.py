"""Numeric features of a review and their scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.columns import (
    literal_count,
    mean_word_length,
    to_number,
    uppercase_ratio,
    word_count,
)
from reviewloom.schemas import METADATA_FEATURES


def metadata(df: DataFrame, text: str = "review_text", keep: Sequence[str] = (),
             drop_label_proxy: bool = False) -> DataFrame:
    """The nine numeric features. Given lengths are used where the column exists; the star, from
    which the label is derived, can be left out."""
    t = F.coalesce(F.col(text), F.lit(""))
    zero = F.lit(0)
    has = set(df.columns)
    length = F.coalesce("review_length", zero) if "review_length" in has else F.length(t)
    words = F.coalesce("word_count", zero) if "word_count" in has else word_count(t)
    star = F.coalesce(to_number("star_rating"), F.lit(0.0)) if "star_rating" in has else F.lit(0.0)
    title = F.nullif(F.col("title"), F.lit("")).isNotNull() if "title" in has else F.lit(False)
    values = {
        "review_length": length,
        "word_count": words,
        "avg_word_len": mean_word_length(t),
        "exclamation_count": literal_count(t, "!"),
        "question_count": literal_count(t, "?"),
        "ellipsis_count": literal_count(t, "..."),
        "uppercase_ratio": uppercase_ratio(t),
        "star_rating": star,
        "has_title": title.cast("int"),
    }
    if drop_label_proxy:
        del values["star_rating"]
    return df.select("sample_id", *keep,
                     *[v.cast("double").alias(k) for k, v in values.items()])


def fit_scaler(meta: DataFrame, features: Sequence[str] = tuple(METADATA_FEATURES)) -> DataFrame:
    """``(feature, mean, scale)`` by population deviation; constant columns get scale 1."""
    once = meta.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(features)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(features)],
    )
    cells = [
        F.struct(F.lit(c).alias("feature"), F.col(f"m{i}").alias("mean"),
                 F.when(F.col(f"s{i}") > 0, F.col(f"s{i}")).otherwise(1.0).alias("scale"))
        for i, c in enumerate(features)
    ]
    return once.select(F.explode(F.array(*cells)).alias("x")).select("x.*")


def apply_scaler(meta: DataFrame, scaler: DataFrame) -> DataFrame:
    """Scales every feature the scaler knows. The fitted values reach the rows as one scalar
    subquery, so there is no join."""
    features = [c for c in meta.columns if c in METADATA_FEATURES]
    picked = scaler.agg(
        F.struct(*[
            F.max(F.when(F.col("feature") == c, F.struct("mean", "scale"))).alias(c)
            for c in features
        ]).alias("s")
    ).scalar()
    fit = F.col("_fit")
    scaled = {c: (F.col(c) - fit[c]["mean"]) / fit[c]["scale"] for c in features}
    # bound to a column first, so that the subquery is planned once and not per feature
    return meta.withColumn("_fit", picked).select(
        *[scaled[c].alias(c) if c in scaled else F.col(c) for c in meta.columns]
    )
