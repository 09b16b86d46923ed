"""Readers for raw and cleaned review files and for split tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.functions.columns import check_platform, trim_space
from reviewloom.schemas import OPTIONAL_COLUMNS, RAW_REVIEWS, REQUIRED_COLUMNS, SPLITS

STORE_RECORDS = "reviewId string, userName string, score string, at string, content string"
POSITION = ["_source", "_file", "_row"]


def check_columns(df: DataFrame, required: Sequence[str], optional: Sequence[str] = ()):
    """Fail on a missing required column; missing optional ones become null strings."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df.withColumns(
        {c: F.lit(None).cast("string") for c in optional if c not in df.columns}
    )


def with_position(df: DataFrame, source: int = 0) -> DataFrame:
    """Adds the input position ``(_source, _file, _row)`` to a file scan. Rows of a file keep
    their order; files count in the order of their names."""
    return df.withColumns(
        {
            "_source": F.lit(source),
            "_file": F.col("_metadata.file_path"),
            "_row": F.monotonically_increasing_id(),
        }
    )


def project_raw(
    records: DataFrame, app_name: str | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Store records to the six raw fields; absent text is '', an absent star null."""
    blank = F.lit("")
    app = F.lit(app_name) if app_name is not None else F.col("app_name")
    return records.select(
        F.coalesce("reviewId", blank).alias("review_id"),
        app.alias("app_name"),
        F.coalesce("userName", blank).alias("user"),
        F.col("score").cast("string").alias("star_rating"),
        F.coalesce(F.substring(F.col("at").cast("string"), 1, 10), blank).alias("date"),
        trim_space(F.coalesce("content", blank)).alias("review"),
        *keep,
    )


def read_raw_reviews(
    spark: SparkSession, path, app_name: str | None = None, fmt: str = "json",
    keep: Sequence[str] = (),
):
    """Raw reviews: JSON lines of store records, or CSV / Parquet with the six fields. Records of
    several apps hold ``app_name`` themselves; ``keep`` are more of their columns, like "id long".
    """
    if fmt == "json":
        own = [STORE_RECORDS, *(["app_name string"] if app_name is None else []), *keep]
        records = spark.read.schema(", ".join(own)).json(path)
        return project_raw(records, app_name, [c.split()[0] for c in keep])
    if fmt == "csv":
        df = _csv(spark, path, schema=RAW_REVIEWS)
    else:
        df = spark.read.schema(RAW_REVIEWS).format(fmt).load(path)
    df = df.withColumns({c: F.coalesce(c, F.lit("")) for c in ("review_id", "user", "date")})
    return df.withColumn("review", trim_space(F.coalesce("review", F.lit(""))))


def _csv(spark: SparkSession, path, multi_line: bool = True, schema: str | None = None):
    reader = spark.read.options(header=True, multiLine=multi_line, escape='"', quote='"')
    return (reader.schema(schema) if schema else reader).csv(path)


def read_clean_reviews(
    spark: SparkSession,
    path,
    platform: str,
    source: int = 0,
    fmt: str = "csv",
    multi_line: bool = True,
) -> DataFrame:
    """Cleaned reviews as text, '' kept as '' and "NA" kept as text, with platform and position.

    A quoted line break makes a CSV file unsplittable, so big CSV inputs should come as many
    files, or with ``multi_line=False`` where reviews hold no line breaks, or as Parquet.
    """
    check_platform(platform)
    df = _csv(spark, path, multi_line) if fmt == "csv" else spark.read.format(fmt).load(path)
    df = check_columns(with_position(df, source), REQUIRED_COLUMNS, OPTIONAL_COLUMNS)
    texts = [*REQUIRED_COLUMNS, *OPTIONAL_COLUMNS]
    return df.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in texts],
        F.lit(platform).alias("platform_key"),
        *POSITION,
    )


def combine_sources(spark: SparkSession, sources: Sequence[tuple[str, str]], **options):
    """``[(path, platform), ...]`` as one table, earlier sources first."""
    out = None
    for i, (path, platform) in enumerate(sources):
        one = read_clean_reviews(spark, path, platform, source=i, **options)
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no source given")
    return out


def check_splits(df: DataFrame) -> DataFrame:
    """Alias the text column and require what the features need."""
    if "review_text" not in df.columns and "review" in df.columns:
        df = df.withColumnRenamed("review", "review_text")
    return check_columns(df, ["review_id", "review_text", "sentiment", "split"])


def read_splits(spark: SparkSession, path: str) -> DataFrame:
    """A split table written by ``write_splits``; every split must be present."""
    df = check_splits(spark.read.parquet(path))
    found = {r["split"] for r in df.select("split").distinct().limit(len(SPLITS) + 1).collect()}
    missing = [s for s in SPLITS if s not in found]
    if missing:
        raise FileNotFoundError(f"{path} has no rows for {missing}; write the splits first")
    return df
