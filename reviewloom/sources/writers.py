"""Writers for reviews, splits, features and fitted models. All write Parquet in parallel."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from reviewloom.operators.tables import COMPRESSION

# quotes doubled, white space and empty text kept
CSV = {
    "header": True, "escape": '"', "quote": '"', "emptyValue": "",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}
INTERNAL_COLUMNS = ["id", "label_method"]


def write_reviews(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = df.write.mode("errorifexists")
    if fmt == "csv":
        writer.options(**CSV).csv(path)
    else:
        writer.format(fmt).save(path)


def write_splits(df: DataFrame, path: str) -> None:
    """Splits without internal columns, one folder per split."""
    rows = df.drop(*INTERNAL_COLUMNS).write.mode("errorifexists").partitionBy("split")
    rows.option("compression", COMPRESSION).parquet(path)


def write_features(families: Mapping[str, DataFrame], path: str) -> None:
    """One table per feature family, one folder per split."""
    for name, df in families.items():
        df.write.mode("errorifexists").partitionBy("split").parquet(f"{path}/{name}")


def save_model(vocab: DataFrame, scaler: DataFrame, path: str) -> None:
    """Fitted state as two small tables."""
    vocab.coalesce(1).write.mode("errorifexists").parquet(f"{path}/vocab")
    scaler.coalesce(1).write.mode("errorifexists").parquet(f"{path}/scaler")


def load_model(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}") for name in ("vocab", "scaler")}
