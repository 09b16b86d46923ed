"""Small tables from driver values, and tables on disk between steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.session import shared_dir


COMPRESSION = "zstd"  # of Parquet files: texts take about two thirds of what they do by default
BROADCAST_ROWS = 1 << 20  # fixed value: of a table the driver may hold; narrow rows take 50 to 75 MB


def literal_rows(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """A few rows of the driver's as a table."""
    cells = [F.struct(*[F.lit(v).alias(c) for c, v in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.explode(F.array(*cells)).alias("r")).select("r.*")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared working folder and read again. Later steps all see these rows,
    whatever happens to the executors that made them, and the planner knows their size."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def off_driver(df: DataFrame) -> DataFrame:
    """``df`` as the narrow side of a join. The planner goes by the size of files, in which a row
    takes a few bytes, while in a broadcast it takes 50 to 70 of the driver's. A table of more than
    ``BROADCAST_ROWS`` rows, counted in the files' footers, is therefore dealt to the tasks."""
    return df.hint("shuffle_hash") if df.count() > BROADCAST_ROWS else df
