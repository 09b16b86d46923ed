"""Words of a text, and how the operators here treat rows.

A word is a run of characters other than blank, tab, line feed, vertical tab, form feed and
carriage return. ``bytes.split()`` cuts at just these bytes, so tasks in Python use it on UTF-8.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.registry.views import table  # noqa: F401  (tables of a folder by name)
from reviewloom.session import shared_dir

WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text; none for null. One literal blank is the cheapest thing to split at."""
    flat = F.coalesce(text, F.lit(""))
    for space in "\t\n\x0b\f\r":
        flat = F.replace(flat, F.lit(space), F.lit(" "))
    return F.array_remove(F.split(flat, " "), "")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else unchanged."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def shelve(
    docs: DataFrame, needed: Sequence[str], new: Sequence[str],
) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with its other columns under names that no operator uses, and the way back: the
    columns of ``docs`` in their order, but for those named like a new one, then the new ones."""
    taken = {n.lower() for n in new}
    own = {n.lower(): n for n in needed}
    kept = [c for c in docs.columns if c.lower() not in taken]
    names = {c: own.get(c.lower(), f"_x{k}") for k, c in enumerate(kept)}
    columns = [F.col(f"`{c.replace('`', '``')}`").alias(n) for c, n in names.items()]

    def back(out: DataFrame) -> DataFrame:
        return out.select([F.col(n).alias(c) for c, n in names.items()] + [F.col(n) for n in new])

    return docs.select(columns), back


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read again: later steps start from files
    that all executors share, whatever happens to the executors that made them."""
    spark: SparkSession = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
