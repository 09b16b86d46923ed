"""Fingerprints and constraint audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.columns import portable_hash


def _texts(df: DataFrame, cols: Sequence[str] | None) -> list[Column]:
    """Columns as text, null told apart from empty."""
    return [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("0"))
            for c in (cols or df.columns)]


def fingerprint(
    df: DataFrame, cols: Sequence[str] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Order-free content checksum: row count, xor and sum of row hashes. The sum is there
    because a pair of equal rows cancels out in the xor."""
    h = F.xxhash64(*_texts(df, cols))
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.bit_xor(h), F.lit(0)).alias("xor_hash"),
        F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").alias("sum_hash"),
    )


def fingerprint_text(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """The fingerprint as one string, for audit rows."""
    f = fingerprint(df, cols)
    text = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in f.columns]))
    return f.select(text.alias("checksum"))


def portable_fingerprint(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """The same with a hash every SQL engine has."""
    h = portable_hash(*_texts(df, cols)).cast("decimal(38,0)")
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(h), F.lit(0)).cast("string").alias("sum_hash"),
    )


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def fk_orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str = "id") -> DataFrame:
    """Foreign keys without a parent and how many rows use them. Keys are counted before the
    join, so a key that many rows share is joined once."""
    used = (
        child.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("key"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return used.join(parent.select(F.col(parent_key).alias("key")), "key", "left_anti")


def check_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break each rule; as in SQL a rule that is null passes. One scan."""
    counted = df.agg(
        *[F.count_if(~F.coalesce(cond, F.lit(True))).alias(f"r{i}")
          for i, cond in enumerate(rules.values())]
    )
    cells = [F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("violations"))
             for i, name in enumerate(rules)]
    return counted.select(F.explode(F.array(*cells)).alias("x")).select("x.*")
