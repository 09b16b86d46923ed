"""First rows, dense numbers, ranks and exact quantiles without a global sort.

Statistics over an integer column (lengths, counts, stars) work on its table of distinct values
with their frequencies. That table is built with map-side counting and is as long as the longest
text at most, however many reviews there are; only it is ever ordered as a whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewloom.operators.tables import stored

def least(order: Sequence[str]) -> Column:
    """Least place in an order. A single number is hash-aggregated; several columns are not."""
    return F.min(order[0]) if len(order) == 1 else F.min(F.struct(*order))


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    """Rows with equal values, a null equal to a null."""
    out = F.lit(True)
    for a, b in zip(left, right, strict=True):
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], taken: DataFrame | None = None,
) -> DataFrame:
    """First row of every key in the given order, which numbers each row differently; none for the
    keys of ``taken``.

    Only keys and places are aggregated and shuffled. What comes of it is a table of the places that
    lose, rows of repeated or taken keys only, which is stored and taken off the whole rows. Those
    are not shuffled while that table is small enough to be broadcast, which the planner reads off
    the stored files; beyond that they are, once, by their place.
    """
    named = [f"_k{i}" for i in range(len(keys))]
    narrow = df.select(*[F.col(k).alias(n) for k, n in zip(keys, named, strict=True)], *order)
    firsts = narrow.groupBy(*[F.col(n).alias(f"_g{n}") for n in named]).agg(
        least(order).alias("_first"), F.count(F.lit(1)).alias("_n"))
    grouped = [f"_g{n}" for n in named]
    if taken is None:
        beaten = firsts.filter("_n > 1").withColumn("_taken", F.lit(False))
    else:
        # the taken keys are first reduced to those that the rows have: the big side is a filter
        # on a few columns
        present = taken.select(*[F.col(k).alias(f"_t{i}") for i, k in enumerate(keys)]).join(
            firsts.select(*grouped), _same([f"_t{i}" for i in range(len(keys))], grouped),
            "left_semi").distinct().withColumn("_taken", F.lit(True))
        beaten = firsts.join(
            present, _same(grouped, [f"_t{i}" for i in range(len(keys))]), "left").withColumn(
            "_taken", F.coalesce("_taken", F.lit(False))).filter("_n > 1 OR _taken")
    place = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    lost = narrow.join(beaten, _same(named, grouped)).filter(
        F.col("_taken") | (place > F.col("_first"))).select(
        *[F.col(c).alias(f"_l_{c}") for c in order])
    return df.join(stored(lost, "lost"), _same(order, [f"_l_{c}" for c in order]), "left_anti")


def dense_number(
    df: DataFrame, order: Sequence[str], out: str, by: Sequence[str] = (),
    start: Column | None = None,
) -> DataFrame:
    """Gap-free numbers from ``start`` (default 0) in the given order, within each ``by`` group.

    Rows are dealt to ranges of the order and stored; how many ranges is up to the session and to
    AQE, and their bounds come from a sample of the rows, so ids may lie anywhere and as far apart
    as they like. Only the sizes of ranges are added up; rows are ordered inside their range. All
    columns are shuffled, so give it narrow rows.
    """
    ranged = stored(
        df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    keys = [*by, "_range"]
    sizes = ranged.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(
        W.partitionBy(*by).orderBy("_range").rowsBetween(W.unboundedPreceding, -1))
    offsets = sizes.select(*[F.col(k).alias(f"_o_{k}") for k in keys],
                           F.coalesce(before, F.lit(0)).alias("_before"))
    number = F.row_number().over(W.partitionBy(*keys).orderBy(*order)) - F.lit(1) + F.col("_before")
    if start is not None:
        number = number + start
    return (
        ranged.join(offsets, _same(keys, [f"_o_{k}" for k in keys]))
        .withColumn(out, number.cast("long"))
        .drop("_range", "_before", *[f"_o_{k}" for k in keys])
    )


def value_counts(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., value, n)`` for the non-null values of a column."""
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(*by, F.col(col).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def running_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Adds ``before`` (rows with a smaller value) and ``total`` per group to value counts."""
    group = W.partitionBy(*by)
    ahead = group.orderBy("value").rowsBetween(W.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0))).withColumn(
        "total", F.sum("n").over(group)
    )


def average_ranks(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Adds ``rank``: ties share the mean of the places they take."""
    return running_counts(counts, by).withColumn(
        "rank", F.col("before") + (F.col("n") + 1) / F.lit(2.0)
    )


def quantile(p: float) -> Column:
    """Linearly interpolated quantile, as an aggregate over ``running_counts`` rows."""
    place = (F.col("total") - 1) * F.lit(float(p))
    low, high = F.floor(place), F.ceil(place)
    reached = F.col("before") + F.col("n")
    v_low = F.min(F.when(reached > low, F.col("value"))).cast("double")
    v_high = F.min(F.when(reached > high, F.col("value"))).cast("double")
    return v_low + (v_high - v_low) * F.max(place - low)


def quantiles(
    df: DataFrame, col: str, points: Mapping[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """One row per group with the named exact quantiles of an integer column."""
    table = running_counts(value_counts(df, col, by), by)
    return table.groupBy(*by).agg(*[quantile(p).alias(name) for name, p in points.items()])


def top_k(df: DataFrame, key: str, k: int, out: str = "n") -> DataFrame:
    """The k most frequent keys, ties by key."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias(out))
    return counts.orderBy(F.desc(out), F.asc(key)).limit(k)
