"""Time-ordered train / val / test split by position, without ordering the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK_ROWS = 1 << 17
DEFAULT_RATIOS = (0.70, 0.15, 0.15)


def check_ratios(train: float, val: float, test: float) -> None:
    if abs(train + val + test - 1.0) > 1e-6:
        raise ValueError(f"ratios must add up to 1, got {train + val + test:.4f}")


def _bounds(n: Column, train: float, val: float) -> tuple[Column, Column]:
    """Last positions of train and val. Products of binary floats, cut down to whole numbers."""
    n = n.cast("double")
    return (
        F.floor(n * F.lit(float(train))).cast("long"),
        F.floor(n * F.lit(float(train + val))).cast("long"),
    )


def _cuts_by_day(df: DataFrame, date: str, train: float, val: float) -> DataFrame:
    """Dates of the last train and val row, from counts per day."""
    days = df.groupBy(F.col(date).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(W.partitionBy().orderBy("day").rowsBetween(W.unboundedPreceding, 0))
    days = days.withColumn("upto", upto).withColumn("all", F.sum("n").over(W.partitionBy()))
    b1, b2 = _bounds(F.col("all"), train, val)

    def cut(bound):
        return F.min(F.when((bound > 0) & (F.col("upto") >= bound), F.col("day")))

    return days.agg(F.struct(cut(b1).alias("train"), cut(b2).alias("val")).alias("cuts"))


def _cuts_by_row(df: DataFrame, date: str, row_id: str, train: float, val: float,
                 block_rows: int) -> DataFrame:
    """``(date, id)`` of the last train and val row.

    Rows are counted per day and block of ids. A block holds at most ``block_rows`` rows even on
    a day with a third of all reviews. Day sizes are added up over the calendar and block sizes
    within each day; only the two blocks with a boundary inside are ordered row by row.
    """
    block = F.floor(F.col(row_id) / F.lit(block_rows)).cast("long")
    rows = df.select(F.col(date).alias("day"), block.alias("block"), F.col(row_id).alias("id"))
    blocks = rows.groupBy("day", "block").agg(F.count(F.lit(1)).alias("n"))
    days = blocks.groupBy("day").agg(F.sum("n").alias("day_n"))
    earlier = F.sum("day_n").over(
        W.partitionBy().orderBy("day").rowsBetween(W.unboundedPreceding, -1)
    )
    days = days.select(
        "day",
        F.coalesce(earlier, F.lit(0)).alias("day_start"),
        F.sum("day_n").over(W.partitionBy()).alias("all"),
    )
    in_day = F.sum("n").over(
        W.partitionBy("day").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    )
    placed = blocks.withColumn("in_day", F.coalesce(in_day, F.lit(0))).join(days, "day")
    start = F.col("day_start") + F.col("in_day")
    b1, b2 = _bounds(F.col("all"), train, val)
    inside = F.filter(
        F.array(F.struct(F.lit("train").alias("cut"), b1.alias("at")),
                F.struct(F.lit("val").alias("cut"), b2.alias("at"))),
        lambda b: (b["at"] > F.col("start")) & (b["at"] <= F.col("start") + F.col("n")),
    )
    targets = (
        placed.withColumn("start", start)
        .select("day", "block", "start", F.explode(inside).alias("b"))
        .select("day", "block", "b.cut", (F.col("b.at") - F.col("start")).alias("nth"))
    )
    # at most two rows: every boundary lies in exactly one block
    nth = F.row_number().over(W.partitionBy("cut", "day", "block").orderBy("id"))
    found = (
        rows.join(F.broadcast(targets), ["day", "block"])
        .withColumn("rn", nth)
        .filter(F.col("rn") == F.col("nth"))
    )

    def at(name):
        return F.max(F.when(F.col("cut") == name, F.struct("day", "id"))).alias(name)

    return found.agg(F.struct(at("train"), at("val")).alias("cuts"))


def time_split(
    df: DataFrame,
    train: float = DEFAULT_RATIOS[0],
    val: float = DEFAULT_RATIOS[1],
    test: float = DEFAULT_RATIOS[2],
    date: str = "review_date",
    row_id: str = "id",
    boundary: str = "row",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Adds ``split``. Rows are taken in the order of date and id; the first ``int(n * train)``
    are train, up to ``int(n * (train + val))`` val, the rest test.

    ``row_id`` is a unique integer. ``boundary='date'`` moves each boundary to the end of its
    day, so a day never lies in two splits. The two boundaries are looked up once and reach the
    rows as literals: the rows themselves are neither shuffled nor sorted, every use of the split
    sees the same cut, and reading one split prunes the scan by date.
    """
    check_ratios(train, val, test)
    dated = df.filter(F.col(date).isNotNull())
    d = F.col(date)
    if boundary == "date":
        cuts = _cuts_by_day(dated, date, train, val).first()["cuts"]

        def upto(name):
            return F.lit(False) if cuts[name] is None else d <= F.lit(cuts[name])

    elif boundary == "row":
        cuts = _cuts_by_row(dated, date, row_id, train, val, block_rows).first()["cuts"]

        def upto(name):
            if cuts[name] is None:
                return F.lit(False)
            day, last = F.lit(cuts[name]["day"]), F.lit(cuts[name]["id"])
            return (d < day) | ((d == day) & (F.col(row_id) <= last))

    else:
        raise ValueError(f"boundary must be 'row' or 'date', got {boundary!r}")
    in_train, in_val = upto("train"), upto("val")
    return dated.withColumn(
        "split", F.when(in_train, "train").when(in_val, "val").otherwise("test")
    )


def cutoffs(split_df: DataFrame, date: str = "review_date") -> DataFrame:
    """Dates of the last train and val row; null for an empty split."""
    return split_df.agg(
        F.max(F.when(F.col("split") == "train", F.col(date))).alias("cutoff_train"),
        F.max(F.when(F.col("split") == "val", F.col(date))).alias("cutoff_val"),
    )
