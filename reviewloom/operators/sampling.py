"""Seeded sampling. Draws come from a hash of seed and row, so a run can be repeated anywhere."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewloom.functions.columns import portable_hash
from reviewloom.operators.order_stats import dense_number
from reviewloom.operators.tables import literal_rows

DRAWS_PER_TASK = 1 << 16
COPIES_PER_TASK = 1 << 10


def shuffle_order(df: DataFrame, id_col: str, seed: Column | int, out: str = "shuffle_key"):
    """Adds the key whose order is the seeded shuffle; sorting by it is a range-partitioned sort."""
    seed = F.lit(seed) if isinstance(seed, int) else seed
    return df.withColumn(out, F.md5(F.concat_ws("|", seed.cast("string"), F.col(id_col))))


def sample_n(df: DataFrame, n: int, seed: int, id_col: str) -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement. Each task keeps its n best rows."""
    hashed = df.withColumn("_h", portable_hash(F.lit(seed), F.col(id_col)))
    return hashed.orderBy("_h", id_col).limit(n).drop("_h")


def class_needs(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per class and how many draws lift it to the largest class of its group."""
    sizes = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("size"))
    largest = F.max("size").over(W.partitionBy(*by))
    return sizes.withColumn("need", largest - F.col("size"))


def expand_copies(
    df: DataFrame, extra: str, id_col: str, per_task: int = COPIES_PER_TASK
) -> DataFrame:
    """Each row as copy 0 plus ``extra`` further copies, numbered in ``copy_no``. Rows with many copies are cut into pieces that are spread over tasks before they
    unfold."""
    zero = F.lit(0).cast("long")

    def unfold(rows, first, last):
        return rows.withColumn("copy_no", F.explode(F.sequence(first, last)))

    few = unfold(df.filter(F.col(extra) < per_task), zero, F.col(extra))
    pieces = F.sequence(zero, F.floor(F.col(extra) / F.lit(per_task)).cast("long"))
    first = F.col("_piece") * F.lit(per_task)
    cut = df.filter(F.col(extra) >= per_task).withColumn("_piece", F.explode(pieces))
    many = unfold(
        cut.repartition(id_col, "_piece"), first,
        F.least(first + F.lit(per_task - 1), F.col(extra)),
    )
    return few.unionByName(many.drop("_piece")).drop(extra)


def draw_counts(
    spark: SparkSession, classes: Sequence[Row], group: Sequence[str], types: Mapping[str, str]
) -> DataFrame:
    """``(group..., _ordinal, _extra)``: how often each ordinal is drawn. Draws are made in
    blocks spread over tasks and counted before the shuffle."""
    names = [*group, "size", "need", "_seed"]
    table = literal_rows(spark, [tuple(r[c] for c in names) for r in classes], names)
    table = table.withColumns({c: F.col(c).cast(types[c]) for c in group})
    pieces = F.floor((F.col("need") - 1) / F.lit(DRAWS_PER_TASK)).cast("long")
    first = F.col("_piece") * F.lit(DRAWS_PER_TASK)
    last = F.least(first + F.lit(DRAWS_PER_TASK), F.col("need")) - 1
    pieced = table.withColumn(
        "_piece", F.explode(F.sequence(F.lit(0).cast("long"), pieces))
    ).repartition(*group, "_piece")
    draw = portable_hash(F.col("_seed"), F.col(group[-1]), F.col("_k"))
    return (
        pieced.withColumn("_k", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
        .withColumn("_ordinal", F.pmod(draw, F.col("size")).cast("long"))
        .groupBy(*group, "_ordinal")
        .agg(F.count(F.lit(1)).alias("_extra"))
    )


def oversample(
    df: DataFrame,
    label: str,
    id_col: str,
    seed: Column | int = 42,
    by: Sequence[str] = (),
) -> DataFrame:
    """Lift every class of each group to the size of the largest one, with replacement.

    All original rows stay (``copy_no`` 0). A class of n rows that needs m more gets m draws;
    draw k takes the row with ordinal ``hash(seed, class, k) mod n``. Class sizes, one row per
    class, come to the driver. Draws are counted per ordinal before they meet the data, so a
    class of three rows that needs a billion draws does not put a billion rows on one join key,
    and only rows of classes that lack some are numbered.
    """
    seed = F.lit(seed) if isinstance(seed, int) else seed
    group = [*by, label]
    classes = class_needs(df, label, by).withColumn("_seed", seed).collect()
    lacking = [r for r in classes if r["need"] > 0]
    if not lacking:
        return df.withColumn("copy_no", F.lit(0).cast("long"))
    lacks = F.lit(False)
    for r in lacking:
        same = F.lit(True)
        for c in group:
            same = same & F.col(c).eqNullSafe(F.lit(r[c]))
        lacks = lacks | same
    copies = draw_counts(df.sparkSession, lacking, group, dict(df.dtypes))
    rows = df.filter(lacks).select(*group, id_col)
    ordinals = dense_number(rows, [id_col], "_ordinal", by=group)
    drawn = copies.select(*[F.col(c).alias(f"_d_{c}") for c in group],
                          F.col("_ordinal").alias("_d"), "_extra")
    met = F.col("_ordinal") == F.col("_d")
    for c in group:
        met = met & F.col(c).eqNullSafe(F.col(f"_d_{c}"))
    per_row = ordinals.join(drawn, met).select(id_col, "_extra")
    counted = df.filter(lacks).join(per_row, id_col, "left").withColumn(
        "_extra", F.coalesce("_extra", F.lit(0)).cast("long")
    )
    rest = df.filter(~lacks).withColumn("copy_no", F.lit(0).cast("long"))
    return rest.unionByName(expand_copies(counted, "_extra", id_col).select(rest.columns))
