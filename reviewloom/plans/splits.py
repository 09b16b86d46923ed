"""Warehouse to time-ordered, class-balanced training splits."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.functions.columns import class_map, share
from reviewloom.operators.audit import fingerprint
from reviewloom.operators.describe import class_counts
from reviewloom.operators.sampling import oversample, shuffle_order
from reviewloom.operators.time_split import DEFAULT_RATIOS, check_ratios, cutoffs, time_split
from reviewloom.plans.warehouse import load_labelled, path_exists, read_warehouse
from reviewloom.schemas import DATASET_SPLITS, SENTIMENTS, SPLITS, STAR_RULE
from reviewloom.sources.writers import write_splits

SMALL = 100


def split_seed(seed: int) -> Column:
    """Each split draws with a seed of its own: seed, seed + 1, seed + 2."""
    out = F.lit(seed + 2)
    for i, name in enumerate(SPLITS[:2]):
        out = F.when(F.col("split") == name, seed + i).otherwise(out)
    return out


def with_sample_id(df: DataFrame) -> DataFrame:
    """``sample_id`` from review and copy; copy 0 is the original row."""
    return df.withColumn(
        "sample_id", F.concat_ws("#", F.col("review_id"), F.col("copy_no").cast("string"))
    )


def make_splits(
    labelled: DataFrame,
    train: float = DEFAULT_RATIOS[0],
    val: float = DEFAULT_RATIOS[1],
    test: float = DEFAULT_RATIOS[2],
    stratified: bool = True,
    seed: int = 42,
    boundary: str = "row",
) -> DataFrame:
    """Labelled reviews with ``split``, ``copy_no``, ``sample_id``. Balancing happens within each
    split, so no row crosses a time boundary."""
    return balance(time_split(labelled, train, val, test, boundary=boundary), stratified, seed)


def balance(cut: DataFrame, stratified: bool = True, seed: int = 42) -> DataFrame:
    """Rows of a cut with ``copy_no`` and ``sample_id``, classes lifted within each split."""
    if stratified:
        out = oversample(cut, "sentiment", "id", split_seed(seed), by=["split"])
    else:
        out = cut.withColumn("copy_no", F.lit(0).cast("long"))
    return with_sample_id(out)


def shuffled(splits: DataFrame, seed: int = 42) -> DataFrame:
    """Adds the seeded shuffle order of each split as ``shuffle_key``."""
    return shuffle_order(splits, "sample_id", split_seed(seed))


def split_summary(cut: DataFrame, balanced: DataFrame) -> DataFrame:
    """Sizes, dates and class counts per split, before and after balancing. The share of all
    rows is given on both bases, as balancing can lift it over 100."""
    raw = cut.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_raw"),
        F.min("review_date").alias("first_date"),
        F.max("review_date").alias("last_date"),
    )
    after = class_counts(balanced, ["split"])
    n = sum((F.col(s) for s in SENTIMENTS[1:]), F.col(SENTIMENTS[0]))
    total = raw.agg(F.sum("n_raw").alias("t")).scalar()
    return raw.join(after, "split").select(
        "split", "n_raw", n.alias("n"), "first_date", "last_date", *SENTIMENTS,
        share("n_raw", total).alias("pct_raw"),
        share(n, total).alias("pct_of_raw_total"),
        (total < SMALL).cast("int").alias("small"),
    )


def split_run_row(
    balanced: DataFrame,
    cut: DataFrame,
    db_source: str,
    path: str,
    ratios: tuple[float, float, float],
    platform: str | None,
    app: str | None,
    label_method: str,
    stratified: bool,
    seed: int,
    notes: str | None,
    split_at: str,
    run_id: int = 1,
) -> DataFrame:
    """The audit row of a split run."""
    per_split = (
        class_counts(balanced, ["split"])
        .join(fingerprint(balanced, by=["split"]), "split")
    )
    dist = F.to_json(class_map({s: F.col(s) for s in SENTIMENTS}))
    checksum = F.concat_ws("-", F.col("rows"), F.col("xor_hash"), F.col("sum_hash"))

    def of(name, value):
        return F.max(F.when(F.col("split") == name, value))

    zero = F.lit(0).cast("long")
    cells = per_split.agg(
        *[F.coalesce(of(s, F.col("rows")), zero).alias(f"n_{s}") for s in SPLITS],
        *[of(s, dist).alias(f"dist_{s}") for s in SPLITS],
        *[of(s, checksum).alias(f"{s}_md5") for s in SPLITS],
    )
    limits = cutoffs(cut).agg(F.max(F.struct("cutoff_train", "cutoff_val")).alias("c")).scalar()
    n_total = cut.agg(F.count(F.lit(1)).alias("n")).scalar()
    row = cells.withColumns(
        {
            "id": F.lit(run_id).cast("long"),
            "split_at": F.lit(split_at).cast("timestamp"),
            "db_source": F.lit(db_source),
            "platform_filter": F.lit(platform).cast("string"),
            "app_filter": F.lit(app).cast("string"),
            "label_method": F.lit(label_method),
            "cutoff_train": limits["cutoff_train"],
            "cutoff_val": limits["cutoff_val"],
            **{f"{s}_ratio": F.lit(float(r)) for s, r in zip(SPLITS, ratios)},
            "n_total": n_total,
            **{f"{s}_file": F.lit(f"{path}/split={s}") for s in SPLITS},
            "stratified": F.lit(int(stratified)),
            "random_seed": F.lit(seed),
            "notes": F.lit(notes).cast("string"),
        }
    )
    return row.select(*[c.split()[0] for c in DATASET_SPLITS.split(", ")])


def split_dataset(
    spark: SparkSession,
    root: str,
    out_dir: str,
    train: float = DEFAULT_RATIOS[0],
    val: float = DEFAULT_RATIOS[1],
    test: float = DEFAULT_RATIOS[2],
    platform: str | None = None,
    app: str | None = None,
    label_method: str = STAR_RULE,
    stratified: bool = True,
    seed: int = 42,
    boundary: str = "row",
    dry_run: bool = False,
    notes: str | None = None,
    warehouse: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Cut, balance and write the splits, append the audit row below ``<root>/dataset_splits``,
    and return it. A dry run returns the summary and writes nothing."""
    check_ratios(train, val, test)
    wh = warehouse or read_warehouse(spark, root)
    labelled = load_labelled(wh, platform, app, label_method)
    if labelled.isEmpty():
        raise ValueError("no labelled reviews match the filters")
    cut = time_split(labelled, train, val, test, boundary=boundary)
    balanced = balance(cut, stratified, seed)  # the boundaries are looked for once
    if dry_run:
        return split_summary(cut, balanced)
    write_splits(shuffled(balanced, seed), out_dir)
    written = spark.read.parquet(out_dir)
    originals = written.filter(F.col("copy_no") == 0)
    now = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    log = f"{root}/dataset_splits"
    run_id = 1
    if path_exists(spark, log):
        past = spark.read.schema(DATASET_SPLITS).parquet(log)
        run_id += past.agg(F.max("id")).first()[0] or 0
    row = split_run_row(written, originals, root, out_dir, (train, val, test), platform, app,
                        label_method, stratified, seed, notes, now, run_id)
    row.coalesce(1).write.mode("append").parquet(log)
    return spark.read.schema(DATASET_SPLITS).parquet(log).filter(F.col("id") == run_id)
