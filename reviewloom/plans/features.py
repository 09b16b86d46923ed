"""Splits to feature tables: fitted on train, applied to every split, keyed by sample."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewloom.functions.columns import share
from reviewloom.operators.audit import fingerprint
from reviewloom.operators.meta_features import apply_scaler, fit_scaler, metadata
from reviewloom.operators.tables import stored
from reviewloom.operators.text_features import (
    MAX_FEATURES,
    NEGATIONS,
    NGRAM_MAX,
    aspects,
    check_fit,
    fit_vocab,
    lexicon_sentiment,
    no_sentiment,
    tfidf_transform,
    to_vectors,
)
from reviewloom.schemas import SPLITS
from reviewloom.sources.readers import read_splits
from reviewloom.sources.writers import load_model, save_model, write_features

SPLIT = ["split"]


def labels(df: DataFrame) -> DataFrame:
    return df.select("sample_id", "review_id", "split", "sentiment")


def apply_model(df: DataFrame, model: Mapping[str, DataFrame], ngram_max: int = NGRAM_MAX,
                keep: Sequence[str] = ()) -> dict[str, DataFrame]:
    """TF-IDF cells and scaled metadata of new text from fitted tables. ``df`` has a
    ``sample_id`` and a ``review_text``."""
    return {
        "tfidf": tfidf_transform(df, model["vocab"], ngram_max=ngram_max, keep=keep),
        "meta": apply_scaler(metadata(df, keep=keep), model["scaler"]),
    }


def assemble(families: Mapping[str, DataFrame]) -> DataFrame:
    """All families side by side, one row per sample, TF-IDF as index and value arrays."""
    out = families["labels"]
    vectors = to_vectors(families["tfidf"])
    nothing = F.array()
    out = out.join(vectors, "sample_id", "left").withColumns(
        {
            "indices": F.coalesce("indices", nothing.cast("array<int>")),
            "values": F.coalesce("values", nothing.cast("array<double>")),
        }
    )
    for name in ("meta", "lexicon", "aspects"):
        if name in families:
            family = families[name]
            out = out.join(family.drop("split"), "sample_id")
    return out


def alignment(families: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per split and family beside the labels, and how many keys have no counterpart."""
    base = families["labels"].select("sample_id", "split", F.lit(1).alias("l"))
    out = None
    for name, df in families.items():
        if name in ("labels", "tfidf"):
            continue
        both = base.join(df.select("sample_id", "split", F.lit(1).alias("f")),
                         ["sample_id", "split"], "full_outer")
        one = both.groupBy("split").agg(
            F.count("l").alias("n_labels"),
            F.count("f").alias("n_family"),
            F.count_if(F.col("l").isNull() | F.col("f").isNull()).alias("unmatched"),
        ).select(F.lit(name).alias("family"), "*")
        out = one if out is None else out.unionByName(one)
    return out.withColumn("aligned", (F.col("unmatched") == 0).cast("int"))


def same_keys(families: Mapping[str, DataFrame]) -> DataFrame:
    """``(family, split, n_labels, n_family, aligned)``: whether a family has just the samples of
    the labels, by fingerprints of the keys, which need no join of the families.

    TF-IDF has no row for a sample without known terms and several for one with many, so its
    distinct keys are compared with those labels that it has.
    """
    def prints(df: DataFrame, name: str) -> DataFrame:
        keys = fingerprint(df, ["sample_id"], by=["split"])
        return keys.select("split", *[F.col(c).alias(f"{name}_{c}") for c in keys.columns[1:]])

    label_keys = families["labels"].select("sample_id", "split")
    base, out = prints(label_keys, "l"), None
    for name, df in families.items():
        if name == "labels":
            continue
        own = df.select("sample_id", "split")
        mine, wanted = own, base
        if name == "tfidf":
            mine = own.distinct()
            wanted = prints(label_keys.join(mine, "sample_id", "left_semi"), "l")
        met = wanted.join(prints(mine, "f"), "split", "full_outer")
        equal = F.lit(True)
        for c in ("rows", "xor_hash", "sum_hash"):
            equal = equal & F.col(f"l_{c}").eqNullSafe(F.col(f"f_{c}"))
        one = met.select(
            F.lit(name).alias("family"), "split",
            F.coalesce("l_rows", F.lit(0)).alias("n_labels"),
            F.coalesce("f_rows", F.lit(0)).alias("n_family"), equal.cast("int").alias("aligned"))
        out = one if out is None else out.unionByName(one)
    return out


def split_distribution(df: DataFrame) -> DataFrame:
    """Class shares per split to one decimal."""
    counts = df.groupBy("split", "sentiment").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(W.partitionBy("split"))
    return counts.withColumn("pct", F.round(share("n", total), 1))


def feature_report(splits: DataFrame, families: Mapping[str, DataFrame], vocab: DataFrame):
    """Headline numbers as ``(section, split, item, value)``; lengths are means of raw lengths."""
    def rows(section, df, *cells):
        pairs = F.explode(F.array(*[
            F.struct(F.lit(i).alias("item"), F.col(c).cast("double").alias("value"))
            for i, c in cells
        ])).alias("x")
        split = F.col("split") if "split" in df.columns else F.lit("all")
        return df.select(F.lit(section).alias("section"), split.alias("split"), pairs).select(
            "section", "split", "x.item", "x.value"
        )

    one = F.count(F.lit(1))
    sizes = splits.groupBy("split").agg(
        one.alias("n"), F.avg(F.coalesce("review_length", F.lit(0))).alias("mean_length")
    )
    out = rows("splits", sizes, ("rows", "n"), ("mean_review_length", "mean_length"))
    size = vocab.agg(one.alias("n"))
    out = out.unionByName(rows("tfidf", size, ("vocabulary", "n")))
    per_split = families["tfidf"].groupBy("split").agg(one.alias("nnz")).join(sizes, "split")
    width = size.scalar().cast("double")
    density = per_split.withColumn(
        "density", F.try_divide(F.col("nnz").cast("double"), F.col("n") * width)
    )
    out = out.unionByName(rows("tfidf", density, ("nnz", "nnz"), ("density", "density")))
    if "lexicon" in families:
        scores = families["lexicon"].groupBy("split").agg(
            F.avg("polarity").alias("mean"), F.stddev_samp("polarity").alias("std")
        )
        out = out.unionByName(rows("lexicon", scores, ("polarity_mean", "mean"),
                                   ("polarity_std", "std")))
    if "aspects" in families:
        flags = [c for c in families["aspects"].columns if c.startswith("aspect_")]
        covered = families["aspects"].filter(F.col("split") == SPLITS[0]).groupBy("split").agg(
            *[(F.avg(c) * 100).alias(c) for c in flags]
        )
        out = out.unionByName(rows("aspects", covered, *[(f"{c}_pct", c) for c in flags]))
    return out


def build_features(
    spark: SparkSession,
    splits_dir: str,
    out_dir: str,
    lexicon: DataFrame | None = None,
    dictionary: Mapping[str, Sequence[str]] | None = None,
    max_features: int = MAX_FEATURES,
    ngram_max: int = NGRAM_MAX,
    drop_label_proxy: bool = False,
    dry_run: bool = False,
    negations: Sequence[str] = NEGATIONS,
) -> DataFrame:
    """Read the splits, fit on train, write every family and the fitted tables, and return the
    report. Without a lexicon polarity is 0.0; without a dictionary there are no aspects."""
    splits = read_splits(spark, splits_dir)
    train = splits.filter(F.col("split") == SPLITS[0])
    check_fit(train.count())
    if dry_run:
        return split_distribution(splits)
    raw_meta = stored(metadata(splits, keep=SPLIT, drop_label_proxy=drop_label_proxy), "meta")
    features = [c for c in raw_meta.columns if c not in ("sample_id", "split")]
    save_model(
        fit_vocab(train, ngram_max=ngram_max, max_features=max_features),
        fit_scaler(raw_meta.filter(F.col("split") == SPLITS[0]), features),
        f"{out_dir}/model",
    )
    # from here on everything uses the written model, as scoring new text will
    model = load_model(spark, f"{out_dir}/model")
    if model["vocab"].isEmpty():
        raise ValueError("no term is left after pruning")
    families = apply_model(splits, model, ngram_max, SPLIT)
    families["meta"] = apply_scaler(raw_meta, model["scaler"])
    families["lexicon"] = (
        lexicon_sentiment(splits, lexicon, keep=SPLIT, negations=negations)
        if lexicon is not None
        else no_sentiment(splits, keep=SPLIT)
    )
    if dictionary:
        families["aspects"] = aspects(splits, dictionary, keep=SPLIT)
    families["labels"] = labels(splits)
    write_features(families, out_dir)
    written = {name: spark.read.parquet(f"{out_dir}/{name}") for name in families}
    return feature_report(splits, written, model["vocab"])
