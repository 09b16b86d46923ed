"""Quality rules: base rules on words and lines, then a likelihood ratio of hashed n-grams.

Words and word pairs are hashed into a fixed number of buckets. Two multinomials over the buckets
are counted, one over trusted documents and one over all documents. A document's score is the mean
log ratio of the two over its n-grams, so its length cancels out; one threshold decides for every
document. It is read off the trusted documents: each is scored by what the other folds of them
teach, and the threshold lies below a low quantile of these scores. All of it is built-in
expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.text import shelve, stored, words

BUCKETS = 10_000
SMOOTHING = 1.0
THRESHOLD = -0.15  # nats per n-gram; only where no trusted document passes the base rules
FOLDS = 5  # of the trusted documents, by hash of the id
LOW = 0.01  # quantile of the trusted documents' scores
MARGIN = 0.5  # of the way from their median to that quantile, further down
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30  # percent
NO_SYMBOLS = r"[^#*$%&|<>]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"
NEW = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score",
       "base_failed", "kept"]


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of all documents labelled good and not toxic, each once."""
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    return labels.filter(good & F.col("doc_id").isNotNull()).select("doc_id").distinct()


def pair_hashes(hashes: Column, apart: int = 1) -> Column:
    """Hashes of each element with the one ``apart`` places on."""
    shifted = F.slice(hashes, apart + 1, F.greatest(F.size(hashes), F.lit(0)))
    both = F.zip_with(hashes, shifted, lambda a, b: F.xxhash64(a, b))
    return F.slice(both, 1, F.greatest(F.size(hashes) - apart, F.lit(0)))


def bucket(gram: Column, buckets: int) -> Column:
    return F.pmod(gram, F.lit(buckets)).cast("int")


def fold_of(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(FOLDS)).cast("int")


def bucket_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row: the log ``ratios`` of every bucket, and ``folds``, for each fold the ratios without
    its trusted documents. Zeros where no trusted document with a word is left.

    How ``trusted`` is joined is the planner's choice: give it a stored table, whose size is known.
    """
    marked = docs.select("doc_id", "text").join(
        trusted.withColumn("_fold", fold_of(F.col("doc_id"))), "doc_id", "left")
    hashed = marked.select("_fold", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("_h"))
    grams = hashed.select("_fold", F.explode(F.concat("_h", pair_hashes(F.col("_h")))).alias("_g"))
    good = [f"good{k}" for k in range(FOLDS)]
    counts = grams.groupBy(bucket(F.col("_g"), buckets).alias("bucket")).agg(
        F.count("*").alias("raw"), *[
            F.count(F.when(F.col("_fold") == k, 1)).alias(g) for k, g in enumerate(good)])
    all_buckets = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    filled = all_buckets.join(counts, "bucket", "left").na.fill(0, ["raw", *good])
    rows = filled.agg(
        F.array_sort(F.collect_list(F.struct("bucket", "raw", *good))).alias("rows"),
        F.sum("raw").alias("all_raw"), *[F.sum(g).alias(f"all_{g}") for g in good])
    smooth = F.lit(SMOOTHING)

    def ratios(used: list[str]) -> Column:
        total = sum((F.col(f"all_{g}") for g in used), F.lit(0))
        return F.transform("rows", lambda r: F.when(
            total > 0,
            F.log((sum((r[g] for g in used), F.lit(0)) + smooth) / (total + smooth * buckets))
            - F.log((r["raw"] + smooth) / (F.col("all_raw") + smooth * buckets))).otherwise(0.0))

    return rows.select(
        ratios(good).alias("ratios"),
        F.array(*[ratios([g for g in good if g != left]) for left in good]).alias("folds"))


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the base measures, ``_h`` (word hashes) and ``_b`` (hashes of word pairs).

    Repeated windows are looked for only in texts with a repeated run of four words: hashes of
    pairs make hashes of fours, and those make the hashes of windows of eight.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD_CHAR))
    a = docs.withColumn("_w", words(text)).withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": F.length(F.array_join("_w", "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(text, NO_SYMBOLS, "")).cast("long"),
        "_lines": F.when(F.contains(text, F.lit("\n")), lines),
        "_h": F.transform("_w", lambda w: F.xxhash64(w)),
    }).drop("_w")
    b = a.withColumns({
        "n_dup_lines": F.coalesce(
            F.size("_lines") - F.size(F.array_distinct("_lines")), F.lit(0)).cast("long"),
        "_b": pair_hashes(F.col("_h")),
    }).drop("_lines")
    c = b.withColumn("_four", pair_hashes(F.col("_b"), 2))
    d = c.withColumn("_eight", F.when(
        F.size(F.array_distinct("_four")) < F.size("_four"), pair_hashes(F.col("_four"), 4)))
    # (hash, start) in order; a start counts if a neighbour has its hash
    e = d.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_eight")) < F.size("_eight"),
        F.array_sort(F.transform(
            "_eight", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("_four", "_eight")
    none = F.lit(None).cast("struct<h:bigint,i:int>")
    before = F.slice(F.concat(F.array(none), F.col("_sorted")), 1, F.size("_sorted"))
    after = F.concat(F.slice("_sorted", 2, F.size("_sorted")), F.array(none))
    f = e.withColumn("_starts", F.array_sort(F.transform(F.filter(
        F.arrays_zip(F.col("_sorted").alias("x"), before.alias("y"), after.alias("z")),
        lambda p: F.coalesce(p["x"]["h"] == p["y"]["h"], F.lit(False))
        | F.coalesce(p["x"]["h"] == p["z"]["h"], F.lit(False))), lambda p: p["x"]["i"])),
    ).drop("_sorted")
    # each start covers the words up to the next start, or a whole window
    steps = F.zip_with(
        "_starts", F.slice("_starts", 2, F.size("_starts")),
        lambda s, t: F.least(F.lit(WINDOW), F.coalesce(t - s, F.lit(WINDOW))))
    return f.withColumn("n_repeat_words", F.coalesce(
        F.aggregate(steps, F.lit(0), lambda x, y: x + y), F.lit(0)).cast("long")).drop("_starts")


def scored(docs: DataFrame, ratios: Column, buckets: int) -> DataFrame:
    """``docs`` with the base measures, ``score`` by ``ratios``, and ``base_failed``."""
    a = measured(docs).withColumn("_ratios", ratios)

    def total(grams: str) -> Column:
        return F.aggregate(
            grams, F.lit(0.0), lambda x, g: x + F.get(F.col("_ratios"), bucket(g, buckets)))

    n = F.greatest(F.size("_h") + F.size("_b"), F.lit(1))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return a.withColumn("score", F.round((total("_h") + total("_b")) / n, 9)).withColumn(
        "base_failed", failed)


def fitted_threshold(
    docs: DataFrame, trusted: DataFrame, folds: Column, buckets: int = BUCKETS,
) -> DataFrame:
    """One row with the least score that is kept; null if no trusted document passes the base
    rules. Trusted documents are scored by ``folds``, the ratios without their own fold: by the
    full ratios they lie above any document that was not fitted on, the more so the fewer they are.
    """
    rows = docs.select("doc_id", "text").join(trusted, "doc_id")
    own = scored(rows, F.get(folds, fold_of(F.col("doc_id"))), buckets).select(
        F.when(~F.col("base_failed"), F.col("score")).alias("score"))
    at = own.agg(F.percentile("score", F.array(F.lit(LOW), F.lit(0.5))).alias("_at"))
    return at.select(
        (F.get("_at", F.lit(0)) - MARGIN * (F.get("_at", F.lit(1)) - F.get("_at", F.lit(0))))
        .alias("threshold"))


def quality_rules(
    docs: DataFrame, labels: DataFrame, *, buckets: int = BUCKETS, threshold: float | None = None,
) -> DataFrame:
    """``docs`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``score``, ``base_failed`` and ``kept``.

    Needs ``doc_id`` and ``text``; columns of ``docs`` with one of the new names are replaced, all
    others stay. Every row gets its own verdict, so repeated rows and repeated ids all stay. A null
    or empty text has no words and fails the base rules; a null id is judged like any other but is
    never trusted. Without a ``threshold`` it is fitted on the trusted documents. Without trusted
    documents all ratios are 0. No rows in, no rows out.

    All trusted documents are fitted on, however many. Their ids are stored, so that the planner
    knows their size: a small table is broadcast, beyond that the texts are shuffled by id.
    """
    rows, back = shelve(docs, ["doc_id", "text"], NEW)
    trusted = stored(trusted_ids(labels), "trusted")
    # one value for both uses, so that it is computed once
    learned = bucket_ratios(rows, trusted, buckets).select(
        F.struct("ratios", "folds").alias("learned")).scalar()
    if threshold is None:
        least = F.coalesce(
            fitted_threshold(rows, trusted, learned["folds"], buckets).scalar(), F.lit(THRESHOLD))
    else:
        least = F.lit(threshold)
    out = scored(rows, learned["ratios"], buckets)
    return back(out.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= least)))


def good_documents(docs: DataFrame, labels: DataFrame, **choices) -> DataFrame:
    """``docs`` without the rows that ``quality_rules`` does not keep, in the same columns.

    The row number holds the filter above the columns it reads: pushed below them it would repeat
    their expressions many times over.
    """
    rows, back = shelve(docs, ["doc_id", "text"], [])
    judged = quality_rules(rows, labels, **choices).withColumn(
        "_row", F.monotonically_increasing_id())
    return back(judged.filter(F.col("kept") & (F.col("_row") >= 0)))
