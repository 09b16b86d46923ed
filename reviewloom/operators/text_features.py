"""TF-IDF, lexicon polarity and aspect flags.

A document is keyed by ``sample_id``. Fitting looks at training rows only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewloom.functions.columns import (
    lower_without_urls,
    mentions,
    ngrams,
    word_tokens,
)
from reviewloom.operators.batch_terms import term_freq
from reviewloom.session import ship_package

# Fitting limits.
MAX_FEATURES = 15_000
NGRAM_MAX = 2
MIN_DF = 3
MAX_DF = 0.95

SLOTS = 1 << 14  # of the array in which terms are looked up; only its speed depends on it


def documents(df: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """``(sample_id, keep..., _texts)``: one row per document with its texts, mostly one. This moves
    each text once; all that follows looks at one row at a time."""
    return df.groupBy("sample_id", *keep).agg(F.collect_list(text).alias("_texts"))


def text_terms(text: Column, ngram_max: int) -> Column:
    """All 1..n-grams of the normalised text. White space separates tokens in any amount, so it
    need not be collapsed here."""
    return ngrams(word_tokens(lower_without_urls(text)), ngram_max)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def run_lengths(items: Column, key: Callable[[Column], Column]) -> Column:
    """``struct(item, n)`` for every run of equal keys in a sorted array, with its length."""
    def runs(x: Column) -> Column:
        size = F.size(x)
        places = F.filter(
            F.sequence(F.lit(0), size - 1),
            lambda i: F.coalesce(key(F.get(x, i)) != key(F.get(x, i - 1)), F.lit(True)))
        return bound(F.when(size > 0, places).otherwise(F.array().cast("array<int>")),
                     lambda at: F.zip_with(
                         at, F.slice(at, F.lit(2), F.size(at)),
                         lambda a, b: F.struct(F.get(x, a).alias("item"),
                                               (F.coalesce(b, size) - a).alias("n"))))

    return bound(items, runs)


def counted_terms(terms: Column) -> Column:
    """``struct(item, n)`` for every term of an array."""
    return run_lengths(F.sort_array(terms), lambda t: t)


def term_counts(df: DataFrame, text: str = "review_text", ngram_max: int = NGRAM_MAX) -> DataFrame:
    """``(sample_id, term, tf)``.

    Terms unfold to several times the text, so they are sorted and counted inside their document's
    row; no table of terms is kept, shuffled or spilled.
    """
    terms = F.flatten(F.transform("_texts", lambda t: text_terms(t, ngram_max)))
    cells = documents(df, text).select("sample_id", F.explode(counted_terms(terms)).alias("_c"))
    return cells.select("sample_id", F.col("_c.item").alias("term"),
                        F.col("_c.n").cast("long").alias("tf"))


def doc_freq(counts: DataFrame) -> DataFrame:
    """``(term, df, total)``: documents with the term, occurrences in all of them."""
    return counts.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total")
    )


def corpus_freq(df: DataFrame, text: str = "review_text", ngram_max: int = NGRAM_MAX) -> DataFrame:
    """``(term, df, total)`` straight from texts, without counting per document first.

    Both numbers are counted in the tasks that read the texts, an Arrow batch at a time, so a term is
    one row per batch and not one per occurrence. What is shuffled are partial counts, never a text.
    """
    ship_package(df.sparkSession)
    words = word_tokens(lower_without_urls(F.coalesce(F.col(text), F.lit(""))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from term_freq(batch.column(0), ngram_max)

    counts = df.select(words.alias("words")).mapInArrow(count, "term string, df long, total long")
    # most terms are rare: adding them up once more before they are dealt would fill each task's
    # memory with them and hardly leave fewer
    return counts.repartition("term").groupBy("term").agg(
        F.sum("df").alias("df"), F.sum("total").alias("total"))


def prune(freq: DataFrame, n_docs: Column, min_df: int = MIN_DF, max_df: float = MAX_DF):
    """Terms in at least ``min_df`` documents and at most the share ``max_df`` of them."""
    return freq.filter((F.col("df") >= min_df) & (F.col("df") <= n_docs * F.lit(max_df)))


def limit_vocab(freq: DataFrame, k: int = MAX_FEATURES) -> DataFrame:
    """The k terms with most occurrences, ties by term."""
    return freq.orderBy(F.desc("total"), F.asc("term")).limit(k)


def index_vocab(vocab: DataFrame, n_docs: Column) -> DataFrame:
    """``(term, term_idx, df, idf)``: alphabetical index and smoothed inverse frequency. The
    window sees the vocabulary only, which ``limit_vocab`` bounds."""
    idf = F.ln((n_docs + 1.0) / (F.col("df") + 1.0)) + 1.0
    at = F.row_number().over(W.partitionBy().orderBy("term")) - 1
    return vocab.select("term", at.alias("term_idx"), "df", idf.alias("idf"))


def fit_vocab(
    train: DataFrame,
    text: str = "review_text",
    ngram_max: int = NGRAM_MAX,
    max_features: int = MAX_FEATURES,
    min_df: int = MIN_DF,
    max_df: float = MAX_DF,
) -> DataFrame:
    """Vocabulary of the training rows."""
    n_docs = train.agg(F.count(F.lit(1)).alias("n")).scalar()
    freq = corpus_freq(train, text, ngram_max)
    return index_vocab(limit_vocab(prune(freq, n_docs, min_df, max_df), max_features), n_docs)


def lookup_table(vocab: DataFrame) -> Column:
    """The vocabulary as one value: an array of ``SLOTS`` arrays of ``struct(term_idx, idf, term)``,
    in which a term lies at its hash."""
    slots = vocab.groupBy(F.pmod(F.xxhash64("term"), F.lit(SLOTS)).cast("int").alias("slot")).agg(
        F.collect_list(F.struct("term_idx", "idf", "term")).alias("terms"))
    every = vocab.sparkSession.range(SLOTS).select(F.col("id").cast("int").alias("slot"))
    filled = every.join(slots, "slot", "left")
    whole = F.array_sort(F.collect_list(F.struct("slot", "terms")))
    return filled.agg(F.transform(whole, lambda s: s["terms"]).alias("table")).scalar()


def check_fit(n_docs: int, min_df: int = MIN_DF, max_df: float = MAX_DF) -> None:
    if max_df * n_docs < min_df:
        raise ValueError(f"{n_docs} training documents are too few for min_df={min_df}")


def tfidf_transform(
    df: DataFrame,
    vocab: DataFrame,
    text: str = "review_text",
    ngram_max: int = NGRAM_MAX,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``(sample_id, term_idx, value)``: sub-linear TF times IDF, unit length per document.

    The vocabulary holds at most ``max_features`` rows by construction. It reaches the rows as one
    scalar, an array in which a term is looked up by hash. Terms are looked up, counted, weighted
    and normalised inside their document's row, so no cell is shuffled, sorted or spilled.
    ``keep`` carries further columns, such as the split, along.
    """
    def hit(t: Column) -> Column:
        slot = F.pmod(F.xxhash64(t), F.lit(SLOTS)).cast("int")
        return F.get(F.filter(F.get("_table", slot), lambda v: v["term"] == t), F.lit(0))

    known = F.flatten(F.transform("_texts", lambda t: F.filter(
        F.transform(text_terms(t, ngram_max), hit), lambda v: v.isNotNull())))
    counts = run_lengths(F.sort_array(known), lambda c: c["term_idx"])
    weights = F.transform(counts, lambda c: F.struct(
        c["item"]["term_idx"].alias("term_idx"),
        ((F.lit(1.0) + F.ln(c["n"])) * c["item"]["idf"]).alias("w")))

    def normalised(cells: Column) -> Column:
        norm = F.sqrt(F.aggregate(cells, F.lit(0.0), lambda x, c: x + c["w"] * c["w"]))
        return bound(norm, lambda d: F.transform(cells, lambda c: F.struct(
            c["term_idx"].alias("term_idx"), (c["w"] / d).alias("value"))))

    # a column of its own for the cells: unfolded in place, every row would carry the table
    rows = documents(df, text, keep).withColumn("_table", lookup_table(vocab)).select(
        "sample_id", *keep, bound(weights, normalised).alias("_cells"))
    rows = rows.select("sample_id", *keep, F.explode("_cells").alias("_c"))
    return rows.select("sample_id", *keep, "_c.term_idx", "_c.value")


def to_vectors(cells: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per document with index and value arrays in index order, bounded by the
    vocabulary."""
    pairs = F.sort_array(F.collect_list(F.struct("term_idx", "value")))
    return cells.groupBy("sample_id", *keep).agg(pairs.alias("p")).select(
        "sample_id", *keep, F.col("p.term_idx").alias("indices"), F.col("p.value").alias("values")
    )


def matrix_stats(cells: DataFrame, docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """Shape and density of the matrix, documents without cells included."""
    one = F.count(F.lit(1))
    rows, cols = docs.agg(one.alias("n")).scalar(), vocab.agg(one.alias("n")).scalar()
    return cells.agg(one.alias("nnz")).select(
        rows.alias("n_rows"), cols.alias("n_cols"), "nnz",
        F.try_divide(F.col("nnz").cast("double"), rows.cast("double") * cols.cast("double"))
        .alias("density"),
    )


# --- lexicon polarity ----------------------------------------------------------------------

# Words that turn the meaning of the next scored word. A word with the contracted
# form at its end ("don't") is one as well.
NEGATIONS = ["no", "not", "never"]
CONTRACTED = "n't"
NEGATION_FACTOR = -0.5


def folded(text: Column) -> Column:
    """Lower case, with one kind of apostrophe."""
    return F.replace(F.lower(text), F.lit("’"), F.lit("'"))


def lexicon_sentiment(
    df: DataFrame,
    lexicon: DataFrame,
    text: str = "review_text",
    keep: Sequence[str] = (),
    negations: Sequence[str] = tuple(NEGATIONS),
) -> DataFrame:
    """``(sample_id, polarity, subjectivity)`` as means over the scored words of a text.

    ``lexicon(word, polarity, subjectivity, intensity)`` is a table of the user. Words that differ
    in case or apostrophe only are one word, with the means of their values. A lexicon word right
    after a word of intensity other than 1 is multiplied by it and clipped to [-1, 1] ([0, 1] for
    subjectivity); the modifier itself is then not scored. After a negation, also with one modifier
    in between, polarity is multiplied by -0.5. No scored word gives 0.0 for both.

    The lexicon is joined once, by word; only its words and negations go on, and look at their
    neighbours inside their text.
    """
    tokens = F.regexp_extract_all(
        folded(F.coalesce(F.col(text), F.lit(""))), F.lit(r"[\p{L}\p{N}_']+"), F.lit(0)
    )
    positioned = df.select("sample_id", F.posexplode(tokens).alias("_i", "_word"))
    words = lexicon.groupBy(folded(F.col("word")).alias("_word")).agg(
        F.avg("polarity").alias("polarity"), F.avg("subjectivity").alias("subjectivity"),
        F.avg(F.coalesce("intensity", F.lit(1.0))).alias("_own"), F.count("*").alias("_found"),
    )
    negation = F.col("_word").isin(list(negations)) | F.endswith(
        F.col("_word"), F.lit(CONTRACTED))
    marked = positioned.join(words, "_word", "left").select(
        "sample_id", "_i", "polarity", "subjectivity", "_own",
        F.col("_found").isNotNull().alias("_hit"), negation.alias("_neg"),
    ).filter("_hit or _neg")

    order = W.partitionBy("sample_id").orderBy("_i")
    one, zero, no = F.lit(1.0), F.lit(0.0), F.lit(False)
    row = F.struct("_i", "_own", "_hit", "_neg")
    near = marked.withColumns({
        "_p1": F.lag(row, 1).over(order), "_p2": F.lag(row, 2).over(order),
        "_n1": F.lead(row, 1).over(order),
    })
    i = F.col("_i")
    is_prev = F.coalesce(F.col("_p1._i") == i - 1, no)
    next_hit = F.coalesce((F.col("_n1._i") == i + 1) & F.col("_n1._hit"), no)
    by = F.when(is_prev & F.col("_p1._hit") & (F.col("_p1._own") != 1.0), F.col("_p1._own"))
    two_back = F.coalesce((F.col("_p2._i") == i - 2) & F.col("_p2._neg"), no)
    negated = (is_prev & F.coalesce("_p1._neg", no)) | (by.isNotNull() & two_back)
    factor = F.coalesce(by, one)
    p = F.least(F.greatest(F.col("polarity") * factor, F.lit(-1.0)), one)
    s = F.least(F.greatest(F.col("subjectivity") * factor, zero), one)
    scored = F.col("_hit") & ~((F.col("_own") != 1.0) & next_hit)
    scores = near.select(
        "sample_id", F.when(scored, p * F.when(negated, NEGATION_FACTOR).otherwise(1.0))
        .alias("_p"), F.when(scored, s).alias("_s"),
    ).groupBy("sample_id").agg(F.avg("_p").alias("polarity"), F.avg("_s").alias("subjectivity"))
    return df.select("sample_id", *keep).join(scores, "sample_id", "left").select(
        "sample_id", *keep,
        F.coalesce("polarity", zero).alias("polarity"),
        F.coalesce("subjectivity", zero).alias("subjectivity"),
    )


def no_sentiment(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Stand-in with the same columns when scoring is turned off."""
    return df.select("sample_id", *keep, F.lit(0.0).alias("polarity"),
                     F.lit(0.0).alias("subjectivity"))


# --- aspects -------------------------------------------------------------------------------


def aspects(
    df: DataFrame,
    dictionary: Mapping[str, Sequence[str]],
    text: str = "review_text",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One 0/1 column per aspect of the user's dictionary (aspect to keywords), a projection."""
    return df.select(
        "sample_id", *keep,
        *[mentions(text, words).alias(f"aspect_{name}") for name, words in dictionary.items()],
    )
