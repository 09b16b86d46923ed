"""Text, metadata, lexicon and aspect features."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewloom.functions import columns as C
from reviewloom.functions.columns import SPACE, WORD
from reviewloom.operators import meta_features as M
from reviewloom.operators import text_features as T
from reviewloom.operators.tables import stored
from reviewloom.plans import features as P
from reviewloom.plans.splits import make_splits
from reviewloom.registry import views as V
from reviewloom.registry.row_queries import normal_sql
from reviewloom.registry.split_queries import split_ctes
from reviewloom.registry.views import r6
from reviewloom.session import shared_dir
from reviewloom.sources.writers import load_model, save_model, write_splits

K = T.MAX_FEATURES
SPLIT = ["split"]
DICTIONARY = {
    "ui": ["the", "un"],
    "performance": ["of the", "la de"],
    "login": ["worthless", "and"],
    "pricing": ["por", "das"],
}
NEGATIONS = [*T.NEGATIONS, "of", "de"]


def splits(spark, sf):
    return make_splits(V.reviews(spark, sf), stratified=False)


def train_rows(spark, sf):
    return splits(spark, sf).filter(F.col("split") == "train")


def rows_of(df):
    return df.agg(F.count("*").alias("n")).scalar()


# --- TF-IDF --------------------------------------------------------------------------------

GRAM_CTES = [
    f"""tk AS (SELECT id, split,
    regexp_extract_all({normal_sql('review_text')}, '{WORD}{{2,}}') AS t FROM sp)""",
    """gr AS (
  SELECT id, split, unnest(list_concat(t,
    list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term FROM tk)""",
    "tc AS (SELECT id, split, term, count(*) AS tf FROM gr GROUP BY 1, 2, 3)",
    "nt AS (SELECT count(*) AS n FROM sp WHERE split = 'train')",
    """fq AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total FROM tc
  WHERE split = 'train' GROUP BY 1)""",
    "pr AS (SELECT fq.* FROM fq, nt WHERE df >= 3 AND df <= 0.95::DOUBLE * n)",
    f"kp AS (SELECT * FROM pr ORDER BY total DESC, term LIMIT {K})",
    """vc AS (
  SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_idx, df,
    ln((1 + n)::DOUBLE / (1 + df)) + 1 AS idf FROM kp, nt)""",
    """wt AS (SELECT id, split, term_idx, (1 + ln(tf)) * idf AS w FROM tc JOIN vc USING (term))""",
    """xf AS (
  SELECT id || '#0' AS sample_id, split, term_idx,
    w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS value FROM wt)""",
]


def G(sql: str, *ctes: str) -> str:
    return V.with_reviews(sql, *split_ctes(), *GRAM_CTES, *ctes)


def gram_lists(spark, sf):
    t = C.ngrams(C.word_tokens(C.normalise_text("review_text")), 3)
    return V.reviews(spark, sf).select(
        "review_id", F.size(t).alias("n"), F.md5(F.array_join(t, "|")).alias("grams_md5")
    )


TRIGRAM_SQL = f"""SELECT review_id, len(g) AS n, md5(array_to_string(g, '|')) AS grams_md5 FROM (
  SELECT review_id, list_concat(t,
    list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]),
    list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2]))
    AS g FROM (SELECT review_id,
    regexp_extract_all({normal_sql('review_text')}, '{WORD}{{2,}}') AS t FROM rv))"""


def frequencies(spark, sf):
    return T.corpus_freq(train_rows(spark, sf))


def counts(spark, sf):
    """Per document: distinct terms, occurrences and the most frequent term's count."""
    return T.term_counts(splits(spark, sf)).groupBy("sample_id").agg(
        F.count("*").alias("terms"), F.sum("tf").alias("grams"), F.max("tf").alias("top")
    )


def pruned(spark, sf):
    train = train_rows(spark, sf)
    return T.prune(T.corpus_freq(train), rows_of(train))


def limited(spark, sf):
    return T.limit_vocab(pruned(spark, sf), K)


def vocabulary(spark, sf):
    return r6(T.fit_vocab(train_rows(spark, sf), max_features=K))


def cells(spark, sf):
    """Fitted on train, applied to every split."""
    df = splits(spark, sf)
    vocab = T.fit_vocab(df.filter(F.col("split") == "train"), max_features=K)
    return T.tfidf_transform(df, vocab, keep=SPLIT), df, vocab


def transformed(spark, sf):
    return r6(cells(spark, sf)[0])


def matrix(spark, sf):
    x, df, vocab = cells(spark, sf)
    return r6(T.matrix_stats(x, df, vocab))


# --- metadata ------------------------------------------------------------------------------

META_SQL = f"""SELECT id || '#0' AS sample_id, split, review_length::DOUBLE AS review_length,
    word_count::DOUBLE AS word_count,
    coalesce(length(regexp_replace(review_text, '{SPACE}+', '', 'g'))::DOUBLE
      / nullif({V.words_sql('review_text')}, 0), 0) AS avg_word_len,
    (length(review_text) - length(replace(review_text, '!', '')))::DOUBLE AS exclamation_count,
    (length(review_text) - length(replace(review_text, '?', '')))::DOUBLE AS question_count,
    ((length(review_text) - length(replace(review_text, '...', ''))) / 3)::DOUBLE
      AS ellipsis_count,
    length(regexp_replace(review_text, '[^\\p{{Lu}}]', '', 'g'))
      / greatest(length(review_text), 1)::DOUBLE AS uppercase_ratio,
    coalesce(star_rating, 0)::DOUBLE AS star_rating,
    (nullif(title, '') IS NOT NULL)::INTEGER::DOUBLE AS has_title FROM sp"""
FEATURES = ["review_length", "word_count", "avg_word_len", "exclamation_count", "question_count",
            "ellipsis_count", "uppercase_ratio", "star_rating", "has_title"]
SCALER_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, avg({c}) AS mean, "
    f"CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1 END AS scale "
    "FROM mt WHERE split = 'train'" for c in FEATURES
)
META_CTES = [f"mt AS ({META_SQL})", f"sc AS ({SCALER_SQL})"]


def Q(sql: str, *ctes: str) -> str:
    return V.with_reviews(sql, *split_ctes(), *META_CTES, *ctes)


def scaled_sql(source: str) -> str:
    return ", ".join(
        f"round(({c} - (SELECT mean FROM sc WHERE feature = '{c}'))"
        f" / (SELECT scale FROM sc WHERE feature = '{c}'), 6) + 0.0 AS {c}" for c in FEATURES
    )


def meta(spark, sf):
    return r6(M.metadata(splits(spark, sf), keep=SPLIT))


def computed_meta(spark, sf):
    """Texts without given lengths, stars or titles: everything is computed."""
    return r6(M.metadata(V.chats(spark, sf).select("sample_id", "review_text")))


CHAT_META_SQL = V.with_chats(f"""SELECT sample_id, review_length::DOUBLE AS review_length,
  word_count::DOUBLE AS word_count, round(coalesce(
    length(regexp_replace(review_text, '{SPACE}+', '', 'g'))::DOUBLE / nullif(word_count, 0), 0), 6)
    AS avg_word_len,
  (length(review_text) - length(replace(review_text, '!', '')))::DOUBLE AS exclamation_count,
  (length(review_text) - length(replace(review_text, '?', '')))::DOUBLE AS question_count,
  ((length(review_text) - length(replace(review_text, '...', ''))) / 3)::DOUBLE AS ellipsis_count,
  round(length(regexp_replace(review_text, '[^\\p{{Lu}}]', '', 'g'))
    / greatest(length(review_text), 1)::DOUBLE, 6) AS uppercase_ratio,
  0.0::DOUBLE AS star_rating, 0.0::DOUBLE AS has_title FROM ch""")


def scaler(spark, sf):
    return r6(M.fit_scaler(M.metadata(train_rows(spark, sf))))


def raw_meta(df):
    """Unscaled features as a table of their own: fitting and scaling read its narrow rows, so each
    text is joined and measured once."""
    return stored(M.metadata(df, keep=SPLIT), "meta")


def scaled(spark, sf):
    raw = raw_meta(splits(spark, sf))
    return r6(M.apply_scaler(raw, M.fit_scaler(raw.filter(F.col("split") == "train"))))


# --- lexicon -------------------------------------------------------------------------------


def lexicon(spark, sf):
    """A lexicon from the words of the benchmark texts, scores from their hashes."""
    words = V.table(spark, sf, "benchmark").select(
        F.explode(F.regexp_extract_all(F.lower("text"), F.lit(f"{WORD}{{2,}}"), F.lit(0)))
        .alias("word")
    ).distinct()
    h = C.portable_hash("word")
    return words.select(
        "word",
        ((h % 201 - 100) / F.lit(100.0)).alias("polarity"),
        ((h % 101) / F.lit(100.0)).alias("subjectivity"),
        F.when(h % 7 == 0, 1.3).when(h % 7 == 1, 0.5).otherwise(1.0).alias("intensity"),
    )


def _negation(there: str, word: str) -> str:
    return f"({there} AND ({word} IN {tuple(NEGATIONS)} OR ends_with({word}, 'n''t')))"


LEXICON_CTES = [
    f"""wd AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '{WORD}{{2,}}')) AS word
  FROM benchmark)""",
    """lx AS (
  SELECT word, (h % 201 - 100) / 100.0::DOUBLE AS polarity, (h % 101) / 100.0::DOUBLE AS
    subjectivity, CASE h % 7 WHEN 0 THEN 1.3 WHEN 1 THEN 0.5 ELSE 1.0 END::DOUBLE AS intensity
  FROM (SELECT word, CAST('0x' || md5(word)[1:15] AS BIGINT) AS h FROM wd))""",
    """tx AS (
  SELECT id, t, unnest(range(1, len(t) + 1)) AS i
  FROM (SELECT id, regexp_extract_all(
    replace(lower(review_text), chr(8217), ''''), '[\\p{L}\\p{N}_'']+') AS t FROM sp))""",
    f"""ht AS (
  SELECT id, cur.polarity, cur.subjectivity, mod.intensity AS by_, cur.intensity AS own,
    nxt.word AS nw, t[i] AS w, {_negation('i > 1', 't[i - 1]')} AS n1,
    {_negation('i > 2', 't[i - 2]')} AS n2
  FROM tx JOIN lx cur ON cur.word = t[i]
  LEFT JOIN lx nxt ON nxt.word = t[i + 1]
  LEFT JOIN lx mod ON mod.intensity <> 1 AND i > 1 AND mod.word = t[i - 1])""",
    """sr AS (
  SELECT id,
    CASE WHEN coalesce(n1, false) OR (by_ IS NOT NULL AND coalesce(n2, false)) THEN -0.5::DOUBLE
      ELSE 1 END * least(greatest(polarity * coalesce(by_, 1), -1), 1) AS p,
    least(greatest(subjectivity * coalesce(by_, 1), 0), 1) AS s
  FROM ht WHERE NOT (own <> 1 AND nw IS NOT NULL))""",
    """lp AS (
  SELECT sp.id || '#0' AS sample_id, split, coalesce(avg(p), 0) AS polarity,
    coalesce(avg(s), 0) AS subjectivity
  FROM sp LEFT JOIN sr USING (id) GROUP BY sp.id, split)""",
]


def off_ties(df):
    """Mean scores can end in a 5 at the seventh decimal, where engines round differently."""
    return df.withColumns({c: F.col(c) + F.lit(1e-9) for c in ("polarity", "subjectivity")})


def polarity(spark, sf):
    return r6(off_ties(T.lexicon_sentiment(splits(spark, sf), lexicon(spark, sf), keep=SPLIT,
                                           negations=NEGATIONS)))


# --- aspects -------------------------------------------------------------------------------

ASPECT_SQL = "SELECT id || '#0' AS sample_id, split, " + ", ".join(
    f"CAST(regexp_matches(lower(review_text), '(^|[^\\p{{L}}\\p{{N}}_])({'|'.join(words)})"
    f"($|[^\\p{{L}}\\p{{N}}_])') AS INTEGER) AS aspect_{name}"
    for name, words in DICTIONARY.items()
) + " FROM sp"


def aspect_flags(spark, sf):
    return T.aspects(splits(spark, sf), DICTIONARY, keep=SPLIT)


# --- whole job -----------------------------------------------------------------------------


def scored_new_text(spark, sf):
    """Conversation turns scored with a model that was fitted on reviews, saved and loaded."""
    train = train_rows(spark, sf)
    path = shared_dir(spark, "model")
    save_model(T.fit_vocab(train, max_features=K), M.fit_scaler(M.metadata(train)), path)
    new = V.chats(spark, sf).select("sample_id", "review_text")
    out = P.apply_model(new, load_model(spark, path))
    sums = out["tfidf"].groupBy("sample_id").agg(
        F.count("*").alias("cells"), F.sum("value").alias("total"),
        F.sum(F.col("value") * F.col("value")).alias("norm"),
    )
    return r6(out["meta"].select("sample_id", "review_length", "avg_word_len", "star_rating")
              .join(sums, "sample_id", "left"))


SCORED_SQL = V.with_reviews(
    """SELECT m.sample_id, round((m.review_length - s1.mean) / s1.scale, 6) + 0.0 AS review_length,
  round((m.avg_word_len - s2.mean) / s2.scale, 6) + 0.0 AS avg_word_len,
  round((0 - s3.mean) / s3.scale, 6) + 0.0 AS star_rating, cells, round(total, 6) AS total,
  round(norm, 6) AS norm
FROM cm m LEFT JOIN cx USING (sample_id)
JOIN sc s1 ON s1.feature = 'review_length' JOIN sc s2 ON s2.feature = 'avg_word_len'
JOIN sc s3 ON s3.feature = 'star_rating'""",
    *split_ctes(), *GRAM_CTES, *META_CTES, V.CHATS_SQL,
    f"""cm AS (
  SELECT sample_id, review_length, coalesce(
    length(regexp_replace(review_text, '{SPACE}+', '', 'g'))::DOUBLE / nullif(word_count, 0), 0)
    AS avg_word_len FROM ch)""",
    f"""ct AS (SELECT sample_id,
    regexp_extract_all({normal_sql('review_text')}, '{WORD}{{2,}}') AS t FROM ch)""",
    """cw AS (
  SELECT sample_id, (1 + ln(tf)) * idf AS w FROM (
    SELECT sample_id, term, count(*) AS tf FROM (
      SELECT sample_id, unnest(list_concat(t,
        list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term FROM ct)
    GROUP BY 1, 2) JOIN vc USING (term))""",
    """cx AS (
  SELECT sample_id, count(*) AS cells, sum(w) / sqrt(sum(w * w)) AS total, 1.0::DOUBLE AS norm
  FROM cw GROUP BY 1)""",
)


def families(spark, sf):
    x, df, _ = cells(spark, sf)
    raw = raw_meta(df)
    return {
        "tfidf": x,
        "meta": M.apply_scaler(raw, M.fit_scaler(raw.filter(F.col("split") == "train"))),
        "lexicon": T.lexicon_sentiment(df, lexicon(spark, sf), keep=SPLIT, negations=NEGATIONS),
        "aspects": T.aspects(df, DICTIONARY, keep=SPLIT),
        "labels": P.labels(df),
    }


def assembled(spark, sf):
    """All families side by side; the arrays are summed up for the check."""
    out = off_ties(P.assemble(families(spark, sf)))
    return r6(out.select(
        "sample_id", "split", "sentiment", "polarity", "aspect_ui", "uppercase_ratio",
        F.size("indices").alias("cells"),
        F.aggregate("values", F.lit(0.0), lambda a, v: a + v).alias("total"),
    ))


ASSEMBLED_SQL = G(
    """SELECT sp.id || '#0' AS sample_id, sp.split, sentiment, round(polarity + 1e-9, 6) + 0.0 AS polarity,
  aspect_ui, round((uppercase_ratio - (SELECT mean FROM sc WHERE feature = 'uppercase_ratio'))
    / (SELECT scale FROM sc WHERE feature = 'uppercase_ratio'), 6) + 0.0 AS uppercase_ratio,
  CAST(coalesce(x.n, 0) AS INTEGER) AS cells, round(coalesce(x.total, 0), 6) AS total
FROM sp JOIN mt ON mt.sample_id = sp.id || '#0' JOIN lp ON lp.sample_id = sp.id || '#0'
JOIN ap ON ap.sample_id = sp.id || '#0'
LEFT JOIN (SELECT sample_id, count(*) AS n, sum(value) AS total FROM xf GROUP BY 1) x
  ON x.sample_id = sp.id || '#0'""",
    *META_CTES, *LEXICON_CTES, f"ap AS ({ASPECT_SQL})",
)


def aligned(spark, sf):
    df = splits(spark, sf)
    return P.alignment({
        "labels": P.labels(df),
        "meta": M.metadata(df, keep=SPLIT),
        "aspects": T.aspects(df, DICTIONARY, keep=SPLIT),
    })


ALIGNED_SQL = " UNION ALL ".join(
    f"SELECT '{f}' AS family, split, count(*) AS n_labels, count(*) AS n_family, "
    "0::BIGINT AS unmatched, 1 AS aligned FROM sp GROUP BY split" for f in ("meta", "aspects")
)


def keys_compared(spark, sf):
    """One family in order, and three with faults: samples without a star are missing, Spanish
    train rows are in another split, TF-IDF has terms of a sample that is not there."""
    df = splits(spark, sf)
    swapped = F.when((F.col("lang") == "es") & (F.col("split") == "train"), "val")
    odd = df.limit(1).select(F.lit("none#0").alias("sample_id"), "split", "review_text")
    texts = df.select("sample_id", "split", "review_text")
    vocab = T.fit_vocab(df.filter(F.col("split") == "train"), max_features=K)
    return P.same_keys({
        "labels": P.labels(df),
        "meta": M.metadata(df, keep=SPLIT),
        "lexicon": df.filter(F.col("star_rating").isNotNull()).select("sample_id", "split"),
        "aspects": df.select("sample_id", F.coalesce(swapped, "split").alias("split")),
        "tfidf": T.tfidf_transform(texts, vocab, keep=SPLIT),
        "extra": texts.select("sample_id", "split").unionAll(odd.select("sample_id", F.lit("test"))),
    })


_BY_SPLIT = """SELECT '{0}' AS family, a.split, a.n AS n_labels, coalesce(b.n, 0) AS n_family,
  CAST({1} AS INTEGER) AS aligned
FROM (SELECT split, count(*) AS n FROM sp GROUP BY split) a
LEFT JOIN (SELECT {2} AS split, count(*) AS n FROM sp {3} GROUP BY 1) b ON a.split = b.split"""
KEYS_SQL = "\nUNION ALL ".join([
    _BY_SPLIT.format("meta", "true", "split", ""),
    _BY_SPLIT.format("lexicon", "a.n = coalesce(b.n, 0)", "split", "WHERE star_rating IS NOT NULL"),
    _BY_SPLIT.format(
        "aspects", "a.n = b.n",
        "CASE WHEN lang = 'es' AND split = 'train' THEN 'val' ELSE split END", ""),
    """SELECT 'tfidf', split, count(DISTINCT sample_id), count(DISTINCT sample_id), 1
FROM xf GROUP BY split""",
    """SELECT 'extra', split, count(*), count(*) + CAST(split = 'test' AS INTEGER),
  CAST(split <> 'test' AS INTEGER) FROM sp GROUP BY split""",
])


def built(spark, sf):
    """The whole job from written splits to written features; returns its report."""
    base = shared_dir(spark, "features")
    write_splits(splits(spark, sf), f"{base}/splits")
    report = P.build_features(
        spark, f"{base}/splits", f"{base}/out", lexicon(spark, sf), DICTIONARY, max_features=K,
        negations=NEGATIONS,
    )
    return r6(report)


REPORT_COLUMNS = ["id", "review_id", "review_date", "review_text", "review_length"]


def report(spark, sf):
    """All parts read one stored table of reviews and one stored vocabulary."""
    df = make_splits(V.stored_reviews(spark, sf, REPORT_COLUMNS), stratified=False)
    vocab = stored(T.fit_vocab(df.filter(F.col("split") == "train"), max_features=K), "vocab")
    return r6(P.feature_report(df, {
        "tfidf": T.tfidf_transform(df, vocab, keep=SPLIT),
        "lexicon": T.lexicon_sentiment(df, lexicon(spark, sf), keep=SPLIT, negations=NEGATIONS),
        "aspects": T.aspects(df, DICTIONARY, keep=SPLIT),
    }, vocab))


REPORT_SQL = G(
    """SELECT 'splits' AS section, split, unnest(['rows', 'mean_review_length']) AS item,
  round(unnest([count(*)::DOUBLE, avg(review_length)]), 6) AS value FROM sp GROUP BY split
UNION ALL SELECT 'tfidf', 'all', 'vocabulary', count(*)::DOUBLE FROM vc
UNION ALL SELECT 'tfidf', split, unnest(['nnz', 'density']), round(unnest([nnz::DOUBLE,
    nnz::DOUBLE / (rows * (SELECT count(*) FROM vc))]), 6)
  FROM (SELECT split, count(*) AS nnz FROM xf GROUP BY 1)
  JOIN (SELECT split, count(*) AS rows FROM sp GROUP BY 1) USING (split)
UNION ALL SELECT 'lexicon', split, unnest(['polarity_mean', 'polarity_std']),
  round(unnest([avg(polarity), stddev_samp(polarity)]), 6) FROM lp GROUP BY split
UNION ALL SELECT 'aspects', split, unnest(["""
    + ", ".join(f"'aspect_{a}_pct'" for a in DICTIONARY) + "]), round(unnest(["
    + ", ".join(f"avg(aspect_{a}) * 100" for a in DICTIONARY)
    + "]), 6) FROM ap WHERE split = 'train' GROUP BY split",
    *META_CTES, *LEXICON_CTES, f"ap AS ({ASPECT_SQL})",
)


def label_rows(spark, sf):
    return P.labels(splits(spark, sf))


QUERIES = {
    "ngrams": (gram_lists, V.with_reviews(TRIGRAM_SQL)),
    "term_counts": (counts, G(
        """SELECT id || '#0' AS sample_id, count(*) AS terms, CAST(sum(tf) AS BIGINT) AS grams,
  max(tf) AS top FROM tc GROUP BY 1""")),
    "doc_freq": (frequencies, G("SELECT term, df, total FROM fq")),
    "prune_terms": (pruned, G("SELECT term, df, total FROM pr")),
    "limit_vocab": (limited, G("SELECT term, df, total FROM kp")),
    "vocabulary": (vocabulary, G(
        "SELECT term, term_idx, df, round(idf, 6) AS idf FROM vc")),
    "tfidf": (transformed, G(
        "SELECT sample_id, split, term_idx, round(value, 6) AS value FROM xf")),
    "matrix_stats": (matrix, G(
        """SELECT (SELECT count(*) FROM sp) AS n_rows, (SELECT count(*) FROM vc) AS n_cols,
  count(*) AS nnz, round(count(*)::DOUBLE / ((SELECT count(*) FROM sp)
    * (SELECT count(*) FROM vc)), 6) AS density FROM xf""")),
    "metadata": (meta, Q("SELECT sample_id, split, " + ", ".join(
        f"round({c}, 6) AS {c}" for c in FEATURES) + " FROM mt")),
    "metadata_computed": (computed_meta, CHAT_META_SQL),
    "fit_scaler": (scaler, Q(
        "SELECT feature, round(mean, 6) AS mean, round(scale, 6) AS scale FROM sc")),
    "apply_scaler": (scaled, Q(f"SELECT sample_id, split, {scaled_sql('mt')} FROM mt")),
    "lexicon_sentiment": (polarity, V.with_reviews(
        "SELECT sample_id, split, round(polarity + 1e-9, 6) + 0.0 AS polarity, "
        "round(subjectivity + 1e-9, 6) AS subjectivity FROM lp", *split_ctes(), *LEXICON_CTES)),
    "aspects": (aspect_flags, V.with_reviews(ASPECT_SQL, *split_ctes())),
    "feature_labels": (label_rows, V.with_reviews(
        "SELECT id || '#0' AS sample_id, review_id, split, sentiment FROM sp", *split_ctes())),
    "apply_model": (scored_new_text, SCORED_SQL),
    "assemble": (assembled, ASSEMBLED_SQL),
    "alignment": (aligned, V.with_reviews(ALIGNED_SQL, *split_ctes())),
    "split_distribution": (lambda s, d: P.split_distribution(splits(s, d)), V.with_reviews(
        """SELECT split, sentiment, count(*) AS n,
  round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY split), 1) AS pct
FROM sp GROUP BY 1, 2""", *split_ctes())),
    "feature_report": (report, REPORT_SQL),
    "build_features": (built, REPORT_SQL),
    "same_keys": (keys_compared, G(KEYS_SQL)),
}
