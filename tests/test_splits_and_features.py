import math
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import rows
from reviewloom.operators import batch_terms
from reviewloom.operators import meta_features as M
from reviewloom.operators import text_features as T
from reviewloom.operators.sampling import expand_copies, oversample, sample_n
from reviewloom.operators.time_split import cutoffs, time_split
from reviewloom.plans import features as P
from reviewloom.plans import splits as S


def dated(spark, n, days=7):
    return spark.range(n).select(
        F.col("id"), F.expr(f"date_add(date'2024-01-01', cast(id * 5 % {days} as int))")
        .alias("review_date"))


def sizes(df):
    return {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}


@pytest.mark.parametrize("block", [3, 1 << 17])
def test_row_boundaries(spark, block):
    got = time_split(dated(spark, 90), block_rows=block)
    assert sizes(got) == {"train": 62, "val": 14, "test": 14}
    order = [r["split"] for r in got.orderBy("review_date", "id").collect()]
    assert order == ["train"] * 62 + ["val"] * 14 + ["test"] * 14


def test_empty_val(spark):
    got = time_split(dated(spark, 10), 0.7, 0.1, 0.2)
    assert sizes(got) == {"train": 7, "test": 3}
    assert cutoffs(got).first()["cutoff_val"] is None


def test_tiny_and_single_day(spark):
    assert sizes(time_split(dated(spark, 1))) == {"test": 1}
    one_day = dated(spark, 20, 1)
    assert sizes(time_split(one_day)) == {"train": 14, "val": 3, "test": 3}
    assert sizes(time_split(one_day, boundary="date")) == {"train": 20}
    with pytest.raises(ValueError):
        time_split(one_day, 0.5, 0.1, 0.1)


def test_date_boundary_keeps_days_together(spark):
    got = time_split(dated(spark, 90), boundary="date")
    assert got.groupBy("review_date").agg(F.countDistinct("split").alias("n")) \
        .filter("n > 1").count() == 0


def classes(spark, *counts):
    data = [(i, c) for i, c in enumerate(x for c, n in zip("abcd", counts) for x in c * n)]
    return spark.createDataFrame(data, "id long, sentiment string")


def test_oversample(spark):
    df = classes(spark, 5, 2, 1)
    got = oversample(df, "sentiment", "id", 42)
    assert rows(got.groupBy("sentiment").count()) == [("a", 5), ("b", 5), ("c", 5)]
    assert rows(got.filter("copy_no = 0").drop("copy_no")) == rows(df)
    assert got.select("id", "copy_no").distinct().count() == 15
    assert rows(got) == rows(oversample(df.repartition(3), "sentiment", "id", 42))
    assert rows(got) != rows(oversample(classes(spark, 40, 9, 9), "sentiment", "id", 7))
    assert rows(oversample(classes(spark, 3), "sentiment", "id").drop("copy_no")) == [
        (0, "a"), (1, "a"), (2, "a")]


def test_many_draws_of_few_rows(spark, monkeypatch):
    from reviewloom.operators import sampling
    monkeypatch.setattr(sampling, "DRAWS_PER_TASK", 16)
    got = oversample(classes(spark, 3000, 1), "sentiment", "id")
    assert rows(got.groupBy("sentiment").count()) == [("a", 3000), ("b", 3000)]


def test_expand_copies_in_pieces(spark):
    df = spark.createDataFrame([(1, 0), (2, 3), (3, 25), (4, 4)], "id long, extra long")
    got = expand_copies(df, "extra", "id", per_task=4)
    for i, extra in ((1, 0), (2, 3), (3, 25), (4, 4)):
        copies = [r["copy_no"] for r in got.filter(F.col("id") == i).collect()]
        assert sorted(copies) == list(range(extra + 1))


def test_sample_n(spark):
    df = spark.range(50)
    assert sample_n(df, 7, 1, "id").count() == 7
    assert rows(sample_n(df, 7, 1, "id")) == rows(sample_n(df.repartition(3), 7, 1, "id"))
    assert sample_n(df, 100, 1, "id").count() == 50


TEXTS = ["good app good", "good app", "bad app today", "good bad day", "app good fun"]


def docs(spark, texts, split="train", start=0):
    return spark.createDataFrame(
        [(f"s{start + i}", t, split) for i, t in enumerate(texts)],
        "sample_id string, review_text string, split string")


def test_tfidf(spark):
    train = docs(spark, TEXTS)
    vocab = T.fit_vocab(train, min_df=2, max_df=0.8)
    terms = {r["term"]: r["df"] for r in vocab.collect()}
    assert terms == {"good": 4, "app": 4, "bad": 2, "good app": 2, "app good": 2}
    x = T.tfidf_transform(train, vocab)
    for r in x.groupBy("sample_id").agg(F.sum(F.col("value") ** 2).alias("s")).collect():
        assert r["s"] == pytest.approx(1.0)
    assert T.tfidf_transform(docs(spark, ["zzz", ""]), vocab).count() == 0
    # what is not in train does not change the fit
    both = train.unionByName(docs(spark, ["bad bad bad", "new words"], "val", 10))
    refit = T.fit_vocab(both.filter("split = 'train'"), min_df=2, max_df=0.8)
    assert rows(refit) == rows(vocab)
    assert rows(T.fit_vocab(train, min_df=2, max_features=1).select("term")) == [("good",)]
    with pytest.raises(ValueError):
        T.check_fit(3)


def test_terms_are_counted_inside_their_row(spark):
    """No table of terms or cells is aggregated, sorted or shuffled per document."""
    train = docs(spark, TEXTS)
    vocab = T.fit_vocab(train, min_df=2, max_df=0.8).localCheckpoint()
    for out in (T.term_counts(train), T.tfidf_transform(train, vocab, keep=["split"])):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        above = plan[:plan.index("Generate")]
        assert "Aggregate" not in above and "Window" not in above
        assert plan.count("Aggregate [sample_id") == 1


def test_texts_of_one_sample_are_one_document(spark):
    df = spark.createDataFrame(
        [("a", "b1 b1 b2"), ("a", "b2 b1"), ("c", None), ("d", "")], "sample_id string, review_text string")
    got = {(r[0], r[1]): r[2] for r in T.term_counts(df).collect()}
    assert got == {("a", "b1"): 3, ("a", "b2"): 2, ("a", "b1 b1"): 1, ("a", "b1 b2"): 1,
                   ("a", "b2 b1"): 1}
    vocab = spark.createDataFrame([("b1", 4, 1, 2.0), ("b2", 9, 1, 1.0)],
                                  "term string, term_idx int, df long, idf double")
    w = [(1 + math.log(3)) * 2.0, 1 + math.log(2)]
    norm = math.sqrt(w[0] ** 2 + w[1] ** 2)
    values = {r[1]: r[2] for r in T.tfidf_transform(df, vocab).collect()}
    assert values == {4: pytest.approx(w[0] / norm), 9: pytest.approx(w[1] / norm)}


def test_scaler(spark):
    meta = M.metadata(docs(spark, ["aa b!", "cc dd...", "E?"]))
    scaled = M.apply_scaler(meta, M.fit_scaler(meta)).toPandas()
    assert scaled["has_title"].tolist() == [0, 0, 0]
    for c in ("review_length", "word_count", "uppercase_ratio"):
        assert scaled[c].mean() == pytest.approx(0) and scaled[c].std(ddof=0) == pytest.approx(1)
    empty = M.metadata(docs(spark, [""])).first()
    assert all(empty[c] == 0 for c in meta.columns if c != "sample_id")


def test_lexicon_rules(spark):
    lexicon = spark.createDataFrame(
        [("good", 0.8, 0.6, 1.0), ("very", 0.2, 0.3, 1.5), ("bad", -0.7, 0.6, 1.0)],
        "word string, polarity double, subjectivity double, intensity double")
    texts = ["Good.", "not good", "very good", "not very good", "nothing here", "", "very",
             "good bad"]
    got = T.lexicon_sentiment(docs(spark, texts), lexicon).orderBy("sample_id").collect()
    assert [round(r["polarity"], 6) for r in got] == [0.8, -0.4, 1.0, -0.5, 0.0, 0.0, 0.2, 0.05]
    assert [round(r["subjectivity"], 6) for r in got] == [0.6, 0.6, 0.9, 0.9, 0.0, 0.0, 0.3, 0.6]


def test_contractions_negate_and_case_is_one_word(spark):
    lexicon = spark.createDataFrame(
        [("like", 0.5, 0.5, 1.0), ("Like", 0.5, 0.5, 1.0), ("good", 0.7, 0.5, 1.0),
         ("very", 0.2, 0.3, 1.5)],
        "word string, polarity double, subjectivity double, intensity double")
    texts = ["i do not like it", "i don't like it", "it isn\u2019t good", "i like it",
             "not so good", "can't very good", "like not"]
    got = T.lexicon_sentiment(docs(spark, texts), lexicon).orderBy("sample_id").collect()
    assert [round(r["polarity"], 6) for r in got] == [-0.25, -0.25, -0.35, 0.5, 0.7, -0.5, 0.5]


def labelled(spark):
    return spark.range(200).select(
        "id", F.concat(F.lit("r"), "id").alias("review_id"), F.lit("App").alias("app_name"),
        F.lit("apple").alias("platform_key"), F.lit(5).alias("star_rating"),
        F.expr("date_add(date'2024-01-01', cast(id % 40 as int))").alias("review_date"),
        F.concat_ws(" ", F.lit("some words w"), F.concat(F.lit("w"), F.col("id") % 5))
        .alias("review_text"),
        F.lit(17).alias("review_length"), F.lit(4).alias("word_count"),
        F.lit(None).cast("string").alias("title"),
        F.when(F.col("id") % 4 == 0, "negative").otherwise("positive").alias("sentiment"),
        F.lit("star_rule").alias("label_method"))


def test_split_and_feature_jobs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "load_labelled", lambda *_: labelled(spark))
    monkeypatch.setattr(S, "read_warehouse", lambda *_: {})
    out, cuts, cut = str(tmp_path / "splits"), [], S.time_split
    monkeypatch.setattr(S, "time_split", lambda *a, **k: cuts.append(1) or cut(*a, **k))
    row = S.split_dataset(spark, str(tmp_path), out).first()
    assert len(cuts) == 1
    assert (row["n_total"], row["id"], row["stratified"]) == (200, 1, 1)
    written = spark.read.parquet(out)
    assert "id" not in written.columns and "label_method" not in written.columns
    for counts in rows(written.groupBy("split", "sentiment").count()):
        assert counts[2] == written.filter(F.col("split") == counts[0]).count() / 2
    second = S.split_dataset(spark, str(tmp_path), str(tmp_path / "again")).first()
    assert second["id"] == 2 and second["train_md5"] == row["train_md5"]
    dry = S.split_dataset(spark, str(tmp_path), str(tmp_path / "no"), dry_run=True)
    assert dry.count() == 3 and not (tmp_path / "no").exists()

    features = str(tmp_path / "features")
    lexicon = spark.createDataFrame([("words", 0.5, 0.5, 1.0)], "word string, polarity double, "
                                    "subjectivity double, intensity double")
    report = P.build_features(spark, out, features, lexicon, {"ui": ["some words"]})
    numbers = {(r["split"], r["item"]): r["value"] for r in report.collect()}
    assert numbers["train", "polarity_mean"] == 0.5
    families = {n: spark.read.parquet(f"{features}/{n}")
                for n in ("labels", "meta", "lexicon", "aspects", "tfidf")}
    assert {r["aligned"] for r in P.alignment(families).collect()} == {1}
    assert P.assemble(families).count() == written.count()
    model = P.load_model(spark, f"{features}/model")
    again = P.apply_model(written, model, keep=["split"])
    key = ["sample_id", "term_idx"]
    assert again["tfidf"].join(families["tfidf"], key, "left_anti").count() == 0
    partial = str(tmp_path / "partial")
    written.filter("split <> 'val'").write.partitionBy("split").parquet(partial)
    with pytest.raises(FileNotFoundError, match="val"):
        P.build_features(spark, partial, features)


def test_a_null_class_is_lifted_as_well(spark):
    df = classes(spark, 6, 2).withColumn(
        "sentiment", F.when(F.col("sentiment") == "a", F.col("sentiment")))
    got = oversample(df, "sentiment", "id")
    assert {r[0]: r[1] for r in got.groupBy("sentiment").count().collect()} == {"a": 6, None: 6}


def test_frequencies_without_moving_texts(spark):
    docs = spark.createDataFrame(
        [("a", "Good app, good APP good"), ("b", "good"), ("c", None), ("d", ""), ("e", "x y zz zz"),
         ("f", "very long " * 20_000)], "sample_id string, review_text string")
    for n in (1, 2, 3):
        one, other = T.corpus_freq(docs, ngram_max=n), T.doc_freq(T.term_counts(docs, ngram_max=n))
        assert rows(one.select("term", "df", "total")) == rows(other.select("term", "df", "total"))
    plan = T.corpus_freq(docs)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.split("\n") if "Exchange" in line]
    assert len(moved) == 1 and "hashpartitioning(term" in moved[0]


def test_terms_are_counted_before_they_leave_the_task(spark):
    """A task gives a term once for all its texts at hand, and holds no table of terms."""
    plan = T.corpus_freq(docs(spark, TEXTS))._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange")
    assert "HashAggregate" in above
    assert "Generate" not in plan and "HashAggregate" not in below
    heavy = docs(spark, ["again and again " * 500] * 40).coalesce(1)
    assert {r[0]: r[1:] for r in T.corpus_freq(heavy).collect()} == {
        "again": (40, 40_000), "again again": (40, 40 * 499), "again and": (40, 20_000),
        "and": (40, 20_000), "and again": (40, 20_000)}


@pytest.mark.parametrize("words, n_rows", [(1 << 22, 1 << 18), (7, 100), (100, 2), (1, 1)])
def test_frequencies_of_parts_of_a_batch(monkeypatch, words, n_rows):
    monkeypatch.setattr(batch_terms, "WORDS", words)
    monkeypatch.setattr(batch_terms, "ROWS", n_rows)
    texts = [["a1", "b1", "a1", "b1"], [], ["b1"], ["a1", "b1"] * 9, ["ß", "a1", "ß"], [], ["a1"]]
    for n in (1, 2, 3, 4):
        df, total = Counter(), Counter()
        for t in texts:
            grams = [" ".join(t[i:i + k]) for k in range(1, n + 1) for i in range(len(t) - k + 1)]
            total.update(grams)
            df.update(set(grams))
        got, seen = Counter(), Counter()
        for batch in batch_terms.term_freq(pa.array([["x1"], *texts]).slice(1), n):
            for term, d, t in zip(*(c.to_pylist() for c in batch.columns)):
                got[term] += d
                seen[term] += t
        assert got == df and seen == total
    assert list(batch_terms.term_freq(pa.array([[], []], pa.list_(pa.string())), 2)) == []
    assert list(batch_terms.term_freq(pa.array([], pa.list_(pa.string())), 2)) == []
