import math

import pytest
from pyspark.sql import functions as F

from reviewloom.functions import columns as C
from reviewloom.functions.language import SAMPLES, detect_language, fit
from reviewloom.functions.tails import correlation_p, incomplete_beta, log_gamma
from reviewloom.operators.cleaning import keep_language


def one(spark, value, make, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(make(F.col("v")).alias("o")).first()["o"]


@pytest.mark.parametrize("text, number", [
    ("5", 5.0), (" 4.7 ", 4.7), ("1e2", 100.0), ("x", None), ("", None), ("nan", None),
    ("5d", None), ("0x1p3", None), (None, None), ("-.5", -0.5), ("inf", math.inf),
])
def test_to_number(spark, text, number):
    assert one(spark, text, C.to_number) == number


@pytest.mark.parametrize("text, day", [
    ("2024-01-05", "2024-01-05"), ("2024-13-40", None), ("03/04/2024", None),
    ("2024-01-05 10:00:00", None), ("", None),
])
def test_to_review_date(spark, text, day):
    got = one(spark, text, C.to_review_date)
    assert (str(got) if got else None) == day


@pytest.mark.parametrize("value, whole", [
    (4.7, 4), (0.5, 0), (-0.5, 0), (math.inf, None), (None, None),
])
def test_to_int_trunc(spark, value, whole):
    assert one(spark, value, C.to_int_trunc, "double") == whole


@pytest.mark.parametrize("star, label", [
    (5.0, "positive"), (4.0, "positive"), (3.0, "neutral"), (2.0, "negative"), (1.0, "negative"),
    (3.5, "neutral"), (None, "unrated"),
])
def test_star_sentiment(spark, star, label):
    assert one(spark, star, C.star_sentiment, "double") == label


def test_trim_and_lengths(spark):
    assert one(spark, "   a b\t\n", C.trim_space) == "a b"
    assert one(spark, "　", C.is_blank) is True
    assert one(spark, "👍👍👍", C.review_length) == 3
    assert one(spark, " a b  c ", C.word_count) == 3
    assert one(spark, "", C.word_count) == 0


def test_cut_is_right_closed_and_open_at_the_top(spark):
    df = spark.createDataFrame([(v,) for v in (0, 1, 4, 5, 19, 20, 10**6)], "v int")
    got = [r[0] for r in df.select(C.cut("v", [0, 4, 9, 19, None], list("abcd"))).collect()]
    assert got == [None, "a", "a", "b", "c", "d", "d"]
    closed = [r[0] for r in df.select(C.cut("v", [0, 4, 19], list("ab"))).collect()]
    assert closed == [None, "a", "a", "b", "b", None, None]


def test_text_functions(spark):
    text = "Why??? the app is slow... see http://x.io/a"
    assert one(spark, text, C.normalise_text) == "why??? the app is slow... see"
    assert one(spark, text, lambda c: C.literal_count(c, "?")) == 3
    assert one(spark, "......", lambda c: C.literal_count(c, "...")) == 2
    assert one(spark, "ABc é", C.uppercase_ratio) == pytest.approx(2 / 5)
    assert one(spark, "", C.uppercase_ratio) == 0
    assert one(spark, "", C.mean_word_length) == 0
    assert one(spark, "ab cdef", C.mean_word_length) == 3
    assert one(spark, "a été x_1 b", C.word_tokens) == ["été", "x_1"]


def test_ngrams(spark):
    grams = lambda n: lambda c: C.ngrams(F.split(c, " "), n)
    assert one(spark, "a b c", grams(1)) == ["a", "b", "c"]
    assert one(spark, "a b c", grams(3)) == ["a", "b", "c", "a b", "b c", "a b c"]
    assert one(spark, "a", grams(3)) == ["a"]


@pytest.mark.parametrize("text, keywords, hit", [
    ("fluid", ["ui"], 0), ("my UI!", ["ui"], 1), ("in Dark mode", ["dark mode"], 1),
    ("two-factor", ["two-factor"], 1), ("a.b", ["a.b"], 1), ("axb", ["a.b"], 0), (None, ["a"], 0),
])
def test_mentions(spark, text, keywords, hit):
    assert one(spark, text, lambda c: C.mentions(c, keywords)) == hit


def test_platforms(spark):
    assert one(spark, "apple", C.platform_name) == "Apple App Store"
    with pytest.raises(ValueError):
        C.check_platform("amazon")
    with pytest.raises(Exception, match="unknown platform"):
        one(spark, "amazon", C.platform_name)


@pytest.mark.parametrize("text, lang", [
    ("the end of it", "en"), ("le chat est dans la maison", "fr"), ("👍👍👍", "und"), ("", "und"),
    ("der Hund und die Katze", "de"), ("el perro y los gatos", "es"),
    ("यह ऐप बहुत अच्छा है", "other"), ("очень хорошее приложение", "other"), ("很好用的软件", "other"),
    ("questo gioco è molto bello", "it"), ("não gosto, é muito lento", "pt"),
    ("het werkt niet meer", "nl"), ("bu uygulama çok iyi", "tr"), ("12 % 5/5", "und"),
    ("Ottima app", "it"), ("Geweldige app", "nl"), ("harika", "tr"), ("Sehr gut", "de"),
    ("Tres bien", "fr"), ("Appen är jättebra", "sv"), ("app rất tốt", "vi"),
    ("Dit is de app van het jaar", "nl"), (None, "und"), ("word " * 50_000, "en"),
])
def test_language(spark, text, lang):
    assert one(spark, text, detect_language) == lang


@pytest.mark.parametrize("text, kept", [
    ("Ottima app", False), ("Geweldige app", False), ("harika", False), ("Sehr gut", False),
    ("Tres bien", False), ("Appen är jättebra", False), ("app rất tốt", False),
    ("Dit is de app van het jaar", False), ("Gute App", False), ("очень хорошо", False),
    ("Great app", True), ("5/5 👍", True), ("ok", True), ("", True), ("kool", True),
    ("Good service", True), ("super", True), ("no sound", True), ("cant open it", True),
])
def test_keep_language(spark, text, kept):
    rows = spark.createDataFrame([(text,)], "review string")
    assert keep_language(rows, "en").count() == kept


def test_language_of_own_samples(spark):
    samples = {"aa": "bla blu bli", "bb": "cra cru cri bla"}
    for text, lang in (("blu", "aa"), ("CRI", "bb"), ("xyz", "und"), ("bli cri cru", "bb")):
        assert one(spark, text, lambda c: detect_language(c, samples)) == lang
    # no score can run into its neighbour's bits, however long the text
    assert max(map(sum, zip(*fit(SAMPLES).values()))) < 2**15


def test_tails(spark):
    def value(make, **args):
        row = spark.range(1).select(*[F.lit(v).cast("double").alias(k) for k, v in args.items()])
        return row.select(make(*[F.col(k) for k in args]).alias("p")).first()["p"]

    for z in (0.5, 1, 1.5, 7, 123.25, 1e6):
        assert value(log_gamma, z=z) == pytest.approx(math.lgamma(z), rel=1e-12, abs=1e-12)
    assert value(incomplete_beta, a=2, b=3, x=0.4) == pytest.approx(0.5248, abs=1e-12)
    assert value(incomplete_beta, a=2, b=3, x=0) == 0 and value(incomplete_beta, a=2, b=3, x=1) == 1
    # published critical values of r: p = 0.05 at n = 10 and n = 32
    assert value(correlation_p, r=0.6319, n=10) == pytest.approx(0.05, abs=1e-4)
    assert value(correlation_p, r=-0.3494, n=32) == pytest.approx(0.05, abs=1e-4)
    assert value(correlation_p, r=0.5, n=10) == pytest.approx(0.1411, abs=1e-4)
    assert value(correlation_p, r=1.0, n=5) == 0 and value(correlation_p, r=None, n=5) is None
    assert value(correlation_p, r=0.3, n=2) is None and value(correlation_p, r=0.0, n=9) == 1
    assert value(correlation_p, r=0.01, n=1_000_000) == pytest.approx(1.52e-23, rel=0.01)
