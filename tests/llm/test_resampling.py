"""Importance resampling against a plain computation over whole texts."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from reviewloom.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    found = words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
    return len(words), [zlib.crc32(g.encode()) % 10_000 for g in found]


def expected(docs, target, percent=25, least=20):
    s, t = Counter(), Counter()
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            counts.update(grams(text)[1])
    n_s, n_t = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    out = []
    for doc_id, text in docs:
        n_words, g = grams(text)
        gain = sum(math.floor(1000 * math.log((t[b] + 1) * n_s / ((s[b] + 1) * n_t))) for b in g)
        weight = gain // len(g) if g else 0
        key = f"7:{'' if doc_id is None else doc_id}"
        h = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append([doc_id, len(g), weight, score, None, n_words])
    able = [r for r in out if r[5] >= least]
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in out]


def corpus():
    r = random.Random(5)
    names = [f"w{k}" for k in range(60)] + ["Été", "ß", "x-y", "A1", "日本"]
    shared = [" ".join(r.choices(names, k=9)) for _ in range(12)]
    docs = [(1, None), (2, ""), (3, "\n\n \n"), (4, "one"), (None, "\n".join(shared[:4])),
            (5, "a\n\nb\r\nc\x00d\n"), (6, "big " * 50_000), (7, "same line\n" * 4000)]
    for k in range(8, 220):
        lines = [r.choice(shared) if r.random() < .5 else " ".join(r.choices(names, k=r.randint(0, 14)))
                 for _ in range(r.randint(1, 7))]
        docs.append((k, "\n".join(lines)))
    docs += [docs[20], docs[20], docs[21], (22, docs[30][1])]
    target = [shared[0] + "\n" + shared[1], "W3 w4 w5\nété", None, ""]
    return docs, target


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[3], r[4] or 0, r[1]))


def test_scores_and_ranks(spark):
    docs, target = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr(
        "*", "1 AS rank", "'x' AS line", "2 AS `a.b`").repartition(5)
    aim = spark.createDataFrame([(x, 0) for x in target], "text string, n int")
    out = resampling.importance_scores(df, aim)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {t for _, t in out.dtypes} == {"bigint"}
    got = [tuple(r) for r in out.collect()]
    want = expected(docs, target)
    assert order(got) == order(want)
    drawn = resampling.importance_sample(df, aim).collect()
    assert drawn[0].__fields__[:4] == ["doc_id", "text", "line", "a.b"]
    assert sorted(r["rank"] for r in drawn) == list(range(1, len(drawn) + 1))
    assert {(r.doc_id, r["rank"]) for r in drawn} == {(r[0], r[4]) for r in want if r[4]}


@pytest.mark.parametrize("percent", [0, 100])
def test_all_or_none(spark, percent):
    docs, target = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    aim = spark.createDataFrame([(x,) for x in target], "text string")
    got = [tuple(r) for r in resampling.importance_scores(df, aim, percent=percent).collect()]
    assert order(got) == order(expected(docs, target, percent))


def test_one_id_everywhere(spark, monkeypatch):
    monkeypatch.setattr(resampling, "BLOCK_ROWS", 4)
    text = "a b c d e " * 5
    df = spark.createDataFrame([(3, text)] * 40 + [(None, text)] * 20, "doc_id long, text string")
    aim = spark.createDataFrame([("a b",)], "text string")
    got = resampling.importance_scores(df, aim, percent=80).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 49))
    assert len({r.score for r in got}) == 2


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b " * 20)], "doc_id long, text string")
    assert resampling.importance_scores(none, some).collect() == []
    assert resampling.importance_sample(none, none).collect() == []
    assert resampling.importance_scores(some, none, percent=100).first()["rank"] == 1


def test_a_line_is_counted_once(spark):
    lines = spark.createDataFrame([("a b\nc\na b",), ("a b\n\n",), (None,)], "text string")
    got = {r.line: r.occurrences for r in resampling.distinct_lines(lines).collect()}
    assert got == {"a b": 3, "c": 1}
    counts = {r.bucket: r.n for r in resampling.bucket_counts(lines).collect()}
    want = Counter(b for t in ("a b\nc\na b", "a b\n\n") for b in grams(t)[1])
    assert counts == dict(want)
