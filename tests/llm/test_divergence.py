"""Source divergence against a plain computation, and the trees by themselves."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from reviewloom.llm import divergence as dv

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def found(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(low)


def expected(docs, least=30, top=50):
    counts, seen = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        counts[lang or "", source or ""].update(found(text))
        seen[lang or ""].update(set(found(text)))
    out = []
    for lang, source in counts:
        kept = [t for t, n in seen[lang].items() if n >= least]
        own = {s: c for (x, s), c in counts.items() if x == lang}
        whole = Counter()
        for c in own.values():
            whole.update(c)

        def share(c):
            total = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 5) // total for t in kept}

        p, q = share(own[source]), share(whole)
        pairs = [(-sum(abs(p[t] - x) for t, x in share(c).items()), s.encode())
                 for s, c in own.items() if s != source]
        over = [(q[t] - p[t], t.encode()) for t in kept if own[source][t] and p[t] > q[t]]
        for part, items in (("pair", sorted(pairs)), ("term", sorted(over)[:top])):
            out += [(lang, source, part, i.decode(), -v, k + 1) for k, (v, i) in enumerate(items)]
    return sorted(out)


def corpus():
    r = random.Random(3)
    names = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(90)]
    names += ["été", "ß", "日本", "WaA"]
    docs = []
    for k in range(400):
        weights = [1 / (1 + (j * (1 + k % 5)) % 93) for j in range(len(names))]
        text = "".join(w + r.choice([" ", "\n", "1", "-", "\x00", "_"])
                       for w in r.choices(names, weights, k=r.randint(0, 60)))
        docs.append((text, ["en", "de", None, ""][k % 4], [f"s{k % 7}", None, "ü", "sz"][k % 3]))
    docs += [(None, "fr", "a"), ("rare words", "fr", "b"), ("", "fr", None), ("x", "only", "one")]
    docs += [("waa " * 30_000, "en", "s1")] + [docs[0]] * 3 + [("", "en", "silent")]
    return docs


@pytest.mark.parametrize(("segment", "sources"), [(2048, 32), (8, 3)])
def test_equals_plain_computation(spark, segment, sources):
    docs = corpus()
    df = spark.createDataFrame(docs, "text string, lang string, source string").selectExpr(
        "*", "1 AS n", "2 AS term", "'x' AS `part`", "3 AS `a.b`", "4 AS doc_id").repartition(5)
    out = dv.source_divergence(df, segment=segment, sources=sources)
    assert out.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"),
                          ("item", "string"), ("value", "bigint"), ("rank", "int")]
    got = sorted(tuple(r) for r in out.collect())
    assert got == expected(docs)
    assert any(r[:3] == ("fr", "a", "pair") and r[4] == 0 for r in got)
    assert not any(r[0] == "only" for r in got)


def test_few_terms_are_listed(spark):
    df = spark.createDataFrame(corpus(), "text string, lang string, source string")
    got = sorted(tuple(r) for r in dv.source_divergence(df, least_docs=2, top_terms=3).collect())
    assert got == expected(corpus(), 2, 3)


def test_empty_table(spark):
    none = spark.createDataFrame([], "text string, lang string, source string")
    assert dv.source_divergence(none).collect() == []


def test_equal_subtrees_are_one_node():
    leaves = np.array([[1, 2, 1, 2, 0, 0, 0, 0], [0, 0, 0, 0, 1, 2, 1, 2]])
    forest = dv.Forest(leaves)
    # over two leaves: (1 2) and (0 0); over four: twice the one, twice the other
    assert [len(left) for left, _ in forest.nodes] == [2, 2, 2]


def test_equal_pairs_are_priced_once():
    r = np.random.default_rng(1)
    leaves = r.integers(1, 4, (5, 256))
    leaves[:, 100:] = 1  # most of it alike
    asked = []

    def price(walk, x, y):
        asked.append(len(walk))
        return (walk + 1) * np.abs(x - y)

    a, b = np.triu_indices(5, 1)
    value = dv.Forest(leaves).walk(a, b, price)
    want = [(k + 1) * np.abs(leaves[i] - leaves[j]).sum()
            for k, (i, j) in enumerate(zip(a, b, strict=True))]
    assert value.tolist() == want
    assert asked[0] <= 9 * len(a)  # three leaf values: nine pairs a walk at most


def test_shares_beyond_64_bits(spark):
    df = spark.createDataFrame(
        [(1, 10), (8_999_999_999_999, 9_000_000_000_000), (123_456_789, 9_876_543_210)],
        "n long, d long")
    got = [r[0] for r in df.select(dv.share("n", "d")).collect()]
    assert got == [1 + 10**9 * (n + 5) // d for n, d in df.collect()]
