"""Near-duplicate embeddings against all pairs."""

import math

import numpy as np
import pytest

from reviewloom.llm import embedding_dedup as ed


def expected(rows, threshold=0.95):
    good = [k for k, (_, e) in enumerate(rows) if e and None not in e
            and all(map(math.isfinite, e)) and any(e)]
    links = {k: set() for k in range(len(rows))}
    x = {k: np.array(rows[k][1], float) for k in good}
    x = {k: v / np.abs(v).max() if not 1e-100 < np.abs(v).max() < 1e100 else v for k, v in x.items()}
    for i in good:
        for j in good:
            if i < j and len(x[i]) == len(x[j]) and ed.exact_cosine(x[i], x[j]) >= threshold:
                links[i].add(j)
                links[j].add(i)
    out = []
    for k, (vec_id, _) in enumerate(rows):
        reach, todo = {k}, [k]
        while todo:
            new = links[todo.pop()] - reach
            reach |= new
            todo += new
        ids = [rows[j][0] for j in reach if rows[j][0] is not None]
        low = min(ids) if ids else None
        out.append((vec_id, len(links[k]), low, vec_id == low))
    return out


def near(r, base, cosine):
    """A vector at this cosine to the base."""
    base = base / np.linalg.norm(base)
    side = r.standard_normal(len(base))
    side -= side @ base * base
    return cosine * base + math.sqrt(1 - cosine**2) * side / np.linalg.norm(side)


def vectors():
    r = np.random.default_rng(11)
    rows = [(k, r.standard_normal(16).tolist()) for k in range(400, 520)]
    for size, low, high in ((60, 0.98, 0.999), (25, 0.9, 0.97), (8, 0.951, 0.953)):
        base = r.standard_normal(16)
        rows += [(600 + len(rows), (near(r, base, r.uniform(low, high)) * r.uniform(.1, 9)).tolist())
                 for _ in range(size)]
    chain = r.standard_normal(16)
    for k in range(12):  # each near the next one only
        rows.append((1000 + k, chain.tolist()))
        chain = near(r, chain, 0.96)
    rows += [(5, rows[0][1])] * 3 + [(None, rows[1][1]), (None, rows[130][1])]
    rows += [(20, None), (21, []), (22, [0.0] * 16), (23, [math.nan] * 16), (24, [None, *[1.0] * 15]),
             (25, [math.inf, *[1.0] * 15]), (26, [1.0, 2.0]), (27, [2.0, 4.0]), (28, [1e300, 2e300]),
             (29, [1e-320, 2e-320]), (30, [-1.0, -2.0])]
    # a cosine of exactly 19/20, and one just below it
    rows += [(40, [3.0, 0.0, 0.0, 0.0, 0.0]), (41, [19.0, 6.0, 1.0, 1.0, 1.0]),
             (42, [19.0, 6.001, 1.0, 1.0, 1.0])]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr(
        "*", "1 AS n", "'x' AS comp", "2 AS kept", "3 AS `a.b`")


def key(row):
    return (row[0] is None, row[0] or 0, row[1], str(row[2]))


@pytest.mark.parametrize("block", [1024, 8])
def test_equals_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(ed, "BLOCK", block)
    rows = vectors()
    out = ed.near_vectors(frame(spark, rows))
    assert out.dtypes == [("vec_id", "bigint"), ("n_links", "bigint"), ("component_id", "bigint"),
                          ("kept", "boolean")]
    got = sorted((tuple(r) for r in out.collect()), key=key)
    want = sorted(expected(rows), key=key)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    by_id = {r[0]: r for r in got}
    assert by_id[40][1] == by_id[41][1] - 1 == 1  # 41 and 42 are near each other
    assert all(r[3] == (r[0] == r[2]) for r in got)


def test_empty_and_single(spark):
    assert ed.near_vectors(frame(spark, [])).collect() == []
    assert [tuple(r) for r in ed.near_vectors(frame(spark, [(3, [1.0])])).collect()] == [
        (3, 0, 3, True)]


def test_other_threshold_and_number_type(spark):
    rows = [(1, [1, 0]), (2, [1, 1]), (3, [0, 5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<int>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in
           ed.near_vectors(df, threshold=0.7).collect()}
    assert got == {1: (1, 1), 2: (2, 1), 3: (1, 1)}


def test_collision_probability():
    r = np.random.default_rng(2)
    for cosine in (0.95, 0.5, 0.0):
        a = np.array([1.0, 0, 0])
        b = near(r, a, cosine)
        lines, shift = r.standard_normal((3, 40_000)), r.uniform(0, ed.WIDTH, 40_000)
        same = (np.floor((a @ lines + shift) / ed.WIDTH)
                == np.floor((b @ lines + shift) / ed.WIDTH)).mean()
        assert same == pytest.approx(ed.agreement(math.sqrt(2 - 2 * cosine)), abs=0.01)
    values, tables = ed.plan_tables(10**6, 0.95, 1e-4)
    hit = ed.agreement(math.sqrt(0.1)) ** values
    assert (1 - hit) ** tables <= 1e-4 < (1 - hit) ** (tables - 1)
    assert ed.plan_tables(0, 1.0, 1e-4)[1] == 1
