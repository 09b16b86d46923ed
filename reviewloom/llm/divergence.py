"""Audit of how the sources of a language diverge, by hash-consed segment trees.

Each language keeps the terms of enough of its documents, and each source of the language is a
tree over the ids of these terms with the source's counts as leaves. Subtrees with equal counts are
one shared node, whichever source and place they come from. Two trees are walked together; within
a walk every pair of nodes is priced once, however often it comes up: rare terms, whose counts are
mostly 0 and 1, share most of their nodes.

A tree's top is Spark's: term ids are a segment and a place in it, segments are subtrees of bounded
width that lie in tasks of their own, and the sum of their prices is an aggregate. Terms of like
total counts share segments. Sources meet in pairs of bounded blocks, so neither many terms nor
many sources make a task grow.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewloom.llm.text import stored

LEAST_DOCS = 30
PRIOR = 5
UNIT = 1_000_000_000
TOP_TERMS = 50
SEGMENT = 2048  # terms of a segment on average
SOURCES = 32  # sources of a block on average
COUNTED = 300_000  # distinct terms of its groups a task counts before it passes them on

# bytes of terms: letters and all of UTF-8 beyond ASCII; A-Z become a-z, others a blank
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))
_COUNTS = "lang string, source string, term string, n long, docs long"


def terms(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` (occurrences) and ``docs`` (rows with the term); every
    group has a row with a null term too. Counted in the tasks before anything is shuffled."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()),
                        ("n", pa.int64()), ("docs", pa.int64())])

    def rows(groups: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in groups.items():
            words = list(n)
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * (len(n) + 1)), pa.array([source] * (len(n) + 1)),
                pa.array([None, *[w.decode() for w in words]], pa.string()),
                pa.array([0, *n.values()], pa.int64()),
                pa.array([0, *[docs[w] for w in words]], pa.int64())], schema=schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, tuple[Counter, Counter]] = {}
        for batch in batches:
            columns = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            for k, (lang, source, text) in enumerate(columns):
                n, docs = groups.setdefault((lang, source), (Counter(), Counter()))
                found = terms(text)
                n.update(found)
                docs.update(set(found))
                if k % 64 == 63 and sum(len(x) for x, _ in groups.values()) > COUNTED:
                    yield from rows(groups)
                    groups = {}
        yield from rows(groups)

    texts = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return texts.mapInArrow(count, _COUNTS).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, least_docs: int, segment: int) -> DataFrame:
    """``lang``, ``term``, ``total`` and where the term lies: ``level`` (binary order of its total)
    and ``part``, one of so many hashed parts of the level that each has about ``segment`` terms."""
    kept = counts.filter("term is not null").groupBy("lang", "term").agg(
        F.sum("n").alias("total"), F.sum("docs").alias("_d")).filter(F.col("_d") >= least_docs)
    kept = kept.drop("_d").withColumn("level", F.floor(F.log2("total")).cast("int"))
    parts = kept.groupBy("lang", "level").agg(F.ceil(F.count("*") / segment).alias("_k"))
    return kept.join(parts, ["lang", "level"]).withColumn(
        "part", F.pmod(F.xxhash64("term"), "_k").cast("int")).drop("_k")


def share(n: str, total: str) -> Column:
    """``1 + floor(UNIT * (n + PRIOR) / total)``, in decimals wide enough to be exact."""
    return F.expr(f"CAST(1 + (({n} + {PRIOR}) * {UNIT}BD) div {total} AS BIGINT)")


class Forest:
    """Segment trees over one row of leaves per source, all trees sharing equal nodes.

    ``nodes[h]`` holds for height ``h`` (1: over two leaves) the left and right children, as node
    numbers one height below; ``roots`` the top node of each source.
    """

    def __init__(self, leaves: np.ndarray):
        self.nodes: list[tuple[np.ndarray, np.ndarray]] = []
        row, self.n_leaves = leaves, int(leaves.max(initial=0)) + 1
        below = self.n_leaves
        while row.shape[1] > 1:
            met, at = np.unique(row[:, ::2] * below + row[:, 1::2], return_inverse=True)
            self.nodes.append((met // below, met % below))
            row, below = at.reshape(row.shape[0], -1), len(met)
        self.roots = row[:, 0]

    def walk(self, a: np.ndarray, b: np.ndarray, price) -> np.ndarray:
        """Sum of ``price(walk, leaf of a, leaf of b)`` over the places of trees ``a[k]`` and
        ``b[k]``, for each walk ``k``. Going down, equal pairs of one walk become one."""
        walk, x, y = np.arange(len(a)), self.roots[a], self.roots[b]
        below = [self.n_leaves, *[len(left) for left, _ in self.nodes]][:len(self.nodes)]
        ways = []
        for (left, right), size in zip(self.nodes[::-1], below[::-1], strict=True):
            both = np.concatenate([(walk * size + left[x]) * size + left[y],
                                   (walk * size + right[x]) * size + right[y]])
            met, at = np.unique(both, return_inverse=True)
            ways.append(at)
            rest, y = np.divmod(met, size)
            walk, x = np.divmod(rest, size)
        value = price(walk, x, y)
        for at in ways[::-1]:
            value = value[at[:len(at) // 2]] + value[at[len(at) // 2:]]
        return value


def tree_prices(
    names: list[str], totals: list[int], places: np.ndarray, owners: np.ndarray,
    counts: np.ndarray, width: int, pairs: tuple[np.ndarray, np.ndarray],
) -> np.ndarray:
    """Summed differences of shares over ``width`` terms, for each pair of sources. ``places``,
    ``owners`` and ``counts`` are the cells that are not 0: term, source and count."""
    known = np.unique(np.append(counts, 0))
    padded = 1 << max(width - 1, 0).bit_length()
    # leaf 0 is the padding, leaf 1 + k the k-th distinct count
    leaves = np.zeros((len(names), padded), "int64")
    leaves[:, :width] = 1
    leaves[owners, places] = 1 + np.searchsorted(known, counts)
    shares = np.array([[1 + UNIT * (c + PRIOR) // total for c in known.tolist()]
                       for total in totals], "int64")
    a, b = pairs

    def price(walk: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        gap = np.abs(shares[a[walk], x - 1] - shares[b[walk], y - 1])
        return np.where(x == 0, 0, gap)  # both trees are padded in the same places

    return Forest(leaves).walk(a, b, price)


def _segment_pairs(key: tuple, rows: pa.Table) -> pa.Table:
    """``lang``, ``a``, ``b``, ``value`` over one segment for the sources of two blocks."""
    lo, hi = key[3].as_py(), key[4].as_py()
    listed = rows.filter(pc.is_null(rows["term"]))
    names, totals, block = (listed[c].to_pylist() for c in ("source", "d", "_b"))
    one = np.flatnonzero(np.array(block) == lo)
    other = np.flatnonzero(np.array(block) == hi)
    if lo == hi:
        a, b = (one[k] for k in np.triu_indices(len(one), 1))
    else:
        a, b = np.repeat(one, len(other)), np.tile(other, len(one))
    cells = rows.filter(pc.is_valid(rows["term"]))
    term, total = (cells[c].to_numpy(zero_copy_only=False) for c in ("term", "total"))
    # ids of the segment's terms: by falling total, then by name; equal counts come to lie together
    order = np.lexsort((term, -total)) if len(term) else np.zeros(0, "int64")
    first = np.r_[True, term[order][1:] != term[order][:-1]][:len(term)]
    place = np.empty(len(term), "int64")
    place[order] = np.cumsum(first) - 1
    number = {s: i for i, s in enumerate(names)}
    owner = np.array([number[s] for s in cells["source"].to_pylist()], "int64")
    value = tree_prices(names, totals, place, owner, cells["n"].to_numpy(),
                        listed["width"][0].as_py(), (a, b)) if len(a) else a
    who = np.array(names, object)
    return pa.table({
        "lang": pa.array([key[0].as_py()] * len(a), pa.string()),
        "a": pa.array(who[a], pa.string()), "b": pa.array(who[b], pa.string()),
        "value": pa.array(value, pa.int64())})


def pair_prices(
    cells: DataFrame, groups: DataFrame, kept: DataFrame, sources: int,
) -> DataFrame:
    """``lang``, ``a``, ``b``, ``value`` for every two sources of a language with kept terms.

    ``cells``: a source's count of a kept term, with the term's place. ``groups``: ``d``, the
    denominator of a source's shares.
    """
    at = ["lang", "level", "part"]
    n_sources = groups.groupBy("lang").agg(F.ceil(F.count("*") / sources).cast("int").alias("_k"))
    dealt = groups.join(n_sources, "lang").withColumn(
        "_b", F.pmod(F.xxhash64("source"), "_k").cast("int")).select(
        "lang", "source", "d", "_k", "_b")
    widths = kept.groupBy(*at).agg(F.count("*").cast("int").alias("width"))
    nothing = F.lit(None)
    listed = widths.join(dealt, "lang").select(
        *at, "source", nothing.cast("string").alias("term"), nothing.cast("long").alias("total"),
        nothing.cast("long").alias("n"), "d", "width", "_k", "_b")
    counted = cells.join(dealt.drop("d"), ["lang", "source"]).select(
        *at, "source", "term", "total", "n", nothing.cast("long").alias("d"),
        nothing.cast("int").alias("width"), "_k", "_b")
    met = listed.unionByName(counted).withColumn(
        "_j", F.explode(F.sequence(F.lit(0), F.col("_k") - 1))).select(
        *at, F.least("_b", "_j").alias("_lo"), F.greatest("_b", "_j").alias("_hi"),
        "source", "term", "total", "n", "d", "width", "_b")
    parts = met.groupBy(*at, "_lo", "_hi").applyInArrow(
        _segment_pairs, "lang string, a string, b string, value long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def source_divergence(
    docs: DataFrame, *, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS,
    segment: int = SEGMENT, sources: int = SOURCES,
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``. Part ``pair``: how far the
    source's term shares are from those of each other source of the language, all of them. Part
    ``term``: the terms the source uses more than its language does, ``top_terms`` of them.

    Needs ``text``, ``lang`` and ``source``; other columns are not used. Nulls in them count as
    empty text; a row's text may be of any length. Repeated rows count as often as they come. A
    language's only source has no pair; a language without kept terms has pairs of value 0 and no
    terms. Ties rank by item in UTF-8 order. No rows in, no rows out.
    """
    counts = stored(term_counts(docs), "term-counts")
    kept = stored(kept_terms(counts, least_docs, segment), "terms")
    cells = stored(counts.filter("term is not null").select("lang", "source", "term", "n").join(
        kept, ["lang", "term"]), "cells")
    per_lang = kept.groupBy("lang").agg(F.count("*").alias("_v"), F.sum("total").alias("_n"))
    per_lang = per_lang.select("lang", "_v", (F.col("_n") + PRIOR * F.col("_v")).alias("lang_d"))
    per_source = cells.groupBy("lang", "source").agg(F.sum("n").alias("_n"))
    # one row per language and source
    groups = stored(
        counts.select("lang", "source").distinct().join(per_lang, "lang", "left")
        .join(per_source, ["lang", "source"], "left").select(
            "lang", "source", "lang_d",
            (F.coalesce("_n", F.lit(0)) + PRIOR * F.col("_v")).alias("d")), "groups")

    priced = stored(pair_prices(
        cells, groups.filter("d is not null"), kept, sources), "pairs")
    bare = groups.filter("d is null").select("lang", "source")
    without = bare.join(bare.withColumnRenamed("source", "item"), "lang").filter("source <> item")
    pairs = priced.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value"
                          ).unionAll(priced.select("lang", "b", "a", "value")).unionAll(
        without.select("lang", "source", "item", F.lit(0).cast("long")))
    own = cells.select("lang", "source", "term", "n", "total").join(groups, ["lang", "source"])
    over = own.select(
        "lang", "source", F.col("term").alias("item"),
        (share("n", "d") - share("total", "lang_d")).alias("value")).filter("value > 0")

    place = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value",
                           place.cast("int").alias("rank"))

    return ranked(pairs, "pair").unionAll(ranked(over, "term").filter(F.col("rank") <= top_terms))
