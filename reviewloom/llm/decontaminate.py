"""Benchmark decontamination by greedy string tiling.

Runs of words that a document shares with a benchmark item are seeds. Where there are any, the
longest matches are marked as tiles, longest first and without overlap, until none of the least
length is left; Karp-Rabin hashes find them. The share of the item's words under tiles is its
coverage. Tiles may lie in any order, so shuffled passages are caught as well.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST = 5  # words of the shortest tile
THRESHOLD = 0.5  # share of an item's words under tiles
BLOCK_BYTES = 8_000_000  # benchmark text that one pass over the documents looks for
BASE = 1_000_003
WORDS = re.compile(r"\w+")
FOUND = ("array<struct<item_id:bigint,n_tiles:int,matched_words:int,item_words:int,"
         "coverage:double>>")


def word_list(text: str) -> list[str]:
    """Runs of letters, digits and underscores in lower case: neither case nor punctuation hides a
    passage."""
    return WORDS.findall(text.lower())


def _window_hashes(tokens: Sequence[int], marked: Sequence[bool], size: int):
    """(start, hash) of every window of ``size`` unmarked tokens; the hash is rolled along."""
    out, top, value, run = [], pow(BASE, size - 1, 1 << 61), 0, 0
    for i, token in enumerate(tokens):
        if marked[i]:
            value = run = 0
            continue
        if run >= size:
            value -= tokens[i - size] * top
        value = (value * BASE + token) % (1 << 61)
        run += 1
        if run >= size:
            out.append((i - size + 1, value))
    return out


def greedy_tiles(doc: Sequence[int], item: Sequence[int], least: int = LEAST,
                 ) -> list[tuple[int, int, int]]:
    """Tiles (start in ``doc``, start in ``item``, length). The search length halves from the
    item's length down to ``least``. At each length the longest matches are marked, in the order of
    their places, and the search is run again until it finds none."""
    tiles, in_doc, in_item = [], [False] * len(doc), [False] * len(item)
    size = max(len(item), least)
    while True:
        while True:
            starts = defaultdict(list)
            for at, value in _window_hashes(item, in_item, size):
                starts[value].append(at)
            matches = []
            for d, value in _window_hashes(doc, in_doc, size) if starts else ():
                for i in starts.get(value, ()):
                    k = 0
                    while (d + k < len(doc) and i + k < len(item) and doc[d + k] == item[i + k]
                           and not in_doc[d + k] and not in_item[i + k]):
                        k += 1
                    if k >= size:
                        matches.append((-k, d, i))
            fresh = False
            longest = min(matches)[0] if matches else 0
            for k, d, i in sorted(m for m in matches if m[0] == longest):
                if not any(in_doc[d:d - k]) and not any(in_item[i:i - k]):
                    in_doc[d:d - k] = in_item[i:i - k] = [True] * -k
                    tiles.append((d, i, -k))
                    fresh = True
            if not fresh:
                break
        if size == least:
            return tiles
        size = max(least, size // 2)


class Seeds:
    """Index of a block of benchmark items by the hashes of their runs of ``least`` words."""

    def __init__(self, items: Sequence[tuple[int | None, str]], least: int = LEAST):
        self.least = least
        self.number = _Numbers()
        self.items = []
        starts = defaultdict(set)
        for item_id, text in items:
            ids = [self.number.setdefault(w, len(self.number)) for w in word_list(text or "")]
            if len(ids) >= least:
                for value in self._hashes(np.array(ids, "int64"), np.arange(len(ids) - least + 1)):
                    starts[int(value)].add(len(self.items))
                self.items.append((item_id, ids))
        self.starts = dict(starts)
        self.sorted = np.array(sorted(self.starts), "uint64")

    def _hashes(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        value = np.zeros(len(at), "uint64")
        for j in range(self.least):
            value = value * np.uint64(BASE) + ids[at + j].astype("uint64")
        return value

    def search(self, texts: Sequence[str | None]) -> list[list[tuple]]:
        """Per text the items that share a seed, each with its tiling: (item_id, n_tiles,
        matched_words, item_words, coverage)."""
        out: list[list[tuple]] = [[] for _ in texts]
        if not len(self.sorted):
            return out
        flat, ends = [], []
        for text in texts:
            flat.extend(map(self.number.__getitem__, word_list(text or "")))
            flat.append(-1)
            ends.append(len(flat))
        ids = np.array(flat, "int64")
        known = ids >= 0
        n = len(ids) - self.least + 1
        if n <= 0:
            return out
        whole = np.ones(n, bool)
        for j in range(self.least):
            whole &= known[j:j + n]
        at = np.flatnonzero(whole)
        values = self._hashes(ids, at)
        near = np.minimum(np.searchsorted(self.sorted, values), len(self.sorted) - 1)
        hit = self.sorted[near] == values
        at, values = at[hit], values[hit]
        places: dict[tuple[int, int], list[int]] = defaultdict(list)
        for a, v, t in zip(at.tolist(), values.tolist(),
                           np.searchsorted(ends, at, "right").tolist(), strict=True):
            for k in self.starts[v]:
                places[t, k].append(a)
        for (t, k), hits in places.items():
            item_id, item = self.items[k]
            tiles = greedy_tiles(self._near(ids, hits), item, self.least)
            matched = sum(length for _, _, length in tiles)
            if matched:
                out[t].append((item_id, len(tiles), matched, len(item), matched / len(item)))
        return out

    def _near(self, ids: np.ndarray, hits: list[int]) -> list[int]:
        """The words under seeds; what lies between is one word that no item has."""
        near, end = [], hits[0]
        for a in hits:
            if a > end:
                near.append(-1)
            near.extend(ids[max(a, end):a + self.least].tolist())
            end = a + self.least
        return near


class _Numbers(dict):
    def __missing__(self, word):
        return -1


def blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """The benchmark in blocks of about ``block_bytes`` of text, chosen by hash; each is small enough
    to be sent to every task."""
    items = benchmark.select("item_id", "text").filter("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(n, 1)))
    for k in range(n):
        yield [(r[0], r[1]) for r in items.filter(part == k).collect()]


def _searcher(sent, least: int):
    names = ("item_id", "n_tiles", "matched_words", "item_words", "coverage")

    @F.pandas_udf(FOUND)
    def search(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        seeds = Seeds(sent.value, least)
        for texts in series:
            yield pd.Series([[dict(zip(names, x, strict=True)) for x in found]
                             for found in seeds.search(texts)])

    return search


def shared_items(
    docs: DataFrame, benchmark: DataFrame, *, least: int = LEAST, block_bytes: int = BLOCK_BYTES,
) -> Column:
    """Column of the benchmark items that ``text`` shares a tile with, one search per block."""
    found = F.array().cast(FOUND)
    for block in blocks(benchmark, block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(block)
        found = F.concat(found, _searcher(sent, least)(F.col("text")))
    return found


def contaminated_pairs(
    docs: DataFrame, benchmark: DataFrame, *, threshold: float = THRESHOLD, least: int = LEAST,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document row and benchmark item whose coverage is ``threshold`` or more:
    ``doc_id``, ``item_id``, ``n_tiles``, ``matched_words``, ``item_words``, ``coverage``,
    ``contaminated`` (true).

    Needs ``doc_id`` and ``text``, and ``item_id`` and ``text`` of the benchmark; other columns are
    not used. Null and empty texts match nothing. Items of fewer than ``least`` words are no
    evidence and are not looked for. Repeated rows give repeated results, a null id stays null.
    Empty tables give no rows.
    """
    items = shared_items(docs, benchmark, least=least, block_bytes=block_bytes)
    return docs.select("doc_id", F.explode(items).alias("_i")).select("doc_id", "_i.*").filter(
        F.col("coverage") >= threshold).withColumn("contaminated", F.lit(True))


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, *, threshold: float = THRESHOLD, least: int = LEAST,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` without the rows that cover an item to ``threshold`` or more; see
    ``contaminated_pairs``. No row moves."""
    items = shared_items(docs, benchmark, least=least, block_bytes=block_bytes)
    return docs.filter(~F.exists(items, lambda i: i["coverage"] >= threshold))
