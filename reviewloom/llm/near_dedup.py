"""MinHash near-dedup with sequential Bayesian verification.

Texts with one shingle set are one node. Signatures are cut into bands; nodes that agree in a band
share a bucket. Each bucket's best connected node is compared with the others first, which links
most of a group; only buckets that still hold several components are then compared in full, in
blocks. Candidates are compared signature batch by batch and dropped as soon as the posterior
probability of the wanted similarity is below the chosen miss probability; what survives is
confirmed on the full shingle sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.graph import stars
from reviewloom.llm.text import shelve, stored

BANDS = 40
ROWS = 5  # a pair of similarity 0.8 shares no bucket with probability 1e-7
BATCH = 20  # hash values compared before the posterior is looked at again
MISS = 1e-6
BLOCK = 1024  # members of a bucket that a task compares with as many others
MOST_WORDS = 200_000  # words whose hashes a worker remembers
SIGNED = "doc_id long, _t long, node binary, n_shingles long, sig binary"


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MOST_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingles(text: str | None, size: int) -> set[tuple[bytes, ...]]:
    """Distinct runs of ``size`` words, A-Z in lower case; the whole of a shorter text is one."""
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(size)), strict=False))


def shingle_hashes(text: str | None, size: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the same."""
    words = (text or "").encode().lower().split()
    ids = np.fromiter(map(known.__getitem__, words), "uint64", len(words))
    n = max(min(len(ids), 1), len(ids) - size + 1)
    value = np.full(n, min(len(ids), size), "uint64")
    for k in range(min(size, len(ids))):
        value = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + ids[k:k + n]
    value = (value ^ (value >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return np.unique(value ^ (value >> np.uint64(30)))


def signature(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """16 bits of the least value of each hash function over the set."""
    low = np.full(len(a), np.iinfo("uint64").max, "uint64")
    for at in range(0, len(hashes), 1024):
        part = hashes[at:at + 1024]
        np.minimum(low, (a[:, None] * part + b[:, None]).min(axis=1), out=low)
    return ((low * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype("<u2")


def signed(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """``doc_id``, text hash, node (digest of the shingle set), set size and signature per row."""
    random = np.random.default_rng(20_240_229)
    a = random.integers(0, 1 << 63, bands * rows, "uint64") * np.uint64(2) + np.uint64(1)
    b = random.integers(0, 1 << 63, bands * rows, "uint64")
    schema = pa.schema([("doc_id", pa.int64()), ("_t", pa.int64()), ("node", pa.binary()),
                        ("n_shingles", pa.int64()), ("sig", pa.binary())])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            nodes, sizes, sigs = [], [], []
            for text in batch.column(2).to_pylist():
                hashes = shingle_hashes(text, size, known)
                some = len(hashes) > 0
                nodes.append(xxhash.xxh3_128_digest(hashes.tobytes()) if some else None)
                sizes.append(len(hashes))
                sigs.append(signature(hashes, a, b).tobytes() if some else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(nodes, pa.binary()),
                 pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary())], schema=schema)

    rows_in = docs.select("doc_id", F.xxhash64("text").alias("_t"), "text")
    return rows_in.mapInArrow(sign, SIGNED)


def least_matches(threshold: float, miss: float, n: int) -> int:
    """Fewest agreements of ``n`` hash values with which the similarity is ``threshold`` or more
    with a posterior probability of ``miss`` or more, from a uniform prior."""
    total = 0.0
    for m in range(n + 1):
        total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if total >= miss:
            return m
    return n


def checkpoints(width: int, threshold: float, miss: float) -> list[tuple[int, int]]:
    ends = [*range(BATCH, width, BATCH), width]
    return [(n, least_matches(threshold, miss, n)) for n in ends]


def surviving(x: np.ndarray, y: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """Rows of two signature tables that no batch of hash values rules out; agreements or -1."""
    alive, found, start = np.arange(len(x)), np.zeros(len(x), "int64"), 0
    for end, least in steps:
        found[alive] += (x[alive, start:end] == y[alive, start:end]).sum(axis=1)
        found[alive[found[alive] < least]] = -1
        alive, start = alive[found[alive] >= 0], end
    return found


def _table(sigs, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(sigs), "<u2").reshape(-1, width)


def agreements(width: int, threshold: float, miss: float):
    steps = checkpoints(width, threshold, miss)

    @F.pandas_udf("int")
    def compare(series: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for x, y in series:
            yield pd.Series(surviving(_table(x, width), _table(y, width), steps), dtype="int32")

    return compare


def exact_links(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose full shingle sets have the wanted similarity."""

    @F.pandas_udf("boolean")
    def alike(series: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for x, y in series:
            out = []
            for one, other in zip(x, y, strict=True):
                s, t = shingles(one, size), shingles(other, size)
                both = len(s & t)
                out.append(100 * both >= percent * (len(s) + len(t) - both))
            yield pd.Series(out, dtype=bool)

    x = texts.select(F.col("n").alias("a"), F.col("text").alias("_x"))
    y = texts.select(F.col("n").alias("b"), F.col("text").alias("_y"))
    return pairs.join(x, "a").join(y, "b").filter(alike("_x", "_y")).select("a", "b")


def _labelled(members: DataFrame, comps: DataFrame) -> DataFrame:
    """``members`` with ``comp``, the smallest node number of their component."""
    return members.join(comps.select(F.col("b").alias("n"), F.col("a").alias("_c")), "n", "left"
                        ).withColumn("comp", F.coalesce("_c", "n")).drop("_c")


def _block_links(
    members: DataFrame, width: int, size: int, percent: int, miss: float,
) -> DataFrame:
    """Links between different components inside each group, as many as connect what is connected.

    A group is dealt to blocks, and every two blocks meet in a task of their own, so its size
    doesn't matter. There candidates are pruned by their signatures and confirmed on their shingle
    sets; pairs that a link has already joined are passed over, so no task gives more links than it
    has members.
    """
    steps = checkpoints(width, percent / 100, miss)
    sizes = members.groupBy("centre").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_k"))
    dealt = members.join(sizes, "centre").withColumn(
        "_i", F.pmod(F.xxhash64("n"), F.col("_k")).cast("int"))
    met = dealt.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_k") - 1))).select(
        "centre", F.least("_i", "_j").alias("_lo"), F.greatest("_i", "_j").alias("_hi"),
        "_i", "n", "comp", "sig", "text")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(table: pa.Table) -> pa.Table:
        n, comp, block = (table.column(c).to_numpy() for c in ("n", "comp", "_i"))
        sigs = _table(table.column("sig").to_pylist(), width)
        known = WordHashes()
        sets = [set(shingle_hashes(t, size, known).tolist())
                for t in table.column("text").to_pylist()]
        lo, hi = table.column("_lo")[0].as_py(), table.column("_hi")[0].as_py()
        comp, mine, links = comp.copy(), np.flatnonzero(block == hi), []
        for i in np.flatnonzero(block == lo).tolist():
            others = mine[comp[mine] != comp[i]]
            if lo == hi:
                others = others[others > i]
            found = surviving(np.broadcast_to(sigs[i], (len(others), width)), sigs[others], steps)
            for k in np.argsort(-found, kind="stable").tolist():
                j = int(others[k])
                if found[k] < 0:
                    break
                if comp[i] != comp[j]:
                    both = len(sets[i] & sets[j])
                    if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                        links.append((min(n[i], n[j]), max(n[i], n[j])))
                        comp[comp == comp[j]] = comp[i]
        a, b = zip(*links, strict=True) if links else ([], [])
        return pa.Table.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                    schema=schema)

    return met.groupBy("centre", "_lo", "_hi").applyInArrow(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame, *, size: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS,
    miss: float = MISS,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``, and
    ``_t``, the hash of its text.

    Two rows are linked if their sets of ``size``-word shingles have a Jaccard similarity of
    ``percent`` hundredths or more; ``component_id`` is the smallest id reachable over links.
    Needs ``doc_id`` and ``text``; other columns are not used. Null and empty texts and texts of
    blanks have no shingle, are linked with nothing and kept. Rows that repeat an id are rows of
    their own, kept if their id is the component's. A null id is never a component's id unless all
    its ids are null; then its rows are kept. Empty in, empty out.
    """
    width, threshold = bands * rows, percent / 100
    found = stored(signed(docs, size, bands, rows), "signed")
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_t", "sig")).alias("_r")
    nodes = stored(
        found.filter("node is not null").groupBy("node").agg(least).select(
            F.monotonically_increasing_id().alias("n"), "node", "_r.doc_id", "_r._t", "_r.sig"),
        "nodes")

    # buckets with two members or more
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda k: F.xxhash64(k, F.substring(F.col("sig"), k * (2 * rows) + 1, 2 * rows)))
    banded = nodes.select("n", F.explode(keys).alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("_size")).filter("_size > 1")
    members = stored(banded.join(shared, "bucket"), "members")
    degrees = members.groupBy("n").agg(F.sum("_size").alias("_degree"))
    ranked = members.join(degrees, "n")
    centres = ranked.groupBy("bucket").agg(
        F.min(F.struct(-F.col("_degree"), "n")).alias("_r")).select(
        "bucket", F.col("_r.n").alias("_centre"))
    # a group: the nodes that share some bucket with its centre
    groups = stored(members.join(centres, "bucket").select(
        F.col("_centre").alias("centre"), "n").distinct(), "groups")
    sigs = nodes.select("n", "sig")
    compare = agreements(width, threshold, miss)
    spokes = groups.filter("n <> centre").select(F.col("centre").alias("a"), F.col("n").alias("b"))
    pairs = spokes.join(sigs.toDF("a", "_x"), "a").join(sigs.toDF("b", "_y"), "b").filter(
        compare("_x", "_y") >= 0).select("a", "b")

    # texts of all nodes that share a bucket with others
    some = groups.select("n").distinct().join(nodes, "n")
    wanted = some.select("n", F.col("doc_id").alias("_d"), F.col("_t").alias("_h"), "sig")
    texts = stored(docs.select("doc_id", "text", F.xxhash64("text").alias("_t")).join(
        wanted, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_t") == F.col("_h"))
    ).select("n", "sig", "text"), "texts")
    comps = stars(exact_links(pairs, texts, size, percent))

    # groups that still hold several components are compared in full
    named = _labelled(groups, comps)
    mixed = named.groupBy("centre").agg(
        F.min("comp").alias("_lo"), F.max("comp").alias("_hi"), F.count("*").alias("_n")
    ).filter("_lo <> _hi and _n > 2").select("centre")
    more = stored(_block_links(
        named.join(mixed, "centre").join(texts, "n"), width, size, percent, miss), "links")
    if not more.isEmpty():
        comps = stars(comps.unionByName(more))

    # smallest id of each component
    grouped = _labelled(nodes.select("n", "node", "doc_id"), comps)
    smallest = grouped.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    by_node = grouped.join(smallest, "comp").select("node", "component_id")
    lone = F.col("node").isNull()
    return found.drop("sig").join(by_node, "node", "left").withColumn(
        "component_id", F.when(lone, F.col("doc_id")).otherwise(F.col("component_id"))).select(
        "doc_id", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "_t")


def without_copies(docs: DataFrame, **choices) -> DataFrame:
    """``docs`` without the rows that ``near_duplicates`` does not keep, so that the document with
    the smallest id is left of each component. Columns stay as they are. Rows that repeat both id
    and text are one document and stay or go together; rows without shingles all stay."""
    gone = near_duplicates(docs, **choices).filter("not kept").select(
        F.col("doc_id").alias("_id"), F.col("_t").alias("_h")).distinct()
    rows, back = shelve(docs, ["doc_id", "text"], [])
    keyed = rows.withColumns({"_key_id": F.col("doc_id"), "_key_text": F.xxhash64("text")})
    left = keyed.join(gone, F.col("_key_id").eqNullSafe(F.col("_id"))
                      & (F.col("_key_text") == F.col("_h")), "left_anti")
    return back(left)
