"""Best-fit packing: token pieces into sequences of fixed length, certified by lower bounds.

Pieces are dealt to partitions of bounded size; each packs its own by best-fit decreasing and
compares the number of sequences with a lower bound from dual feasible functions. A partition that
meets its bound cannot be improved. The others exchange their pieces, packed anew in other company,
as long as that saves a sequence.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.bpe import read_vocabulary, worker_encoder
from reviewloom.llm.text import shelve, stored

CAPACITY = 4096
END_ID = 1
GROUP = 65_536  # pieces a partition packs together
ROUNDS = 3  # exchanges at most
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids binary"


def token_pieces(docs: DataFrame, vocabulary_path: str, *, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of at most ``capacity`` tokens per document: its ids, then the end id. ``ids`` are
    little-endian unsigned 32-bit. A null text is one piece that holds the end id only; repeated
    rows and null ids give pieces of their own. No rows in, no rows out."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    end = np.array([END_ID], dtype="<u4").tobytes()
    width = 4 * capacity
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                        ("length", pa.int64()), ("ids", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(vocabulary)
        rows, size = [], 0
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.ids(texts), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), width)):
                    part = ids[at:at + width]
                    rows.append((doc_id, k, at // 4, len(part) // 4, part))
                    size += len(part)
                if size > 1 << 24:
                    yield _batch(rows, schema)
                    rows, size = [], 0
        yield _batch(rows, schema)

    return docs.select("doc_id", "text").mapInArrow(cut, PIECE_SCHEMA)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    return bound_of(*np.unique(lengths, return_counts=True), capacity)


def bound_of(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """No packing of ``counts[i]`` pieces of length ``sizes[i]`` has fewer bins: the best of two families of dual feasible
    functions, in whole numbers. One rounds (k+1)x down unless it is whole; the other counts what
    exceeds all but e as a full bin and drops what is below e."""
    sizes, counts = sizes.astype("int64"), counts.astype("int64")
    best = -(-int((sizes * counts).sum()) // capacity)
    for k in range(1, 33):
        exact = ((k + 1) * sizes) % capacity == 0
        value = np.where(exact, k * sizes, ((k + 1) * sizes // capacity) * capacity)
        best = max(best, -(-int((value * counts).sum()) // (k * capacity)))
    for e in (s for s in sizes if 2 * s <= capacity):
        value = np.where(sizes > capacity - e, capacity, np.where(sizes < e, 0, sizes))
        best = max(best, -(-int((value * counts).sum()) // capacity))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece. Bins wait in stacks by their free space; a bit set tells which
    stacks hold any, so the tightest fit is the lowest bit at or above a piece's length."""
    bins, offsets = np.empty(len(lengths), "int64"), np.empty(len(lengths), "int64")
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    free, n = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = free >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            chosen = stacks[space].pop()
            if not stacks[space]:
                free ^= 1 << space
        else:
            space, chosen, n = capacity, n, n + 1
        bins[i], offsets[i] = chosen, capacity - space
        left = space - size
        if left:
            if not stacks[left]:
                free |= 1 << left
            stacks[left].append(chosen)
    return bins, offsets


def _packed(pieces: DataFrame, n: int, turn: int, capacity: int, group: int) -> DataFrame:
    """``pieces`` (``_row``, ``length``) dealt to groups and packed; ``_gap`` is what its group uses
    above its lower bound."""
    groups = max(1, math.ceil(n / group))
    dealt = pieces.select("_row", "length").withColumn(
        "_group", F.pmod(F.xxhash64("_row", F.lit(turn)), F.lit(groups)))
    schema = pa.schema([("_row", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                        ("_bins", pa.int64()), ("_gap", pa.int64())])

    def pack(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        bins, offsets = best_fit_decreasing(lengths, capacity)
        used = int(bins.max()) + 1
        base = (turn << 56) + (int(table.column("_group")[0].as_py()) << 20)
        return pa.Table.from_arrays([
            table.column("_row"), pa.array(bins + base), pa.array(offsets),
            pa.array(np.where(offsets == 0, 1, 0).astype("int64")),
            pa.array(np.full(len(bins), used - lower_bound(lengths, capacity), "int64")),
        ], schema=schema)

    return dealt.groupBy("_group").applyInArrow(
        pack, "_row long, sequence_id long, offset long, _bins long, _gap long")


def pack(
    pieces: DataFrame, *, capacity: int = CAPACITY, group: int = GROUP, rounds: int = ROUNDS,
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; columns of these names are replaced.

    Needs ``length`` between 1 and ``capacity``. Every row is a piece of its own, also a repeated
    one. Rows move without their other columns; those are joined back at the end. Which of equally
    long pieces shares a sequence with which depends on row order only. No rows in, no rows out.
    """
    inside, back = shelve(pieces, ["length"], ["sequence_id", "offset"])
    rows = stored(inside.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    placed = stored(_packed(rows, rows.count(), 0, capacity, group), "packed")
    for turn in range(1, rounds + 1):
        gaps = placed.filter("_gap > 0")
        group_id = F.shiftright("sequence_id", 20)
        n, used, groups = gaps.agg(
            F.count("*"), F.sum("_bins"), F.count_distinct(group_id)).first()
        if groups < 2:  # nobody to exchange with
            break
        again = stored(_packed(gaps.join(rows, "_row").select("_row", "length"), n, turn,
                               capacity, group), "packed")
        if again.agg(F.sum("_bins")).first()[0] >= used:
            break
        placed = placed.filter("_gap <= 0").unionByName(again)
    return back(rows.join(placed.drop("_bins", "_gap"), "_row"))


def packing_bound(pieces: DataFrame, *, capacity: int = CAPACITY) -> int:
    """Sequences that any packing of all pieces needs. Collects lengths with their counts, of which
    there are ``capacity`` at most."""
    rows = pieces.groupBy("length").count().collect()
    return bound_of(np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """One row per sequence with its ids in place, for writing training files."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("_p")).select(
        "sequence_id", F.aggregate("_p", F.lit(b""), lambda x, p: F.concat(x, p["ids"])).alias("ids"))
