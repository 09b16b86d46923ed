"""Substring dedup by super-k-mers.

Every run of 13 words is a window. Its minimiser is the least hash of three neighbouring words in
it; consecutive windows with one minimiser form a super-k-mer and travel as one packed string to the
minimiser's bucket, where equal windows therefore meet. There they are sorted, and each window's
smallest document is known exactly.

A super-k-mer that a chunk of documents holds several times travels once, for the smallest of them;
the others are settled on the spot. However common a passage is, a bucket gets it once per chunk.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.near_dedup import WordHashes
from reviewloom.llm.text import shelve

WINDOW = 13
MINIMISER = 3  # words hashed together
BUCKET_BYTES = 16_000_000  # text per bucket
LEAST_BUCKETS = 64  # so that small inputs use all cores
CHUNK_BYTES = 16_000_000  # text whose super-k-mers are collected before they are packed
NO_ID = np.iinfo("int64").max  # a null id comes after all others
MIX = np.uint64(0xD6E8FEB86659FD93)
BLOCK = pa.schema([("bucket", pa.int64()), ("strings", pa.binary()), ("ids", pa.binary()),
                   ("marks", pa.binary()), ("starts", pa.binary())])
SPAN = pa.schema([("_id", pa.int64()), ("_mark", pa.int32()), ("start", pa.int32()),
                  ("end", pa.int32())])


def window_minimisers(hashes: np.ndarray, window: int, size: int) -> np.ndarray:
    """The least hash of ``size`` words in each window."""
    low = hashes[:len(hashes) - size + 1].copy()
    for k in range(1, size):
        low = (low ^ (low >> np.uint64(32))) * MIX + hashes[k:len(hashes) - size + 1 + k]
    low = (low ^ (low >> np.uint64(32))) * MIX
    low ^= low >> np.uint64(32)
    reach, width = 1, window - size + 1
    while reach < width:
        step = min(reach, width - reach)
        low = np.minimum(low[:-step], low[step:])
        reach += step
    return low


def super_kmers(text: str, known: WordHashes, window: int = WINDOW, size: int = MINIMISER):
    """(first window, minimiser, packed words) of each super-k-mer of a text."""
    words = text.encode().split()
    if len(words) < window:
        return
    hashes = np.fromiter(map(known.__getitem__, words), "uint64", len(words))
    least = window_minimisers(hashes, window, size)
    first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    ends = np.concatenate((first[1:], [len(least)])) + window - 1
    packed = b" ".join(words)
    place = np.zeros(len(words) + 1, "int64")
    np.cumsum(np.fromiter(map(len, words), "int64", len(words)) + 1, out=place[1:])
    yield from zip(first.tolist(), least[first].tolist(),
                   [packed[a:b] for a, b in zip(place[first].tolist(),
                                                (place[ends] - 1).tolist(), strict=True)],
                   strict=True)


class _Chunk:
    """Super-k-mers of some documents, each once, by bucket."""

    def __init__(self, buckets: int, window: int):
        self.buckets, self.window = buckets, window
        self.known, self.pack = WordHashes(), zstandard.ZstdCompressor(level=3).compress

    def blocks(self, docs: Sequence[tuple[int, int, str]]):
        """One packed block per bucket; and the spans (id, mark, start, end) settled here."""
        met: dict[bytes, int] = {}
        rows: dict[int, list[tuple]] = {}
        spans = []
        for doc_id, mark, text in sorted(docs, key=lambda d: d[0]):
            for start, least, packed in super_kmers(text, self.known, self.window):
                if met.setdefault(packed, doc_id) != doc_id:
                    spans.append((doc_id, mark, start, start + packed.count(b" ") + 1))
                else:
                    rows.setdefault(least % self.buckets, []).append(
                        (packed, doc_id, mark, start))
        for bucket, found in rows.items():
            strings, ids, marks, starts = zip(*found, strict=True)
            ids = np.diff(np.array(ids, "<i8"), prepend=0)
            yield (bucket, self.pack(b"\n".join(strings)), self.pack(ids.tobytes()),
                   np.array(marks, "<i4").tobytes(),
                   self.pack(np.array(starts, "<i4").tobytes())), None
        yield None, spans


def _chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[tuple]]:
    some, size = [], 0
    for batch in batches:
        for doc_id, mark, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if text:
                some.append((NO_ID if doc_id is None else doc_id, mark, text))
                size += len(text)
                if size >= most:
                    yield some
                    some, size = [], 0
    if some:
        yield some


def _repeats(ids: np.ndarray, at: np.ndarray, docs: np.ndarray, window: int) -> np.ndarray:
    """Which windows ``ids[at:at + window]`` are also found under a smaller document. Those that share
    a hash of their words with another one are sorted by it, then document; neighbours are compared
    word by word."""
    value = np.zeros(len(at), "uint64")
    for k in range(window):
        value = (value ^ (value >> np.uint64(29))) * MIX + ids[at + k].astype("uint64")
    out = np.zeros(len(at), bool)
    order = np.argsort(value)
    again = value[order[1:]] == value[order[:-1]]
    shared = order[np.append(again, False) | np.append(False, again)]
    if len(shared) == 0:
        return out
    at, docs, value = at[shared], docs[shared], value[shared]
    order = np.lexsort((docs, value))
    while True:
        at_, docs_, value_ = at[order], docs[order], value[order]
        same_hash = value_[1:] == value_[:-1]
        same = same_hash.copy()
        for k in range(window):
            same &= ids[at_[1:] + k] == ids[at_[:-1] + k]
        if (same == same_hash).all():
            break
        # different windows under one hash: order by all words instead
        columns = [ids[at + k] for k in range(window)]
        order = np.lexsort((docs, *columns))
        value = np.zeros(len(at), "uint64")
        ranks = np.cumsum(np.concatenate(([False], np.any(
            [c[order][1:] != c[order][:-1] for c in columns], axis=0))))
        value[order] = ranks.astype("uint64")
    begins = np.flatnonzero(np.concatenate(([True], ~same)))
    least = np.repeat(docs_[begins], np.diff(np.concatenate((begins, [len(at)]))))
    out[shared[order]] = docs_ > least
    return out


def numbered_words(lines: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The words of lines that all end with a line feed, as numbers, and how many each line has."""
    data = np.frombuffer(lines, "uint8").copy()
    ends = np.flatnonzero((data == ord(" ")) | (data == ord("\n")))
    lengths = np.diff(np.flatnonzero(data[ends] == ord("\n")), prepend=-1)
    data[ends] = ord(" ")  # each word goes with one blank
    starts = np.append(0, ends + 1)
    words = pa.Array.from_buffers(
        pa.large_binary(), len(ends), [None, pa.py_buffer(starts), pa.py_buffer(data)])
    return words.dictionary_encode().indices.to_numpy(), lengths


def bucket_spans(blocks: pa.Table, window: int) -> pa.Table:
    """Spans of words, of all super-k-mers in a bucket, that lie in windows of smaller documents."""
    unpack = zstandard.ZstdDecompressor().decompress
    texts, ids, marks, starts = [], [], [], []
    for s, i, m, a in zip(*(blocks.column(c).to_pylist() for c in BLOCK.names[1:]), strict=True):
        texts += [unpack(s), b"\n"]
        ids.append(np.cumsum(np.frombuffer(unpack(i), "<i8")))
        marks.append(np.frombuffer(m, "<i4"))
        starts.append(np.frombuffer(unpack(a), "<i4"))
    ids, marks, starts = (np.concatenate(x) for x in (ids, marks, starts))
    words, lengths = numbered_words(b"".join(texts))
    counts = lengths - window + 1
    owner = np.repeat(np.arange(len(lengths)), counts)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = np.repeat(np.cumsum(lengths) - lengths, counts) + inside
    hit = np.flatnonzero(_repeats(words, at, ids[owner], window))
    owner, inside = owner[hit], inside[hit]
    fresh = np.concatenate(([True], (owner[1:] != owner[:-1]) | (inside[1:] != inside[:-1] + 1)))
    begins = np.flatnonzero(fresh) if len(hit) else np.array([], "int64")
    ends = np.concatenate((begins[1:], [len(hit)]))[:len(begins)] - 1
    who = owner[begins]
    return pa.Table.from_arrays([
        pa.array(ids[who]), pa.array(marks[who]),
        pa.array((starts[who] + inside[begins]).astype("int32")),
        pa.array((starts[who] + inside[ends] + window).astype("int32"))], schema=SPAN)


def _batch(rows: Sequence[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``_id``, ``_mark`` (32 bits of the text's hash), ``start``, ``end``: spans of words that repeat
    a window of a smaller document."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, math.ceil(total / BUCKET_BYTES))
    both = pa.schema([*BLOCK, *SPAN])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk(buckets, window)
        for some in _chunks(batches, CHUNK_BYTES):
            for block, spans in chunk.blocks(some):
                if block:
                    yield _batch([(*block, None, None, None, None)], both)
                elif spans:
                    yield _batch([(None, None, None, None, None, *s) for s in spans], both)

    fields = ("bucket long, strings binary, ids binary, marks binary, starts binary, "
              "_id long, _mark int, start int, end int")
    packed = docs.select("doc_id", _mark(), "text").mapInArrow(pack, fields)
    # a settled span goes through the same shuffle, dealt by its document
    dealt = packed.withColumn("_to", F.when(
        F.col("bucket").isNull(), F.pmod(F.xxhash64("_id", "_mark"), F.lit(buckets))
    ).otherwise(F.col("bucket")))

    def settle(table: pa.Table) -> pa.Table:
        settled = pc.is_null(table.column("bucket"))
        spans = table.filter(settled).select(SPAN.names)
        blocks = table.filter(pc.invert(settled))
        found = [spans] if len(spans) else []
        if len(blocks):
            found.append(bucket_spans(blocks, window))
        return pa.concat_tables(found)

    return dealt.groupBy("_to").applyInArrow(settle, "_id long, _mark int, start int, end int")


def _mark():
    return F.xxhash64("text").cast("string").substr(-9, 9).cast("int").alias("_mark")


def _without(series: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, starts, ends in series:
        rows = []
        for text, a, b in zip(texts, starts, ends, strict=True):
            words = (text or "").encode().split()
            if a is None or len(a) == 0:
                rows.append((len(words), 0, b" ".join(words).decode()))
                continue
            keep = np.zeros(len(words) + 1, "int64")
            np.add.at(keep, a, 1)
            np.add.at(keep, b, -1)
            left = [words[i] for i in np.flatnonzero(np.cumsum(keep)[:-1] == 0).tolist()]
            rows.append((len(words), len(words) - len(left), b" ".join(left).decode()))
        yield pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_text"])


def substring_dedup(docs: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text``: the text without the words under a
    window of words that also starts in a document with a smaller id, joined by one blank.

    Needs ``doc_id`` and ``text``; columns with one of the new names are replaced, all others stay.
    Windows are judged on the input. Repeats inside one document, or in rows that share an id,
    are kept. A null id counts as larger than all others. Null and empty texts and texts of fewer
    words than a window lose nothing. No rows in, no rows out.
    """
    spans = repeated_spans(docs, window).groupBy("_id", "_mark").agg(
        F.collect_list("start").alias("_starts"), F.collect_list("end").alias("_ends"))
    inside, back = shelve(docs, ["doc_id", "text"], ["n_words", "n_removed", "kept_text"])
    rows = inside.withColumns({
        "_id": F.coalesce("doc_id", F.lit(int(NO_ID))), "_mark": _mark()})
    without = F.pandas_udf(_without, "n_words long, n_removed long, kept_text string")
    out = rows.join(spans, ["_id", "_mark"], "left").withColumn(
        "_r", without("text", "_starts", "_ends"))
    return back(out.select("*", "_r.*"))
